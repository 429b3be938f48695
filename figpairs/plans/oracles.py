"""DuckDB oracle SQL for the registered queries (same column names)."""

from __future__ import annotations

from figpairs.plans.proxies import GRAPHIC_REF_SQL, JPEG_HEX, PNG_HEX, cte, member_cut_sql, member_junk_sql, member_name_sql
from figpairs.plans.queries import MAX_MB, PAIR_SHARD, SHARD, SUBSET

WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
MB = 1024 * 1024

CAT = """cat AS (
  SELECT line_no, f[1] AS path, f[2] AS title, f[3] AS pmcid, f[4] AS pmid, f[5] AS code
  FROM (SELECT line_no, string_split(value, chr(9)) AS f FROM raw_list) WHERE len(f) = 5)"""

SPLIT = """sp AS (
  SELECT *, CAST(('0x' || substr(md5(pmcid), 1, 8)) AS BIGINT) % 100 AS bucket FROM cat),
 spl AS (SELECT *, CASE WHEN bucket < 97 THEN 'train' WHEN bucket < 98 THEN 'dev' ELSE 'test' END AS split FROM sp)"""

USABLE = f"""uf AS (
  SELECT *, trim(fig_caption, {WS}) AS caption FROM figures
  WHERE trim(fig_caption, {WS}) <> '' AND graphic_ref <> '')"""

REFS = """us AS (
  SELECT *, CASE WHEN regexp_matches(base, '^.+\\.[^.]+$') THEN regexp_replace(base, '\\.[^.]*$', '') ELSE base END AS stem
  FROM (SELECT *, regexp_extract(graphic_ref, '[^/]*$') AS base FROM uf))"""

IMAP = """im AS (
  SELECT article_id, lower(regexp_extract(name, '[^/]*$')) AS k, min(pos) AS fp, max(pos) AS lp
  FROM members WHERE regexp_matches(lower(name), '\\.(jpg|jpeg|png|tif|tiff)$') GROUP BY 1, 2)"""

CAND = """cand AS (
  SELECT article_id, fig_pos, 0 AS r, lower(base) AS c FROM us
  UNION ALL SELECT article_id, fig_pos, 1, lower(stem || '.jpg') FROM us
  UNION ALL SELECT article_id, fig_pos, 2, lower(stem || '.jpeg') FROM us
  UNION ALL SELECT article_id, fig_pos, 3, lower(stem || '.png') FROM us
  UNION ALL SELECT article_id, fig_pos, 4, lower(stem || '.tif') FROM us
  UNION ALL SELECT article_id, fig_pos, 5, lower(stem || '.tiff') FROM us)"""

MATCH = f"""{REFS},
 {IMAP},
 {CAND},
 xm AS (SELECT cand.article_id, cand.fig_pos, arg_min(im.k, cand.r) AS k, arg_min(im.lp, cand.r) AS lp
        FROM cand JOIN im ON cand.article_id = im.article_id AND cand.c = im.k GROUP BY 1, 2),
 lm AS (SELECT us.article_id, us.fig_pos, arg_min(im.k, im.fp) AS k, arg_min(im.lp, im.fp) AS lp
        FROM us JOIN im ON us.article_id = im.article_id AND contains(im.k, us.stem)
        WHERE NOT EXISTS (SELECT 1 FROM xm WHERE xm.article_id = us.article_id AND xm.fig_pos = us.fig_pos)
        GROUP BY 1, 2),
 mall AS (SELECT article_id, fig_pos, k AS member_key, lp AS member_pos, 'exact' AS match_kind FROM xm
          UNION ALL SELECT article_id, fig_pos, k, lp, 'loose' FROM lm)"""

PAIRS = """pr AS (
  SELECT concat_ws('/', nullif(uf.pmcid, ''), uf.pmcid || '_fig-' || uf.fig_id || '.jpg') AS image, uf.caption,
         uf.pmid, uf.pmcid, uf.pmid || '_' || uf.fig_id AS pair_id, uf.article_id, uf.fig_pos, mall.member_pos
  FROM uf JOIN mall ON uf.article_id = mall.article_id AND uf.fig_pos = mall.fig_pos)"""

BASE_MATCH = cte("figures", "members") + f",\n {USABLE},\n {MATCH}"
BASE_PAIRS = cte("raw_list", "figures", "members") + f",\n {CAT},\n {USABLE},\n {MATCH},\n {PAIRS}"

SPLIT_PAIRS = f"""{BASE_PAIRS},
 {SPLIT},
 sprs AS (SELECT pr.*, spl.split, spl.line_no FROM pr JOIN spl ON pr.pmcid = spl.pmcid
          QUALIFY row_number() OVER (PARTITION BY spl.split, pr.pair_id ORDER BY spl.line_no, pr.fig_pos) = 1)"""

XML_LINES = """s AS (SELECT conv_id, turn, string_split(text, chr(10)) AS parts, (conv_id + turn) % 9 = 4 AS broken FROM conversations),
 l AS (SELECT conv_id, turn, parts, broken, unnest(range(len(parts))) AS i FROM s),
 xf AS (SELECT conv_id, turn, CAST(i AS BIGINT) AS fig_pos, 'F' || turn || '-' || i AS fig_id, 'Figure' || chr(160) || i AS fig_label,
               'T' || i || ' ' || parts[i + 1] AS fig_caption, 'g' || turn || '-' || i AS graphic_ref,
               CAST(conv_id + 100000 AS VARCHAR) AS pmid, CAST(conv_id AS VARCHAR) AS pmc
        FROM l WHERE NOT broken)"""

DEDUPE = f"""{BASE_PAIRS},
 dd AS (SELECT * FROM pr QUALIFY row_number() OVER (PARTITION BY pair_id ORDER BY article_id, fig_pos) = 1)"""

PRIOR = """pf AS (SELECT article_id, fig_pos, pmid || '_' || fig_id AS pair_id FROM figures)"""

ENTRIES = f"""{SPLIT_PAIRS},
 {cte("package_sizes", "landed")[5:]},
 nf AS (SELECT pmcid, count(*) AS n_usable FROM uf GROUP BY 1),
 np AS (SELECT pmcid, count(*) AS n_pairs FROM sprs GROUP BY 1),
 ld AS (SELECT regexp_replace(regexp_extract(path, '[^/]*$'), '\\.tar\\.gz$', '') AS pmcid FROM landed),
 ent AS (SELECT spl.*, np.n_pairs,
           CASE WHEN ps.size > {MAX_MB * MB} THEN 'too_large'
                WHEN NOT EXISTS (SELECT 1 FROM ld WHERE ld.pmcid = spl.pmcid) THEN 'fetch_failed'
                WHEN nf.n_usable IS NULL THEN 'no_figures'
                WHEN coalesce(np.n_pairs, 0) = 0 THEN 'no_pair_written'
                ELSE 'ok' END AS reason
         FROM spl LEFT JOIN package_sizes ps ON ps.pmcid = spl.pmcid
                  LEFT JOIN nf ON nf.pmcid = spl.pmcid LEFT JOIN np ON np.pmcid = spl.pmcid)"""

SIG = """CASE WHEN (article_id + pos) % 5 = 4 THEN 16
          WHEN lower(name) LIKE '%.png' THEN 16
          WHEN lower(name) LIKE '%.tif' OR lower(name) LIKE '%.tiff' THEN 8
          WHEN lower(name) LIKE '%.nxml' THEN 5 ELSE 10 END"""
FMT = """CASE WHEN (article_id + pos) % 5 = 4 THEN NULL
          WHEN lower(name) LIKE '%.png' THEN 'png'
          WHEN lower(name) LIKE '%.tif' OR lower(name) LIKE '%.tiff' THEN 'tiff'
          WHEN lower(name) LIKE '%.nxml' THEN NULL ELSE 'jpeg' END"""


BYTES = """unhex(CASE WHEN (mt.article_id + mt.pos) % 5 = 4 THEN '00112233445566778899AABBCCDDEEFF'
          WHEN lower(mt.name) LIKE '%.png' THEN '89504E470D0A1A0A0000000D49484452'
          WHEN lower(mt.name) LIKE '%.tif' OR lower(mt.name) LIKE '%.tiff' THEN '49492A0008000000'
          WHEN lower(mt.name) LIKE '%.nxml' THEN '3C3F786D6C' ELSE 'FFD8FFE000104A464946' END) || encode(mt.text)"""

PKG = f"""WITH base AS (
  SELECT conv_id, turn, text, conv_id * 1000 + turn AS article_id, conv_id * 1000 + turn + 1 AS line_no,
         {GRAPHIC_REF_SQL.replace("STRING", "VARCHAR")} AS graphic_ref
  FROM conversations WHERE (conv_id + turn) % 13 <> 7),
 uf AS (SELECT article_id, 0 AS fig_pos, line_no, 'F' || (turn % 5) AS fig_id, trim(text, {WS}) AS caption, graphic_ref,
          coalesce(nullif(CASE WHEN conv_id % 5 = 0 THEN '' ELSE CAST(100000 + conv_id AS VARCHAR) END, ''), CAST(200000 + conv_id AS VARCHAR)) AS pmid,
          CASE WHEN turn % 2 = 0 THEN conv_id || '-' || turn ELSE 'PMC' || conv_id || '-' || turn END AS pmcid,
          'PMC' || conv_id || '-' || turn AS cat_pmcid
        FROM base WHERE (conv_id + turn) % 11 <> 10 AND trim(text, {WS}) <> '' AND graphic_ref <> ''),
 members AS (SELECT article_id, 1 AS pos, {member_name_sql(0)} AS name, {member_junk_sql(0)} AS junk FROM base
             UNION ALL
             SELECT article_id, 2 AS pos, {member_name_sql(1)} AS name, {member_junk_sql(1)} AS junk FROM base WHERE (conv_id + turn) % 2 = 0),
 {MATCH},
 pk AS (SELECT uf.line_no, uf.fig_id, uf.caption, uf.pmid, uf.pmcid, uf.cat_pmcid FROM uf
        JOIN mall ON mall.article_id = uf.article_id AND mall.fig_pos = uf.fig_pos
        JOIN members m ON m.article_id = mall.article_id AND m.pos = mall.member_pos WHERE NOT m.junk),
 ps AS (SELECT *, CASE WHEN b < 97 THEN 'train' WHEN b < 98 THEN 'dev' ELSE 'test' END AS split
        FROM (SELECT *, CAST(('0x' || substr(md5(cat_pmcid), 1, 8)) AS BIGINT) % 100 AS b FROM pk)),
 pdd AS (SELECT * FROM ps QUALIFY row_number() OVER (PARTITION BY split, pmid || '_' || fig_id ORDER BY line_no) = 1)"""

# The same with images that are cut in half instead of junk.
DECODED = PKG
for _d in (0, 1):
    DECODED = DECODED.replace(f"{member_junk_sql(_d)} AS junk", f"{member_cut_sql(_d)} AS junk")
DECODED = DECODED.replace("uf.cat_pmcid FROM uf", "uf.cat_pmcid, m.name FROM uf")

ORACLE: dict[str, str] = {
    "image_valid": """
SELECT conv_id, turn, turn + 1 AS width, conv_id % 5 + 1 AS height FROM conversations WHERE (conv_id + turn) % 7 <> 3""",
    "landed_listing": """
SELECT 'PMC' || conv_id || '-' || turn AS pmcid, CASE WHEN (conv_id + turn) % 3 <> 1 THEN 'landed' ELSE 'pending' END AS state
FROM conversations""",
    "xml_scan": """
SELECT conv_id, turn, (conv_id + turn) % 9 <> 4 AS parsed,
       CAST(CASE WHEN (conv_id + turn) % 9 = 4 THEN 0 ELSE len(string_split(text, chr(10))) END AS BIGINT) AS n_figures
FROM conversations""",
    "build_from_packages": PKG + """
SELECT pmcid || '/' || pmcid || '_fig-' || fig_id || '.jpg' AS image, caption, pmid, pmcid, pmid || '_' || fig_id AS pair_id, split FROM pdd""",
    "build_from_packages_skips": PKG + """
SELECT CASE WHEN (conv_id + turn) % 13 = 7 THEN 'bad_archive'
            WHEN conv_id * 1000 + turn + 1 IN (SELECT line_no FROM pdd) THEN 'ok' ELSE 'no_pair_written' END AS reason, count(*) AS n
FROM conversations GROUP BY 1""",
    "written_report": PKG + """,
 lst AS (SELECT *, CASE WHEN b < 97 THEN 'train' WHEN b < 98 THEN 'dev' ELSE 'test' END AS split, line_no % 17 = 3 AS away
         FROM (SELECT (conv_id + turn) % 13 = 7 AS bad, conv_id * 1000 + turn + 1 AS line_no,
                      CAST(('0x' || substr(md5('PMC' || conv_id || '-' || turn), 1, 8)) AS BIGINT) % 100 AS b FROM conversations)),
 won AS (SELECT line_no, count(*) AS n FROM (
           SELECT * FROM ps WHERE line_no % 17 <> 3 QUALIFY row_number() OVER (PARTITION BY split, pmid || '_' || fig_id ORDER BY line_no) = 1) GROUP BY 1),
 ent AS (SELECT split, CASE WHEN away THEN 'fetch_failed' WHEN bad THEN 'bad_archive' WHEN n IS NULL THEN 'no_pair_written' ELSE 'ok' END AS reason,
                coalesce(n, 0) AS n_pairs FROM lst LEFT JOIN won USING (line_no))
SELECT coalesce(split, '*') AS split, reason, count(*) AS n, CAST(sum(n_pairs) AS BIGINT) AS n_pairs
FROM ent GROUP BY GROUPING SETS ((split, reason), (reason))""",
    "list_skip_malformed": cte("raw_list") + f",\n {CAT}\nSELECT * FROM cat",
    "list_failfast_violations": cte("raw_list") + f"""
SELECT line_no, n_fields FROM (
  SELECT line_no, CAST(len(string_split(trim(value, {WS}), chr(9))) AS BIGINT) AS n_fields FROM raw_list)
WHERE n_fields <> 5""",
    "list_at_least_five": cte("raw_list") + "\nSELECT line_no, string_split(value, chr(9))[3] AS pmcid, value FROM raw_list WHERE len(string_split(value, chr(9))) >= 5",
    "subset_limit": cte("raw_list") + f",\n {CAT}\nSELECT * FROM cat WHERE line_no <= {SUBSET}",
    "package_urls": cte("raw_list") + f""",\n {CAT}
SELECT line_no, rel_path, 'https://pmc-oa-opendata.s3.amazonaws.com/' || rel_path AS primary_url,
       'https://ftp.ncbi.nlm.nih.gov/pub/pmc/' || rel_path AS fallback_url
FROM (SELECT line_no, CASE WHEN ends_with(path, '.tar.gz') THEN path ELSE path || '.tar.gz' END AS rel_path FROM cat)""",
    "size_guard": cte("raw_list", "package_sizes") + f""",\n {CAT}
SELECT cat.line_no, cat.pmcid, s.size FROM cat LEFT JOIN package_sizes s ON s.pmcid = cat.pmcid
WHERE s.size IS NULL OR s.size <= {MAX_MB * MB}""",
    "size_required": cte("raw_list", "package_sizes") + f""",\n {CAT}
SELECT cat.line_no, cat.pmcid, s.size FROM cat JOIN package_sizes s ON s.pmcid = cat.pmcid WHERE s.size IS NOT NULL""",
    "pending_fetch": cte("raw_list", "landed") + f""",\n {CAT}
SELECT line_no, pmcid, pmcid || '.tar.gz' AS file_name FROM cat
WHERE pmcid || '.tar.gz' NOT IN (SELECT regexp_extract(path, '[^/]*$') FROM landed)""",
    "resolve_fallback": cte("raw_list", "primary_has", "fallback_has") + f""",\n {CAT},
 r AS (SELECT line_no, CASE WHEN ends_with(path, '.tar.gz') THEN path ELSE path || '.tar.gz' END AS rel_path FROM cat)
SELECT line_no, rel_path,
  CASE WHEN rel_path IN (SELECT rel_path FROM primary_has) THEN 'https://pmc-oa-opendata.s3.amazonaws.com/' || rel_path
       WHEN rel_path IN (SELECT rel_path FROM fallback_has) THEN 'https://ftp.ncbi.nlm.nih.gov/pub/pmc/' || rel_path END AS resolved_url,
  CASE WHEN rel_path IN (SELECT rel_path FROM primary_has) THEN 'primary'
       WHEN rel_path IN (SELECT rel_path FROM fallback_has) THEN 'fallback' ELSE 'fetch_failed' END AS fetch_status
FROM r""",
    "list_package_join": cte("raw_list", "landed") + f""",\n {CAT}
SELECT cat.line_no, cat.pmcid, landed.path AS package_path FROM cat
JOIN landed ON regexp_replace(regexp_extract(landed.path, '[^/]*$'), '\\.tar\\.gz$', '') = cat.pmcid""",
    "split_assign": cte("raw_list") + f",\n {CAT},\n {SPLIT}\nSELECT line_no, pmcid, bucket, split FROM spl",
    "split_counts": cte("raw_list") + f",\n {CAT},\n {SPLIT}\nSELECT split, count(*) AS n FROM spl GROUP BY 1",
    "split_is_partition": "SELECT 'missing' AS check, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'extra', CAST(0 AS BIGINT)",
    "shard_assign": cte("raw_list") + f"\nSELECT line_no, (line_no - 1) // {SHARD} AS shard_idx FROM raw_list",
    "shard_sizes": cte("raw_list") + f"\nSELECT (line_no - 1) // {SHARD} AS shard_idx, count(*) AS n_rows FROM raw_list GROUP BY 1",
    "shard_scan_numbering": cte("raw_list") + f"""
SELECT file_path, CAST(dense_rank() OVER (ORDER BY file_path) AS BIGINT) AS list_no, n_lines FROM (
  SELECT 'lists/train_shard-' || lpad(CAST((line_no - 1) // {SHARD} AS VARCHAR), 5, '0') || '.txt' AS file_path, count(*) AS n_lines
  FROM raw_list GROUP BY 1)""",
    "line_numbers": "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS line_no FROM documents",
    "resume_existing_ids": cte("figures") + f",\n {PRIOR}\nSELECT DISTINCT pair_id FROM pf WHERE article_id % 3 = 0 AND pair_id <> ''",
    "resume_anti": cte("figures") + f""",\n {USABLE},\n {PRIOR}
SELECT article_id, fig_pos, pmid || '_' || fig_id AS pair_id FROM uf
WHERE pmid || '_' || fig_id NOT IN (SELECT pair_id FROM pf WHERE article_id % 3 = 0)""",
    "allowlist_semi": cte("raw_list", "figures") + f""",\n {CAT},\n {SPLIT}
SELECT article_id, fig_pos, pmcid FROM figures WHERE pmcid IN (SELECT pmcid FROM spl WHERE split = 'train')""",
    "usable_figures": cte("figures") + f",\n {USABLE}\nSELECT article_id, fig_pos, caption FROM uf",
    "article_ids": cte("raw_list", "figures") + f""",\n {CAT},
 fp AS (SELECT article_id, pmcid, arg_min(pmid, fig_pos) AS first_pmid FROM figures GROUP BY 1, 2)
SELECT fp.article_id, fp.pmcid, coalesce(nullif(fp.first_pmid, ''), cat.pmid) AS pmid
FROM fp LEFT JOIN cat ON cat.pmcid = fp.pmcid""",
    "pair_records": BASE_PAIRS + "\nSELECT image, caption, pmid, pmcid, pair_id, article_id, fig_pos FROM pr",
    "parse_figures": f"WITH {XML_LINES}\nSELECT * FROM xf",
    "parse_error_report": "SELECT 'xml_syntax' AS reason, count(*) AS n FROM conversations WHERE (conv_id + turn) % 9 = 4",
    "articles_seen": f"""WITH {XML_LINES}
SELECT count(*) AS n_articles, count(*) FILTER (WHERE NOT broken) AS n_parsed,
       CAST(coalesce(sum(len(parts)) FILTER (WHERE NOT broken), 0) AS BIGINT) AS n_figures FROM s""",
    "article_records": f"""WITH {XML_LINES}
SELECT pmid, pmc, '/data/PMC' || conv_id AS location, CAST(count(*) OVER (PARTITION BY conv_id, turn) AS BIGINT) AS n_figures,
       fig_pos AS fig_idx, fig_caption, fig_id, fig_label,
       '/data/PMC' || conv_id || '/' || graphic_ref || '.jpg' AS graphic_ref, pmid || '_' || fig_id AS pair_id
FROM xf""",
    "first_xml": cte("members") + """
SELECT article_id, min(pos) AS xml_pos, arg_min(name, pos) AS xml_name FROM members WHERE ends_with(lower(name), '.nxml') GROUP BY 1""",
    "member_filter": cte("members") + "\nSELECT article_id, pos, name FROM members WHERE regexp_matches(lower(name), '\\.(jpg|jpeg|png|tif|tiff)$')",
    "image_map": cte("members") + f",\n {IMAP}\nSELECT article_id, k AS key, fp AS first_pos, lp AS member_pos FROM im",
    "ref_basename_stem": cte("figures") + """,
 b AS (SELECT article_id, fig_pos, regexp_extract(graphic_ref, '[^/]*$') AS ref_base FROM figures WHERE graphic_ref IS NOT NULL)
SELECT article_id, fig_pos, ref_base,
  CASE WHEN regexp_matches(ref_base, '^.+\\.[^.]+$') THEN regexp_replace(ref_base, '\\.[^.]*$', '') ELSE ref_base END AS ref_stem FROM b""",
    "candidate_names": cte("figures") + f""",
 uf AS (SELECT * FROM figures WHERE graphic_ref IS NOT NULL),
 {REFS},
 {CAND}
SELECT article_id, fig_pos, CAST(r AS BIGINT) AS rank, c AS candidate FROM cand""",
    "match_exact": BASE_MATCH + "\nSELECT article_id, fig_pos, k AS member_key, lp AS member_pos FROM xm",
    "match_loose": BASE_MATCH + "\nSELECT article_id, fig_pos, k AS member_key, lp AS member_pos FROM lm",
    "match_all": BASE_MATCH + "\nSELECT * FROM mall",
    "match_join_form": BASE_MATCH + "\nSELECT article_id, fig_pos, member_pos FROM mall",
    "catalogue_file_scan": cte("raw_list") + f"""
SELECT 'train_shard-' || lpad(CAST((line_no - 1) // {SHARD} AS VARCHAR), 5, '0') AS shard_name, (line_no - 1) % {SHARD} + 1 AS line_no, value FROM raw_list""",
    "resume_after_partial_write": PKG + "\nSELECT DISTINCT split, pmid || '_' || fig_id AS pair_id FROM pdd",
    "build_from_shard_lists": PKG + f""",
 pl AS (SELECT *, (line_no - 1) // {SHARD * 100} AS shard_idx FROM pk),
 pw AS (SELECT * FROM pl QUALIFY row_number() OVER (PARTITION BY shard_idx, pmid || '_' || fig_id ORDER BY line_no) = 1),
 pn AS (SELECT line_no, count(*) AS n FROM pw GROUP BY 1)
SELECT (e.line_no - 1) // {SHARD * 100} AS shard_idx, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_written,
       CAST(count(*) FILTER (WHERE n IS NULL) AS BIGINT) AS n_skipped, count(*) AS n_entries
FROM (SELECT conv_id * 1000 + turn + 1 AS line_no FROM conversations) e LEFT JOIN pn USING (line_no) GROUP BY 1""",
    "unmatched_figures": BASE_MATCH + """
SELECT article_id, fig_pos FROM uf WHERE NOT EXISTS (SELECT 1 FROM mall WHERE mall.article_id = uf.article_id AND mall.fig_pos = uf.fig_pos)""",
    "dedupe_first": DEDUPE + "\nSELECT pair_id, article_id, fig_pos, image, caption FROM dd",
    "dedupe_first_lineitem": """
SELECT l_returnflag, pair_id, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
  SELECT *, l_orderkey || '_' || l_linenumber AS pair_id FROM lineitem)
QUALIFY row_number() OVER (PARTITION BY l_returnflag, pair_id
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_linestatus) = 1""",
    "pair_id_collisions": BASE_PAIRS + """
SELECT pair_id, count(DISTINCT pmcid) AS n_articles, count(*) AS n_rows FROM pr GROUP BY 1 HAVING count(DISTINCT pmcid) > 1""",
    "skip_reasons": ENTRIES + "\nSELECT reason, count(*) AS n FROM ent GROUP BY 1",
    "run_summary": ENTRIES + """
SELECT split, CAST(sum(CASE WHEN reason = 'ok' THEN n_pairs ELSE 0 END) AS BIGINT) AS n_written,
       CAST(sum(CASE WHEN reason = 'ok' THEN 0 ELSE 1 END) AS BIGINT) AS n_skipped, count(*) AS n_entries
FROM ent GROUP BY 1""",
    "shard_status": cte("raw_list") + f""",
 st AS (SELECT (line_no - 1) // {SHARD} AS shard_idx,
               count(*) FILTER (WHERE len(string_split(trim(value, {WS}), chr(9))) <> 5) = 0 AS ok
        FROM raw_list GROUP BY 1)
SELECT count(*) FILTER (WHERE ok) AS n_ok, count(*) FILTER (WHERE NOT ok) AS n_fail, count(*) AS n_total FROM st""",
    "line_count": cte("raw_list") + "\nSELECT count(*) AS n_lines FROM raw_list",
    "append_resume_on": BASE_PAIRS + """,
 prior AS (SELECT * FROM pr WHERE article_id % 3 = 0),
 new AS (SELECT * FROM pr WHERE pair_id NOT IN (SELECT pair_id FROM prior)
         QUALIFY row_number() OVER (PARTITION BY pair_id ORDER BY article_id, fig_pos) = 1)
SELECT pair_id, article_id, fig_pos FROM prior UNION ALL SELECT pair_id, article_id, fig_pos FROM new""",
    "append_resume_off": BASE_PAIRS + """
SELECT pair_id, article_id, fig_pos FROM pr WHERE article_id % 3 = 0
UNION ALL SELECT pair_id, article_id, fig_pos FROM pr""",
    "image_sniff": cte("members") + f"\nSELECT article_id, pos, {FMT} AS format FROM members",
    "image_manifest": BASE_PAIRS + f""",
 {cte("members_text")[5:]},
 mt AS (SELECT article_id, pos, name, CAST({SIG} + strlen(text) AS BIGINT) AS n_bytes, {FMT} AS format FROM members_text)
SELECT pr.article_id, pr.fig_pos, pr.pair_id, pr.image, mt.name AS source_member, mt.n_bytes, mt.format
FROM pr JOIN mt ON mt.article_id = pr.article_id AND mt.pos = pr.member_pos""",
    "unpack_packages": cte("members_text") + f"""
SELECT article_id, pos AS src_pos, CAST(0 AS BIGINT) AS member_pos, name, CAST({SIG} + strlen(text) AS BIGINT) AS n_bytes, true AS same_bytes
FROM members_text""",
    "build_pairs": SPLIT_PAIRS + """,
 prior AS (SELECT pr.pair_id, spl.split FROM pr JOIN spl ON pr.pmcid = spl.pmcid WHERE pr.article_id % 3 = 0),
 todo AS (SELECT pr.*, spl.split, spl.line_no FROM pr JOIN spl ON pr.pmcid = spl.pmcid
          WHERE NOT EXISTS (SELECT 1 FROM prior WHERE prior.split = spl.split AND prior.pair_id = pr.pair_id)
          QUALIFY row_number() OVER (PARTITION BY spl.split, pr.pair_id ORDER BY spl.line_no, pr.fig_pos) = 1)
SELECT image, caption, pmid, pmcid, pair_id, split FROM todo""",
    "bad_archive_report": cte("members") + """
SELECT CASE WHEN (article_id + pos) % 6 = 5 THEN 'bad_archive' ELSE 'ok' END AS status, count(*) AS n FROM members GROUP BY 1""",
    "pairs_json_roundtrip": DEDUPE + "\nSELECT image, caption, pmid, pmcid, pair_id FROM dd",
    "pairs_by_split": SPLIT_PAIRS + "\nSELECT split, count(*) AS n FROM sprs GROUP BY 1",
    "pairs_by_shard": BASE_PAIRS + f""",
 sh AS (SELECT pr.*, (cat.line_no - 1) // {PAIR_SHARD} AS shard_idx, cat.line_no FROM pr JOIN cat ON cat.pmcid = pr.pmcid
        QUALIFY row_number() OVER (PARTITION BY shard_idx, pr.pair_id ORDER BY pr.article_id, pr.fig_pos) = 1)
SELECT shard_idx, count(*) AS n FROM sh GROUP BY 1""",
    "articles_json_roundtrip": f"""WITH {XML_LINES}
SELECT CAST(conv_id + 100000 AS VARCHAR) AS pmid, CAST(conv_id AS VARCHAR) AS pmc, '/data/PMC' || conv_id AS location,
       CAST(len(parts) AS BIGINT) AS n_figures FROM s WHERE NOT broken""",
    "split_files": cte("raw_list") + """,
 c AS (SELECT line_no, string_split(value, chr(9))[3] AS pmcid FROM raw_list WHERE len(string_split(value, chr(9))) >= 5),
 s AS (SELECT line_no, CASE WHEN CAST(('0x' || substr(md5(pmcid), 1, 8)) AS BIGINT) % 100 < 97 THEN 'train'
                            WHEN CAST(('0x' || substr(md5(pmcid), 1, 8)) AS BIGINT) % 100 < 98 THEN 'dev' ELSE 'test' END AS split FROM c)
SELECT split || '-' || lpad(CAST((line_no - 1) // 1000000 AS VARCHAR), 5, '0') AS list, count(*) + 1 AS n_lines, CAST(1 AS BIGINT) AS n_headers
FROM s GROUP BY 1""",
    "split_order": cte("raw_list") + """,
 c AS (SELECT line_no, string_split(value, chr(9))[3] AS pmcid FROM raw_list WHERE len(string_split(value, chr(9))) >= 5),
 s AS (SELECT line_no, CASE WHEN CAST(('0x' || substr(md5(pmcid), 1, 8)) AS BIGINT) % 100 < 97 THEN 'train'
                            WHEN CAST(('0x' || substr(md5(pmcid), 1, 8)) AS BIGINT) % 100 < 98 THEN 'dev' ELSE 'test' END AS split FROM c)
SELECT split || '-' || lpad(CAST((line_no - 1) // 1000000 AS VARCHAR), 5, '0') AS list, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_out_of_order
FROM s GROUP BY 1""",
    "shard_files": cte("raw_list") + f"""
SELECT 'train_shard-' || lpad(CAST((line_no - 1) // {SHARD} AS VARCHAR), 5, '0') AS shard_name, count(*) + 1 AS n_lines, CAST(1 AS BIGINT) AS n_headers
FROM raw_list GROUP BY 1""",
    "shard_union": BASE_PAIRS + f""",
 sh AS (SELECT pr.*, (cat.line_no - 1) // {PAIR_SHARD} AS shard_idx FROM pr JOIN cat ON cat.pmcid = pr.pmcid
        QUALIFY row_number() OVER (PARTITION BY shard_idx, pr.pair_id ORDER BY pr.article_id, pr.fig_pos) = 1)
SELECT pair_id, image, caption, shard_idx FROM sh""",
    "packed_shards": SPLIT_PAIRS + f""",
 {cte("members_text")[5:]},
 tr AS (SELECT *, row_number() OVER (ORDER BY line_no, fig_pos) - 1 AS ordinal FROM sprs WHERE split = 'train'),
 c AS (SELECT lpad(CAST(ordinal // {SHARD} AS VARCHAR), 6, '0') AS shard, lpad(CAST(ordinal AS VARCHAR), 9, '0') AS k, caption, {BYTES} AS content
       FROM tr JOIN members_text mt ON mt.article_id = tr.article_id AND mt.pos = tr.member_pos)
SELECT shard, k || '.jpg' AS name, CAST(octet_length(content) AS BIGINT) AS n_bytes, md5(content) AS md5 FROM c
UNION ALL SELECT shard, k || '.txt', CAST(strlen(caption) AS BIGINT), md5(caption) FROM c
UNION ALL SELECT shard, k || '.json', NULL, NULL FROM c""",
    "lazy_bytes": f"""WITH m AS (
  SELECT conv_id, turn, 1 AS pos, {member_name_sql(0)} AS name, {member_junk_sql(0)} AS junk, text FROM conversations
  UNION ALL SELECT conv_id, turn, 2, {member_name_sql(1)}, {member_junk_sql(1)}, text FROM conversations WHERE (conv_id + turn) % 2 = 0),
 b AS (SELECT *, unhex(CASE WHEN lower(name) LIKE '%.png' THEN '89504E470D0A1A0A0000000D49484452'
                            WHEN lower(name) LIKE '%.tif' OR lower(name) LIKE '%.tiff' THEN '49492A0008000000' ELSE 'FFD8FFE000104A464946' END) || encode(text) AS content
       FROM m WHERE NOT junk AND lower(name) NOT LIKE '%.nxml' AND (conv_id + turn) % 13 <> 7)
SELECT 'PMC' || conv_id || '-' || turn AS pmcid, CAST(pos AS BIGINT) AS member_pos, CAST(octet_length(content) AS BIGINT) AS n_bytes, md5(content) AS md5 FROM b""",
    "build_decoded": DECODED + f"""
SELECT pmcid || '/' || pmcid || '_fig-' || fig_id || '.jpg' AS image, caption, pmid, pmcid, pmid || '_' || fig_id AS pair_id, split,
       CAST(CASE WHEN lower(name) LIKE '%.png' THEN {len(PNG_HEX) // 2} ELSE {len(JPEG_HEX) // 2} END AS BIGINT) AS n_bytes FROM pdd""",
    "stream_landings": PKG + """
SELECT pmcid || '/' || pmcid || '_fig-' || fig_id || '.jpg' AS image, caption, pmid, pmcid, pmid || '_' || fig_id AS pair_id, split FROM pdd""",
    "first_xml_unpacked": """
SELECT 'PMC' || conv_id || '-' || turn AS pmcid, CAST(2 AS BIGINT) AS n_figures, 'first-' || conv_id AS fig_id, CAST(2 AS BIGINT) AS n_articles FROM conversations""",
    "inline_refs_guard": """
SELECT conv_id, CAST(2 * count(*) FILTER (turn % 4 = 3) AS BIGINT) AS n_refs, count(*) AS n_figures FROM conversations GROUP BY 1 HAVING n_refs > 0""",
    "shard_report": """
SELECT conv_id AS shard_idx, 'lists/' || lpad(CAST(conv_id AS VARCHAR), 9, '0') || '.txt' AS shard_path, count(*) FILTER (bad) = 0 AS ok,
       CASE WHEN count(*) FILTER (bad) > 0 THEN count(*) FILTER (bad) || ' of ' || count(*) || ' entries failed: bad_archive' END AS msg
FROM (SELECT conv_id, (conv_id + turn) % 13 = 7 AS bad FROM conversations) GROUP BY 1""",
}
ORACLE["resume_indexed"] = ORACLE["resume_anti"]
