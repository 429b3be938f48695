"""Proxy inputs over the driver's tables.

The pipeline's real inputs (a catalogue text file, ``.tar.gz`` packages,
article XML) are not among the test tables, so each is expressed as a view
over them with the same shape and edge cases.  The statements are plain SQL
that runs unchanged in Spark and DuckDB; Spark binds the tables as DataFrames
(``spark.sql(text, documents=df)``), the oracle names the registered views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("documents", "conversations", "lineitem")

# Catalogue lines (header excluded): 5, 4 and 6 fields, an empty trailing
# field, empty pmid, paths with and without the extension.
RAW_LIST = """
SELECT doc_id + 1 AS line_no,
  CASE WHEN doc_id % 10 = 3 THEN concat(p, chr(9), t, chr(9), k, chr(9), m)
       WHEN doc_id % 10 = 7 THEN concat(p, chr(9), t, chr(9), k, chr(9), m, chr(9), source, chr(9), 'x')
       WHEN doc_id % 10 = 9 THEN concat(p, chr(9), t, chr(9), k, chr(9), m, chr(9))
       ELSE concat(p, chr(9), t, chr(9), k, chr(9), m, chr(9), source) END AS value
FROM (SELECT doc_id, source,
        concat('oa_package/', substring(md5(concat('', doc_id)), 1, 2), '/PMC', doc_id,
               CASE WHEN doc_id % 2 = 0 THEN '.tar.gz' ELSE '' END) AS p,
        concat('Title ', doc_id) AS t, concat('PMC', doc_id) AS k,
        CASE WHEN doc_id % 5 = 0 THEN '' ELSE concat('', 100000 + doc_id) END AS m
      FROM {documents}) d
"""

# One row per figure: blank captions, NULL / dotted / capitalised / foldered
# refs, repeated fig_id, colliding empty pmid.
FIGURES = """
SELECT conv_id AS article_id, concat('PMC', conv_id) AS pmcid,
  CASE WHEN conv_id % 5 = 0 THEN '' ELSE concat('', 100000 + conv_id) END AS pmid,
  turn AS fig_pos, concat('F', turn % 5) AS fig_id, concat('Figure ', turn) AS fig_label,
  CASE WHEN (conv_id + turn) % 11 = 10 THEN '  ' ELSE text END AS fig_caption,
  CASE (conv_id + turn) % 8
    WHEN 0 THEN concat('a', conv_id, '-g', turn)
    WHEN 1 THEN concat('sub/a', conv_id, '-g', turn, '.jpg')
    WHEN 2 THEN concat('A', conv_id, '-G', turn)
    WHEN 3 THEN CAST(NULL AS STRING)
    WHEN 4 THEN concat('a', conv_id, '-g.', turn)
    WHEN 5 THEN concat('g', turn)
    WHEN 6 THEN concat('a', conv_id, '-G', turn, 'x')
    ELSE concat('a', conv_id, '-g', turn, '.tif') END AS graphic_ref
FROM {conversations}
"""

# Package members: mixed-case names and extensions, .nxml, several formats per
# stem, the same basename in two folders (last wins).
MEMBERS = """
SELECT conv_id AS article_id, 2 * turn + d AS pos,
  concat('PMC', conv_id, CASE WHEN d = 1 THEN '/alt/' ELSE '/' END,
    CASE WHEN (conv_id + turn) % 3 = 0 THEN 'A' ELSE 'a' END, conv_id, '-g', turn,
    CASE (conv_id + turn + CASE WHEN (conv_id + turn) % 4 = 0 THEN 0 ELSE d END) % 7
      WHEN 0 THEN '.jpg' WHEN 1 THEN '.PNG' WHEN 2 THEN '.tif'
      WHEN 3 THEN '.jpeg' WHEN 4 THEN '.nxml' WHEN 5 THEN '.jpg' ELSE '.tiff' END) AS name,
  1000 + (conv_id * 31 + turn * 7 + d) % 5000 AS size
FROM (SELECT conv_id, turn, text, 0 AS d FROM {conversations}
      UNION ALL
      SELECT conv_id, turn, text, 1 AS d FROM {conversations} WHERE (conv_id + turn) % 2 = 0) x
"""

# The same members with synthetic bytes (Spark side only): a format signature
# chosen by extension, junk for every fifth member, then the text.
MEMBERS_CONTENT = """
SELECT article_id, pos, name, size,
  concat(unhex(CASE WHEN (article_id + pos) % 5 = 4 THEN '00112233445566778899AABBCCDDEEFF'
                    WHEN lower(name) LIKE '%.png' THEN '89504E470D0A1A0A0000000D49484452'
                    WHEN lower(name) LIKE '%.tif' OR lower(name) LIKE '%.tiff' THEN '49492A0008000000'
                    WHEN lower(name) LIKE '%.nxml' THEN '3C3F786D6C'
                    ELSE 'FFD8FFE000104A464946' END),
         encode(text, 'UTF-8')) AS content
FROM {members_text} m
"""

# Package sizes per catalogue entry (unknown for every 7th).
PACKAGE_SIZES = """
SELECT concat('PMC', doc_id) AS pmcid,
  CASE WHEN doc_id % 7 = 0 THEN CAST(NULL AS BIGINT) ELSE n_chars * 64 END AS size
FROM {documents}
"""

# Packages already landed on disk, and which locations hold which package.
LANDED = """
SELECT concat('/landing/', 'PMC', doc_id, '.tar.gz') AS path FROM {documents} WHERE doc_id % 3 <> 1
"""
PRIMARY_HAS = """
SELECT concat('oa_package/', substring(md5(concat('', doc_id)), 1, 2), '/PMC', doc_id, '.tar.gz') AS rel_path
FROM {documents} WHERE doc_id % 4 IN (0, 1)
"""
FALLBACK_HAS = """
SELECT concat('oa_package/', substring(md5(concat('', doc_id)), 1, 2), '/PMC', doc_id, '.tar.gz') AS rel_path
FROM {documents} WHERE doc_id % 4 IN (1, 2)
"""

def member_name_sql(d: int) -> str:
    """The ``members`` view's name expression for a fixed ``d`` (0 or 1)."""
    return f"""concat('PMC', conv_id, '{'/alt/' if d else '/'}',
    CASE WHEN (conv_id + turn) % 3 = 0 THEN 'A' ELSE 'a' END, conv_id, '-g', turn,
    CASE (conv_id + turn + CASE WHEN (conv_id + turn) % 4 = 0 THEN 0 ELSE {d} END) % 7
      WHEN 0 THEN '.jpg' WHEN 1 THEN '.PNG' WHEN 2 THEN '.tif'
      WHEN 3 THEN '.jpeg' WHEN 4 THEN '.nxml' WHEN 5 THEN '.jpg' ELSE '.tiff' END)"""


def member_junk_sql(d: int) -> str:
    """Members whose bytes carry no image signature (every fifth position)."""
    return f"(conv_id + 2 * turn + {d}) % 5 = 4"


GRAPHIC_REF_SQL = """CASE (conv_id + turn) % 8
    WHEN 0 THEN concat('a', conv_id, '-g', turn)
    WHEN 1 THEN concat('sub/a', conv_id, '-g', turn, '.jpg')
    WHEN 2 THEN concat('A', conv_id, '-G', turn)
    WHEN 3 THEN CAST(NULL AS STRING)
    WHEN 4 THEN concat('a', conv_id, '-g.', turn)
    WHEN 5 THEN concat('g', turn)
    WHEN 6 THEN concat('a', conv_id, '-G', turn, 'x')
    ELSE concat('a', conv_id, '-g', turn, '.tif') END"""


def _sig_sql(d: int) -> str:
    n = member_name_sql(d)
    return f"""CASE WHEN {member_junk_sql(d)} THEN '00112233445566778899AABBCCDDEEFF'
              WHEN lower({n}) LIKE '%.png' THEN '89504E470D0A1A0A0000000D49484452'
              WHEN lower({n}) LIKE '%.tif' OR lower({n}) LIKE '%.tiff' THEN '49492A0008000000'
              WHEN lower({n}) LIKE '%.nxml' THEN '3C3F786D6C'
              ELSE 'FFD8FFE000104A464946' END"""


# One package per conversation row (Spark side only): the article XML first,
# then the row's one or two members with synthetic bytes; every 13th package is
# corrupted after packing.  Catalogue fields ride along.
PACKAGE_ROWS = f"""
SELECT conv_id, turn, conv_id * 1000 + turn + 1 AS line_no,
  concat('PMC', conv_id, '-', turn) AS pmcid, concat('', 200000 + conv_id) AS pmid,
  concat('/packages/PMC', conv_id, '-', turn, '.tar.gz') AS path,
  (conv_id + turn) % 13 = 7 AS corrupt,
  CASE WHEN (conv_id + turn) % 2 = 0 THEN array(xml_name, n0, n1) ELSE array(xml_name, n0) END AS names,
  CASE WHEN (conv_id + turn) % 2 = 0 THEN array(xml, c0, c1) ELSE array(xml, c0) END AS contents
FROM (
  SELECT conv_id, turn,
    concat('PMC', conv_id, '-', turn, '/article.nxml') AS xml_name,
    encode(concat('<?xml version="1.0"?><article xmlns:xlink="http://www.w3.org/1999/xlink"><front><article-meta>',
      '<article-id pub-id-type="pmid">', CASE WHEN conv_id % 5 = 0 THEN '' ELSE concat('', 100000 + conv_id) END, '</article-id>',
      CASE WHEN turn % 2 = 0 THEN concat('<article-id pub-id-type="pmc">', conv_id, '-', turn, '</article-id>') ELSE '' END,
      '</article-meta></front><body><fig id="F', turn % 5, '"><label>Figure ', turn, '</label><caption><p>',
      replace(replace(replace(CASE WHEN (conv_id + turn) % 11 = 10 THEN '  ' ELSE text END, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'),
      '</p></caption>',
      CASE WHEN ref IS NULL THEN '' ELSE concat('<graphic xlink:href="', ref, '"/>') END,
      '</fig></body></article>'), 'UTF-8') AS xml,
    {member_name_sql(0)} AS n0,
    {member_name_sql(1)} AS n1,
    concat(unhex({_sig_sql(0)}), encode(text, 'UTF-8')) AS c0,
    concat(unhex({_sig_sql(1)}), encode(text, 'UTF-8')) AS c1
  FROM (SELECT *, {GRAPHIC_REF_SQL} AS ref FROM {{conversations}}) r
) x
"""

# ---------------------------------------------------------------------------
# A PNG and a JPEG of one pixel.
PNG_HEX = "89504E470D0A1A0A0000000D4948445200000001000000010802000000907753DE0000000C49444154785E636060600000000400010FD2ADE40000000049454E44AE426082"
JPEG_HEX = (
    "FFD8FFE000104A46494600010200000100010000FFDB004300080606070605080707070909080A0C140D0C0B0B0C1912130F141D1A1F1E1D1A1C1C20242E2720222C231C1C2837292C"
    "30313434341F27393D38323C2E333432FFDB0043010909090C0B0C180D0D1832211C2132323232323232323232323232323232323232323232323232323232323232323232323232"
    "32323232323232323232323232FFC00011080001000103012200021101031101FFC4001F0000010501010101010100000000000000000102030405060708090A0BFFC400B5100002"
    "010303020403050504040000017D01020300041105122131410613516107227114328191A1082342B1C11552D1F02433627282090A161718191A25262728292A3435363738393A43"
    "4445464748494A535455565758595A636465666768696A737475767778797A838485868788898A92939495969798999AA2A3A4A5A6A7A8A9AAB2B3B4B5B6B7B8B9BAC2C3C4C5C6C7"
    "C8C9CAD2D3D4D5D6D7D8D9DAE1E2E3E4E5E6E7E8E9EAF1F2F3F4F5F6F7F8F9FAFFC4001F0100030101010101010101010000000000000102030405060708090A0BFFC400B5110002"
    "0102040403040705040400010277000102031104052131061241510761711322328108144291A1B1C109233352F0156272D10A162434E125F11718191A262728292A35363738393A"
    "434445464748494A535455565758595A636465666768696A737475767778797A82838485868788898A92939495969798999AA2A3A4A5A6A7A8A9AAB2B3B4B5B6B7B8B9BAC2C3C4C5"
    "C6C7C8C9CAD2D3D4D5D6D7D8D9DAE2E3E4E5E6E7E8E9EAF2F3F4F5F6F7F8F9FAFFDA000C03010002110311003F00F9FE8A28A00FFFD9"
)
# ---------------------------------------------------------------------------


def member_cut_sql(d: int) -> str:
    """Images that are cut in half: their signature is right, they do not decode."""
    return f"(conv_id + 2 * turn + {d}) % 3 = 1"


def _image_sql(d: int) -> str:
    hexed = f"CASE WHEN lower({member_name_sql(d)}) LIKE '%.png' THEN '{PNG_HEX}' ELSE '{JPEG_HEX}' END"
    return f"unhex(CASE WHEN {member_cut_sql(d)} THEN substring({hexed}, 1, 2 * (length({hexed}) div 4)) ELSE {hexed} END)"


# The same packages with real images, a third of them cut in half.
PACKAGE_IMAGES = PACKAGE_ROWS
for _d in (0, 1):
    PACKAGE_IMAGES = PACKAGE_IMAGES.replace(f"concat(unhex({_sig_sql(_d)}), encode(text, 'UTF-8')) AS c{_d}", f"{_image_sql(_d)} AS c{_d}")

# Packages with two articles: the first one in archive order counts.
TWO_ARTICLES = """
SELECT conv_id, turn, concat('PMC', conv_id, '-', turn, '.tar.gz') AS path,
  array('z/second-to-none.NXML', concat('a/', turn, '.jpg'), 'a/second.nxml') AS names,
  array(encode(concat('<article><fig id="first-', conv_id, '"/><fig/></article>'), 'UTF-8'), unhex('FFD8FF'),
        encode('<article><fig id="second"/></article>', 'UTF-8')) AS contents
FROM {conversations}
"""

MEMBERS_TEXT = MEMBERS.replace("AS size\n", "AS size, text\n", 1)

PROXIES = {
    "package_rows": (PACKAGE_ROWS, ("conversations",)),
    "package_images": (PACKAGE_IMAGES, ("conversations",)),
    "two_articles": (TWO_ARTICLES, ("conversations",)),
    "members_text": (MEMBERS_TEXT, ("conversations",)),
    "members_content": (MEMBERS_CONTENT, ("members_text",)),
    "raw_list": (RAW_LIST, ("documents",)),
    "figures": (FIGURES, ("conversations",)),
    "members": (MEMBERS, ("conversations",)),
    "package_sizes": (PACKAGE_SIZES, ("documents",)),
    "landed": (LANDED, ("documents",)),
    "primary_has": (PRIMARY_HAS, ("documents",)),
    "fallback_has": (FALLBACK_HAS, ("documents",)),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def proxy(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql, deps = PROXIES[name]
    return spark.sql(sql, **{d: _source(spark, sf_dir, d) for d in deps})


def _source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return proxy(spark, sf_dir, name) if name in PROXIES else table(spark, sf_dir, name)


def cte(*names: str) -> str:
    """``WITH`` clause defining the named proxies over the registered views (oracle side)."""
    parts = [f"{n} AS ({PROXIES[n][0].format(**{d: d for d in PROXIES[n][1]})})" for n in names]
    return "WITH " + ",\n".join(parts)
