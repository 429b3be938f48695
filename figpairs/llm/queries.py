"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from figpairs.llm.common import crc_mod, table

# The rules that op3 applies: host, path, verdict.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from figpairs.llm.near_dup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from figpairs.llm.lm_scoring import lm_scores, quality_target

    return lm_scores(table(spark, sf_dir, "documents"), quality_target(table(spark, sf_dir, "labels")))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from figpairs.llm.url_filters import url_verdicts

    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES) + " AS t(host, path, verdict)")
    return url_verdicts(table(spark, sf_dir, "pages"), rules)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from figpairs.llm.token_files import token_files

    return token_files(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from figpairs.llm.toxicity import learn, toxicity

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    model = learn(docs, labels, ~held_out)
    return toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op6_long_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    from figpairs.llm.long_matches import remove_long_matches

    return remove_long_matches(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from figpairs.llm.decontaminate import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from figpairs.llm.quality_rules import quality_rules

    return quality_rules(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from figpairs.llm.language_id import language_spans, learn

    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    found = language_spans(docs, learn(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from figpairs.llm.mixing import mix

    m = mix(table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", "taken", F.col("copies").cast("long").alias("copies"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from figpairs.llm.prefix_trie import rebuilt_prefixes

    return rebuilt_prefixes(table(spark, sf_dir, "conversations")).drop("enter", "exit")


def op12_preference_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from figpairs.llm.preference import learn, preference_scores

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    model = learn(docs, labels, ~held_out)
    return preference_scores(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op13_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from figpairs.llm.word_runs import disturbed, word_runs

    return word_runs(table(spark, sf_dir, "documents"), rewrite=disturbed).drop("runs")


QUERIES = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_url_filters": op3_url_filters,
    "op4_token_files": op4_token_files,
    "op5_toxicity": op5_toxicity,
    "op6_long_matches": op6_long_matches,
    "op7_benchmark_leaks": op7_benchmark_leaks,
    "op8_quality_rules": op8_quality_rules,
    "op9_language_id": op9_language_id,
    "op10_mixing": op10_mixing,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_preference_quality": op12_preference_quality,
    "op13_word_runs": op13_word_runs,
}

_W = r"[^\x20\x09-\x0D]+"

_OP3 = r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
     p AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
     r(h, p, verdict) AS (VALUES %s),
     m AS (SELECT page_id, host, path, max(struct_pack(n := length(h) + length(r.p), hn := length(h), rule := h || r.p, verdict := r.verdict)) AS best
           FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, r.p) GROUP BY ALL)
SELECT p.page_id, p.host, p.path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM p LEFT JOIN (SELECT DISTINCT host, path, best FROM m) m ON p.host = m.host AND p.path = m.path
""" % ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

_OP8 = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
     w AS (SELECT doc_id, t, source, regexp_extract_all(t, '%(w)s') AS ws FROM d),
     tri AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
             FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2)),
     rep AS (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
     cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM rep GROUP BY doc_id),
     ln AS (SELECT doc_id, source, t, unnest(string_split(t, chr(10))) AS line FROM d),
     wl AS (SELECT doc_id, source, t, line, len(regexp_extract_all(line, '%(w)s')) AS words,
                   translate(array_to_string(regexp_extract_all(line, '%(w)s'), ' '),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789', 'abcdefghijklmnopqrstuvwxyz0000000000') AS norm
            FROM ln WHERE regexp_matches(line, '%(w)s')),
     dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM wl GROUP BY doc_id),
     hosts AS (SELECT source, count(DISTINCT t) AS docs FROM d GROUP BY source),
     freq AS (SELECT source, norm, count(DISTINCT t) AS docs FROM wl GROUP BY source, norm),
     often AS (SELECT f.source, f.norm FROM freq f JOIN hosts h ON f.source IS NOT DISTINCT FROM h.source
               WHERE f.docs >= 20 AND f.docs > 0.1 * h.docs),
     lost AS (SELECT wl.doc_id, sum(words) AS n FROM wl JOIN often o ON wl.source IS NOT DISTINCT FROM o.source AND wl.norm = o.norm GROUP BY wl.doc_id),
     s AS (SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
                  length(t) - length(translate(t, '#*$%%&|<>', '')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
                  coalesce(cov.n, 0) AS n_repeat_words, coalesce(lost.n, 0) AS frequent_words
           FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN lost USING (doc_id)),
     b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       frequent_words::BIGINT AS frequent_words, NOT base_failed AND 2 * frequent_words <= n_words AS kept
FROM b
""" % {"w": _W}

_OP10 = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '%(w)s'))::BIGINT AS size, md5(doc_id::VARCHAR) AS h FROM documents),
     s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM d GROUP BY source),
     w AS (SELECT *, [3, 1, 2][((k - 1) %% 3 + 1)::INT] AS weight FROM s),
     -- rounds of giving shares by weight and holding those above twice their size
     lv(round, level) AS (
       SELECT 0, (SELECT sum(source_size) * 150 / 100.0 / sum(weight) FROM w)
       UNION ALL
       SELECT round + 1, nxt FROM (
         SELECT lv.round, lv.level, (SELECT ((SELECT sum(source_size) * 150 / 100.0 FROM w) - coalesce(sum(2 * source_size) FILTER (2 * source_size <= level * weight), 0))
                                            / sum(weight) FILTER (2 * source_size > level * weight) FROM w) AS nxt FROM lv)
       WHERE nxt IS NOT NULL AND nxt > level),
     f AS (SELECT max(level) AS level FROM lv),
     t AS (SELECT source, source_size, CASE WHEN 2 * source_size <= level * weight THEN (2 * source_size)::DOUBLE ELSE weight * level END AS target FROM w, f),
     c AS (SELECT d.*, t.source_size, t.target,
                  sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id) - size + size / 2 AS middle
           FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
     k AS (SELECT *, CASE WHEN size = 0 THEN 0 ELSE (middle <= target)::INT + (source_size + middle <= target)::INT END AS copies FROM c)
SELECT doc_id, size, source_size, target::DOUBLE AS target, (copies * size)::BIGINT AS taken, copies::BIGINT AS copies FROM k
""" % {"w": _W}

_OP11 = r"""
WITH crcs AS (SELECT list(v ORDER BY n) AS t FROM (
       SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) AS r(n))),
     turns AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i,
                      md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS turn,
                      len(regexp_extract_all(coalesce(text, ''), '%(w)s')) AS words
               FROM conversations WHERE conv_id IS NOT NULL),
     convs AS (SELECT c, c - c %% 20 AS base,
                      xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
                                      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) %% 4 AS h
               FROM (SELECT DISTINCT c FROM turns), crcs),
     seq AS (SELECT v.c, 0 AS kind, t.i, turn, words FROM convs v JOIN turns t ON t.c = v.base AND t.i < v.h
             UNION ALL SELECT v.c, 1, t.i, turn, words FROM convs v JOIN turns t ON t.c = v.c AND t.i >= v.h),
     lists AS (SELECT v.c, coalesce(list(turn ORDER BY kind, i) FILTER (turn IS NOT NULL), []) AS ts,
                      coalesce(list(words ORDER BY kind, i) FILTER (turn IS NOT NULL), []) AS ws FROM convs v LEFT JOIN seq USING (c) GROUP BY v.c),
     rows AS (SELECT c, d, d = len(ts) AS last, md5(array_to_string(ts[1:d], ',')) AS k, CASE WHEN d > 0 THEN md5(array_to_string(ts[1:d - 1], ',')) END AS up,
                     CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS words
              FROM (SELECT *, unnest(range(len(ts) + 1)) AS d FROM lists)),
     nodes AS (SELECT k, any_value(up) AS up, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
                      sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends_sha256 FROM rows GROUP BY k),
     children AS (SELECT up AS k, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY up),
     n AS (SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children USING (k)),
     sums AS (SELECT r.k, count(*) FILTER (n.n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM n JOIN rows r ON r.c = n.conv_id AND r.d <= n.depth GROUP BY r.k)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, sums.n_leaves, sums.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN sums USING (k) LEFT JOIN nodes p ON p.k = n.up
""" % {"w": _W}

ORACLE = {"op11_prefix_trie": _OP11, "op3_url_filters": _OP3, "op8_quality_rules": _OP8, "op10_mixing": _OP10}
