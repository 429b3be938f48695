"""Quality rules: counts within a document, and lines that many documents of a host share.

Lines are normalised (ASCII lower case, digits to 0, white space to single
spaces) and hashed to 64 bits.  Over the whole corpus the distinct documents
of each host that hold a line are counted; a line in at least ``min_docs`` of
them and in more than ``max_share`` of the host's distinct documents is
boilerplate.  Boilerplate lines are removed, and a document that loses more
than ``max_removed`` of its words is depleted and rejected.  Exact copies on a
host are one document in these counts, so copies alone never make a line
frequent.  Copies are removed elsewhere, by near-duplicate removal.

One pass reads the texts and writes counts and line hashes, which are far
smaller, to the shared folder; all shuffles move hashes only, and line counts
are summed before they are shuffled.

Defined results:
* null and empty texts: all counts 0, ``base_failed`` true (under 50 words);
* a null host is a host of its own;
* repeated rows each keep their row and get equal results;
* very long texts are read whole; an empty table gives an empty result;
* other columns of the documents do not take part and are not returned.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figpairs.llm.common import by_bytes, free_name, stored, without_ids, worker_cache

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\f"
BATCH_BYTES = 8 << 20
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FOLD = bytes(48 if 48 <= b <= 57 else b + 32 if 65 <= b <= 90 else b for b in range(256))


def repeat_words(words: list) -> int:
    """Words inside a window of three words that the text holds twice or more."""
    n = len(words)
    windows = list(zip(words, words[1:], words[2:]))
    seen: dict = {}
    for g in windows:
        seen[g] = seen.get(g, 0) + 1
    if len(seen) == len(windows):
        return 0
    covered = bytearray(n)
    for i, g in enumerate(windows):
        if seen[g] > 1:
            covered[i] = covered[i + 1] = covered[i + 2] = 1
    return sum(covered)


def line_hashes(data: bytes) -> tuple[int, dict[int, int]]:
    """(lines equal to an earlier line, words under each normalised line's hash)."""
    import xxhash

    raw, dup, by_hash = set(), 0, {}
    for line in data.split(b"\n"):
        words = line.split()
        if not words:
            continue
        if line in raw:
            dup += 1
        raw.add(line)
        h = xxhash.xxh3_64_intdigest(b" ".join(words).translate(FOLD))
        h -= (h >> 63) << 64
        by_hash[h] = by_hash.get(h, 0) + len(words)
    return dup, by_hash


def measure(text: str | None) -> tuple:
    import xxhash

    text = text or ""
    data = text.encode()
    words = data.split()
    dup, lines = line_hashes(data)
    return (len(words), len(text) - sum(text.count(c) for c in SPACES), sum(text.count(c) for c in SYMBOLS), dup,
            repeat_words(words), xxhash.xxh3_128_digest(data), list(lines), list(lines.values()))


def _measured(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    d = docs.select(F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"), F.col(text_col).cast("string").alias("text"))
    id_type = d.schema["id"].dataType.simpleString()

    def run(batches):
        kinds = [pa.int64()] * 5 + [pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = [*COUNTS, "content", "lines", "line_words"]
        worker_cache("quality")
        for b in by_bytes(batches, 2, BATCH_BYTES):
            cols = list(zip(*(measure(t) for t in b.column(2).to_pylist()))) or [[]] * 8
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *(pa.array(c, k) for c, k in zip(cols, kinds))], ["id", "host", *names])

    return d.mapInArrow(run, f"id {id_type}, host string, " + ", ".join(f"{c} long" for c in COUNTS)
                        + ", content binary, lines array<long>, line_words array<long>")


def frequent_lines(distinct: DataFrame, min_docs: int, max_share: float) -> DataFrame:
    """(host, line) above the limits; ``distinct`` has one row per distinct document of a host."""
    of_host = distinct.groupBy("host").agg(F.count("*").alias("host_docs"))
    counted = (distinct.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count("*").alias("docs"))
               .where(F.col("docs") >= min_docs))
    return (counted.alias("c").join(of_host.alias("h"), F.col("c.host").eqNullSafe(F.col("h.host")))
            .where(F.col("docs") > max_share * F.col("host_docs")).select("c.host", "line", "docs"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  min_words: int = 50, max_repeat: float = 0.5, min_docs: int = 20, max_share: float = 0.1,
                  max_removed: float = 0.5) -> DataFrame:
    """Per row: id, the counts, ``base_failed``, ``frequent_words`` (words on boilerplate lines) and ``kept``."""
    m = stored(_measured(docs, id_col, text_col, host_col), "quality")
    distinct = m.groupBy("host", "content").agg(F.first("lines").alias("lines"), F.first("line_words").alias("line_words"))
    often = frequent_lines(distinct, min_docs, max_share)
    lost = (distinct.select("host", "content", F.explode(F.arrays_zip("lines", "line_words")).alias("l"))
            .select(F.col("host"), "content", F.col("l.lines").alias("line"), F.col("l.line_words").alias("words")).alias("d")
            .join(often.alias("o"), F.col("d.host").eqNullSafe(F.col("o.host")) & (F.col("d.line") == F.col("o.line")))
            .groupBy("d.host", "d.content").agg(F.sum("d.words").alias("frequent_words")))
    out = m.alias("m").join(lost.alias("l"), F.col("m.host").eqNullSafe(F.col("l.host")) & (F.col("m.content") == F.col("l.content")), "left")
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    words = F.coalesce(F.col("frequent_words"), F.lit(0))
    return out.select(F.col("m.id").alias(id_col), *COUNTS, failed.alias("base_failed"), words.alias("frequent_words"),
                      (~failed & (words <= max_removed * F.col("n_words"))).alias("kept"))


def without_frequent_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                           min_docs: int = 20, max_share: float = 0.1) -> DataFrame:
    """``docs`` with the lines above the limits taken out of ``text_col``; null texts stay null.

    Only documents that hold such a line are rewritten; the list of a
    document's frequent lines is at most as long as its own list of lines.
    """
    m = stored(_measured(docs, id_col, text_col, host_col), "quality")
    distinct = m.groupBy("host", "content").agg(F.first("lines").alias("lines"), F.first("line_words").alias("line_words"))
    often = frequent_lines(distinct, min_docs, max_share)
    mine = (distinct.select("host", "content", F.explode("lines").alias("line")).alias("d")
            .join(often.alias("o"), F.col("d.host").eqNullSafe(F.col("o.host")) & (F.col("d.line") == F.col("o.line")))
            .groupBy("d.host", "d.content").agg(F.collect_list("d.line").alias("__drop")))

    @F.pandas_udf("binary")
    def content(texts):
        import xxhash

        return texts.map(lambda t: xxhash.xxh3_128_digest((t or "").encode()))

    @F.pandas_udf("string")
    def cleaned(texts, drops):
        import xxhash

        def one(text, drop):
            if text is None or drop is None or not len(drop):
                return text
            gone = {int(x) % (1 << 64) for x in drop}
            return "\n".join(line for line in text.split("\n")
                             if xxhash.xxh3_64_intdigest(b" ".join(line.encode().split()).translate(FOLD)) not in gone)

        import pandas as pd

        return pd.Series([one(t, d) for t, d in zip(texts, drops)])

    name = free_name("__content", docs.columns)
    keyed = docs.withColumn(name, content(F.col(text_col).cast("string"))).alias("k")
    joined = keyed.join(mine.alias("l"), F.col(f"k.{host_col}").cast("string").eqNullSafe(F.col("l.host"))
                        & (F.col(f"k.{name}") == F.col("l.content")), "left")
    return joined.select(*(cleaned(F.col(f"k.{c}").cast("string"), F.col("l.__drop")).alias(c) if c == text_col else F.col(f"k.`{c}`")
                           for c in docs.columns))


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **limits) -> DataFrame:
    """The rows of ``docs`` that the rules keep, as they are.

    Rejected ids are taken out by an anti-join on id; among rows of one id
    (null counts as one id) all go if one is rejected.
    """
    return without_ids(docs, id_col, quality_rules(docs, id_col, text_col, host_col, **limits).where("not kept").select(id_col))
