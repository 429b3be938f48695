"""Language-model scoring by cross-entropy difference.

Two matched character n-gram models, one of a target (chosen documents), one of
the background (all documents), share one vocabulary, order and smoothing; the
background's counts are scaled to the target's total, so that neither model is
smoother than the other for its size.  A token is a character of a word or the
word's end; its context is up to ``ORDER - 1`` characters back, not beyond the
word's begin.  An order's estimate is mixed with the next lower one's as
``(n + KAPPA * lower) / (context + KAPPA)``, down to 1 / (characters + 1).

A document's score is the mean over its tokens of the target model's loss less
the background model's: below 0 it is more like the target than the corpus is.

Counting: tasks count words, then the n-grams of distinct words, and Spark sums
them over the corpus.  Documents of the target are told by bitmaps over their
ids' hashes (64 bits, taken as the id where two share a slot), so no text is
shuffled to mark them.  The model grows with the corpus.  Up to ``SHARED_ROWS``
n-grams, measured, it is broadcast; beyond, documents are dealt out to blocks,
each block's own n-grams fetch their counts by a join, and block and counts meet
in one task.  Both ways give equal results.

Defined results:
* null texts and texts without words: 0 tokens, entropies and score null;
* without a target (no such row, or an empty table) the target model is the
  smoothing alone;
* repeated rows get equal scores and each counts; very long texts are read whole;
* other columns of the documents do not take part.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from figpairs.llm.common import Bitmap, WordTable, by_bytes, stored, worker_cache

ORDER = 4
KAPPA = 5.0
SHARED_ROWS = 4_000_000
BLOCK_DOCS = 4096
WORDS_HELD = 400_000
BATCH_BYTES = 2 << 20
LISTED = 1_000_000
MOST_BITS = 28
TOTAL = 0  # the key of the number of tokens
LAST_CHAR = 0x110003  # keys -LAST_CHAR to -1 name characters that occur


def ngrams(words: list[bytes]):
    """Keys per order, and per position its word, its place in the word and its character.

    Keys of order k stand at the n-gram's last character, from place k - 1 on.
    """
    text = [w.decode() for w in words]
    sizes = np.array([len(t) + 2 for t in text], np.int64)
    cp = np.frombuffer(("\0" + "\0\0".join(text) + "\0").encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(3)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    cp[starts], cp[ends - 1] = 1, 2
    word = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(cp)) - starts[word]
    keys = []
    h = np.zeros(len(cp), np.uint64)
    power = 1
    for k in range(1, ORDER + 1):
        h[k - 1:] += cp[:len(cp) - k + 1] * np.uint64(power)
        power = power * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
        x = (h + np.uint64(k)) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        keys.append((x ^ (x >> np.uint64(29))).view(np.int64))
    return keys, word, place, cp


class Marks:
    """Which rows are of the target, told by the hashes of their ids without moving a text.

    Two bitmaps of bounded size: slots of target ids, and slots of other ids of
    the documents.  A slot of the first alone has target ids only.  The target
    ids in slots of both are listed, up to ``LISTED`` of them, counted; beyond
    that there are no marks (None) and texts meet the target in a join.
    """

    def __init__(self, ids: DataFrame, chosen: DataFrame, listed: int):
        hashed = F.xxhash64("id").alias("hash")
        # 64 slots or more for an id, 4 KB to 32 MB in all
        bits = 1 << min(max(15, (64 * chosen.count()).bit_length()), MOST_BITS)
        self.target = Bitmap(chosen.select(hashed), bits)
        self.other = Bitmap(ids.where("id is not null").distinct().join(chosen, "id", "left_anti").select(hashed), bits)
        spark = ids.sparkSession
        shared = spark.sparkContext.broadcast(self.other)

        def met(batches):
            for b in batches:
                yield b.filter(pa.array(shared.value.has(b.column(0).to_numpy())))

        both = chosen.select(hashed).mapInArrow(met, "hash long")
        rows = both.limit(listed + 1).collect()  # at most listed + 1 numbers
        self.complete = len(rows) <= listed
        self.listed = np.sort(np.array([r["hash"] for r in rows], np.int64))

    def wanted(self, hashes: np.ndarray) -> np.ndarray:
        out = self.target.has(hashes)
        unsure = np.flatnonzero(out & self.other.has(hashes))
        out[unsure] = np.isin(hashes[unsure], self.listed)
        return out


def _counts(docs: DataFrame, marks: Marks | None) -> DataFrame:
    """(key, target, every): n-gram counts; ``docs`` has text and hash (of the id, null: none) or, without marks, wanted."""
    shared = docs.sparkSession.sparkContext.broadcast(marks)

    def run(batches):
        import pandas as pd

        worker_cache("lm counts")
        tally: Counter[bytes] = Counter()
        of_target: Counter[bytes] = Counter()

        def flush():
            words = list(tally)
            n = np.array([[of_target.get(w, 0), tally[w]] for w in words], np.int64).reshape(-1, 2)
            tally.clear()
            of_target.clear()
            for at in range(0, len(words), 50_000):
                part = n[at:at + 50_000]
                keys, word, place, cp = ngrams(words[at:at + 50_000])
                found, sums = [], []
                for o, k in enumerate(keys):
                    inside = place >= o
                    which, key = pd.factorize(k[inside])
                    owner = word[inside]
                    found.append(key)
                    sums.append([np.bincount(which, part[owner, c], minlength=len(key)).astype(np.int64) for c in (0, 1)])
                key, sums = np.concatenate(found), [np.concatenate(x) for x in zip(*sums)]
                chars = -np.unique(cp[cp > 2]).astype(np.int64)
                none = np.zeros(len(chars), np.int64)
                tokens = (part * (np.bincount(word, minlength=len(part)) - 1)[:, None]).sum(0)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([key, chars, [TOTAL]])), pa.array(np.concatenate([sums[0], none, tokens[:1]])),
                     pa.array(np.concatenate([sums[1], none, tokens[1:]]))],
                                                 ["key", "target", "every"])

        for b in by_bytes(batches, 0, BATCH_BYTES):
            if marks_given:
                known = b.column(1).is_valid().to_numpy(zero_copy_only=False)
                wanted = known & shared.value.wanted(b.column(1).fill_null(0).to_numpy())
            else:
                wanted = b.column(1).to_numpy(zero_copy_only=False)
            for text, own in zip(b.column(0).to_pylist(), wanted.tolist()):
                words = (text or b"").split()
                tally.update(words)
                if own:
                    of_target.update(words)
            if len(tally) > WORDS_HELD:
                yield from flush()
        if tally:
            yield from flush()

    marks_given = marks is not None
    return docs.select(F.col("text").cast("binary").alias("text"), "hash" if marks_given else "wanted").mapInArrow(run, "key long, target long, every long").groupBy("key").agg(F.sum("target").alias("target"), F.sum("every").alias("every"))


class Model:
    """Counts by sorted keys, and the totals that both models share."""

    def __init__(self, key: np.ndarray, target: np.ndarray, every: np.ndarray, totals: tuple[int, int, int]):
        # the last row stands for n-grams that do not occur
        self.key = key
        self.counts = np.zeros((len(key) + 1, 2))
        self.counts[:-1, 0], self.counts[:-1, 1] = target, every
        self.n_target, self.n_every, self.n_chars = totals
        self.counts[:, 1] *= self.n_target / max(self.n_every, 1)
        self.index = None

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Rows of ``counts``; -1, the last one, for keys that do not occur."""
        if self.index is None:
            import pandas as pd

            self.index = pd.Index(self.key)
        return self.index.get_indexer(keys)

    def word_losses(self, words: list[bytes]) -> np.ndarray:
        """[words, 3]: loss under the target, loss under the background, tokens."""
        out = np.zeros((len(words), 3))
        for at in range(0, len(words), 20_000):
            part = words[at:at + 20_000]
            keys, word, place, _ = ngrams(part)
            rows = [np.where(place >= o, self.places(k), -1) for o, k in enumerate(keys)]
            token = place >= 1
            for model in (0, 1):
                counts = self.counts[:, model]
                p = np.full(len(word), 1.0 / (self.n_chars + 1))
                context = np.full(len(word), float(self.n_target))
                for o in range(ORDER):
                    n = counts[rows[o]]
                    mixed = (n + KAPPA * p) / (context + KAPPA)
                    p = mixed if o < 2 else np.where(place >= o, mixed, p)
                    context[1:] = n[:-1]
                first = np.searchsorted(word, np.arange(len(part)))
                out[at:at + len(part), model] = np.add.reduceat(np.where(token, -np.log(p), 0.0), first)
            out[at:at + len(part), 2] = np.add.reduceat(token.astype(np.int64), first)
        return out

    def score(self, texts: list[str | None], table: WordTable) -> np.ndarray:
        """[texts, 3]: summed losses and tokens."""
        index = table.lookup([(t or "").encode().split() for t in texts])
        return np.array([table.rows[i].sum(0, dtype=np.float64) for i in index]).reshape(-1, 3)


def _arrow_scores(ids, sums: np.ndarray):
    n = sums[:, 2]
    none = n == 0
    each = sums[:, :2] / np.maximum(n, 1)[:, None]
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(n.astype(np.int64)), pa.array(each[:, 0], mask=none), pa.array(each[:, 1], mask=none), pa.array(each[:, 0] - each[:, 1], mask=none)],
        ["id", "n_tokens", "ce_target", "ce_background", "score"])


def lm_scores(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", shared_rows: int = SHARED_ROWS,
              listed: int = LISTED) -> DataFrame:
    """Per row of ``docs``: id, n_tokens, ce_target, ce_background (nats a token) and score.

    ``target`` has ids of the target documents (repeated ids count once).
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = d.schema["id"].dataType.simpleString()
    chosen = target.select(F.col(id_col).alias("id")).where("id is not null").distinct().withColumn("wanted", F.lit(True))
    marks = Marks(d.select("id"), chosen.select("id"), listed)
    if marks.complete:
        marked = d.select("text", F.when(F.col("id").isNotNull(), F.xxhash64("id")).alias("hash"))
    else:
        marked = d.join(chosen, "id", "left").select("text", F.coalesce("wanted", F.lit(False)).alias("wanted"))
    counts = stored(_counts(marked, marks if marks.complete else None), "ngrams")
    total = counts.where(F.col("key") == TOTAL).first()
    chars = counts.where(F.col("key").between(-LAST_CHAR, -1)).count()
    totals = (int(total["target"]) if total else 0, int(total["every"]) if total else 0, int(chars))
    schema = f"id {id_type}, n_tokens long, ce_target double, ce_background double, score double"

    if counts.count() <= shared_rows:
        c = counts.toPandas()  # at most shared_rows rows, counted above
        shared = spark.sparkContext.broadcast(Model(c["key"].to_numpy(), c["target"].to_numpy(), c["every"].to_numpy(), totals))
        tag = f"{spark.sparkContext.applicationId}:{id(shared)}"

        def run(batches):
            model, held = shared.value, worker_cache("lm")
            if held.get("tag") != tag:
                held.clear()
                held.update(tag=tag, words=WordTable(model.word_losses, 3))
            for b in by_bytes(batches, 1, BATCH_BYTES):
                yield _arrow_scores(b.column(0), model.score(b.column(1).to_pylist(), held["words"]))

        return d.mapInArrow(run, schema).withColumnRenamed("id", id_col)

    blocks = max(1, -(-d.count() // BLOCK_DOCS))
    dealt = d.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))

    def own_keys(batches):
        for b in batches:
            if b.num_rows:
                words = sorted(set().union(*((t or "").encode().split() for t in b.column(1).to_pylist())))
                if words:
                    keys, _, place, _ = ngrams(words)
                    key = np.unique(np.concatenate([k[place >= o] for o, k in enumerate(keys)]))
                    yield pa.RecordBatch.from_arrays([pa.array([b.column(0)[0].as_py()] * len(key), pa.int64()), pa.array(key)], ["block", "key"])

    def by_block(batches):
        for b in batches:
            blocks_ = b.column(0).to_numpy()
            for k in np.unique(blocks_):
                yield from own_keys([b.filter(pa.array(blocks_ == k))])

    asked = dealt.select("block", "text").mapInArrow(by_block, "block long, key long").distinct()
    fetched = asked.join(counts, "key")

    def score(texts, own):
        import pandas as pd

        model = Model(own["key"].to_numpy(), own["target"].to_numpy(), own["every"].to_numpy(), totals)
        table = WordTable(model.word_losses, 3)
        sums = np.concatenate([model.score(texts["text"].iloc[at:at + 256].tolist(), table) for at in range(0, len(texts), 256)] or [np.zeros((0, 3))])
        out = _arrow_scores(pa.array(texts["id"]), sums).to_pandas()
        return out if len(out) else pd.DataFrame(columns=["id", "n_tokens", "ce_target", "ce_background", "score"])

    out = dealt.groupBy("block").cogroup(fetched.groupBy("block")).applyInPandas(score, schema)
    return out.withColumnRenamed("id", id_col)


def quality_target(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents labelled as of good quality."""
    return labels.where("quality = 1").select(id_col)
