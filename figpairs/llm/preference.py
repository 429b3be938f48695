"""Quality by Bradley-Terry ranking: a score learnt from preference pairs, cut at a quantile.

1. A text becomes numbers: how often words of each shape occur (capitals, small
   letters, digits and marks, each run of one kind counted as one), hashed to
   ``SHAPES`` slots, and a few counts of words, lines and repeats.
2. A pair (better, worse) takes a row labelled 1 and one labelled 0.  The
   better one wins with probability 1 / (1 + exp(s(worse) - s(better))), s linear in
   the features, so the logistic loss is over differences of features.  It is
   minimised by Newton's steps with a small ridge.
3. The cut is the quantile of s, over the labelled rows, at the share of rows
   labelled 0, half-way to the next score.  A text at the cut scores ``AT_CUT``.

All labelled rows take part.  They are dealt by a hash of their ids into buckets
of about ``BUCKET`` rows; in a bucket every row meets ``ROUNDS`` rows of the other
label, the fewer ones again and again.  (All pairs would grow with the square of
the labels.)  A step's sums, the rows' moments and the quantile's counts are Spark
jobs over the buckets; the driver gets results of fixed size.

Defined results:
* null and empty texts have all features 0 and a score like any other text;
* rows of one id: each is scored; in training the least feature row counts;
* null labels and ids labelled both 0 and 1 are not learnt from;
* without a row of either label there is no preference: every text scores 0.5;
* texts are read whole; an empty table gives an empty result; other columns
  do not take part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from figpairs.llm.common import Bitmap, by_bytes, stored, worker_cache

SHAPES = 256
FEATURES = SHAPES + 6
PAIRS = 40_000
BUCKET = 500
LEAST_SIDE = 20  # rows of the rarer label a bucket should have
ROUNDS = 4
MARK_BITS = 1 << 26
BINS, AT_ONCE = 1024, 4096  # of the quantile's search
RIDGE = 0.01
AT_CUT = 0.3
BATCH_BYTES = 4 << 20

_KINDS = bytes(0x41 if 0x41 <= c <= 0x5A else 0x61 if 0x61 <= c <= 0x7A or c >= 0x80 else 0x30 if 0x30 <= c <= 0x39 else c for c in range(256))
_AGAIN = re.compile(rb"(.)\1+", re.DOTALL)


def slot(shape: bytes) -> int:
    return zlib.crc32(_AGAIN.sub(rb"\1+", shape)) % SHAPES


def text_features(text: bytes, slots: dict[bytes, int]) -> np.ndarray:
    out = np.zeros(FEATURES, np.float32)
    words = text.split()
    n = len(words)
    if not n:
        return out
    for shape, times in Counter(text.translate(_KINDS).split()).items():
        at = slots.get(shape)
        if at is None:
            if len(slots) > 200_000:
                slots.clear()
            at = slots[shape] = slot(shape)
        out[at] += times
    out[:SHAPES] = np.sqrt(out[:SHAPES] / n)
    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    out[SHAPES:] = (np.log1p(n), len(counts) / n, len(text) / n / 10, max(counts.values()) / n, 1 - len(set(lines)) / len(lines), np.log1p(n / len(lines)))
    return out


def pair_sums(diff: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slope and second derivatives of the loss over rows of differences."""
    lose = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))
    return -diff.T @ lose, (diff * (lose * (1 - lose))[:, None]).T @ diff


def newton(sums, pairs: int) -> np.ndarray:
    """The weights of least loss; ``sums(w)`` adds up :func:`pair_sums` over all pairs."""
    w, ridge = np.zeros(FEATURES), RIDGE * pairs / 1000
    for _ in range(30):
        slope, bend = sums(w)
        bend[np.diag_indices(FEATURES)] += ridge
        step = np.linalg.solve(bend, slope + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(better: np.ndarray, worse: np.ndarray, share: float, pairs: int = PAIRS) -> dict | None:
    """The model from feature rows held in memory and ``pairs`` drawn ones; ``share`` is that of the worse rows among all."""
    if not len(better) or not len(worse):
        return None
    rows = np.concatenate([better, worse]).astype(np.float64)
    mean, scale = rows.mean(0), rows.std(0) + 1e-3
    z = (rows - mean) / scale
    rng = np.random.default_rng(12)
    diff = z[rng.integers(0, len(better), pairs)] - z[len(better) + rng.integers(0, len(worse), pairs)]
    w = newton(lambda w: pair_sums(diff, w), pairs)
    s = z @ w
    weight = np.concatenate([np.full(len(better), (1 - share) / len(better)), np.full(len(worse), share / len(worse))])
    by = np.argsort(s, kind="stable")
    k = int(np.searchsorted(np.cumsum(weight[by]), share - 1e-9))
    cut = (s[by[k]] + s[by[min(k + 1, len(s) - 1)]]) / 2
    return {"mean": mean, "scale": scale, "w": w, "cut": float(cut), "spread": float(max(np.abs(s - cut).mean() / 4, 1e-6))}


def linear(model: dict, rows: np.ndarray) -> np.ndarray:
    """s of each row, summed alike wherever the row stands in its batch."""
    return ((rows - model["mean"]) / model["scale"] * model["w"]).sum(1)


def scores(model: dict, rows: np.ndarray) -> np.ndarray:
    s = linear(model, rows)
    x = np.log(AT_CUT / (1 - AT_CUT)) + (s - model["cut"]) / model["spread"]
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def features(docs: DataFrame) -> DataFrame:
    """(id, features) of rows (id, text as bytes)."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        slots = worker_cache("preference")
        for b in by_bytes(batches, 1, BATCH_BYTES):
            rows = np.stack([text_features(t or b"", slots) for t in b.column(1).to_pylist()])
            ends = pa.array(np.arange(0, rows.size + 1, FEATURES), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(ends, pa.array(rows.ravel()))], ["id", "features"])

    return docs.mapInArrow(run, f"id {id_type}, features array<float>")


def _differences(better: np.ndarray, worse: np.ndarray):
    """A bucket's pairs, round by round: every row of both sides is in each round."""
    if len(better) and len(worse):
        at = np.arange(max(len(better), len(worse)))
        for r in range(ROUNDS):
            yield better[at % len(better)] - worse[(at + r * max(1, len(worse) // ROUNDS)) % len(worse)]


def _sides(batches):
    for b in batches:
        for better, worse in zip(b.column("better").to_pylist(), b.column("worse").to_pylist()):
            yield tuple(np.frombuffer(x, np.float32).reshape(-1, FEATURES).astype(np.float64) for x in (better, worse))


def _summed(buckets: DataFrame, of, rows: int) -> np.ndarray:
    """[rows, FEATURES]: ``of(better, worse)`` added up over all buckets, first in their tasks, then by chunks of rows."""
    step = 32

    def run(batches):
        from pyspark import TaskContext

        total = np.zeros((rows, FEATURES))
        for sides in _sides(batches):
            total += of(*sides)
        starts = range(0, rows, step)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()] * len(starts), pa.int32()), pa.array(starts, pa.int32()),
                                          pa.array([total[k:k + step].tobytes() for k in starts], pa.binary())], ["task", "start", "part"])

    def add(pdf):  # in the order of tasks: equal inputs, equal sums
        total = sum(np.frombuffer(x, np.float64) for x in pdf.sort_values("task")["part"])
        return pdf.head(1).assign(part=[total.tobytes()])

    kind = "task int, start int, part binary"
    out = np.zeros((rows, FEATURES))
    for r in buckets.mapInArrow(run, kind).groupBy("start").applyInPandas(add, kind).collect():  # rows x FEATURES numbers
        out[r["start"]:r["start"] + step] = np.frombuffer(r["part"], np.float64).reshape(-1, FEATURES)
    return out


def _cut(scored: DataFrame, weights: dict[int, float], share: float) -> float:
    """Half-way between the score at which the weight of all rows up to it reaches ``share`` and the next one."""
    weigh = F.when(F.col("y") == 1, weights[1]).otherwise(weights[0])
    low, high, n = scored.agg(F.min("s"), F.max("s"), F.count("*")).first()
    below, weight = 0.0, 1.0
    while n > AT_ONCE and low < high:
        bins = (scored.where(F.col("s").between(low, high)).groupBy(F.floor((F.col("s") - low) / (high - low) * BINS).alias("bin"))
                .agg(F.min("s").alias("low"), F.max("s").alias("high"), F.count("*").alias("n"), F.sum(weigh).alias("weight")).orderBy("bin").collect())  # BINS + 1 rows at most
        for k, r in enumerate(bins):
            if below + r["weight"] >= share - 1e-9 or k + 1 == len(bins):
                low, high, n, weight = r["low"], r["high"], r["n"], r["weight"]
                break
            below += r["weight"]
    next_up = scored.where(F.col("s") > high).agg(F.min("s")).first()[0]
    if low == high and n > AT_ONCE:  # rows of one score; the last of them or an earlier one
        last = next_up is not None and below + weight - min(weights.values()) < share - 1e-9
        return float((low + next_up) / 2 if last else low)
    here = sorted((r["s"], weights[r["y"]]) for r in scored.where(F.col("s").between(low, high)).collect())
    k = min(int(np.searchsorted(below + np.cumsum([h[1] for h in here]), share - 1e-9)), len(here) - 1)
    after = here[k + 1][0] if k + 1 < len(here) else here[k][0] if next_up is None else next_up
    return float((here[k][0] + after) / 2)


def learn(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> dict | None:
    """Fit on all labelled rows for which ``train``, a condition on the id, holds."""
    y = F.col(label_col).cast("int")
    known = stored(labels.where(train & F.col(id_col).isNotNull() & y.isin(0, 1)).groupBy(F.col(id_col).alias("id"))
                   .agg(F.min(y).alias("least"), F.max(y).alias("y")).where("least = y").select("id", "y"), "preference-labels")
    total = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(total) < 2:
        return None
    # texts are read where they lie: only rows that may be labelled (never too few) become features, and only features are shuffled
    marks = docs.sparkSession.sparkContext.broadcast(Bitmap(known.select(F.xxhash64("id")), MARK_BITS))

    def labelled(batches):
        for b in batches:
            yield b.filter(pa.array(marks.value.has(b.column("mark").to_numpy()))).select(["id", "text"])

    texts = docs.where(train & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    texts = texts.withColumn("mark", F.xxhash64(F.col("id").cast(known.schema["id"].dataType)))
    chosen = texts.mapInArrow(labelled, texts.drop("mark").schema)
    found = features(chosen).groupBy("id").agg(F.min("features").alias("features")).join(known, "id")
    n = max(1, min(sum(total.values()) // BUCKET, min(total.values()) // LEAST_SIDE))

    def pack(pdf):
        pdf = pdf.sort_values("place")
        sides = [np.array(pdf["features"][pdf["y"] == side].tolist(), np.float32).tobytes() for side in (1, 0)]
        return pdf[["bucket"]].head(1).assign(better=[sides[0]], worse=[sides[1]])

    dealt = found.select(F.pmod(F.xxhash64("id"), F.lit(n)).alias("bucket"), F.md5(F.col("id").cast("string").cast("binary")).alias("place"), "y", "features")
    buckets = stored(dealt.groupBy("bucket").applyInPandas(pack, "bucket long, better binary, worse binary"), "preference-buckets")
    marks.destroy()
    row = 4 * FEATURES
    n_better, n_worse, n_pairs = buckets.agg(F.sum(F.octet_length("better")) / row, F.sum(F.octet_length("worse")) / row, F.sum(F.when(
        (F.octet_length("better") > 0) & (F.octet_length("worse") > 0), F.greatest(F.octet_length("better"), F.octet_length("worse")))) / row * ROUNDS).first()
    if not n_better or not n_worse:
        return None
    sums = _summed(buckets, lambda b, w: np.array([b.sum(0) + w.sum(0), (b * b).sum(0) + (w * w).sum(0)]), 2) / (n_better + n_worse)
    mean = sums[0]
    scale = np.sqrt(np.maximum(sums[1] - mean * mean, 0)) + 1e-3

    def derivatives(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def of(better, worse):
            out = np.zeros((FEATURES + 1, FEATURES))
            for diff in _differences(better / scale, worse / scale):
                slope, bend = pair_sums(diff, w)
                out[0] += slope
                out[1:] += bend
            return out

        got = _summed(buckets, of, FEATURES + 1)
        return got[0], got[1:]

    model = {"mean": mean, "scale": scale, "w": newton(derivatives, int(n_pairs or 0) or 1)}

    def score(batches):
        for sides in _sides(batches):
            for side, rows in zip((1, 0), sides):
                yield pa.RecordBatch.from_arrays([pa.array(linear(model, rows)), pa.array([side] * len(rows), pa.int32())], ["s", "y"])

    scored = stored(buckets.mapInArrow(score, "s double, y int"), "preference-scores")
    share = total[0] / sum(total.values())
    cut = _cut(scored, {1: (1 - share) / n_better, 0: share / n_worse}, share)
    spread = scored.agg(F.avg(F.abs(F.col("s") - cut))).first()[0] / 4
    return model | {"cut": cut, "spread": float(max(spread, 1e-6))}


def preference_scores(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and score (0 to 1; ``AT_CUT`` at the cut)."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    if model is None:
        return d.select(F.col("id").alias(id_col), F.lit(0.5).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = d.schema["id"].dataType.simpleString()

    def run(batches):
        slots = worker_cache("preference")
        for b in by_bytes(batches, 1, BATCH_BYTES):
            rows = np.stack([text_features(t or b"", slots) for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores(shared.value, rows))], ["id", "score"])

    return d.mapInArrow(run, f"id {id_type}, score double").withColumnRenamed("id", id_col)
