"""Bradley-Terry: the fit against plain gradient steps, held-out accuracy, edges."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from figpairs.llm import preference as B
from figpairs.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_loss_is_at_its_least():
    rng = np.random.default_rng(4)
    better, worse = rng.normal(0.3, 1, (60, B.FEATURES)), rng.normal(-0.3, 1, (40, B.FEATURES))
    m = B.fit(better, worse, 0.4, pairs=500)
    z = (np.concatenate([better, worse]) - m["mean"]) / m["scale"]
    draw = np.random.default_rng(12)
    diff = z[draw.integers(0, 60, 500)] - z[60 + draw.integers(0, 40, 500)]
    ridge = B.RIDGE * 500 / 1000

    def loss(w):
        return np.log1p(np.exp(-diff @ w)).sum() + ridge / 2 * w @ w

    base = loss(m["w"])
    for _ in range(50):
        assert loss(m["w"] + rng.normal(0, 1e-2, B.FEATURES)) >= base


def test_cut_is_the_quantile_of_the_share():
    rng = np.random.default_rng(4)
    better, worse = rng.normal(1, 1, (300, B.FEATURES)), rng.normal(-1, 1, (100, B.FEATURES))
    m = B.fit(better, worse, 0.25)
    s = B.scores(m, np.concatenate([better, worse]))
    assert (s < B.AT_CUT).sum() == 100 and (s[:300] >= B.AT_CUT).all()
    # a share that the sample does not have: the cut follows the share
    m = B.fit(better, worse, 0.5)
    low = (B.scores(m, better) < B.AT_CUT).mean() * 0.5 + (B.scores(m, worse) < B.AT_CUT).mean() * 0.5
    assert abs(low - 0.5) < 0.01


def test_shapes():
    slots: dict = {}
    a, b = B.text_features("Alpha beta 12, CAPS!!".encode(), slots), B.text_features("Bravoes charli 987, WORDS!!!".encode(), slots)
    assert np.array_equal(a[:B.SHAPES], b[:B.SHAPES])
    assert not B.text_features(b" \n ", slots).any() and B.text_features(b"x " * 400_000, slots)[B.SHAPES + 3] == 1


def test_held_out_accuracy(spark):
    got = QUERIES["op12_preference_quality"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(got) > 700
    right = np.mean([r.predicted == r.quality for r in got])
    good = np.array([r.score for r in got if r.quality == 1])
    bad = np.array([r.score for r in got if r.quality == 0])
    assert right >= 0.98 and (good[:, None] > bad[None, :]).mean() >= 0.995


def test_registered_query_covers_every_row(spark):
    got = QUERIES["op12_preference_quality"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 200 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_held_out_labels_and_other_columns_take_no_part(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    a = B.learn(docs, labels, ~held)
    b = B.learn(docs.withColumn("lang", F.lit("xx")).withColumn("y", F.lit(1)),
                labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))).withColumn("toxic", F.lit(0)), ~held)
    assert np.array_equal(a["w"], b["w"]) and a["cut"] == b["cut"]


def test_edges(spark, docs, no_docs):
    every = F.lit(True)
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert B.learn(docs, empty, every) is None
    assert {r.score for r in B.preference_scores(docs, None).collect()} == {0.5}
    labels = spark.createDataFrame([(0, 1), (0, 1), (9, 0), (7, 0), (6, 1), (6, 0), (3, None), (None, 1), (99, 1)], "doc_id long, quality int")
    model = B.learn(docs, labels, every)
    got = B.preference_scores(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (3, 4, 5)}) == 1
    assert B.preference_scores(no_docs, model).count() == 0 and B.learn(no_docs, labels, every) is None


def _texts(spark, n, bad):
    """Documents of plain words, every ``bad``-th in capitals and marks (label 0); a tenth of either are of an odd kind."""
    def text(k):
        words = [f"{'abcdefgh'[(k + j) % 8] * (1 + j % 5)}{j % 7 if k % 10 == 3 else ''}" for j in range(30)]
        return " ".join(w.upper() + "!" for w in words) if k % bad == 0 else " ".join(words)

    docs = spark.createDataFrame([(k, text(k)) for k in range(n)], "doc_id long, text string")
    return docs, spark.createDataFrame([(k, int(k % bad != 0)) for k in range(n)], "doc_id long, quality int")


def test_every_labelled_row_is_learnt_from(spark, monkeypatch):
    """Moments, loss and cut of many buckets are those of all rows and pairs put together."""
    monkeypatch.setattr(B, "BUCKET", 40)
    monkeypatch.setattr(B, "LEAST_SIDE", 4)
    monkeypatch.setattr(B, "AT_ONCE", 16)
    docs, labels = _texts(spark, 600, 5)
    seen, sums = [], B._summed
    monkeypatch.setattr(B, "_summed", lambda buckets, of, rows: (seen.append(buckets), sums(buckets, of, rows))[1])
    m = B.learn(docs, labels, F.col("doc_id") % 7 != 0)
    packed = [tuple(np.frombuffer(x, np.float32).reshape(-1, B.FEATURES).astype(float) for x in (r.better, r.worse)) for r in seen[0].collect()]
    assert len(packed) > 5
    slots: dict = {}
    of = {r.doc_id: B.text_features(r.text.encode(), slots) for r in docs.collect() if r.doc_id % 7}
    better, worse = (np.array([f for k, f in of.items() if (k % 5 != 0) == good], float) for good in (True, False))
    assert sorted(map(tuple, np.concatenate([p[0] for p in packed]))) == sorted(map(tuple, better))
    assert sorted(map(tuple, np.concatenate([p[1] for p in packed]))) == sorted(map(tuple, worse))
    rows = np.concatenate([better, worse])
    assert np.allclose(m["mean"], rows.mean(0)) and np.allclose(m["scale"], rows.std(0) + 1e-3)
    diff = np.concatenate([d for b, w in packed for d in B._differences(b / m["scale"], w / m["scale"])])
    ridge = B.RIDGE * len(diff) / 1000
    slope, _ = B.pair_sums(diff, m["w"])
    assert np.abs(slope + ridge * m["w"]).max() < 1e-4 * len(diff)
    s = np.sort(((rows - m["mean"]) / m["scale"]) @ m["w"])
    share = len(worse) / len(rows)
    k = round(share * len(rows))
    assert np.isclose(m["cut"], (s[k - 1] + s[k]) / 2)


def test_each_round_of_pairs_has_every_row():
    better, worse = np.arange(7.0)[:, None] * 100, np.arange(3.0)[:, None]
    for diff in B._differences(better, worse):
        assert {round(x) // 100 + (round(x) % 100 > 0) for x in diff.ravel()} == set(range(7)) and {round(-x) % 100 for x in diff.ravel()} == {0, 1, 2}
    assert not list(B._differences(better, worse[:0]))
