import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from figpairs.llm.common import crc_mod
from figpairs.llm.language_id import language_spans, learn, viterbi
from tests.llm.conftest import documents

PARTS = {"aa": ["the", "ing", "on", "er"], "bb": ["eau", "oi", "que", "ré"], "cc": ["ци", "ст", "ов", "на"]}


def corpus(n=300, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(PARTS))
        rows.append((i, " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, 60))), lang, "s"))
    return rows


def test_held_out_accuracy_and_mixed_spans(spark):
    rows = corpus()
    mixed = " ".join(["theing"] * 20 + ["queeau"] * 30 + ["12", "--"] + ["цист"] * 10)
    df = documents(spark, [*rows, (9000, mixed, None, "s")])
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    got = {r.doc_id: r for r in language_spans(df, learn(df, ~held_out)).collect()}
    test = [got[i].lang_pred == lang for i, _, lang, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(test) > 40 and sum(test) / len(test) > 0.98
    assert [(s["first"], s["words"], s["lang"]) for s in got[9000].spans] == [(0, 20, "aa"), (20, 32, "bb"), (52, 10, "cc")]
    assert got[9000].lang_pred == "bb" and abs(got[9000].score - 180 / (120 + 180 + 40)) < 1e-6


def brute_viterbi(scores, penalty):
    best = None
    n, k = scores.shape
    from itertools import product

    for path in product(range(k), repeat=n):
        v = sum(scores[t, s] for t, s in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))
        best = max(best or (v, path), (v, path))
    return best[0]


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 0, 6, 1, 5])
    scores = rng.normal(size=(lengths.sum(), 3)).astype(np.float32) * 2
    label = viterbi(scores, lengths, 1.5)
    at = 0
    for n in lengths:
        own, path = scores[at:at + n], label[at:at + n]
        at += n
        if n:
            value = own[np.arange(n), path].sum() - 1.5 * (path[1:] != path[:-1]).sum()
            assert abs(value - brute_viterbi(own, 1.5)) < 1e-4


def test_more_languages_than_a_byte_holds():
    rng = np.random.default_rng(0)
    for n in (127, 128, 129, 300, 40_000):
        scores = rng.normal(size=(6, n)).astype(np.float32)
        scores[:, n - 1] += 50
        assert viterbi(scores, np.array([4, 2]), 3.0).tolist() == [n - 1] * 6


def test_held_out_rows_are_not_learned_from(spark):
    rows = corpus(80)
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    changed = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, s) for i, t, lang, s in rows]
    a, b = (learn(documents(spark, r), ~held_out) for r in (rows, changed))
    assert a["langs"] == b["langs"] and np.array_equal(a["logp"], b["logp"])


def test_edge_rows(docs, no_docs):
    model = learn(docs, F.lit(True))
    assert model["langs"] == ["de", "en"]
    got = language_spans(docs, model).collect()
    assert len(got) == docs.count()
    assert all((r.lang_pred, r.score, r.spans) == ("und", 0.0, []) for r in got if r.doc_id in (3, 4, 5))
    assert all(r.lang_pred in ("de", "en") and 0 < r.score <= 1 for r in got if r.doc_id not in (3, 4, 5))
    assert len([r for r in got if r.doc_id == 7]) == 2
    empty = learn(no_docs, F.lit(True))
    assert {r.lang_pred for r in language_spans(docs, empty).collect()} == {"und"}
    assert language_spans(no_docs, model).count() == 0


def test_results_do_not_depend_on_the_sessions_batches(spark):
    df = documents(spark, corpus(200, seed=5)).coalesce(1)
    model = learn(df, F.lit(True))
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, got = spark.conf.get(key, None), []
    try:
        for n in ("1", "64", "10000"):
            spark.conf.set(key, n)
            got.append(sorted(map(tuple, language_spans(df, model).collect())))
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    assert got[0] == got[1] == got[2] and len(got[0]) == 200
