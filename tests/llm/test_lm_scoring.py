import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from figpairs.llm import lm_scoring
from figpairs.llm.lm_scoring import KAPPA, ORDER, Marks, lm_scores
from tests.llm.conftest import documents

ROWS = [(k, f"good words here number {k} of the good kind", "", "") for k in range(12)] + [(100 + k, f"ZZ!! QQ## {k}", "", "") for k in range(8)]


def brute(rows, wanted):
    counts, total, chars = [Counter(), Counter()], [0, 0], set()
    for i, t in rows:
        for w in (t or "").encode().split():
            w = "\1" + w.decode() + "\2"
            chars |= set(w[1:-1])
            for m in ([0, 1] if i in wanted else [1]):
                total[m] += len(w) - 1
                for k in range(1, ORDER + 1):
                    for p in range(k - 1, len(w)):
                        counts[m][w[p - k + 1:p + 1]] += 1
    out = {}
    for i, t in rows:
        loss, n = [0.0, 0.0], 0
        for w in (t or "").encode().split():
            w = "\1" + w.decode() + "\2"
            for p in range(1, len(w)):
                n += 1
                for m in (0, 1):
                    scale = 1 if m == 0 else total[0] / max(total[1], 1)
                    x = 1 / (len(chars) + 1)
                    for k in range(1, min(ORDER, p + 1) + 1):
                        context = total[0] if k == 1 else counts[m][w[p - k + 1:p]] * scale
                        x = (counts[m][w[p - k + 1:p + 1]] * scale + KAPPA * x) / (context + KAPPA)
                    loss[m] -= math.log(x)
        out[i] = (n, loss[0] / n, loss[1] / n) if n else (0, None, None)
    return out


@pytest.mark.parametrize("shared_rows,listed,bits", [(4_000_000, 1000, 28), (1, 1000, 28), (4_000_000, 1000, 15), (4_000_000, 0, 15)])
def test_all_ways_match_brute_force(spark, monkeypatch, shared_rows, listed, bits):
    """Broadcast and blocks; target documents told by roomy bitmaps, by crowded ones with a list, and by the join."""
    monkeypatch.setattr(lm_scoring, "MOST_BITS", bits)
    df, wanted = documents(spark, ROWS), set(range(12))
    target = spark.createDataFrame([(i,) for i in [*wanted, 3, None, 555]], "doc_id long")
    want = brute([r[:2] for r in ROWS], wanted)
    got = lm_scores(df, target, shared_rows=shared_rows, listed=listed).collect()
    assert len(got) == len(ROWS)
    for r in got:
        n, t, b = want[r.doc_id]
        assert r.n_tokens == n and math.isclose(r.ce_target, t, rel_tol=1e-5) and math.isclose(r.ce_background, b, rel_tol=1e-5)
        assert math.isclose(r.score, r.ce_target - r.ce_background, abs_tol=1e-12)
    assert max(r.score for r in got if r.doc_id < 100) < min(r.score for r in got if r.doc_id >= 100)


def test_marks_are_exact_where_slots_are_shared(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "MOST_BITS", 15)
    n = 60_000
    ids = spark.range(n)
    marks = Marks(ids, ids.where("id % 3 = 0"), 1_000_000)
    assert marks.complete and len(marks.listed) > n // 6
    rows = ids.select("id", F.xxhash64("id").alias("h")).collect()
    got = marks.wanted(np.array([r.h for r in rows], np.int64))
    assert got.tolist() == [r.id % 3 == 0 for r in rows]
    assert not Marks(ids, ids.where("id % 3 = 0"), 100).complete


def test_edge_rows(spark, docs, no_docs):
    target = spark.createDataFrame([(0,)], "doc_id long")
    for rows in (4_000_000, 1):
        got = lm_scores(docs, target, shared_rows=rows).collect()
        assert len(got) == docs.count()
        assert all((r.n_tokens, r.score) == (0, None) for r in got if r.doc_id in (3, 4, 5))
        a, b = [r for r in got if r.doc_id == 7]
        assert a == b and a.n_tokens == sum(len(f"w{k}") + 1 for k in range(30_000))
    assert lm_scores(no_docs, target).count() == 0
    none = lm_scores(docs, target.limit(0)).collect()
    assert all(r.score is None or math.isfinite(r.score) for r in none)
