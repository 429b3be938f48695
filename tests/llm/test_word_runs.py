"""Runs against trying every period, and the registered query's digests."""

import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from figpairs.llm import word_runs as R
from figpairs.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(words):
    """Runs of every period, the smallest period of each stretch only."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and words[e] == words[e + q]:
                e += 1
            if e > s and e - s + q >= max(6, 4 * q):
                out.setdefault((s, e + q - s), q)  # a multiple of the period has the same stretch
            s = max(e, s + 1)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def rows_of(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n and doc_id is not None:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs)]
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=4), st.integers(1, 9))
def test_small_alphabets(texts, times):
    texts = [t[:5] * times + t for t in texts]
    assert R.runs_of_texts(texts) == [brute(t) for t in texts]


def test_random_repeats():
    rnd = random.Random(2)
    texts = []
    for _ in range(150):
        t = []
        for _ in range(rnd.randint(1, 6)):
            unit = [rnd.randint(0, rnd.choice([1, 3, 500])) for _ in range(rnd.randint(1, 30))]
            t += (unit * rnd.randint(1, 8))[:rnd.randint(1, 200)]
        texts.append(t)
    got = R.runs_of_texts(texts)
    assert got == [brute(t) for t in texts] and sum(map(len, got)) > 100


def test_long_texts_of_one_word_and_of_nested_periods():
    assert R.runs_of_texts([[7] * 100_000]) == [[(0, 100_000, 1)]]
    inner = [1] * 9 + [2]
    text = inner * 500 + [3] + inner * 500
    runs = R.runs_of_texts([text])[0]
    assert (0, 5000, 10) in runs and (5001, 5000, 10) in runs and sum(q == 1 for _, _, q in runs) == 1000


def test_access_costs_few_changes_of_colour():
    """The prefilter aside: an automaton over plain words, where nothing is periodic."""
    word = np.random.default_rng(1).integers(0, 3, 3000).tolist()
    assert sorted(R.squares(word)) == sorted((s, q) for s, _, q in brute(word))


def test_batches_by_bytes():
    import pyarrow as pa

    from figpairs.llm.common import by_bytes

    texts = ["a" * n for n in (5, 5, 100, 1, 1, 1, 0)] + [None, "b" * 9]
    b = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])
    cut = [x.column(0).to_pylist() for x in by_bytes([b, b.slice(0, 0)], 1, 10)]
    assert cut == [[0, 1], [2], [3, 4, 5, 6, 7], [8]]
    assert [x.num_rows for x in by_bytes([b], 1, 1000, rows=4)] == [4, 4, 1]


def test_operator_and_edges(spark, docs, no_docs):
    got = [tuple(r) for r in R.word_runs(docs, rewrite=R.disturbed).drop("runs").collect()]
    want = [rows_of(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert R.word_runs(no_docs).count() == 0
    assert all(len(r.runs) == r.n_runs for r in R.word_runs(docs).collect())


def test_registered_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((rows_of(r.doc_id, r.text) for r in docs), key=str)
    got = QUERIES["op13_word_runs"](spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
