"""Long matches against a scan of all windows."""

import hashlib
import random

import numpy as np
import pytest

import figpairs.llm.long_matches as lm
from figpairs.llm.long_matches import RunLengthIndex, remove_long_matches
from tests.llm.conftest import documents


def brute(rows, length):
    seen, out = set(), {}
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def check(spark, rows, length=100):
    got = remove_long_matches(documents(spark, [(i, t, "en", "s") for i, t in rows]), length=length).collect()
    want = brute(sorted(rows), length)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id], r.doc_id
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(60)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 50)))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            at = rng.randint(0, len(p) // 2)
            p = p[at:at + rng.randint(80, 400)]
            if rng.random() < 0.4:
                k = rng.randrange(len(p))
                p = p[:k] + "#" + p[k + 1:]
            parts += [p, " ".join(word() for _ in range(rng.randint(0, 10)))]
        rows.append((i, " ".join(parts)))
    rows.append((60, "ab" * 500))
    rows.append((61, "a" * 101))
    rows.append((62, rows[3][1]))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    check(spark, corpus(seed))


def test_hot_hashes_and_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(lm, "HOT_BYTES", 500)
    monkeypatch.setattr(lm, "BLOCK_BYTES", 2000)
    check(spark, corpus(3))


def test_edge_rows(spark, docs, no_docs):
    got = {}
    for r in remove_long_matches(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == docs.count()
    assert got[0][0].n_removed == 0 and got[1][0].n_removed == got[1][0].n_bytes and got[1][0].n_spans == 1
    for i in (3, 4):
        assert (got[i][0].n_bytes, got[i][0].n_removed, got[i][0].kept_sha256) == (0, 0, hashlib.sha256(b"").hexdigest())
    assert len(got[7]) == 2 and got[7][0] == got[7][1] and got[7][0].n_removed == 0
    assert got[9][0].n_bytes - got[9][0].n_removed < 104
    assert got[None][0].n_removed > 0  # repeats itself
    assert remove_long_matches(no_docs).count() == 0


def test_null_ids_stand_last(spark):
    t = " ".join(f"word{k}" for k in range(40))
    got = {r.doc_id: r.n_removed for r in remove_long_matches(documents(spark, [(None, t, "", ""), (3, t, "", "")])).collect()}
    assert got == {3: 0, None: len(t)}


def test_index_against_sorted_suffixes():
    rng = random.Random(5)
    for _ in range(60):
        base = bytes(rng.choice(b"ab") for _ in range(50))
        texts = [base[rng.randint(0, 20):rng.randint(25, 50)] for _ in range(rng.randint(1, 6))]
        ix = RunLengthIndex(texts)
        t = ix.text.tolist()
        order = sorted(range(ix.n), key=lambda i: t[i:])
        assert order == ix.rows.tolist()
        assert len(ix.run_rows) <= ix.n and (np.diff(ix.run_symbols) != 0).all()
        ms = ix.matching_statistics()
        for a, b in zip(order, order[1:]):
            n = 0
            while max(a, b) + n < ix.n and t[a + n] == t[b + n]:
                n += 1
            assert ms[b] == n
