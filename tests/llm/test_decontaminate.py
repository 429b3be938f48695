import random

import numpy as np

import figpairs.llm.decontaminate as dc
from figpairs.llm.decontaminate import BLOCK, Item, find_leaks, lcs, without_leaks
from tests.llm.conftest import documents


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for k, y in enumerate(b):
            new.append(row[k] + 1 if x == y else max(row[k + 1], new[-1]))
        row = new
    return row[-1]


def test_bit_parallel_lcs():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(1, 30))] for _ in range(2))
        assert lcs(Item._masks(a), b, len(a)) == brute_lcs(a, b)


def corpus(n=150, n_items=12, seed=6):
    rng = random.Random(seed)
    common = ["the", "of", "and", "to"]
    word = lambda: rng.choice(common) if rng.random() < 0.3 else "".join(rng.choice(["st", "on", "er", "in", "ou", "re"]) for _ in range(rng.randint(2, 5)))
    items = [(k, " ".join(word() for _ in range(rng.randint(15, 60))) + ".") for k in range(n_items)]
    rows, planted = [], set()
    for i in range(n):
        w = [word() for _ in range(rng.randint(10, 400))]
        if i % 5 == 0:
            k = i // 5 % n_items
            leak = items[k][1].split()
            if i % 10 == 0:  # reworded: every tenth word replaced
                leak = [x if j % 10 else word() for j, x in enumerate(leak, 1)]
            at = rng.randint(0, len(w))
            w[at:at] = leak
            planted.add((i, k))
        rows.append((i, " ".join(w), "en", "s"))
    return rows, items, planted


def test_verbatim_and_reworded_items_are_found(spark):
    rows, items, planted = corpus()
    df = documents(spark, rows)
    bench = spark.createDataFrame([(k, t, "?") for k, t in items], "item_id long, text string, id string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(df, bench).collect()}
    assert got == planted
    kept = {r.doc_id for r in without_leaks(df, bench).collect()}
    assert kept == {i for i, *_ in rows} - {i for i, _ in planted}


def test_items_in_blocks_give_the_same(spark, monkeypatch):
    import figpairs.llm.decontaminate as dc

    monkeypatch.setattr(dc, "ITEMS_AT_ONCE", 5)
    rows, items, planted = corpus(60)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in find_leaks(documents(spark, rows), bench).collect()} == planted


def test_words_far_apart_are_no_leak(spark):
    item = " ".join(f"key{k}" for k in range(40))
    spread = " ".join(f"key{k} " + " ".join(f"fill{k}x{j}" for j in range(40)) for k in range(40))
    backwards = " ".join(reversed(item.split()))
    df = documents(spark, [(1, spread, "", ""), (2, backwards, "", ""), (3, item, "", "")] + [(10 + k, f"other text {k} " * 20, "", "") for k in range(30)])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [r.doc_id for r in find_leaks(df, bench).collect()] == [3]


def test_edge_rows(spark, docs, no_docs):
    bench = spark.createDataFrame([(1, "w29990 w29991 w29992 w29993 w29994 w29995"), (2, None), (3, ""), (4, "***"), (1, "w5 w6 w7 w8 w9"), (None, "tok3 tok4 tok5 tok6 tok7")],
                                  "item_id long, text string")
    got = sorted((r.doc_id, r.item_id if r.item_id is not None else -1) for r in find_leaks(docs, bench).collect())
    assert set(got) == {(7, 1), (0, -1), (1, -1), (2, -1)}
    assert find_leaks(no_docs, bench).count() == 0
    assert find_leaks(docs, bench.limit(0)).count() == 0
    out = without_leaks(docs, bench)
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == {3, 4, 5, 6, 9, 10, None}
    assert BLOCK * 2 >= 30 and np.isfinite(find_leaks(docs, bench).agg({"cosine": "max"}).first()[0])


def test_short_items_of_ordinary_words_are_found(spark):
    """Recall of at least 0.9 for items of 5 to 14 words of 400, in passages of heavier words."""
    rng = random.Random(2)
    items = [(k, " ".join(f"w{rng.randrange(500)}" for _ in range((5, 7, 10, 14)[k % 4]))) for k in range(400)]
    rows = []
    for i in range(240):
        topic = rng.randrange(60)
        w = [f"topic{topic}x{rng.randrange(30)}" if rng.random() < 2 / 3 else f"w{rng.randrange(500)}" for _ in range(200)]
        if i < 120:
            at = rng.randint(50, 150)
            w[at:at] = items[i][1].split()
        rows.append((i, " ".join(w), "en", "s"))
    found = {(r.doc_id, r.item_id) for r in find_leaks(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    recall = [sum((k, k) in found for k in range(length, 120, 4)) / 30 for length in range(4)]
    assert min(recall) >= 0.9, recall


def test_bits_leave_out_only_what_the_checks_refuse():
    rng = np.random.default_rng(5)
    for _ in range(300):
        key = rng.integers(0, 3000, rng.integers(1, 300))
        block = np.arange(len(key)) // BLOCK
        n = block[-1] + 1
        it = Item("x", np.zeros(dc.SLOTS, bool))
        own = rng.choice(key, rng.integers(1, 40)).tolist()
        it.n, it.masks = len(own), Item._masks(own)
        bits, need = it.bits(0.6)
        r = int(rng.integers(0, 5))
        wide = dc.widened(dc.bitmaps(block, key, n), [r])[r]
        for k in range(n):
            near = key[max(0, k - r) * BLOCK:(k + 2 + r) * BLOCK].tolist()
            shared = int(np.bitwise_count(wide[k] & bits).sum())
            assert shared == len({x % dc.BITS for x in near} & {x % dc.BITS for x in own})
            assert shared >= need or sum(x in near for x in own) < 0.6 * len(own)


def test_long_items_are_found(spark):
    """Items of many passages, each of which shares a part of their direction only."""
    rng = random.Random(3)
    topical = lambda n: [f"topic{t}x{rng.randrange(30)}" for t in [rng.randrange(300)] for _ in range(n)]
    items = [(k, " ".join(w for _ in range(10) for w in topical(30))) for k in range(40)]
    rows = []
    for i in range(200):
        w = topical(150)
        if i < 40:
            at = rng.randint(20, 120)
            w[at:at] = items[i][1].split()
        rows.append((i, " ".join(w), "en", "s"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in find_leaks(documents(spark, rows), bench).collect()}
    assert got == {(k, k) for k in range(40)}


def test_passages_of_an_item_hold_all_its_words():
    for n in (1, 24, 47, 48, 49, 72, 73, 96, 300):
        parts = dc.passages_of(list(range(n)))
        assert {x for p in parts for x in p} == set(range(n)) and max(map(len, parts)) == min(n, 2 * BLOCK)
        assert len(parts) <= 1 + n // BLOCK


def test_words_hashed_where_they_lie(monkeypatch):
    """Equal plain words, and only they, have equal hashes; places, blocks and documents are those of a loop over words."""
    rng = random.Random(8)
    pool = ["Alpha", "alpha,", "«alpha»", "ALPHA.", "be-ta", "beta", "x", "y1", "1y", "***", "—", "Grüße", "grüße!", "İx", "日本", "日 本", "a\x1cb", "ab", "\x00", "\u00a0", "w" * 300]
    texts = ["", " \n", "***", *(rng.choice([" ", "\n", "\t\x0b"]).join(rng.choice(pool) for _ in range(rng.randint(1, 120))) for _ in range(60))]
    names: dict = {}
    for limit, odd in ((dc.BATCH_BYTES, dc.ODD_WORDS), (40, 3)):
        monkeypatch.setattr(dc, "BATCH_BYTES", limit)
        monkeypatch.setattr(dc, "ODD_WORDS", odd)
        words = [[p for w in t.encode().split() if (p := dc.plain(w))] for t in texts]
        slot, key, block, doc, first = dc._blocks([t.encode() for t in texts])
        assert np.diff(first).tolist() == [len(w) for w in words]
        for w, s, k in zip([w for ws in words for w in ws], slot.tolist(), key.tolist()):
            assert names.setdefault(w, (s, k)) == (s, k)
        want = [(d, k // BLOCK) for d, ws in enumerate(words) for k in range(len(ws))]
        places = sorted(set(want))
        assert block.tolist() == [places.index(x) for x in want] and doc.tolist() == [d for d, _ in places]
    assert len(set(names.values())) == len(names) and {"alpha", "beta", "ab", "grüße"} <= set(names)
    assert Item("x", np.zeros(dc.SLOTS, bool)).slots == [names["x"][0]]


def test_every_document_takes_part_in_the_fit(spark, monkeypatch):
    seen, latent = [], dc._latent

    def fitted(fit, *args):
        seen.append(fit.where("weight = 1").count())
        return latent(fit, *args)

    monkeypatch.setattr(dc, "_latent", fitted)
    rows = [(k, " ".join(f"t{k % 50}x{j}" for j in range(12)), "en", "s") for k in range(2300)]
    find_leaks(documents(spark, rows), spark.createDataFrame([(1, "t3x0 t3x1 t3x2 t3x3 t3x4")], "item_id long, text string"))
    assert seen == [2300]


def test_the_space_is_that_of_all_passages(spark):
    """The basis spans what three rounds with the whole matrix, made row by row, give."""
    rng = random.Random(4)
    texts = [" ".join(f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(rng.choice([0, 1, 7, 24, 25, 48, 60, 200]))) for _ in range(90)]
    d = dc._hashed(documents(spark, [(k, t, "en", "s") for k, t in enumerate(texts)]).select(dc.F.col("doc_id").alias("id"), "text"), "test-words")
    freq, total = dc._frequencies(d)
    idf = np.log((total + 1) / (freq + 0.5)).astype(np.float32)
    rows, blocks = [], 0
    for k, t in enumerate(texts):
        slot = dc._blocks([t.encode()])[0]
        cuts = [slot[i:i + BLOCK] for i in range(0, len(slot), BLOCK)]
        blocks += len(cuts)
        for both in ([np.concatenate(x) for x in zip(cuts, cuts[1:])] or cuts):
            row = np.bincount(both, minlength=dc.SLOTS) * idf
            rows.append(row / np.linalg.norm(row) * (3 if k % 2 else 1))
    assert total == blocks and len(rows) == dc.n_passages(d)
    fit = d.select("slots", dc.F.when(dc.F.col("id") % 2 == 1, 3.0).otherwise(1.0).alias("weight"))
    got = dc._latent(fit.repartition(3), idf)
    x = np.array(rows)
    want = dc._orthonormal(np.random.default_rng(3).standard_normal((dc.SLOTS, dc.RANK), np.float32))
    for _ in range(3):
        want = dc._orthonormal((x.T @ (x @ want)).astype(np.float32))
    # both bases keep the same part of the rows
    assert np.allclose(np.linalg.norm(x @ got, axis=1), np.linalg.norm(x @ want, axis=1), atol=1e-3)
