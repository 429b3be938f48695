"""Near duplicates against brute force over all pairs."""

import random

from figpairs.llm.components import components
from figpairs.llm.near_dup import near_duplicates, without_near_duplicates
from tests.llm.conftest import documents


def shingles(text, width):
    w = (text or "").encode().lower().split()
    return {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def expected(rows, width, percent=80):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t, width))
    root = {i: i for i in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a in sets:
        for b in sets:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in sets}


def corpus(n_groups=12, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    rows = []
    for _ in range(n_groups):
        base = [word() for _ in range(rng.choice([2, 5, 30, 80, 300]))]
        for _ in range(rng.choice([1, 2, 6])):
            w = list(base)
            for _ in range(rng.randint(0, 1 + len(w) // 12)):
                w[rng.randrange(len(w))] = word()
            rows.append(" ".join(w))
    rng.shuffle(rows)
    return list(enumerate(rows))


def check(spark, rows, width):
    df = documents(spark, [(i, t, "en", "s") for i, t in rows])
    want = expected(rows, width)
    for r in near_duplicates(df, width=width).collect():
        assert r.component_id == want[r.doc_id], r
        assert r.kept == (want[r.doc_id] == r.doc_id)


def test_matches_brute_force(spark):
    rows = corpus()
    check(spark, rows, 2)
    check(spark, rows, 5)


def test_large_group_of_near_copies_over_blocks(spark, monkeypatch):
    import figpairs.llm.near_dup as nd

    monkeypatch.setattr(nd, "BLOCK_ROWS", 16)
    rng = random.Random(3)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(80):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(200)] = f"x{rng.random()}"
        rows.append((i, " ".join(w)))
    check(spark, rows, 2)


def test_edge_rows(docs, no_docs):
    got = near_duplicates(docs, width=2).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [by[i][0].component_id for i in (0, 1, 2)] == [0, 0, 0]
    assert all(by[i][0].n_shingles == 0 and by[i][0].component_id == i and by[i][0].kept for i in (3, 4, 5))
    assert by[6][0].n_shingles == 1
    assert len(by[7]) == 2 and all(r.n_shingles == 29_999 and r.kept for r in by[7])
    assert by[None][0].component_id is None and by[None][0].kept
    assert near_duplicates(no_docs, width=2).count() == 0


def test_stage_keeps_one_of_a_group_and_all_columns(docs):
    out = without_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in out.select("doc_id").collect()) == sorted(
        (i is None, i) for i in (0, 3, 4, 5, 6, 7, 7, None, 9, 10))


def test_rows_of_one_id_are_one_node(spark):
    a, b = (" ".join(f"{p}{k}" for k in range(40)) for p in "ab")
    df = documents(spark, [(5, a, "", ""), (5, b, "", ""), (8, a, "", ""), (9, b, "", "")])
    assert {(r.doc_id, r.component_id) for r in near_duplicates(df, width=2).collect()} == {(5, 5), (8, 5), (9, 5)}


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(100)] + [(500, 600), (600, 500), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{k: 0 for k in range(101)}, 500: 500, 600: 500}
    assert components(links.limit(0)).count() == 0
