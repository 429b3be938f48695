"""The trie against a plain one, list ranking against a walk."""

import hashlib
import random
import re
import zlib

import pytest
from figpairs.llm import prefix_trie as P

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, id string, k1 string, pos string, depth string, part string"


def sequences(rows):
    """Conversations from (conv_id, turn, role, text) without equal turn numbers."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}


def rebuild(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    """Every node by the set of its members."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, ms in members.items():
        below = [n for n in members if n[:len(node)] == node]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[:-1] == n for m in below)]
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        ends = ",".join(str(c) for c in sorted(ms) if len(convs[c]) == len(node))
        out.append((min(ms), len(node), min(members[node[:-1]]) if node else None, len(ms), sum(len(n) == len(node) + 1 for n in below),
                    len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "?", "?", "?", "?", "?") for r in rows], SCHEMA)


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.fixture
def partitions(spark):
    """Many small ranges, so that conversations, sibling groups and the tour span tasks."""
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", 13)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old[0])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[1])


def test_random_conversations(spark, partitions):
    rnd = random.Random(5)
    rows = [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "b b", "c  c\tc", "", None]))
            for c in [*range(-30, 60), 10**12] for t in rnd.sample([None, *range(9)], rnd.randint(1, 6))]
    rows += [(7, t, "user", "a") for t in range(10, 90)]                     # one long conversation
    rows += [(200 + c, 0, "user", "hot") for c in range(60)]                 # one hot node and end
    rows += [(300 + c, t, "user", f"hot {c}" if t else "hot") for c in range(60) for t in range(2)]  # a parent of many children
    rnd.shuffle(rows)
    convs = sequences(rows)
    df = table(spark, [*rows, (None, 0, "user", "no conversation")])
    assert got(P.shared_prefixes(df, final=40)) == brute(convs)
    assert got(P.rebuilt_prefixes(df)) == brute(rebuild(convs))


def test_edges(spark):
    assert P.rebuilt_prefixes(table(spark, [])).count() == 0
    # a conversation that loses all its turns ends at the root; repeated rows are turns of their own
    turnless = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 > 0)
    rows = [(turnless, 0, "user", "gone"), (400, 1, "user", "x"), (400, 1, "user", "x"), (400, None, "user", " first\n")]
    assert got(P.rebuilt_prefixes(table(spark, rows))) == brute(rebuild(sequences(rows)))
    long_text = "w " * 300_000
    rows = [(1000, 0, "user", long_text), (1001, 0, "user", long_text)]
    assert got(P.shared_prefixes(table(spark, rows))) == brute(sequences(rows))


def test_equal_turn_numbers_have_one_order(spark):
    rows = [(c, 0, "user", t) for c in (20, 21) for t in ("b", "a", "c")]
    nodes = got(P.shared_prefixes(table(spark, rows)))
    assert [n[3] for n in sorted(nodes, key=lambda n: n[1])] == [2, 2, 2, 2]


def test_list_ranking(spark):
    rnd = random.Random(3)
    arcs = rnd.sample(range(10**9), 400)
    rows = [(a, b, rnd.randint(0, 9), 1, 2) for a, b in zip(arcs, [*arcs[1:], None])]
    heads = spark.createDataFrame(rnd.sample(rows, len(rows)), "arc long, next long, w0 long, w1 long, w2 long")
    want, at = {}, 0
    for k, (a, _, w, *_r) in enumerate(rows):
        want[a] = (at, k, 2 * k)
        at += w
    assert {r["arc"]: (r["r0"], r["r1"], r["r2"]) for r in P.ranked(heads, final=20).collect()} == want
    assert {r["arc"]: (r["r0"], r["r1"], r["r2"]) for r in P.ranked(heads).collect()} == want


def test_tour_positions(spark):
    rows = [(c, t, "user", f"{c % 3 if t else 0}") for c in range(9) for t in range(3)]
    out = P.shared_prefixes(table(spark, rows)).select("depth", "enter", "exit").collect()
    assert sorted(x for r in out for x in (r.enter, r.exit)) == list(range(2 * len(out)))
    spans = [(r.enter, r.exit) for r in out]
    assert all(not (a < c < b < d) for a, b in spans for c, d in spans)
