"""Prefix trie of conversations by the Euler-tour technique.

A node is a distinct sequence of first turns (role, text); the root is the
empty one.  What repeats in a subtree is what a prefix cache would save.

1. Turns are sorted by ranges of (conversation, turn).  A scan of each range
   gives places and prefix hashes within it; one row per range goes to the
   driver, which carries the open conversation over to the next range.  So a
   conversation may span any number of tasks.
2. Rows of equal prefix hash become one node (four lanes of polynomial hashes
   modulo primes near 2^31, about 124 bits).
3. Parents and children are sorted by ranges of (parent, child); the same kind
   of scan gives each child its parent and next sibling, so a parent with a
   third of all children is no hot key.
4. Every node has an enter arc and an exit arc.  Successors: enter -> enter of
   the first child, or the own exit; exit -> enter of the next sibling, or the
   parent's exit.
5. The list of arcs is ranked.  Nodes are dealt out by ranges of (conversation,
   depth), so most successors are near: each task contracts its chains.  The
   list of what is left is contracted by rounds of random mates (a quarter of
   the list leaves per round) until FINAL elements or fewer are left, which
   the driver ranks; then the rounds are undone.
6. Prefix sums of leaves and savings at the exit arc less those at the enter
   arc are the subtree's.

Defined results:
* turns of equal number are ordered by two hashes of (role, text); repeated
  rows are turns like any others; a null turn number comes first;
* a null role or text is an empty one; rows without a conversation id belong
  to no conversation and are ignored;
* texts are read whole; an empty table has no nodes (not even a root);
* other columns do not take part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figpairs.llm.common import WORD, stored

PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (1103515245, 1664525001, 1220703125, 1812433253)
LANES = range(4)
FINAL = 4096
BROADCAST_HEADS = 1_000_000


# ---------------------------------------------------------------------------
# Scans of sorted ranges
# ---------------------------------------------------------------------------
def _whole(batches) -> pa.Table | None:
    """The rows of one range (as many as a shuffle partition holds)."""
    rows = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(rows).combine_chunks() if rows else None


def _starts(*keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _tails(scanned: DataFrame, *cols: str) -> list:
    """The last row of every range, in order: as many rows as there were tasks."""
    rows = scanned.groupBy("part").agg(F.max_by(F.struct(*cols), "idx").alias("t")).collect()
    return sorted(((r["part"], r["t"]) for r in rows), key=lambda x: x[0])


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(1, np.int64)
    while len(out) < n:
        step = pow(base, len(out), prime)
        out = np.concatenate([out, out * step % prime])
    return out[:n]


def _prefixes(turns: DataFrame, order: list, hashes: bool) -> DataFrame:
    """Adds ``pos`` (from 1) and, with ``hashes``, the prefix hashes s0..s3 with and e0..e3 without the row itself.

    ``turns`` has conv and, with ``hashes``, the turn's two hashes t1 and t2.
    """
    lanes = LANES if hashes else ()
    fields = turns.schema.names

    def run(batches):
        t = _whole(batches)
        if t is None:
            return
        n = t.num_rows
        start = _starts(t.column("conv").to_numpy())
        at = np.arange(n)
        cols = [t.column(c).combine_chunks() for c in fields]
        cols += [pa.array(np.full(n, TaskContext.get().partitionId(), np.int32)), pa.array(at), pa.array(start == 0), pa.array(at - start + 1)]
        if hashes:
            both = [t.column(c).to_numpy().view(np.uint64) for c in ("t1", "t2")]
            values = [(both[k // 2] >> np.uint64(32 * (k % 2))).astype(np.int64) & 0x7FFFFFFF for k in lanes]
        for k in lanes:
            power = _powers(BASES[k], PRIMES[k], int((at - start).max()) + 2)
            x = (values[k] % PRIMES[k] + 1) * power[at - start + 1] % PRIMES[k]
            total = np.cumsum(x)
            with_it = (total - (total[start] - x[start])) % PRIMES[k]
            cols += [pa.array(with_it), pa.array((with_it - x) % PRIMES[k])]
        yield from pa.Table.from_arrays(cols, names).to_batches(max_chunksize=50_000)

    names = [*fields, "part", "idx", "open", "pos", *(c + str(k) for k in lanes for c in "se")]
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in turns.schema.fields), "part int, idx long, open boolean, pos long",
                        *(f"s{k} long, e{k} long" for k in lanes)])
    rows = stored(turns.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema), "prefixes")
    sums = [f"s{k}" for k in lanes]
    state, carried = None, []
    for part, tail in _tails(rows, "conv", "open", "pos", *sums):
        if state is not None:
            carried.append((part, state[0], state[1], *state[2], *(pow(BASES[k], state[1], PRIMES[k]) for k in lanes)))
        if state is not None and tail["open"] and tail["conv"] == state[0]:
            state = (state[0], state[1] + tail["pos"],
                     [(a + pow(BASES[k], state[1], PRIMES[k]) * tail[f"s{k}"]) % PRIMES[k] for k, a in zip(lanes, state[2])])
        else:
            state = (tail["conv"], tail["pos"], [tail[s] for s in sums])
    if not carried:
        return rows.drop("part", "idx", "open")
    kinds = ", ".join(["c_part int, c_conv long, c_pos long", *(f"c_{k} long" for k in lanes), *(f"m_{k} long" for k in lanes)])
    carry = turns.sparkSession.createDataFrame(carried, kinds)
    rows = rows.join(F.broadcast(carry), (F.col("part") == F.col("c_part")) & F.col("open") & (F.col("conv") == F.col("c_conv")), "left")
    more = {"pos": F.col("pos") + F.coalesce("c_pos", F.lit(0))}
    for k in lanes:
        for c in "se":
            own = F.col(f"{c}{k}")
            more[f"{c}{k}"] = F.when(F.col("c_pos").isNull(), own).otherwise((F.col(f"c_{k}") + F.col(f"m_{k}") * own) % PRIMES[k])
    return rows.withColumns(more).select(*fields, "pos", *(c + str(k) for k in lanes for c in "se"))


# ---------------------------------------------------------------------------
# Turns, places, rebuilding
# ---------------------------------------------------------------------------
def turns_of(conversations: DataFrame) -> DataFrame:
    """Narrow rows (conv, turn, t1, t2, words, tie): two hashes of (role, text) and the text's words."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), F.xxhash64(role, text).alias("t1"),
        F.xxhash64(F.lit(7), text, role).alias("t2"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("tie"))


def placed(conversations: DataFrame) -> DataFrame:
    """(conv, pos from 1, t1, t2, words) of every turn."""
    order = ["conv", F.asc_nulls_first("turn"), "t1", "t2", "tie"]
    return _prefixes(turns_of(conversations), order, hashes=False).select("conv", "pos", "t1", "t2", "words")


def rebuilt(turns: DataFrame, members: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Sequences that share first turns: of conversation c the first h turns of conversation c - c % ``group``, then its own after h.

    h is crc32(c) % ``most``.  A conversation is the base of at most 2 * group - 1 others.
    """
    def h(c):
        return F.crc32(F.col(c).cast("string").cast("binary")) % most

    own = turns.where(F.col("pos") > h("conv")).select("conv", F.lit(1).alias("kind"), "pos", "t1", "t2", "words")
    base = turns.where(F.col("pos") < most).withColumnRenamed("conv", "base")
    first = members.select("conv", (F.col("conv") - F.col("conv") % group).alias("base"), h("conv").alias("h")).where("h > 0").join(base, "base")
    return own.unionByName(first.where("pos <= h").select("conv", F.lit(0).alias("kind"), "pos", "t1", "t2", "words"))


# ---------------------------------------------------------------------------
# Nodes
# ---------------------------------------------------------------------------
def _key(depth, lanes: str, name: str) -> list:
    cols = [F.col(f"{lanes}{k}") for k in LANES] if lanes else [F.lit(0).cast("long")] * 4
    return [F.xxhash64(depth, *cols).alias(f"{name}1"), F.xxhash64(F.lit(5), *reversed(cols), depth).alias(f"{name}2")]


def _nodes(sequences: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, k1, k2, p1, p2, depth, conv_id, n_convs, words) and, per conversation, the node at its end."""
    pos = F.col("pos")
    rows = _prefixes(sequences.withColumnRenamed("pos", "at"), ["conv", "kind", "at"], hashes=True).select(
        "conv", "words", pos.alias("depth"), *_key(pos, "s", "k"), *_key(pos - 1, "e", "p"))
    root = members.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        *_key(F.lit(0).cast("long"), "", "k"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"),
        F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("long").alias("words"))
    nodes = rows.groupBy("k1", "k2").agg(F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.first("depth").alias("depth"),
                                         F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.first("words").alias("words"))
    nodes = stored(nodes.unionByName(root).withColumn("id", F.monotonically_increasing_id()), "nodes")
    last = rows.groupBy("conv").agg(F.max_by(F.struct("k1", "k2"), "depth").alias("k"))
    none = _key(F.lit(0).cast("long"), "", "k")
    ends = members.join(last, "conv", "left").select("conv", F.coalesce("k.k1", none[0]).alias("k1"), F.coalesce("k.k2", none[1]).alias("k2"))
    return nodes, ends


def _end_hashes(ends: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256): a node's ending conversations in ascending order.

    Ranges of (node, conversation) join their ids to one string per node and
    10,000 ids, so a node at which a third of all conversations end costs its
    task one row per 10,000 of them; the hash runs over them as a stream.
    """
    def join(batches):
        t = _whole(batches)
        if t is None:
            return
        k1, k2, conv = (t.column(c).to_numpy() for c in ("k1", "k2", "conv"))
        start = _starts(k1, k2)
        cuts = np.flatnonzero((np.arange(len(conv)) - start) % 10_000 == 0)
        texts = [",".join(map(str, conv[s:e].tolist())).encode() for s, e in zip(cuts, [*cuts[1:], len(conv)])]
        yield from pa.Table.from_arrays([pa.array(k1[cuts]), pa.array(k2[cuts]), pa.array(conv[cuts]), pa.array(texts, pa.binary())],
                                        ["k1", "k2", "conv", "ids"]).to_batches(max_chunksize=5_000)

    def digest(batches):
        import hashlib

        key, state, done = None, None, []

        def rows():
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.string()))],
                                              ["k1", "k2", "ends_sha256"])

        for b in batches:
            for k1, k2, ids in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
                if (k1, k2) == key:
                    state.update(b",")
                else:
                    if key:
                        done.append((*key, state.hexdigest()))
                    key, state = (k1, k2), hashlib.sha256()
                state.update(ids)
            if len(done) >= 10_000:
                yield rows()
                done.clear()
        if key:
            done.append((*key, state.hexdigest()))
        yield rows()

    order = ["k1", "k2", "conv"]
    chunks = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, "k1 long, k2 long, conv long, ids binary")
    return chunks.repartition("k1", "k2").sortWithinPartitions(*order).mapInArrow(digest, "k1 long, k2 long, ends_sha256 string")


def _linked(nodes: DataFrame) -> DataFrame:
    """(id, parent, parent_conv, sibling): siblings follow each other by falling conv_id; null: none."""
    both = nodes.select("k1", "k2", F.lit(0).alias("kind"), "conv_id", "id").unionByName(
        nodes.where("depth > 0").select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.lit(1).alias("kind"), "conv_id", "id"))

    def run(batches):
        t = _whole(batches)
        if t is None:
            return
        n = t.num_rows
        k1, k2, kind, conv, ids = (t.column(c).to_numpy() for c in ("k1", "k2", "kind", "conv_id", "id"))
        start = _starts(k1, k2)
        unknown = kind[start] == 1                      # the parent's row is in an earlier range
        before = np.arange(n) - 1
        sibling = (kind == 1) & (before >= start)
        sibling &= kind[before] == 1
        part = np.full(n, TaskContext.get().partitionId(), np.int32)
        yield from pa.Table.from_arrays(
            [pa.array(k1), pa.array(k2), pa.array(kind), pa.array(ids), pa.array(ids[start], mask=unknown), pa.array(conv[start], mask=unknown),
             pa.array(ids[before], mask=~sibling), pa.array(part), pa.array(np.arange(n)), pa.array(start == 0)],
            ["k1", "k2", "kind", "id", "parent", "parent_conv", "sibling", "part", "idx", "open"]).to_batches(max_chunksize=50_000)

    order = ["k1", "k2", "kind", "conv_id", "id"]
    rows = stored(both.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        run, "k1 long, k2 long, kind int, id long, parent long, parent_conv long, sibling long, part int, idx long, open boolean"), "siblings")
    state, carried = None, []
    for part, t in _tails(rows, "k1", "k2", "kind", "id", "parent", "parent_conv"):
        if state is not None:
            carried.append((part, state["k1"], state["k2"], state["parent"], state["parent_conv"], state["id"] if state["kind"] else None))
        t = t.asDict()
        if t["parent"] is None:
            t["parent"], t["parent_conv"] = state["parent"], state["parent_conv"]
        state = t
    rows = rows.where("kind = 1")
    if not carried:
        return rows.select("id", "parent", "parent_conv", "sibling")
    carry = nodes.sparkSession.createDataFrame(carried, "c_part int, c1 long, c2 long, c_parent long, c_conv long, c_id long")
    rows = rows.join(F.broadcast(carry), F.expr("part = c_part and open and k1 = c1 and k2 = c2"), "left")
    return rows.select("id", F.coalesce("parent", "c_parent").alias("parent"), F.coalesce("parent_conv", "c_conv").alias("parent_conv"),
                       F.when(F.col("idx") == 0, F.col("c_id")).otherwise(F.col("sibling")).alias("sibling"))


# ---------------------------------------------------------------------------
# List ranking
# ---------------------------------------------------------------------------
def _chains(nxt: np.ndarray, weights: np.ndarray):
    """Per element of a forest of chains: its head, the sum of weights before it, and whether it is a head; ``nxt`` -1 at an end.

    Pointer jumping towards the heads.
    """
    n = len(nxt)
    up = np.arange(n)
    inside = nxt >= 0
    up[nxt[inside]] = np.flatnonzero(inside)
    before = np.where((up != np.arange(n))[:, None], weights[up], 0)
    while True:
        far = up[up]
        if (far == up).all():
            return up, before
        before = before + before[up]
        up = far


def _contracted(tour: DataFrame) -> DataFrame:
    """Rows of each range of nodes with the chains of its arcs contracted.

    Row kind 0: a node with, for enter (a) and exit (b), the head of its chain
    and the sums before it on the chain.  Row kind 1: a head with its chain's
    sums and the arc after its chain (null: the tour's end).
    """
    def run(batches):
        t = _whole(batches)
        if t is None:
            return
        n = t.num_rows
        col = {c: t.column(c).to_numpy(zero_copy_only=False) for c in ("id", "after_enter", "leaf", "saved")}
        after_exit = t.column("after_exit").fill_null(-1).to_numpy()
        arcs = np.concatenate([2 * col["id"], 2 * col["id"] + 1])
        target = np.concatenate([col["after_enter"], after_exit])
        weights = np.zeros((2 * n, 3), np.int64)
        weights[:, 0] = 1
        weights[:n, 1], weights[:n, 2] = col["leaf"], col["saved"]
        by = np.argsort(arcs, kind="stable")
        at = np.minimum(np.searchsorted(arcs, target, sorter=by), 2 * n - 1)
        nxt = np.where(arcs[by[at]] == target, by[at], -1)
        head, before = _chains(nxt, weights)
        ends = np.flatnonzero(nxt < 0)
        first = head[ends]
        total = before[ends] + weights[ends]
        none = pa.nulls(len(ends), pa.int64())
        blank = pa.nulls(n, pa.int64())
        arrays = [pa.array(np.repeat([0, 1], [n, len(ends)]).astype(np.int32))]
        arrays += [pa.concat_arrays([t.column("id").combine_chunks(), none])]
        for s in (slice(0, n), slice(n, 2 * n)):
            arrays += [pa.concat_arrays([pa.array(x), none]) for x in (arcs[head[s]], before[s, 0], before[s, 1], before[s, 2])]
        heads = [pa.array(arcs[first]), pa.array(target[ends], mask=target[ends] < 0), *(pa.array(total[:, k]) for k in range(3))]
        arrays += [pa.concat_arrays([blank, x]) for x in heads]
        yield from pa.Table.from_arrays(arrays, names).to_batches(max_chunksize=50_000)

    names = ["kind", "id", "ha", "a0", "a1", "a2", "hb", "b0", "b1", "b2", "arc", "next", "w0", "w1", "w2"]
    order = ["conv_id", "depth"]
    nodes = tour.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "after_enter", "after_exit", "leaf", "saved")
    return nodes.mapInArrow(run, "kind int, " + ", ".join(f"{c} long" for c in names[1:]))


def ranked(heads: DataFrame, final: int = FINAL) -> DataFrame:
    """(arc, r0, r1, r2): sums of weights before each element of the list ``heads`` (arc, next, w0, w1, w2)."""
    spark = heads.sparkSession
    undo, rnd = [], 0
    while heads.count() > final:
        rnd += 1
        coin = F.pmod(F.xxhash64("arc", F.lit(rnd)), F.lit(2))
        marked = heads.withColumn("coin", coin)
        y = marked.where("coin = 1").select(F.col("arc").alias("y"), F.col("next").alias("y_next"), *(F.col(f"w{k}").alias(f"y{k}") for k in range(3)))
        met = stored(marked.join(y, (F.col("next") == F.col("y")) & (F.col("coin") == 0), "left"), "mates")
        gone = met.where("y is not null").select(F.col("y").alias("arc"), F.col("arc").alias("x"), *(F.col(f"w{k}").alias(f"o{k}") for k in range(3)))
        undo.append(gone)
        left = met.join(gone.select("arc"), "arc", "left_anti")
        heads = stored(left.select("arc", F.when(F.col("y").isNull(), F.col("next")).otherwise(F.col("y_next")).alias("next"),
                                   *((F.col(f"w{k}") + F.coalesce(f"y{k}", F.lit(0))).alias(f"w{k}") for k in range(3))), "list")
    rows = {r["arc"]: r for r in heads.collect()}  # at most ``final``
    arc = next(iter(rows.keys() - {r["next"] for r in rows.values()}), None)
    sums, out = (0, 0, 0), []
    while arc is not None:
        out.append((arc, *sums))
        r = rows[arc]
        sums = tuple(s + r[f"w{k}"] for k, s in enumerate(sums))
        arc = r["next"]
    found = spark.createDataFrame(out, "arc long, r0 long, r1 long, r2 long")
    for gone in reversed(undo):
        back = gone.join(found.withColumnRenamed("arc", "x"), "x").select("arc", *((F.col(f"r{k}") + F.col(f"o{k}")).alias(f"r{k}") for k in range(3)))
        found = stored(found.unionByName(back), "ranks")
    return found


def trie(sequences: DataFrame, members: DataFrame, final: int = FINAL) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, and the places of its two arcs on the tour (enter, exit).

    ``sequences``: conv, kind, pos (order within a conversation), t1, t2, words; ``members``: conv, a row per conversation.
    """
    nodes, ends = _nodes(sequences, members)
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("n_children"), F.max_by("id", "conv_id").alias("child"))
    known = nodes.join(children, ["k1", "k2"], "left").join(_end_hashes(ends), ["k1", "k2"], "left").join(_linked(nodes), "id", "left")
    leaf = F.col("n_children").isNull()
    enter = F.when(leaf, 2 * F.col("id") + 1).otherwise(2 * F.col("child"))
    leave = F.when(F.col("sibling").isNotNull(), 2 * F.col("sibling")).otherwise(2 * F.col("parent") + 1)
    tour = stored(known.select("id", "conv_id", "depth", "parent_conv", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
                               F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"), enter.alias("after_enter"),
                               leave.alias("after_exit"), leaf.cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved")), "tour")
    contracted = stored(_contracted(tour), "chains")
    heads = stored(contracted.where("kind = 1").select("arc", "next", "w0", "w1", "w2"), "list")
    few = heads.count() <= BROADCAST_HEADS
    ranks = ranked(heads, final)
    ranks = F.broadcast(ranks) if few else ranks
    sums = contracted.where("kind = 0")
    for c in "ab":
        sums = sums.join(ranks.select(F.col("arc").alias(f"h{c}"), *(F.col(f"r{k}").alias(f"{c}r{k}") for k in range(3))), f"h{c}")
    at = {f"{c}{k}": F.col(f"{c}{k}") + F.col(f"{c}r{k}") for c in "ab" for k in range(3)}
    sums = sums.select("id", at["a0"].alias("enter"), at["b0"].alias("exit"), (at["b1"] - at["a1"]).alias("n_leaves"), (at["b2"] - at["a2"]).alias("saved_tokens"))
    return tour.join(sums, "id").select("conv_id", "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                                        "saved_tokens", "ends_sha256", "enter", "exit")


def shared_prefixes(conversations: DataFrame, final: int = FINAL) -> DataFrame:
    """The trie of the conversations as they are."""
    turns = placed(conversations)
    return trie(turns.withColumn("kind", F.lit(0)), stored(turns.select("conv").distinct(), "members"), final)


def rebuilt_prefixes(conversations: DataFrame, final: int = FINAL) -> DataFrame:
    """The trie of the conversations rebuilt with shared first turns (:func:`rebuilt`)."""
    turns = placed(conversations)
    members = stored(turns.select("conv").distinct(), "members")
    return trie(rebuilt(turns, members), members, final)
