"""MinHash near-duplicate removal by a signature-coordinate inverted join.

1. One pass over the texts gives each document its shingle count, a 128-bit
   key of its whole shingle set and a signature of ``COORDS`` MinHash
   coordinates.  Documents of one key are one class; only classes go on.
2. Classes are posted under coordinate-value pairs.  Two sets of similarity
   0.8 agree in ``MATCHES`` or more of the coordinates (a pair at exactly 0.8
   misses that with a probability of about 1e-6), so they share a pair among
   the ``COORDS - MATCHES + 1`` rarest of each; only that prefix is posted, and
   of it no pair that occurs once.  Rarity is read from a count sketch of fixed
   size; any common order is right, rarity makes the lists short.
3. Posting lists are cut into blocks of bounded size; a task compares a block
   with a block.  Pairs are skipped if their sizes rule the similarity out, or
   if an earlier common coordinate of both prefixes already brings them
   together; of the rest the agreeing coordinates are counted over the whole
   signature and those at ``MATCHES`` or above stay.
4. Documents with such a pair get their full shingle sets from the texts, and
   the pairs are confirmed on these sets: links.  A pair whose members are
   already connected within the block is skipped, first trying all members
   against the most typical one, so a large group of near copies costs about
   one comparison each; connected components need no more.
5. Connected components over the links of classes; each document takes its
   class's component.

Sets are compared by 64-bit hashes of their shingles.

Defined results:
* texts without words, null and empty texts: an empty set, linked with nothing;
* with fewer words than a shingle takes, the whole sequence is one shingle;
* rows of one id are one node; all rows stay in the result;
* a null id is linked with nothing, its component is null and it is kept;
* very long texts are read whole; an empty table gives an empty result;
* other columns of the documents do not take part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figpairs.llm.common import by_bytes, runs_of, stored, without_ids, worker_cache
from figpairs.llm.components import components

COORDS = 32
MATCHES = 14
SKETCH = 1 << 20
BLOCK_ROWS = 2048
BLOCK_SHINGLES = 1_000_000
WORDS_HELD = 500_000
BATCH_BYTES = 8 << 20


class _Hashes(dict):
    def __missing__(self, word):
        import xxhash

        if len(self) > WORDS_HELD:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: str | None, width: int, known: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of ``width`` words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    x = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        x = x * np.uint64(0x9E3779B97F4A7C15) + h[k:len(words) - width + 1 + k]
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return np.unique(x)


def signature_factors() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(11)
    return rng.integers(0, 1 << 63, COORDS, dtype=np.uint64), rng.integers(0, 1 << 63, COORDS, dtype=np.uint64) * 2 + 1


def signature(s: np.ndarray, flip: np.ndarray, factor: np.ndarray) -> np.ndarray:
    low = np.full(COORDS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 1 << 15):
        part = s[at:at + (1 << 15)]
        low = np.minimum(low, ((part[None, :] ^ flip[:, None]) * factor[:, None]).min(1))
    return (low & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)


def _signed(docs: DataFrame, id_type: str, width: int) -> DataFrame:
    def run(batches):
        import xxhash

        worker_cache("near duplicates")
        known = _Hashes()
        flip, factor = signature_factors()
        for b in by_bytes(batches, 1, BATCH_BYTES):
            n, key, sig = [], [], []
            for t in b.column(1).to_pylist():
                s = shingle_set(t, width, known)
                n.append(len(s))
                key.append(xxhash.xxh3_128_digest(s.tobytes()))
                sig.append(signature(s, flip, factor) if len(s) else np.zeros(COORDS, np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, COORDS * len(n) + 1, COORDS), pa.int32()), pa.array(np.concatenate(sig) if sig else [], pa.int32()))],
                ["id", "n", "key", "sig"])

    return docs.mapInArrow(run, f"id {id_type}, n long, key binary, sig array<int>")


def _sketch(classes: DataFrame) -> np.ndarray:
    """log2 of how often a coordinate-value pair occurs, at most; one byte for each of SKETCH counters.

    A counter of 0 says that the pair occurs once.
    """
    chunk = 1 << 12
    slot = F.col("v").bitwiseXOR(F.col("c") * 40503).bitwiseAND(SKETCH - 1)
    counts = classes.select(F.posexplode("sig").alias("c", "v")).groupBy(slot.alias("slot")).agg(F.count("*").alias("k")).where("k > 1")
    counts = counts.select(F.expr(f"slot div {chunk}").alias("chunk"), (F.col("slot") % chunk).alias("at"), F.ceil(F.log2("k")).cast("int").alias("level"))

    def pack(pdf):
        import pandas as pd

        levels = np.zeros(chunk, np.uint8)
        levels[pdf["at"].to_numpy()] = pdf["level"].to_numpy()
        return pd.DataFrame({"chunk": [int(pdf["chunk"].iloc[0])], "levels": [levels.tobytes()]})

    out = np.zeros(SKETCH, np.uint8)
    for r in counts.groupBy("chunk").applyInPandas(pack, "chunk long, levels binary").collect():  # SKETCH bytes in all
        out[r["chunk"] * chunk:(r["chunk"] + 1) * chunk] = np.frombuffer(r["levels"], np.uint8)
    return out


def _postings(classes: DataFrame, sketch: np.ndarray, id_type: str) -> DataFrame:
    """A narrow row per class and pair of its prefix, but for pairs known to occur once."""
    shared = classes.sparkSession.sparkContext.broadcast(sketch)
    keep = COORDS - MATCHES + 1

    def run(batches):
        count, coord = shared.value, np.arange(COORDS, dtype=np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            sig = b.column(3).flatten().to_numpy().reshape(b.num_rows, COORDS)
            seen = count[(sig.astype(np.int64) ^ (coord * 40503)) & (SKETCH - 1)]
            token = (sig.view(np.uint32).astype(np.int64)) | (coord << 32)
            mixed = (token.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
            rank = np.argsort((seen.astype(np.uint64) << np.uint64(32)) | mixed, axis=1, kind="stable")
            inside = np.zeros(sig.shape, bool)
            np.put_along_axis(inside, rank[:, :keep], True, axis=1)
            mask = (inside.astype(np.int64) << coord).sum(1)
            typical = seen.sum(1).astype(np.float32)
            row, col = np.nonzero(inside & (seen > 0))
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(token[row, col]), *(b.column(k).take(take) for k in range(3)), pa.array(mask[row]), pa.array(typical[row])],
                ["token", "id", "class", "n", "mask", "typical"])

    return classes.select("id", F.xxhash64("key").alias("class"), "n", "sig").mapInArrow(
        run, f"token long, id {id_type}, class long, n long, mask long, typical float")


def _blocks(postings: DataFrame, classes: DataFrame) -> DataFrame:
    """Lists of two or more, dealt out by pairs of blocks (bi <= bj); only their rows get signatures."""
    lists = (postings.groupBy("token").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles")).where("rows > 1")
             .select("token", F.greatest(F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks")))
    own = F.pmod(F.col("class"), F.col("blocks")).cast("int")
    p = postings.join(lists, "token").withColumn("own", own)
    signed = classes.select("id", F.xxhash64("key").alias("class"), "key", "sig")
    p = p.join(signed, ["id", "class"]).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return p.select("token", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"),
                    (F.col("own") > F.col("other")).cast("int").alias("side"), "id", "n", "key", "sig", "mask", "typical")


def matching_pairs(g: dict, percent: int):
    """(i, js): rows of one block pair that may be near duplicates, each pair in one list only."""
    sig, mask, n, side = g["sig"], g["mask"], g["n"], g["side"]
    here = int(g["token"][0]) >> 32
    cross = g["bi"][0] != g["bj"][0]
    bits = np.int64(1) << np.arange(COORDS, dtype=np.int64)
    before = (np.int64(1) << np.int64(here)) - np.int64(1)
    for i in range(len(n) - 1):
        j = np.arange(i + 1, len(n))
        ok = 100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i])
        if cross:
            ok &= side[j] != side[i]
        j = j[ok]
        if not len(j):
            continue
        same = sig[j] == sig[i]
        j, same = (x[same.sum(1) >= MATCHES] for x in (j, same))
        if len(j):
            agreed = (same * bits).sum(1)
            j = j[(agreed & mask[j] & mask[i] & before) == 0]
            if len(j):
                yield i, j


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    inter = int((both[1:] == both[:-1]).sum())
    return 100 * inter >= percent * (len(a) + len(b) - inter)


def _flagged(blocks: DataFrame, percent: int, id_type: str) -> DataFrame:
    """The rows of each block pair that have a matching pair there."""
    schema = f"token long, bi int, bj int, side int, id {id_type}, n long, key binary, sig array<int>, mask long, typical float"

    def run(batches):
        for b in _whole_groups(batches, ["token", "bi", "bj"]):
            a = {k: b.column(k).to_numpy(zero_copy_only=False) for k in ("token", "bi", "bj", "side", "n", "mask")}
            a["sig"] = b.column("sig").combine_chunks().flatten().to_numpy().reshape(b.num_rows, COORDS)
            change = np.ones(b.num_rows, bool)
            change[1:] = (a["token"][1:] != a["token"][:-1]) | (a["bi"][1:] != a["bi"][:-1]) | (a["bj"][1:] != a["bj"][:-1])
            cuts = [*np.flatnonzero(change).tolist(), b.num_rows]
            hit = np.zeros(b.num_rows, bool)
            for s, e in zip(cuts[:-1], cuts[1:]):
                if e - s > 1:
                    for i, js in matching_pairs({k: v[s:e] for k, v in a.items()}, percent):
                        hit[s + i] = True
                        hit[s + js] = True
            yield from b.filter(pa.array(hit)).combine_chunks().to_batches()

    sorted_blocks = blocks.repartition("token", "bi", "bj").sortWithinPartitions("token", "bi", "bj")
    return sorted_blocks.mapInArrow(run, schema)


def _whole_groups(batches, keys: list[str]):
    """Arrow tables of sorted batches, cut so that no group of equal keys is split."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        if not t.num_rows:
            continue
        t = t if held is None else pa.concat_tables([held, t]).combine_chunks()
        cols = [t.column(k).to_numpy() for k in keys]
        tail = np.ones(t.num_rows, bool)
        for c in cols:
            tail &= c == c[-1]
        cut = t.num_rows - int(tail[::-1].argmin() if not tail.all() else t.num_rows)
        if cut:
            yield t.slice(0, cut)
        held = t.slice(cut)
    if held is not None and held.num_rows:
        yield held


def _sets(docs: DataFrame, wanted: DataFrame, id_type: str, width: int) -> DataFrame:
    """(id, key, set) of the wanted documents, from their texts.

    A bitmap of fixed size over hashes of the wanted ids spares other
    documents; where it lets one through, the join that follows drops it.
    """
    bits = 1 << 25
    slot = F.pmod(F.xxhash64("id"), bits)
    maps = wanted.select(F.bitmap_bucket_number(slot + 1).alias("bucket"), F.bitmap_bit_position(slot + 1).alias("bit")).groupBy("bucket").agg(
        F.bitmap_construct_agg("bit").alias("map"))
    held = {r["bucket"]: r["map"] for r in maps.toLocalIterator()}  # at most bits / 32768 maps of 4 KB
    shared = docs.sparkSession.sparkContext.broadcast(held)

    def run(batches):
        import xxhash

        worker_cache("near duplicates")
        maps = shared.value
        known = _Hashes()
        for b in batches:
            buckets, places = b.column(2).to_numpy(), b.column(3).to_numpy()
            hit = np.array([(m := maps.get(k)) is not None and bool(m[p >> 3] >> (p & 7) & 1) for k, p in zip(buckets.tolist(), places.tolist())], bool)
            if not hit.any():
                continue
            own = b.filter(pa.array(hit))
            for at in range(0, own.num_rows, 256):
                part = own.slice(at, 256)
                sets = [shingle_set(t, width, known).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()), pa.array(sets, pa.binary())],
                                                 ["id", "key", "shingles"])

    d = docs.select("id", "text", F.bitmap_bucket_number(slot + 1).alias("bucket"), F.bitmap_bit_position(slot + 1).alias("bit"))
    return d.mapInArrow(run, f"id {id_type}, key binary, shingles binary")


def _links(flagged: DataFrame, sets: DataFrame, percent: int, id_type: str) -> DataFrame:
    """Confirmed links (a, b) that connect what is connected within each block pair."""
    once = sets.groupBy("id", "key").agg(F.first("shingles").alias("shingles"))
    rows = flagged.join(once, ["id", "key"]).repartition("token", "bi", "bj").sortWithinPartitions("token", "bi", "bj")
    rows = rows.select("token", "bi", "bj", "side", "id", "n", "sig", "mask", "typical", "shingles")
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(flagged.schema["id"].dataType)

    def run(batches):
        for g in runs_of(batches, ["token", "bi", "bj"]):
            m = len(g["n"])
            order = np.argsort(-g["typical"], kind="stable")
            g = {k: v[order] for k, v in g.items()}
            sets = [np.frombuffer(s, np.uint64) for s in g["shingles"]]
            root = list(range(m))

            def find(x):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            a, b = [], []
            for i, js in matching_pairs(g, percent):
                for j in js.tolist():
                    if find(i) != find(j) and similar(sets[i], sets[j], percent):
                        root[find(j)] = find(i)
                        a.append(g["id"][i])
                        b.append(g["id"][j])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind)], ["a", "b"])

    return rows.mapInArrow(run, f"a {id_type}, b {id_type}")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest linked id, itself included) and kept.

    ``width``: words in a shingle; ``percent``: least similarity of a link.
    MATCHES is set for a similarity of 0.8 or above.
    """
    if percent < 80:
        raise ValueError("signatures are set for a similarity of 80 % or more")
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = d.schema["id"].dataType.simpleString()
    signed = stored(_signed(d, id_type, width), "signed")
    # ids of one class, and classes of one id, are linked through the class's smallest id
    named = signed.where("id is not null and n > 0")
    classes = stored(named.groupBy("key").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sig").alias("sig")), "classes")
    # with fewer than 4 shingles only equal sets reach 80 %
    large = classes.where("n > 3")
    postings = _postings(large, _sketch(large), id_type)
    flagged = stored(_flagged(_blocks(postings, large), percent, id_type), "flagged")
    sets = _sets(d, flagged.select("id").distinct(), id_type, width)
    links = _links(flagged, sets, percent, id_type)
    twice = named.groupBy("id").agg(F.count_distinct("key").alias("k")).where("k > 1").select("id")
    same = named.join(twice, "id", "left_semi").select("id", "key").alias("d").join(classes.alias("c"), F.col("d.key") == F.col("c.key"))
    links = links.unionByName(same.select(F.col("d.id").alias("a"), F.col("c.id").alias("b")))
    found = components(links)
    of_class = classes.select("key", F.col("id").alias("node")).join(found, "node", "left").select(
        "key", F.coalesce("component", "node").alias("component"))
    out = signed.alias("s").join(of_class.alias("c"), (F.col("s.key") == F.col("c.key")) & (F.col("s.n") > 0), "left")
    comp = F.when(F.col("s.id").isNotNull(), F.coalesce("c.component", "s.id"))
    return out.select(F.col("s.id").alias(id_col), F.col("s.n").alias("n_shingles"), comp.alias("component_id"),
                      F.coalesce(comp == F.col("s.id"), F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` of which one document of each group stays, the one of smallest id.

    Rows of one id stay or go together.
    """
    return without_ids(docs, id_col, near_duplicates(docs, id_col, text_col, width, percent).where("not kept").select(id_col))
