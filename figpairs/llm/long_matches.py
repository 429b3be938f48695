"""Removal of byte strings that also occur earlier in the corpus, by run-length indexes.

A byte is removed if a string of ``length`` bytes (a window) that covers it
also starts earlier: in a document of smaller id, or before in the same one.

1. Every window is assigned to the smallest hash of its ``SEED``-byte
   substrings; consecutive windows of one such hash make a stretch.  Equal
   windows have the same smallest hash, so they meet under it.  A first pass
   counts these hashes, in a bitmap of fixed size: a stretch whose hash occurs
   once needs no further look (a clash in the bitmap only costs work).
2. A second pass hashes the other stretches; of equal ones the earliest place is
   kept, all their later places are removed whole.  Only hashes and places are
   shuffled.
3. A third pass takes the bytes of those earliest places whose hash has several
   texts, or one that repeats itself.  These texts, sorted by hash, are indexed in blocks: suffixes are
   sorted, the Burrows-Wheeler transform is run-compressed, and at the first
   row of each run its text position is sampled with the length of the match
   with the row before.  Inside a run that length is one less than at the
   preceding text position, so the matching statistics of all positions stream
   out of the samples in text order.  Windows matched over the whole length form
   classes of equal windows; all but the earliest of a class are removed.
4. A hash with more than ``HOT_BYTES`` of distinct texts does not go to one
   task: its windows are dealt out one by one under their own 128-bit hashes.

A last pass joins each document with its earliest places and its matches, removes
the matches and all stretches that are no earliest place, and hashes what is kept.

Defined results:
* null and empty texts have 0 bytes and keep the empty string;
* documents of one id stand in the order of a hash of their texts; rows equal
  in id and text are one document and get equal results; null ids stand last;
* a text of thousands of repetitions keeps its first period;
* very long texts are read whole; an empty table gives an empty result;
* other columns of the documents do not take part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figpairs.llm.common import stored

SEED = 24
BITMAP_BITS = 1 << 28  # of hashes that occur again
PLACE_BITS = 1 << 26  # of places whose bytes are wanted
MAP_BITS = 1 << 15  # of one row of bitmap_construct_agg
BLOCK_BYTES = 1 << 19
HOT_BYTES = 4 << 20
WORD64 = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15


def seed_hashes(b: np.ndarray) -> np.ndarray:
    """Hash of the SEED bytes from each position on; SEED is 24: 16 and 8."""
    h, power, n = b.astype(np.uint64) + np.uint64(1), BASE, 1
    half, half_power = h, power
    while n < 16:
        half, half_power = h, power
        h = h[:-n] * np.uint64(power) + h[n:]
        power, n = power * power & WORD64, 2 * n
    h = h[:-8] * np.uint64(half_power) + half[16:]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    m, n = h, 1
    while n * 2 <= width:
        m, n = np.minimum(m[:-n], m[n:]), n * 2
    return np.minimum(m[:len(m) - (width - n)], m[width - n:]) if n < width else m


def stretches(texts: list[bytes], length: int):
    """(buffer, seed hashes, smallest hash, document, start in the buffer, end of the bytes) of all stretches of these texts."""
    buf = b"".join(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    none = np.zeros(0, np.int64)
    if len(buf) < length:
        return buf, none, np.zeros(0, np.uint64), none, none, none
    b = np.frombuffer(buf, np.uint8)
    h = seed_hashes(b)
    low = sliding_min(h, length - SEED + 1)
    doc = np.repeat(np.arange(len(texts)), sizes)[:len(low)]
    inside = np.arange(len(low)) + length <= np.cumsum(sizes)[doc]
    head = np.ones(len(low), bool)
    head[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1]) | ~inside[:-1]
    start = np.flatnonzero(head & inside)
    stops = np.flatnonzero(head | ~inside)
    after = np.searchsorted(stops, start, side="right")
    stop = np.where(after < len(stops), stops[np.minimum(after, len(stops) - 1)], len(low))
    return buf, h, low[start], doc[start], start, stop + length - 1


def seen_again(h: np.ndarray, low: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Whether a stretch holds its hash at several places: then its windows may repeat within it."""
    if not len(low):
        return np.zeros(0, bool)
    seeds = stop - start - SEED + 1
    first = np.concatenate([[0], np.cumsum(seeds)[:-1]])
    at = np.repeat(start - first, seeds) + np.arange(seeds.sum())
    return np.add.reduceat((h[at] == np.repeat(low, seeds)).astype(np.int64), first) > 1


def _batches_of(b, column: int, most: int = 1 << 21):
    """(first row, texts) in parts of about ``most`` bytes."""
    texts = [(t or "").encode() for t in b.column(column).to_pylist()]
    at = size = 0
    for k, t in enumerate(texts):
        size += len(t)
        if size > most or k + 1 == len(texts):
            yield at, texts[at:k + 1]
            at, size = k + 1, 0


def _bits(slots: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of the values of column slot (below ``bits``); bits / 8 bytes come to the driver."""
    at = F.col("slot") + 1
    maps = slots.select(F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("bit")).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("map"))
    out = np.zeros(bits // 8, np.uint8)
    for r in maps.collect():
        first = (r["bucket"] - 1) * (MAP_BITS // 8)
        out[first:first + MAP_BITS // 8] = np.frombuffer(r["map"], np.uint8)
    return out


def _is_set(bits: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _repeated_hashes(docs: DataFrame, length: int) -> np.ndarray:
    """Bits of the hashes that occur more than once in the corpus."""
    def run(batches):
        for b in batches:
            for _, texts in _batches_of(b, 0):
                _, h, low, _, start, stop = stretches(texts, length)
                low = np.concatenate([low, low[seen_again(h, low, start, stop)]])
                yield pa.RecordBatch.from_arrays([pa.array((low % np.uint64(BITMAP_BITS)).astype(np.int64))], ["slot"])

    slots = docs.select("text").mapInArrow(run, "slot long")
    return _bits(slots.groupBy("slot").agg(F.count("*").alias("n")).where("n > 1").select("slot"), BITMAP_BITS)


def repeated_stretches(texts: list[bytes], length: int, bits: np.ndarray):
    """As ``stretches``, of those whose hash occurs again, with their starts in their texts."""
    buf, h, low, doc, start, stop = stretches(texts, length)
    if len(low):
        hit = np.flatnonzero(_is_set(bits, low % np.uint64(BITMAP_BITS)))
        low, doc, start, stop = low[hit], doc[hit], start[hit], stop[hit]
    begin = start - np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)[doc]
    return buf, h, low, doc, start, stop, begin


def _firsts(docs: DataFrame, length: int, shared) -> DataFrame:
    """The earliest place of each distinct stretch whose hash occurs again: low, same, first (none, id, th, start), size, again."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        import xxhash

        bits = shared.value
        for b in batches:
            for at, texts in _batches_of(b, 2):
                buf, h, low, doc, start, stop, begin = repeated_stretches(texts, length, bits)
                if not len(low):
                    continue
                same = np.array([xxhash.xxh3_64_intdigest(buf[s:e]) for s, e in zip(start.tolist(), stop.tolist())], np.uint64)
                rows = pa.array(doc + at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(low.view(np.int64)), pa.array(same.view(np.int64)), b.column(0).take(rows), b.column(1).take(rows), pa.array(begin),
                     pa.array(stop - start), pa.array(seen_again(h, low, start, stop))], ["low", "same", "id", "th", "start", "size", "again"])

    rows = docs.select("id", "th", "text").mapInArrow(run, f"low long, same long, id {id_type}, th long, start long, size long, again boolean")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "th", "start")
    return stored(rows.groupBy("low", "same").agg(F.min(place).alias("first"), F.first("size").alias("size"), F.max("again").alias("again")), "firsts")


def _place_slots(doc_hash: np.ndarray, start: np.ndarray) -> np.ndarray:
    x = (doc_hash.astype(np.uint64) ^ (start.astype(np.uint64) * np.uint64(BASE))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(31))) % np.uint64(PLACE_BITS)


def _texts(docs: DataFrame, wanted: DataFrame, length: int, shared) -> DataFrame:
    """The bytes of the wanted first places (and of a few others): low, none, id, th, start, again, bytes.

    The places are known by a bitmap of fixed size; a place that it lets in
    beside the wanted ones is a further text of its hash and changes nothing.
    """
    id_type = docs.schema["id"].dataType.simpleString()

    def slots(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_place_slots(b.column(0).to_numpy(), b.column(1).to_numpy()).astype(np.int64))], ["slot"])

    places = wanted.select(F.xxhash64("first.id", "first.th").alias("doc_hash"), F.col("first.start").alias("start")).mapInArrow(slots, "slot long")
    chosen = docs.sparkSession.sparkContext.broadcast(_bits(places, PLACE_BITS))

    def run(batches):
        bits, places = shared.value, chosen.value
        for b in batches:
            for at, texts in _batches_of(b, 2):
                buf, h, low, doc, start, stop, begin = repeated_stretches(texts, length, bits)
                if not len(low):
                    continue
                hit = np.flatnonzero(_is_set(places, _place_slots(b.column(3).to_numpy()[doc + at], begin)))
                low, doc, start, stop, begin = low[hit], doc[hit], start[hit], stop[hit], begin[hit]
                rows = pa.array(doc + at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(low.view(np.int64)), b.column(0).take(rows), b.column(1).take(rows), pa.array(begin), pa.array(seen_again(h, low, start, stop)),
                     pa.array([buf[s:e] for s, e in zip(start.tolist(), stop.tolist())], pa.binary())], ["low", "id", "th", "start", "again", "bytes"])

    d = docs.select("id", "th", "text", F.xxhash64("id", "th").alias("doc_hash"))
    return d.mapInArrow(run, f"low long, id {id_type}, th long, start long, again boolean, bytes binary").withColumn("none", F.col("id").isNull())


class RunLengthIndex:
    """Run-length compressed Burrows-Wheeler transform of some texts, with samples at the runs."""

    def __init__(self, texts: list[bytes]):
        m = len(texts)
        sizes = np.array([len(t) + 1 for t in texts])
        self.ends = np.cumsum(sizes) - 1
        self.text = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int64) + m
        self.text[self.ends] = np.arange(m)  # each end sorts before all bytes and differs from all others
        self.n = len(self.text)
        levels = self._sort(m + 256)
        rows = self.rows  # suffixes in order
        before = self.text[rows - 1]
        head = np.ones(self.n, bool)
        head[1:] = before[1:] != before[:-1]
        self.run_rows = np.flatnonzero(head)  # first row of each run
        self.run_symbols = before[self.run_rows]
        self.samples = rows[self.run_rows]
        self.lengths = np.concatenate([[0], self._common(levels, rows[self.run_rows[1:] - 1], rows[self.run_rows[1:]])])

    def _sort(self, alphabet: int) -> list[tuple[int, np.ndarray]]:
        """Sort suffixes by prefixes of growing length; keeps (length, ranks) of each step."""
        rank, span, top = self.text, 1, alphabet
        levels = [(1, rank)]
        while True:
            parts = max(2, int(62 // max(top.bit_length(), 1)))
            key = rank.copy()
            for k in range(1, parts):
                key *= top + 1
                if k * span < self.n:
                    key[:-k * span] += rank[k * span:] + 1
            order = np.argsort(key)
            fresh = np.ones(self.n, bool)
            fresh[1:] = key[order[1:]] != key[order[:-1]]
            rank = np.empty(self.n, np.int64)
            rank[order] = np.cumsum(fresh) - 1
            span *= parts
            top = int(rank[order[-1]]) + 1
            levels.append((span, rank))
            if top == self.n:
                self.rows = order
                return levels

    def _common(self, levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of suffix pairs, from the ranks of the sorting steps."""
        done = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            span, rank = levels[k]
            live = np.arange(len(a))
            while len(live):
                x, y = a[live] + done[live], b[live] + done[live]
                ok = (x < self.n) & (y < self.n)
                live, x, y = live[ok], x[ok], y[ok]
                live = live[rank[x] == rank[y]]
                done[live] += span
        return done

    def matching_statistics(self) -> np.ndarray:
        """At each text position, the length of the match with the suffix sorted before it."""
        reach = np.zeros(self.n, np.int64)
        reach[self.samples] = self.samples + self.lengths
        return np.maximum(np.maximum.accumulate(reach) - np.arange(self.n), 0)

    def later_windows(self, place: np.ndarray, length: int) -> np.ndarray:
        """Positions of windows equal to a window of smaller ``place``."""
        long = self.matching_statistics() >= length
        in_order = long[self.rows]
        heads = np.flatnonzero(~in_order)
        least = np.minimum.reduceat(place[self.rows], heads)
        first = np.empty(self.n, np.int64)
        first[self.rows] = np.repeat(least, np.diff(np.append(heads, self.n)))
        out = first < place
        # a class of one has its own place as the least
        return np.flatnonzero(out)


def spans_of(positions: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of consecutive window positions, as byte spans."""
    if not len(positions):
        return positions, positions
    new = np.ones(len(positions), bool)
    new[1:] = np.diff(positions) > 1
    starts = np.flatnonzero(new)
    lasts = np.append(starts[1:], len(positions)) - 1
    return positions[starts], positions[lasts] + length


def _indexed_spans(texts: DataFrame, length: int, id_type: str) -> DataFrame:
    """Removed spans within the earliest places of the distinct texts; ``texts``: low, id, none, th, start, again, bytes."""
    sorted_texts = texts.repartition("low").sortWithinPartitions("low")

    def work(rows: list[tuple]):
        """rows: (none, id, th, start, bytes) of whole hashes"""
        docs = sorted({(r[0], r[1] if r[1] is not None else 0, r[2]) for r in rows})
        number = {d: k for k, d in enumerate(docs)}
        index = RunLengthIndex([r[4] for r in rows])
        firsts = np.concatenate([[0], index.ends[:-1] + 1])
        base = np.array([(number[(r[0], r[1] if r[1] is not None else 0, r[2])] << 40) + r[3] for r in rows], np.int64)
        of = np.repeat(np.arange(len(rows)), np.diff(np.append(firsts, index.n)))
        place = base[of] + np.arange(index.n) - firsts[of]
        late = index.later_windows(place, length)
        # consecutive windows never run over the end of a text: no window starts in a text's last bytes
        s, e = spans_of(late, length)
        for x, y in zip(s.tolist(), e.tolist()):
            r = rows[of[x]]
            yield r[1], r[2], r[3] + x - int(firsts[of[x]]), r[3] + y - int(firsts[of[x]])

    def emit(found: list[tuple]):
        cols = list(zip(*found)) if found else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(cols[0], kind), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                                          ["id", "th", "begin", "end"])

    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(texts.schema["id"].dataType)

    def run(batches):
        held, group, size, low, repeats = [], [], 0, None, False
        for b in batches:
            c = [b.column(k).to_pylist() for k in ("low", "none", "id", "th", "start", "bytes", "again")]
            for h, none, i, th, start, data, again in zip(*c):
                if h != low:
                    if len(group) > 1 or repeats:
                        held += group
                        size += sum(len(g[4]) for g in group)
                        if size > BLOCK_BYTES:
                            yield emit(list(work(held)))
                            held, size = [], 0
                    group, low, repeats = [], h, False
                group.append((none, i, th, start, data))
                repeats = repeats or again
        if len(group) > 1 or repeats:
            held += group
        if held:
            yield emit(list(work(held)))

    return sorted_texts.select("low", "none", "id", "th", "start", "bytes", "again").mapInArrow(run, f"id {id_type}, th long, begin long, end long")


def _hot_spans(texts: DataFrame, length: int, id_type: str) -> DataFrame:
    """The same for hashes with too many bytes for one task: each window goes under its own hash."""
    def run(batches):
        import xxhash

        for b in batches:
            for k in range(b.num_rows):
                data = b.column("bytes")[k].as_py()
                n = len(data) - length + 1
                row = pa.array([k] * n)
                start = b.column("start")[k].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_128_digest(data[x:x + length]) for x in range(n)], pa.binary()), b.column("none").take(row), b.column("id").take(row),
                     b.column("th").take(row), pa.array(range(start, start + n), pa.int64())], ["window", "none", "id", "th", "start"])

    windows = texts.mapInArrow(run, f"window binary, none boolean, id {id_type}, th long, start long")
    first = windows.groupBy("window").agg(F.min(F.struct("none", "id", "th", "start")).alias("first"))
    late = windows.join(first, "window").where(~F.struct("none", "id", "th", "start").eqNullSafe(F.col("first")))
    return late.select("id", "th", F.col("start").alias("begin"), (F.col("start") + length).alias("end"))


def remove_long_matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256, spans (removed byte ranges) and kept (the bytes left)."""
    if length < SEED + 1:
        raise ValueError(f"length must be over {SEED} bytes")
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("th"), F.col(text_col).cast("string").alias("text"))
    id_type = d.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(_repeated_hashes(d, length))
    firsts = _firsts(d, length, shared)
    # texts whose windows may equal others: hashes with several of them, or one that repeats itself
    several = (firsts.groupBy("low").agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.max("again").alias("again"))
               .where("n > 1 or again").select("low", (F.col("size") > HOT_BYTES).alias("hot")))
    texts = _texts(d, firsts.join(several, "low", "left_semi"), length, shared)
    hot = several.where("hot")
    spans = _indexed_spans(texts.join(hot, "low", "left_anti"), length, id_type).unionByName(
        _hot_spans(texts.join(hot, "low", "left_semi"), length, id_type))
    # per document, at most as many rows as it has windows; a span of a first place has no end
    known = (spans.unionByName(firsts.select("first.id", "first.th", F.col("first.start").alias("begin"), F.lit(None).cast("long").alias("end")))
             .groupBy("id", "th").agg(F.collect_list(F.struct("begin", "end")).alias("spans")))
    joined = d.alias("d").join(known.alias("s"), F.col("d.id").eqNullSafe(F.col("s.id")) & (F.col("d.th") == F.col("s.th")), "left").select(
        "d.id", "d.text", "s.spans")

    def all_spans(texts, found):
        """(begin, end) per text: those found, and the repeated stretches that are no first place."""
        out, first = [], []
        for f in found:
            own, starts = [], set()
            if f.is_valid:
                flat = f.values.flatten()
                for s, e in zip(flat[0].to_pylist(), flat[1].to_pylist()):
                    if e is None:
                        starts.add(s)
                    else:
                        own.append((s, e))
            out.append(own)
            first.append(starts)
        _, _, _, doc, start, stop, begin = repeated_stretches(texts, length, shared.value)
        for k, s, n in zip(doc.tolist(), begin.tolist(), (stop - start).tolist()):
            if s not in first[k]:
                out[k].append((s, s + n))
        return out

    def run(batches):
        kinds = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            ids, found = b.column(0), b.column(2)
            for at, part in _batches_of(b, 1):
                out = []
                for data, own in zip(part, all_spans(part, found.slice(at, len(part)))):
                    merged: list[list[int]] = []
                    for s, e in sorted(own):
                        if merged and s <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], e)
                        else:
                            merged.append([s, e])
                    kept, last = [], 0
                    for s, e in merged:
                        kept.append(data[last:s])
                        last = e
                    kept.append(data[last:])
                    left = b"".join(kept)
                    out.append((len(data), len(data) - len(left), len(merged), hashlib.sha256(left).hexdigest(),
                                [{"begin": s, "end": e} for s, e in merged], left))
                c = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, len(part)), *(pa.array(c[k], pa.int64()) for k in range(3)), pa.array(c[3]), pa.array(c[4], kinds), pa.array(c[5], pa.binary())],
                    ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])

    out = joined.mapInArrow(run, f"id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<begin:long,end:long>>, kept binary")
    return out.withColumnRenamed("id", id_col)
