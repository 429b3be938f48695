"""Benchmark decontamination by latent semantic retrieval.

Texts are read once, as words (letters and digits, lower case; hashed where they lie), which are
stored by their hashes; all passes go over those.  Words are taken in blocks of
``BLOCK`` words; a passage is two neighbouring blocks.  Words are hashed into
``SLOTS`` slots and weighted by inverse document frequency, counted over all
blocks of the corpus.

1. The latent space: the leading right singular vectors of the weighted
   matrix of passages, by a randomised subspace iteration.  Each product with
   the matrix is a Spark job over its rows, which returns sums of fixed size
   (SLOTS x RANK).  The rows are all passages of all documents and those of the
   benchmark items, which are weighted to half of the whole.
2. Search: every passage of every document is mapped into that space; pairs
   with an item are candidates if the passage's weight along the item is at
   least ``SHARE * min_lcs`` of the item's own, or their cosine at least
   ``min_cosine``.  The first needs no guess of how much of a passage an item
   fills, so it holds for short items too.  An item longer than a passage asks
   with each of its own passages, a block apart; all lead to the item's one check.
   Items are the stated query set, taken in blocks of about ``ITEMS_AT_ONCE`` such passages.
   Candidates whose words around, hashed into ``BITS`` bits, cannot hold
   ``min_lcs`` of the item's words are left before the checks.
3. Checks on the words around the passage, common words left out: the longest
   common subsequence with the item must hold ``min_lcs`` of the item's words,
   and that with the item's answer (its last sentence) ``min_answer`` of the
   answer's words.  Reworded passages pass as long as most words stay in order.

Defined results:
* null and empty texts, and texts without a letter or digit, match nothing; so
  do such items;
* repeated documents are each judged; repeated items (equal id) are one answer;
* an item with common words only is compared on all its words;
* very long texts are read whole; an empty table on either side finds nothing;
* other columns of both tables do not take part.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figpairs.llm.common import by_bytes, joined_by_bytes, stored, without_ids, worker_cache

BLOCK = 24
SLOTS = 1 << 15
BATCH_BYTES = 1 << 20
FIT_BYTES = 1 << 18  # of stored slots that are fitted at once
RANK = 96
CHUNK = 1024
ITEMS_AT_ONCE = 20_000
COMMON = 0.01  # a word in more of the blocks than this is common
SHARE = 0.5  # other words of the passage may take away half of an item's least weight
BITS = 1024  # of the words around a passage
FAR = 16  # blocks on either side; beyond it the bits are full
ODD_WORDS = 200_000  # words beyond ASCII that a worker looks up again
SENTENCE = re.compile(r"[.!?\n]+")


_POWER = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_SPACE = b" \t\n\x0b\x0c\r"
_GAP = re.compile(rb"[\t-\r ]")
_LOWER = bytes(range(256)).lower()
_MARKS = bytes(c for c in range(128) if not bytes([c]).isalnum() and c not in _SPACE)  # ASCII that is part of no word


def plain(word: bytes) -> str:
    w = word.translate(_LOWER, _MARKS).decode().lower()
    return w if w.isalnum() else "".join(filter(str.isalnum, w))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of ``_POWER`` and of its inverse, kept per worker."""
    held = worker_cache("latent")
    if len(held.get("powers", ((),))[0]) < n:
        size = max(2 * n, 1 << 16)
        ones = [np.full(size, x, np.uint64) for x in (_POWER, pow(_POWER, -1, 1 << 64))]
        for x in ones:
            x[0] = 1
            np.multiply.accumulate(x, out=x)
        held["powers"] = tuple(ones)
    return held["powers"]


def _hashes(line: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each word: a polynomial in them, from prefix sums, then mixed."""
    power, back = _powers(len(line) + 1)
    sums = np.zeros(len(line) + 1, np.uint64)
    np.cumsum((line + np.uint64(1)) * power[:len(line)], out=sums[1:])
    h = (sums[end] - sums[start]) * back[start]
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h ^= h >> np.uint64(33)
        h *= np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def _words(line: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, whether it has a letter or digit, first byte) of each word of ``line``, which is lower-case and without ``_MARKS``."""
    parts, at = [], 0
    while at < len(line) or not parts:  # a long text in pieces that end between words
        gap = _GAP.search(line, at + BATCH_BYTES)
        stop = gap.end() if gap else len(line)
        h, known, start = _words_at_once(line[at:stop])
        parts.append((h, known, start + at))
        at = stop
    return parts[0] if len(parts) == 1 else tuple(map(np.concatenate, zip(*parts)))


def _words_at_once(line: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a = np.frombuffer(line, np.uint8)
    inside = np.zeros(len(a) + 2, np.int8)
    inside[1:-1] = a > 0x20
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    h, known = _hashes(a.astype(np.uint64), start, end), np.ones(len(start), bool)
    if not line.isascii():
        high = np.concatenate([[0], np.cumsum(a >= 0x80)])
        odd = np.flatnonzero(high[end] > high[start])
        names = [line[s:e] for s, e in zip(start[odd].tolist(), end[odd].tolist())]
        h[odd], known[odd] = _odd_words(names)
    return h, known, start


def _odd_words(names: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of words beyond ASCII as their plain form, and whether it has a letter or digit; looked up per worker."""
    held = worker_cache("latent").setdefault("odd", {})
    new = {w for w in names if w not in held}
    if len(held) + len(new) > ODD_WORDS:
        held.clear()
        new = set(names)
    if new:
        forms = [plain(w).encode() for w in sorted(new)]
        ends = np.cumsum([len(f) for f in forms])
        h = _hashes(np.frombuffer(b"".join(forms), np.uint8).astype(np.uint64), ends - [len(f) for f in forms], ends)
        held.update(zip(sorted(new), zip(h.tolist(), [bool(f) for f in forms])))
    got = [held[w] for w in names]
    return np.array([g[0] for g in got], np.uint64), np.array([g[1] for g in got], bool)


def slots_and_keys(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A word's slot, and the 24 bits of its hash that name it in the checks."""
    return (h % np.uint64(SLOTS)).astype(np.int64), (h >> np.uint64(40)).astype(np.int64)


def _blocks(texts: list[bytes]):
    """(slots and keys of all words that have one, block of each, document of each block, first word of each document)."""
    lines = [t.translate(_LOWER, _MARKS) for t in texts]
    h, known, start = _words(b"\n".join(lines))
    begins = np.cumsum([0, *(len(x) + 1 for x in lines)])
    if not known.all():
        h, start = h[known], start[known]
    first = np.searchsorted(start, begins)
    slot, key = slots_and_keys(h)
    return slot, key, *_layout(first), first


def _layout(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(block of each word, document of each block), from the first word of each document and the end."""
    n_words = np.diff(first)
    n_blocks = -(-n_words // BLOCK)
    place = np.arange(first[-1]) - np.repeat(first[:-1], n_words)
    return np.repeat(np.cumsum(n_blocks) - n_blocks, n_words) + place // BLOCK, np.repeat(np.arange(len(n_words)), n_blocks)


WORDS = "slots binary, low binary, high binary"


def _cells(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """The values as one binary cell a document."""
    return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer((first * values.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _hashed(texts: DataFrame, label: str) -> DataFrame:
    """``texts`` (id, text) with the words in place of the text: their slots and, in two cells, their keys.  No cell is longer than its text was."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = texts.schema["id"].dataType
    arrow = to_arrow_type(kind)

    def run(batches):
        for b in by_bytes(batches, 1, BATCH_BYTES, 256):
            slot, key, _, _, first = _blocks([t or b"" for t in b.column(1).to_pylist()])
            parts = slot.astype("<u2"), (key & 0xFFFF).astype("<u2"), (key >> 16).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(arrow), *(_cells(x, first) for x in parts)], ["id", "slots", "low", "high"])

    return stored(texts.select("id", F.col("text").cast("binary")).mapInArrow(run, f"id {kind.simpleString()}, {WORDS}"), label)


def _joined(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of all cells, and where each cell's values begin (and the last ones end)."""
    cells = column.to_pylist()
    return np.frombuffer(b"".join(cells), kind), np.cumsum([0, *map(len, cells)]) // np.dtype(kind).itemsize


def _grid(values: np.ndarray, block: np.ndarray, n: int, empty: int) -> np.ndarray:
    """[n, BLOCK]: the values of each block's words; short blocks are filled up with ``empty``."""
    heads = np.searchsorted(block, np.arange(n))
    out = np.full((n, BLOCK), empty, values.dtype)
    out[block, np.arange(len(values)) - heads[block]] = values
    return out


def _frequencies(words: DataFrame) -> tuple[np.ndarray, int]:
    """(blocks that hold each slot, number of blocks) over the whole corpus."""
    def run(batches):
        n, total = np.zeros(SLOTS + 1, np.int64), 0
        for b in by_bytes(batches, 0, BATCH_BYTES // 3, 256):
            slot, first = _joined(b.column(0), "<u2")
            block, docs_ = _layout(first)
            rows = np.sort(_grid(slot, block, len(docs_), SLOTS), axis=1)
            rows[:, 1:][rows[:, 1:] == rows[:, :-1]] = SLOTS  # each slot of a block counts once
            n += np.bincount(rows.ravel(), minlength=SLOTS + 1)
            total += len(docs_)
        n = n[:SLOTS]
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, SLOTS)), pa.array(np.append(n[at], total))], ["slot", "n"])

    rows = words.select("slots").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()  # SLOTS + 1 rows at most
    out = np.zeros(SLOTS + 1, np.int64)
    for r in rows:
        out[r["slot"]] = r["n"]
    return out[:SLOTS], int(out[SLOTS])


def _orthonormal(product: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the columns' space, by the RANK x RANK matrix of their products; nothing else of
    the matrix's size is made.  Columns beyond its rank are 0."""
    for _ in range(2):  # the second time takes off what rounding left
        gram = np.zeros((RANK, RANK))
        for at in range(0, SLOTS, CHUNK):
            part = product[at:at + CHUNK].astype(np.float64)
            gram += part.T @ part
        size, axes = np.linalg.eigh(gram)
        held = size > 1e-12 * max(size[-1], 1e-300)
        turn = np.where(held, axes / np.sqrt(np.where(held, size, 1)), 0)
        for at in range(0, SLOTS, CHUNK):
            product[at:at + CHUNK] = product[at:at + CHUNK].astype(np.float64) @ turn
    return product


def _added(rows: np.ndarray, at, n: np.ndarray) -> np.ndarray:
    """Sums of ``n`` of the ``rows``, ``at(k, p)`` being the p-th of each of the sums in ``k``; ``n`` falls and is at least 1."""
    out = np.empty((len(n), RANK), np.float32)
    held = np.empty((min(len(n), CHUNK), RANK), np.float32)
    for start in range(0, len(n), CHUNK):
        part = out[start:start + CHUNK]
        rows.take(at(slice(start, start + len(part)), 0), axis=0, out=part, mode="clip")
        for p in range(1, int(n[start])):
            m = np.searchsorted(-n[start:start + len(part)], -p)
            part[:m] += rows.take(at(slice(start, start + m), p), axis=0, out=held[:m], mode="clip")
    return out


def add_rows(out: np.ndarray, slot: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Adds ``rows[at]`` to ``out[slot]``, where slots repeat: rows of one slot are added up by ``BLOCK`` until each slot has one."""
    while len(slot):
        order = np.argsort(slot, kind="stable")
        slot, at = slot[order], at[order]
        heads = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        count = np.diff(np.append(heads, len(slot)))
        begins = np.flatnonzero((np.arange(len(slot)) - np.repeat(heads, count)) % BLOCK == 0)
        n = np.diff(np.append(begins, len(slot)))
        falls = np.argsort(-n, kind="stable")
        begins, n = begins[falls], n[falls]
        rows = _added(rows, lambda k, p: at[begins[k] + p], n)
        last = np.repeat(count <= BLOCK, -(-count // BLOCK))[falls]
        done, slot = slot[begins[last]], slot[begins[~last]]
        new = out.take(done, axis=0)
        new += rows[last]
        out[done] = new
        at = np.flatnonzero(~last)


def _sums(latent: np.ndarray, grid: np.ndarray) -> np.ndarray:
    """The sum of each block's rows of ``latent``."""
    return _added(latent, lambda k, p: grid[k, p], np.full(len(grid), BLOCK))


def passages(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of blocks with these documents: those that begin a passage, and whether the next block is part of it.  A document of one block is one passage."""
    goes_on = np.append(doc[1:] == doc[:-1], False)
    alone = np.concatenate([[True], doc[1:] != doc[:-1]])
    use = np.flatnonzero(goes_on | alone)
    return use, goes_on[use]


def squared(grid: np.ndarray, use: np.ndarray, two: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Squared length of each passage's row, counts of slots times their weight (one more row of weights, 0)."""
    square = np.square(weight)
    own = square[grid].sum(1, dtype=np.float64)
    out = own[use]
    out[two] += own[use[two] + 1]
    both = np.full((len(use), 2 * BLOCK), SLOTS, grid.dtype)
    both[:, :BLOCK] = grid[use]
    both[two, BLOCK:] = grid[use[two] + 1]
    both.sort(axis=1)
    row, place = np.divmod(np.flatnonzero((both[:, 1:] == both[:, :-1]) & (both[:, 1:] < SLOTS)), 2 * BLOCK - 1)
    if not len(row):
        return out
    # the n-th place of a slot beyond its first adds 2 n of its squares
    begins = np.concatenate([[True], (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)])
    nth = np.arange(len(row)) - np.flatnonzero(begins)[np.cumsum(begins) - 1] + 1
    return out + np.bincount(row, 2.0 * nth * square[both[row, place]], len(use))


def n_passages(words: DataFrame) -> int:
    blocks = F.ceil(F.length("slots") / (2 * BLOCK))
    return words.agg(F.sum(F.when(blocks > 0, F.greatest(blocks - 1, F.lit(1))))).first()[0] or 0


def _latent(fit: DataFrame, idf: np.ndarray, rounds: int = 3) -> np.ndarray:
    """[SLOTS, RANK]: an orthonormal basis of the leading right singular space; ``fit``: a document's slots, the weight of its passages."""
    sc = fit.sparkSession.sparkContext
    basis = _orthonormal(np.random.default_rng(3).standard_normal((SLOTS, RANK), np.float32))
    # a task returns SLOTS x RANK numbers, so there are no more tasks than run at once
    fit = fit.coalesce(max(4, sc.defaultParallelism))

    def add(pdf):
        import pandas as pd

        total = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in pdf["part"])
        return pd.DataFrame({"chunk": [pdf["chunk"].iloc[0]], "part": [total.astype(np.float32).tobytes()]})

    for _ in range(rounds):
        shared = sc.broadcast((basis, idf))

        def run(batches):
            omega, weight = shared.value
            weight = np.append(weight, np.float32(0))
            latent = np.vstack([omega, np.zeros((1, RANK), np.float32)])
            latent *= weight[:, None]  # short blocks end with the row of zeros
            out = np.zeros((SLOTS, RANK), np.float32)
            for b in joined_by_bytes(batches, 0, FIT_BYTES):
                slot, first = _joined(b.column(0), "<u2")
                if not len(slot):
                    continue
                block, doc = _layout(first)
                grid = _grid(slot, block, len(doc), SLOTS)
                use, two = passages(doc)
                e = _sums(latent, grid)
                row = e[use]
                row[two] += e[use[two] + 1]
                scale = np.asarray(b.column(1))[doc[use]]
                row *= (np.square(scale) / np.maximum(squared(grid, use, two, weight), 1e-18)).astype(np.float32)[:, None]
                e[:] = 0
                e[use] = row
                e[use[two] + 1] += row[two]
                add_rows(out, slot, block, e)
            out *= weight[:SLOTS, None]
            chunks = range(0, SLOTS, CHUNK)
            yield pa.RecordBatch.from_arrays([pa.array([k // CHUNK for k in chunks], pa.int64()), pa.array([out[k:k + CHUNK].tobytes() for k in chunks], pa.binary())],
                                             ["chunk", "part"])

        parts = fit.mapInArrow(run, "chunk long, part binary").groupBy("chunk").applyInPandas(add, "chunk long, part binary")
        basis[:] = 0
        for r in parts.toLocalIterator():  # SLOTS x RANK numbers in all, a partition at a time
            basis[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(r["part"], np.float32).reshape(-1, RANK)
        shared.destroy()
        basis = _orthonormal(basis)
    return basis


def lcs(masks: dict, words: list, size: int) -> int:
    """Length of the longest common subsequence, by bit-parallel steps; ``masks``: word -> its places in the other text."""
    full = (1 << size) - 1
    v = full
    for w in words:
        m = masks.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return size - bin(v).count("1")


def bitmaps(row: np.ndarray, key: np.ndarray, rows: int) -> np.ndarray:
    """[rows, BITS / 64]: bit ``key`` modulo BITS set in each ``row``."""
    out = np.zeros((rows, BITS // 64), np.uint64)
    np.bitwise_or.at(out, (row, key % BITS // 64), np.left_shift(np.uint64(1), (key % 64).astype(np.uint64)))
    return out


def widened(bits: np.ndarray, reach: list[int]) -> dict[int, np.ndarray]:
    """Per number r of ``reach``, the bits of each block, the next one and r on either side (also of neighbouring texts)."""
    n, out = len(bits), {}
    wide = bits.copy()
    wide[:-1] |= bits[1:]
    for r in range(max(reach, default=-1) + 1):
        if 0 < r < n:
            wide[r:] |= bits[:n - r]
        if 0 < r < n - 1:
            wide[:n - r - 1] |= bits[r + 1:]
        if r in reach:
            out[r] = wide.copy()
    return out


def passages_of(slots: list) -> list[list]:
    """An item's words, or if they are more than a passage its passages a block apart."""
    last = max(0, len(slots) - 2 * BLOCK)
    return [slots[k:k + 2 * BLOCK] for k in [*range(0, last, BLOCK), last]]


class Item:
    """A benchmark item's words, by their keys, for the checks."""

    def __init__(self, text: str, common: np.ndarray):
        def words(t: str) -> list[tuple[int, int]]:
            slot, key, *_ = _blocks([t.encode()])
            return list(zip(slot.tolist(), key.tolist()))

        def rare(ws: list[tuple[int, int]]) -> list[int]:
            return [key for slot, key in ws if not common[slot]] or [key for _, key in ws]

        self.slots = [slot for slot, _ in words(text)]
        own = rare(words(text))
        sentences = [ws for s in SENTENCE.split(text) if (ws := words(s))]
        answer = rare(sentences[-1]) if sentences else []
        self.n, self.masks = len(own), self._masks(own)
        self.answer_n, self.answer_masks = len(answer), self._masks(answer)
        self.around = len(self.slots) + 4

    def bits(self, min_lcs: float) -> tuple[np.ndarray, float]:
        """The bits of its words, and how many of them a text must have to pass the checks."""
        out = bitmaps(np.zeros(len(self.masks), np.int64), np.fromiter(self.masks, np.int64), 1)[0]
        # words beyond one a bit may all be there
        return out, min_lcs * self.n - (self.n - int(np.bitwise_count(out).sum())) - 1e-6

    @staticmethod
    def _masks(words: list) -> dict:
        out: dict = {}
        for k, w in enumerate(words):
            out[w] = out.get(w, 0) | 1 << k
        return out

    def check(self, words: list, min_lcs: float) -> tuple[float, float]:
        """Shares of the item and of its answer in order in ``words``; 0 where too few of its words occur at all."""
        if sum(w in self.masks for w in words) < min_lcs * self.n:
            return 0.0, 0.0
        return lcs(self.masks, words, self.n) / self.n, lcs(self.answer_masks, words, self.answer_n) / self.answer_n


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               min_cosine: float = 0.4, min_lcs: float = 0.6, min_answer: float = 0.5) -> DataFrame:
    """(id, item_id, cosine, lcs, answer): documents that hold an item, one row per document row and item; the cosine is that with the nearest passage of the item."""
    d = _hashed(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), "latent-words")
    q = items.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text")).where("text is not null")
    id_type, item_type = (x.schema[c].dataType for x, c in ((d, "id"), (q, "item")))
    freq, total = _frequencies(d)
    idf = np.log((total + 1) / (freq + 0.5)).astype(np.float32)
    common = freq > COMMON * total

    asked = _hashed(q.select(F.lit(0).alias("id"), "text"), "latent-items")
    n_asked = n_passages(asked)
    weight = float(np.sqrt(max(n_passages(d), 1) / max(n_asked, 1)))
    basis = _latent(d.select("slots", F.lit(1.0).alias("weight")).unionByName(asked.select("slots", F.lit(weight).alias("weight"))), idf)
    mapping = basis
    mapping *= idf[:, None]

    n_asks = q.agg(F.sum(1 + F.floor(F.size(F.split("text", r"\s+")) / BLOCK))).first()[0] or 0
    blocks = max(1, -(-n_asks // ITEMS_AT_ONCE))
    found = None
    for k in range(blocks):
        part = [(r["item"], r["text"]) for r in q.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).collect()]
        hits = _search(d, part, mapping, common, id_type, item_type, min_cosine, min_lcs, min_answer)
        found = hits if found is None else found.unionByName(hits)
    return found.withColumnRenamed("id", id_col).withColumnRenamed("item", item_col)


def _may_hold(xs: np.ndarray, asks: np.ndarray, owner: np.ndarray, use: np.ndarray, around: dict[int, np.ndarray], reach: np.ndarray, bits: np.ndarray, need: np.ndarray):
    """The pairs of a passage and an item's passage whose bits leave room for enough of the item's words."""
    for at in range(0, len(xs), 1 << 16):
        x, ask = xs[at:at + (1 << 16)], asks[at:at + (1 << 16)]
        item = owner[ask]
        stays = reach[item] > FAR
        for r, wide in around.items():
            of = np.flatnonzero(reach[item] == r)
            stays[of] = np.bitwise_count(wide[use[x[of]]] & bits[item[of]]).sum(1, dtype=np.int64) >= need[item[of]]
        yield from zip(x[stays].tolist(), ask[stays].tolist())


def _search(d: DataFrame, items: list, mapping: np.ndarray, common: np.ndarray, id_type, item_type, min_cosine: float, min_lcs: float, min_answer: float) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type

    kept, vectors, owner, marks = [], [], [], []
    for item, text in sorted(items, key=lambda x: (x[0] is None, x[0], x[1])):
        it = Item(text, common)
        if it.slots:
            asks = [v for part in passages_of(it.slots) if np.linalg.norm(v := mapping[part].sum(0)) > 0]
            vectors += asks
            owner += [len(kept)] * len(asks)
            kept.append((item, text))
            marks.append((-(-it.around // BLOCK), *it.bits(min_lcs)))
    lengths = np.linalg.norm(np.array(vectors, np.float32).reshape(-1, RANK), axis=1)
    queries = np.array(vectors, np.float32).reshape(-1, RANK) / lengths[:, None] ** 2
    shared = d.sparkSession.sparkContext.broadcast((kept, queries, lengths, np.array(owner, np.int64), marks, np.vstack([mapping, np.zeros((1, RANK), np.float32)]), common))
    kinds = to_arrow_type(id_type), to_arrow_type(item_type)

    def run(batches):
        asked, queries, lengths, owner, marks, latent, often = shared.value
        reach = np.array([m[0] for m in marks], np.int64)
        bits = np.array([m[1] for m in marks], np.uint64).reshape(-1, BITS // 64)
        need = np.array([m[2] for m in marks])
        reaches = [r for r in np.unique(reach).tolist() if r <= FAR]
        checks: dict[int, Item] = {}
        for b in by_bytes(batches, 1, BATCH_BYTES // 3):
            out = []
            for at in range(0, b.num_rows if len(queries) else 0, 128):
                part = b.slice(at, 128)
                slot, first = _joined(part.column(1), "<u2")
                if not len(slot):
                    continue
                key = _joined(part.column(2), "<u2")[0] | _joined(part.column(3), np.uint8)[0].astype(np.int64) << 16
                block, doc = _layout(first)
                heads = np.searchsorted(block, np.arange(len(doc)))
                e = _sums(latent, _grid(slot, block, len(doc), SLOTS))  # short blocks end with the row of zeros
                use, two = passages(doc)
                pair = e[use]
                pair[two] += e[use[two] + 1]
                norm = np.maximum(np.linalg.norm(pair, axis=1), 1e-9)
                around = widened(bitmaps(block, key, len(doc)), reaches)
                best: dict[tuple[int, int], tuple] = {}
                got_at: dict[tuple[int, int], tuple] = {}
                step = max(1, (1 << 20) // len(queries))
                for p in range(0, len(pair), step):
                    share = pair[p:p + step] @ queries.T  # of the item's weight
                    xs, asks = np.nonzero(share >= np.minimum(np.float32(SHARE * min_lcs), norm[p:p + step, None] * (np.float32(min_cosine) / lengths)))
                    for x, ask in _may_hold(xs, asks, owner, use[p:p + step], around, reach, bits, need):
                        item = int(owner[ask])
                        cosine = float(share[x, ask] * lengths[ask] / norm[p + x])
                        k = use[p + x]
                        i = int(doc[k])
                        check = checks.get(item)
                        if check is None:
                            check = checks[item] = Item(asked[item][1], often)
                        stop = heads[k + 2] if k + 2 < len(doc) else len(slot)
                        if (k, item) not in got_at:  # passages of one item share a check
                            got_at[k, item] = check.check(key[max(first[i], heads[k] - check.around):min(first[i + 1], stop + check.around)].tolist(), min_lcs)
                        got = got_at[k, item]
                        if got[0] >= min_lcs and got[1] >= min_answer:
                            found = (got[0], got[1], cosine)
                            best[i, item] = max(best.get((i, item), found), found)
                out += [(at + i, item, *v) for (i, item), v in sorted(best.items())]
            rows = pa.array([o[0] for o in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(rows).cast(kinds[0]), pa.array([asked[o[1]][0] for o in out], kinds[1]), pa.array([o[4] for o in out], pa.float64()),
                 pa.array([o[2] for o in out], pa.float64()), pa.array([o[3] for o in out], pa.float64())], ["id", "item", "cosine", "lcs", "answer"])

    return d.mapInArrow(run, f"id {id_type.simpleString()}, item {item_type.simpleString()}, cosine double, lcs double, answer double")


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; rows of one id (null is one id) stay or go together."""
    return without_ids(docs, id_col, find_leaks(docs, items, id_col, text_col, **options).select(id_col))
