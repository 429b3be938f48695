"""Runs of periodic words by a suffix automaton with link-cut access.

A run is a stretch of words with smallest period q that no neighbouring word
extends, of length max(6, 4 * q) or more.

1. Words become numbers.  A position is alive while the three words from it
   come again within a third of the alive stretch it is in; that is repeated
   until nothing changes.  The starts in a run, but for its last q + 2 words,
   are such a stretch, so every run is whole in a stretch plus what one more
   period may add, and the rest of a text (most of it) is passed over at the
   speed of numpy.  No run is lost, whatever the hashes of three words do.
2. A suffix automaton is built of each such piece.  Then its prefixes are
   taken in order: the path of the i-th prefix's state to the root of the link
   tree is *accessed* and takes the colour i.  Each stretch of the path that had
   one colour p before ends the longest suffix that last ended at p; where its
   length l is q = i - p or more it is a square, and the words from i - l - q + 1
   to i have the smallest period q and cannot be extended to the left.  The
   squares of one start and period are a run; its last one is the run's end.
   As in a link-cut tree, accesses cost O(log n) changes of colour each.  The link
   tree does not change any more, so its preferred paths are kept as stacks of
   colours over its heavy chains, not as splay trees.

Defined results:
* null and empty texts and texts without words: no words, no runs;
* a null id counts as none: its text is taken as it is (see ``disturbed``);
* repeated rows are rows of their own; ties of length go to the smallest start,
  then the smallest period; an empty table gives an empty result;
* texts are read whole, a batch at a time of at most ``BATCH_BYTES`` of text (or one longer text);
* other columns do not take part.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figpairs.llm.common import by_bytes

BATCH_BYTES = 4 << 20
LEAST = 6
TIMES = 4


def suffix_automaton(word: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(link, length) of the states and, per prefix, its state."""
    link, length, goes, ends = [-1], [0], [{}], []
    last = 0
    for c in word:
        new = len(link)
        link.append(0)
        length.append(length[last] + 1)
        goes.append({})
        p = last
        while p >= 0 and c not in goes[p]:
            goes[p][c] = new
            p = link[p]
        if p >= 0:
            q = goes[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(link)
                link.append(link[q])
                length.append(length[p] + 1)
                goes.append(goes[q].copy())
                link[q] = link[new] = copy
                while p >= 0 and goes[p].get(c) == q:
                    goes[p][c] = copy
                    p = link[p]
        ends.append(new)
        last = new
    return link, length, ends


def heavy_chains(link: list[int], length: list[int]) -> tuple[list[int], list[int]]:
    """Per state the top of its heavy chain in the link tree, and the chain's number."""
    n = len(link)
    order = sorted(range(1, n), key=length.__getitem__, reverse=True)  # children before parents
    size, heavy, most = [1] * n, [-1] * n, [0] * n
    for v in order:
        p = link[v]
        size[p] += size[v]
        if size[v] > most[p]:
            most[p], heavy[p] = size[v], v
    top = list(range(n))
    for v in reversed(order):
        if heavy[link[v]] == v:
            top[v] = top[link[v]]
    return top, heavy


def squares(word: list[int]) -> dict[tuple[int, int], int]:
    """{(start, period): end} of the runs of a piece."""
    link, length, ends = suffix_automaton(word)
    top, _ = heavy_chains(link, length)
    # per chain: (deepest length, colour) with the shallowest stretch last; a state is known on its chain by its length
    chains: dict[int, list[tuple[int, int]]] = {}
    found: dict[tuple[int, int], int] = {}
    for i, v in enumerate(ends):
        while v > 0:
            head = top[v]
            depth = length[v]
            stack = chains.get(head)
            if stack is None:
                chains[head] = [(depth, i)]
            else:
                while stack:
                    deep, colour = stack[-1]
                    size = deep if deep < depth else depth
                    q = i - colour
                    if size >= (TIMES - 1) * q and size + q >= LEAST:
                        found[i - size - q + 1, q] = i
                    if deep > depth:
                        break
                    stack.pop()
                stack.append((depth, i))
            v = link[head]
    return found


def pieces(ids: np.ndarray, doc: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) of the stretches of ``ids`` outside of which there is no run; ``doc`` numbers the texts."""
    n = len(ids)
    if n < LEAST:
        return []
    x = ids[:-2].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + ids[1:-1].astype(np.uint64)
    x = x * np.uint64(0xBF58476D1CE4E5B9) + ids[2:].astype(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) + doc[:-2].astype(np.uint64)
    by = np.argsort(x, kind="stable")
    same = x[by[1:]] == x[by[:-1]]
    gap = np.full(n - 2, n, np.int64)
    gap[by[:-1][same]] = by[1:][same] - by[:-1][same]
    at = np.flatnonzero((gap < n) & (doc[2:] == doc[:-2]))
    gap = gap[at]
    while len(at):
        first = np.ones(len(at), bool)
        first[1:] = (at[1:] != at[:-1] + 1) | (doc[at[1:]] != doc[at[:-1]])
        number = np.cumsum(first) - 1
        size = np.bincount(number)
        own = size[number]
        # a run of period q has 3 * q - 2 starts or more in it (and 3 at least: 6 words less q + 2)
        stay = (own >= 3) & (3 * gap <= own + 2)
        if stay.all():
            starts = at[first]
            ends = starts + size + 2 + (size + 2) // (TIMES - 1)
            ends = np.minimum(ends, np.searchsorted(doc, doc[starts], side="right"))
            out: list[tuple[int, int]] = []
            for s, e in zip(starts.tolist(), ends.tolist()):
                if out and s < out[-1][1]:
                    out[-1] = (out[-1][0], max(e, out[-1][1]))
                else:
                    out.append((s, e))
            return out
        at, gap = at[stay], gap[stay]
    return []


def runs_of_texts(ids: list[list[int]]) -> list[list[tuple[int, int, int]]]:
    """Per text (a list of word numbers) its runs (start, length, period) in order."""
    sizes = np.array([len(x) for x in ids], np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in ids]
    if not sizes.sum():
        return out
    flat = np.fromiter((w for x in ids for w in x), np.int64, int(sizes.sum()))
    doc = np.repeat(np.arange(len(ids)), sizes)
    first = np.concatenate([[0], np.cumsum(sizes)])
    for s, e in pieces(flat, doc):
        d = int(doc[s])
        at = s - int(first[d])
        out[d] += [(start + at, end - start + 1, q) for (start, q), end in squares(flat[s:e].tolist()).items()]
    for r in out:
        r.sort(key=lambda x: (x[0], x[2]))
    return out


def numbered(words: list[bytes]) -> list[int]:
    known: dict[bytes, int] = {}
    return [known.setdefault(w, len(known)) for w in words]


def disturbed(words: list, doc_id) -> list:
    """The words of the document as the registered query reads them: of every tenth id (by crc32) the tail becomes periodic."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def digests(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256."""
    listed = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
    if not runs:
        return 0, None, None, None, None, listed, hashlib.sha256(b" ".join(words)).hexdigest()
    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]))
    drop = np.zeros(len(words) + 1, np.int64)
    for start, size, period in runs:
        drop[start + period] += 1
        drop[start + size] -= 1
    kept = np.flatnonzero(np.cumsum(drop)[:-1] == 0).tolist()
    return len(runs), s, n, q, 1000 * n // q, listed, hashlib.sha256(b" ".join([words[k] for k in kept])).hexdigest()


def word_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite=None) -> DataFrame:
    """Per row: id, n_runs, the longest run (start, length, period, exponent_milli), runs_sha256, collapsed_sha256,
    and all runs (array of start, length, period).

    ``rewrite(words, id) -> words`` may change a text's words first.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    id_type = d.schema["id"].dataType.simpleString()
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    kinds = [pa.int64()] * 5 + [pa.string()] * 2
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def find(batches):
        for b in by_bytes(batches, 1, BATCH_BYTES):
            words = [(t or b"").split() for t in b.column(1).to_pylist()]
            if rewrite:
                words = [rewrite(w, i) for w, i in zip(words, b.column(0).to_pylist())]
            runs = runs_of_texts([numbered(w) for w in words])
            rows = [digests(w, r) for w, r in zip(words, runs)]
            listed = pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs], run_type)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)), listed],
                                             ["id", *names, "runs"])

    schema = (f"id {id_type}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
              "collapsed_sha256 string, runs array<struct<start: long, length: long, period: long>>")
    return d.mapInArrow(find, schema).withColumnRenamed("id", id_col)
