"""Helpers that the operators of this package share."""

from __future__ import annotations

import sys
import types
import uuid
from itertools import chain, repeat

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from figpairs.session import checkpoint_dir

# Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: what follows survives a lost executor without
    recomputing ``df``, and sees the same rows each time.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, over all tasks of one operator.

    Workers outlive a stage; another operator's cache goes as soon as this one
    asks for its own, so a worker never holds more than one.
    """
    mod = sys.modules.setdefault("_figpairs_llm_cache", types.ModuleType("_figpairs_llm_cache"))
    held = mod.__dict__.setdefault("held", {})
    if held.get("name") != name:
        held.clear()
        held.update(name=name, cache={})
    return held["cache"]


def free_name(name: str, taken) -> str:
    """``name`` or, if a column has it, one that no column has."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def without_ids(docs: DataFrame, id_col: str, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is not in ``gone`` (one column; a null id counts as an id); all columns as they are."""
    name = free_name("__gone", docs.columns)
    gone = gone.toDF(name).distinct()
    return docs.join(gone, docs[f"`{id_col}`"].eqNullSafe(gone[name]), "left_anti")


class Bitmap:
    """Bits of fixed number over 64-bit hashes: which slots a column of hashes falls into."""

    def __init__(self, hashes: DataFrame, bits: int):
        import numpy as np

        self.bits = bits
        slot = F.pmod(F.col(hashes.columns[0]), F.lit(bits))
        maps = hashes.select(F.bitmap_bucket_number(slot + 1).alias("bucket"), F.bitmap_bit_position(slot + 1).alias("bit")).groupBy("bucket").agg(
            F.bitmap_construct_agg("bit").alias("map"))
        self.bytes = np.zeros(bits // 8, np.uint8)
        for r in maps.toLocalIterator():  # at most bits / 32768 maps of 4 KB
            at = (r["bucket"] - 1) * 4096
            self.bytes[at:at + 4096] = np.frombuffer(r["map"], np.uint8)

    def has(self, hashes):
        """Whether each of an array of hashes may be among them (never False for one that is)."""
        slot = hashes % self.bits
        return (self.bytes[slot >> 3] >> (slot & 7).astype("uint8") & 1).astype(bool)


def by_bytes(batches, column: int, most: int, rows: int = 4096):
    """Arrow batches cut so that ``column`` (texts) holds at most ``most`` bytes each, or one longer text."""
    import numpy as np
    import pyarrow.compute as pc

    for b in batches:
        if not b.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(size)
        at = 0
        while at < b.num_rows:
            done = int(ends[at - 1]) if at else 0
            end = min(max(int(np.searchsorted(ends, done + most, side="right")), at + 1), at + rows)
            yield b.slice(at, end - at)
            at = min(end, b.num_rows)


def joined_by_bytes(batches, column: int, most: int, rows: int = 4096):
    """Like :func:`by_bytes`, but small batches are joined first: sizes do not depend on the session's batches."""
    import pyarrow as pa
    import pyarrow.compute as pc

    held, n, size = [], 0, 0
    for part in by_bytes(batches, column, most, rows):
        own = pc.sum(pc.binary_length(part.column(column))).as_py() or 0
        if held and (n + part.num_rows > rows or size + own > most):
            yield pa.concat_batches(held)
            held, n, size = [], 0, 0
        held.append(part)
        n, size = n + part.num_rows, size + own
    if held:
        yield pa.concat_batches(held)


class WordTable:
    """Rows of numbers per distinct word, computed once per Python worker.

    ``learn(words) -> array [len(words), width]``.  Holds at most ``most``
    words; a full table is emptied, so memory stays bounded over any corpus.
    """

    def __init__(self, learn, width: int, most: int = 400_000):
        import numpy as np

        self.learn, self.width, self.most = learn, width, most
        self.at: dict[bytes, int] = {}
        self.rows = np.zeros((1024, width), np.float32)

    def lookup(self, texts: list[list[bytes]]):
        """Per text, the indices of its words in ``rows``."""
        import numpy as np

        flat = list(chain.from_iterable(texts))
        at = np.fromiter(map(self.at.get, flat, repeat(-1)), np.int64, len(flat))
        unknown = np.flatnonzero(at < 0).tolist()
        if unknown:
            new = {flat[k] for k in unknown}
            if len(self.at) + len(new) > self.most:
                self.at.clear()
                new, unknown = set(flat), range(len(flat))
            words = sorted(new)
            n = len(self.at)
            if n + len(words) > len(self.rows):
                grown = np.zeros((max(2 * len(self.rows), n + len(words)), self.width), np.float32)
                grown[:n] = self.rows[:n]
                self.rows = grown
            self.rows[n:n + len(words)] = self.learn(words)
            self.at.update(zip(words, range(n, n + len(words))))
            at[unknown] = [self.at[flat[k]] for k in unknown]
        return np.split(at, np.cumsum([len(t) for t in texts])[:-1]) if texts else []


def crc_mod(c: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as an empty text."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def runs_of(batches, keys: list[str], wide: tuple[str, ...] = ()):
    """Groups of consecutive rows with equal ``keys`` from sorted Arrow batches, as dicts of arrays.

    List columns of one length become 2-D arrays; columns in ``wide`` become
    lists of bytes.  Only the group at hand is held beyond its batch.
    """
    import numpy as np
    import pyarrow as pa

    def arrays(b):
        out = {}
        for name, col in zip(b.schema.names, b.columns):
            if name in wide or pa.types.is_binary(col.type) or pa.types.is_string(col.type):
                out[name] = np.array([*col.to_pylist(), None], dtype=object)[:-1]
            elif pa.types.is_list(col.type):
                flat = col.flatten().to_numpy(zero_copy_only=False)
                out[name] = flat.reshape(len(col), -1)
            else:
                out[name] = col.to_numpy(zero_copy_only=False)
        return out

    held: list[dict] = []

    def joined():
        return held[0] if len(held) == 1 else {k: np.concatenate([h[k] for h in held]) for k in held[0]}

    for b in batches:
        if not b.num_rows:
            continue
        a = arrays(b)
        change = np.zeros(b.num_rows, bool)
        for k in keys:
            change[1:] |= a[k][1:] != a[k][:-1]
        if held and any(held[-1][k][-1] != a[k][0] for k in keys):
            yield joined()
            held = []
        cuts = [0, *np.flatnonzero(change).tolist(), b.num_rows]
        for s, e in zip(cuts[:-1], cuts[1:]):
            part = {k: v[s:e] for k, v in a.items()}
            held.append(part)
            if e < b.num_rows:
                yield joined()
                held = []
    if held:
        yield joined()
