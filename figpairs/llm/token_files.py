"""Token ids in binary files: independent zstandard frames, a seek table, checksums.

File format (all numbers little-endian):
* data frames: each one zstandard frame over
  ``uint32 documents | int64 ordinals... | uint32 token counts... | uint16 or uint32 ids...``;
  a document lies wholly in one frame, a frame holds about ``frame_ids`` ids;
* one skippable frame (magic 0x184D2A50): JSON index with the id width and, per
  frame, its first ordinal and its number of documents;
* one skippable frame (magic 0x184D2A5E) in the public seekable layout: per
  frame its compressed size, its plain size and the low 32 bits of the plain
  bytes' XXH64, then the number of frames, the flags (0x80: checksums) and
  0x8F92EAB1.

A reader takes the tail, finds the frames that hold the ordinals asked for and
reads and decompresses only those, checking each frame's checksum.

Writing: documents are range-sorted by id, each range becomes one file, and a
task writes its file under a name of its own before it reports it, so a retry
never meets a half-written file: only reported files are listed.  A document's
ordinal is its row in its file.  Offsets over all files are prefix sums over one
row per file.

Defined results:
* null texts are empty; an empty text is the end id alone;
* null ids come first; rows with equal ids are ordered by a hash of the text, each kept;
* very long texts are encoded whole and make a frame of their own;
* an empty table writes no file and returns no rows;
* other columns of the documents do not take part.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from figpairs.llm.common import by_bytes, new_path, stored, worker_cache

# Fixed values of the public zstandard seekable format.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

CACHE_WORDS = 1_000_000
BATCH_BYTES = 1 << 20


def encoder(tokenizer_path: str):
    """text -> token ids (uint32 array).

    No token of the tokenizer spans white space, so ids are looked up per
    word and only words not met before go through the library.  Words are
    cached per Python worker; a full cache is emptied.
    """
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    held = worker_cache("tokens:" + tokenizer_path)
    if "tok" not in held:
        held["tok"], held["words"] = Tokenizer.from_file(tokenizer_path), {}
    tok, known = held["tok"], held["words"]

    def learn(words: list[bytes]) -> None:
        for at in range(0, len(words), 4096):
            part = words[at:at + 4096]
            line = b" ".join(part).decode()
            e = tok.encode(line, add_special_tokens=False)
            ids = np.array(e.ids, dtype="<u4").tobytes()
            gaps = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), "<u4") == 0x20)  # offsets count characters
            starts = np.fromiter(chain.from_iterable(e.offsets), np.int64, len(ids) // 2)[::2]
            cuts = [0, *(4 * np.searchsorted(starts, gaps)).tolist(), len(ids)]
            known.update((w, ids[s:t]) for w, s, t in zip(part, cuts, cuts[1:]))

    def encode(texts: list[str | None]) -> list[np.ndarray]:
        split = [(t or "").encode().split() for t in texts]
        if len(known) > CACHE_WORDS:
            known.clear()
        new = set().union(*split).difference(known)
        if new:
            learn(sorted(new))
        get = known.__getitem__
        return [np.frombuffer(b"".join(map(get, ws)), dtype="<u4") for ws in split]

    return encode


def open_fs(uri: str):
    """(filesystem, path) of a shared folder, also of those that are not local."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class FrameWriter:
    """Writes documents into frames of one open binary file."""

    def __init__(self, out, width: int, frame_ids: int, level: int = 3):
        import zstandard

        self.out, self.width, self.frame_ids = out, width, frame_ids
        self.zip = zstandard.ZstdCompressor(level=level)
        self.seek, self.index, self.docs, self.held, self.n = [], [], [], 0, 0

    def add(self, ids: np.ndarray) -> None:
        if self.docs and self.held + len(ids) > self.frame_ids:
            self.flush()
        self.docs.append(ids)
        self.held += len(ids)

    def flush(self) -> None:
        import xxhash

        if not self.docs:
            return
        k = len(self.docs)
        plain = b"".join([struct.pack("<I", k), np.arange(self.n, self.n + k, dtype="<i8").tobytes(),
                          np.array([len(d) for d in self.docs], dtype="<u4").tobytes(),
                          np.concatenate(self.docs).astype(f"<u{self.width}").tobytes()])
        packed = self.zip.compress(plain)
        self.out.write(packed)
        self.seek.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.index.append((self.n, k))
        self.n += k
        self.docs, self.held = [], 0

    def close(self) -> None:
        self.flush()
        index = json.dumps({"width": self.width, "frames": self.index}).encode()
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        body = b"".join(struct.pack("<III", *s) for s in self.seek) + struct.pack("<IBI", len(self.seek), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(body)) + body)


class FrameReader:
    """Reads documents of one token file, frame by frame, from any seekable input."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("not a token file: the seek table is missing")
        table = self._at(size - 9 - 12 * n, 12 * n)
        self.seek = [struct.unpack_from("<III", table, 12 * k) for k in range(n)]
        self.starts = [0, *np.cumsum([s[0] for s in self.seek]).tolist()]
        at = self.starts[-1]
        magic, length = struct.unpack("<II", self._at(at, 8))
        if magic != SKIPPABLE_INDEX:
            raise ValueError("not a token file: the index is missing")
        index = json.loads(self._at(at + 8, length))
        self.width, self.frames = index["width"], index["frames"]

    def _at(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def frame(self, k: int) -> Iterator[tuple[int, np.ndarray]]:
        import xxhash
        import zstandard

        packed, plain_size, check = self.seek[k]
        plain = zstandard.ZstdDecompressor().decompress(self._at(self.starts[k], packed), max_output_size=plain_size)
        if len(plain) != plain_size or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} is damaged")
        (n,) = struct.unpack_from("<I", plain)
        ordinals = np.frombuffer(plain, "<i8", n, 4)
        counts = np.frombuffer(plain, "<u4", n, 4 + 8 * n)
        ids = np.frombuffer(plain, f"<u{self.width}", int(counts.sum()), 4 + 12 * n).astype("<u4")
        ends = np.cumsum(counts, dtype=np.int64)
        for o, c, e in zip(ordinals.tolist(), counts.tolist(), ends.tolist()):
            yield o, ids[e - c:e]

    def documents(self, ordinals: list[int] | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """All documents, or those of the given ordinals; other frames are not read."""
        asked = None if ordinals is None else set(ordinals)
        for k, (first, n) in enumerate(self.frames):
            if asked is None or any(o in asked for o in range(first, first + n)):
                for o, ids in self.frame(k):
                    if asked is None or o in asked:
                        yield o, ids


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = 1, frame_ids: int = 1 << 18, files: int | None = None, width: int = 2) -> DataFrame:
    """Write ``docs`` in ascending id order; returns the catalogue, one row per file.

    Catalogue: file (order), path, doc_ids (of the rows, in order), n_docs,
    n_tokens, start (ids in all files before).  ``width``: bytes an id takes.
    """
    spark = docs.sparkSession
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    id_type = d.schema["id"].dataType.simpleString()
    # ranges are sampled on the driver: of the texts only hashes go there
    d = d.repartitionByRange(n, F.col("id"), F.xxhash64("text")).sortWithinPartitions(F.col("id"), F.xxhash64("text"), F.col("text"))

    def run(batches):
        encode = encoder(tokenizer_path)
        fs, base = open_fs(folder)
        name, out, ids, tokens, writer = f"{uuid.uuid4().hex}.tok.zst", None, [], 0, None
        end = np.array([end_id], dtype="<u4")
        for rows in by_bytes(batches, 1, BATCH_BYTES, 64):
            if rows.num_rows:
                for doc in encode(rows.column(1).to_pylist()):
                    if writer is None:
                        fs.create_dir(base, recursive=True)
                        out = fs.open_output_stream(f"{base}/{name}", compression=None)
                        writer = FrameWriter(out, width, frame_ids)
                    writer.add(np.concatenate([doc, end]))
                    tokens += len(doc) + 1
                ids += rows.column(0).to_pylist()
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{folder.rstrip('/')}/{name}"]), pa.array([ids], pa.list_(b_type)), pa.array([len(ids)], pa.int64()), pa.array([tokens], pa.int64())],
                ["path", "doc_ids", "n_docs", "n_tokens"])

    from pyspark.sql.pandas.types import to_arrow_type

    b_type = to_arrow_type(d.schema["id"].dataType)
    parts = d.mapInArrow(run, f"path string, doc_ids array<{id_type}>, n_docs long, n_tokens long")
    # The partition number is the file's place, since partitions are ranges of ids.
    written = stored(parts.withColumn("file", F.spark_partition_id()), "token-catalogue")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = written.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))
    return written.join(starts, "file")


def read_token_files(catalogue: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    id_type = catalogue.schema["doc_ids"].dataType.elementType
    from pyspark.sql.pandas.types import to_arrow_type

    arrow_id = to_arrow_type(id_type)

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                fs, path = open_fs(row["path"])
                with fs.open_input_file(path) as f:
                    reader, at = FrameReader(f), row["start"]
                    starts, counts, sums = [], [], []
                    for _, ids in reader.documents():
                        starts.append(at)
                        counts.append(len(ids))
                        sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                        at += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], arrow_id), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    # one file is one task's work; files are dealt out evenly
    n = int(catalogue.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (catalogue.repartitionByRange(n, "file").select("path", "doc_ids", "start")
            .mapInArrow(run, f"doc_id {id_type.simpleString()}, start long, n_tokens long, ids_crc32 long"))


def token_files(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Write ``docs`` into the shared folder and return the per-document rows read back from the files."""
    folder = new_path(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, folder, tokenizer_path, id_col, text_col, **options))
