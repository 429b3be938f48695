import zlib

import numpy as np
import pyarrow as pa
import pytest

from figpairs.llm.common import new_path
from figpairs.llm.queries import tokenizer_path
from figpairs.llm.token_files import FrameReader, FrameWriter, encoder, open_fs, read_token_files, token_files, write_token_files
from tests.llm.conftest import LONG, documents

TEXTS = ["", "Hello,  world!", "i'm don't we'll", "étude ÉTUDE", "a<|endoftext|>b", "İstanbul ΣΣ", "x\x1cy\x85z", "日本語 text", "1234 5", "''' ..."]


def library_ids(texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    return [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_word_lookup_equals_the_library():
    got = encoder(tokenizer_path())(TEXTS)
    assert [g.tolist() for g in got] == library_ids(TEXTS)


def test_round_trip_on_edge_rows(docs, no_docs):
    got = sorted(token_files(docs, tokenizer_path()).collect(), key=lambda r: r.start)
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in docs.select("doc_id", "text").collect()))
    ids = [x + [1] for x in library_ids([t for *_, t in rows])]
    at = 0
    for r, (known, i, _), x in zip(got, rows, ids, strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i if known else None, at, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
        at += len(x)
    assert token_files(no_docs, tokenizer_path()).count() == 0


def test_many_files_keep_id_order(spark):
    df = documents(spark, [(k, f"text number {k} " * (k % 7), "", "") for k in reversed(range(200))])
    catalogue = write_token_files(df, new_path(spark, "t"), tokenizer_path(), files=9, frame_ids=50)
    assert catalogue.count() > 1
    got = sorted(read_token_files(catalogue).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == list(range(200))
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))


class Counting:
    def __init__(self, data):
        self.f, self.read_bytes = pa.BufferReader(data), 0

    def size(self):
        return self.f.size()

    def seek(self, at):
        self.f.seek(at)

    def read(self, n):
        self.read_bytes += n
        return self.f.read(n)


def written(docs, **kw):
    out = pa.BufferOutputStream()
    w = FrameWriter(out, **kw)
    for d in docs:
        w.add(np.array(d, "<u4"))
    w.close()
    return out.getvalue().to_pybytes()


def test_reader_takes_only_the_frames_asked_for():
    docs = [list(range(k % 5, 3000 + k)) for k in range(50)]
    data = written(docs, width=2, frame_ids=6000)
    whole = Counting(data)
    assert [(o, x.tolist()) for o, x in FrameReader(whole).documents()] == list(enumerate(docs))
    some = Counting(data)
    assert [(o, x.tolist()) for o, x in FrameReader(some).documents([3, 40])] == [(3, docs[3]), (40, docs[40])]
    assert some.read_bytes < whole.read_bytes / 5


def test_each_frame_is_a_zstandard_frame_and_damage_is_found():
    import zstandard

    data = written([[1, 2, 3], [70_000]], width=4, frame_ids=1)
    r = FrameReader(Counting(data))
    assert len(r.seek) == 2
    # any zstandard reader skips the index and the seek table
    assert len(zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()) == sum(s[1] for s in r.seek)
    bad = bytearray(data)
    at = len(data) - 9 - 12 * 2 + 8
    bad[at] ^= 1  # the first frame's checksum
    with pytest.raises(ValueError, match="frame 0 is damaged"):
        list(FrameReader(Counting(bytes(bad))).documents())
    with pytest.raises(ValueError, match="seek table"):
        FrameReader(Counting(b"x" * 40))


def test_open_fs_takes_paths_and_uris(tmp_path):
    for place in (str(tmp_path), f"file://{tmp_path}"):
        fs, path = open_fs(place)
        with fs.open_output_stream(path + "/x", compression=None) as f:
            f.write(b"1")
    assert LONG
