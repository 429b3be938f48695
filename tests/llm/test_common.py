import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from figpairs.llm.common import by_bytes, joined_by_bytes


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.one_of(st.none(), st.integers(0, 40).map(lambda n: "é" * n)), max_size=12), max_size=8), st.integers(1, 60), st.integers(1, 9))
def test_batches_keep_rows_order_and_bounds(sizes, most, rows):
    at, batches = 0, []
    for texts in sizes:
        ids = range(at, at + len(texts))
        at += len(texts)
        batches.append(pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], ["id", "text"]))
    want = [r for b in batches for r in b.to_pylist()]
    cut = list(by_bytes(batches, 1, most, rows))
    joined = list(joined_by_bytes(batches, 1, most, rows))
    for parts in (cut, joined):
        assert [r for b in parts for r in b.to_pylist()] == want
        for b in parts:
            held = [len((t or "").encode()) for t in b.column(1).to_pylist()]
            assert 0 < len(held) <= rows
            assert sum(held) <= most or sum(map(bool, held)) == 1
    assert len(joined) <= len(cut)
    # two neighbours never fit into one batch
    for a, b in zip(joined, joined[1:]):
        first = len((b.column(1)[0].as_py() or "").encode())
        assert a.num_rows + 1 > rows or sum(len((t or "").encode()) for t in a.column(1).to_pylist()) + first > most or b.num_rows > 1
