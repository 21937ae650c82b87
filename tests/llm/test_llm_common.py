import pyarrow as pa

from tillsight.llm.common import fresh, pieces, small


def test_pieces_of_slices():
    texts = ["a" * n for n in (3, 0, 10, 1, 1, 1, 50, 2)]
    column = pa.array([*texts, None, "é"])
    for a in range(len(column)):
        part = column.slice(a)
        got = list(pieces(part, 10))
        assert [i for x, y in got for i in range(x, y)] == list(range(len(part)))
        for x, y in got:
            size = sum(len((t.as_py() or "").encode()) for t in part.slice(x, y - x))
            assert size <= 10 or y - x == 1
            for p, q in pieces(part.slice(x, y - x), 4):  # slices of slices
                assert 0 <= p < q <= y - x
    assert list(pieces(column.slice(0, 0), 10)) == []


def test_small_batches_keep_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(range(100)), pa.array(["x" * i for i in range(100)])], names=["i", "t"])
    got = list(small([batch, batch.slice(0, 0)], 1, 64))
    assert [i for b in got for i in b.column(0).to_pylist()] == list(range(100)) and len(got) > 50


def test_fresh_names():
    assert fresh("a", ["A", "_a"]) == "__a" and fresh("b", ["a"]) == "b"
