import pyarrow as pa

from litmill.llm import common


def test_a_task_empties_the_tables_of_others(monkeypatch):
    mine, other = {1: 1}, {2: 2}
    monkeypatch.setattr(common, "TABLES", {"mine": mine.clear, "other": other.clear})
    batch = pa.record_batch({"x": [1, 2]})
    assert list(common.tidy(iter, "mine")(iter([batch]))) == [batch]
    assert mine and not other
    assert list(common.per_batch(lambda b: iter([b, b]))(iter([batch]))) == [batch, batch]
    assert not mine


def test_rows_in_slices_and_bytes_end_to_end():
    texts = ["a", None, "é" * 10, "", "b" * 50, "c"]
    batch = pa.record_batch({"i": list(range(6)), "text": pa.array(texts)})
    for size in (1, 7, 30, 1000):
        parts = list(common.sliced(batch, "text", size))
        assert [i for p in parts for i in p.column("i").to_pylist()] == list(range(6)) and (size > 1 or len(parts) > 3)
    data, bounds = common.flat(batch.slice(1, 4).column("text"))
    assert common.unflat(data, bounds, pa.string()).to_pylist() == ["", "é" * 10, "", "b" * 50]
    assert list(common.sliced(batch.slice(0, 0), "text", 5)) == []
    assert common.flat(pa.array([], pa.string()))[1].tolist() == [0]
