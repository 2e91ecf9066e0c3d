"""What a worker holds while it goes through a batch."""

import tracemalloc

import pyarrow as pa
import pytest

from eqscene.llm import order_minhash, quality
from eqscene.llm._shingles import byte_chunks


@pytest.mark.parametrize("step", ["sketch", "codes", "statistics"])
def test_a_batch_is_worked_through_in_small_ranges(step):
    """A full batch of 10,000 texts: Python and numpy hold a small part of it at a time."""
    texts = pa.array([" ".join(f"word{k % (i % 97 + 3)}" for k in range(200)) for i in range(10_000)])
    ids = pa.array(range(len(texts)))
    run = {
        "sketch": lambda: sum(b.num_rows for b in order_minhash._sketch(iter([pa.RecordBatch.from_arrays([ids, ids, ids, texts], names=["doc_id", "h1", "h2", "text"])]))),
        "codes": lambda: sum(b.num_rows for b in order_minhash._codes(iter([pa.RecordBatch.from_arrays([ids, texts], names=["rep", "text"])]))),
        "statistics": lambda: len(quality.statistics_of(texts)),
    }[step]
    tracemalloc.start()
    try:
        assert run() == len(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert texts.nbytes > 10_000_000 and peak < 20_000_000


def test_ranges_of_odd_texts():
    texts = pa.array(["", "é" * 200_000, "a", "", "b" * 300_000, "c"])

    for column in (texts, texts.slice(1, 4), texts.slice(0, 0), texts.cast(pa.large_string())):
        found = list(byte_chunks(column))
        assert [t for _, _, part in found for t in part] == [t.encode() for t in column.to_pylist()]
        assert [k for i, j, _ in found for k in range(i, j)] == list(range(len(column)))
