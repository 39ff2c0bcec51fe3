"""Memory of a packing task: bounded by slices, whatever the batch's size."""

import tracemalloc

import pyarrow as pa

from starloom.llm.encode import KEEP_PIECES, encoder
from starloom.llm.packing import packing_task
from starloom.llm.queries import word_bpe


def test_a_large_batch_is_encoded_in_small_slices():
    text = "the wind farm reports 12 readings, every hour of a day; " * 40
    rows = (6 << 20) // len(text)
    batch = pa.RecordBatch.from_arrays([pa.array(range(rows), pa.int64()), pa.array([text] * rows),
                                        pa.array([0] * rows, pa.int64())], ["doc_id", "text", "loss_from"])
    assert KEEP_PIECES <= 1 << 20
    encoder(word_bpe())  # the tokenizer itself is not counted
    tracemalloc.start()
    try:
        n = sum(len(out) for out in packing_task(word_bpe(), 2, False, {})(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n >= rows
    assert peak < 90 << 20, peak
