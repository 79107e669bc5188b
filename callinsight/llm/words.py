"""Words of many texts at once, as numbers: a helper for operators that work on words in batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(batch: pa.RecordBatch, limit: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``limit`` bytes of ``column``, or one row each."""
    ends = np.cumsum(np.asarray(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def word_numbers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(numbers, counts, words): the words ``[^\\x20\\x09-\\x0D]+`` of all texts in order as indices into the distinct
    ``words``, and how many each text has."""
    parts = pc.ascii_split_whitespace(texts)
    ends = parts.offsets.to_numpy()
    flat = parts.values
    real = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate(([0], np.cumsum(real.to_numpy(zero_copy_only=False), dtype=np.int64)))
    counts = before[ends[1:]] - before[ends[:-1]]
    flat = flat.slice(int(ends[0]), int(ends[-1] - ends[0])).filter(real.slice(int(ends[0]), int(ends[-1] - ends[0])))
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy(), counts, coded.dictionary
