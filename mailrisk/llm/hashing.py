"""Vectorised hashing of words and word sequences for tasks that run on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute

from mailrisk.session import ship_with_tasks

ship_with_tasks(__name__)

_SOME_BYTES = 4 << 20


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on all input bits."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of every word."""
    if not words:
        return np.empty(0, np.uint64)
    array = np.empty(len(words), object)
    array[:] = words
    return mix(pd.util.hash_array(array, categorize=False))


def chunks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches of a few MB of text each (one row at least), with the texts as bytes."""
    for batch in batches:
        texts = batch.column(column)
        start, size = 0, 0
        lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0))
        for at, length in enumerate(lengths):
            size += int(length)
            if size >= _SOME_BYTES or at == len(lengths) - 1:
                part = batch.slice(start, at + 1 - start)
                yield part, [value or b"" for value in part.column(column).to_pylist()]
                start, size = at + 1, 0
