"""Words and text slices of Arrow batches, hashed many at a time.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. All of these are ASCII, so splitting the UTF-8 bytes splits the code points.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

#: Text handled at once inside a task; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20

SPACES = b" \t\n\x0b\x0c\r"
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
_coefficients = np.zeros(0, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def coefficients(n: int) -> np.ndarray:
    """The first ``n`` of a fixed series of odd 64-bit numbers."""
    global _coefficients
    if len(_coefficients) < n:
        size = max(1024, 2 * n)
        _coefficients = mix(np.arange(1, size + 1, dtype=np.uint64) * _ODD) | np.uint64(1)
    return _coefficients[:n]


def hash_runs(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``values[start:start + length]``; runs are in order and don't overlap."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    first = int(starts[0])
    span = values[first:int(starts[-1] + lengths[-1])].astype(np.uint64)
    counts = np.diff(np.append(starts, starts[-1] + lengths[-1]))
    place = np.arange(len(span)) - np.repeat(starts - first, counts)
    inside = place < np.repeat(lengths, counts)
    terms = (span + np.uint64(1)) * coefficients(int(counts.max()))[place]
    terms[~inside] = 0
    return mix(np.add.reduceat(terms, starts - first) + lengths.astype(np.uint64) * _ODD)


def buffers_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the rows of a string column, and where each starts; a null row is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    bounds = bounds[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if not len(bounds) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[bounds[0]:bounds[-1]]
    return raw, bounds - bounds[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges that hold about ``limit`` bytes of text each, whole rows only."""
    _, bounds = buffers_of(column)
    row, last = 0, len(column)
    while row < last:
        end = int(np.searchsorted(bounds, bounds[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), last)
        yield row, end
        row = end


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each row; null is empty."""
    raw, bounds = buffers_of(column)
    whole = raw.tobytes()
    return [whole[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def word_spans(raw: np.ndarray, bounds: np.ndarray,
               between: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of each word in ``raw``, and the number of the first word of each row.

    ``between`` marks the bytes that part words.
    """
    word = ~between[raw]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    heads = bounds[:-1][bounds[:-1] < bounds[1:]]
    begins[heads] = word[heads]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | begins[1:]
    starts = np.flatnonzero(begins)
    lengths = np.flatnonzero(ends) + 1 - starts
    return starts, lengths, np.searchsorted(starts, bounds)


def hashed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for each word, and the number of the first word of each row (and the total)."""
    raw, bounds = buffers_of(column)
    starts, lengths, first_word = word_spans(raw, bounds)
    return hash_runs(raw, starts, lengths), first_word


def by_slice(work: Callable[[pa.RecordBatch], pa.RecordBatch], text: str = "text",
             limit: int = SLICE_BYTES) -> Callable:
    """A function for ``mapInArrow`` that hands ``work`` a bounded amount of text at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in slices(batch.column(text), limit):
                made = work(batch.slice(start, end - start))
                if made is not None:
                    yield made
    return run


def schema_with(rows: DataFrame, fields: str) -> StructType:
    """The schema of ``rows`` with more fields, given as DDL."""
    return StructType(rows.schema.fields + StructType.fromDDL(fields).fields)


def free_name(rows: DataFrame, name: str) -> str:
    """A column name that ``rows`` doesn't have."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name
