"""Whole texts of an Arrow batch as one run of bytes, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are taken together up to this many bytes; a longer one is a piece of its own.
PIECE_BYTES = 8 << 20


def pieces(batch: pa.RecordBatch, column: int, limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows, the UTF-8 bytes of their texts end to end, and where each begins (one more entry: the end).

    A null text is empty. No text is cut.
    """
    texts = pc.fill_null(batch.column(column), "").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    first = 0
    starts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    content = texts.buffers()[2]
    data = np.frombuffer(content, np.uint8) if content is not None and content.size else np.zeros(0, np.uint8)
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + limit, side="right")) - 1)
        yield batch.slice(first, last - first), data[starts[first] : starts[last]], starts[first : last + 1] - starts[first]
        first = last


_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


class RunHashes:
    """64-bit hashes of any runs of bytes, from one pass of prefix sums over them."""

    def __init__(self, data: np.ndarray):
        powers = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(len(data), _ODD)]))
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * powers[:-1], out=self._sums[1:])
        self._back = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(len(data), _INVERSE)]))

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self._sums[end] - self._sums[start]) * self._back[start])


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which all bits depend on all bits."""
    values = values.astype(np.uint64, copy=True)
    for _ in range(2):
        values ^= values >> np.uint64(32)
        values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return values
