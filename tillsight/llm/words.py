"""Words of UTF-8 texts as numpy arrays, for the operators that work in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# The ASCII white space that separates words.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
GAP = re.compile(rb"[\x20\x09-\x0D]")


def mix(n: int, seed: int = 1) -> np.ndarray:
    """``n`` odd 64-bit constants from a fixed rule (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(1_000_003)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(31))) | np.uint64(1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, one text after the other, and the offsets; null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    column = pa.concat_arrays([column])
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]], at - at[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each text the number of its first word (one more entry at the end)."""
    inside = ~SPACE[data]
    # A word never runs over the end of a text.
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    opens[firsts] = inside[firsts]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    lasts = firsts[1:] - 1
    closes[lasts] = inside[lasts]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def slices(batch: pa.RecordBatch, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``most`` bytes, at least a row each: long texts don't meet in one array."""
    at = 0
    while at < len(batch):
        rows = len(batch) - at
        while rows > 1 and batch.slice(at, rows).nbytes > most:
            rows = (rows + 1) // 2
        yield batch.slice(at, rows)
        at += rows


def pieces(text: bytes, most: int = 1 << 20) -> Iterator[bytes]:
    """The text in parts of about ``most`` bytes that end at white space: a long text's words never meet in one list.

    A stretch without white space stays whole.
    """
    at = 0
    while len(text) - at > most:
        cut = max(text.rfind(c, at + 1, at + most) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
        if cut < 0:
            gap = GAP.search(text, at + most)
            cut = gap.start() if gap else len(text)
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text
