"""Words of a text column and their fingerprints, found on the UTF-8 bytes with numpy.

Words are runs of bytes of a given class, so nothing is done per word in Python. A word's
fingerprint is a 64-bit polynomial of its bytes, mixed at the end; a window's is the same over the
fingerprints of its words. The work runs in chunks, so that memory follows the batch, not the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLANK = [0x20, *range(0x09, 0x0E)]
#: Bytes of words that end at white space only.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[BLANK] = False
#: Bytes of words made of ASCII letters, digits and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

CHUNK = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD1342543DE82EF95)
_BYTES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mixed_in(x: np.ndarray) -> np.ndarray:
    """``mix`` in the place of the values, which are lost."""
    high = x >> np.uint64(30)
    x ^= high
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, np.uint64(27), out=high)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= np.right_shift(x, np.uint64(31), out=high)
    return x


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, CHUNK)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"][:n], _powers["down"]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each text begins; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """All words of a batch, in order: number of their text, byte span and fingerprint."""

    data: np.ndarray
    offsets: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    code: np.ndarray

    def counts(self) -> np.ndarray:
        return np.bincount(self.text, minlength=len(self.offsets) - 1)


def spans(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of member bytes; no run crosses a text's border."""
    inside = member[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(data))]
    begins[borders] = inside[borders]
    ends[borders - 1] = inside[borders - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def span_codes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprint of each byte span; the spans are in order of their begin."""
    codes = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + CHUNK, "right")))
        low, high = start[at], end[to - 1]
        up, down = _power(int(high - low))
        sums = np.zeros(high - low + 1, np.uint64)
        weighed = _BYTES.take(data[low:high])
        weighed *= up
        np.cumsum(weighed, out=sums[1:])
        first = start[at:to] - low
        codes[at:to] = (sums[end[at:to] - low] - sums[first]) * down[first]
        at = to
    return mix(codes)


def words_of(column: pa.Array | pa.ChunkedArray, member: np.ndarray, lower: bool = False) -> Words:
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    start, end = spans(data, offsets, member)
    text = np.searchsorted(offsets, start, "right") - 1
    return Words(data, offsets, text, start, end, span_codes(data, start, end))


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all windows of ``size`` words within a text, and the number of their first word."""
    n = len(words.code) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    code = np.zeros(n, np.uint64)
    for k in range(size):
        code *= _STEP
        code += words.code[k : k + n]
    first = np.flatnonzero(words.text[:n] == words.text[size - 1 :])
    return mix(code[first]), first


def covered(first: np.ndarray, size: int, total: int) -> np.ndarray:
    """Which of ``total`` words lie in a window of ``size`` words that begins at one of ``first``."""
    edges = np.zeros(total + 1, np.int32)
    np.add.at(edges, first, 1)
    np.add.at(edges, np.minimum(first + size, total), -1)
    return np.cumsum(edges[:total]) > 0


def blocks(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int) -> Iterator[pa.Table]:
    """Batches put together, or cut, to blocks of about ``most_bytes`` of text; one text is never cut."""
    kept: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        lengths = text_bytes(batch.column(batch.schema.get_field_index(text)))[1]
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(lengths, lengths[at] + most_bytes - size, "right")) - 1
            to = min(max(to, at + (not kept)), batch.num_rows)
            if to > at:
                kept.append(batch.slice(at, to - at))
                size += int(lengths[to] - lengths[at])
                at = to
            if at < batch.num_rows or size >= most_bytes:
                yield pa.Table.from_batches(kept)
                kept, size = [], 0
    if kept:
        yield pa.Table.from_batches(kept)
