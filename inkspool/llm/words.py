"""Vectorised words of Arrow text batches.

A word is ``[^\\x20\\x09-\\x0D]+``. Words are found and hashed on the UTF-8 bytes
of a whole batch at once, so no Python code runs per usual word. A word's 64-bit
hash chains a mixing step over its length and its bytes, eight at a time, with
A-Z lowered (on demand); a word of more than LONG bytes is hashed by xxh3. Equal
words have equal hashes in every batch, task and run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
BASE = np.uint64(0x9E3779B97F4A7C15)
LOWER = np.arange(256)
LOWER[65:91] += 32
#: The first k bytes of eight, read as a little-endian number.
FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Longer words (in bytes) are hashed one by one.
LONG = 64
#: Texts of so many bytes are handled at once; a longer text goes alone.
CHUNK_BYTES = 4 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finisher of 64-bit hashes."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Chunk:
    """The words of some consecutive texts.

    data: their bytes; text_at: byte offsets of the texts (one more than texts);
    start, end: byte offsets of the words; word_at: index of the first word of
    each text (one more than texts); doc: the text of each word.
    """

    def __init__(self, data: np.ndarray, text_at: np.ndarray, first: int):
        self.data, self.text_at, self.first = data, text_at, first
        white = np.ones(len(data) + 2, bool)  # with one more byte on either side
        white[1:-1] = WHITE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[text_at] = True
        inside = ~white[1:-1]
        self.start = np.flatnonzero(inside & (edge[:-1] | white[:-2]))
        self.end = np.flatnonzero(inside & (edge[1:] | white[2:])) + 1
        self.word_at = np.searchsorted(self.start, text_at)
        self.counts = np.diff(self.word_at)

    def __len__(self) -> int:
        return len(self.text_at) - 1

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), self.counts)

    def hashes(self, lower: bool = True) -> np.ndarray:
        """The 64-bit hash of every word."""
        data = np.zeros(len(self.data) + 8, np.uint8)
        data[:-8] = LOWER.astype(np.uint8)[self.data] if lower else self.data
        eight = np.ndarray((len(self.data) + 1,), "<u8", data, strides=(1,))  # the eight bytes from every offset on
        size = self.end - self.start
        out = mix(size.astype(np.uint64) * BASE)
        for k in range(0, LONG, 8):
            at = np.flatnonzero((size > k) & (size <= LONG))
            if not len(at):
                break
            piece = eight[self.start[at] + k] & FIRST[np.minimum(size[at] - k, 8)]
            out[at] = mix(out[at] ^ mix(piece + BASE))
        for i in np.flatnonzero(size > LONG).tolist():
            out[i] = xxhash.xxh3_64_intdigest(data[self.start[i] : self.end[i]])
        return out

    def text(self, i: int) -> str:
        return self.data[self.text_at[i] : self.text_at[i + 1]].tobytes().decode()

    def windows(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) of every window of k words; a shorter, non-empty text is one window."""
        n, doc = len(hashes), self.doc
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        odd = mix(np.arange(1, k + 1, dtype=np.uint64) * BASE) | np.uint64(1)
        full = max(0, n - k + 1)
        out = np.zeros(full, np.uint64)
        for j in range(k):
            out += hashes[j : j + full] * odd[j]
        inside = doc[:full] == doc[k - 1 :] if full else np.zeros(0, bool)
        texts, values = doc[:full][inside], mix(out[inside])
        short = np.flatnonzero((self.counts > 0) & (self.counts < k))
        if len(short):
            extra = []
            for i in short:
                own = hashes[self.word_at[i] : self.word_at[i + 1]]
                extra.append(mix(np.array([np.sum(own * odd[: len(own)], dtype=np.uint64) + np.uint64(len(own))]))[0])
            texts, values = np.concatenate([texts, short]), np.concatenate([values, np.array(extra, np.uint64)])
        return texts, values


def trimmed(data: np.ndarray, start: np.ndarray, end: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words' starts and ends without the marks (a table of bytes) at either side; a word of marks only stays whole."""
    if not len(start):
        return start.copy(), end.copy()
    n, own = len(data), ~marks[data]
    place = np.arange(n)
    after = np.minimum.accumulate(np.where(own, place, n)[::-1])[::-1][start]
    before = np.maximum.accumulate(np.where(own, place, -1))[end - 1] + 1
    some = after < end
    return np.where(some, after, start), np.where(some, before, end)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The column's texts in chunks of about ``size`` bytes."""
    data, at = text_bytes(column)
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, "right")) - 1)
        yield Chunk(data[at[i] : at[j]], at[i : j + 1] - at[i], i)
        i = j


def code_points(data: np.ndarray) -> np.ndarray:
    """For each byte offset, and the end, the number of code points before it."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def as_signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
