"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes hashed in one vector operation.
SPAN = 1 << 18

_SPACES = [0x20, *range(0x09, 0x0E)]
#: Which bytes belong to a word: everything but ASCII white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[_SPACES] = False
#: Which bytes belong to a word: ASCII letters and digits, and every byte of other characters.
LETTERS = np.zeros(256, bool)
LETTERS[0x30:0x3A] = LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True

_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_PLACE = _random.integers(1, 1 << 63, 1 << 16, dtype=np.uint64) * U64(2) + U64(1)
_TURN = _random.integers(1, 1 << 63, 4096, dtype=np.uint64) * U64(2) + U64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 bits."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after another, and where each text begins; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Where the words of a column of texts begin and end.

    ``starts`` and ``ends`` are byte places; text ``i`` has words ``first[i]:first[i + 1]``.
    A word never runs over the end of a text.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = NOT_SPACE):
        self.data, self.offsets, self.inside = data, offsets, inside
        word = inside[data]
        before, after = np.zeros_like(word), np.zeros_like(word)
        before[1:], after[:-1] = word[:-1], word[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        before[edges], after[edges - 1] = False, False
        self.starts = np.flatnonzero(word & ~before)
        self.ends = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word; with ``lower``, A-Z hash like a-z."""
        value = np.where(self.inside, _BYTE, U64(0))
        if lower:
            value[0x41:0x5B] = value[0x61:0x7B]
        out, i, n = np.empty(len(self.starts), np.uint64), 0, len(self.starts)
        while i < n:
            j = max(i + 1, int(np.searchsorted(self.starts, self.starts[i] + SPAN)))
            a, b = int(self.starts[i]), int(self.ends[j - 1])
            begins = self.starts[i:j] - a
            lengths = np.diff(np.append(begins, b - a))
            place = np.arange(b - a) - np.repeat(begins, lengths)
            out[i:j] = np.add.reduceat(value[self.data[a:b]] * _PLACE[place & 0xFFFF], begins)
            i = j
        return mix(out)

    def texts_of(self) -> np.ndarray:
        """For each word, which text it is in."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive word hashes, also over the ends of texts."""
    n = max(0, len(h) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k if n else 0):
        out += h[j : j + n] * _TURN[j]
    return mix(out)


def whole(first: np.ndarray, n_words: int, k: int) -> np.ndarray:
    """Which of the k-word windows lie in one text."""
    out = np.ones(max(0, n_words - k + 1), bool)
    for e in first[1:-1][np.diff(first)[1:] > 0] if k > 1 else []:
        out[max(0, e - k + 1) : e] = False
    return out


def sliding_argmin(x: np.ndarray, width: int) -> np.ndarray:
    """Where the least of every ``width`` consecutive values is, the leftmost of equals."""
    if len(x) < width:
        return np.zeros(0, np.int64)

    def least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(x[b] < x[a], b, a)

    at, have = np.arange(len(x)), 1
    while have * 2 <= width:
        at = least(at[:-have], at[have:])
        have *= 2
    return least(at[: len(at) - (width - have)], at[width - have :]) if width > have else at


#: A-Z as a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def strings(words: Words) -> pa.LargeStringArray:
    """The words themselves, A-Z lower-cased."""
    letters = LOWER[words.data[words.inside[words.data]]]
    ends = np.concatenate([[0], np.cumsum(words.ends - words.starts)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(words), pa.py_buffer(ends.tobytes()), pa.py_buffer(letters.tobytes()))
