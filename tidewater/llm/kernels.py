"""Array arithmetic on the UTF-8 bytes of many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
#: Lower-cased, and ASCII punctuation as blanks.
PLAIN = np.array([LOWER[c] if c >= 128 or chr(c).isalnum() else 32 for c in range(256)], dtype=np.uint8)


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow column as one byte array, and the offset of each
    (one more than there are texts). Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string()).cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(at), np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def chunks(offsets: np.ndarray, most: int):
    """Ranges ``(i, j)`` of texts that hold about ``most`` bytes together."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` and, for each text, the
    index of its first word (one more entry than there are texts)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    white = WHITE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    begin, end = edge[:n].copy(), edge[1:].copy()
    begin[1:] |= white[:-1]
    end[:-1] |= white[1:]
    end[-1] = True
    starts, ends = np.flatnonzero(begin & ~white), np.flatnonzero(end & ~white) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (a fixed bijection)."""
    v = values ^ (values >> np.uint64(33))
    v = v * np.uint64(0xFF51AFD7ED558CCD)
    v = v ^ (v >> np.uint64(33))
    v = v * np.uint64(0xC4CEB9FE1A85EC53)
    return v ^ (v >> np.uint64(33))


class Rolling:
    """Hashes of any byte range, ``sum sym[byte] * base**position mod 2**64``,
    from prefix sums and inverse powers; ``sym`` are fixed random odd numbers."""

    def __init__(self, seed: int):
        random = np.random.default_rng(seed)
        self.sym = random.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = (int(random.integers(0, 2**60)) << 3) | 5
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 2**64))
        self.powers = self.back = np.ones(1, np.uint64)
        self.sums = np.zeros(1, np.uint64)

    def load(self, data: np.ndarray) -> "Rolling":
        return self.load_symbols(self.sym[data])

    def load_symbols(self, symbols: np.ndarray) -> "Rolling":
        n = len(symbols)
        if len(self.powers) <= n:
            grown = np.full(n + n // 4 + 1, self.base, np.uint64)
            grown[0] = 1
            self.powers = np.cumprod(grown, dtype=np.uint64)
            grown = np.full(n + n // 4 + 1, self.inverse, np.uint64)
            grown[0] = 1
            self.back = np.cumprod(grown, dtype=np.uint64)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * self.powers[:n], dtype=np.uint64, out=self.sums[1:])
        return self

    def of(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])


def word_hashes(rolling: Rolling, data: np.ndarray, offsets: np.ndarray, most: int = 1 << 21):
    """Hashes of the lower-cased (A-Z only) words, chunk by chunk of texts: yields
    ``(i, j, hashes, first)`` where ``first`` has the index of each text's first word."""
    for i, j in chunks(offsets, most):
        part = LOWER[data[offsets[i]:offsets[j]]]
        starts, ends, first = word_spans(part, offsets[i:j + 1] - offsets[i])
        rolling.load(part)
        yield i, j, rolling.of(starts, ends), first


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over each text's words."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[first[1:]] - sums[first[:-1]]
