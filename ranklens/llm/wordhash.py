"""Words, lines and n-grams of Arrow text columns as numpy arrays.

A text column is looked at as one byte buffer.  Words are maximal runs of bytes
outside a separator table and never cross a row.  The hash of any byte span is
read off one prefix sum, so hashing costs a fixed number of vector operations
per buffer, however many words there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text looked at together; a longer row is looked at alone.
SLICE_BYTES = 4 << 20

WHITE = np.zeros(256, bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = True
#: Everything in ASCII but letters and digits separates.
NOT_WORD = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "p" not in _powers or len(_powers["p"]) < n:
        m = max(n, 1 << 16)
        for key, base in (("p", _P), ("i", _P_INV)):
            a = np.full(m, base, np.uint64)
            a[0] = 1
            _powers[key] = np.multiply.accumulate(a)
    return _powers["p"], _powers["i"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_slices(table: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have at most ``max_bytes`` together."""
    col = table.column(column).fill_null("").cast(pa.string())
    off = _offsets(col)
    lo, n = 0, table.num_rows
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + max_bytes, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield table.slice(lo, hi - lo)
        lo = hi


def _offsets(col: pa.Array) -> np.ndarray:
    if len(col) == 0:
        return np.zeros(1, np.int64)
    return np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)


class Texts:
    """Spans of the texts of one column (null texts count as empty)."""

    def __init__(self, col: pa.Array | pa.ChunkedArray, separators: np.ndarray = WHITE, lower: bool = False, folded: np.ndarray = LOWER):
        if isinstance(col, pa.ChunkedArray):
            col = col.combine_chunks()
        col = col.fill_null("").cast(pa.string())
        off = _offsets(col)
        raw = col.buffers()[2] if len(col) else None
        whole = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
        self.raw = whole[off[0] : off[-1]]
        self.off = off - off[0]
        self.rows = len(col)
        b = folded[self.raw] if lower else self.raw
        pw, self._inv = _power(len(b) + 1)
        self._sum = np.zeros(len(b) + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * pw[: len(b)], out=self._sum[1:])
        inside = ~separators[b]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        row_starts = self.off[:-1][self.off[:-1] < len(b)]
        first[row_starts] = inside[row_starts]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        row_ends = self.off[1:][self.off[1:] > 0] - 1
        last[row_ends] = inside[row_ends]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        #: Words of row i: word_off[i] to word_off[i + 1].
        self.word_off = np.searchsorted(self.start, self.off)
        self.row = np.repeat(np.arange(self.rows), np.diff(self.word_off))

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte spans; equal bytes have equal hashes wherever they stand."""
        h = (self._sum[end] - self._sum[start]) * self._inv[start]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def sequences(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hashes of runs of words, first to last (exclusive), whatever stands between the words."""
        h = self.words()
        pw, inv = _power(len(h) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * pw[: len(h)])])
        return mix((total[last] - total[first]) * inv[first] + (last - first).astype(np.uint64))

    def words(self) -> np.ndarray:
        return self.hash(self.start, self.end)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, row) of every line that ``\\n`` bounds, line ends left out."""
        nl = np.flatnonzero(self.raw == 10)
        start = np.sort(np.concatenate([self.off[:-1], nl + 1]))
        end = np.sort(np.concatenate([nl, self.off[1:]]))
        row = np.repeat(np.arange(self.rows), 1 + np.diff(np.searchsorted(nl, self.off)))
        return start, end, row

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """Sum of per-word values by row."""
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[self.word_off[1:]] - total[self.word_off[:-1]]


def ngrams(h: np.ndarray, row: np.ndarray, n: int, gaps: tuple[int, ...] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position of the first word) of the n-grams inside rows; ``gaps`` are the words' offsets (skip-grams)."""
    at = gaps or tuple(range(n))
    m = len(h) - at[-1]
    if m <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    ok = np.flatnonzero(row[:m] == row[at[-1] :])
    acc = np.full(len(ok), 0x632BE59BD9B4E019 * (n + 31 * at[-1]) & (1 << 64) - 1, np.uint64)
    for k in at:
        acc = mix(acc + h[ok + k])
    return acc, ok


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def order_in_rows(g: np.ndarray, row: np.ndarray, kind: np.ndarray | None = None) -> np.ndarray:
    """``np.lexsort((g, kind, row))`` of hashes, rows from 0 and kinds below 128: one sort by as much of all three as a number holds."""
    keys = (g, row) if kind is None else (g, kind, row)
    if not len(g):
        return np.lexsort(keys)
    bits = max(1, int(row.max()).bit_length())
    room = 64 - bits - (0 if kind is None else 7)
    if room < 16:
        return np.lexsort(keys)
    packed = (row.astype(np.uint64) << np.uint64(64 - bits)) | (g >> np.uint64(64 - room))
    if kind is not None:
        packed |= kind.astype(np.uint64) << np.uint64(room)
    order = np.argsort(packed, kind="stable")
    packed, g = packed[order], g[order]
    # hashes that differ only in what was cut off stand in their own order by chance
    return np.lexsort(keys) if ((packed[1:] == packed[:-1]) & (g[1:] < g[:-1])).any() else order
