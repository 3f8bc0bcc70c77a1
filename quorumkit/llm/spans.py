"""Words of flat bytes as arrays: where they begin and end, polynomial hashes of them, and packed number columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
#: Bytes whose words are hashed at once.
_STEP = 4 << 20
#: Odd bases of the polynomials modulo 2**64; the first and its inverse are for bytes, the others for words.
_BYTE_BASE = 0x9E3779B97F4A7C15
_BYTE_INVERSE = pow(_BYTE_BASE, -1, 1 << 64)
WORD_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit of the input moves every bit of the output."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


def word_spans(data: np.ndarray, lengths: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words of each row) of the words of rows that lie one after the other in ``data``.

    ``space`` says of each byte value whether it parts words; a word never crosses the end of a row.
    """
    gap = space[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[np.concatenate([[0], np.cumsum(lengths)])] = True
    starts = np.flatnonzero(~gap & (edge[:-1] | np.concatenate([[True], gap[:-1]])))
    ends = np.flatnonzero(~gap & (edge[1:] | np.concatenate([gap[1:], [True]]))) + 1
    per_row = np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)])))
    return starts, ends, per_row


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """The first n powers of the byte base and of its inverse."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, _STEP + 1)
        _POWERS[:] = [np.multiply.accumulate(np.concatenate([[_U(1)], np.full(size - 1, b, _U)])) for b in (_BYTE_BASE, _BYTE_INVERSE)]
    return _POWERS


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A mixed polynomial hash of each word's bytes, from running sums, stretch by stretch."""
    out = np.empty(len(starts), _U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _STEP, "right")))
        low, high = int(starts[i]), int(ends[j - 1])
        up, down = _powers(high - low + 1)
        total = np.concatenate([[_U(0)], np.cumsum((data[low:high].astype(_U) + _U(1)) * up[: high - low])])
        out[i:j] = (total[ends[i:j] - low] - total[starts[i:j] - low]) * down[starts[i:j] - low]
        i = j
    if _POWERS and len(_POWERS[0]) > _STEP + 1:
        _POWERS.clear()  # one huge word should not keep its table
    return mix(out)


def window_hashes(x: np.ndarray, size: int, base: int) -> np.ndarray:
    """Polynomial hash of every ``size`` neighbours of x, by doubling: two halves make a window of twice the width."""
    width, h, done, total = 1, x, 0, None
    while True:
        if size & width:
            part = h[done : done + len(x) - size + 1]
            total = part if total is None else total * _U(pow(base, width, 1 << 64)) + part
            done += width
        if width * 2 > size:
            return total
        h = h[:-width] * _U(pow(base, width, 1 << 64)) + h[width:]
        width *= 2


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed planes of the bytes of their differences."""
    step = np.diff(values, prepend=values.dtype.type(0))
    planes = np.ascontiguousarray(step.view(np.uint8).reshape(len(values), values.itemsize).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(packed: bytes, n: int, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(packed, decompressed_size=n * size, codec="zstd", asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(size, n).T).view(dtype).ravel(), dtype=dtype)
