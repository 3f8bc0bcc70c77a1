"""Texts of an Arrow batch as flat arrays: rows of different lengths, slices, words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20
#: White space (that of Unicode, without the separators U+001C to U+001F).
SPACE = "\t\n\x0b\x0c\r \x85\xa0                　"
_RAW_SPACE = sorted((s for c in SPACE if len(s := c.encode()) > 1), key=len)


class Ragged:
    """Rows of different lengths in one array: row i is values[ends[i - 1] : ends[i]]."""

    def __init__(self, values: np.ndarray, lengths: np.ndarray):
        self.values, self.lengths, self.ends = values, lengths, np.cumsum(lengths)

    def take(self, rows: np.ndarray) -> "Ragged":
        lengths = self.lengths[rows]
        shift = (self.ends - self.lengths)[rows] - (np.cumsum(lengths) - lengths)
        return Ragged(self.values[np.repeat(shift, lengths) + np.arange(lengths.sum())], lengths)

    def groups(self, sizes: np.ndarray) -> "Ragged":
        """The same values, with runs of ``sizes`` rows joined into one."""
        ends = np.concatenate([[0], self.ends])[np.cumsum(sizes)]
        return Ragged(self.values, np.diff(ends, prepend=0))


def raw_bytes(words: pa.Array) -> Ragged:
    """The bytes of a string array without nulls."""
    _, ends, data = words.buffers()
    ends = np.frombuffer(ends, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64) if len(words) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return Ragged(data, np.diff(ends))


def slices(texts: pa.Array, most: int | None = None) -> Iterator[pa.Array]:
    """Runs of texts of at most ``most`` bytes together (``SLICE_BYTES``, if not given), or of one longer text."""
    most = most or SLICE_BYTES
    size = np.cumsum([0 if n is None else n for n in pc.binary_length(texts).to_pylist()])
    start = 0
    while start < len(texts):
        reach = (size[start - 1] if start else 0) + most
        end = max(start + 1, int(np.searchsorted(size, reach, "right")))
        yield texts.slice(start, end - start)
        start = end


def split_words(raw: Ragged) -> tuple[pa.Array, np.ndarray]:
    """The white-space-separated words of texts, and how many each text has."""
    data = raw.values
    space = (data == 32) | ((data >= 9) & (data <= 13))
    for s in _RAW_SPACE:
        at = np.flatnonzero(data[: len(data) - len(s) + 1] == s[0])
        for i, b in enumerate(s[1:], 1):
            at = at[data[at + i] == b]
        for i in range(len(s)):
            space[at + i] = True
    # a word begins where a byte that is no space follows a space or the end of a text
    before = np.concatenate([[True], space[:-1]])
    first = (raw.ends - raw.lengths)[raw.lengths > 0]
    before[first] = True
    starts = np.flatnonzero(~space & before)
    letters = np.concatenate([[0], np.cumsum(~space)])
    number = np.diff(np.searchsorted(starts, np.concatenate([[0], raw.ends])))
    offsets = np.append(letters[starts], letters[-1]).astype(np.int32)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[~space])), number
