"""Texts as units that encode independently, and a worker's memory of units it has encoded.

With the pattern below a match never goes on across certain places, and what is on one side of them has no influence on
the matches on the other side. Cut there, the units of a text encode one by one to the same ids. The places are: before a space
that a non-space follows; after a letter that no letter follows; after a single line end that a non-space follows. Letters
and marks are those of ASCII, and a non-space is a byte that cannot begin a white space of Unicode; elsewhere no cut is made.
Texts of other patterns are one unit each.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The pattern of byte-level BPE for which the cut is proved (a fixed value).
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+"
#: So many units are kept in a worker (some 60 bytes each); of the bytes that they have, so many.
KEPT, KEPT_BYTES = 2_000_000, 64 << 20

_first = np.zeros(256, bool)
_first[0x21:0x7F] = _first[0xC3:0xE0] = True
#: Bytes that no white space holds, in a text of which the first is given: continuation bytes count with their lead byte.
_inside = _first.copy()
_inside[0x80:0xC0] = True
_letter, _mark = np.zeros(256, bool), np.zeros(256, bool)
_letter[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_mark[0x21:0x7F] = True
_mark &= ~_letter
_printed = _letter | _mark


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array without nulls, and where each text begins, with the end."""
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
    raw = np.frombuffer(data, np.uint8, int(at[-1] - at[0]), int(at[0])) if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def strings(raw: np.ndarray, offsets: np.ndarray) -> pa.StringArray:
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int32)), pa.py_buffer(raw))


def units(texts: pa.Array, cut: bool = True) -> tuple[pa.StringArray, np.ndarray]:
    """The units of all texts in a row, and how many each text has."""
    raw, at = text_bytes(texts)
    begin = np.zeros(len(raw), bool)
    if cut and len(raw):
        begin[:-1] = (raw[:-1] == 32) & _first[raw[1:]]
        begin[at[1:-1][at[1:-1] > 0] - 1] = False  # the last byte of a text, whatever the next text begins with
        begin[1:] |= _letter[raw[:-1]] & _mark[raw[1:]]
        begin[2:] |= _printed[raw[:-2]] & (raw[1:-1] == 10) & _first[raw[2:]]
    begin[at[:-1][at[:-1] < at[1:]]] = True
    begins = np.flatnonzero(begin)
    return strings(raw, np.append(begins, len(raw))), np.diff(np.searchsorted(begins, at))


def plain(some: pa.StringArray) -> np.ndarray:
    """Which units are a space and then no white space."""
    raw, at = text_bytes(some)
    bad = np.append(0, np.cumsum(~_inside[raw]))
    ok = at[1:] > at[:-1] + 1
    ok[ok] = (raw[at[:-1][ok]] == 32) & (bad[at[1:][ok]] == bad[at[:-1][ok] + 1])
    return ok


class UnitCoder:
    """encode: a string array of distinct units to all their ids and how many each has."""

    def __init__(self, encode: Callable[[pa.StringArray], tuple[np.ndarray, np.ndarray]]):
        self.encode = encode
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.flat, self.starts = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def ids(self, texts: pa.Array, cut: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, and how many each text has."""
        if len(self.known) > KEPT or self.known.nbytes > KEPT_BYTES:
            self.forget()
        some, sizes = units(texts, cut)
        at = pc.index_in(some, value_set=self.known)
        numbers = at.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        if at.null_count:
            unknown = np.flatnonzero(numbers < 0)
            unknown_units = some.take(pa.array(unknown))
            new = unknown_units.unique()
            numbers[unknown] = pc.index_in(unknown_units, value_set=new).to_numpy(zero_copy_only=False) + len(self.known)
            flat, n = self.encode(new)
            self.known = pa.concat_arrays([self.known, new])
            self.flat, self.starts = np.concatenate((self.flat, flat.astype(np.int32))), np.concatenate((self.starts, self.starts[-1] + np.cumsum(n)))
        n = self.starts[numbers + 1] - self.starts[numbers]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        where = np.repeat(self.starts[numbers] - (ends - n), n) + np.arange(total)
        ends = np.append(0, ends)[np.append(0, np.cumsum(sizes))]
        return self.flat[where], np.diff(ends)
