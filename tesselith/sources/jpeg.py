"""Baseline JPEG encoding (three components, not subsampled), with NumPy alone."""

from __future__ import annotations

import struct

import numpy as np

# fixed values: the tables that the JPEG standard gives as examples, in natural order
LUMINANCE = [
    16, 11, 10, 16, 24, 40, 51, 61, 12, 12, 14, 19, 26, 58, 60, 55, 14, 13, 16, 24, 40, 57, 69, 56, 14, 17, 22, 29, 51, 87, 80, 62,
    18, 22, 37, 56, 68, 109, 103, 77, 24, 35, 55, 64, 81, 104, 113, 92, 49, 64, 78, 87, 103, 121, 120, 101, 72, 92, 95, 98, 112, 100, 103, 99,
]
CHROMINANCE = [
    17, 18, 24, 47, 99, 99, 99, 99, 18, 21, 26, 66, 99, 99, 99, 99, 24, 26, 56, 99, 99, 99, 99, 99, 47, 66, 99, 99, 99, 99, 99, 99,
    99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99, 99,
]
DC_COUNTS, DC_VALUES = [0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0], list(range(12))

_zigzag = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, (i // 8 if (i // 8 + i % 8) % 2 else i % 8))))
_k = np.arange(8)
_dct = np.cos((2 * _k[None, :] + 1) * _k[:, None] * np.pi / 16) * np.where(_k == 0, np.sqrt(1 / 8), 0.5)[:, None]


def _quality(table: list[int], quality: int) -> np.ndarray:
    scale = 5000 // quality if quality < 50 else 200 - 2 * quality
    return np.clip((np.array(table) * scale + 50) // 100, 1, 255)


def _code(counts: list[int], values: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Code words and lengths of the 256 symbols: shorter ones first, then in the order of values."""
    words, sizes, code, at = np.zeros(256, np.int64), np.zeros(256, np.int64), 0, 0
    for length, n in enumerate(counts, 1):
        for v in values[at : at + n]:
            words[v], sizes[v] = code, length
            code += 1
        at += n
        code <<= 1
    return words, sizes


def _fitted(symbols: np.ndarray) -> tuple[list[int], list[int]]:
    """Counts of lengths and symbols of a code for these symbols: Huffman's, cut to 16 bits, no word of ones alone."""
    freq = np.bincount(symbols, minlength=257)
    freq[256] = 1  # takes the word of ones
    used = np.flatnonzero(freq)
    levels: list = []
    pairs = sorted((int(freq[s]), (int(s),)) for s in used)
    for _ in range(16):  # package-merge
        merged = [(a[0] + b[0], a[1] + b[1]) for a, b in zip(levels[::2], levels[1::2])]
        levels = sorted(pairs + merged, key=lambda x: x[0])
    sizes = np.zeros(257, np.int64)
    for _, group in levels[: 2 * len(pairs) - 2]:
        for s in group:
            sizes[s] += 1
    if len(pairs) == 1:
        sizes[used] = 1
    deepest = max(int(sizes.max()), 1)
    longest = [s for s in used if sizes[s] == deepest]
    if 256 not in longest:  # the mark has to be the last of the longest
        swap = longest[-1]
        sizes[256], sizes[swap] = sizes[swap], sizes[256]
    order = [int(s) for s in sorted(used, key=lambda s: (sizes[s], s)) if s != 256]
    return [sum(1 for s in order if sizes[s] == n) for n in range(1, 17)], order


def _magnitude(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of bits of each value, and those bits: negative values are one's complements."""
    size = np.zeros(len(v), np.int64)
    a = np.abs(v)
    for _ in range(12):
        size += a > 0
        a >>= 1
    return size, np.where(v < 0, v + (1 << size) - 1, v)


def _packed(words: np.ndarray, sizes: np.ndarray) -> bytes:
    """Bits in a row, the last byte filled with ones, and a zero byte after each byte of ones."""
    total = int(sizes.sum())
    ends = np.cumsum(sizes)
    bits = np.ones(-(-total // 8) * 8, np.uint8)
    down = np.repeat(ends, sizes) - 1 - np.arange(total)
    bits[:total] = (np.repeat(words, sizes) >> down) & 1
    return np.packbits(bits).tobytes().replace(b"\xff", b"\xff\x00")


def encoded(image: np.ndarray, quality: int = 90) -> bytes:
    h, w = image.shape[:2]
    rgb = np.pad(image[..., :3].astype(np.float64), ((0, -h % 8), (0, -w % 8), (0, 0)), mode="edge")
    ycc = rgb @ np.array([[0.299, 0.587, 0.114], [-0.168736, -0.331264, 0.5], [0.5, -0.418688, -0.081312]]).T - [128.0, 0.0, 0.0]
    rows, cols = rgb.shape[0] // 8, rgb.shape[1] // 8
    blocks = ycc.reshape(rows, 8, cols, 8, 3).transpose(0, 2, 4, 1, 3)
    tables = [_quality(t, quality) for t in (LUMINANCE, CHROMINANCE)]
    steps = np.stack([tables[0], tables[1], tables[1]]).reshape(3, 8, 8)
    z = np.rint(_dct @ blocks @ _dct.T / steps).astype(np.int64).reshape(-1, 3, 64)[..., _zigzag]
    z[..., 0] = np.diff(z[..., 0], axis=0, prepend=0)
    n = len(z)
    # one entry for each first value, each other value that is not zero, each run of 16 zeros before one, and each end of block
    flat = z.reshape(-1, 64)
    comp = np.tile([0, 1, 1], n)
    size, bits = _magnitude(flat[:, 0])
    entries = [(np.arange(len(flat)) * 1024, size, size, bits)]
    block, at = np.nonzero(flat[:, 1:])
    at = at + 1
    first = np.append(True, block[1:] != block[:-1]) if len(block) else np.zeros(0, bool)
    run = at - np.where(first, 0, np.append(0, at[:-1])[: len(at)]) - 1
    size, bits = _magnitude(flat[block, at])
    entries.append((block * 1024 + at * 8 + 4, (run % 16) * 16 + size, size, bits))
    for k in range(1, 4):
        long = run >= 16 * k
        entries.append((block[long] * 1024 + at[long] * 8 + k - 1, np.full(long.sum(), 0xF0), np.zeros(long.sum(), np.int64), np.zeros(long.sum(), np.int64)))
    last = np.zeros(len(flat), np.int64)
    np.maximum.at(last, block, at)
    short = np.flatnonzero(last < 63)
    entries.append((short * 1024 + 1020, np.zeros(len(short), np.int64), np.zeros(len(short), np.int64), np.zeros(len(short), np.int64)))
    place, symbol, size, bits = (np.concatenate(x) for x in zip(*entries))
    order = np.argsort(place, kind="stable")
    place, symbol, size, bits = place[order], symbol[order], size[order], bits[order]
    is_dc, which = place % 1024 == 0, comp[place // 1024]
    dc = [(DC_COUNTS, DC_VALUES)] * 2
    ac = [_fitted(symbol[~is_dc & (which == c)]) for c in (0, 1)]
    words, sizes = np.zeros(len(symbol), np.int64), np.zeros(len(symbol), np.int64)
    for c in (0, 1):
        for mask, table in ((is_dc & (which == c), dc[c]), (~is_dc & (which == c), ac[c])):
            code, length = _code(*table)
            words[mask], sizes[mask] = code[symbol[mask]], length[symbol[mask]]
    body = _packed(words << size | bits, sizes + size)
    part = lambda mark, data: b"\xff" + bytes([mark]) + struct.pack(">H", len(data) + 2) + data
    out = b"\xff\xd8" + part(0xE0, b"JFIF\0\x01\x01\0\0\x01\0\x01\0\0")
    out += b"".join(part(0xDB, bytes([c]) + bytes(t[_zigzag].tolist())) for c, t in enumerate(tables))
    out += part(0xC0, struct.pack(">BHHB", 8, h, w, 3) + bytes([1, 0x11, 0, 2, 0x11, 1, 3, 0x11, 1]))
    out += b"".join(part(0xC4, bytes([kind << 4 | c]) + bytes(counts) + bytes(values)) for c in (0, 1) for kind, (counts, values) in ((0, dc[c]), (1, ac[c])))
    return out + part(0xDA, bytes([3, 1, 0, 2, 0x11, 3, 0x11, 0, 63, 0])) + body + b"\xff\xd9"
