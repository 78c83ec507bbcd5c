"""PNG encoding and decoding with the standard library alone (8 bits a channel, not interlaced)."""

from __future__ import annotations

import struct
import zlib

import numpy as np

SIGN = b"\x89PNG\r\n\x1a\n"


def encoded(image: np.ndarray) -> bytes:
    h, w, _ = image.shape
    rows = np.hstack((np.zeros((h, 1), np.uint8), np.ascontiguousarray(image, np.uint8).reshape(h, -1)))
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return SIGN + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def decoded(data: bytes) -> np.ndarray:
    if data[:8] != SIGN:
        raise ValueError("not a PNG file")
    at, body, head = 8, b"", None
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", data[at + 8 : at + 8 + n])
        elif kind == b"IDAT":
            body += data[at + 8 : at + 8 + n]
        at += n + 12
    w, h, depth, colour, _, _, lace = head
    channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(colour)
    if depth != 8 or lace or channels is None:
        raise ValueError("only 8 bits a channel, not interlaced, without palette")
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, 1 + w * channels)
    out = np.zeros((h, w, channels), np.uint8)
    for y in range(h):
        line, up = raw[y, 1:].reshape(w, channels).astype(np.int64), out[y - 1].astype(np.int64) if y else np.zeros((w, channels), np.int64)
        kind = raw[y, 0]
        if kind == 0:
            out[y] = line
        elif kind == 1:
            out[y] = np.cumsum(line, axis=0) % 256
        elif kind == 2:
            out[y] = (line + up) % 256
        else:  # mean and Paeth depend on the pixel before
            left, corner = np.zeros(channels, np.int64), np.zeros(channels, np.int64)
            for x in range(w):
                if kind == 3:
                    guess = (left + up[x]) // 2
                else:
                    p = left + up[x] - corner
                    a, b, c = np.abs(p - left), np.abs(p - up[x]), np.abs(p - corner)
                    guess = np.where((a <= b) & (a <= c), left, np.where(b <= c, up[x], corner))
                left, corner = (line[x] + guess) % 256, up[x]
                out[y, x] = left
    if channels == 1:
        return np.repeat(out, 3, axis=2)
    return out[..., :3] if channels > 2 else np.repeat(out[..., :1], 3, axis=2)
