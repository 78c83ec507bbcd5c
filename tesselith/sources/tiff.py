"""Pyramids in TIFF files: one directory a level, RGB with 8 bits a channel, strips or tiles, plain or deflated.

A region is read from the tiles it touches; the rest of the file stays where it is.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

# fixed values: tags and types of the format
WIDTH, LENGTH, BITS, COMPRESSION, PHOTOMETRIC, DESCRIPTION, STRIPS, CHANNELS, ROWS, STRIP_SIZES = 256, 257, 258, 259, 262, 270, 273, 277, 278, 279
X_RESOLUTION, Y_RESOLUTION, PLANAR, UNIT, TILE_WIDTH, TILE_LENGTH, TILES, TILE_SIZES, SUBTYPE = 282, 283, 284, 296, 322, 323, 324, 325, 254
TYPES = {1: "B", 2: "c", 3: "H", 4: "I", 5: "II"}


class Tiff:
    def __init__(self, path: str):
        self.file = open(path, "rb")
        try:
            self.levels = self._directories()
        except BaseException:
            self.file.close()
            raise

    def close(self) -> None:
        self.file.close()

    def _directories(self) -> list[dict]:
        head = self.file.read(8)
        self.order = {b"II": "<", b"MM": ">"}.get(head[:2])
        if self.order is None or struct.unpack(self.order + "H", head[2:4])[0] != 42:
            raise ValueError("not a TIFF file")
        at, found = struct.unpack(self.order + "I", head[4:8])[0], []
        while at and len(found) < 64:
            self.file.seek(at)
            n = struct.unpack(self.order + "H", self.file.read(2))[0]
            raw, tags = self.file.read(12 * n + 4), {}
            for i in range(n):
                tag, kind, count, _ = struct.unpack(self.order + "HHI4s", raw[12 * i : 12 * i + 12])
                form = TYPES.get(kind)
                if form is None:
                    continue
                size = struct.calcsize("<" + form) * count
                data = raw[12 * i + 8 : 12 * i + 8 + size]
                if size > 4:
                    self.file.seek(struct.unpack(self.order + "I", raw[12 * i + 8 : 12 * i + 12])[0])
                    data = self.file.read(size)
                tags[tag] = data.rstrip(b"\0").decode("utf-8", "replace") if kind == 2 else struct.unpack(self.order + form[0] * (len(form) * count), data)
            if tags.get(BITS, (8,))[0] != 8 or tags.get(CHANNELS, (1,))[0] != 3 or tags.get(COMPRESSION, (1,))[0] not in (1, 8, 32946) or tags.get(PLANAR, (1,))[0] != 1:
                raise ValueError("only RGB with 8 bits a channel, plain or deflated")
            found.append(tags)
            at = struct.unpack(self.order + "I", raw[12 * n : 12 * n + 4])[0]
        return found

    def dimensions(self, level: int) -> tuple[int, int]:
        return self.levels[level][WIDTH][0], self.levels[level][LENGTH][0]

    def properties(self) -> dict[str, str]:
        """The description, and microns a pixel where the resolution has a unit."""
        t, out = self.levels[0], {}
        if DESCRIPTION in t:
            out["tiff.description"] = t[DESCRIPTION]
        per = {2: 25400.0, 3: 10000.0}.get(t.get(UNIT, (1,))[0])
        for tag, name in ((X_RESOLUTION, "mpp-x"), (Y_RESOLUTION, "mpp-y")):
            if per and tag in t and t[tag][0] and t[tag][1]:
                out[name] = repr(per * t[tag][1] / t[tag][0])
        return out

    def region(self, level: int, x: int, y: int, width: int, height: int) -> np.ndarray:
        """Pixels of a level; what lies outside is white."""
        t = self.levels[level]
        w, h = self.dimensions(level)
        tw, th = (t[TILE_WIDTH][0], t[TILE_LENGTH][0]) if TILES in t else (w, t.get(ROWS, (h,))[0])
        offsets, sizes = (t[TILES], t[TILE_SIZES]) if TILES in t else (t[STRIPS], t[STRIP_SIZES])
        out = np.full((height, width, 3), 255, np.uint8)
        x0, y0, x1, y1 = max(0, x), max(0, y), min(w, x + width), min(h, y + height)
        if x0 >= x1 or y0 >= y1:
            return out
        across = -(-w // tw)
        for r in range(y0 // th, (y1 - 1) // th + 1):
            for c in range(x0 // tw, (x1 - 1) // tw + 1):
                self.file.seek(offsets[r * across + c])
                data = self.file.read(sizes[r * across + c])
                if t.get(COMPRESSION, (1,))[0] != 1:
                    data = zlib.decompress(data)
                rows = th if TILES in t else min(th, h - r * th)
                tile = np.frombuffer(data, np.uint8, rows * tw * 3).reshape(rows, tw, 3)
                a, b, e, f = max(x0, c * tw), max(y0, r * th), min(x1, c * tw + tw), min(y1, r * th + rows)
                out[b - y : f - y, a - x : e - x] = tile[b - r * th : f - r * th, a - c * tw : e - c * tw]
        return out


def written(levels: list[np.ndarray], mpp: float | None = None, tile: int = 256, description: str = "") -> bytes:
    """A file with these levels, largest first."""
    out, patch = bytearray(b"II*\0\0\0\0\0"), 4
    for number, image in enumerate(levels):
        h, w = image.shape[:2]
        offsets, sizes = [], []
        for r in range(0, h, tile):
            for c in range(0, w, tile):
                part = image[r : r + tile, c : c + tile]
                data = zlib.compress(np.pad(part, ((0, tile - part.shape[0]), (0, tile - part.shape[1]), (0, 0)), constant_values=255).tobytes(), 6)
                offsets.append(len(out))
                sizes.append(len(data))
                out += data
        tags = [(SUBTYPE, 4, [int(number > 0)]), (WIDTH, 4, [w]), (LENGTH, 4, [h]), (BITS, 3, [8, 8, 8]), (COMPRESSION, 3, [8]), (PHOTOMETRIC, 3, [2])]
        if description:
            tags.append((DESCRIPTION, 2, description.encode() + b"\0"))
        tags += [(CHANNELS, 3, [3])]
        if mpp:
            per = [10_000_000, max(1, round(mpp * 1000))]
            tags += [(X_RESOLUTION, 5, per), (Y_RESOLUTION, 5, per)]
        tags += [(PLANAR, 3, [1])] + ([(UNIT, 3, [3])] if mpp else [])
        tags += [(TILE_WIDTH, 4, [tile]), (TILE_LENGTH, 4, [tile]), (TILES, 4, offsets), (TILE_SIZES, 4, sizes)]
        entries = b""
        for tag, kind, values in tags:
            data = values if kind == 2 else struct.pack("<" + TYPES[kind][0] * len(values), *values)
            count = len(values) // len(TYPES[kind]) if kind == 5 else len(values)
            if len(data) > 4:
                out += b"\0" * (len(out) % 2)
                where, data = len(out), data
                out += data
                data = struct.pack("<I", where)
            entries += struct.pack("<HHI", tag, kind, count) + data.ljust(4, b"\0")
        out += b"\0" * (len(out) % 2)
        out[patch : patch + 4] = struct.pack("<I", len(out))
        out += struct.pack("<H", len(tags)) + entries
        patch = len(out)
        out += b"\0\0\0\0"
    return bytes(out)
