"""Slide readers: a contract, the formats at hand, a fall-back in order, and metadata with the defaults it needs.

A reader gives dimensions, level_dimensions, level_downsamples, properties, read_region(), thumbnail() and close(). Others,
for vendor formats, are added with register(); settings name them as backend and fallback.
"""

from __future__ import annotations

import contextlib
import fcntl
import hashlib
import math
import os
import re
import shutil
import uuid
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np

from ..config import Reader as Settings
from ..functions import raster
from . import png
from .tiff import Tiff


@dataclass(frozen=True)
class Metadata:
    dimensions: tuple[int, int]
    level_dimensions: tuple[tuple[int, int], ...]
    level_downsamples: tuple[float, ...]
    mpp: float | None
    reader: str
    properties: dict[str, str] = field(default_factory=dict)


class SlideReader(Protocol):
    metadata: Metadata

    def read_region(self, x: int, y: int, level: int, width: int, height: int) -> np.ndarray: ...

    def thumbnail(self, width: int, height: int) -> np.ndarray: ...

    def close(self) -> None: ...


class ReaderOpenError(RuntimeError):
    pass


def numbers(value) -> list[float]:
    """The finite numbers above zero in a text (parted by commas, semicolons, backslashes or blanks), a list or one value."""
    parts = re.split(r"[,;\\\s]+", value.strip()) if isinstance(value, str) else list(value) if isinstance(value, (tuple, list)) else [value]
    out = []
    for p in parts:
        with contextlib.suppress(TypeError, ValueError):
            if math.isfinite(float(p)) and float(p) > 0:
                out.append(float(p))
    return out


# fixed values: where readers keep the resolution
X_KEYS = ("openslide.mpp-x", "mpp-x", "mpp_x", "microns_per_pixel_x")
Y_KEYS = ("openslide.mpp-y", "mpp-y", "mpp_y", "microns_per_pixel_y")
BOTH_KEYS = ("aperio.mpp", "mpp", "microns_per_pixel", "resolution")
MILLIMETRE_KEYS = ("pixelspacing", "pixel_spacing", "dicom.pixelspacing")


def resolution(properties: dict, direct=None) -> float | None:
    """Microns a pixel: the direct value's mean; the mean of all spellings of either axis; a value for both; millimetres."""
    mean = lambda v: sum(v) / len(v)
    if own := numbers(direct):
        return mean(own)
    low = {str(k).lower(): v for k, v in properties.items()}
    if axes := [n[0] for k in X_KEYS + Y_KEYS if (n := numbers(low.get(k)))]:
        return mean(axes)
    for keys, scale in ((BOTH_KEYS, 1.0), (MILLIMETRE_KEYS, 1000.0)):
        for k in keys:
            if found := numbers(low.get(k)):
                return scale * mean(found)
    return None


def metadata_of(slide, reader: str) -> Metadata:
    """Metadata of any slide object; attributes may be values or functions. Without levels there is one; without downsamples
    they follow from the widths."""
    get = lambda name, default=None: v() if callable(v := getattr(slide, name, default)) else v
    properties = {str(k): str(v) for k, v in (get("properties") or {}).items()}
    w, h = (int(v) for v in get("dimensions"))
    levels = tuple((int(a), int(b)) for a, b in (get("level_dimensions") or ((w, h),)))
    downs = get("level_downsamples")
    downs = tuple(float(v) for v in downs) if downs is not None else tuple(w / a for a, _ in levels)
    direct = get("mpp") if get("mpp") is not None else get("microns_per_pixel")
    return Metadata((w, h), levels, downs, resolution(properties, direct), reader, properties)


def thumbnail_level(levels, width: int, height: int) -> int:
    """The first level that fits into the size, else the last."""
    return next((i for i, (w, h) in enumerate(levels) if w <= width and h <= height), len(levels) - 1)


def fitted(image: np.ndarray, width: int, height: int) -> np.ndarray:
    """Shrunk to fit, never enlarged."""
    h, w = image.shape[:2]
    scale = min(width / w, height / h)
    return image if scale >= 1 else raster.area_resized(image, max(1, round(w * scale)), max(1, round(h * scale)))


class RasterReader:
    """A whole image in memory, as one level."""

    def __init__(self, image: np.ndarray, properties: dict | None = None, mpp: float | None = None, name: str = "raster"):
        self.image, self.properties, self.mpp, self.dimensions = image, properties or {}, mpp, (image.shape[1], image.shape[0])
        self.metadata = metadata_of(self, name)

    def read_region(self, x, y, level, width, height):
        if level:
            raise ValueError(f"no level {level}")
        out = np.full((height, width, 3), 255, np.uint8)
        a, b, c, d = max(0, x), max(0, y), min(self.dimensions[0], x + width), min(self.dimensions[1], y + height)
        if a < c and b < d:
            out[b - y : d - y, a - x : c - x] = self.image[b:d, a:c]
        return out

    def thumbnail(self, width, height):
        return fitted(self.image, width, height)

    def close(self):
        self.image = None


class PngReader(RasterReader):
    def __init__(self, path: str):
        with open(path, "rb") as f:
            super().__init__(png.decoded(f.read()), name="png")


class TiffReader:
    """A pyramid, of which only the tiles in question are read."""

    def __init__(self, path: str):
        self.file = Tiff(path)
        self.dimensions = self.file.dimensions(0)
        self.level_dimensions = tuple(self.file.dimensions(i) for i in range(len(self.file.levels)))
        self.properties = self.file.properties()
        self.metadata = metadata_of(self, "tiff")

    def read_region(self, x, y, level, width, height):
        """x and y at level 0, width and height at the level."""
        down = self.metadata.level_downsamples[level]
        return self.file.region(level, int(x / down), int(y / down), width, height)

    def thumbnail(self, width, height):
        """From the level that is next above the size; where its sides are out of proportion, from one that fits."""
        levels = self.level_dimensions
        level = next((i for i in reversed(range(len(levels))) if levels[i][0] >= width and levels[i][1] >= height), 0)
        ratio = self.dimensions[0] / self.dimensions[1]
        if abs(levels[level][0] / levels[level][1] / ratio - 1) > 0.02:
            level = thumbnail_level(levels, width, height)
        return fitted(self.file.region(level, 0, 0, *levels[level]), width, height)

    def close(self):
        self.file.close()


BACKENDS: dict = {}


def register(name: str, construct) -> None:
    if not name or (name in BACKENDS and BACKENDS[name] is not construct):
        raise ValueError(f"name is empty or taken: {name!r}")
    BACKENDS[name] = construct


register("tiff", TiffReader)
register("png", PngReader)


def _vendor(*modules: str):
    """A reader over a vendor's module, if it is installed: a constructor class or an open function."""

    def construct(path: str):
        import importlib

        for name in modules:
            with contextlib.suppress(ImportError):
                module = importlib.import_module(name)
                # fixed values: what such modules call it
                make = next((getattr(module, x) for x in ("ASlide", "Aslide", "Slide", "OpenSlide", "open_slide", "open") if hasattr(module, x)), None)
                if make is None:
                    raise AttributeError(f"{name} has no slide constructor")
                return VendorReader(make(path), modules[-1])
        raise ImportError(f"not installed: {' or '.join(modules)}")

    return construct


class VendorReader:
    """Any slide object with read_region((x, y), level, (w, h)) and get_thumbnail((w, h)). Colours become sRGB where the
    object can do so; the outcome is kept among the properties."""

    def __init__(self, slide, name: str):
        self.slide = slide
        try:
            self.metadata = metadata_of(slide, name)
            self.metadata.properties["color_correction"] = self._corrected()
        except BaseException:
            self.close()
            raise

    def _corrected(self) -> str:
        apply = getattr(self.slide, "apply_color_correction", None)
        if apply is None:
            return "unavailable:not supported"
        try:
            apply(True, "Real")
            return "enabled:Real"
        except Exception as e:
            return f"unavailable:{type(e).__name__}: {e}"

    def read_region(self, x, y, level, width, height):
        return np.asarray(self.slide.read_region((x, y), level, (width, height)))[..., :3]

    def thumbnail(self, width, height):
        image = np.asarray(self.slide.get_thumbnail((width, height)))[..., :3]
        w, h = self.metadata.dimensions
        if abs(image.shape[1] / image.shape[0] * h / w - 1) > 0.02:
            level = thumbnail_level(self.metadata.level_dimensions, width, height)
            image = self.read_region(0, 0, level, *self.metadata.level_dimensions[level])
        return fitted(image, width, height)

    def close(self):
        with contextlib.suppress(AttributeError):
            self.slide.close()


register("aslide", _vendor("Aslide", "aslide"))
register("openslide", _vendor("openslide"))


def backends(settings: Settings) -> tuple[str, ...]:
    """Backends in the order of trial. auto begins with the formats read here, then the vendor readers."""
    b, f = settings.backend.strip().lower(), settings.fallback.strip().lower()
    for name in (b, f):
        if name not in {*BACKENDS, "auto", "", "none", "disabled"}:
            raise ValueError(f"no such backend: {name}; there are {sorted(BACKENDS)}")
    if b != "auto":
        return (b,)
    return tuple(dict.fromkeys(("tiff", "png", "aslide", *([f] if f in BACKENDS else []))))


@contextlib.contextmanager
def staged(source: str, entrypoint: str, sidecars, settings: Settings):
    """The entry point within a copy of the slide's files on a fast disk; the copy is made once, and renamed when whole."""
    if not settings.staging_enabled:
        yield entrypoint
        return
    os.makedirs(settings.staging_root, exist_ok=True)
    stem = os.path.splitext(os.path.basename(source))[0]
    place = os.path.join(settings.staging_root, f"{stem}-{hashlib.sha256(source.encode()).hexdigest()[:16]}")
    with open(place + ".lock", "a") as lock:
        fcntl.flock(lock, fcntl.LOCK_EX)
        if not os.path.isdir(place):
            part = f"{place}.{uuid.uuid4().hex}.part"
            os.makedirs(part)
            for f in (source, *sidecars):
                (shutil.copytree if os.path.isdir(f) else shutil.copy2)(f, os.path.join(part, os.path.basename(f)))
            os.rename(part, place)
        try:
            inside = os.path.relpath(entrypoint, os.path.dirname(source))
            yield os.path.join(place, inside)
        finally:
            if settings.staging_cleanup:
                shutil.rmtree(place, ignore_errors=True)


@contextlib.contextmanager
def opened(source: str, entrypoint: str, sidecars=(), settings: Settings = Settings()):
    """The first reader that opens the slide; what all of them said, if none does."""
    with staged(source, entrypoint, () if sidecars is None else tuple(sidecars), settings) as path:
        said, reader = [], None
        for name in backends(settings):
            try:
                reader = BACKENDS[name](path)
                break
            except Exception as e:
                said.append(f"{name}: {e}")
        if reader is None:
            raise ReaderOpenError(f"cannot open {path} ({'; '.join(said)})")
        try:
            yield reader
        finally:
            reader.close()
