"""Where patches go: image files, TAR shards, or nowhere; and what is beside them: index, samples, previews.

A file has its name only when it is whole, and a task that runs twice writes the same files again. Paths are on a file
system that all executors share.
"""

from __future__ import annotations

import contextlib
import glob
import hashlib
import heapq
import json
import os
import tarfile
import uuid

import numpy as np

from ..config import Output, octal_mode
from ..functions import raster
from . import jpeg, png

QUALITY = 92


def published(path: str, data: bytes, overwrite: bool = True) -> bool:
    """Write a file under a hidden name, then give it its own; False if it is there and shall stay."""
    folder = os.path.dirname(path)
    os.makedirs(folder, exist_ok=True)
    hidden = os.path.join(folder, f".{uuid.uuid4().hex}.part")
    try:
        with open(hidden, "wb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        if overwrite:
            os.replace(hidden, path)
            return True
        with contextlib.suppress(FileExistsError):
            os.link(hidden, path)
            return True
        return False
    finally:
        with contextlib.suppress(FileNotFoundError):
            os.unlink(hidden)


class Sink:
    """How a mode names and encodes a patch, and what it makes of it at once. Subclasses are found by mode."""

    extension = ""

    def __init__(self, settings: Output):
        self.settings = settings

    def encode(self, image: np.ndarray) -> bytes:
        return b""

    def publish(self, slide_id: str, name: str, data: bytes) -> str:
        """What is left to be written later is returned by keeps."""
        return name

    #: whether the bytes go on with the row, for a writer to come
    keeps = False


class ImageFiles(Sink):
    def publish(self, slide_id, name, data):
        path = os.path.join(self.settings.root, slide_id, name)
        if not published(path, data, self.settings.overwrite) and not os.path.getsize(path):
            raise FileExistsError(path)
        return name


class JpegFiles(ImageFiles):
    extension = ".jpeg"

    def encode(self, image):
        return jpeg.encoded(image, self.settings.jpeg_quality)


class PngFiles(ImageFiles):
    extension = ".png"

    def encode(self, image):
        return png.encoded(image)


class Shards(JpegFiles):
    keeps = True

    def publish(self, slide_id, name, data):
        return name


class Nowhere(Sink):
    def publish(self, slide_id, name, data):
        return ""


SINKS = {"jpeg": JpegFiles, "png": PngFiles, "tar": Shards, "none": Nowhere}


def sink(settings: Output) -> Sink:
    return SINKS[settings.mode](settings)


def shard_number(folder: str) -> int:
    """The greatest number among the shards of a slide's folder, 0 without any."""
    slide = os.path.basename(folder.rstrip("/"))
    names = [os.path.basename(f)[len(slide) + 1 : -4] for f in glob.glob(os.path.join(glob.escape(folder), f"{glob.escape(slide)}_*.tar"))]
    if any(not n.isdigit() for n in names):
        raise ValueError(f"a shard of another name in {folder}")
    return max(map(int, names), default=0)


def members(folder: str):
    """shard and name of the images in a slide's shards, in order; the first of each name."""
    slide, seen = os.path.basename(folder.rstrip("/")), set()
    for path in sorted(glob.glob(os.path.join(glob.escape(folder), f"{glob.escape(slide)}_*.tar"))):
        if os.path.getsize(path):
            with tarfile.open(path) as tar:
                for m in tar:
                    if m.isfile() and m.name.lower().endswith((".jpg", ".jpeg")) and m.name not in seen:
                        seen.add(m.name)
                        yield path, m.name


def completed(folder: str, mode: str) -> dict[str, str]:
    """File name to output of what an earlier run has left."""
    if mode == "tar":
        return {name: f"{os.path.basename(path)}/{name}" for path, name in members(folder)}
    kind = SINKS[mode].extension
    files = glob.glob(os.path.join(glob.escape(folder), f"*{kind}")) if kind else []
    return {os.path.basename(f): os.path.basename(f) for f in files if os.path.isfile(f) and os.path.getsize(f)}


def there(path: str) -> bool:
    return os.path.isfile(path) and os.path.getsize(path) > 0


def complete_count(folder: str, mode: str) -> int | None:
    """Patches of a folder whose index is sound and whose files are all there; None otherwise."""
    try:
        with open(os.path.join(folder, "index.json"), encoding="utf-8") as f:
            index = json.load(f)
        files = {p["shard" if mode == "tar" else "name"] for p in index["patches"]}
        if mode != "none" and int(index["patch_count"]) == len(index["patches"]) and all(there(os.path.join(folder, x)) for x in files):
            return len(index["patches"])
    except (OSError, KeyError, TypeError, ValueError):
        pass
    return None


def preview_paths(root: str, slide_id: str) -> tuple[str, str]:
    top = os.path.join(os.path.dirname(root.rstrip("/")), "preview")
    return os.path.join(top, "thumbnail", f"{slide_id}.jpeg"), os.path.join(top, "mask", f"{slide_id}.jpg")


def previews_complete(settings: Output, slide_id: str, patches: int) -> bool:
    if not all(map(there, preview_paths(settings.root, slide_id))):
        return False
    if settings.mode != "tar" or not settings.tar_preview:
        return True
    samples = glob.glob(os.path.join(glob.escape(os.path.join(settings.root, slide_id, "sample")), "*.jpeg"))
    return len(samples) >= min(settings.tar_preview_n, patches)


def write_index(folder: str, outputs: list[str], shards: bool) -> None:
    """index.json: outputs in the order of their plans, numbered anew."""
    entries = [{"index": i, **dict(zip(("shard", "name") if shards else ("name",), x.split("/", 1) if shards else (x,)))} for i, x in enumerate(outputs)]
    entries = [{k: e[k] for k in ("index", "name", "shard") if k in e} for e in entries]
    document = json.dumps({"patch_count": len(entries), "patches": entries}, ensure_ascii=False, indent=2) + "\n"
    published(os.path.join(folder, "index.json"), document.encode())


def sample_score(name: str, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed}:{name}".encode(), digest_size=8).digest(), "big")


def write_samples(folder: str, count: int, seed: int) -> list[str]:
    """Copies of the count members with the least scores, in their order; other samples go."""
    best = heapq.nsmallest(count, ((sample_score(n, seed), n, p) for p, n in members(folder)))
    if not best:
        return []
    names = [n for _, n, _ in best]
    for f in glob.glob(os.path.join(glob.escape(folder), "sample", "*.jp*g")):
        if os.path.basename(f) not in names:
            os.unlink(f)
    for path in sorted({p for _, _, p in best}):
        with tarfile.open(path) as tar:
            for _, name, where in best:
                if where == path:
                    published(os.path.join(folder, "sample", name), tar.extractfile(name).read())
    return names


GREEN, RED = (0, 220, 0), (255, 0, 0)


def overlay(thumbnail: np.ndarray, mask: np.ndarray, plans, slide_size: tuple[int, int]) -> np.ndarray:
    """The region's outline, and the frames of plans (x, y, read size), in the thumbnail's pixels."""
    out = thumbnail.copy()
    h, w = out.shape[:2]
    thick = max(2, min(h, w) // 300)
    near = raster.dilated(mask, raster.odd(thick, 3)) if mask.any() else mask
    out[near & ~raster.eroded(mask, 3)] = GREEN
    at = lambda v, n: min(n - 1, max(0, int(v)))
    for x, y, size in plans:
        a, b = x * w / slide_size[0], y * h / slide_size[1]
        c, d = a + size * w / slide_size[0], b + size * h / slide_size[1]
        a, b, c, d = at(a, w), at(b, h), at(c, w), at(d, h)
        out[b : d + 1, [a, c]] = RED
        out[[b, d], a : c + 1] = RED
    return out


def write_previews(settings: Output, slide_id: str, thumbnail: np.ndarray, drawn: np.ndarray) -> None:
    for path, image in zip(preview_paths(settings.root, slide_id), (thumbnail, drawn)):
        published(path, jpeg.encoded(image, QUALITY))


def set_modes(top: str, permissions) -> None:
    """One mode for a tree, from the leaves up; links are left alone."""
    mode = octal_mode(permissions)
    if not os.path.exists(top):
        return

    def stop(error):
        raise error

    for folder, folders, files in os.walk(top, topdown=False, followlinks=False, onerror=stop):
        for name in (*files, *folders):
            if not os.path.islink(p := os.path.join(folder, name)):
                os.chmod(p, mode)
        os.chmod(folder, mode)
