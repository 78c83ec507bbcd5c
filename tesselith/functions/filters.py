"""Filters of patches: a contract, a registry, and chains in which the first rejection counts.

A filter gets a batch of RGB patches and its options, and gives a Verdict for each. Where a filter fails on a patch, the patch is dropped
and the failure is the reason; a filter that cannot work at all raises SetupError, which fails the slide.
"""

from __future__ import annotations

import hashlib
import os
from dataclasses import dataclass, field

import numpy as np

from . import raster, regions


@dataclass(frozen=True)
class Verdict:
    keep: bool
    reason: str = ""
    metrics: dict = field(default_factory=dict)
    name: str = ""


class SetupError(RuntimeError):
    pass


class PatchFilter:
    """Subclasses define name and evaluate(), or evaluate_many() where patches are better judged together."""

    name = ""

    def evaluate(self, image: np.ndarray, options: dict) -> Verdict:
        raise NotImplementedError

    def evaluate_many(self, images: list[np.ndarray], options: dict) -> list[Verdict]:
        out = []
        for image in images:
            try:
                out.append(self.evaluate(image, options))
            except SetupError:
                raise
            except Exception as e:
                out.append(Verdict(False, f"{type(e).__name__}: {e}", {"exception_type": type(e).__name__}, self.name))
        return out


FILTERS: dict[str, type[PatchFilter]] = {}


def register(cls: type[PatchFilter]) -> type[PatchFilter]:
    if not cls.name or FILTERS.get(cls.name, cls) is not cls:
        raise ValueError(f"name is empty or taken: {cls.name!r}")
    FILTERS[cls.name] = cls
    return cls


def get(name: str) -> PatchFilter:
    if name not in FILTERS:
        raise KeyError(f"no such filter: {name!r}; there are {sorted(FILTERS)}")
    return FILTERS[name]()


@register
class NonEmpty(PatchFilter):
    name = "nonempty"

    def evaluate(self, image, options):
        keep, metrics = regions.nonempty(image, options)
        return Verdict(keep, "shows something" if keep else "nonempty", metrics, self.name)


# fixed values: what the published description of the classifier gives
QC_THRESHOLD, QC_SIZE, QC_MEAN, QC_STD = 0.14677508175373077, 256, (0.485, 0.456, 0.406), (0.229, 0.224, 0.225)


def scaled_batch(images: list[np.ndarray], size: int = QC_SIZE) -> np.ndarray:
    """Patches as one uint8 array (patch, channel, row, column): a quarter of what floats would take on the way."""
    return np.ascontiguousarray(np.stack([raster.resized(x, size, size) for x in images]).transpose(0, 3, 1, 2))


def normalized(batch: np.ndarray) -> np.ndarray:
    """uint8 to floats of the mean and deviation that networks of this kind are trained with."""
    if batch.dtype != np.uint8 or batch.ndim != 4 or batch.shape[1] != 3:
        raise SetupError(f"not a uint8 batch of three channels: {batch.dtype}, {batch.shape}")
    mean, std = (np.array(v, np.float32).reshape(1, 3, 1, 1) for v in (QC_MEAN, QC_STD))
    return (batch.astype(np.float32) / 255 - mean) / std


def checkpoint(path: str | None, sha256: str | None = None) -> str:
    """The file of a scorer; its content has to have the hash, if one is given."""
    if not path or not os.path.isfile(path):
        raise SetupError(f"no checkpoint: {path}")
    if sha256:
        with open(path, "rb") as f:
            found = hashlib.file_digest(f, "sha256").hexdigest()
        if found != sha256:
            raise SetupError(f"checkpoint has the hash {found}")
    return os.path.realpath(path)


class OnnxScorer:
    """Two logits a patch from an ONNX file, on the CPU."""

    def __init__(self, path: str, sha256: str | None = None):
        try:
            import onnxruntime
        except ImportError as e:
            raise SetupError("the qc filter needs onnxruntime, or a scorer of yours") from e
        self.session = onnxruntime.InferenceSession(checkpoint(path, sha256), providers=["CPUExecutionProvider"])

    def __call__(self, batch: np.ndarray) -> np.ndarray:
        return self.session.run(None, {self.session.get_inputs()[0].name: normalized(batch)})[0]


#: name to a function from options to a scorer, which is a function from a uint8 batch to two logits a patch
SCORERS: dict = {"onnx": lambda options: OnnxScorer(options.get("checkpoint"), options.get("sha256"))}


@register
class Quality(PatchFilter):
    """Keeps patches whose second softmax share is at the threshold or above. The scorer is loaded once a worker."""

    name = "qc"
    loaded: dict = {}

    def evaluate_many(self, images, options):
        if not images:
            return []
        key = repr(sorted(options.items()))
        if key not in self.loaded:
            kind = options.get("scorer", "onnx")
            if kind not in SCORERS:
                raise SetupError(f"no such scorer: {kind!r}")
            self.loaded[key] = SCORERS[kind](options)
        score, most, out = self.loaded[key], int(options.get("batch_size", 128)), []
        threshold = float(options["threshold"] if options.get("threshold") is not None else QC_THRESHOLD)
        for i in range(0, len(images), most):
            logits = np.asarray(score(scaled_batch(images[i : i + most], int(options.get("input_size", QC_SIZE)))), np.float64)
            for p in (1 / (1 + np.exp(logits[:, 0] - logits[:, 1]))).tolist():
                out.append(Verdict(p >= threshold, "accepted" if p >= threshold else "rejected by qc", {"score": p, "threshold": threshold}, self.name))
        return out


def run_many(images: list[np.ndarray], names, options: dict) -> list[Verdict]:
    """Verdicts of a chain: each filter sees what is left, the first rejection counts, an empty chain keeps all."""
    out: list[Verdict] = [Verdict(True)] * len(images)
    for name in names:
        left = [i for i, v in enumerate(out) if v.keep]
        found = get(name).evaluate_many([images[i] for i in left], options.get(name, {}))
        if len(found) != len(left):
            raise SetupError(f"{name} gave {len(found)} verdicts for {len(left)} patches")
        for i, v in zip(left, found):
            out[i] = v
    return out
