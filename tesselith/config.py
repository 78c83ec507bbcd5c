"""Settings: defaults, then a YAML or JSON file, then key=value overrides; unknown keys and bad values are refused."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field, fields, is_dataclass

# fixed values: names and defaults of the settings are the public surface


@dataclass(frozen=True)
class Reader:
    backend: str = "auto"
    fallback: str = "openslide"
    thumbnail_width: int = 2048
    staging_enabled: bool = False
    staging_root: str = "/dev/shm/tesselith"
    staging_cleanup: bool = True


@dataclass(frozen=True)
class Patching:
    level: int = 0
    patch_size: int = 1200
    output_size: int = 1200
    stride: int = 1200
    min_region_fraction: float = 0.10
    inclusion: str = "fraction"
    max_patches_per_slide: int = 0
    sampling: str = "all"
    seed: int = 0
    mpp: float | None = None


@dataclass(frozen=True)
class Output:
    root: str = "outputs/patches"
    mode: str = "jpeg"
    jpeg_quality: int = 90
    shard_max_count: int = 1000
    tar_preview: bool = False
    tar_preview_n: int = 20
    tar_preview_seed: int = 0
    overwrite: bool = False
    permissions: str | int = "777"


@dataclass(frozen=True)
class Parallel:
    slide_workers: int = 4
    read_workers_per_slide: int = 4
    encode_workers: int = 2
    writer_workers: int = 2
    max_inflight_patches: int = 32
    max_inflight_bytes: int = 536_870_912
    opencv_threads: int = 1


@dataclass(frozen=True)
class Logging:
    root: str = "logs"
    level: str = "INFO"


@dataclass(frozen=True)
class Preview:
    root: str = "outputs/preview"
    n_patches: int = 8
    seed: int = 0


@dataclass(frozen=True)
class Config:
    reader: Reader = field(default_factory=Reader)
    patching: Patching = field(default_factory=Patching)
    output: Output = field(default_factory=Output)
    parallel: Parallel = field(default_factory=Parallel)
    logging: Logging = field(default_factory=Logging)
    preview: Preview = field(default_factory=Preview)
    heuristic_pipe: tuple = ("density",)
    heuristic_strategy: str = "first"
    heuristic_arbitration: dict = field(default_factory=dict)
    heuristics: dict = field(default_factory=dict)
    post_filter_pipe: tuple = ()
    post_filters: dict = field(default_factory=dict)

    @property
    def signature(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True, separators=(",", ":")).encode()).hexdigest()

    @property
    def batch_patches(self) -> int:
        """Patches of a micro-batch: as many as are allowed in number and in decoded bytes, one at least."""
        return max(1, min(self.parallel.max_inflight_patches, self.parallel.max_inflight_bytes // max(1, 3 * self.patching.output_size**2)))


def _made(kind, values: dict):
    known = {f.name: f for f in fields(kind)}
    if unknown := set(values) - set(known):
        raise ValueError(f"unknown settings of {kind.__name__}: {sorted(unknown)}")
    sub = {name: type(f.default_factory()) for name, f in known.items() if callable(f.default_factory)} if kind is Config else {}
    out = {}
    for name, v in values.items():
        part = sub.get(name)
        out[name] = _made(part, v or {}) if part and is_dataclass(part) else tuple(v) if name.endswith("_pipe") else v
    return kind(**out)


def _merged(a: dict, b: dict) -> dict:
    return a | {k: _merged(a[k], v) if isinstance(v, dict) and isinstance(a.get(k), dict) else v for k, v in b.items()}


def octal_mode(value) -> int:
    """A file mode from one to three octal digits, as text or number, with 0o in front or not."""
    text = str(value).strip().lower().removeprefix("0o")
    if isinstance(value, bool) or not 1 <= len(text) <= 3 or set(text) - set("01234567"):
        raise ValueError(f"not an octal mode from 000 to 777: {value!r}")
    return int(text, 8)


def checked(c: Config) -> Config:
    p, o = c.patching, c.output
    octal_mode(o.permissions)
    workers = (c.parallel.slide_workers, c.parallel.read_workers_per_slide, c.parallel.encode_workers, c.parallel.writer_workers, c.parallel.max_inflight_patches)
    rules = {
        "sizes and stride are above zero": min(p.patch_size, p.output_size, p.stride) > 0, "level is not negative": p.level >= 0, "min_region_fraction is in 0..1": 0 <= p.min_region_fraction <= 1,
        "inclusion is fraction, center or full": p.inclusion in ("fraction", "center", "full"), "sampling is all, random or uniform": p.sampling in ("all", "random", "uniform"),
        "max_patches_per_slide is not negative": p.max_patches_per_slide >= 0, "mode is jpeg, png, tar or none": o.mode in ("jpeg", "png", "tar", "none"), "shard_max_count is above zero": o.shard_max_count > 0,
        "tar_preview_n is not negative": o.tar_preview_n >= 0, "jpeg_quality is in 1..100": 1 <= o.jpeg_quality <= 100, "thumbnail_width is above zero": c.reader.thumbnail_width > 0,
        "heuristic_strategy is first or arbitrate": c.heuristic_strategy in ("first", "arbitrate"), "there is a heuristic": len(c.heuristic_pipe) > 0, "mpp is above zero": p.mpp is None or p.mpp > 0,
        "filters have names": all(isinstance(x, str) and x for x in c.post_filter_pipe), "workers and patches in flight are above zero": min(workers) > 0, "n_patches is not negative": c.preview.n_patches >= 0,
    }
    if broken := [k for k, ok in rules.items() if not ok]:
        raise ValueError("; ".join(broken))
    return c


def load_config(path: str | None = None, overrides: tuple[str, ...] = ()) -> Config:
    import yaml

    values: dict = {}
    if path:
        with open(path) as f:
            values = (json.load(f) if str(path).lower().endswith(".json") else yaml.safe_load(f)) or {}
    for item in overrides:
        key, mark, value = item.partition("=")
        if not mark:
            raise ValueError(f"not key=value: {item}")
        tree = yaml.safe_load(value)
        for part in reversed(key.split(".")):
            tree = {part: tree}
        values = _merged(values, tree)
    return checked(_made(Config, values))


def dumped(c: Config) -> str:
    """All settings as YAML, in their order."""
    import yaml

    return yaml.safe_dump(json.loads(json.dumps(asdict(c))), sort_keys=False, allow_unicode=True)
