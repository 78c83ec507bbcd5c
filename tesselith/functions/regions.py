"""Heuristics that find the region of interest in a thumbnail, and the patch filter for empty patches.

A heuristic takes an RGB image and its options, and gives a Decision. They are held in REGISTRY by name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np

from . import raster as ra


@dataclass(frozen=True)
class Decision:
    name: str
    status: str  # accepted, not_applicable, rejected, error
    confidence: float = 0.0
    reason: str = ""
    mask: np.ndarray | None = None
    metrics: dict = field(default_factory=dict)


REGISTRY: dict = {}


def heuristic(name: str):
    def add(f):
        if not name or name in REGISTRY:
            raise ValueError(f"name is empty or taken: {name!r}")
        REGISTRY[name] = f
        return f

    return add


def run(name: str, image: np.ndarray, options: dict | None = None) -> Decision:
    """A decision in any case: what goes wrong, and an accepted mask that is not usable, is an error."""
    if name not in REGISTRY:
        return Decision(name, "error", reason=f"KeyError: {name}")
    try:
        d = REGISTRY[name](ra.prepared(image), options or {})
    except Exception as e:
        return Decision(name, "error", reason=f"{type(e).__name__}: {e}")
    if d.status != "accepted":
        return d
    if d.mask is None or d.mask.dtype != bool or d.mask.shape != image.shape[:2] or not d.mask.any():
        return Decision(name, "error", reason="accepted without a usable mask", metrics=d.metrics)
    return Decision(name, "accepted", max(0.0, min(1.0, d.confidence)), d.reason, d.mask, d.metrics)


def run_pipeline(image: np.ndarray, names=("density",), options: dict | None = None, strategy: str = "first", arbitration: dict | None = None) -> Decision:
    """One image through a pipe of heuristics: the first that accepts, or, arbitrated, the surest that is safe against density.

    The same rules as for decisions in a DataFrame; metrics has the attempts.
    """
    options, attempts, accepted = options or {}, [], []
    for name in names:
        o = options.get(name, {})
        d = run(name, image, o)
        if d.status == "accepted" and d.confidence < float(o.get("min_confidence", 0.0)):
            d = Decision(name, "rejected", d.confidence, f"confidence {d.confidence:.3f} is below {o['min_confidence']}", metrics=d.metrics)
        attempts.append({"name": name, "status": d.status, "confidence": d.confidence, "reason": d.reason})
        if d.status == "accepted":
            accepted.append(d)
            if strategy == "first":
                break
    if not accepted:
        return Decision("pipeline", "rejected", reason="no heuristic found a region", metrics={"attempts": attempts})
    chosen = accepted[0]
    ref = next((d for d in accepted if d.name == "density"), None)
    if strategy == "arbitrate" and ref is not None:
        a = {"min_specialized_confidence": 0.65, "min_density_recall": 0.90, "max_density_area_ratio": 3.5} | (arbitration or {})
        n, safe = max(1, int(ref.mask.sum())), []
        for d in accepted:
            o = options.get(d.name, {})
            fits = (d.mask & ref.mask).sum() / n >= o.get("min_density_recall", a["min_density_recall"]) and d.mask.sum() / n <= o.get("max_density_area_ratio", a["max_density_area_ratio"])
            if d is not ref and d.confidence >= o.get("arbitration_min_confidence", a["min_specialized_confidence"]) and (fits or not o.get("density_guard", True)):
                safe.append(d)
        chosen = max(safe, key=lambda d: d.confidence, default=ref)
    return Decision(chosen.name, "accepted", chosen.confidence, chosen.reason, chosen.mask, chosen.metrics | {"attempts": attempts, "strategy": strategy})


def foreground(image: np.ndarray, delta: float = 10.0) -> np.ndarray:
    """Pixels whose colour is away from the light border's median, or that are dark, but not near black."""
    m = min(image.shape[:2])
    band = max(2, round(0.035 * m))
    x = ra.lab(image)
    border = np.concatenate([s.reshape(-1, 3) for s in (x[:band], x[-band:], x[:, :band], x[:, -band:])])
    ground = np.median(border[border[:, 0] >= np.percentile(border[:, 0], 55)], axis=0)
    d = x - ground
    g = ra.grey(image)
    seed = (np.sqrt(0.25 * d[..., 0] ** 2 + d[..., 1] ** 2 + d[..., 2] ** 2) >= delta) | (g < min(210.0, np.percentile(g, 20)))
    return seed & ~(image < 35).all(axis=2)


def parts(mask: np.ndarray, least: float) -> list[np.ndarray]:
    """Filled parts of at least that area by their outline, largest first; if there is none, the largest of 8 or more."""
    labels, n = ra.components(mask)
    found = []
    for k in range(1, n + 1):
        part = labels == k
        if part.sum() >= 3:
            found.append((ra.polygon_area(ra.outline(part)), k))
    found.sort(key=lambda x: (-x[0], x[1]))
    good = [k for a, k in found if a >= least] or [k for a, k in found[:1] if a >= 8]
    return [ra.filled(labels == k) for k in good]


@heuristic("density")
def density(image: np.ndarray, options: dict) -> Decision:
    h, w = image.shape[:2]
    m = min(h, w)
    seed = foreground(image, options.get("color_delta", 9.0))
    if not seed.any():
        return Decision("density", "rejected", reason="no foreground")
    field_ = ra.blurred(seed.astype(float), max(1.2, 0.018 * m))
    for factor in (1.0, 1.5, 2.25, 3.25):
        raw = field_ > max(0.008, 0.12 * field_.max() * factor)
        found = parts(ra.opened(ra.closed(raw, ra.odd(0.025 * m)), ra.odd(0.008 * m)), max(8.0, 0.0005 * h * w))
        mask = np.logical_or.reduce(found) if found else np.zeros((h, w), bool)
        share = mask.mean()
        if 0 < share <= 0.95:
            return Decision("density", "accepted", min(0.98, 0.45 + 2 * min(share, 0.25) + min(seed.mean(), 0.1)), "", mask, {"fraction": float(share)})
    return Decision("density", "rejected", reason="nothing left" if share == 0 else "covers everything")


def content(image: np.ndarray) -> list[tuple[dict, np.ndarray]]:
    """Shapes of the content's parts, largest first."""
    m = min(image.shape[:2])
    f = ra.blurred(foreground(image, 8.0).astype(float), max(1.0, 0.012 * m))
    size = ra.odd(0.018 * m)
    mask = ra.opened(ra.closed(f > max(0.025, 0.16 * f.max()), size), size)
    found = [(ra.shape_of(p), p) for p in parts(mask, 1.0)]
    return sorted(found, key=lambda x: -x[0]["area"])


@heuristic("single_circle")
def single_circle(image: np.ndarray, options: dict) -> Decision:
    h, w = image.shape[:2]
    found = content(image) if 0.72 <= w / h <= 1.40 else []
    s = found[0][0] if found else None
    if not s or not (0.08 <= s["area_fraction"] <= 0.88 and s["circularity"] >= 0.66 and s["solidity"] >= 0.86 and s["fill"] >= 0.60 and s["center_distance"] <= 0.22):
        return Decision("single_circle", "not_applicable", reason="no round content in the middle")
    mask = ra.disk((h, w), s["x"], s["y"], s["radius"] * options.get("expansion", 1.04))
    return Decision("single_circle", "accepted", min(0.99, 0.35 + 0.30 * s["circularity"] + 0.20 * s["fill"] + 0.15 * s["solidity"]), "", mask, s)


@heuristic("double_circle")
def double_circle(image: np.ndarray, options: dict) -> Decision:
    h, w = image.shape[:2]
    found = [s for s, _ in content(image)] if w / h >= 1.45 else []
    found = [s for s in found if 0.025 <= s["area_fraction"] <= 0.32 and s["circularity"] >= 0.58 and s["fill"] >= 0.50][:4]
    pairs = [(abs(a["x"] - b["x"]), i, j) for i, a in enumerate(found) for j, b in enumerate(found) if i < j]
    if not pairs:
        return Decision("double_circle", "not_applicable", reason="no two round parts")
    _, i, j = max(pairs, key=lambda p: (p[0], -p[1], -p[2]))
    a, b = found[i], found[j]
    ratio = min(a["radius"], b["radius"]) / max(a["radius"], b["radius"])
    mean = (a["radius"] + b["radius"]) / 2
    apart = math.hypot(a["x"] - b["x"], a["y"] - b["y"]) / max(1e-6, mean)
    if ratio < 0.55 or apart < 2.3 or abs(a["y"] - b["y"]) / h > 0.22:
        return Decision("double_circle", "not_applicable", reason="the two do not match")
    k = options.get("expansion", 1.04)
    mask = ra.disk((h, w), a["x"], a["y"], a["radius"] * k) | ra.disk((h, w), b["x"], b["y"], b["radius"] * k)
    return Decision("double_circle", "accepted", min(0.98, 0.55 + 0.25 * ratio + 0.1 * min(1.0, apart / 4)), "", mask, {"ratio": ratio, "apart": apart})


@heuristic("smear")
def smear(image: np.ndarray, options: dict) -> Decision:
    h, w = image.shape[:2]
    found = content(image)
    if not found:
        return Decision("smear", "not_applicable", reason="no content")
    s, part = found[0]
    low, high = image.min(axis=2).astype(int), image.max(axis=2).astype(int)
    stain = (high - low >= 10) & (low < 230)
    tiles = min(t.mean() for rows in np.array_split(stain, 5, axis=0) for t in np.array_split(rows, 5, axis=1))
    full = options.get("full_field", True) and 0.90 < s["area_fraction"] <= 1.0 and s["solidity"] >= 0.95 and s["touches"] >= 3 and tiles >= 0.15
    if full:
        return Decision("smear", "accepted", 0.92, "full_field", part, s | {"tiles": float(tiles)})
    if not (0.10 <= s["area_fraction"] <= 0.90 and s["aspect"] >= 1.45 and s["solidity"] >= 0.80 and s["circularity"] >= 0.35):
        return Decision("smear", "not_applicable", reason="no long smooth part")
    mask = ra.dilated(part, ra.odd(0.015 * min(h, w)))
    return Decision("smear", "accepted", min(0.97, 0.45 + 0.18 * min(s["aspect"], 2.5) + 0.1 * s["solidity"]), "standard", mask, s)


@heuristic("qmh_center_circle")
def portrait_circle(image: np.ndarray, options: dict) -> Decision:
    """A circle wider than a portrait canvas, around its middle, clipped by the canvas; dark fixtures at the sides do not count."""
    h, w = image.shape[:2]
    if not 0.30 <= w / h <= 0.60:
        return Decision("qmh_center_circle", "not_applicable", reason="not a portrait canvas")
    dark = ra.closed((image <= 70).all(axis=2), ra.odd(0.004 * w))
    labels, n = ra.components(dark)
    side = max(1, round(0.025 * w))
    at_side = set(np.unique(labels[:, :side])) | set(np.unique(labels[:, -side:]))
    sizes = np.bincount(labels.ravel(), minlength=n + 1)
    fixture = np.isin(labels, [k for k in at_side if k and sizes[k] >= 0.001 * w * w])
    if fixture.any():
        fixture = ra.dilated(fixture, ra.odd(0.025 * w))
    top, bottom = max(0, round(h / 2 - 0.85 * w)), min(h, round(h / 2 + 0.85 * w))
    seed = foreground(image, 5.0)[top:bottom] & ~fixture[top:bottom]
    step = max(1, -(-w // 256))
    small = seed[: len(seed) // step * step, : w // step * step].reshape(len(seed) // step, step, w // step, step).mean(axis=(1, 3))
    sw = small.shape[1]
    ev = ra.blurred(small, max(0.5, 0.005 * sw))
    yy, xx = np.mgrid[: ev.shape[0], : sw]
    best = None
    for dx in np.arange(-0.12, 0.121, 0.03):
        for dy in np.arange(-0.12, 0.121, 0.03):
            for r in np.arange(0.52, 0.601, 0.02):
                d = np.hypot(xx - (0.5 + dx) * sw, yy - (ev.shape[0] / 2 + dy * sw)) / (r * sw)
                inner, ring = ev[d <= 1.0], ev[(d >= 1.04) & (d <= 1.25)]
                contrast = inner.mean() - (ring.mean() if ring.size else 0.0)
                score = contrast - 0.006 * math.hypot(dx, dy) / 0.12 - 0.004 * abs(r - 0.56) / 0.04
                if best is None or score > best[0]:
                    best = (score, contrast, dx, dy, r)
    _, contrast, dx, dy, r = best
    trust = min(1.0, max(0.0, (contrast - 0.004) / 0.036))
    mask = ra.disk((h, w), w / 2 + trust * dx * w, h / 2 + trust * dy * w, w * (0.56 + trust * (r - 0.56))) & ~fixture
    return Decision("qmh_center_circle", "accepted", min(0.97, 0.72 + 0.23 * trust), "", mask, {"contrast": float(contrast)})


# fixed values: settings of the radial fit and the weights of its score, in parts of the shorter side or of the canvas
RADIAL = {
    "radial_blue_floor": 0.5, "radial_chroma_floor": 1.5, "radial_signal_sigma_ratio": 0.003, "radial_min_radius": 0.27, "radial_max_radius": 0.36, "radial_band_ratio": 0.012,
    "radial_angle_count": 72, "radial_center_extent": 0.09, "radial_center_step": 0.012, "preferred_radius_fraction": 0.32, "prior_center_x_fraction": 0.50, "prior_center_y_fraction": 0.41,
    "outer_annulus_min": 0.36, "outer_annulus_max": 0.53, "outer_dark_threshold": 10.0, "min_outer_artifact_fraction": 0.025, "max_outer_artifact_fraction": 0.45,
    "min_inner_radial_score": 0.0, "min_inner_radial_positive_support": 0.65, "min_inner_radial_mean_difference": 0.02,
}
SCORE = {"low": 1.0, "mean": 0.50, "spread": -0.30, "support": 0.08, "off": -0.10, "size": -0.04}


def radial_fit(image: np.ndarray, artifact: np.ndarray, o: dict) -> dict:
    """The circle whose inside is bluer, more colourful and darker than its outside, all around: x, y, radius, score and its parts."""
    h, w = image.shape[:2]
    m, rgb, x = min(h, w), image.astype(np.float64), ra.lab(image)
    blue, chroma = rgb[..., 2] - (rgb[..., 0] + rgb[..., 1]) / 2, np.hypot(x[..., 1] - 128, x[..., 2] - 128)
    signal = np.maximum(blue - o["radial_blue_floor"], 0) + 0.30 * np.maximum(chroma - o["radial_chroma_floor"], 0) + 0.08 * np.maximum(254.0 - ra.grey(image), 0)
    signal[artifact] = 0.0
    signal = ra.blurred(signal, max(1.5, m * o["radial_signal_sigma_ratio"]))
    px, py = w * o["prior_center_x_fraction"], h * o["prior_center_y_fraction"]
    band, radii = max(3, round(m * o["radial_band_ratio"])), np.arange(round(m * o["radial_min_radius"]), round(m * o["radial_max_radius"]) + 1, 2)
    best = {"score": -np.inf, "x": px, "y": py, "radius": m * o["preferred_radius_fraction"], "support": 0.0, "mean": 0.0, "fallback": True}
    if not len(radii):
        return best

    def look(cx, cy):
        sums = np.pad(np.cumsum(ra.polar(signal, cx, cy, int(radii[-1]) + band + 2, int(o["radial_angle_count"])), axis=1), ((0, 0), (1, 0)))
        diff = (sums[:, radii] - sums[:, radii - band] - sums[:, radii + 1 + band] + sums[:, radii + 1]) / band
        parts = {"low": np.percentile(diff, 35, axis=0), "mean": diff.mean(axis=0), "spread": diff.std(axis=0), "support": (diff > 0.02).mean(axis=0), "off": np.full(len(radii), math.hypot(cx - px, cy - py) / m), "size": np.abs(radii - m * o["preferred_radius_fraction"]) / m}
        score = sum(SCORE[k] * v for k, v in parts.items())
        k = int(np.argmax(score))
        return {"score": float(score[k]), "x": cx, "y": cy, "radius": float(radii[k]), "fallback": False} | {n: float(v[k]) for n, v in parts.items()}

    step = max(4, round(m * o["radial_center_step"]))
    reach, fine = m * o["radial_center_extent"], max(2, step // 4)
    around = lambda c, r, s: range(round(c - r), round(c + r) + 1, s)
    for r, s in ((reach, step), (step, fine)):
        mx, my = best["x"], best["y"]
        best = max([best, *(look(cx, cy) for cy in around(my, r, s) for cx in around(mx, r, s))], key=lambda b: b["score"])
    return best


@heuristic("serrated_outer_circle")
def serrated(image: np.ndarray, options: dict) -> Decision:
    """A core inside a toothed outer ring: a radial fit of the core's edge, together with what density finds inside."""
    o = RADIAL | {k: v for k, v in options.items() if k in RADIAL}
    h, w = image.shape[:2]
    m = min(h, w)
    yy, xx = np.mgrid[:h, :w]
    dark = 255.0 - ra.grey(image)
    radius = np.hypot(xx - w / 2, yy - h / 2) / m
    ring = (radius >= o["outer_annulus_min"]) & (radius <= o["outer_annulus_max"])
    artifact = ring & (dark >= o["outer_dark_threshold"])
    outer = float(artifact.sum() / max(1, ring.sum()))
    if not o["min_outer_artifact_fraction"] <= outer <= o["max_outer_artifact_fraction"]:
        return Decision("serrated_outer_circle", "not_applicable", reason="no toothed ring", metrics={"outer": outer})
    fit = radial_fit(image, artifact, o)
    metrics = {"outer": outer, "radius": fit["radius"], "support": fit["support"], "fallback": fit["fallback"]}
    weak = fit["score"] < o["min_inner_radial_score"] or fit["support"] < o["min_inner_radial_positive_support"] or fit["mean"] < o["min_inner_radial_mean_difference"]
    if weak and not fit["fallback"]:
        return Decision("serrated_outer_circle", "rejected", reason="no clear core", metrics=metrics)
    core = fit["radius"] * options.get("expansion", 1.0)
    if core >= 0.90 * 0.5 * m:
        return Decision("serrated_outer_circle", "rejected", reason="core as large as the ring", metrics=metrics)
    safe = radius <= 0.445
    inside = image.copy()
    inside[~safe] = 255
    dense = density(inside, options.get("within_density", {}))
    mask = ra.disk((h, w), fit["x"], fit["y"], core)
    if dense.status == "accepted":
        mask = mask | ra.dilated(dense.mask, 2 * max(1, round(0.01 * m)) + 1)
    return Decision("serrated_outer_circle", "accepted", min(0.98, 0.55 + 1.5 * min(0.12, outer)), "", mask & safe, metrics)


# fixed values: thresholds of the filter for empty patches
NONEMPTY = {"max_analysis_dimension": 320, "noise_sigma": 0.8, "background_sigma_ratio": 0.035, "local_color_delta": 3.0, "min_local_color_fraction": 0.001, "min_laplacian_std": 1.9}


def nonempty(patch: np.ndarray, options: dict | None = None) -> tuple[bool, dict]:
    """Whether a patch shows anything: colours that differ from around them, or fine structure."""
    o = NONEMPTY | (options or {})
    small = ra.shrunk(patch, o["max_analysis_dimension"])
    x = ra.lab(small)
    x = np.stack([ra.blurred(x[..., c], o["noise_sigma"]) for c in range(3)], axis=-1)
    sigma = max(3.0, o["background_sigma_ratio"] * min(small.shape[:2]))
    d = x - np.stack([ra.blurred(x[..., c], sigma) for c in range(3)], axis=-1)
    residual = np.sqrt(0.25 * d[..., 0] ** 2 + d[..., 1] ** 2 + d[..., 2] ** 2)
    fraction = float((residual >= o["local_color_delta"]).mean())
    fine = float(ra.laplacian(ra.blurred(ra.grey(small), o["noise_sigma"])).std())
    metrics = {"local_color_fraction": fraction, "laplacian_std": fine, "residual_p99": float(np.percentile(residual, 99)), "near_white": float((patch >= 245).all(axis=2).mean())}
    return fraction >= o["min_local_color_fraction"] or fine >= o["min_laplacian_std"], metrics


from . import carriers  # noqa: E402, F401  registers its heuristic
