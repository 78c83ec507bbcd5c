"""Image kernels in NumPy: colour, blur, morphology, outlines and their shapes."""

from __future__ import annotations

import math

import numpy as np


def prepared(image: np.ndarray) -> np.ndarray:
    """An RGB uint8 image: grey is tripled, alpha dropped, floats up to 1 stretched, NaN and +inf white, -inf black."""
    x = np.asarray(image)
    if x.ndim == 2:
        x = np.repeat(x[:, :, None], 3, axis=2)
    if x.ndim != 3 or x.shape[2] not in (3, 4) or min(x.shape[:2]) < 8:
        raise ValueError(f"not an image of 8 pixels a side or more: {x.shape}")
    x = x[:, :, :3]
    if x.dtype == np.uint8:
        return x
    x = x.astype(np.float64)
    finite = x[np.isfinite(x)]
    if finite.size and finite.max() <= 1.0:
        x = x * 255.0
    return np.clip(np.nan_to_num(x, nan=255.0, posinf=255.0, neginf=0.0), 0, 255).astype(np.uint8)


def grey(rgb: np.ndarray) -> np.ndarray:
    return np.rint(rgb.astype(np.float64) @ (0.299, 0.587, 0.114)).astype(np.uint8)


def lab(rgb: np.ndarray) -> np.ndarray:
    """CIE Lab under D65, each channel stretched to 0..255."""
    c = rgb.astype(np.float64) / 255.0
    c = np.where(c <= 0.04045, c / 12.92, ((c + 0.055) / 1.055) ** 2.4)
    xyz = c @ np.array([[0.412453, 0.357580, 0.180423], [0.212671, 0.715160, 0.072169], [0.019334, 0.119193, 0.950227]]).T / (0.950456, 1.0, 1.088754)
    f = np.where(xyz > 0.008856, np.cbrt(xyz), 7.787 * xyz + 16 / 116)
    light = np.where(xyz[..., 1] > 0.008856, 116 * np.cbrt(xyz[..., 1]) - 16, 903.3 * xyz[..., 1])
    return np.stack((light * 255 / 100, 500 * (f[..., 0] - f[..., 1]) + 128, 200 * (f[..., 1] - f[..., 2]) + 128), axis=-1)


def convolved(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The same odd weights along both axes, mirrored at the edges without repeating the edge."""
    r = len(weights) // 2
    for axis in (0, 1):
        if r == 0 or x.shape[axis] == 1:
            continue
        n = x.shape[axis]
        at = np.abs((np.arange(-r, n + r) + 2 * (n - 1) * (1 + r // max(n - 1, 1))) % (2 * (n - 1)))
        at = np.where(at > n - 1, 2 * (n - 1) - at, at)
        padded = np.take(x, at, axis=axis)
        x = sum(w * np.take(padded, np.arange(k, k + n), axis=axis) for k, w in enumerate(weights))
    return x


def blurred(x: np.ndarray, sigma: float) -> np.ndarray:
    r = max(1, int(round(sigma * 4)))
    w = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return convolved(x.astype(np.float64), w / w.sum())


def laplacian(x: np.ndarray) -> np.ndarray:
    """Sum of second differences with the corners' weights of a 3 x 3 kernel."""
    p = np.pad(x.astype(np.float64), 1, mode="reflect")
    return 2 * (p[:-2, :-2] + p[:-2, 2:] + p[2:, :-2] + p[2:, 2:]) - 8 * p[1:-1, 1:-1]


def odd(value: float, least: int = 3) -> int:
    """The next odd size from a value on, not below the least."""
    n = max(least, round(value))
    return n + 1 - n % 2


def _extreme(mask: np.ndarray, size: int, grow: bool) -> np.ndarray:
    """Dilation or erosion by a filled ellipse: rows of the ellipse are spans, and a span is a prefix-sum difference."""
    r = size // 2
    m = mask if grow else ~mask
    wide = np.pad(np.cumsum(np.pad(m.astype(np.int32), ((0, 0), (r + 1, r))), axis=1), ((r, r), (0, 0)))
    h, w = mask.shape
    out = np.zeros((h, w), bool)
    for dy in range(-r, r + 1):
        half = int(round(r * math.sqrt(max(0.0, 1 - (dy / r) ** 2)))) if r else 0
        rows = wide[r + dy : r + dy + h]
        out |= rows[:, r + half + 1 : r + half + 1 + w] - rows[:, r - half : r - half + w] > 0
    return out if grow else ~out


def dilated(mask, size):
    return _extreme(mask, size, True)


def eroded(mask, size):
    return _extreme(mask, size, False)


def closed(mask, size):
    return eroded(dilated(mask, size), size)


def opened(mask, size):
    return dilated(eroded(mask, size), size)


def components(mask: np.ndarray) -> tuple[np.ndarray, int]:
    """Labels 1..n of 8-connected parts: runs of each row, joined where they touch runs of the row above."""
    h, w = mask.shape
    edges = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    rows, begins = np.nonzero(edges == 1)
    ends = np.nonzero(edges == -1)[1]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    first = np.searchsorted(rows, np.arange(h + 1))
    for y in range(1, h):
        i, j = int(first[y - 1]), int(first[y])
        while i < first[y] and j < first[y + 1]:
            if begins[i] <= ends[j] and begins[j] <= ends[i]:
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
            if ends[i] < ends[j]:
                i += 1
            else:
                j += 1
    roots = {}
    label = [roots.setdefault(top(i), len(roots) + 1) for i in range(len(rows))]
    out = np.zeros((h, w), np.int32)
    for y, a, b, k in zip(rows.tolist(), begins.tolist(), ends.tolist(), label):
        out[y, a:b] = k
    return out, len(roots)


def filled(part: np.ndarray) -> np.ndarray:
    """A part with its holes: all that the outside, 4-connected from the border, does not reach."""
    outside = np.pad(~part, 1, constant_values=True)
    # 4-connected parts of the outside: those whose runs overlap in more than a corner
    seen = np.zeros_like(outside)
    seen[0, :] = seen[-1, :] = seen[:, 0] = seen[:, -1] = True
    while True:
        before = int(seen.sum())
        for axis in (0, 1):
            for flip in (False, True):
                s, o = (np.flip(seen, axis), np.flip(outside, axis)) if flip else (seen, outside)
                n = o.shape[axis]
                idx = np.arange(n).reshape((-1, 1) if axis == 0 else (1, -1))
                wall = np.maximum.accumulate(np.where(~o, idx, -1), axis=axis)
                last = np.maximum.accumulate(np.where(s & o, idx, -1), axis=axis)
                s |= o & (last > wall)
        if int(seen.sum()) == before:
            return ~seen[1:-1, 1:-1]


def outline(part: np.ndarray) -> np.ndarray:
    """Outer boundary of one part, as points (x, y) in order."""
    p = np.pad(part, 1)
    y0, x0 = (int(v[0]) for v in np.nonzero(p))
    ring = [(0, -1), (-1, -1), (-1, 0), (-1, 1), (0, 1), (1, 1), (1, 0), (1, -1)]
    y, x, came = y0, x0, 0
    points, start = [(x0 - 1, y0 - 1)], None
    while True:
        for k in range(1, 9):
            d = (came + k) % 8
            ny, nx = y + ring[d][0], x + ring[d][1]
            if p[ny, nx]:
                break
        else:
            return np.array(points)
        if (y, x, d) == start:
            return np.array(points[:-1] if len(points) > 1 else points)
        start = start or (y, x, d)
        y, x, came = ny, nx, (d + 4) % 8
        points.append((x - 1, y - 1))


def hull(points: np.ndarray) -> np.ndarray:
    pts = np.unique(points, axis=0)
    if len(pts) < 3:
        return pts
    halves = []
    for seq in (pts, pts[::-1]):
        out = []
        for q in seq.tolist():
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        halves += out[:-1]
    return np.array(halves)


def polygon_area(points: np.ndarray) -> float:
    x, y = points[:, 0].astype(float), points[:, 1].astype(float)
    return abs(float(x @ np.roll(y, -1) - y @ np.roll(x, -1))) / 2


def enclosing_circle(points: np.ndarray) -> tuple[float, float, float]:
    """Centre and radius of a near-least circle around the points: steps towards the farthest one, ever smaller."""
    pts = points.astype(float)
    c = (pts.min(axis=0) + pts.max(axis=0)) / 2
    for k in range(1, 400):
        far = pts[np.argmax(((pts - c) ** 2).sum(axis=1))]
        c = c + (far - c) / (k + 1)
    return float(c[0]), float(c[1]), float(np.sqrt(((pts - c) ** 2).sum(axis=1).max()))


def shape_of(part: np.ndarray) -> dict:
    """Measures of one part of a mask."""
    h, w = part.shape
    pts = outline(part)
    steps = np.abs(np.diff(np.vstack((pts, pts[:1])), axis=0))
    perimeter, area = float(np.sqrt((steps**2).sum(axis=1)).sum()), polygon_area(pts)
    cx, cy, r = enclosing_circle(hull(pts))
    left, top = pts.min(axis=0)
    right, bottom = pts.max(axis=0)
    bw, bh = int(right - left + 1), int(bottom - top + 1)
    margin = max(1.0, 0.01 * min(h, w))
    return {
        "area": area, "area_fraction": area / (h * w), "circularity": 4 * math.pi * area / max(1e-6, perimeter**2), "solidity": area / max(1e-6, polygon_area(hull(pts)) if len(pts) > 2 else 0.0),
        "fill": area / max(1e-6, math.pi * r * r), "aspect": max(bw, bh) / max(1, min(bw, bh)), "x": cx, "y": cy, "radius": r,
        "center_distance": math.hypot(cx - w / 2, cy - h / 2) / min(h, w), "touches": int(left <= margin) + int(top <= margin) + int(right >= w - 1 - margin) + int(bottom >= h - 1 - margin),
    }


def disk(shape: tuple[int, int], x: float, y: float, r: float) -> np.ndarray:
    yy, xx = np.ogrid[: shape[0], : shape[1]]
    return (xx - round(x)) ** 2 + (yy - round(y)) ** 2 <= round(r) ** 2


def shrunk(image: np.ndarray, most: int) -> np.ndarray:
    """An image of `most` pixels on its longer side at most, each pixel the mean of the area it covers."""
    h, w = image.shape[:2]
    scale = most / max(h, w)
    return image if scale >= 1 else area_resized(image, max(1, round(w * scale)), max(1, round(h * scale)))


def area_resized(image: np.ndarray, width: int, height: int) -> np.ndarray:
    """Each pixel the mean of the area it covers."""
    x = image.astype(np.float64)
    for axis, n in ((0, height), (1, width)):
        m = x.shape[axis]
        sums = np.concatenate((np.zeros_like(np.take(x, [0], axis=axis)), np.cumsum(x, axis=axis)), axis=axis)
        at = np.arange(n + 1) * m / n
        low = np.minimum(at.astype(int), m - 1)
        part = (at - low).reshape((-1, *[1] * (x.ndim - 1)) if axis == 0 else (1, -1, *[1] * (x.ndim - 2)))
        edge = np.take(sums, low, axis=axis) + part * np.take(x, low, axis=axis)
        x = np.diff(edge, axis=axis) * n / m
    return np.clip(np.rint(x), 0, 255).astype(image.dtype)


def resized(image: np.ndarray, width: int, height: int, lobes: int = 3) -> np.ndarray:
    """Lanczos resampling along each axis."""
    x = image.astype(np.float64)
    for axis, n in ((0, height), (1, width)):
        m = x.shape[axis]
        if n == m:
            continue
        scale = max(1.0, m / n)
        center = (np.arange(n) + 0.5) * m / n
        reach = int(math.ceil(lobes * scale)) + 1
        at = np.floor(center)[:, None].astype(int) + np.arange(-reach, reach + 1)
        t = (at + 0.5 - center[:, None]) / scale
        w = np.where(np.abs(t) < lobes, np.sinc(t) * np.sinc(t / lobes), 0.0) * ((at >= 0) & (at < m))
        w /= w.sum(axis=1, keepdims=True)
        weights = np.zeros((n, m))
        np.add.at(weights, (np.repeat(np.arange(n), at.shape[1]), np.clip(at, 0, m - 1).ravel()), w.ravel())
        x = np.moveaxis(np.tensordot(weights, x, axes=(1, axis)), 0, axis)
    return np.clip(np.rint(x), 0, 255).astype(np.uint8)


def hsv(rgb: np.ndarray) -> np.ndarray:
    """Hue in degrees, saturation and value in 0..255."""
    x = rgb.astype(np.float64)
    high, span = x.max(axis=2), np.ptp(x, axis=2)
    r, g, b = (x[..., i] for i in range(3))
    turn = np.where(high == r, (g - b) % np.where(span, 6 * span, 1), np.where(high == g, b - r + 2 * span, r - g + 4 * span))
    return np.stack((np.where(span > 0, 60 * turn / np.maximum(span, 1e-12), 0.0), 255 * span / np.maximum(high, 1e-12), high), axis=-1)


def sobel(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Differences to the right and downwards, smoothed across."""
    p = np.pad(x.astype(np.float64), 1, mode="reflect")
    right, down = p[:, 2:] - p[:, :-2], p[2:] - p[:-2]
    return right[:-2] + 2 * right[1:-1] + right[2:], down[:, :-2] + 2 * down[:, 1:-1] + down[:, 2:]


def greatest_around(x: np.ndarray, reach: int) -> np.ndarray:
    """The greatest value in the square of that reach around each place."""
    for axis in (0, 1):
        p = np.pad(x, [(reach, reach) if a == axis else (0, 0) for a in (0, 1)], constant_values=-np.inf)
        x = np.lib.stride_tricks.sliding_window_view(p, 2 * reach + 1, axis=axis).max(axis=-1)
    return x


def edges(image: np.ndarray, low: float, high: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Thin edges of a grey image that are strong, or hang together with strong ones; and both gradients."""
    gx, gy = sobel(image)
    size = np.abs(gx) + np.abs(gy)
    p = np.pad(size, 1)
    at = lambda dy, dx: p[1 + dy : 1 + dy + size.shape[0], 1 + dx : 1 + dx + size.shape[1]]
    steep = np.abs(gy) / np.maximum(np.abs(gx), 1e-12)
    flat, tall, falling = steep < np.tan(np.pi / 8), steep > np.tan(3 * np.pi / 8), gx * gy > 0
    pick = lambda a, b, c, d: np.where(flat, a, np.where(tall, b, np.where(falling, c, d)))
    thin = (size > pick(at(0, -1), at(-1, 0), at(-1, -1), at(-1, 1))) & (size >= pick(at(0, 1), at(1, 0), at(1, 1), at(1, -1)))
    labels, n = components(thin & (size > low))
    strong = np.bincount(labels[thin & (size > high)], minlength=n + 1) > 0
    strong[0] = False
    return strong[labels], gx, gy


def hough_circles(image: np.ndarray, dp: float, apart: float, high: float, votes: float, least: int, most: int) -> list[tuple[int, int, int]]:
    """Circles of a grey image, best first: edge points vote along their gradients for centres, on a grid dp times as coarse; a
    centre's radius is the one that most edge points have, for its length. A circle is then fitted to those points."""
    edge, gx, gy = edges(image, high / 2, high)
    y, x = np.nonzero(edge)
    size = np.hypot(gx[y, x], gy[y, x])
    y, x, dx, dy = (v[size > 0] for v in (y, x, gx[y, x] / np.maximum(size, 1e-12), gy[y, x] / np.maximum(size, 1e-12)))
    h, w = (int(np.ceil(n / dp)) for n in image.shape)
    total = np.zeros((h + 2, w + 2), np.int64)
    for r in np.arange(least, most + 1e-9, dp):
        for way in (-1, 1):
            cx, cy = np.floor((x + way * r * dx) / dp).astype(np.int64), np.floor((y + way * r * dy) / dp).astype(np.int64)
            ok = (cx >= 0) & (cx < w) & (cy >= 0) & (cy < h)
            total[1:-1, 1:-1] += np.bincount(cy[ok] * w + cx[ok], minlength=h * w).reshape(h, w)
    v = total[1:-1, 1:-1]
    peak = (v > votes) & (v > total[1:-1, :-2]) & (v >= total[1:-1, 2:]) & (v > total[:-2, 1:-1]) & (v >= total[2:, 1:-1])
    py, px = np.nonzero(peak)
    out: list[tuple[int, int, int]] = []
    for i in np.argsort(-v[py, px], kind="stable")[:2000].tolist():
        cx, cy = (px[i] + 0.5) * dp, (py[i] + 0.5) * dp
        if any((cx - a) ** 2 + (cy - b) ** 2 < apart**2 for a, b, _ in out):
            continue
        d = np.hypot(x - cx, y - cy)
        n = np.bincount(np.rint(d[(d >= least) & (d <= most)]).astype(int), minlength=most + 2)
        support = np.convolve(n, np.ones(3), "same") / np.maximum(np.arange(len(n)), 1)
        r = int(np.argmax(support))
        if support[r] * r > votes:
            near = np.abs(d - r) <= max(3.0, 0.08 * r)
            a = np.stack((x[near], y[near], np.ones(near.sum())), axis=1)
            (p, q, c), *_ = np.linalg.lstsq(a, (a[:, :2] ** 2).sum(axis=1), rcond=None)
            fit = p / 2, q / 2, math.sqrt(max(0.0, c + p * p / 4 + q * q / 4))
            good = math.hypot(fit[0] - cx, fit[1] - cy) <= 0.15 * r and least <= fit[2] <= most
            out.append(tuple(map(round, fit if good else (cx, cy, r))))
    return out


def otsu(image: np.ndarray) -> int:
    """The grey level that parts an image into two classes farthest apart, the least of equals."""
    n = np.bincount(image.astype(np.uint8).ravel(), minlength=256).astype(np.float64)
    below, mass = np.cumsum(n), np.cumsum(n * np.arange(256))
    rest = below[-1] - below
    ok = (below > 0) & (rest > 0)
    score = np.where(ok, (mass[-1] * below - mass * below[-1]) ** 2 / np.maximum(below * rest, 1e-12), -1.0)
    return int(np.argmax(score))


def inpainted(image: np.ndarray, gone: np.ndarray, reach: int = 5) -> np.ndarray:
    """An image whose places that are gone are filled from their rims inwards, by means of what is known around them."""
    out, known = image.astype(np.float64), ~gone
    ones = np.ones(2 * reach + 1)
    while not known.all() and known.any():
        near = convolved(known.astype(np.float64), ones)
        rim = ~known & (convolved(known.astype(np.float64), np.ones(3)) > 0)
        out[rim] = (convolved(np.where(known, out, 0.0), ones) / np.maximum(near, 1e-12))[rim]
        known = known | rim
    return out


def polar(image: np.ndarray, x: float, y: float, reach: int, angles: int) -> np.ndarray:
    """Rows of angles, columns of whole radii below reach, between pixels bilinear; 0 outside the image."""
    t = np.arange(angles)[:, None] * 2 * np.pi / angles
    px, py = x + np.cos(t) * np.arange(reach), y + np.sin(t) * np.arange(reach)
    p = np.pad(image.astype(np.float64), 1)
    inside = (px > -1) & (py > -1) & (px < image.shape[1]) & (py < image.shape[0])
    px, py = np.where(inside, px, 0) + 1, np.where(inside, py, 0) + 1
    a, b = np.floor(px).astype(int), np.floor(py).astype(int)
    fx, fy = px - a, py - b
    return inside * ((p[b, a] * (1 - fx) + p[b, a + 1] * fx) * (1 - fy) + (p[b + 1, a] * (1 - fx) + p[b + 1, a + 1] * fx) * fy)


def moments(part: np.ndarray) -> tuple[float, float, float]:
    """Area and centre of a mask or of weights."""
    total = float(part.sum())
    y, x = np.indices(part.shape)
    return total, float((x * part).sum() / max(total, 1e-12)), float((y * part).sum() / max(total, 1e-12))
