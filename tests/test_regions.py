"""Kernels and heuristics on drawn images."""

import numpy as np
import pytest

from tesselith.functions import raster as ra
from tesselith.functions import regions


def canvas(h, w, value=235):
    return np.full((h, w, 3), value, np.uint8)


def drawn(h, w, *disks):
    img = canvas(h, w)
    for x, y, r in disks:
        img[ra.disk((h, w), x, y, r)] = (190, 70, 160)
    return img


def iou(a, b):
    return (a & b).sum() / (a | b).sum()


def test_single_circle():
    d = regions.run("single_circle", drawn(160, 160, (80, 80, 50)))
    assert d.status == "accepted" and iou(d.mask, ra.disk((160, 160), 80, 80, 52)) > 0.9


def test_double_circle():
    d = regions.run("double_circle", drawn(160, 340, (80, 80, 50), (250, 80, 45)))
    assert d.status == "accepted" and d.metrics["apart"] > 2.3
    assert regions.run("double_circle", drawn(160, 160, (80, 80, 50))).status == "not_applicable"


@pytest.mark.parametrize("h,w", [(160, 160), (240, 160), (160, 300), (100, 220)])
def test_full_field_smear(h, w):
    img = canvas(h, w)
    img[:] = (180, 80, 160)
    img[np.random.default_rng(5).random((h, w)) < 0.25] = 245
    d = regions.run("smear", img)
    assert d.status == "accepted" and d.mask.mean() >= 0.99


def test_ellipse_smear():
    img = canvas(240, 480)
    yy, xx = np.mgrid[:240, :480]
    img[((xx - 240) / 200) ** 2 + ((yy - 120) / 65) ** 2 <= 1] = (190, 70, 160)
    assert regions.run("smear", img).reason == "standard"
    assert regions.run("smear", canvas(240, 480)).status == "not_applicable"


def test_density():
    d = regions.run("density", drawn(160, 200, (60, 80, 30), (150, 70, 25)))
    truth = ra.disk((160, 200), 60, 80, 30) | ra.disk((160, 200), 150, 70, 25)
    assert d.status == "accepted" and iou(d.mask, truth) > 0.6 and (d.mask & truth).sum() / truth.sum() > 0.95
    assert regions.run("density", canvas(64, 64)).status == "rejected"


def test_portrait_and_unknown():
    d = regions.run("qmh_center_circle", drawn(400, 180, (90, 200, 95)))
    assert d.status == "accepted" and d.mask[200, 90]
    assert regions.run("nothing", canvas(64, 64)).status == "error"
    assert regions.run("density", np.zeros((4, 4, 3), np.uint8)).status == "error"


def test_nonempty():
    assert not regions.nonempty(canvas(256, 256))[0]
    assert regions.nonempty(drawn(256, 256, (128, 128, 40)))[0]


def test_components_and_holes():
    m = np.zeros((9, 9), bool)
    m[1:6, 1:6] = True
    m[3, 3] = False
    m[6, 6] = True
    labels, n = ra.components(m)
    assert n == 1 and ra.filled(m)[3, 3] and not ra.filled(m)[0, 0]
    m[8, 0] = True
    assert ra.components(m)[1] == 2


def test_morphology_against_brute_force():
    g = np.random.default_rng(2)
    m = g.random((20, 25)) < 0.2
    r = 2
    half = {dy: int(round(r * np.sqrt(1 - (dy / r) ** 2))) for dy in range(-r, r + 1)}
    want = np.zeros_like(m)
    for y, x in zip(*np.nonzero(m)):
        for dy, k in half.items():
            if 0 <= y + dy < 20:
                want[y + dy, max(0, x - k) : x + k + 1] = True
    assert (ra.dilated(m, 5) == want).all()
    assert (ra.eroded(m, 5) == ~ra.dilated(~m, 5)).all()


def test_resampling_keeps_flat_images():
    assert (ra.resized(canvas(40, 30), 17, 23) == 235).all() and (ra.shrunk(canvas(400, 300), 50) == 235).all()
    assert ra.shrunk(canvas(400, 300), 50).shape == (50, 38, 3)
