"""End to end over drawn slides: readers, inputs, plans, sinks, resumption, previews, settings and the input stream."""

import glob
import json
import os
import tarfile

import numpy as np
import pytest

from tesselith import api
from tesselith.config import load_config, octal_mode
from tesselith.functions import filters
from tesselith.functions import raster as ra
from tesselith.operators import planning, resolve, runs
from tesselith.sources import jpeg, png, readers, sinks, tiff


def drawn(w, h, x, y, r):
    img = np.full((h, w, 3), 235, np.uint8)
    img[ra.disk((h, w), x, y, r)] = (190, 70, 160)
    return img


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    top = tmp_path_factory.mktemp("slides")
    for name, r in (("a", 90), ("b", 60)):
        img = drawn(320, 256, 150, 128, r)
        (top / f"{name}.tif").write_bytes(tiff.written([img, img[::2, ::2]], 0.5, 64))
    (top / "again").mkdir()
    (top / "again/a.tif").write_bytes((top / "a.tif").read_bytes())
    (top / "blank.tif").write_bytes(tiff.written([np.full((256, 320, 3), 255, np.uint8)], 0.5, 64))
    (top / "list.txt").write_text("a.tif\n\n 'b.tif' \nagain/a.tif\na.tif\nblank.tif\n")
    return top


def settings(tmp_path, *more):
    return load_config(None, ("reader.thumbnail_width=320", "patching.patch_size=32", "patching.stride=32", "patching.output_size=16", "post_filter_pipe=[nonempty]", f"output.root={tmp_path}/out", f"logging.root={tmp_path}/logs", f"preview.root={tmp_path}/pre", *more))


def test_png_round_trip():
    x = np.random.default_rng(1).integers(0, 256, (17, 9, 3)).astype(np.uint8)
    assert (png.decoded(png.encoded(x)) == x).all()


def test_jpeg_is_read_by_another_library(spark, tmp_path):
    img = drawn(101, 83, 50, 40, 30)
    (tmp_path / "x.jpeg").write_bytes(jpeg.encoded(img, 95))
    (tmp_path / "y.jpeg").write_bytes(jpeg.encoded(np.random.default_rng(2).integers(0, 256, (83, 101, 3)).astype(np.uint8), 95))
    for r in spark.read.format("image").load(str(tmp_path)).select("image.*").collect():
        back = np.frombuffer(bytes(r.data), np.uint8).reshape(83, 101, 3)[..., ::-1].astype(int)
        if r.origin.endswith("x.jpeg"):
            assert np.abs(back - img).mean() < 1.5


def test_regions_of_a_pyramid(tmp_path):
    levels = [np.random.default_rng(0).integers(0, 256, (300, 520, 3)).astype(np.uint8)]
    levels.append(levels[0][::4, ::4].copy())
    (tmp_path / "p.tiff").write_bytes(tiff.written(levels, 0.25, 128))
    with readers.opened(str(tmp_path / "p.tiff"), str(tmp_path / "p.tiff")) as r:
        assert (r.metadata.dimensions, r.metadata.level_downsamples, r.metadata.mpp, r.metadata.reader) == ((520, 300), (1.0, 4.0), 0.25, "tiff")
        assert (r.read_region(100, 50, 0, 300, 200) == levels[0][50:250, 100:400]).all()
        assert (r.read_region(400, 80, 1, 30, 20) == levels[1][20:40, 100:130]).all()
        assert (r.read_region(510, 0, 0, 20, 10)[:, 10:] == 255).all() and r.thumbnail(130, 75).shape == (75, 130, 3)


@pytest.mark.parametrize(
    "properties,direct,mpp",
    [({}, 0.25, 0.25), ({}, (0.2, 0.4), 0.3), ({"openslide.mpp-x": "0.5", "MPP-X": "0.7", "mpp_y": 0.6}, None, 0.6), ({"aperio.MPP": "0.25"}, None, 0.25), ({"PixelSpacing": "0.00025\\0.00035"}, None, 0.3), ({"mpp": "nan"}, -1, None), ({"Resolution": "x, 0.4"}, None, 0.4)],
)
def test_resolution(properties, direct, mpp):
    found = readers.resolution(properties, direct)
    assert found == mpp or abs(found - mpp) < 1e-12


def test_backends_fall_back(tmp_path):
    (tmp_path / "x.svs").write_bytes(b"no slide")
    s = load_config().reader
    assert readers.backends(s) == ("tiff", "png", "aslide", "openslide")
    with pytest.raises(readers.ReaderOpenError, match="tiff: .*png: .*aslide: .*openslide"), readers.opened(str(tmp_path / "x.svs"), str(tmp_path / "x.svs")):
        pass
    with pytest.raises(ValueError):
        readers.backends(load_config(None, ("reader.backend=other",)).reader)


def test_staging_copies_a_bundle_and_cleans_up(tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s/4_1.dcm").write_bytes(b"x")
    s = load_config(None, ("reader.staging_enabled=true", f"reader.staging_root={tmp_path}/fast")).reader
    with readers.staged(str(tmp_path / "s"), str(tmp_path / "s/4_1.dcm"), (), s) as path:
        assert path.startswith(f"{tmp_path}/fast/s-") and path.endswith("/s/4_1.dcm") and open(path).read() == "x"
    assert not os.path.exists(path)


def test_inputs(spark, folder, tmp_path):
    rows = resolve.resolved(spark, str(folder / "list.txt"), str(folder)).orderBy("ordinal").collect()
    assert [r.slide_id for r in rows] == ["a", "b", "blank"] and rows[0].entrypoint == str(folder / "a.tif")
    assert [r.slide_id for r in resolve.resolved(spark, str(folder / "a.tif")).collect()] == ["a"]
    (tmp_path / "m").mkdir()
    (tmp_path / "m.mrxs").write_bytes(b"1")
    (tmp_path / "m/data.dat").write_bytes(b"2")
    (tmp_path / "d").mkdir()
    for f in ("4_2.dcm", "4_1.dcm", "1.dcm"):
        (tmp_path / "d" / f).write_bytes(b"3")
    by = {r.slide_id: r for r in resolve.resolved(spark, [str(tmp_path / "m.mrxs"), str(tmp_path / "d")]).collect()}
    assert by["m"].sidecars == [str(tmp_path / "m")] and by["d"].entrypoint.endswith("4_1.dcm")
    one = resolve.checksum(*resolve.resolve(str(tmp_path / "m.mrxs"))[:2], [str(tmp_path / "m")])
    (tmp_path / "m/data.dat").write_bytes(b"9")
    assert one != resolve.checksum(*resolve.resolve(str(tmp_path / "m.mrxs"))[:2], [str(tmp_path / "m")])


def test_bad_inputs(spark, folder, tmp_path):
    (tmp_path / "a.tif").write_bytes(b"other")
    (tmp_path / "x.doc").write_bytes(b"")
    (tmp_path / "none").mkdir()
    for value, kind, text in (
        ([str(folder / "a.tif"), str(tmp_path / "a.tif")], ValueError, "several contents"), ([str(tmp_path / "gone.svs")], FileNotFoundError, "gone"),
        ([str(tmp_path / "x.doc")], ValueError, "kind of slide"), ([str(tmp_path / "none")], ValueError, "DICOM"), ([], ValueError, "no inputs"),
    ):
        with pytest.raises(kind, match=text):
            resolve.resolved(spark, value)


def test_extract_to_shards_and_resume(spark, folder, tmp_path):
    c = settings(tmp_path, "output.mode=tar", "output.shard_max_count=10", "output.tar_preview=true", "output.tar_preview_n=4", "output.permissions=755")
    slides = resolve.resolved(spark, str(folder / "list.txt"), str(folder))
    first = api.extract(spark, slides, c, "one")
    got = {r.slide_id: r for r in first.slides.collect()}
    assert first.status == "partial" and [got[k].status for k in ("a", "b", "blank")] == ["success", "success", "failed"] and "heuristic" in got["blank"].error
    assert got["a"].patches > got["b"].patches > 10 and got["a"].reader == "tiff" and got["a"].heuristic == "density"
    assert open(f"{tmp_path}/logs/.state/one/failures.txt").read().startswith("blank\t") and "summary status=partial slides=3 success=2 failed=1" in open(first.log).read()
    assert runs.Run(spark, "one", c).successes("a")
    index = json.load(open(f"{tmp_path}/out/a/index.json"))
    assert index["patch_count"] == got["a"].patches == len(index["patches"]) and set(index["patches"][0]) == {"index", "name", "shard"}
    shards = sorted(os.path.basename(f) for f in glob.glob(f"{tmp_path}/out/a/*.tar"))
    assert shards[0] == "a_0001.tar" and len(shards) == -(-got["a"].patches // 10)
    with tarfile.open(f"{tmp_path}/out/a/a_0001.tar") as t:
        assert len(t.getmembers()) == 10 and t.getmembers()[0].mode == 0o755 and t.getmembers()[0].name.endswith("_mpp1_px16.jpeg")
    assert len(os.listdir(f"{tmp_path}/out/a/sample")) == 4 and os.stat(f"{tmp_path}/out/a").st_mode & 0o777 == 0o755
    back = spark.read.format("tar_shards").option("path", f"{tmp_path}/out").load()
    assert back.count() == got["a"].patches + got["b"].patches
    # a shard is lost, and the index with it: what is there is skipped, what is not goes to the next shard
    os.unlink(f"{tmp_path}/out/a/a_0001.tar")
    again = {r.slide_id: r for r in api.extract(spark, slides, c, "two").slides.collect()}
    assert (again["b"].status, again["b"].patches) == ("skipped", got["b"].patches) and (again["a"].status, again["a"].patches) == ("success", got["a"].patches)
    assert f"a_{len(shards) + 1:04d}.tar" in os.listdir(f"{tmp_path}/out/a") and sinks.complete_count(f"{tmp_path}/out/a", "tar") == got["a"].patches
    with pytest.raises(ValueError, match="other settings"):
        api.extract(spark, slides, settings(tmp_path), "one")


@pytest.mark.parametrize("mode", ["jpeg", "png", "none"])
def test_extract_to_files(spark, folder, tmp_path, mode):
    c = settings(tmp_path, f"output.mode={mode}", "patching.level=1", "patching.mpp=2.0", "patching.output_size=32")
    r = api.extract(spark, resolve.resolved(spark, [str(folder / "a.tif")]), c)
    a = r.slides.collect()[0]
    assert r.status == "success" and a.status == "success" and a.patches > 2 and not os.path.exists(f"{tmp_path}/logs/.state/{r.run_id}")
    files = glob.glob(f"{tmp_path}/out/a/*.{mode}")
    assert len(files) == (0 if mode == "none" else a.patches)
    if mode == "png":
        # level 1 has 1 micron a pixel: 64 of its pixels make 32 of 2 microns
        x, y = (int(v[1:]) for v in os.path.basename(files[0]).split("_")[:2])
        img = drawn(320, 256, 150, 128, 90)[::2, ::2]
        assert os.path.basename(files[0]).endswith("_mpp2_px32.png") and x % 128 == 0
        assert (png.decoded(open(files[0], "rb").read()) == ra.resized(img[y // 2 : y // 2 + 64, x // 2 : x // 2 + 64], 32, 32)).all()
        os.unlink(files[0])
        assert api.extract(spark, resolve.resolved(spark, [str(folder / "a.tif")]), c).slides.collect()[0].patches == a.patches and os.path.exists(files[0])


def test_previews(spark, folder, tmp_path, monkeypatch):
    c = settings(tmp_path, "preview.n_patches=3")
    slides = resolve.resolved(spark, str(folder / "list.txt"), str(folder))
    r = api.center_preview(spark, slides, c)
    assert [x.status for x in r.slides.orderBy("ordinal").collect()] == ["success", "success", "failed"]
    assert all(map(sinks.there, sinks.preview_paths(f"{tmp_path}/out", "a")))
    assert [x.status for x in api.center_preview(spark, slides, c).slides.orderBy("ordinal").collect()] == ["skipped", "skipped", "failed"]
    r = api.run_preview(spark, slides, c, "p")
    a = r.slides.orderBy("ordinal").collect()[0]
    names = sorted(os.listdir(f"{tmp_path}/pre/p/a/patches"))
    assert len(names) == 3 and names[0].startswith("sample_00_x") and names[0].endswith("_l0.jpg") and sinks.there(f"{tmp_path}/pre/p/a/contour.jpg")
    plain = api.run_preview(spark, slides, settings(tmp_path, "post_filter_pipe=[]"), "q").slides.orderBy("ordinal").collect()[0]
    assert plain.patches >= a.patches > 0


def test_large_slides_of_one_level_are_not_previewed():
    meta = lambda levels: readers.Metadata((92928, 89856), levels, tuple(92928 / w for w, _ in levels), 0.5, "x")
    assert "8,350,138,368 pixels" in api.skip_reason(meta(((92928, 89856),)))
    assert api.skip_reason(meta(((92928, 89856), (23232, 22464)))) is None


def test_filters():
    class Even(filters.PatchFilter):
        name = "even"

        def evaluate(self, image, options):
            if image[0, 0, 0] == 9:
                raise OSError("broken")
            return filters.Verdict(image[0, 0, 0] % 2 == 0, "odd")

    filters.register(Even)
    try:
        images = [np.full((8, 8, 3), v, np.uint8) for v in (0, 1, 2, 9)]
        got = filters.run_many(images, ["even"], {})
        assert [v.keep for v in got] == [True, False, True, False] and got[3].reason == "OSError: broken"
        filters.SCORERS["mean"] = lambda o: lambda b: np.stack([np.zeros(len(b)), b.mean(axis=(1, 2, 3)) - 1], axis=1)
        got = filters.run_many(images, ["even", "qc"], {"qc": {"scorer": "mean", "threshold": 0.5, "input_size": 8, "batch_size": 1}})
        assert [v.keep for v in got] == [False, False, True, False] and got[0].reason == "rejected by qc"
        with pytest.raises(KeyError):
            filters.run_many(images, ["nothing"], {})
        with pytest.raises(filters.SetupError):
            filters.run_many(images, ["qc"], {"qc": {"checkpoint": "/none"}})
        with pytest.raises(ValueError):
            filters.register(type("Even", (filters.PatchFilter,), {"name": "even"}))
    finally:
        del filters.FILTERS["even"], filters.SCORERS["mean"]
    batch = filters.scaled_batch(images, 16)
    assert batch.shape == (4, 3, 16, 16) and batch.dtype == np.uint8 and abs(filters.normalized(batch)[0, 0, 0, 0] + 0.485 / 0.229) < 1e-6


def test_slide_plans_by_brute_force():
    rng = np.random.default_rng(3)
    mask, size, levels, downs = rng.random((40, 50)) < 0.4, (1000, 810), [(1000, 810), (400, 324)], [1.0, 2.5]
    for inclusion in ("fraction", "full", "center"):
        for level in (0, 1):
            p = load_config(None, (f"patching.level={level}", "patching.patch_size=41", "patching.stride=37", f"patching.inclusion={inclusion}", "patching.min_region_fraction=0.4")).patching
            want, extent = [], 41 * downs[level]
            for ty in range(0, levels[level][1] - 40, 37):
                for tx in range(0, levels[level][0] - 40, 37):
                    x, y = round(tx * downs[level]), round(ty * downs[level])
                    box = mask[int(np.floor(y * 40 / 810)) : min(40, int(np.ceil((y + extent) * 40 / 810))), int(np.floor(x * 50 / 1000)) : min(50, int(np.ceil((x + extent) * 50 / 1000)))]
                    middle = mask[min(39, int((y + extent / 2) * 40 / 810)), min(49, int((x + extent / 2) * 50 / 1000))]
                    if {"fraction": box.mean() >= 0.4, "full": box.all(), "center": middle}[inclusion]:
                        want.append((x, y, round(float(box.mean()), 9)))
            got = planning.slide_plans(mask, size, levels, downs, p)
            assert [(int(a), int(b), round(float(c), 9)) for a, b, c in zip(*got)] == want
    with pytest.raises(ValueError, match="no level"):
        planning.slide_plans(mask, size, levels, downs, load_config(None, ("patching.level=5",)).patching)


def test_settings(tmp_path):
    (tmp_path / "c.yaml").write_text("patching: {stride: 300}\n")
    (tmp_path / "c.json").write_text('{"output": {"mode": "tar"}}')
    c = load_config(str(tmp_path / "c.yaml"), ("patching.level=2",))
    assert (c.patching.stride, c.patching.level, c.patching.patch_size) == (300, 2, 1200) and len(c.signature) == 64
    assert load_config(str(tmp_path / "c.json")).output.mode == "tar" and load_config().batch_patches == 32
    assert load_config(None, ("patching.output_size=4096",)).batch_patches == 10
    for bad in ("patching.inclusion=some", "nothing=1", "patching.none=1", "patching.stride=0", "output.permissions=888", "output.permissions=true", "parallel.slide_workers=0", "output.mode=gif", "post_filter_pipe=['']"):
        with pytest.raises(ValueError):
            load_config(None, (bad,))
    assert [octal_mode(x) for x in ("0o755", 644, "7")] == [0o755, 0o644, 7]


def test_stream(spark, tmp_path):
    from tesselith.streaming import inputs

    src = "/root/testdata/sf0.001/events.parquet"
    events = spark.read.parquet(src)
    events.union(events).write.parquet(str(tmp_path / "in"))
    rows = inputs.once(inputs.arriving(spark, str(tmp_path / "in"), events.schema, "ts"), ["event_id"])
    inputs.run_available(rows, str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == events.count()


def test_windows_and_late_rows(spark, tmp_path):
    """Counts by windows of a stream; a row that comes after the watermark is left out."""
    from tesselith.streaming import inputs

    src, at = str(tmp_path / "in"), lambda i, t: f"({i}, timestamp'2024-01-01 {t}', 'k', {i}.0)"

    def take(*rows):
        spark.sql(f"select cast(col1 as long) id, col2 ts, col3 kind, cast(col4 as double) value from values {', '.join(rows)}").coalesce(1).write.mode("append").parquet(src)
        rows = inputs.arriving(spark, src, "id long, ts timestamp, kind string, value double", "ts", "10 minutes")
        inputs.run_available(inputs.counts(rows, "ts", "kind", "1 hour"), str(tmp_path / "out"), str(tmp_path / "state"))

    take(at(1, "00:00:10"), at(2, "00:00:20"), at(3, "01:10:00"))
    take(at(4, "05:00:00"))
    take(at(5, "00:00:30"), at(6, "12:00:00"))
    got = {r.window.start.hour: (r.n, r["mean"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {0: (2, 1.5), 1: (1, 3.0), 5: (1, 4.0)}  # row 5 is late, and the window of row 6 is open


def test_arbitration_settings(spark):
    from pyspark.sql import functions as F

    from tesselith.operators import decisions

    rows = [(1, "density", 0, "accepted", 0.5, 100, 100), (1, "smear", 1, "accepted", 0.9, 100, 50), (1, "double_circle", 2, "accepted", 0.7, 100, 95), (2, "density", 0, "accepted", 0.5, 100, 100), (2, "smear", 1, "accepted", 0.6, 100, 99)]
    d = spark.createDataFrame(rows, "slide_id long, name string, pos int, status string, confidence double, area long, overlap long")
    pick = lambda **k: {r.slide_id: r.name for r in decisions.arbitrate(d, **k).collect()}
    assert pick() == {1: "double_circle", 2: "density"}
    assert pick(**decisions.thresholds({"min_specialized_confidence": 0.55}, {"smear": {"density_guard": False}})) == {1: "smear", 2: "smear"}
    assert pick(**decisions.thresholds({}, {"double_circle": {"arbitration_min_confidence": 0.8}, "smear": {"min_density_recall": 0.5}})) == {1: "smear", 2: "density"}
    assert d.where(F.col("slide_id") == 3).count() == 0


def test_one_image_through_a_pipe():
    from tesselith.functions import regions

    img = drawn(200, 200, 100, 100, 60)
    d = regions.run_pipeline(img, ("double_circle", "nothing", "single_circle", "density"))
    assert d.name == "single_circle" and [a["status"] for a in d.metrics["attempts"]] == ["not_applicable", "error", "accepted"]
    assert regions.run_pipeline(img, ("single_circle", "density"), {"single_circle": {"min_confidence": 0.999}}).name == "density"
    assert regions.run_pipeline(img, ("density", "single_circle"), strategy="arbitrate").name == "single_circle"
    assert regions.run_pipeline(img, ("density", "single_circle"), {}, "arbitrate", {"min_specialized_confidence": 0.999}).name == "density"
    assert regions.run_pipeline(np.full((50, 50, 3), 255, np.uint8)).status == "rejected"


def test_command_line(spark, folder, tmp_path, capsys):
    from tesselith.__main__ import main

    sets = ["--set", "reader.thumbnail_width=320", "--set", "patching.patch_size=64", "--set", "patching.stride=64", "--set", "patching.output_size=16", "--set", f"logging.root={tmp_path}/logs"]
    assert main(["--show-config", *sets], spark) == 0 and "patch_size: 64" in capsys.readouterr().out
    assert main(["--input-list", str(folder / "list.txt"), "--input-root", str(folder), "--inspect"], spark) == 0
    assert capsys.readouterr().out.splitlines()[1].startswith("b\tsource=")
    assert main([str(folder / "a.tif"), "--output", f"{tmp_path}/out", "--run-id", "x", *sets], spark) == 0
    assert "status=success slides=1 output=" in capsys.readouterr().out and os.path.exists(f"{tmp_path}/out/a/index.json")
    assert main([str(folder / "a.tif"), "--preview", "--output", f"{tmp_path}/pre", "--n-patches", "1", *sets], spark) == 0
    assert "planned_patches=" in capsys.readouterr().out
    for bad in ([], [str(folder / "a.tif"), "--input-list", "x"], [str(folder / "none.tif")]):
        with pytest.raises(SystemExit):
            main(bad, spark)
