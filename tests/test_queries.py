"""Every registered relational query against its SQL twin."""

import glob
import os

import duckdb
import numpy as np
import pytest

from tesselith.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    a = registry.QUERIES[name](spark, SF).toPandas()
    if name not in registry.ORACLE_SQL:
        assert len(a)
        return
    b = duck.execute(registry.ORACLE_SQL[name]).df()
    assert sorted(a.columns) == sorted(b.columns)
    cols = sorted(a.columns)
    a, b = (x[cols].sort_values(cols, key=lambda s: s.astype(str)).reset_index(drop=True) for x in (a, b))
    assert len(a) == len(b)
    for c in cols:
        if "f" in (a[c].dtype.kind, b[c].dtype.kind):
            assert np.allclose(a[c].astype(float), b[c].astype(float), equal_nan=True, atol=1e-9), c
        else:
            assert (a[c].astype(str) == b[c].astype(str)).all(), c


def test_coverage_by_brute_force(spark):
    from tesselith import fixtures

    cells = {tuple(r) for r in fixtures.mask_cells(spark, SF).collect()}
    for r in registry.region_plans(spark, SF).where("slide_id = 3").limit(40).collect():
        left, right = r.x0 * 64 // r.width, min(64, -(-(r.x0 + 600) * 64 // r.width))
        top, bottom = r.y0 * 64 // r.height, min(64, -(-(r.y0 + 600) * 64 // r.height))
        on = sum((3, y, x) in cells for y in range(top, bottom) for x in range(left, right))
        assert (r.total, r.area) == (on, (right - left) * (bottom - top))


def test_samples_are_those_of_the_libraries(spark):
    """sample_random takes what NumPy's generator chooses, bottom_k_blake2b what the hash orders first."""
    import hashlib

    plans = registry.fraction_plans(spark, SF).toPandas()
    got = registry.QUERIES["sample_random"](spark, SF).toPandas()
    for slide, rows in plans.groupby("slide_id"):
        rows = rows.sort_values("index").reset_index(drop=True)
        mine = got[got.slide_id == slide].sort_values("index")
        assert len(mine) == min(25, len(rows))
        places = np.sort(np.random.default_rng(0).choice(len(rows), 25, replace=False)) if len(rows) > 25 else np.arange(len(rows))
        assert (mine[["x0", "y0"]].to_numpy() == rows[["x0", "y0"]].to_numpy()[places]).all()
        order = np.random.default_rng(3).permutation(len(rows))[:8].tolist()
        first = registry.QUERIES["preview_permutation"](spark, SF).where(f"slide_id = {slide}").orderBy("place").collect()
        assert [r["index"] for r in first] == order
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source").toPandas()
    docs["score"] = [hashlib.blake2b(f"0:{i}".encode(), digest_size=8).hexdigest() for i in docs.doc_id]
    want = docs.sort_values(["source", "score", "doc_id"]).groupby("source").head(5)
    got = registry.QUERIES["bottom_k_blake2b"](spark, SF).toPandas()
    assert set(zip(got.source, got.doc_id, got.score)) == set(zip(want.source, want.doc_id, want.score))
    assert (got.sort_values(["source", "rank"]).groupby("source")["rank"].apply(list).str[0] == 1).all()


def test_entry_point_without_the_other_package(spark):
    import __spark_entry__

    assert set(registry.QUERIES) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0
