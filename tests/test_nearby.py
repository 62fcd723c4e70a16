import numpy as np
import pytest

from hullmark.operators.nearby import arc_m, boxes_of, radius_pairs, unit_vectors, vantage_join


def brute(lat, lon, r):
    u = unit_vectors(np.array(lat), np.array(lon))
    d = arc_m(u[:, None], u[None])
    return {(i, j) for i in range(len(u)) for j in range(i + 1, len(u)) if d[i, j] <= r}


def test_vantage_join_is_complete():
    rng = np.random.default_rng(0)
    lat, lon = rng.normal(10, 0.01, 700), rng.normal(179.999, 0.01, 700)
    lat[:60], lon[:60] = 10.0, 180.0
    u = unit_vectors(lat, lon)
    i, j = vantage_join(u, u, 150.0)
    assert {(a, b) for a, b in zip(i.tolist(), j.tolist(), strict=True) if a < b} == brute(lat, lon, 150.0)


@pytest.mark.parametrize("block", [25_000, 40])
def test_radius_pairs_against_brute_force(spark, block):
    rng = np.random.default_rng(1)
    lat, lon = rng.normal(0, 0.02, 400), rng.normal(0, 0.02, 400)
    lat[:80], lon[:80] = 0.001, -0.001
    lon[80:90], lat[80:90] = np.array([179.9999, -179.9999] * 5), 89.0
    rows = [(i, float(a), float(b), "x") for i, (a, b) in enumerate(zip(lat, lon, strict=True))]
    bad = [(1000, None, 1.0, "x"), (1001, float("nan"), 1.0, "x"), (1002, 91.0, 0.0, "x"), (1003, 0.0, 999.0, "x")]
    df = spark.createDataFrame(rows + bad, "row_no long, latitude double, longitude double, _cell string")
    got = {(r.id_a, r.id_b) for r in radius_pairs(df, 100.0, points_per_cell=50, block=block).collect()}
    assert got == brute(lat, lon, 100.0)


def test_empty(spark):
    df = spark.createDataFrame([], "row_no long, latitude double, longitude double")
    assert radius_pairs(df, 100.0).count() == 0


def test_boxes(spark):
    boxes = spark.createDataFrame([("a", "b", 0.0, 2.0, 179.0, -179.0), ("c", "b", 0.0, 1.0, 0.0, 1.0), ("n", "b", None, 1.0, 0.0, 1.0)], "enc_cell string, band string, lat_min double, lat_max double, lon_min double, lon_max double")
    points = spark.createDataFrame([(1, 1.0, 179.5), (2, 1.0, -179.5), (3, 1.0, 1.0), (4, 1.0, 178.0), (5, None, 1.0)], "row_no long, latitude double, longitude double")
    assert {(r.row_no, r.enc_cell) for r in boxes_of(points, boxes).collect()} == {(1, "a"), (2, "a"), (3, "c")}
