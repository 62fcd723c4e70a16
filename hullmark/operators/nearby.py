"""Complete radius joins on the sphere.

A Voronoi partition around pivots drawn from the points sends every point to its
nearest pivot, and also to each pivot that a point within the radius could call its
nearest: by the triangle inequality that needs d(y, p) <= d(y, nearest) + 2 r. Inside
a cell a vantage-point tree over the exact great-circle metric yields the pairs. Cells
larger than ``block`` are cut into a grid of query blocks and member blocks, so that no
task holds more than two blocks however dense a spot is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hullmark.session import settle

EARTH_M = 6_371_000.0
LEAF = 48
#: Rounding of dot products near 1 can move an angle by some 1e-8; in metres on the sphere.
SLACK_M = 1.0


def possible(lat: str = "latitude", lon: str = "longitude") -> F.Column:
    """True where a position is possible; false for null, NaN and out of range."""
    good = F.col(lat).between(-90.0, 90.0) & F.col(lon).between(-180.0, 180.0)
    return F.coalesce(good & ~F.isnan(lat) & ~F.isnan(lon), F.lit(False))


def unit_vectors(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    a, b = np.radians(lat), np.radians(lon)
    c = np.cos(a)
    return np.column_stack((c * np.cos(b), c * np.sin(b), np.sin(a)))


def arc_m(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Great-circle metres between unit vectors; broadcast over leading axes."""
    chord = np.sqrt(((u - v) ** 2).sum(-1))
    return 2 * EARTH_M * np.arcsin(np.minimum(chord / 2, 1.0))


def vantage_join(q: np.ndarray, m: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices (query, member) of all pairs at most ``radius`` metres apart.

    All queries walk down the vantage-point tree of the members together; a branch is
    entered by those queries that the triangle inequality cannot exclude.
    """
    found_q: list[np.ndarray] = []
    found_m: list[np.ndarray] = []
    stack = [(np.arange(len(q)), np.arange(len(m)))]
    while stack:
        qi, mi = stack.pop()
        if not len(qi) or not len(mi):
            continue
        split = None
        if len(mi) > LEAF:
            far = int(np.argmax(((m[mi] - m[mi[0]]) ** 2).sum(1)))
            point = m[mi[far]]
            dm = arc_m(m[mi], point)
            mid = float(np.median(dm))
            inner = dm <= mid
            if inner.all():
                inner = dm < mid
            if inner.any():
                edge = float(dm[inner].max())
                dq = arc_m(q[qi], point)
                split = (
                    (qi[dq <= edge + radius], mi[inner]),
                    (qi[dq >= float(dm[~inner].min()) - radius], mi[~inner]),
                )
        if split:
            stack.extend(split)
            continue
        step = max(1, 500_000 // len(mi))
        for at in range(0, len(qi), step):
            part = qi[at : at + step]
            near = arc_m(q[part][:, None, :], m[mi][None, :, :]) <= radius
            a, b = np.nonzero(near)
            found_q.append(part[a])
            found_m.append(mi[b])
    if not found_q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_q), np.concatenate(found_m)


def _assign(pivots: np.ndarray, radius: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 4096):
                part = pdf.iloc[at : at + 4096]
                u = unit_vectors(part["_lat"].to_numpy(), part["_lon"].to_numpy())
                dots = np.clip(u @ pivots.T, -1.0, 1.0)
                best = dots.argmax(1)
                top = dots[np.arange(len(u)), best]
                limit = np.cos(np.minimum(np.arccos(top) + (2 * radius + SLACK_M) / EARTH_M, np.pi))
                row, cell = np.nonzero(dots >= limit[:, None])
                yield pd.DataFrame({
                    "_id": part["_id"].to_numpy()[row], "_lat": part["_lat"].to_numpy()[row], "_lon": part["_lon"].to_numpy()[row],
                    "_cell": cell.astype(np.int32), "_home": best[row] == cell,
                })

    return run


def _cell_pairs(radius: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        u = unit_vectors(pdf["_lat"].to_numpy(), pdf["_lon"].to_numpy())
        ids = pdf["_id"].to_numpy()
        as_q, as_m = np.flatnonzero(pdf["_q"].to_numpy()), np.flatnonzero(pdf["_m"].to_numpy())
        i, j = vantage_join(u[as_q], u[as_m], radius)
        a, b = ids[as_q[i]], ids[as_m[j]]
        keep = a < b
        return pd.DataFrame({"id_a": a[keep], "id_b": b[keep]})

    return run


def radius_pairs(
    df: DataFrame, radius_m: float, key: str = "row_no", lat: str = "latitude", lon: str = "longitude",
    points_per_cell: int = 4000, max_pivots: int = 2048, block: int = 25_000,
) -> DataFrame:
    """All pairs ``id_a < id_b`` of rows at most ``radius_m`` apart on the sphere.

    ``key`` must be a bigint that tells the rows apart. Rows with a null, NaN or impossible
    position or a null key take part in no pair; rows at one spot pair with each other; an
    empty table gives no rows. Other columns are ignored, whatever their names.
    ``max_pivots`` bounds what the driver holds; larger inputs get larger cells, which
    ``block`` cuts up.
    """
    spark = df.sparkSession
    points = df.where(possible(lat, lon) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("_id"), F.col(lat).cast("double").alias("_lat"), F.col(lon).cast("double").alias("_lon")
    )
    n = points.count()
    wanted = max(1, min(max_pivots, n // points_per_cell))
    drawn = points.orderBy(F.xxhash64("_id"), "_id").limit(wanted).select("_lat", "_lon").distinct().collect()
    if not drawn:
        return spark.createDataFrame([], "id_a long, id_b long")
    pivots = unit_vectors(np.array([r[0] for r in drawn]), np.array([r[1] for r in drawn]))
    placed = settle(points.mapInPandas(_assign(pivots, radius_m), "_id long, _lat double, _lon double, _cell int, _home boolean"))
    counts = placed.groupBy("_cell").agg(F.count("*").alias("n"), F.sum(F.col("_home").cast("long")).alias("h")).collect()
    rows = [(int(r["_cell"]), int(-(-r["h"] // block)) or 1, -(-r["n"] // block)) for r in counts]
    # one row per pivot at most: max_pivots bounds this broadcast
    sizes = F.broadcast(spark.createDataFrame(rows, "_cell int, _hb int, _mb int"))
    spot = F.pmod(F.xxhash64("_id"), F.lit(1 << 20))
    asked = F.when(
        F.col("_home"),
        F.transform(F.sequence(F.lit(0), F.col("_mb") - 1), lambda j: F.struct(F.pmod(spot, F.col("_hb")).cast("int").alias("h"), j.alias("m"), F.lit(True).alias("q"), F.lit(False).alias("t"))),
    )
    held = F.transform(F.sequence(F.lit(0), F.col("_hb") - 1), lambda i: F.struct(i.alias("h"), F.pmod(spot, F.col("_mb")).cast("int").alias("m"), F.lit(False).alias("q"), F.lit(True).alias("t")))
    whole = F.array(F.struct(F.lit(0).alias("h"), F.lit(0).alias("m"), F.col("_home").alias("q"), F.lit(True).alias("t")))
    roles = F.when((F.col("_hb") == 1) & (F.col("_mb") == 1), whole).otherwise(F.concat(F.coalesce(asked, F.slice(whole, 1, 0)), held))
    cells = placed.join(sizes, "_cell").select("_id", "_lat", "_lon", "_cell", F.explode(roles).alias("r"))
    cells = cells.select("_id", "_lat", "_lon", "_cell", F.col("r.h").alias("_h"), F.col("r.m").alias("_k"), F.col("r.q").alias("_q"), F.col("r.t").alias("_m"))
    return cells.groupBy("_cell", "_h", "_k").applyInPandas(_cell_pairs(radius_m), "id_a long, id_b long")


def boxes_of(points: DataFrame, boxes: DataFrame, key: str = "row_no", cell_deg: float = 1.0, broadcast_bytes: int = 8 << 20) -> DataFrame:
    """``key, enc_cell, band`` for each box of ``boxes`` that holds a point (edges included).

    A box with lon_min > lon_max crosses the 180th meridian and is cut in two. Boxes and
    points meet on a grid of ``cell_deg`` degrees, so the join is an equi-join; the box side
    is broadcast only while its checked size stays under ``broadcast_bytes``. Impossible
    positions and boxes with a null bound are in no result row.
    """
    west = F.col("lon_min") > F.col("lon_max")
    split = F.when(
        west,
        F.array(F.struct(F.col("lon_min").alias("w"), F.lit(180.0).alias("e")), F.struct(F.lit(-180.0).alias("w"), F.col("lon_max").alias("e"))),
    ).otherwise(F.array(F.struct(F.col("lon_min").alias("w"), F.col("lon_max").alias("e"))))
    step = lambda c: F.floor(c / F.lit(cell_deg)).cast("int")
    parts = (
        boxes.where(F.col("lat_min").isNotNull() & F.col("lat_max").isNotNull() & F.col("lon_min").isNotNull() & F.col("lon_max").isNotNull())
        .where(F.col("lat_min") <= F.col("lat_max"))
        .select("enc_cell", "band", "lat_min", "lat_max", F.explode(split).alias("x"))
        .select("enc_cell", "band", "lat_min", "lat_max", F.col("x.w").alias("w"), F.col("x.e").alias("e"))
    )
    grid = parts.select("*", F.explode(F.sequence(step(F.col("lat_min")), step(F.col("lat_max")))).alias("gy")).select(
        "*", F.explode(F.sequence(step(F.col("w")), step(F.col("e")))).alias("gx")
    )
    grid = settle(grid)
    if int(grid._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= broadcast_bytes:
        grid = F.broadcast(grid)
    at = points.where(possible()).select(F.col(key), F.col("latitude").alias("_la"), F.col("longitude").alias("_lo"))
    at = at.withColumn("gy", step(F.col("_la"))).withColumn("gx", step(F.col("_lo")))
    inside = F.col("_la").between(F.col("lat_min"), F.col("lat_max")) & F.col("_lo").between(F.col("w"), F.col("e"))
    # a point has one cell, and the two parts of a cut box have no point in common
    return at.join(grid, ["gy", "gx"]).where(inside).select(key, "enc_cell", "band")
