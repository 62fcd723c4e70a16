"""Queries of the general data problems (positions, units)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hullmark.operators.nearby import boxes_of, radius_pairs
from hullmark.operators.units import depths_in_metres, pair_scales, sources, stated_depths
from hullmark.session import settle, table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = radius_pairs(table(spark, sf_dir, "noaa_enc_wrecks"), 100.0)
    return pairs.select(F.col("id_a").alias("row_a"), F.col("id_b").alias("row_b"))


def p2_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boxes_of(table(spark, sf_dir, "noaa_enc_wrecks"), table(spark, sf_dir, "enc_cells"))


def ship_and_year() -> F.Column:
    """An exact key that rows of one ship often share: the folded name and the year of the date."""
    name = F.regexp_replace(F.lower("name"), r"[^\p{L}\p{N}]+", "")
    year = F.regexp_extract(F.coalesce(F.col("date"), F.lit("")), r"^(\d{4})", 1)
    return F.when((F.length(name) > 4) & (year != ""), F.concat_ws("|", name, year))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "wikipedia_wrecks").select("row_no", "name", "date", "depth_m", "note")
    metres = depths_in_metres(rows, ship_and_year())
    return metres.select("row_no", F.round(F.col("depth_value_m") * 10).cast("long").alias("depth_dm"))


def p5_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources of depth values and the scale each pair of them shows."""
    rows = table(spark, sf_dir, "wikipedia_wrecks").select("row_no", "name", "date", "depth_m", "note")
    read = settle(stated_depths(rows.withColumn("_entity", ship_and_year())).where(F.col("_q").isNotNull()).select("_entity", "_q"))
    return pair_scales(sources(read, "_entity"), "_e", "_v", "_t")


QUERIES = {"p2_found": p2_found, "p2_boxes": p2_boxes, "p5_found": p5_found, "p5_scales": p5_scales}

SQL = {
    "p2_boxes": """
SELECT DISTINCT n.row_no, c.enc_cell, c.band
FROM noaa_enc_wrecks n JOIN enc_cells c
  ON n.latitude BETWEEN c.lat_min AND c.lat_max
 AND CASE WHEN c.lon_min <= c.lon_max THEN n.longitude BETWEEN c.lon_min AND c.lon_max
          ELSE n.longitude >= c.lon_min OR n.longitude <= c.lon_max END
WHERE n.latitude BETWEEN -90 AND 90 AND n.longitude BETWEEN -180 AND 180
""",
    "p2_found": """
WITH p AS (
  SELECT row_no, latitude la, longitude lo, CAST(floor(latitude / 0.001) AS BIGINT) gy
  FROM noaa_enc_wrecks
  WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180
), k AS (SELECT row_no, la, lo, gy + d AS gy FROM p, (VALUES (-1), (0), (1)) t(d))
SELECT a.row_no AS row_a, b.row_no AS row_b
FROM p a JOIN k b ON a.gy = b.gy AND a.row_no < b.row_no
WHERE 2 * 6371000 * asin(least(1, sqrt(pow(sin(radians(b.la - a.la) / 2), 2)
      + cos(radians(a.la)) * cos(radians(b.la)) * pow(sin(radians(b.lo - a.lo) / 2), 2)))) <= 100
""",
}
