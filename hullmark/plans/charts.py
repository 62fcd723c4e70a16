"""Queries over chart features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hullmark.functions.codes import CODE_LISTS, code_table, decode
from hullmark.functions.geo import cell_degrees, cell_of, dms_degrees, dmm_degrees, vertex_mean
from hullmark.functions.ids import chart_id, suffix_repeats
from hullmark.operators.clusters import greedy_clusters, near_pairs
from hullmark.operators.merging import merge_clusters
from hullmark.operators.ordering import placed
from hullmark.session import table

BANDS = ("berthing", "harbour", "approach", "coastal", "general", "overview")
DECODED = {"water_level": "WATLEV", "depth_quality": "QUASOU", "depth_technique": "TECSOU", "depth_exposition": "EXPSOU", "vertical_datum": "VERDAT"}


def _charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "noaa_enc_wrecks")


def enc_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    category = F.when(F.col("kind") == "wreck", decode(F.col("category"), "CATWRK")).when(F.col("kind") == "obstruction", decode(F.col("category"), "CATOBS")).otherwise(F.lit("hulk"))
    return _charts(spark, sf_dir).select("row_no", category.alias("category"), *[decode(F.col(c), a).alias(c) for c, a in DECODED.items()])


def enc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The identifiers that kind, position and name give, with coordinates in six places and the joined note parts."""
    rows = _charts(spark, sf_dir).where("latitude is not null and longitude is not null and not isnan(latitude) and not isnan(longitude)")
    six = lambda c: F.format_string("%.6f", c)
    return rows.select(
        "row_no", chart_id(F.col("kind"), F.col("latitude"), F.col("longitude"), F.col("name")).alias("record_id"), F.trim(F.coalesce("name", F.lit(""))).alias("name"), six("latitude").alias("latitude"), six("longitude").alias("longitude"),
        F.round("depth_m", 2).alias("depth_m"),
    )


def enc_band_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrecks and hulks of three bands, with the rank of their band."""
    rank = F.array_position(F.array(*[F.lit(b) for b in BANDS]), F.col("bands"))
    return _charts(spark, sf_dir).where(F.col("bands").isin("harbour", "approach", "coastal") & F.col("kind").isin("wreck", "hulk")).select("row_no", "kind", "bands", rank.cast("long").alias("band_rank"))


def enc_kind_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = lambda c: F.count_if(F.coalesce(F.col(c), F.lit("")) != "")
    return _charts(spark, sf_dir).groupBy("kind").agg(F.count("*").alias("features"), filled("name").alias("with_name"), F.count("depth_m").alias("with_depth"), F.count_if(F.col("latitude").isNull()).alias("without_position"))


def enc_id_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_repeats(_charts(spark, sf_dir).select("row_no", "id"), "id", "row_no")


def enc_grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    deg = cell_degrees(100.0)
    rows = _charts(spark, sf_dir).where("latitude between -90 and 90 and longitude between -180 and 180")
    return rows.select(cell_of(F.col("longitude"), deg).alias("cx"), cell_of(F.col("latitude"), deg).alias("cy")).groupBy("cx", "cy").agg(F.count("*").alias("features"))


def enc_near_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_pairs(_charts(spark, sf_dir)).select("a", "b")


def enc_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return greedy_clusters(_charts(spark, sf_dir))


def enc_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _charts(spark, sf_dir)
    return merge_clusters(rows.join(greedy_clusters(rows), "row_no"))


def enc_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of the export in its order: kind, then id, then row."""
    return placed(_charts(spark, sf_dir).select("kind", "id", "row_no"), ["kind", "id", "row_no"], "kind", "place_in_kind")


def enc_cell_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of each chart cell against the cell's table; cells without features count 0."""
    per = _charts(spark, sf_dir).groupBy("enc_cell").agg(F.count("*").alias("n"))
    return table(spark, sf_dir, "enc_cells").join(per, "enc_cell", "left").select("enc_cell", "band", F.coalesce("n", F.lit(0)).cast("long").alias("features"))


def code_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(code_table(), "attribute string, code int, label string")


def dms_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box corners written in degrees and minutes, and read again."""
    lat = F.col("lat_min")
    a = F.round(F.abs(lat) * 60).cast("long")
    text = F.concat(F.floor(a / 60).cast("string"), F.lit("°"), (a % 60).cast("string"), F.lit("′"), F.when(lat < 0, "S").otherwise("N"))
    dmm = F.concat(F.floor(a / 60).cast("string"), F.lit(" "), (a % 60).cast("string"), F.lit(".5 "), F.when(lat < 0, "S").otherwise("N"))
    return table(spark, sf_dir, "enc_cells").select("enc_cell", text.alias("written"), dms_degrees(text).alias("dms"), dmm_degrees(dmm).alias("dmm"))


def box_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertex mean of each box's closed ring."""
    p = lambda x, y: F.array(F.col(x), F.col(y))
    ring = F.array(p("lon_min", "lat_min"), p("lon_max", "lat_min"), p("lon_max", "lat_max"), p("lon_min", "lat_max"), p("lon_min", "lat_min"))
    c = vertex_mean(ring)
    return table(spark, sf_dir, "enc_cells").select("enc_cell", F.round(c["lon"], 6).alias("lon"), F.round(c["lat"], 6).alias("lat"))


QUERIES = {
    f.__name__: f
    for f in (enc_decode, enc_records, enc_band_filter, enc_kind_counts, enc_id_suffix, enc_grid_cells, enc_near_pairs, enc_clusters, enc_merge, enc_export, enc_cell_load, code_lists, dms_decimal, box_centres)
}


def _sql_list(items: list[str]) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in items) + "]"


def _sql_decode(column: str, attribute: str) -> str:
    known = _sql_list(CODE_LISTS[attribute])
    return f"""CASE WHEN coalesce({column}, '') = '' THEN '' WHEN list_contains({known}, trim({column})) THEN trim({column}) ELSE array_to_string(list_transform(string_split({column}, ','), lambda p:
      CASE WHEN TRY_CAST(trim(p) AS DOUBLE) IS NOT NULL THEN coalesce({known}[CAST(trunc(TRY_CAST(trim(p) AS DOUBLE)) AS BIGINT)], trim(p))
           WHEN list_contains({known}, trim(p)) THEN trim(p)
           ELSE coalesce(list_filter({known}, lambda x: trim(p) <> '' AND starts_with(x, trim(p)))[1], trim(p)) END), '; ') END"""


SQL = {
    "enc_decode": "SELECT row_no, CASE WHEN kind = 'wreck' THEN " + _sql_decode("category", "CATWRK") + " WHEN kind = 'obstruction' THEN " + _sql_decode("category", "CATOBS") + " ELSE 'hulk' END AS category, "
    + ", ".join(_sql_decode(c, a) + f" AS {c}" for c, a in DECODED.items()) + " FROM noaa_enc_wrecks",
    "enc_records": """
SELECT row_no, 'NOAA-' || substr(sha1(kind || '|' || printf('%.4f', latitude) || '|' || printf('%.4f', longitude) || '|' || lower(trim(coalesce(name, '')))), 1, 12) AS record_id,
       trim(coalesce(name, '')) AS name, printf('%.6f', latitude) AS latitude, printf('%.6f', longitude) AS longitude, round(depth_m, 2) AS depth_m
FROM noaa_enc_wrecks WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND NOT isnan(latitude) AND NOT isnan(longitude)""",
    "enc_band_filter": "SELECT row_no, kind, bands, CAST(list_position(" + _sql_list(list(BANDS)) + ", bands) AS BIGINT) AS band_rank FROM noaa_enc_wrecks WHERE bands IN ('harbour', 'approach', 'coastal') AND kind IN ('wreck', 'hulk')",
    "enc_kind_counts": """
SELECT kind, count(*) AS features, count(*) FILTER (coalesce(name, '') <> '') AS with_name, count(depth_m) AS with_depth, count(*) FILTER (latitude IS NULL) AS without_position
FROM noaa_enc_wrecks GROUP BY kind""",
    "enc_id_suffix": """
SELECT row_no, CASE WHEN n > 1 THEN id || '-' || n ELSE id END AS id FROM (SELECT row_no, id, row_number() OVER (PARTITION BY id ORDER BY row_no) AS n FROM noaa_enc_wrecks)""",
    "enc_grid_cells": f"""
SELECT CAST(floor(longitude / {cell_degrees(100.0)!r}) AS BIGINT) AS cx, CAST(floor(latitude / {cell_degrees(100.0)!r}) AS BIGINT) AS cy, count(*) AS features
FROM noaa_enc_wrecks WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 GROUP BY 1, 2""",
    "enc_near_pairs": f"""
WITH p AS (
  SELECT row_no AS i, kind, lower(trim(coalesce(name, ''))) AS n, latitude AS la, longitude AS lo,
         CAST(floor(longitude / {cell_degrees(100.0)!r}) AS BIGINT) AS cx, CAST(floor(latitude / {cell_degrees(100.0)!r}) AS BIGINT) AS cy
  FROM noaa_enc_wrecks WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180
), q AS (SELECT i, kind, n, la, lo, cx + dx AS cx, cy + dy AS cy FROM p, (VALUES (-1), (0), (1)) x(dx), (VALUES (-1), (0), (1)) y(dy))
SELECT p.i AS a, q.i AS b FROM p JOIN q USING (kind, cx, cy)
WHERE p.i < q.i AND (p.n = '' OR q.n = '' OR p.n = q.n)
  AND 2 * 6371000 * asin(sqrt(least(1, pow(sin(radians(q.la - p.la) / 2), 2) + cos(radians(p.la)) * cos(radians(q.la)) * pow(sin(radians(q.lo - p.lo) / 2), 2)))) <= 100""",
    "enc_export": "SELECT kind, id, row_no, row_number() OVER (PARTITION BY kind ORDER BY id, row_no) AS place_in_kind FROM noaa_enc_wrecks",
    "enc_cell_load": "SELECT c.enc_cell, c.band, count(n.row_no) AS features FROM enc_cells c LEFT JOIN noaa_enc_wrecks n ON n.enc_cell = c.enc_cell GROUP BY 1, 2",
    "code_lists": " UNION ALL ".join(f"SELECT '{a}' AS attribute, CAST(generate_subscripts({_sql_list(x)}, 1) AS INTEGER) AS code, unnest({_sql_list(x)}) AS label" for a, x in CODE_LISTS.items()),
    "dms_decimal": """
WITH t AS (SELECT enc_cell, CAST(round(abs(lat_min) * 60) AS BIGINT) AS a, lat_min < 0 AS s FROM enc_cells)
SELECT enc_cell, (a // 60) || '°' || (a % 60) || '′' || CASE WHEN s THEN 'S' ELSE 'N' END AS written,
       round((CASE WHEN s THEN -1 ELSE 1 END) * ((a // 60) + (a % 60) / 60.0), 6)::DOUBLE AS dms, round((CASE WHEN s THEN -1 ELSE 1 END) * ((a // 60) + ((a % 60) + 0.5) / 60.0), 6)::DOUBLE AS dmm FROM t""",
    "box_centres": """
SELECT enc_cell, round(list_avg(list_transform(list_distinct(r), lambda p: p.x)), 6) AS lon, round(list_avg(list_transform(list_distinct(r), lambda p: p.y)), 6) AS lat
FROM (SELECT enc_cell, [{'x': lon_min, 'y': lat_min}, {'x': lon_max, 'y': lat_min}, {'x': lon_max, 'y': lat_max}, {'x': lon_min, 'y': lat_max}, {'x': lon_min, 'y': lat_min}] AS r FROM enc_cells)""",
}
