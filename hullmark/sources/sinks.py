"""Sinks. Spark's commit protocol makes each all or nothing."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hullmark.functions.text import derived_url

LISTED = ["id", "name", "flag", "date", "latitude", "longitude", "depth_m", "note", "wikipedia_url", "date_raw", "depth_source", "coord_source", "source_lists"]
CHARTED = [
    "id", "name", "flag", "date", "latitude", "longitude", "depth_m", "note", "kind", "category", "geometry_type", "water_level", "depth_quality", "depth_technique", "depth_exposition", "vertical_datum",
    "height_m", "source_date", "source_ind", "enc_cell", "bands", "depth_source", "coord_source",
]


def _csv(df: DataFrame, path: str, files: int | None) -> None:
    """As many files as the order has ranges, or ``files`` of them; read in the order of their names, they are in order."""
    (df.coalesce(files) if files else df).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def _text(df: DataFrame, columns: list[str]) -> list[Column]:
    """Columns as texts, coordinates in six places, missing ones as ''."""
    number = lambda c: F.col(c).try_cast("double")
    six = lambda c: F.when(number(c).isNotNull(), F.format_string("%.6f", number(c))).otherwise("")
    told = lambda c: six(c) if c in ("latitude", "longitude") else F.coalesce(F.col(c).cast("string"), F.lit(""))
    return [(told(c) if c in df.columns else F.lit("")).alias(c) for c in columns]


def write_charts_csv(records: DataFrame, path: str, files: int | None = None) -> None:
    """The charted columns, ordered by kind and id."""
    _csv(records.orderBy("kind", "id").select(*_text(records, CHARTED)), path, files)


def write_list_csv(rows: DataFrame, path: str, files: int | None = None) -> None:
    """The listed columns, ordered by date (undated last) and name; a row with an ``article`` but no address gets the article's."""
    order = F.coalesce(F.nullif(F.col("date"), F.lit("")), F.lit("9999"))
    if "article" in rows.columns:
        rows = rows.withColumn("wikipedia_url", derived_url(F.col("wikipedia_url") if "wikipedia_url" in rows.columns else F.lit(""), F.col("article")))
    kept = LISTED + [c for c in ("status", "n_merged", "merged_ids") if c in rows.columns]
    _csv(rows.orderBy(order, "name").select(*_text(rows, kept)), path, files)


def write_merged(merged: DataFrame, folder: str, keep_refloated: bool = False, files: int | None = None) -> None:
    """All groups, and those that are probably wrecks."""
    kept = ["wreck", "unknown"] + ["refloated"] * keep_refloated
    write_list_csv(merged, f"{folder}/wrecks_dedup", files)
    write_list_csv(merged.where(F.col("status").isin(kept)), f"{folder}/wrecks_only", files)


def write_geojson(records: DataFrame, path: str, geometry: str = "geometry", per_file: int = 50_000) -> None:
    """FeatureCollections of about ``per_file`` records each, one in a file of its own folder ``part=N``; ``geometry`` holds JSON text.

    The other columns are the properties, nulls included. Without records there is one empty collection.
    """
    props = F.to_json(F.struct(*[c for c in records.columns if c != geometry]), {"ignoreNullFields": "false"})
    feature = F.concat(F.lit('{"type":"Feature","geometry":'), F.coalesce(F.col(geometry), F.lit("null")), F.lit(',"properties":'), props, F.lit("}"))
    files = max(1, -(-records.count() // per_file))
    lines = records.select(feature.alias("value"), F.pmod(F.monotonically_increasing_id(), F.lit(files)).alias("part"))
    none = records.sparkSession.createDataFrame([(None, 0)], "value string, part long")  # null is no feature
    whole = lines.unionByName(none).groupBy("part").agg(F.array_join(F.collect_list("value"), ",\n").alias("all"))
    text = F.concat(F.lit('{"type":"FeatureCollection","features":['), "all", F.lit("]}"))
    whole.select(text.alias("value"), "part").write.mode("overwrite").partitionBy("part").text(path)


def write_report(counts: dict[str, int], merges: DataFrame, status: DataFrame, names: DataFrame, path: str) -> None:
    """A text report of the duplicates: totals, merges by rule, groups by status, the most frequent names."""
    spark = merges.sparkSession
    lines = [f"{k}: {v}" for k, v in counts.items()] + ["Merges by rule:"] + [f"  {r['rule']}: {r['merges']}" for r in merges.collect()]
    lines += ["Groups by status:"] + [f"  {r['status']}: {r['groups']}" for r in status.orderBy(F.desc("groups")).collect()]
    lines += ["Most frequent names left:"] + [f"  {r['norm']}: {r['n']}" for r in names.collect()]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def metadata_document(article: dict, images: list[dict], row: dict, fetched_at: str) -> str:
    """What is stored beside an article: the row it is for, what the article tells, and its images."""
    spot = {"lat": article.get("latitude"), "lon": article.get("longitude")} if article.get("latitude") is not None else None
    told = {"id": row.get("id"), "name": row.get("name"), "title": article.get("title"), "coords": spot, "depth_m": article.get("depth_m"), "images": images, "source": row, "fetched_at": fetched_at}
    return json.dumps(told, ensure_ascii=False, indent=1)
