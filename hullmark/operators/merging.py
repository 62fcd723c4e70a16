"""Rules by which the fields of merged records are chosen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hullmark.functions.status import classify


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def first_filled(c: str, order: str) -> Column:
    """The value of the first row, in ``order``, that has one; null if none has."""
    return F.min_by(F.when(_text(c) != "", F.col(c)), F.when(_text(c) != "", F.col(order)))


def longest(c: str, order: str, take: str | None = None) -> Column:
    """The longest text (the first of equals), or the column ``take`` of its row."""
    rank = F.struct(F.length(_text(c)).alias("n"), (-F.col(order)).alias("o"))
    return F.max_by(F.col(take or c), F.when(_text(c) != "", rank))


def ordered_union(c: str, order: str, separator: str = " | ", distinct: bool = True) -> Column:
    """All parts of a joined list, in the order of their rows; repeats within the whole dropped."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.split(_text(c), F.lit("\\Q" + separator + "\\E")).alias("p"))))
    flat = F.filter(F.flatten(F.transform(parts, lambda x: x["p"])), lambda x: x != "")
    return F.array_join(F.array_distinct(flat) if distinct else flat, separator)


def by_unit(fields: list[str], lead: str, order: str) -> list[Column]:
    """Fields taken together from the first row that has ``lead``."""
    have = F.when(_text(lead) != "", F.col(order))
    return [F.min_by(F.when(_text(lead) != "", F.col(f)), have).alias(f) for f in fields]


def merge_listed(rows: DataFrame, order: str = "row_no") -> DataFrame:
    """One row per ``id``: note the longest, date (with its text) the longest, position and depth as units, lists joined, else the first filled."""
    return rows.groupBy("id").agg(
        first_filled("name", order).alias("name"), first_filled("flag", order).alias("flag"),
        longest("date", order).alias("date"), longest("date", order, "date_raw").alias("date_raw"),
        *by_unit(["latitude", "longitude", "coord_source"], "latitude", order), *by_unit(["depth_m", "depth_source"], "depth_m", order),
        longest("note", order).alias("note"), first_filled("wikipedia_url", order).alias("wikipedia_url"), ordered_union("source_lists", order).alias("source_lists"), F.count("*").alias("n_rows"),
    )


def merge_groups(rows: DataFrame) -> DataFrame:
    """One row per ``root`` of ranked rows (``_rank``, ``idx``).

    The leading row gives name, id and note. Other fields come from the first row that has
    them. The group is a wreck if any row is; then the latest dated loss gives the date and the note.
    """
    rows = rows.withColumn("_status", classify(F.col("note")))
    loss = (F.col("_status") == "wreck") & (_text("date") != "")
    when = F.when(loss, F.struct(_text("date").alias("d"), (-F.col("_rank")).alias("r")))
    lead = lambda c: F.min_by(F.col(c), F.col("_rank")).alias(c)
    ids = F.array_sort(F.collect_list(F.struct(F.col("_rank").alias("r"), F.col("id").alias("i"))))
    out = rows.groupBy("root").agg(
        lead("id"), lead("name"), F.min_by(_text("note"), F.col("_rank")).alias("_note"),
        first_filled("flag", "_rank").alias("flag"), first_filled("wikipedia_url", "_rank").alias("wikipedia_url"),
        first_filled("date", "_rank").alias("_date"), first_filled("date_raw", "_rank").alias("_raw"),
        *by_unit(["latitude", "longitude", "coord_source"], "latitude", "_rank"), *by_unit(["depth_m", "depth_source"], "depth_m", "_rank"),
        ordered_union("source_lists", "_rank").alias("source_lists"),
        F.array_join(F.slice(F.transform(ids, lambda x: x["i"]), 2, 1 << 30), " ").alias("merged_ids"), F.count("*").alias("n_merged"),
        F.bool_or(F.col("_status") == "wreck").alias("_w"), F.bool_or(F.col("_status") == "refloated").alias("_r"),
        F.max_by(F.struct(_text("date").alias("d"), F.coalesce("date_raw", F.lit("")).alias("raw"), _text("note").alias("n")), when).alias("_loss"),
    )
    status = F.when(F.col("_w"), "wreck").when(F.col("_r"), "refloated").otherwise("unknown")
    return out.select(
        "root", "id", "name", F.coalesce("flag", F.lit("")).alias("flag"), F.coalesce("_loss.d", "_date", F.lit("")).alias("date"), F.coalesce("_loss.raw", "_raw", F.lit("")).alias("date_raw"),
        "latitude", "longitude", "coord_source", "depth_m", "depth_source", F.coalesce(F.nullif(F.col("_loss.n"), F.lit("")), "_note").alias("note"),
        F.coalesce("wikipedia_url", F.lit("")).alias("wikipedia_url"), "source_lists", status.alias("status"), F.col("n_merged").cast("long"), "merged_ids",
    )


def merge_clusters(rows: DataFrame, keeper: str = "keeper", order: str = "row_no") -> DataFrame:
    """One row per cluster of chart rows: id, position and geometry stay the keeper's, every other field is the first filled, bands are joined."""
    stay = lambda c: F.min_by(F.col(c), F.col("_o")).alias(c)
    filled = ["name", "flag", "date", "depth_m", "note", "category", "water_level", "depth_quality", "depth_technique", "depth_exposition", "vertical_datum", "height_m", "source_date", "source_ind", "enc_cell", "depth_source", "coord_source"]
    first = rows.withColumn("_o", F.when(F.col(order) == F.col(keeper), F.lit(-1)).otherwise(F.col(order)))
    return first.groupBy(keeper).agg(
        stay("id"), stay("kind"), stay("latitude"), stay("longitude"), stay("geometry_type"), *[first_filled(c, "_o").alias(c) for c in filled if c in rows.columns],
        ordered_union("bands", "_o", ",").alias("bands"), F.count("*").alias("n_features"),
    )
