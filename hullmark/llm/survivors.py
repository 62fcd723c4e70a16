"""The best value of each field in each group of duplicate records.

Candidates are ranked by trust, then recency, then completeness, then key, by a window
of which only the first row per group and field is kept. Spark keeps that many rows per
group already ahead of the shuffle, so a group with a third of all rows sends a few rows
per task and no more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Titles under /wiki/ that are no article on a single thing.
NO_ARTICLE = r"^(lists?_of_|category:|file:|image:|help:|template:|special:|portal:|talk:|user:|wikipedia:|wiktionary:|index_of_)|_\(disambiguation\)$|(-|_)class(_|$)"


def article_title(url: Column) -> Column:
    """The title an address of an article names, lower case, blanks as underscores; else null."""
    title = F.regexp_extract(F.trim(url), r"(?i)^https?://[^/\s]+/wiki/([^?#\s]+)(?:#.*)?$", 1)
    return F.nullif(F.lower(F.regexp_replace(title, r"%20|\s", "_")), F.lit(""))


def is_article(url: Column) -> Column:
    """True for an address of an article on one wreck: no placeholder, list, class article or page yet to be written."""
    title = article_title(url)
    return F.coalesce(~title.rlike(NO_ARTICLE) & title.rlike(r"[\p{L}\p{N}]"), F.lit(False))


def is_depth(value: Column) -> Column:
    """True for a depth in metres above 0 and below 11,000 (NaN is above)."""
    return F.coalesce((value > 0) & (value < 11_000), F.lit(False))


def best_values(records: DataFrame, fields: dict[str, tuple[Column, Column]], group: str = "group_id", key: str = "id", recency: str = "loaded_at") -> DataFrame:
    """``group_id, field_name, from_id, value`` of the value that survives per field.

    ``fields`` gives for each column whether its value is usable and a trust rank (the
    higher the better). Later ``recency`` wins next (null is the oldest), then the record
    with more usable fields, then the smaller key. Groups without a usable value have no
    row for that field; exact copies of a record count once.
    """
    full = sum((f[0].cast("int") for f in fields.values()), F.lit(0))
    each = F.array(*[
        F.struct(F.lit(name).alias("field_name"), usable.alias("usable"), trust.cast("int").alias("trust"), F.col(name).cast("string").alias("value"))
        for name, (usable, trust) in fields.items()
    ])
    rows = records.where(F.col(group).isNotNull()).select(F.col(group).alias("group_id"), F.col(key).alias("from_id"), F.col(recency).alias("_when"), full.alias("_full"), F.explode(each).alias("f"))
    rows = rows.where("f.usable").select("group_id", "from_id", "_when", "_full", "f.field_name", "f.trust", "f.value")
    order = Window.partitionBy("group_id", "field_name").orderBy(
        F.col("trust").desc(), F.col("_when").desc_nulls_last(), F.col("_full").desc(), F.col("from_id"), F.col("value")
    )
    return rows.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").select("group_id", "field_name", "from_id", "value")
