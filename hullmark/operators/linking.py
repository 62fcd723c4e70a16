"""Duplicate rules over list rows, and the groups they form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hullmark.functions.dates import year_key
from hullmark.functions.geo import coordinate, dist_km
from hullmark.functions.text import norm_name
from hullmark.session import settle

RULES = ("same id", "same article", "same name and day", "same name and month", "same name and year, near")


def keyed(rows: DataFrame, idx: str = "row_no") -> DataFrame:
    """Rows with what the rules look at: ``idx, norm, date, year, lat, lon`` besides their columns. Missing texts become ''."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    number = lambda c: coordinate(F.col(c).cast("string"))
    good = lambda c: F.when(~F.isnan(c), c)
    return rows.select(
        F.col(idx).alias("idx"), text("id").alias("id"), text("wikipedia_url").alias("url"), text("date").alias("date"), norm_name(F.col("name")).alias("norm"),
        year_key(F.col("date")).alias("year"), good(number("latitude")).alias("lat"), good(number("longitude")).alias("lon"),
    )


def union_by(rows: DataFrame, key: Column, when: Column) -> DataFrame:
    """Edges ``a, b`` from the rows with equal ``key`` to the first of them. The one pluggable rule."""
    block = rows.where(when).select("idx", key.alias("k")).where(F.col("k").isNotNull())
    first = block.groupBy("k").agg(F.min("idx").alias("a"))
    return block.join(first, "k").where("idx <> a").select("a", F.col("idx").alias("b"))


def by_id(rows: DataFrame) -> DataFrame:
    return union_by(rows, F.col("id"), F.col("id") != "")


def by_article(rows: DataFrame) -> DataFrame:
    return union_by(rows, F.lower("url"), F.col("url") != "")


def by_day(rows: DataFrame) -> DataFrame:
    return union_by(rows, F.struct("norm", "date"), (F.col("norm") != "") & (F.length("date") >= 10))


def by_month(rows: DataFrame) -> DataFrame:
    """Blocks of one name and month join if some date lacks the day and no two days differ."""
    month = F.struct("norm", F.substring("date", 1, 7).alias("m"))
    fit = rows.where((F.col("norm") != "") & (F.length("date") >= 7)).select("idx", "date", month.alias("k"))
    full = F.when(F.length("date") >= 10, F.col("date"))
    good = fit.groupBy("k").agg(
        F.bool_or(F.length("date") == 7).alias("partial"), F.min(full).alias("lo"), F.max(full).alias("hi"), F.min("idx").alias("a")
    ).where(F.col("partial") & (F.col("lo").isNull() | (F.col("lo") == F.col("hi"))))
    return fit.join(good, "k").where("idx <> a").select("a", F.col("idx").alias("b"))


def by_place(rows: DataFrame, max_km: float = 10.0) -> DataFrame:
    """Pairs of one name and year at most ``max_km`` apart, met on a grid of latitude so that a common name does not pair all its rows."""
    deg = max_km / 111.0
    fit = rows.where((F.col("norm") != "") & (F.col("year") != "") & F.col("lat").isNotNull() & F.col("lon").isNotNull()).select("idx", "norm", "year", "lat", "lon")
    y = F.floor(F.col("lat") / deg).cast("long")
    near = fit.select("idx", "norm", "year", "lat", "lon", F.explode(F.array(y - 1, y, y + 1)).alias("y")).alias("p")
    own = fit.withColumn("y", y).alias("q")
    hit = own.join(near, ["norm", "year", "y"]).where((F.col("p.idx") < F.col("q.idx")) & (dist_km(F.col("p.lat"), F.col("p.lon"), F.col("q.lat"), F.col("q.lon")) <= max_km))
    return hit.select(F.col("p.idx").alias("a"), F.col("q.idx").alias("b"))


def rule_edges(rows: DataFrame, max_km: float = 10.0) -> list[DataFrame]:
    """The edges of each of ``RULES``, in their order."""
    rules: list[Callable[[DataFrame], DataFrame]] = [by_id, by_article, by_day, by_month, lambda r: by_place(r, max_km)]
    return [f(rows) for f in rules]


def smallest_labels(vertices: DataFrame, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``idx, root``: the smallest vertex each vertex is connected with.

    Each round, neighbours tell each other their labels and every label is followed to its
    own label, so that paths halve; done once nothing changes.
    """
    both = settle(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = settle(both.select(F.col("a").alias("idx"), F.col("a").alias("root")).distinct())
    for _ in range(rounds):
        told = both.join(labels.withColumnsRenamed({"idx": "b"}), "b").groupBy("a").agg(F.min("root").alias("told"))
        low = labels.join(told.withColumnRenamed("a", "idx"), "idx", "left").select("idx", "root", F.least("root", F.coalesce("told", "root")).alias("low"))
        # a root that hears of a lower one takes it along
        lowered = low.where("low < root").groupBy("root").agg(F.min("low").alias("r2"))
        low = low.join(lowered, "root", "left").select("idx", F.col("root").alias("old"), F.least("low", F.coalesce("r2", "low")).alias("root"))
        up = low.select(F.col("idx").alias("root"), F.col("root").alias("top"))
        new = settle(low.join(up, "root", "left").select("idx", "old", F.coalesce("top", "root").alias("root")))
        labels = new.select("idx", "root")
        if new.where("old <> root").isEmpty():
            # vertices without a link are their own roots
            return vertices.select("idx").join(labels, "idx", "left").select("idx", F.coalesce("root", "idx").alias("root"))
    raise RuntimeError("the labels did not settle")


def groups(rows: DataFrame, max_km: float = 10.0, rules: int = len(RULES)) -> DataFrame:
    """``idx, root`` by the first ``rules`` rules."""
    rows = settle(rows)
    edges = rule_edges(rows, max_km)[:rules]
    out = edges[0]
    for e in edges[1:]:
        out = out.union(e)
    return smallest_labels(rows, out)


def rule_merges(rows: DataFrame, max_km: float = 10.0) -> DataFrame:
    """``rule, merges``: by how many groups each rule lessens what the rules before it left.

    Each rule's edges are drawn between the groups so far, and only those they touch are labelled anew.
    """
    spark = rows.sparkSession
    rows = settle(rows)
    labels, counts = rows.select("idx", F.col("idx").alias("root")), []
    for e in rule_edges(rows, max_km):
        ends = [labels.select(F.col("idx").alias(c), F.col("root").alias(f"r{c}")) for c in ("a", "b")]
        between = settle(e.join(ends[0], "a").join(ends[1], "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())
        touched = between.select(F.col("a").alias("idx")).union(between.select("b")).distinct()
        moved = settle(smallest_labels(touched, between).where("idx <> root").select(F.col("idx").alias("root"), F.col("root").alias("to")))
        counts.append(moved.count())
        labels = settle(labels.join(moved, "root", "left").select("idx", F.coalesce("to", "root").alias("root")))
    return spark.createDataFrame(list(zip(RULES, counts, strict=True)), "rule string, merges long")


def ranked(rows: DataFrame, by: str = "root") -> DataFrame:
    """``_rank`` 1 is the row that leads its group: with article, position, depth, the longer date, the longer note, then first in order."""
    there = lambda c: (F.coalesce(F.col(c).cast("string"), F.lit("")) != "").cast("int").desc()
    size = lambda c: F.length(F.coalesce(F.col(c), F.lit(""))).desc()
    w = Window.partitionBy(by).orderBy(there("wikipedia_url"), there("latitude"), there("depth_m"), size("date"), size("note"), F.col("idx"))
    return rows.withColumn("_rank", F.row_number().over(w))
