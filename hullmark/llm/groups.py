"""Consolidating pairwise links into groups (connected components).

The links form a grid: each vertex is hashed to one of ``side`` blocks and a link falls
into the partition of its two blocks. Every partition runs a local union-find and tells
each of its vertices the smallest vertex it can reach there. A vertex lies in one row
and one column of the grid; where these tell it different representatives, the
representatives are linked to each other, and only they go on to the next round, on a
smaller grid. Once no representatives differ, the answers are carried back round by
round. Each round works on far fewer vertices; no task holds more than its partition.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hullmark.session import release, settle


def union_find(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest vertex of each vertex's component, for vertices 0..n-1."""
    parent = np.arange(n)
    while len(a):
        low, high = np.minimum(parent[a], parent[b]), np.maximum(parent[a], parent[b])
        differ = low != high
        a, b, low, high = a[differ], b[differ], low[differ], high[differ]
        np.minimum.at(parent, high, low)
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return parent


def _partition(pdf: pd.DataFrame) -> pd.DataFrame:
    both = pd.concat([pdf["a"], pdf["b"]], ignore_index=True)
    codes, names = pd.factorize(both, sort=True)
    n = len(pdf)
    root = union_find(codes[:n], codes[n:], len(names))
    return pd.DataFrame({"v": names, "r": np.asarray(names)[root]})


def components(links: DataFrame, a: str = "a", b: str = "b", side: int | None = None, block_links: int = 400_000, rounds: int = 40) -> DataFrame:
    """``v, group_id`` for each vertex of ``links``: the smallest vertex, in text order, of
    all that are linked to it directly or through others.

    Links with a null end are no links; a link of a vertex to itself gives it a group of
    its own; repeated links count once; no links give no rows. The grid has as many rows and columns as
    keep its partitions at ``block_links`` links (or ``side``). Blocks a hot vertex fills beyond
    twice that are cut by the hash of the link, as any cut of the links serves as well.
    """
    x, y = F.col(a).cast("string"), F.col(b).cast("string")
    edges = settle(links.where(x.isNotNull() & y.isNotNull()).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct())
    told: list[DataFrame] = []
    for _ in range(rounds):
        n = edges.count()
        k = 1 if n <= block_links else side or math.ceil(math.sqrt(n / block_links))
        block = lambda c: F.pmod(F.xxhash64(c), F.lit(k))  # noqa: E731,B023
        at = edges.select("a", "b", block("a").alias("i"), block("b").alias("j"), F.lit(0).alias("s"))
        if k > 1:
            # of n links at most n / (2 * block_links) blocks are so full
            full = at.groupBy("i", "j").count().where(F.col("count") > 2 * block_links).select("i", "j", F.ceil(F.col("count") / block_links).alias("cuts"))
            cut = F.pmod(F.xxhash64("a", "b"), F.coalesce("cuts", F.lit(1)))
            at = at.drop("s").join(full, ["i", "j"], "left").select("a", "b", "i", "j", cut.alias("s"))
        local = at.groupBy("i", "j", "s").applyInPandas(_partition, "v string, r string")
        # one group per block pair; a vertex comes out of at most 2 * k of them, and their cuts
        if k == 1:
            told.append(local.select("v", F.col("r").alias("p")))
            break
        local = settle(local.distinct())
        parent = settle(local.groupBy("v").agg(F.min("r").alias("p")))
        told.append(parent)
        # representatives of one vertex that differ are linked; so are a parent and its own parent
        apart = local.join(parent, "v").where("r <> p").select(F.col("p").alias("a"), F.col("r").alias("b"))
        old, edges = edges, settle(apart.distinct())
        release(old, local)
        if edges.isEmpty():
            break
    else:
        raise RuntimeError("the components did not settle")
    answer = told[-1]
    for parent in reversed(told[:-1]):
        up = answer.select(F.col("v").alias("p"), F.col("p").alias("top"))
        answer = parent.join(up, "p", "left").select("v", F.coalesce("top", "p").alias("p"))
    return answer.select("v", F.col("p").alias("group_id"))


def listed_links(df: DataFrame, key: str = "id", listed: str = "merged_ids") -> DataFrame:
    """``a, b``: the ids of two different records of which one lists the other.

    Ids are compared without letter case and the signs around them; they may be listed
    with any separator of blanks, commas, semicolons, bars or slashes. Null, empty and unknown ids
    link nothing.
    """
    plain = lambda c: F.regexp_replace(F.lower(c), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    known = df.where(F.col(key).isNotNull() & (F.col(key) != "")).select(F.col(key).alias("own")).distinct().withColumn("k", plain(F.col("own"))).where("k <> ''")
    named = df.where(F.col(key).isNotNull() & F.coalesce(F.col(listed) != "", F.lit(False))).select(
        F.col(key).alias("own"), F.explode(F.array_distinct(F.split(F.lower(listed), r"[\s,;|/]+"))).alias("t")
    ).select("own", plain(F.col("t")).alias("k")).where("k <> ''")
    return named.join(known.withColumnRenamed("own", "other"), "k").where("own <> other").select(F.col("own").alias("a"), F.col("other").alias("b"))


def linked_groups(df: DataFrame, key: str = "id", listed: str = "merged_ids") -> DataFrame:
    """``id, group_id`` of each id that is linked to another id of the table."""
    return components(listed_links(df, key, listed)).select(F.col("v").alias("id"), "group_id")
