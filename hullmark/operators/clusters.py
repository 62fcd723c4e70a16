"""Greedy spatial clusters of chart features.

The greedy rule depends on order and on what was merged before, but only within one
connected component of the graph of near features of a kind. So the components are found
first, by the radius join and label propagation, and the rule runs inside each.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hullmark.functions.geo import cell_degrees, cell_of, dist_m
from hullmark.operators.linking import smallest_labels
from hullmark.operators.nearby import possible, radius_pairs
from hullmark.session import settle


def near_pairs(features: DataFrame, merge_m: float = 100.0, key: str = "row_no") -> DataFrame:
    """Pairs of features of one kind, within the radius, in cells that touch, whose names do not differ: ``a, b, metres`` with a < b."""
    deg = cell_degrees(merge_m)
    at = features.where(possible()).select(F.col(key).alias("i"), "kind", F.lower(F.trim(F.coalesce("name", F.lit("")))).alias("n"), F.col("latitude").alias("la"), F.col("longitude").alias("lo"))
    at = at.withColumn("cy", cell_of(F.col("la"), deg)).withColumn("cx", cell_of(F.col("lo"), deg))
    around = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]))
    spread = at.select("*", around.alias("s")).select("i", "kind", "n", "la", "lo", (F.col("cx") + F.col("s.dx")).alias("cx"), (F.col("cy") + F.col("s.dy")).alias("cy"))
    metres = dist_m(F.col("p.la"), F.col("p.lo"), F.col("q.la"), F.col("q.lo"))
    alike = (F.col("p.n") == "") | (F.col("q.n") == "") | (F.col("p.n") == F.col("q.n"))
    return at.alias("p").join(spread.alias("q"), ["kind", "cx", "cy"]).where((F.col("p.i") < F.col("q.i")) & alike & (metres <= merge_m)).select(F.col("p.i").alias("a"), F.col("q.i").alias("b"), metres.alias("metres"))


def _greedy(merge_m: float, deg: float, compat: bool):
    def metres(a: tuple[float, float], b: tuple[float, float]) -> float:
        la, lo, lb, lp = map(math.radians, (*a, *b))
        h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
        return 2 * 6_371_000.0 * math.asin(min(1.0, math.sqrt(h)))

    def around(la: float) -> range | tuple[int, ...]:
        """Columns of cells to look in; beyond the grid's own reach, high latitudes need more of them."""
        if compat:
            return reach
        wide = max(1, math.ceil(0.5 / max(0.02, math.cos(math.radians(la))) + 0.5))
        return range(-wide, wide + 1)

    reach = (-1, 0, 1)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        told, last, keepers = [], None, {}
        columns = pdf.sort_values(["root", "o"])[["root", "i", "n", "la", "lo"]]
        for root, i, n, la, lo in zip(*(columns[c].tolist() for c in columns), strict=True):
            if root != last:
                last, keepers = root, {}
            name, kx, ky = (n or "").lower(), math.floor(lo / deg), math.floor(la / deg)
            near = (k for dx in around(la) for dy in reach for k in keepers.get((kx + dx, ky + dy), ()))
            home = next((k for k in near if metres((la, lo), (round(k[1], 6), round(k[2], 6))) <= merge_m and (not name or not k[3] or name == k[3])), None)
            if home is None:
                home = [i, la, lo, name]
                keepers.setdefault((kx, ky), []).append(home)
            elif not home[3]:
                home[3] = name
            told.append((i, home[0]))
        return pd.DataFrame(told, columns=["i", "keeper"])

    return run


def greedy_clusters(features: DataFrame, merge_m: float = 100.0, key: str = "row_no", compat: bool = False, per_task: int = 5000) -> DataFrame:
    """``key, keeper``: the feature that keeps each feature, in order of ``ord`` (detail of the band, then key).

    ``compat`` looks for keepers in the nine cells around only, as the grid was meant, and so
    misses some at high latitudes.
    """
    bands = F.array(*[F.lit(b) for b in ("berthing", "harbour", "approach", "coastal", "general", "overview")])
    order = F.array_position(bands, F.coalesce("bands", F.lit(""))) * F.lit(1 << 50) + F.col(key)
    at = features.where(possible()).select(F.col(key).alias("i"), "kind", F.trim(F.coalesce("name", F.lit(""))).alias("n"), F.col("latitude").alias("la"), F.col("longitude").alias("lo"), order.alias("o"))
    near = radius_pairs(features, merge_m + 1, key)
    kinds = at.select("i", "kind")
    edges = near.join(kinds.withColumnsRenamed({"i": "id_a", "kind": "ka"}), "id_a").join(kinds.withColumnsRenamed({"i": "id_b", "kind": "kb"}), "id_b").where("ka = kb").select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    edges = settle(edges)
    ends = edges.select(F.col("a").alias("idx")).union(edges.select(F.col("b").alias("idx"))).distinct()
    roots = settle(smallest_labels(ends, edges).withColumnRenamed("idx", "i"))
    share = max(1, roots.count() // per_task)
    # a task takes the components of one hash; a component is never split
    both = settle(at.join(roots, "i", "left"))
    crowd = both.where("root is not null").groupBy(F.pmod(F.xxhash64("root"), F.lit(share))).applyInPandas(_greedy(merge_m, cell_degrees(merge_m), compat), "i long, keeper long")
    alone = both.where("root is null").select("i", F.col("i").alias("keeper"))
    return crowd.union(alone).select(F.col("i").alias(key), "keeper")
