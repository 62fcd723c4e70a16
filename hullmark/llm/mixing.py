"""Mixing sources to target weights.

A source's records are spread over shards by a seeded hash and laid into blocks of equal
size (equal but for the record that a cut falls into; what each holds is counted). Whole blocks are apportioned by Sainte-Laguë (each next block goes to the source
with the highest quotient of its share by 2 n + 1), first to sources, then to the shards
of a source, never beyond the allowed repeats. A shard fills its quota, in units of what its blocks
really hold, with blocks in a seeded order, as often as the quota needs.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hullmark.session import settle


def plain_source(source: Column) -> Column:
    """One writing per source: lower case, other signs as single underscores; null stays null."""
    return F.nullif(F.regexp_replace(F.regexp_replace(F.lower(source), r"[^\p{L}\p{N}]+", "_"), "^_|_$", ""), F.lit(""))


def sainte_lague(weights: dict, seats: int, caps: dict) -> dict:
    """Seats by highest quotient, none beyond its cap; ties go to the smaller key. Fewer than ``seats`` if all caps are met."""
    got = dict.fromkeys(weights, 0)
    queue = [(-w, k) for k, w in sorted(weights.items()) if w > 0 and caps.get(k, 0) > 0]
    heapq.heapify(queue)
    for _ in range(seats):
        if not queue:
            break
        _, k = heapq.heappop(queue)
        got[k] += 1
        if got[k] < caps[k]:
            heapq.heappush(queue, (-weights[k] / (2 * got[k] + 1), k))
    return got


def full_size(sizes: dict, shares: dict, repeats: dict) -> float:
    """The largest total at which every source that has records can give its share."""
    there = {s: shares[s] for s in shares if sizes.get(s, 0) > 0 and shares[s] > 0 and repeats[s] > 0}
    whole = sum(there.values())
    return min((sizes[s] * repeats[s] / (share / whole) for s, share in there.items()), default=0.0)


def mix(
    records: DataFrame, targets: DataFrame, size: str = "n_tokens", key: str = "doc_id", total: float | None = None,
    blocks: int = 20_000, least_block: int = 64, shard_size: int = 50_000_000, max_shards: int = 4096, seed: int = 7,
) -> DataFrame:
    """``key, source, size, copies`` of the records in the mix (copies at least 1).

    ``records`` has ``key, source, size``; ``targets`` has ``source, target_share,
    max_repeats`` (one row per source; the driver holds it). Without ``total`` the mix is as
    large as the shares and repeats allow at once; the share of a source without records is
    shared out over the others in proportion. With a larger ``total`` a source stops at its
    repeats. Records without a source, of a source without target, or without size are in
    no mix; repeated rows of a key count as records of their own.
    """
    spark = records.sparkSession
    want = {}
    for r in targets.select(plain_source(F.col("source")).alias("s"), "target_share", "max_repeats").collect():
        if r["s"] is not None and r["target_share"] and r["target_share"] > 0:
            want[r["s"]] = (float(r["target_share"]), max(0, int(r["max_repeats"] or 0)))
    rows = records.select(F.col(key), plain_source(F.col("source")).alias("source"), F.col(size).cast("long").alias("_size"))
    rows = settle(rows.where(F.col("source").isin(list(want)) & (F.col("_size") > 0)))
    sizes = {r["source"]: float(r["n"]) for r in rows.groupBy("source").agg(F.sum("_size").alias("n")).collect()}
    shares, repeats = {s: w[0] for s, w in want.items()}, {s: w[1] for s, w in want.items()}
    total = full_size(sizes, shares, repeats) if total is None else total
    empty = spark.createDataFrame([], f"{key} {records.schema[key].dataType.simpleString()}, source string, {size} long, copies int")
    if not sizes or total <= 0:
        return empty
    width = max(float(least_block), total / blocks)
    shards = {s: int(min(max_shards, -(-n // shard_size))) for s, n in sizes.items()}
    shard_of = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.try_element_at(F.create_map(*[F.lit(x) for kv in shards.items() for x in kv]), F.col("source"))).cast("int")
    rows = rows.withColumn("shard", shard_of)
    # records in a seeded order, cut where the running size passes a whole block
    place = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed + 1), F.col(key)), F.col(key))
    ends = F.sum("_size").over(place)
    laid = settle(rows.withColumn("block", F.floor((ends - F.col("_size") / 2) / F.lit(width)).cast("long")))
    # what each block really holds: a few rows a shard
    held_by = laid.groupBy("source", "shard", "block").agg(F.sum("_size").alias("held"))
    # one row per source and shard: at most len(targets) * max_shards
    held = {(r["source"], r["shard"]): int(r["n"]) for r in held_by.groupBy("source", "shard").agg(F.sum("held").alias("n")).collect()}
    seats_of = lambda n, s: max(1, int(n * repeats[s] // width))
    supply: dict = {}
    for (s, _), n in held.items():
        supply[s] = supply.get(s, 0) + n
    quota = sainte_lague({s: shares[s] for s in supply}, round(total / width), {s: seats_of(n, s) for s, n in supply.items()})
    plan = []
    for s, seats in quota.items():
        own = {k: n for k, n in held.items() if k[0] == s}
        for k, q in sainte_lague(own, seats, {k: seats_of(n, s) for k, n in own.items()}).items():
            if q:
                plan.append((*k, float(min(q * width, own[k] * repeats[s])), own[k]))
    if not plan:
        return empty
    plan_df = F.broadcast(spark.createDataFrame(plan, "source string, shard int, quota double, whole long"))  # as many rows as held
    turn = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed + 2), F.col("source"), F.col("shard"), F.col("block")), "block")
    # all blocks as often as the quota holds the shard, then blocks in turn until the rest of it is reached
    often = F.floor(F.col("quota") / F.col("whole"))
    filled = held_by.join(plan_df, ["source", "shard"]).withColumn("_mid", F.sum("held").over(turn) - F.col("held") / 2)
    copies = (often + (F.col("_mid") < F.col("quota") - often * F.col("whole")).cast("int")).cast("int")
    chosen = filled.select("source", "shard", "block", copies.alias("copies")).where("copies > 0")
    return laid.join(chosen, ["source", "shard", "block"]).select(key, "source", F.col("_size").alias(size), "copies")


def reached_shares(mixed: DataFrame, targets: DataFrame, size: str = "n_tokens") -> DataFrame:
    """Per target source: the share aimed at, the share reached, size, records and most copies in the mix."""
    per = mixed.groupBy("source").agg(
        F.sum(F.col(size) * F.col("copies")).cast("long").alias("size_in_mix"), F.count("*").alias("records"), F.max("copies").alias("most_copies")
    )
    whole = mixed.agg(F.sum(F.col(size) * F.col("copies")).alias("_whole"))
    aim = targets.select(plain_source(F.col("source")).alias("source"), "target_share", "max_repeats")
    out = aim.join(per, "source", "left").crossJoin(F.broadcast(whole))  # the right side is one row
    share = F.coalesce(F.col("size_in_mix") / F.nullif(F.col("_whole"), F.lit(0)), F.lit(0.0))
    zero = lambda c, t: F.coalesce(F.col(c), F.lit(0)).cast(t).alias(c)
    return out.select("source", "target_share", share.alias("actual_share"), zero("size_in_mix", "long"), zero("records", "long"), "max_repeats", zero("most_copies", "int"))
