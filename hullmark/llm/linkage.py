"""Matching records of two sources that share no key.

A collective linkage on a graph. Stems of the two sources' names are vertices; they are
candidates if they share an attribute (their head, tail, consonants or letters), and an
edge weighs as much as the attributes are rare, the sum of ln(N / frequency). Meta-blocking
drops edges far below the best of both their ends, and those whose edit distance is too
wide. Records meet over the remaining edges: where both have a position, in one cell of a
grid, so that a common name never pairs all its bearers. Their similarity is then spread
to neighbours (records of the same source that mean one ship) until no pair is added.
Pairs that only names speak for are kept where just one ship of that name is known and
none of its records has a position that speaks against it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hullmark.llm.names import parse
from hullmark.llm.spellings import RADIUS, agree, links_of_read, near_stems, position_gap, read_rows
from hullmark.session import release, settle, settled_from

# Phrases ahead of a ship's name in a chart note.
_TOLD = re.compile(
    r"(?:\b(?:wreck|remains|rems|wreckage|hulk|hull|wk) of (?:the )?|\bsaid (?:by [\w ]+? )?to be (?:the )?|\bthis is (?:the )?|\b(?:believed|thought|reported|identified|known)(?: to be)?(?: as)? (?:the )?(?=[\"A-Z]))"
    r"(?P<name>.+?)(?= reported \d{4}|, sunk \d{4}| sunk \d{4}|; masts|\.?$)", re.I
)
_SUNK = re.compile(r"^(?P<name>.+?),? (?:was )?(?:sunk|lost|foundered|wrecked)(?: in)? (?P<year>\d{4})\b", re.I)
READ = "row_no long, name string, stem string, given string, number long, prefix string, country string, loss_year long, latitude double, longitude double"


def name_in_note(note: str | None) -> tuple[str, int] | None:
    """The ship's name a chart note gives, and the year of loss (0 if none)."""
    for part in (note or "").split("|"):
        part = part.strip().rstrip(".").strip("​ ")
        m = _SUNK.match(part)
        year = int(m["year"]) if m else 0
        inside = _TOLD.search(part)
        if inside:
            return inside["name"], year
        if m and not re.match(r"(?i)(masts?|rep(orted)?|vessel|wreck|ship)\b", m["name"]):
            return m["name"], year
    return None


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for row_no, name, note, lat, lon in zip(pdf["row_no"], pdf["name"], pdf["note"], pdf["latitude"], pdf["longitude"], strict=True):
            name, note = name if isinstance(name, str) else "", note if isinstance(note, str) else ""
            got, year, told = parse(name), 0, None
            if got is None or "sunk" in note:
                told = name_in_note(note)
            if told:
                year = told[1]
                if got is None:
                    name, got = told[0], parse(told[0])
            if got is not None:
                rows.append((row_no, name, got.stem, got.given, got.number, got.prefix, "", year or got.year, lat, lon))
        if rows:
            yield pd.DataFrame(rows, columns=["row_no", "name", "stem", "given", "number", "prefix", "country", "loss_year", "latitude", "longitude"]).astype({"row_no": "int64", "number": "int64", "loss_year": "int64"})


def read_chart(rows: DataFrame) -> DataFrame:
    """The chart rows that give a ship's name, in ``name`` or else in ``note``, taken apart."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    told = (F.trim(text("name")) != "") | F.lower(text("note")).rlike(r"\bof\b|\bbe\b|\bis\b|sunk|lost|known|identified")
    no_place = F.lit(None).cast("double")
    lat, lon = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    good = (F.abs(lat) <= 90) & (F.abs(lon) <= 180)
    plain = rows.where(told).select(F.col("row_no").cast("long"), "name", "note", F.when(good, lat).otherwise(no_place).alias("latitude"), F.when(good, lon).otherwise(no_place).alias("longitude"))
    return plain.mapInPandas(_read, READ)


def _attributes(stem: str) -> list[tuple[str, Column]]:
    """What stems may share, as marks: the head, the tail, the consonants and the letters."""
    s = F.col(stem)
    letters = F.array_join(F.array_sort(F.split(s, "")), "")
    bones = F.regexp_replace(F.translate(s, "aeiouy", ""), r"(.)\1+", "$1")
    return [(k, F.xxhash64(F.lit(k), v)) for k, v in (("h", F.substring(s, 1, 5)), ("t", F.substring(s, -5, 5)), ("b", bones), ("l", letters))]


def _near_of_keys(table: pa.Table) -> pa.Table:
    """``a, b, d`` of the different near stems, one asking and one not, that share a key."""
    _, key = np.unique(table["k"].to_numpy(), return_inverse=True)
    asks = table["asks"].to_numpy()
    both = (np.bincount(key, asks) > 0) & (np.bincount(key, ~asks) > 0)
    used = both[key]
    key, asks = np.unique(key[used], return_inverse=True)[1], asks[used]
    words = table["stem"].filter(pa.array(used)).to_pylist()
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    apart = int(lengths.max(initial=0)) + RADIUS + 1
    i, j, d = near_stems(words, asks, key * apart + lengths, RADIUS, ~asks, key)
    same = key[i] == key[j]
    a, b = (pa.array([words[k] for k in x[same]], pa.string()) for x in (i, j))
    return pa.table({"a": a, "b": b, "d": pa.array(d[same], pa.int32())})


def stem_edges(left: DataFrame, right: DataFrame, keep: float = 0.15) -> DataFrame:
    """``a, b, d, weight`` between distinct stems of the two sides that share rare attributes and are near.

    A shared attribute weighs ln(N / its frequency on the right). Meta-blocking goes by weight
    and comes before any comparison: an edge is dropped if it weighs less than ``keep`` of all
    that ``a`` has to share. Two stems meet at the rarest attribute they share; as that and what
    is more frequent must reach the bound, the frequent attributes of a stem are not
    looked up at all. So an attribute that a third of all stems share pairs nothing.
    """
    names = ["h", "t", "b", "l"]
    plain = lambda df: df.select("stem").distinct().select("stem", *[v.alias(k) for k, v in _attributes("stem")])
    marks = lambda: F.explode(F.array(*[F.struct(F.lit(n).alias("kind"), F.col(n).alias("k")) for n in names])).alias("m")
    b = settle(plain(right))
    by_key = b.select("stem", marks()).select("stem", "m.k")
    each = plain(left).select("stem", marks()).select("stem", "m.*")
    known = b.select(marks()).select("m.k").join(each.select("k").distinct(), "k", "left_semi").groupBy("k").agg(F.count("*").alias("df"))
    total = float(max(b.count(), 2))
    # of each left stem what each attribute weighs, below zero if nothing on the right has it
    weight = F.when(F.col("df").isNull(), F.lit(-math.log(total))).otherwise(F.log(F.lit(total) / F.col("df")))
    own = each.join(known, "k", "left").groupBy("stem").agg(*[F.max(F.when(F.col("kind") == n, weight)).alias(f"s_{n}") for n in names])
    own = own.select("stem", *[v.alias(k) for k, v in _attributes("stem")], *[F.abs(f"s_{n}").alias(f"w_{n}") for n in names], *[(F.col(f"s_{n}") >= 0).alias(f"met_{n}") for n in names])
    rarer = lambda n, m: (F.col(f"w_{n}") > F.col(f"w_{m}")) | ((F.col(f"w_{n}") == F.col(f"w_{m}")) & F.lit(names.index(n) < names.index(m)))
    least = F.lit(keep) * sum(F.col(f"w_{n}") for n in names)
    ways = [F.struct(F.col(m).alias("k"), (F.col(f"met_{m}") & (sum(F.when(rarer(n, m), 0.0).otherwise(F.col(f"w_{n}")) for n in names) >= least)).alias("on")) for m in names]
    asked = own.select("stem", F.explode(F.array(*ways)).alias("way")).where("way.on").select("stem", "way.k")
    rows = asked.select("k", "stem", F.lit(True).alias("asks")).unionByName(by_key.select("k", "stem", F.lit(False).alias("asks")))
    parts = max(1, int(total) // 16_384)
    found = rows.groupBy(F.pmod("k", F.lit(parts))).applyInArrow(_near_of_keys, "a string, b string, d int").distinct()
    equal = b.select(F.col("stem").alias("a"), F.col("stem").alias("b"), F.lit(0).alias("d")).join(asked.select(F.col("stem").alias("a")).distinct(), "a", "left_semi")
    bare = lambda c: {k: v for k, v in _attributes(c)}
    met = found.unionByName(equal).join(own.select(F.col("stem").alias("a"), *[f"w_{n}" for n in names], least.alias("least")), "a")
    shares = {n: bare("a")[n] == bare("b")[n] for n in names}
    weighed = met.withColumn("weight", sum(F.when(shares[n], F.col(f"w_{n}")).otherwise(0.0) for n in names))
    return weighed.where(F.col("weight") >= F.col("least")).select("a", "b", "d", "weight")


def _cells(lat: Column, lon: Column, km: float = 0.0, deg: float = 2.0) -> Column:
    """The grid cells that a circle of ``km`` around a position can touch; its own cell for 0."""
    turn = round(360 / deg)
    tall = km / 111.0
    far = F.when(F.abs(lat) + tall >= 89, F.lit(180.0)).otherwise(tall / F.cos(F.radians(F.abs(lat) + tall)))
    row = lambda y: F.floor(y / deg).cast("int")
    ys, xs = F.sequence(row(lat - tall), row(lat + tall)), F.sequence(row(lon + 180 - far), row(lon + 180 + far))
    return F.array_distinct(F.flatten(F.transform(ys, lambda y: F.transform(xs, lambda x: y * 1000 + F.pmod(x, F.lit(turn))))))


def match(chart_rows: DataFrame, list_rows: DataFrame, near_km: float = 30.0) -> DataFrame:
    """``chart_row, list_row, confidence`` of rows of the two sources that tell of one ship.

    ``chart_rows``: row_no, name, note, latitude, longitude. ``list_rows``: row_no, name,
    flag, date, latitude, longitude, source_lists. Other columns are ignored. Rows that
    give no ship's name are in no pair; repeated rows each have their pairs; an empty
    table on either side gives none. Missing and impossible positions count as missing.
    """
    chart, listed = settle(read_chart(chart_rows)), settle(read_rows(list_rows))
    edges = settled_from(lambda: stem_edges(chart, listed))
    met_a, met_b = edges.select(F.col("a").alias("stem")).distinct(), edges.select(F.col("b").alias("stem")).distinct()
    named = settle(chart.join(met_a, "stem", "left_semi").select(*[c for c in chart.columns if c != "name"]))
    release(chart)
    chart, ships = named, settle(listed.join(met_b, "stem", "left_semi").select("row_no", "stem", "given", "number", "prefix", "country", "latitude", "longitude", "year"))
    there = F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & ~F.isnan("latitude") & ~F.isnan("longitude")

    lat, lon = F.col("latitude"), F.col("longitude")
    slips = F.array(*[F.struct(a.alias("la"), b.alias("lo")) for a, b in ((lat, lon), (lat, -lon), (-lat, lon), (-lat, -lon), (lon, lat), (-lon, lat), (lon, -lat), (-lon, -lat))])
    own = F.transform(F.filter(slips, lambda p: (F.abs(p["la"]) <= 90) & (F.abs(p["lo"]) <= 180)), lambda p: F.get(_cells(p["la"], p["lo"]), F.lit(0)))
    wide = ships.where(there).select(*ships.columns, F.explode(F.array_distinct(own)).alias("cell"))
    spots = chart.where(there).join(edges, chart["stem"] == edges["a"]).select(*chart.columns, "b", "d", F.explode(_cells(lat, lon, near_km)).alias("cell"))
    year_ok = (F.col("n.loss_year") == 0) | (F.col("w.year") == 0) | (F.col("n.loss_year") == F.col("w.year"))
    gap = position_gap("n", "w")
    n, w, e = spots.alias("n"), wide.alias("w"), edges.alias("e")
    placed = n.join(w, (F.col("n.b") == F.col("w.stem")) & (F.col("n.cell") == F.col("w.cell"))).where(
        agree("n", "w") & year_ok & (gap <= near_km)
    ).select(F.col("n.row_no").alias("x"), F.col("w.row_no").alias("y"), (1 - 0.1 * F.col("n.d") - F.when(gap > 10, 0.1).otherwise(0.0)).alias("s"))
    pairs = settle(placed.groupBy("x", "y").agg(F.max("s").alias("s")))

    # links among all list rows: a stem that meets no chart stem is reached through a linked row
    links = settled_from(lambda: links_of_read(listed).select("row_a", "row_b", "confidence"))
    both = links.unionByName(links.select(F.col("row_b").alias("row_a"), F.col("row_a").alias("row_b"), "confidence"))

    # names alone
    with_place = ships.where(there).select("row_no")
    by_place = both.join(with_place.withColumnRenamed("row_no", "row_b"), "row_b", "left_semi").select(F.col("row_a").alias("row_no"))
    unplaced = ships.where(~there).join(by_place, "row_no", "left_anti").select("*", F.lit(False).alias("far"))
    # how many ships a name (with given name and number) stands for: its years, and its countries
    bearers = ships.groupBy("stem", "number").agg(
        F.count_distinct(F.when(F.col("year") > 0, F.col("year"))).alias("years"), F.count_distinct(F.when(F.col("country") != "", F.col("country"))).alias("flags"),
        F.count_distinct(F.when(F.length("given") > 1, F.col("given"))).alias("givens"),
    )
    sole = bearers.where("years <= 1 and flags <= 1 and givens <= 1").select("stem", "number")
    lone = unplaced.unionByName(ships.where(there).select("*", F.lit(True).alias("far"))).join(sole, ["stem", "number"]).alias("w")
    n = chart.select("*", there.alias("seen")).alias("n")
    by_name = n.join(e, F.col("n.stem") == F.col("e.a")).join(lone, (F.col("e.b") == F.col("w.stem")) & (F.col("n.number") == F.col("w.number"))).where(
        (~F.col("w.far") | ~F.col("n.seen")) & agree("n", "w") & year_ok & (F.length("n.stem") >= 7) & (F.col("e.d") <= 2)
    ).select(F.col("n.row_no").alias("x"), F.col("w.row_no").alias("y"), (0.7 - 0.1 * F.col("e.d")).alias("s"))
    # linked rows of stems that met no chart stem were not compared by place; theirs may speak against it
    others = listed.where(there).join(met_b, "stem", "left_anti").select(F.col("row_no").alias("row_b"), "latitude", "longitude")
    others = both.join(others, "row_b").select(F.col("row_a").alias("y"), "latitude", "longitude")
    by_name_found = settle(by_name)
    told = by_name_found.select("x", "y").join(chart.where(there).select(F.col("row_no").alias("x"), "latitude", "longitude"), "x").alias("c").join(others.alias("o"), F.col("c.y") == F.col("o.y"))
    against = told.where(position_gap("c", "o") > near_km).select("c.x", "c.y").distinct()
    by_name = by_name_found.join(against, ["x", "y"], "left_anti")
    begun = settle(pairs.unionByName(by_name).groupBy("x", "y").agg(F.max("s").alias("s")))
    release(pairs, by_name_found, edges, chart, ships, listed)
    # Similarity spreads to rows that mean the same ship: a pair is as good as its own evidence or, a
    # little less, as its best neighbour's. Each round passes on what the last one raised.
    # It ends, as a way round never raises a pair, and of other ways there are finitely many.
    pairs = raised = begun
    while True:
        reached = raised.join(both, raised["y"] == both["row_a"]).select("x", F.col("row_b").alias("y"), (F.col("s") * 0.95 * F.least(F.lit(1.0), F.col("confidence") + 0.1)).alias("new"))
        reached = reached.groupBy("x", "y").agg(F.max("new").alias("new"))
        better = reached.join(pairs, ["x", "y"], "left").where(F.col("s").isNull() | (F.col("new") > F.col("s") + 1e-9)).select("x", "y", F.col("new").alias("s"))
        raised = settle(better)
        if raised.isEmpty():
            break
        old, pairs = pairs, settle(pairs.unionByName(raised).groupBy("x", "y").agg(F.max("s").alias("s")))
        release(old)
    release(links, raised)
    return pairs.select(F.col("x").alias("chart_row"), F.col("y").alias("list_row"), F.col("s").alias("confidence"))
