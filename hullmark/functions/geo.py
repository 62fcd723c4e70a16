"""Distances, grid cells, and coordinates written in degrees and minutes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0


def haversine(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column, radius: float) -> Column:
    h = F.pow(F.sin(F.radians(lat_b - lat_a) / 2), 2) + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * F.pow(F.sin(F.radians(lon_b - lon_a) / 2), 2)
    return F.lit(2 * radius) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def dist_m(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    return haversine(lat_a, lon_a, lat_b, lon_b, EARTH_M)


def dist_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    return haversine(lat_a, lon_a, lat_b, lon_b, EARTH_M / 1000)


def cell_degrees(merge_m: float) -> float:
    """The side of a grid cell for a merge radius."""
    return max(merge_m / 111_000 * 2, 0.0005)


def cell_of(coordinate: Column, degrees: float) -> Column:
    return F.floor(coordinate / F.lit(degrees)).cast("long")


def coordinate(text: Column) -> Column:
    """A coordinate text as a number; null if it is none."""
    return F.trim(text).try_cast("double")


def dms_degrees(text: Column, compat: bool = False) -> Column:
    """Degrees, minutes, seconds and hemisphere to decimal degrees, six places; null if there is no number.

    ``compat`` loses the seconds, and the hemisphere after them, as two prime signs no longer are one double sign.
    """
    t = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    seconds = r"(?:([\d.]+)″)?" if compat else r"(?:([\d.]+)(?:″|′′|''|\"))?"
    if compat:
        t = F.replace(t, F.lit("″"), F.lit("′′"))
    p = r"^(-?[\d.]+)°?\s*(?:([\d.]+)′(?!′))?\s*" + seconds + r"\s*([NSEW])?" if not compat else r"^(-?[\d.]+)°?\s*(?:([\d.]+)′)?\s*" + seconds + r"\s*([NSEW])?"
    part = lambda i: F.regexp_extract(t, p, i)
    number = lambda i: F.coalesce(part(i).try_cast("double"), F.lit(0.0))
    v = part(1).try_cast("double") + number(2) / 60 + number(3) / 3600
    return F.round(F.when(part(4).isin("S", "W"), -v).otherwise(v), 6)


def dmm_degrees(text: Column) -> Column:
    """``58 18.03 N`` (degrees, decimal minutes, hemisphere) to decimal degrees, six places; null otherwise."""
    p = r"^\s*(\d{1,3})\s+(\d+(?:\.\d+)?)\s*([NSEW])\s*$"
    part = lambda i: F.regexp_extract(text, p, i)
    v = part(1).try_cast("double") + part(2).try_cast("double") / 60
    return F.round(F.when(part(3).isin("S", "W"), -v).otherwise(v), 6)


def vertex_mean(vertices: Column) -> Column:
    """Mean point of the distinct vertices of an array of arrays (x, y, ...): a struct of lon and lat, null if empty."""
    points = F.array_distinct(F.transform(vertices, lambda v: F.struct(v[0].alias("lon"), v[1].alias("lat"))))
    n = F.size(points)
    total = lambda f: F.aggregate(points, F.lit(0.0), lambda a, p: a + p[f])
    return F.when(n > 0, F.struct((total("lon") / n).alias("lon"), (total("lat") / n).alias("lat")))


def representative_point(geojson: Column) -> Column:
    """Struct of lon and lat of a GeoJSON geometry text: a point itself, else its vertex mean, at any depth of nesting."""
    inside = F.regexp_extract(geojson, r'"coordinates"\s*:\s*(\[.*\])', 1)
    pairs = F.regexp_extract_all(inside, F.lit(r"\[\s*(-?[\d.eE+-]+\s*,\s*-?[\d.eE+-]+)[^\[\]]*\]"), F.lit(1))
    return vertex_mean(F.transform(pairs, lambda p: F.transform(F.split(p, ","), lambda x: F.trim(x).cast("double"))))
