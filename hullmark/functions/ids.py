"""Identifiers made from what a record says."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hullmark.functions.text import norm_listed


def hashed(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha1(key), 1, 12))


def four_places(x: Column) -> Column:
    """Text with four decimals, rounded as the exact binary value demands (ties to even).

    The product with 10^4 is taken with its rounding error (split multiplication), so that a
    value just below a tie is not rounded up.
    """
    a, b = F.abs(x), F.lit(1e4)
    high = a * F.lit(134217729.0) - (a * F.lit(134217729.0) - a)
    p = a * b
    error = (high * b - p) + (a - high) * b
    whole = F.floor(p)
    past = (p - whole - F.lit(0.5)) + error
    n = F.when(past > 0, whole + 1).when(past < 0, whole).otherwise(whole + whole % 2)
    n = n.cast("long")
    return F.concat(F.when(x < 0, F.lit("-")).otherwise(F.lit("")), (F.floor(n / 10000)).cast("string"), F.lit("."), F.lpad((n % 10000).cast("string"), 4, "0"))


def chart_id(kind: Column, lat: Column, lon: Column, name: Column) -> Column:
    return hashed("NOAA-", F.concat_ws("|", kind, four_places(lat), four_places(lon), F.lower(F.trim(F.coalesce(name, F.lit(""))))))


def list_id(article: Column, date: Column, name: Column, flag: Column) -> Column:
    """By article and year if there is an article, else by name, date and flag."""
    d = F.coalesce(date, F.lit(""))
    year = F.regexp_replace(F.substring(d, 1, 5), "-+$", "")
    by_article = F.concat_ws("|", F.lit("a"), F.lower(article), year)
    by_name = F.concat_ws("|", F.lit("n"), norm_listed(name), d, norm_listed(flag))
    return hashed("WPW-", F.when(F.coalesce(article, F.lit("")) != "", by_article).otherwise(by_name))


def suffix_repeats(df: DataFrame, key: str, order: str) -> DataFrame:
    """Second and later rows of one ``key`` get -2, -3, ... in ``order``."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return df.withColumn("_n", n).withColumn(key, F.when(F.col("_n") > 1, F.concat_ws("-", F.col(key), F.col("_n").cast("string"))).otherwise(F.col(key))).drop("_n")
