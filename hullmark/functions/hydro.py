"""Extracts of a hydrographic office: 50 text fields mapped to the inventory's columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hullmark.functions.dates import compact_date
from hullmark.functions.geo import dmm_degrees

# ISO codes and the countries they stand for.
COUNTRIES = {"GB": "United Kingdom", "US": "United States", "DE": "Germany", "NO": "Norway", "FR": "France", "NL": "Netherlands", "DK": "Denmark", "SE": "Sweden", "BE": "Belgium", "ES": "Spain", "IT": "Italy", "GR": "Greece", "PA": "Panama", "RU": "Russia", "JP": "Japan", "FI": "Finland", "PL": "Poland", "PT": "Portugal", "IE": "Ireland", "CA": "Canada"}


# Codes of horizontal datums.
DATUMS = {"WGD 2": "WGS 84"}


def horizontal_datum(code: Column) -> Column:
    """The datum a code stands for, whatever the case and blanks; the code itself if it is unknown, '' if there is none."""
    t = F.trim(F.regexp_replace(F.upper(F.coalesce(code, F.lit(""))), r"\s+", " "))
    names = F.create_map(*[F.lit(x) for kv in DATUMS.items() for x in kv])
    return F.coalesce(F.try_element_at(names, t), t)


def told(c: str) -> Column:
    """The text of a field; null for '', NULL and n/a."""
    t = F.trim(F.col(c).cast("string"))
    return F.when(~F.upper(t).isin("", "NULL", "N/A"), t)


def hydro_records(extract: DataFrame, keep_dead: bool = False) -> DataFrame:
    """Wrecks of an extract. Obstructions without a wreck category are none; dead ones are left out unless kept."""
    rows = extract.where(~(told("obstructio").isNotNull() & told("wreck_cate").isNull()))
    if not keep_dead:
        rows = rows.where(F.coalesce(F.lower(told("status")) != "dead", F.lit(True)))
    names = F.create_map(*[F.lit(x) for kv in COUNTRIES.items() for x in kv])
    note = F.concat_ws("; ", told("circumstan"), F.concat(F.lit("type: "), told("type")), F.concat(F.lit("cargo: "), told("cargo")))
    return rows.select(
        F.concat(F.lit("UKHO-"), told("wreck_id")).alias("id"), F.coalesce(told("name"), F.lit("Unnamed wreck")).alias("name"),
        F.coalesce(F.try_element_at(names, F.upper(told("flag"))), told("flag"), F.lit("")).alias("flag"), compact_date(told("date_sunk")).alias("date"),
        dmm_degrees(told("latitude")).alias("latitude"), dmm_degrees(told("longitude")).alias("longitude"), told("depth").try_cast("double").alias("depth_m"), told("water_dept").try_cast("double").alias("water_depth_m"),
        note.alias("note"), F.lit("ukho").alias("coord_source"), F.coalesce(F.lower(told("status")), F.lit("")).alias("status"),
        *([horizontal_datum(told("horizontal")).alias("horizontal_datum")] if "horizontal" in extract.columns else []),
    )
