import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hullmark.functions import codes, dates, depth, geo, ids, status, text


@pytest.mark.parametrize(("said", "year", "month", "iso"), [
    ("14 May 1918", None, None, "1918-05-14"), ("May 14, 1918", None, None, "1918-05-14"), ("Sept. 3, 1914", None, None, "1914-09-03"), ("May 1918", None, None, "1918-05"),
    ("June", 1850, None, "1850-06"), ("c. 1700", None, None, "1700"), ("300 BC", None, None, "-0300"), ("300 BCE", None, None, "-0300"), ("55 BC", None, None, "-0055"),
    ("31 February 1900", None, None, "1900-02-31"), ("45 May 1900", None, None, "1900-05"), ("5 June", None, None, ""), ("June 5 1942", 1850, None, "1850-06-05"),
    ("5000 tons, 1942", 1900, None, "1900"), ("", 1942, 6, "1942-06"), (None, None, None, ""),
])
def test_parse_date(one, said, year, month, iso):
    make = lambda t: dates.parse_date(t.cast("string"), None if year is None else F.lit(year), None if month is None else F.lit(month))
    assert one(make, said) == iso


@pytest.mark.parametrize(("title", "year", "month"), [("List of ship losses in June 1942", 1942, 6), ("List of ship losses in 1750", 1750, None), ("List of ship losses of Africa", None, None)])
def test_page_period(one, title, year, month):
    assert one(dates.page_year, title) == year
    assert one(dates.page_month, title) == month


@pytest.mark.parametrize(("date", "key"), [("1942-06-01", "1942"), ("-0300-06", "-0300"), ("", ""), (None, "")])
def test_year_key(one, date, key):
    assert one(lambda d: dates.year_key(d.cast("string")), date) == key


@pytest.mark.parametrize(("said", "compat", "metres"), [
    ("in 85 feet (26 m) of water", False, 25.9), ("at a depth of 60 m", False, 60.0), ("12 fathoms deep", False, 21.9), ("lies at 40 m depth", False, 40.0), ("30-40 m deep", False, 30.0),
    ("in 1,200 m of water", False, 1200.0), ("in 1200 m of water", True, 200.0), ("in 1200 m of water", False, 1200.0), ("11,500 m deep", False, None), ("draught 9 feet of water", False, None),
    ("depth of hold 12 feet", False, None), ("", False, None),
])
def test_extract_depth(one, said, compat, metres):
    assert one(lambda t: depth.extract_depth(t, compat), said) == metres


@pytest.mark.parametrize(("said", "metres"), [("85", 85.0), ("85 ft", 25.9), ("85 fathoms", 155.4)])
def test_row_depth(one, said, metres):
    assert one(lambda t: depth.row_depth(t, F.lit("")), said) == metres


@pytest.mark.parametrize(("said", "compat", "degrees"), [("51°30′N", False, 51.5), ("0°30′W", False, -0.5), ("51°30′36″S", True, 51.5), ("51°30′36″S", False, -51.51)])
def test_dms(one, said, compat, degrees):
    assert one(lambda t: geo.dms_degrees(t, compat), said) == pytest.approx(degrees)


def test_dmm(one):
    assert one(geo.dmm_degrees, "58 18.03 N") == pytest.approx(58.3005)
    assert one(geo.dmm_degrees, "1 44.421 W") == pytest.approx(-1.74035)
    assert one(geo.dmm_degrees, "n/a") is None
    assert one(dates.compact_date, "19820226") == "1982-02-26"


def test_distances(one):
    assert one(lambda a, b: geo.dist_m(a, F.lit(0.0), b, F.lit(0.0)), 0.0, 1.0) == pytest.approx(111194.93, abs=0.01)
    assert geo.cell_degrees(100) == pytest.approx(0.0018018, abs=1e-7)


def test_representative_point(one):
    ring = '{"type":"Polygon","coordinates":[[[0,0],[2,0],[2,2],[0,2],[0,0]]]}'
    assert tuple(one(geo.representative_point, ring)) == (1.0, 1.0)
    assert tuple(one(geo.representative_point, '{"type":"Point","coordinates":[-70.5,40.25]}')) == (-70.5, 40.25)
    assert one(lambda g: geo.representative_point(g.cast("string")), None) is None


@pytest.mark.parametrize(("value", "attribute", "compat", "label"), [
    ("2", "CATWRK", False, "dangerous wreck"), ("2.0", "CATWRK", False, "dangerous wreck"), ("2,6", "QUASOU", False, "depth unknown; least depth known"),
    ("wreck showing any portion of h", "CATWRK", False, "wreck showing any portion of hull or superstructure"), ("99", "CATWRK", False, "99"), ("", "CATWRK", False, ""), (None, "CATWRK", False, ""),
    ("Mean low water", "VERDAT", True, "Mean low water springs"), ("Mean low water", "VERDAT", False, "Mean low water"),
    ("least depth unknown, safe clearance at value shown", "QUASOU", True, "least depth unknown, safe clearance at value shown; safe clearance at value shown"),
    ("least depth unknown, safe clearance at value shown", "QUASOU", False, "least depth unknown, safe clearance at value shown"),
])
def test_decode(one, value, attribute, compat, label):
    assert one(lambda v: codes.decode(v.cast("string"), attribute, compat), value) == label


@pytest.mark.parametrize(("name", "norm"), [("HMS Basilisk", "basilisk"), ("SS Foo (1890)", "foo"), ("The Éclair", "eclair"), ("HMS The Foo", "foo"), ("ST Helena", "helena"), (None, "")])
def test_norm_name(one, name, norm):
    assert one(lambda n: text.norm_name(n.cast("string")), name) == norm


def test_other_texts(one):
    assert one(text.norm_listed, "HMS Basilisk") == "hms basilisk"
    assert one(text.clean, " A b[12][note 3] ​ c ") == "A b c"
    assert one(text.url_basename, "https://x.example/a/b%20c.jpg?w=1") == "b c.jpg"
    assert one(text.safe_name, "***") == "image"


def test_ids(one):
    assert one(lambda k, n: ids.chart_id(k, F.lit(40.1235), F.lit(-70.5), n), "wreck", "Basilisk") == "NOAA-47b059e4630d"
    assert one(lambda a: ids.list_id(a, F.lit("1942"), F.lit("x"), F.lit("y")), "HMS Basilisk") == "WPW-85ca0ab109be"
    assert one(lambda a: ids.list_id(a, F.lit("1942-06-01"), F.lit("HMS Basilisk"), F.lit("Royal Navy")), "") == "WPW-ef1082f5237e"


@settings(max_examples=1, deadline=None)
@given(st.lists(st.floats(-180, 180, allow_nan=False), min_size=300, max_size=300))
def test_four_places_round_as_binary(spark, values):
    values += [k / 10000 + 0.00005 for k in range(-300, 300)]
    got = [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double").orderBy("i").select(ids.four_places(F.col("x"))).collect()]
    assert got == [f"{v:.4f}" if v or not math.copysign(1, v) < 0 else "0.0000" for v in values]


@pytest.mark.parametrize(("note", "said"), [
    ("", "unknown"), (None, "unknown"), ("She sank off X.", "wreck"), ("She was refloated.", "refloated"), ("was sunk, later raised and repaired", "refloated"), ("refloated but later sank", "wreck"), ("ran aground", "unknown"),
])
def test_classify(one, note, said):
    assert one(lambda n: status.classify(n.cast("string")), note) == said
