import math

import pytest
from pyspark.sql import functions as F

from hullmark.operators.units import depths_in_metres, snap, spread

CASES = [
    ("85", "", 850), ("85 ft", "", 259), ("12 fathoms", "", 219), ("37 feet 11 inches", "", 116), ("135' 6\"", "", 413), ("8½ fathoms", "", 155), ("8 1/2 fathoms", "", 155), ("54 fathoms 3 ft", "", 997),
    ("c. 235 FT", "", 716), ("~5 m", "", 50), ("36 to 48 m", "", 360), ("16 metres (52 feet)", "", 160), ("47,4 m", "", 474), ("1,350 cm", "", 135), ("2,300 m", "", 23000), ("20 yards", "", 183),
    ("133", "Depth given in feet.", 405), ("20", "The depth is in fathoms, as in the log.", 366), ("305", "Soundings are in ft.", 930), ("641", "She lies at 641 ft.", 1954), ("", "Depth: two hundred feet.", 610),
    ("?", "The wreck lies in 26 m of water.", 260), (None, "She rests upright at a depth of about twenty-six metres.", 260), ("0", "Reported missing.", None), ("unknown", "Her draught was 19 feet.", None),
    ("", "She was 321 feet long with a depth of hold of 11 ft.", None), ("", "Moulded depth 6 m.", None), ("", "Torpedoed 41 nautical miles off.", None), ("", "She had 83 fathoms of chain out.", None),
    ("", "Seas of 9 m were running. Divers located the hull 47 m down.", 470), ("", None, None), ("deep water", "x" * 5000, None), ("", "Wreck found in 51-fathoms, listing.", 933), ("", "The light stood 48 m above the sea.", None),
]


def test_depths(spark):
    rows = [(i, c, n, "clash") for i, (c, n, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "row_no long, depth_m string, note string, value string")
    out = depths_in_metres(df, F.lit(None).cast("string"))
    got = {r.row_no: round(r.depth_value_m * 10) for r in out.collect()}
    assert {i: d for i, (_, _, d) in enumerate(CASES) if d is not None} == got


def test_empty(spark):
    assert depths_in_metres(spark.createDataFrame([], "row_no long, depth_m string, note string"), F.lit("e")).count() == 0


def test_scales_come_from_links(spark):
    rows = [(2 * i + k, f"{10 + i} m" if k else f"{round((10 + i) / 0.3048, 1)} ft", "", f"ship{i}") for i in range(12) for k in (0, 1)]
    df = spark.createDataFrame(rows, "row_no long, depth_m string, note string, ship string")
    out = depths_in_metres(df, F.col("ship"))
    assert {r.depth_scale_from for r in out.collect()} == {"linked"}


def test_unknown_words_take_the_scale_of_their_links(spark):
    said = [("{m} m", ""), ("{f} famnar", ""), ("", "She lies in {f} braccia of water."), ("{f}", "The depth is in orgyia.")]
    rows = [(10 * i + k, c.format(m=10 + i, f=round((10 + i) / 1.8288, 2)), n.format(f=round((10 + i) / 1.8288, 2)), f"ship{i}") for i in range(12) for k, (c, n) in enumerate(said)]
    alone = [(900, "10 famnar", "She lies in 7 m of water."), (901, "?", "She lies in 20 braccia of water."), (902, "5", "The depth is in orgyia."), (903, "10 qwert", ""), (904, "10 qwert", "She lies in 7 m of water."), (905, "4", "Depth in doubt.")]
    df = spark.createDataFrame(rows + [(*r, None) for r in alone], "row_no long, depth_m string, note string, ship string")
    got = {r.row_no: (round(r.depth_value_m * 10), r.depth_scale_from) for r in depths_in_metres(df, F.col("ship")).collect()}
    assert [got.get(k) for k in range(900, 906)] == [(183, "linked"), (366, "linked"), (91, "linked"), None, (70, "linked"), (40, "defined")]
    assert all(abs(got[10 * i + k][0] - 10 * (10 + i)) <= 1 for i in range(12) for k in range(4))


def test_snap_and_spread():
    assert snap(math.log(1 / 0.3048) + 0.01) == pytest.approx(math.log(1 / 0.3048))
    assert snap(0.3) is None
    got = spread([("m", "odd", 40, math.log(1 / 1.8288), 0.01), ("odd", "ft", 30, math.log(6), 0.01), ("m", "weak", 2, 0.0, 0.0)], {"m", "odd", "ft", "weak"})
    assert got["odd"] == (pytest.approx(1.8288), 0.0, "linked") and got["ft"] == (0.3048, 0.0, "linked") and "weak" not in got


def test_links_decide_against_a_definition():
    tokens = {"m", "ft", "fathoms", "yards"}
    swapped = [("m", "ft", 40, math.log(1 / 1.8288), 0.01), ("m", "fathoms", 40, math.log(1 / 0.3048), 0.01), ("m", "yards", 8, math.log(1 / 0.3048), 0.01)]
    got = spread(swapped, tokens)
    assert got["ft"] == (1.8288, 0.0, "redefined") and got["fathoms"] == (0.3048, 0.0, "redefined") and got["yards"] == (0.9144, 0.0, "contradicted")
    assert {t: x[2] for t, x in spread([], tokens).items()} == {"m": "linked", "ft": "defined", "fathoms": "defined", "yards": "defined"}


def test_swapped_spellings_and_offsets_come_from_links(spark):
    rows = []
    for i in range(60):
        m = 20 + 3 * i
        rows += [(10 * i, f"{m} m", "", f"s{i}"), (10 * i + 1, f"{round(m / 1.8288, 1)} ft", "", f"s{i}"), (10 * i + 2, f"{m + 12} vadem", "", f"s{i}"), (10 * i + 3, f"{round((m + 12) / 0.3048, 1)} pes", "", f"s{i}")]
    out = depths_in_metres(spark.createDataFrame(rows, "row_no long, depth_m string, note string, ship string"), F.col("ship"))
    got = {r.row_no: r.depth_value_m for r in out.collect()}
    for i in range(60):
        assert got[10 * i + 1] == pytest.approx(20 + 3 * i, abs=0.2)  # "ft" means fathoms here
        assert got[10 * i + 2] == pytest.approx(20 + 3 * i, abs=0.01) and got[10 * i + 3] == pytest.approx(20 + 3 * i, abs=0.3)  # counted from 12 m higher
