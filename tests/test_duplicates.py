import numpy as np
from pyspark.sql import functions as F

from hullmark.operators.clusters import greedy_clusters
from hullmark.operators.linking import groups, keyed, ranked, rule_merges, smallest_labels
from hullmark.operators.merging import merge_clusters, merge_groups, merge_listed

SCHEMA = "row_no long, id string, name string, flag string, date string, date_raw string, wikipedia_url string, latitude double, longitude double, coord_source string, depth_m string, depth_source string, note string, source_lists string"


def row(i, name, date, url="", lat=None, lon=None, note="", **more):
    base = dict(row_no=i, id=str(i), name=name, flag="", date=date, date_raw=date, wikipedia_url=url, latitude=lat, longitude=lon, coord_source="list" if lat else "", depth_m="", depth_source="", note=note, source_lists="")
    return {**base, **more}


ROWS = [
    row(0, "HMS Alpha", "1942-06-01", "u1", note="sank"), row(1, "Alpha", "1942-06-01", lat=10.0, lon=20.0), row(2, "Alpha", "1942-06"), row(3, "Beta", "1850-03-02", lat=50.0, lon=-1.0, note="refloated"),
    row(4, "Beta", "1850-09-09", lat=50.05, lon=-1.0, note="wrecked"), row(5, "Gamma", "1900"), row(6, "Gamma", "1900"),
]


def test_end_to_end(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    roots = groups(keyed(df))
    assert [r.root for r in roots.orderBy("idx").collect()] == [0, 0, 0, 3, 3, 5, 6]
    assert [r.merges for r in rule_merges(keyed(df)).collect()] == [0, 0, 1, 1, 1]
    out = {r.root: r for r in merge_groups(ranked(df.withColumn("idx", F.col("row_no")).join(roots, "idx"))).collect()}
    assert (out[3].date, out[3].note, out[3].status, out[3].n_merged, out[3].merged_ids) == ("1850-09-09", "wrecked", "wreck", 2, "4")
    assert (out[0].name, out[0].date, out[0].latitude, out[0].merged_ids, out[0].status) == ("HMS Alpha", "1942-06-01", 10.0, "1 2", "wreck")
    assert out[5].status == "unknown"


def test_labels_against_brute_force(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 460)]
    label = {i: i for i in range(500)}
    for _ in range(500):
        moved = False
        for a, b in edges:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
        if not moved:
            break
    got = smallest_labels(spark.range(500).select(F.col("id").alias("idx")), spark.createDataFrame(edges, "a long, b long"))
    assert {r.idx: r.root for r in got.collect()} == label


def test_merge_by_id(spark):
    rows = [row(1, "A", "1900", id="x", note="ab", source_lists="L1 | L2"), row(2, "B", "1900-05", id="x", note="cd", lat=1.0, lon=2.0, source_lists="L2 | L3"), row(3, "", "", id="x", note="longer", flag="F", depth_m="7", depth_source="list")]
    (r,) = merge_listed(spark.createDataFrame(rows, SCHEMA)).collect()
    assert (r.name, r.date, r.latitude, r.note, r.source_lists, r.flag, r.depth_m, r.n_rows) == ("A", "1900-05", 1.0, "longer", "L1 | L2 | L3", "F", "7", 3)


def test_chart_clusters(spark):
    made = [(1, "wreck", "", 40.0, -70.0, "harbour"), (2, "wreck", "ALPHA", 40.0004, -70.0, "approach"), (3, "wreck", "BETA", 39.9996, -70.0, "coastal"), (4, "hulk", "", 40.0, -70.0, "harbour"), (5, "wreck", None, None, None, "harbour")]
    cols = ["depth_m", "note", "category", "water_level", "depth_quality", "depth_technique", "depth_exposition", "vertical_datum", "height_m", "source_date", "source_ind", "enc_cell", "depth_source", "coord_source", "geometry_type"]
    df = spark.createDataFrame(made, "row_no long, kind string, name string, latitude double, longitude double, bands string").select("*", F.concat(F.lit("id"), "row_no").alias("id"), *[F.lit("").alias(c) for c in cols])
    kept = greedy_clusters(df)
    assert {r.row_no: r.keeper for r in kept.collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    one = {r.keeper: r for r in merge_clusters(df.join(kept, "row_no")).collect()}[1]
    assert (one.id, one.name, one.bands, one.latitude, one.n_features) == ("id1", "ALPHA", "harbour,approach", 40.0, 2)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert groups(keyed(df)).count() == 0 and merge_listed(df).count() == 0
