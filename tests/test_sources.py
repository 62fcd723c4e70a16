import json

import pytest
from pyspark.sql import functions as F

from hullmark.functions.hydro import hydro_records
from hullmark.operators.ordering import placed
from hullmark.sources import readers, sinks
from hullmark.sources.pages import crawl, grid, list_rows, list_titles, tree
from hullmark.streaming import resume

PAGE = """<div class="mw-parser-output"><h2>1 June</h2><table class="wikitable"><tr><th>Ship</th><th>Country</th><th>Description</th></tr>
<tr><td><a href="/wiki/HMS_Alpha">HMS Alpha</a><sup class="reference">[1]</sup></td><td rowspan="2">(France)</td><td>sank <span class="geo">51.5; -0.5</span></td></tr>
<tr><td>Beta</td><td>sank in 85 feet of water</td></tr><tr><th>Ship</th><th>x</th><th>y</th></tr><tr><td>Ship</td><td>a</td><td>b</td></tr></table><table><tr><td>no</td></tr></table></div>"""


def test_list_rows(spark):
    df = spark.createDataFrame([("List of ship losses in June 1942", PAGE), (None, None), ("x", "")], "title string, html string")
    a, b = list_rows(df).orderBy("name").collect()[::-1]
    assert (a.name, a.flag, a.date, a.latitude, a.longitude, a.coord_source, a.article) == ("HMS Alpha", "France", "1942-06-01", 51.5, -0.5, "list", "HMS Alpha")
    assert (b.name, b.flag, b.depth_m, b.depth_source, b.article) == ("Beta", "France", 25.9, "list", None)


def test_crawl(spark):
    link = lambda *t: "".join(f'<a href="/wiki/{x.replace(" ", "_")}">l</a>' for x in t)
    a, b, c = "List of ship losses in 1", "List of ship losses in 2", "Lists of ship losses of x"
    pages = spark.createDataFrame([(a, link(b, "Other")), (b, link(a, c)), (c, ""), ("lost", link(a))], "title string, html string")
    assert {r.title for r in crawl(a, lambda t: pages.join(t, "title"), spark).collect()} == {a, b, c}
    assert list_titles(link(b, b, "File:X")) == [b]


def test_chart_service(spark, monkeypatch):
    spark.dataSource.register(readers.ChartService)
    spark.conf.set("spark.sql.execution.pyspark.udf.faulthandler.enabled", "false")
    df = spark.read.format("chart_service").option("url", "x").option("transport", "tests.fake_service:ask").option("chunk", 2).load()
    got = readers.chart_records(df).orderBy("latitude").collect()
    assert [(r.name, r.category, r.depth_m, r.bands) for r in got] == [(f"N{i}", "dangerous wreck", 1.5, "harbour") for i in (1, 2, 3)]


def test_chart_answers_are_kept(spark, tmp_path, monkeypatch):
    reader = readers._ChartReader({"transport": "tests.fake_service:ask", "url": "x", "cache": str(tmp_path / "c"), "bands": "harbour"})
    first = [list(reader.read(p)) for p in reader.partitions()]
    monkeypatch.setattr("tests.fake_service.ask", None)
    assert [list(reader.read(p)) for p in reader.partitions()] == first and len(first[0]) == 3


def test_patience():
    waits, calls = [], []

    def call():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return "ok"

    assert readers.patient(call, wait=2, sleep=waits.append) == "ok" and waits == [2, 4]
    with pytest.raises(readers.Refused):
        readers.patient(lambda: (_ for _ in ()).throw(readers.Refused()), sleep=waits.append)


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,note\n1,"A ""x""","two\nlines"\n2,,\n')
    rows = readers.read_rows_csv(spark, str(tmp_path / "a.csv")).orderBy("id").collect()
    assert (rows[0].name, rows[0].note, rows[1].name) == ('A "x"', "two\nlines", "")
    (tmp_path / "s.jsonl").write_text('{"id":"a","status":"error"}\n\n{"id":"a","status":"ok","coords":{"lat":1.0,"lon":2.0}}\n')
    (s,) = readers.read_state_log(spark, str(tmp_path / "s.jsonl")).collect()
    assert (s.status, s.coords.lat) == ("ok", 1.0)
    (tmp_path / "g.json").write_text(json.dumps({"type": "FeatureCollection", "features": [{"geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": {"objnam": "N"}}]}))
    (g,) = readers.read_geojson(spark, str(tmp_path / "g.json")).collect()
    assert g.properties == {"OBJNAM": "N"} and json.loads(g.geometry)["coordinates"] == [1, 2]
    points = spark.createDataFrame([(f"i{k}", None, '{"type":"Point","coordinates":[1,2]}') for k in range(5)], "id string, note string, geometry string").repartition(4)
    sinks.write_geojson(points, str(tmp_path / "out"), per_file=2)
    files = [json.loads(p.read_text()) for p in (tmp_path / "out").rglob("*.txt")]
    assert len(files) == 3 and all(f["type"] == "FeatureCollection" for f in files)
    assert sorted((f["properties"]["id"], f["properties"]["note"]) for x in files for f in x["features"]) == [(f"i{k}", None) for k in range(5)]
    sinks.write_geojson(points.where("id = ''"), str(tmp_path / "none"))
    assert [json.loads(p.read_text())["features"] for p in (tmp_path / "none").rglob("*.txt")] == [[]]


def test_spans_and_headers():
    table = tree('<table><tr><th colspan="2">Ship name</th><th rowspan="2">Nationality</th></tr><tr><td rowspan="3">A</td><td>B</td></tr><tr><td colspan="99999999">wide</td></tr><tr><td>C</td></tr></table>').find("table")[0]
    roles, rows = grid(table)
    assert roles == {"name": 0, "flag": 2}
    assert [(r[0] or r[1]).text() for r in rows] == ["A", "A", "A"] and rows[0][1].text() == "B" and rows[0][2].text() == "Nationality" and rows[1][5000].text() == "wide" and rows[2][1].text() == "C"


def test_charts_and_lists_as_csv(spark, tmp_path):
    records = spark.createDataFrame([("b", "wreck", "N", 1.0), ("a", "wreck", "M", None), ("c", "hulk", "", 2.0)], "id string, kind string, name string, latitude double")
    sinks.write_charts_csv(records, str(tmp_path / "c"))
    lines = [x for p in sorted((tmp_path / "c").glob("*.csv")) for x in p.read_text().splitlines()]
    assert lines[0].split(",") == sinks.CHARTED and [x.split(",")[0] for x in lines if not x.startswith("id,")] == ["c", "a", "b"]
    rows = spark.createDataFrame([("1", "X", "", "HMS A"), ("2", "Y", "https://w/wiki/Y", "Z")], "id string, name string, wikipedia_url string, article string").withColumn("date", F.lit(""))
    sinks.write_list_csv(rows, str(tmp_path / "l"))
    back = {r.id: r.wikipedia_url for r in readers.read_rows_csv(spark, str(tmp_path / "l")).collect()}
    assert back == {"1": "https://wiki.example/wiki/HMS_A", "2": "https://w/wiki/Y"}


def test_features_are_known_by_their_own_ids():
    assert readers._object_id({"properties": {"ObjectId": 7}}) == 7 and readers._object_id({"id": "3"}) == 3 and readers._object_id({}) is None


def test_places_in_an_order(spark):
    rows = [("a" if i % 3 else "b", str(i % 7), i) for i in range(200)] + [(None, "z", 900)]
    df = spark.createDataFrame(rows, "kind string, id string, row_no long")
    got = {r.row_no: r.place for r in placed(df, ["kind", "id", "row_no"], "kind", ranges=5).collect()}
    want = {}
    for kind in ("a", "b", None):
        want |= {r[2]: i + 1 for i, r in enumerate(sorted(x for x in rows if x[0] == kind))}
    assert got == want and placed(df.where("row_no < 0"), ["kind"], ranges=2).count() == 0
    assert [r.place for r in placed(df, ["row_no"]).orderBy("row_no").collect()] == list(range(1, 202))


def test_hydro(spark):
    base = dict(wreck_id="7", name="n/a", flag="GB", date_sunk="19820226", latitude="58 18.03 N", longitude="1 44.421 W", depth="12", water_dept="40", circumstan="torpedoed", type="cargo", cargo="NULL", status="live", wreck_cate="dangerous wreck", obstructio="")
    df = spark.createDataFrame([base, {**base, "wreck_id": "8", "wreck_cate": "", "obstructio": "foul ground"}, {**base, "wreck_id": "9", "status": "dead"}])
    (r,) = hydro_records(df).collect()
    assert (r.id, r.name, r.flag, r.date, r.latitude, r.note) == ("UKHO-7", "Unnamed wreck", "United Kingdom", "1982-02-26", 58.3005, "torpedoed; type: cargo")
    assert hydro_records(df, keep_dead=True).count() == 2
    (r,) = hydro_records(df.withColumn("horizontal", F.lit("wgd  2"))).collect()
    assert r.horizontal_datum == "WGS 84"


def test_resume(spark, tmp_path):
    lines = spark.createDataFrame([(1, "a", "error"), (2, "a", "ok"), (3, "b", "error")], "line_no long, id string, status string")
    full = lines.selectExpr("line_no", "id", "status", "cast(null as double) latitude", "cast(null as double) longitude", "cast(null as double) depth_m", "'' title", "'' error", "timestamp_ntz'2025-01-01 00:00:00' fetched_at")
    full.write.parquet(str(tmp_path / "in"))
    stream = resume.state_stream(spark, str(tmp_path / "in"))
    resume.follow(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "out"))
    rows = spark.createDataFrame([("a", "x/wiki/A"), ("b", "x/wiki/B"), ("c", "x/wiki/C"), ("d", "")], "id string, wikipedia_url string")
    assert {r.id for r in resume.still_to_do(rows, stored).collect()} == {"b", "c"}
    q = resume.latest_stream(stream).writeStream.format("memory").queryName("latest").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.id: r.status for r in spark.table("latest").collect()} == {"a": "ok", "b": "error"}
