import json

import pytest

from hullmark import cli
from hullmark.sources import articles, readers
from tests import fake_wiki


def test_fetch_and_store(spark, tmp_path):
    rows = [("a", "https://w/wiki/HMS_A"), ("b", "https://w/wiki/Gone"), ("c", "https://w/wiki/Broken"), ("d", ""), ("e", "https://w/wiki/Many")]
    got = articles.fetch_articles(spark.createDataFrame(rows, "id string, wikipedia_url string"), "tests.fake_wiki:ask", parallel=2)
    said = {r.id: (r.status, r.depth_m, r.latitude) for r in got.collect()}
    assert said == {"a": ("ok", 60.0, 1.0), "b": ("missing", None, None), "c": ("error", None, None), "e": ("missing", None, None)}
    root = str(tmp_path)
    articles.store_texts(got, lambda: articles.FolderStore(root, "x"))
    assert json.loads((tmp_path / "x/a/metadata.json").read_text())["depth_m"] == 60.0 and not (tmp_path / "x/b").exists()


def test_lists_and_articles_end_to_end(spark, tmp_path, monkeypatch):
    from hullmark.sources import http

    out = tmp_path / "out"
    told = ["all", str(out), "--transport", f"tests.fake_lists:ask?{tmp_path}", "--no-images"]
    args = cli.parser().parse_args(told)
    cli.run_lists(spark, args)
    listed = {r.name: r for r in readers.read_rows_csv(spark, str(out / "wrecks")).collect()}
    assert set(listed) == {"HMS A", "Nameless B"} and listed["HMS A"].wikipedia_url.endswith("/wiki/HMS_A") and listed["HMS A"].date == "1900-05" and listed["Nameless B"].depth_m == "20.0"
    asked = (tmp_path / "asked").read_text().splitlines()
    assert sorted(asked) == ["List of gone", "List of ship losses in 1900", "Lists of ship losses"]
    cli.run_lists(spark, args)  # the pages are taken from the store; what is missing is not asked for again
    assert (tmp_path / "asked").read_text().splitlines() == asked
    cli.run_articles(spark, args)
    filled = {r.name: r for r in readers.read_rows_csv(spark, str(out / "wrecks_filled")).collect()}
    assert (filled["HMS A"].latitude, filled["HMS A"].coord_source, filled["HMS A"].depth_m, filled["Nameless B"].latitude) == ("1.500000", "article", "60.0", "")
    n = len((tmp_path / "asked").read_text().splitlines())
    cli.run_articles(spark, args)  # nothing is left to do
    assert len((tmp_path / "asked").read_text().splitlines()) == n
    assert http.transport("tests.fake_wiki:ask") is fake_wiki.ask


def test_images(spark, tmp_path):
    found = spark.createDataFrame([("w1", "ok", 7), ("w2", "missing", None)], "id string, status string, pageid long")
    images = articles.list_images(found, f"tests.fake_lists:ask?{tmp_path}")
    root = str(tmp_path)
    stored = articles.store_images(images, lambda: articles.FolderStore(root), lambda url: url.encode()).orderBy("place").collect()
    assert [(r.object_name, r.artist, r.license_url, r.key, r.bytes) for r in stored] == [("01_Ship_one.jpg", "Ann B", "https://l", "w1/01_Ship_one.jpg", 11), ("02_Ship_two.jpg", "Ann B", "https://l", "w1/02_Ship_two.jpg", 11)]
    assert (tmp_path / "w1/01_Ship_one.jpg").read_bytes() == b"https://f/1"

    def fails(url):
        raise OSError

    assert [(r.key, r.bytes) for r in articles.store_images(images, lambda: articles.FolderStore(root), fails).collect()] == [(None, None)] * 2


def test_spacing_and_errors(monkeypatch, tmp_path):
    import io
    import urllib.error
    import urllib.request

    from hullmark.sources import http

    spacing, slept = http.Spacing(5.0, "test"), []
    spacing.path = str(tmp_path / "lock")
    for now in (100.0, 102.0):
        spacing.wait(lambda: now, slept.append)  # noqa: B023
    assert slept == [0.0, 3.0]

    def answer(code, headers):
        def open_(request, timeout):
            raise urllib.error.HTTPError(request.full_url, code, "", headers, io.BytesIO())

        return open_

    monkeypatch.setattr(urllib.request, "urlopen", answer(503, {"Retry-After": "7"}))
    with pytest.raises(http.Later) as told:
        http.fetch("http://x", {"a": 1}, spacing=0)
    assert told.value.retry_after == 7
    monkeypatch.setattr(urllib.request, "urlopen", answer(404, {}))
    with pytest.raises(readers.Refused):
        http.fetch("http://x", spacing=0)
    with pytest.raises(http.Later):
        http.fetch("http://x", spacing=0, every_error_passes=True)


def test_paged():
    assert [a["n"] for a in articles.paged(fake_wiki.ask, {"action": "query", "list": "x"})] == [1, 2]


def test_image_names(spark):
    df = spark.createDataFrame([("a", 1, "File:Été 1.JPG"), ("a", 2, "File:***.png"), ("a", 3, "File:b.png")], "id string, place int, file string")
    assert [r.object_name for r in articles.image_names(df, 2).orderBy("place").collect()] == ["01_Ete_1.jpg", "02_image.png"]


def test_cli_dedup(spark, tmp_path):
    head = "id,name,flag,date,latitude,longitude,depth_m,note,wikipedia_url,date_raw,depth_source,coord_source,source_lists\n"
    (tmp_path / "w.csv").write_text(head + "1,HMS A b,F,1900-01-01,,,,sank,,1900-01-01,,,L\n2,A b,,1900-01-01,1.0,2.0,,,,1900-01-01,,list,L\n3,C,,1901,,,,was refloated,,1901,,,L\n")
    cli.run_dedup(spark, str(tmp_path / "w.csv"), str(tmp_path / "out"), 10.0, False)
    lines = next((tmp_path / "out/wrecks_only").glob("*.csv")).read_text().splitlines()
    assert len(lines) == 2 and lines[1].startswith('2,A b,F,1900-01-01,1.000000,2.000000,,sank')
    assert cli.parser().parse_args(["dedup", "a", "b"]).max_km == 10.0
