"""Queries over all rows, which no SQL states, against brute force."""

import re
import unicodedata
from collections import Counter

import pytest

from hullmark.plans import lists, services
from hullmark.sources.pages import crawl

NAMES = [
    "LANKOAKS\u200bSES", "S.M.S. Nearposgisbën", "\ufeffＦＵＬＬ\u3000width", "e\u0301toile du \u00a0 Nord[note 2]", "ﬁne № 5…", "24½ fathoms", "Ångström & Ærø [3]", "Straße/“Quoted”", "Лев", "Tiếng Việt", "plain  name", "", " ", None, "x" * 200, "__a__",
]


def rows_at(spark, tmp_path, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "wikipedia_wrecks.parquet"))
    return str(tmp_path)


def cleaned(text):
    t = unicodedata.normalize("NFKC", text or "")
    t = re.sub(r"\[(?:\d+|[a-z]|note \d+|citation needed|nb \d+)\]", "", t).replace("\ufeff", "").replace("\u200b", "")
    return re.sub(r"\s+", " ", t).strip()


def file_name(text):
    t = unicodedata.normalize("NFKD", text or "").encode("ascii", "ignore").decode()
    return re.sub(r"[^A-Za-z0-9._-]+", "_", t).strip("_")[:150] or "image"


def test_clean_text_of_all_names(spark, tmp_path):
    at = rows_at(spark, tmp_path, list(enumerate(NAMES)), "row_no long, name string")
    got = {r.row_no: (r.cleaned, r.file_name) for r in lists.QUERIES["clean_text_all"](spark, at).collect()}
    assert got == {i: (cleaned(n), file_name(n)) for i, n in enumerate(NAMES)}


def test_html_rows_of_all_names(spark, tmp_path):
    page = "List of ship losses in May 1900"
    rows = [
        (1, "Étoile <du> Nord", "France", "3 May", "Ran aground & sank.[1]", page), (2, '"Rose" (1890)/[2]', None, None, "She hit a mine;\n all <b>saved</b>.", f"{page} | other"), (3, "A&amp;B", "(Norway)", "4 May", None, page),
        (4, "K\u200bata", "UK", "5 May", "Sank.", page), (5, "Plain", "UK", "5 May", "Sank.", page), (2005, "Plain", "UK", "5 May", "Sank.", page), (6, "Ship", "UK", "5 May", "x", page), (7, "  ", "UK", "5 May", "x", page), (8, None, "UK", "5 May", "x", page),
        (9, "No list", "Åland", "6 May 1901", "Ｌost", ""), (10, "Nor  here", "Åland", "6 May 1901", "Lost", None),
    ]
    at = rows_at(spark, tmp_path, rows, "row_no long, name string, flag string, date_raw string, note string, source_lists string")
    plain = lambda t: " ".join((t or "").split())
    want = Counter(
        (plain(name), plain(flag).strip("() "), plain(date) or ("1900-05" if lists_ else ""), cleaned(note), (lists_ or "").split(" | ")[0])
        for _, name, flag, date, note, lists_ in rows
        if plain(name) and plain(name).lower() not in ("ship", "name", "vessel")
    )
    assert {tuple(r)[:5]: r.n for r in services.QUERIES["html_list_rows_all"](spark, at).collect()} == want


def test_crawl_from_page_0(spark, tmp_path):
    pages = [(i, f"List of ship losses in {1800 + i}") for i in range(20)]
    spark.createDataFrame(pages, "page_id long, title string").write.parquet(str(tmp_path / "list_pages.parquet"))
    got = [r.title for r in services.QUERIES["crawl_bfs_all"](spark, str(tmp_path)).collect()]
    assert sorted(got) == [t for _, t in pages]
    df = services._page_frame(spark, str(tmp_path)).select("title", "html")
    with pytest.raises(RuntimeError):
        crawl(pages[0][1], lambda t: df.join(t, "title"), spark, max_rounds=2)
