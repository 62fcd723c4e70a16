"""Queries over pages, extracts and the catalogue of sources, on inputs derived from the tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hullmark.functions.hydro import COUNTRIES, hydro_records
from hullmark.sources.pages import crawl, header_roles, list_rows, page_links
from hullmark.session import table

# Public sources of wreck data; area, and whether they give positions for free download.
CATALOGUE = """
EMODnet worldwide wrecks|world|yes
EMODnet cultural heritage, wrecks|Europe|yes
UKHO wrecks and obstructions|world|yes
Wrecksite|world|no
ShipwreckMap|world|no
Wikidata|world|no
OpenStreetMap and OpenSeaMap|world|no
Wikipedia lists of losses at sea|world|no
Worldwide Shipwreck Database, ShipwreckWorld|world|no
SHOM wrecks and obstructions|France|yes
DRASSM|France|no
Wreck Inventory of Ireland|Ireland|yes
Canmore|Scotland|yes
Historic England protected wrecks|England|no
RBINS wrecks|Belgium|no
Flemish hydrography|Belgium|no
RCE wreck count, MaSS|Netherlands|no
Museovirasto|Finland|no
Fornsok|Sweden|no
Slots- og Kulturstyrelsen|Denmark|no
HELCOM, War Log|Baltic|no
BSH|Germany|no
NOAA wrecks and obstructions|United States|yes
NOAA potentially polluting wrecks|United States|no
BOEM Atlantic shelf|United States|no
Maritime History of the Great Lakes|Great Lakes|no
Northern Maritime Research|Canada|no
Australasian Underwater Cultural Heritage Database|Australia|yes
Western Australian Museum|Australia|no
SAHRIS|South Africa|no
National Shipwreck Database|Sri Lanka|no
OxREP ancient wrecks|Mediterranean|yes
uboat.net|world|no
Pacific Wrecks|Pacific|no
EMODnet dumped munitions|Europe|no
Heritage Victoria submerged aircraft|Australia|no
""".strip().split("\n")


def source_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [(i + 1, *line.split("|")) for i, line in enumerate(CATALOGUE)]
    return spark.createDataFrame(rows, "place int, source string, area string, open_positions string")


def hydro_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers dressed as rows of a hydrographic extract, and mapped."""
    k = F.col("s_suppkey")
    codes = F.array(*[F.lit(c) for c in sorted(COUNTRIES)])
    dressed = table(spark, sf_dir, "supplier").select(
        k.cast("string").alias("wreck_id"), F.when(k % 5 == 0, "NULL").otherwise(F.col("s_name")).alias("name"), F.element_at(codes, (k % len(COUNTRIES) + 1).cast("int")).alias("flag"),
        F.when(k % 4 == 0, "1943").when(k % 4 == 1, "194305").when(k % 4 == 2, "19430517").otherwise("n/a").alias("date_sunk"),
        F.concat((k % 80).cast("string"), F.lit(" "), (k % 60).cast("string"), F.lit(".25 "), F.when(k % 2 == 0, "N").otherwise("S")).alias("latitude"),
        F.concat((k % 170).cast("string"), F.lit(" "), (k % 60).cast("string"), F.lit(".5 "), F.when(k % 3 == 0, "W").otherwise("E")).alias("longitude"),
        (k % 40).cast("string").alias("depth"), (k % 90).cast("string").alias("water_dept"), F.when(k % 2 == 0, "sunk in collision").otherwise("").alias("circumstan"), F.lit("cargo").alias("type"), F.when(k % 3 == 0, "coal").otherwise("n/a").alias("cargo"),
        F.when(k % 7 == 0, "dead").otherwise("live").alias("status"), F.when(k % 6 == 0, "").otherwise("dangerous wreck").alias("wreck_cate"), F.when(k % 6 == 0, "foul ground").otherwise("").alias("obstructio"),
    )
    return hydro_records(dressed)


def _page_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List pages that each link to two others, as HTML."""
    p = table(spark, sf_dir, "list_pages").select("page_id", "title")
    href = lambda t: F.concat(F.lit('<a href="/wiki/'), F.replace(t, F.lit(" "), F.lit("_")), F.lit('#top">x</a>'))
    kids = p.select((F.floor(F.col("page_id") / 2)).alias("page_id"), F.col("title").alias("t")).groupBy("page_id").agg(F.array_join(F.array_sort(F.collect_list(href(F.col("t")))), "\n").alias("links"))
    return p.join(kids, "page_id", "left").select("page_id", "title", F.concat(F.lit('<p><a href="/wiki/File:X">f</a><a class="new" href="/wiki/List_of_what_is_gone">n</a>'), F.coalesce("links", F.lit("")), F.lit("</p>")).alias("html"))


def page_link_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_links(_page_frame(spark, sf_dir))


def _crawled(spark: SparkSession, sf_dir: str, first: int) -> DataFrame:
    pages = _page_frame(spark, sf_dir)
    root = pages.where(F.col("page_id") == first).first()
    if root is None:
        return pages.select("title").where("false")
    return crawl(root["title"], lambda titles: pages.join(F.broadcast(titles) if titles.count() < 10_000 else titles, "title").select("title", "html"), spark).select("title")


def crawl_bfs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _crawled(spark, sf_dir, 2)


def crawl_bfs_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crawl from page 0, which leads to all list pages; the SQL of ``crawl_bfs`` starts at page 2, this has none."""
    return _crawled(spark, sf_dir, 0)


def html_list_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List rows written as tables of pages, one per title, and read back."""
    rows = table(spark, sf_dir, "wikipedia_wrecks").where(F.col("name").rlike("^[A-Za-z][A-Za-z0-9 .-]*[A-Za-z0-9]$") & ~F.lower("name").isin("ship", "name", "vessel") & F.col("flag").rlike("^[A-Za-z][A-Za-z .]*[A-Za-z]$") & ~F.col("flag").contains("  ") & ~F.col("name").contains("  "))
    first = F.substring_index("source_lists", " | ", 1)
    line = F.concat(F.lit('<tr><td><a href="/wiki/A">'), F.col("name"), F.lit("</a></td><td>"), F.col("flag"), F.lit('</td><td>Sank.<sup class="reference">[1]</sup></td></tr>'))
    pages = rows.where("source_lists <> ''").groupBy(first.alias("title")).agg(F.array_join(F.collect_list(line), "").alias("body"))
    html = F.concat(F.lit('<h2>Losses</h2><table class="wikitable"><tr><th>Ship</th><th>Country</th><th>Description</th></tr>'), F.col("body"), F.lit("</table>"))
    return list_rows(pages.select("title", html.alias("html"))).groupBy("name", "flag", "note", "source_lists").agg(F.count("*").alias("n"))


def html_list_rows_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every list row with its flag, date and note written as tables of pages and read back; the SQL of ``html_list_rows`` states plain names only, this has none.

    A cell that is null is written empty; rows whose name is blank or a header word are no ships to the parser.
    """
    cell = lambda c: F.concat(F.lit("<td>"), F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit("</td>"))
    line = F.concat(F.lit("<tr>"), *[cell(F.col(c)) for c in ("name", "flag", "date_raw", "note")], F.lit("</tr>"))
    title = F.substring_index(F.coalesce("source_lists", F.lit("")), " | ", 1)
    # several pages a title, so that none grows with the table
    pages = table(spark, sf_dir, "wikipedia_wrecks").groupBy(title.alias("title"), F.floor(F.col("row_no") / 500_000)).agg(F.array_join(F.collect_list(line), "").alias("body"))
    html = F.concat(F.lit('<h2>Losses</h2><table class="wikitable"><tr><th>Ship</th><th>Country</th><th>Date</th><th>Description</th></tr>'), F.col("body"), F.lit("</table>"))
    return list_rows(pages.select("title", html.alias("html"))).groupBy("name", "flag", "date_raw", "note", "source_lists").agg(F.count("*").alias("n"))


def header_role_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roles of the columns of some header rows."""
    cases = ["Ship|Country|Description", "Date|Ship name|Flag|Coordinates|Depth", "Vessel|Owner|Sunk|Fate|Location", "Name|Nationality|When lost|Remarks", "Wreck|Year|Cause|Notes"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            told = [(line, columns[i], role) for line in pdf["headers"] for columns in [line.split("|")] for role, i in header_roles(columns).items()]
            yield pd.DataFrame(told, columns=["headers", "header", "role"])

    return spark.createDataFrame([(c,) for c in cases], "headers string").mapInPandas(run, "headers string, header string, role string")


QUERIES = {f.__name__: f for f in (source_catalogue, hydro_normalized, page_link_pairs, crawl_bfs, crawl_bfs_all, html_list_rows, html_list_rows_all, header_role_table)}

_CODES = sorted(COUNTRIES)
_PAGES = "p AS (SELECT page_id, title FROM list_pages), k AS (SELECT a.page_id, a.title, b.title AS target, b.page_id AS kid FROM p a JOIN p b ON b.page_id // 2 = a.page_id WHERE regexp_matches(b.title, '(?i)^lists? of '))"

SQL = {
    "source_catalogue": "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join([f"CAST({i + 1} AS INTEGER)", *["'" + x.replace("'", "''") + "'" for x in line.split("|")]]) + ")" for i, line in enumerate(CATALOGUE)) + ") t(place, source, area, open_positions)",
    "hydro_normalized": f"""
SELECT 'UKHO-' || s_suppkey AS id, CASE WHEN s_suppkey % 5 = 0 THEN 'Unnamed wreck' ELSE s_name END AS name, {[COUNTRIES[c] for c in _CODES]!r}[s_suppkey % {len(_CODES)} + 1] AS flag,
  CASE s_suppkey % 4 WHEN 0 THEN '1943' WHEN 1 THEN '1943-05' WHEN 2 THEN '1943-05-17' ELSE '' END AS date,
  round((CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE -1 END) * (s_suppkey % 80 + (s_suppkey % 60 + 0.25::DOUBLE) / 60), 6) AS latitude, round((CASE WHEN s_suppkey % 3 = 0 THEN -1 ELSE 1 END) * (s_suppkey % 170 + (s_suppkey % 60 + 0.5::DOUBLE) / 60), 6) AS longitude,
  CAST(s_suppkey % 40 AS DOUBLE) AS depth_m, CAST(s_suppkey % 90 AS DOUBLE) AS water_depth_m,
  CASE WHEN s_suppkey % 2 = 0 THEN 'sunk in collision; ' ELSE '' END || 'type: cargo' || CASE WHEN s_suppkey % 3 = 0 THEN '; cargo: coal' ELSE '' END AS note, 'ukho' AS coord_source, 'live' AS status
FROM supplier WHERE s_suppkey % 7 <> 0 AND s_suppkey % 6 <> 0""",
    "page_link_pairs": f"WITH {_PAGES} SELECT DISTINCT title, target FROM k",
    "crawl_bfs": f"WITH RECURSIVE {_PAGES}, r AS (SELECT page_id, title FROM p WHERE page_id = 2 UNION SELECT k.kid, k.target FROM r JOIN k ON k.page_id = r.page_id) SELECT title FROM r",
    "html_list_rows": """
SELECT name, flag, 'Sank.' AS note, string_split(source_lists, ' | ')[1] AS source_lists, count(*) AS n FROM wikipedia_wrecks
WHERE regexp_full_match(name, '[A-Za-z][A-Za-z0-9 .-]*[A-Za-z0-9]') AND lower(name) NOT IN ('ship', 'name', 'vessel') AND regexp_full_match(flag, '[A-Za-z][A-Za-z .]*[A-Za-z]') AND NOT contains(flag, '  ') AND NOT contains(name, '  ') AND source_lists <> '' GROUP BY 1, 2, 4""",
    "header_role_table": """
SELECT * FROM (VALUES ('Ship|Country|Description', 'Ship', 'name'), ('Ship|Country|Description', 'Country', 'flag'), ('Ship|Country|Description', 'Description', 'note'),
 ('Date|Ship name|Flag|Coordinates|Depth', 'Date', 'date'), ('Date|Ship name|Flag|Coordinates|Depth', 'Ship name', 'name'), ('Date|Ship name|Flag|Coordinates|Depth', 'Flag', 'flag'), ('Date|Ship name|Flag|Coordinates|Depth', 'Coordinates', 'coords'), ('Date|Ship name|Flag|Coordinates|Depth', 'Depth', 'depth'),
 ('Vessel|Owner|Sunk|Fate|Location', 'Vessel', 'name'), ('Vessel|Owner|Sunk|Fate|Location', 'Owner', 'flag'), ('Vessel|Owner|Sunk|Fate|Location', 'Sunk', 'date'), ('Vessel|Owner|Sunk|Fate|Location', 'Fate', 'note'), ('Vessel|Owner|Sunk|Fate|Location', 'Location', 'coords'),
 ('Name|Nationality|When lost|Remarks', 'Name', 'name'), ('Name|Nationality|When lost|Remarks', 'Nationality', 'flag'), ('Name|Nationality|When lost|Remarks', 'When lost', 'date'), ('Name|Nationality|When lost|Remarks', 'Remarks', 'note'),
 ('Wreck|Year|Cause|Notes', 'Wreck', 'name'), ('Wreck|Year|Cause|Notes', 'Year', 'date'), ('Wreck|Year|Cause|Notes', 'Cause', 'note')) t(headers, header, role)""",
}
