"""Queries over list rows, list pages and the article log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hullmark.functions.dates import page_month, page_year, parse_date, year_key
from hullmark.functions.depth import column_number, extract_depth, row_depth
from hullmark.functions.ids import list_id
from hullmark.functions.status import LOST, SAVED, classify
from hullmark.functions.text import SHIP_PREFIXES, clean, derived_url, norm_listed, norm_name, normal, safe_name, url_basename
from hullmark.operators.merging import merge_listed
from hullmark.operators.ordering import placed
from hullmark.session import table


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "wikipedia_wrecks")


def _title(url: F.Column) -> F.Column:
    return F.replace(F.regexp_extract(F.coalesce(url, F.lit("")), r"/wiki/([^?#]+)$", 1), F.lit("_"), F.lit(" "))


def list_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir).select("row_no", list_id(_title(F.col("wikipedia_url")), F.col("date"), F.col("name"), F.col("flag")).alias("list_id"))


def list_merge_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_listed(_rows(spark, sf_dir))


def list_sorted_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each row in its year's part of the export: by date (undated last) and name; rows without an address have that of an article of their name."""
    date = F.coalesce(F.nullif("date", F.lit("")), F.lit("9999"))
    rows = _rows(spark, sf_dir).select("row_no", date.alias("sort_date"), F.coalesce("name", F.lit("")).alias("_name"), F.substring(date, 1, 4).alias("_year"), derived_url(F.col("wikipedia_url"), F.col("name")).alias("url"))
    return placed(rows, ["sort_date", "_name", "row_no"], "_year", "place_in_year").select("row_no", "sort_date", "url", "place_in_year")


def norm_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir).select("row_no", norm_name(F.col("name")).alias("norm"), norm_listed(F.col("name")).alias("norm_listed"))


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = F.col("name").rlike(r"^[\x20-\x7E]*$")
    return _rows(spark, sf_dir).where(plain).select("row_no", clean(F.col("name")).alias("cleaned"), safe_name(F.col("name")).alias("file_name"))


def clean_text_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``clean_text`` of every row; its SQL states names of printable ASCII only, this has none."""
    return _rows(spark, sf_dir).select("row_no", clean(normal(F.col("name"), "NFKC")).alias("cleaned"), safe_name(F.col("name")).alias("file_name"))


def classify_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir).select("row_no", classify(F.col("note")).alias("status"))


def status_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir).groupBy(classify(F.col("note")).alias("status")).agg(F.count("*").alias("rows"))


def coverage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = lambda c: F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    return _rows(spark, sf_dir).agg(F.count("*").alias("rows"), filled("name").alias("with_name"), filled("latitude").alias("with_position"), filled("depth_m").alias("with_depth"), filled("wikipedia_url").alias("with_article"))


def partial_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir).select("row_no", parse_date(F.col("date_raw")).alias("parsed"), year_key(F.col("date")).alias("year_key"))


def page_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "list_pages").select("page_id", page_year(F.col("title")).cast("long").alias("year"), page_month(F.col("title")).cast("long").alias("month"))


def context_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed dates with the period of the row's first list as default year and month."""
    title = F.substring_index(F.coalesce("source_lists", F.lit("")), " | ", 1)
    return _rows(spark, sf_dir).select("row_no", parse_date(F.coalesce("date_raw", F.lit("")), page_year(title), page_month(title)).alias("dated"))


def depth_from_note(spark: SparkSession, sf_dir: str) -> DataFrame:
    col = F.coalesce("depth_m", F.lit(""))
    return _rows(spark, sf_dir).select("row_no", extract_depth(F.coalesce("note", F.lit(""))).alias("from_note"), column_number(col).alias("from_column"), row_depth(col, F.coalesce("note", F.lit(""))).alias("depth"))


def url_basenames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir).where("wikipedia_url like 'http%'").select("row_no", url_basename(F.col("wikipedia_url")).alias("basename"))


def list_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per list page, through the joined titles; pages without rows count 0."""
    each = _rows(spark, sf_dir).select("row_no", F.explode(F.split("source_lists", r" \| ")).alias("title")).groupBy("title").agg(F.count_distinct("row_no").alias("n"))
    return table(spark, sf_dir, "list_pages").join(each, "title", "left").select("page_id", "title", F.coalesce("n", F.lit(0)).cast("long").alias("rows"))


def state_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last line of each id."""
    s = table(spark, sf_dir, "article_state")
    last = F.max_by(F.struct("status", "latitude", "longitude", "depth_m", "title"), F.col("line_no"))
    return s.where("id is not null").groupBy("id").agg(F.max("line_no").alias("line_no"), last.alias("s")).select("id", "line_no", "s.status", "s.latitude", "s.longitude", "s.depth_m", "s.title")


def _linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir).where("wikipedia_url like '%/wiki/%'")


def todo_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with an article that were never fetched, or failed last time; missing ones are not tried again."""
    last = state_latest(spark, sf_dir).select("id", "status")
    return _linked(spark, sf_dir).join(last, "id", "left").where("status is null or status = 'error'").select("row_no", "id", "status")


def state_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions and depths the rows lack, from the last good fetch of their article."""
    got = state_latest(spark, sf_dir).where("status = 'ok'").select("id", F.col("latitude").alias("_la"), F.col("longitude").alias("_lo"), F.col("depth_m").alias("_d"))
    rows = _rows(spark, sf_dir).join(got, "id", "left")
    bare = F.col("latitude").isNull() & F.col("_la").isNotNull()
    no_depth = (F.coalesce("depth_m", F.lit("")) == "") & F.col("_d").isNotNull()
    return rows.select(
        "row_no", F.when(bare, F.col("_la")).otherwise(F.col("latitude")).alias("latitude"), F.when(bare, F.col("_lo")).otherwise(F.col("longitude")).alias("longitude"),
        F.when(bare, F.lit("article")).otherwise(F.col("coord_source")).alias("coord_source"), F.when(no_depth, F.col("_d")).alias("filled_depth"),
    )


def fetch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_latest(spark, sf_dir).groupBy("status").agg(F.count("*").alias("ids"), F.count("latitude").alias("with_position"))


QUERIES = {
    f.__name__: f
    for f in (
        list_ids, list_merge_by_id, list_sorted_export, norm_names, clean_text, clean_text_all, classify_notes, status_histogram, coverage_counts, partial_dates, page_period, context_dates, depth_from_note, url_basenames, list_membership,
        state_latest, todo_items, state_backfill, fetch_summary,
    )
}

_FOLD = "regexp_replace(strip_accents(replace(coalesce({0}, ''), chr(160), ' ')), '[^\\x00-\\x7F]', '', 'g')"
_NORM_LISTED = "trim(regexp_replace(lower(" + _FOLD + "), '[^a-z0-9]+', ' ', 'g'))"
_PREFIXES = "|".join(p.replace(".", "\\.") for p in sorted(SHIP_PREFIXES, key=lambda p: (-len(p), p)))
NORM = (
    "regexp_replace(trim(lower(regexp_replace(regexp_replace(trim(regexp_replace(" + _FOLD + ", '\\(.*?\\)', ' ', 'g')), '(?i)^(?:(?:" + _PREFIXES + ")\\.?\\s+)+', ''), '[^a-zA-Z0-9]+', ' ', 'g'))), '^the ', '')"
)
_TITLE = "replace(regexp_extract(coalesce(wikipedia_url, ''), '/wiki/([^?#]+)$', 1), '_', ' ')"


def _at(words: list[str]) -> str:
    """Length of the text ahead of the first of the words, plus 1; 0 if there is none."""
    p = "(?i)^(?s:(.*?))\\b(?:" + "|".join(words) + ")\\b"
    return f"CASE WHEN regexp_matches(coalesce(note, ''), '{p}') THEN length(regexp_extract(note, '{p}', 1)) + 1 ELSE 0 END"


_STATUS = f"(SELECT row_no, CASE WHEN l > 0 AND (s = 0 OR s < l) THEN 'wreck' WHEN s > 0 THEN 'refloated' ELSE 'unknown' END AS status FROM (SELECT row_no, {_at(LOST)} AS l, {_at(SAVED)} AS s FROM wikipedia_wrecks))"
_LATEST = "(SELECT * FROM article_state WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY line_no DESC) = 1)"
_MONTH = "(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"


def _month_no(x: str) -> str:
    return f"list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'], lower(substr({x}, 1, 3)))"


# Typed dates by their words and numbers: day month year, month day comma year, month year, else the first number of three or four digits.
_READ_DATES = """
WITH words AS (
  SELECT row_no, coalesce(date, '') AS d, string_split(coalesce(source_lists, ''), ' | ')[1] AS title, regexp_extract_all(lower(coalesce(date_raw, '')), '[a-z]+|[0-9]+|,') AS w,
    ['jan', 'feb', 'mar', 'apr', 'may', 'jun', 'jul', 'aug', 'sep', 'oct', 'nov', 'dec'] AS months FROM wikipedia_wrecks
), found AS (
  SELECT *, coalesce(list_position(months, w[1][1:3]), 0) AS first, coalesce(list_position(months, w[2][1:3]), 0) AS second, list_filter(w, lambda x: regexp_full_match(x, '[0-9]{3,4}'))[1] AS year FROM words
), read AS (
  SELECT row_no, d, title, months, CASE
    WHEN len(w) = 3 AND second > 0 AND len(w[1]) <= 2 THEN year || '-' || lpad(CAST(second AS VARCHAR), 2, '0') || '-' || lpad(w[1], 2, '0')
    WHEN len(w) = 4 AND first > 0 AND w[3] = ',' THEN year || '-' || lpad(CAST(first AS VARCHAR), 2, '0') || '-' || lpad(w[2], 2, '0')
    WHEN len(w) = 2 AND first > 0 THEN year || '-' || lpad(CAST(first AS VARCHAR), 2, '0')
    WHEN CAST(year AS INTEGER) BETWEEN 100 AND 2100 THEN year END AS said FROM found
)
"""


def _best_depths(texts: str) -> str:
    """``x, depth`` of each text ``x``: its quantities each with what stands before and after them, the best kind first."""
    units = "metres|meters|metre|meter|m|feet|foot|ft|fathoms|fathom|fms|fm"
    amount = rf"'([0-9]+(?:,[0-9]{{3}})*(?:\.[0-9]+)?)(?: ?(?:-|–|to) ?[0-9]+(?:,[0-9]{{3}})*(?:\.[0-9]+)?)? ?-? ?({units})\b'"
    aside = r"^( ?\([^)]{0,30}\))? "
    named = r"'depth of ((about|approximately|around|some|roughly|over|nearly|~|c\.) ?)?$'"
    own = lambda c: f"NOT regexp_matches(right({c}, 25), 'hold|draught|draft')"
    return f"""
WITH cut AS (
  SELECT x, t, regexp_extract_all(t, {amount}) AS f, regexp_extract_all(t, {amount}, 1) AS n, regexp_extract_all(t, {amount}, 2) AS u, string_split_regex(t, {amount}) AS b
  FROM (SELECT x, lower(regexp_replace(x, '[\\s\\p{{Z}}]+', ' ', 'g')) AS t FROM ({texts}))
), each AS (
  SELECT *, array_to_string(list_transform(range(1, i + 1), lambda k: CASE WHEN k > 1 THEN f[k - 1] ELSE '' END || b[k]), '') AS ahead FROM (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM cut)
), told AS (
  SELECT x, i, ahead, substr(t, length(ahead) + length(f[i]) + 1) AS rest, CAST(replace(n[i], ',', '') AS DOUBLE) * CASE WHEN u[i] IN ('feet', 'foot', 'ft') THEN 0.3048 WHEN u[i] LIKE 'f%' THEN 1.8288 ELSE 1 END AS m FROM each
), kinds AS (
  SELECT x, i, m, CASE
    WHEN regexp_matches(rest, '{aside}of (\\w+ )?water') AND {own('ahead')} THEN 1
    WHEN regexp_matches(ahead, {named}) AND NOT regexp_matches(ahead, 'hold depth of|moulded depth of') AND {own(f"regexp_replace(ahead, {named}, '')")} THEN 2
    WHEN regexp_matches(rest, '{aside}(deep|down|below the surface|beneath the surface)') AND {own('ahead')} THEN 3
    WHEN regexp_matches(ahead, '\\bat $') AND regexp_matches(rest, '{aside}depth') AND {own("regexp_replace(ahead, 'at $', '')")} THEN 4 END AS kind
  FROM told WHERE m > 0 AND m < 11000 AND NOT regexp_matches(ahead, '[0-9.,]$')
), best AS (SELECT x, arg_min(round(m, 1), kind * 1000 + i) AS depth FROM kinds WHERE kind IS NOT NULL GROUP BY x)"""


SQL = {
    "list_ids": f"""
SELECT row_no, 'WPW-' || substr(sha1(CASE WHEN {_TITLE} <> '' THEN 'a|' || lower({_TITLE}) || '|' || regexp_replace(substr(coalesce(date, ''), 1, 5), '-+$', '')
  ELSE 'n|' || {_NORM_LISTED.format('name')} || '|' || coalesce(date, '') || '|' || {_NORM_LISTED.format('flag')} END), 1, 12) AS list_id FROM wikipedia_wrecks""",
    "list_merge_by_id": """
WITH r AS (SELECT *, row_no AS o FROM wikipedia_wrecks),
l AS (SELECT id, s, min(o * 1000 + k) AS p FROM (SELECT id, o, unnest(string_split(source_lists, ' | ')) AS s, generate_subscripts(string_split(source_lists, ' | '), 1) AS k FROM r WHERE source_lists <> '') WHERE s <> '' GROUP BY id, s),
ls AS (SELECT id, string_agg(s, ' | ' ORDER BY p) AS source_lists FROM l GROUP BY id)
SELECT r.id, arg_min(name, o) FILTER (name <> '') AS name, arg_min(flag, o) FILTER (flag <> '') AS flag,
  first(date ORDER BY length(date) DESC, o) FILTER (date <> '') AS date, first(date_raw ORDER BY length(date) DESC, o) FILTER (date <> '') AS date_raw,
  arg_min(latitude, o) FILTER (latitude IS NOT NULL) AS latitude, first(longitude ORDER BY o) FILTER (latitude IS NOT NULL) AS longitude, first(coord_source ORDER BY o) FILTER (latitude IS NOT NULL) AS coord_source,
  arg_min(depth_m, o) FILTER (depth_m <> '') AS depth_m, first(depth_source ORDER BY o) FILTER (depth_m <> '') AS depth_source,
  first(note ORDER BY length(note) DESC, o) FILTER (note <> '') AS note, arg_min(wikipedia_url, o) FILTER (wikipedia_url <> '') AS wikipedia_url,
  coalesce(any_value(ls.source_lists), '') AS source_lists, count(*) AS n_rows
FROM r LEFT JOIN ls ON r.id = ls.id GROUP BY r.id""",
    "depth_from_note": _best_depths("SELECT DISTINCT note AS x FROM wikipedia_wrecks WHERE note IS NOT NULL UNION SELECT DISTINCT depth_m || ' deep' FROM wikipedia_wrecks WHERE depth_m IS NOT NULL") + r"""
SELECT row_no, n.depth AS from_note, from_column, coalesce(d.depth, from_column, n.depth) AS depth FROM (
  SELECT row_no, note, depth_m || ' deep' AS col,
    round(TRY_CAST(replace(regexp_extract(coalesce(depth_m, ''), '[0-9.,]+'), ',', '') AS DOUBLE) * CASE WHEN regexp_matches(lower(coalesce(depth_m, '')), '\b(ft|feet|foot)\b') THEN 0.3048 ELSE 1 END, 1) AS from_column
  FROM wikipedia_wrecks) w LEFT JOIN best n ON n.x = w.note LEFT JOIN best d ON d.x = w.col""",
    "partial_dates": _READ_DATES + "SELECT row_no, coalesce(said, '') AS parsed, CASE WHEN starts_with(d, '-') THEN rtrim(substr(d, 1, 5), '-') ELSE substr(d, 1, 4) END AS year_key FROM read",
    "context_dates": _READ_DATES + """
SELECT row_no, coalesce(said, y || CASE WHEN m > 0 THEN '-' || lpad(CAST(m AS VARCHAR), 2, '0') ELSE '' END, '') AS dated FROM (
  SELECT *, list_position(months, lower(regexp_extract(title, '\\bin ([A-Z][a-z]{2})[a-z]* [0-9]{4}', 1))) AS m,
    nullif(coalesce(nullif(regexp_extract(title, '\\bin [A-Z][a-z]+ ([0-9]{4})', 1), ''), regexp_extract(title, '\\bin ([0-9]{3,4})$', 1)), '') AS y FROM read)""",
    "list_sorted_export": """
SELECT row_no, coalesce(nullif(date, ''), '9999') AS sort_date, 
  CASE WHEN coalesce(wikipedia_url, '') <> '' THEN wikipedia_url WHEN coalesce(name, '') <> '' THEN 'https://wiki.example/wiki/' || replace(name, ' ', '_') ELSE '' END AS url,
  row_number() OVER (PARTITION BY substr(coalesce(nullif(date, ''), '9999'), 1, 4) ORDER BY coalesce(nullif(date, ''), '9999'), coalesce(name, ''), row_no) AS place_in_year FROM wikipedia_wrecks""",
    "norm_names": f"SELECT row_no, {NORM.format('name')} AS norm, {_NORM_LISTED.format('name')} AS norm_listed FROM wikipedia_wrecks",
    "clean_text": r"""
SELECT row_no, trim(regexp_replace(regexp_replace(name, '\[(\d+|[a-z]|note \d+|citation needed|nb \d+)\]', '', 'g'), '\s+', ' ', 'g')) AS cleaned,
  CASE WHEN regexp_replace(regexp_replace(name, '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g') = '' THEN 'image' ELSE substr(regexp_replace(regexp_replace(name, '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 150) END AS file_name
FROM wikipedia_wrecks WHERE regexp_full_match(name, '[\x20-\x7E]*')""",
    "classify_notes": f"SELECT row_no, status FROM {_STATUS}",
    "status_histogram": f"SELECT status, count(*) AS rows FROM {_STATUS} GROUP BY status",
    "coverage_counts": """
SELECT count(*) AS rows, count(*) FILTER (name <> '') AS with_name, count(latitude) AS with_position, count(*) FILTER (depth_m <> '') AS with_depth, count(*) FILTER (wikipedia_url <> '') AS with_article FROM wikipedia_wrecks""",
    "page_period": f"""
SELECT page_id, coalesce(TRY_CAST(nullif(regexp_extract(title, '(?i)in ({_MONTH})\\.?\\s+(\\d{{4}})', 2), '') AS BIGINT), TRY_CAST(nullif(regexp_extract(title, 'in (\\d{{3,4}})$', 1), '') AS BIGINT)) AS year,
  CAST({_month_no(f"regexp_extract(title, '(?i)in ({_MONTH})\\.?\\s+(\\d{{4}})', 1)")} AS BIGINT) AS month FROM list_pages""",
    "url_basenames": "SELECT row_no, url_decode(regexp_extract(string_split(wikipedia_url, '?')[1], '([^/]*)$', 1)) AS basename FROM wikipedia_wrecks WHERE wikipedia_url LIKE 'http%'",
    "list_membership": """
WITH e AS (SELECT DISTINCT row_no, unnest(string_split(source_lists, ' | ')) AS title FROM wikipedia_wrecks)
SELECT p.page_id, p.title, count(e.row_no) AS rows FROM list_pages p LEFT JOIN e USING (title) GROUP BY 1, 2""",
    "state_latest": f"SELECT id, line_no, status, latitude, longitude, depth_m, title FROM {_LATEST}",
    "todo_items": f"""
SELECT w.row_no, w.id, s.status FROM wikipedia_wrecks w LEFT JOIN {_LATEST} s USING (id) WHERE w.wikipedia_url LIKE '%/wiki/%' AND (s.status IS NULL OR s.status = 'error')""",
    "state_backfill": f"""
SELECT w.row_no, CASE WHEN w.latitude IS NULL AND s.latitude IS NOT NULL THEN s.latitude ELSE w.latitude END AS latitude,
  CASE WHEN w.latitude IS NULL AND s.latitude IS NOT NULL THEN s.longitude ELSE w.longitude END AS longitude,
  CASE WHEN w.latitude IS NULL AND s.latitude IS NOT NULL THEN 'article' ELSE w.coord_source END AS coord_source,
  CASE WHEN coalesce(w.depth_m, '') = '' THEN s.depth_m END AS filled_depth
FROM wikipedia_wrecks w LEFT JOIN (SELECT * FROM {_LATEST} WHERE status = 'ok') s USING (id)""",
    "fetch_summary": f"SELECT status, count(*) AS ids, count(latitude) AS with_position FROM {_LATEST} GROUP BY status",
}
