"""Queries that find, merge and report duplicates among list rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hullmark.functions.text import norm_name
from hullmark.operators.linking import by_article, by_day, by_month, by_place, groups, keyed, ranked, rule_merges
from hullmark.operators.merging import merge_groups
from hullmark.plans.lists import NORM
from hullmark.session import table


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(table(spark, sf_dir, "wikipedia_wrecks"))


def dedup_edges_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_article(_keyed(spark, sf_dir))


def dedup_edges_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_day(_keyed(spark, sf_dir))


def dedup_edges_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_month(_keyed(spark, sf_dir))


def dedup_edges_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_place(_keyed(spark, sf_dir))


def dedup_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(_keyed(spark, sf_dir))


def dedup_rule_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_merges(_keyed(spark, sf_dir))


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "wikipedia_wrecks").withColumn("idx", F.col("row_no"))
    return ranked(rows.join(dedup_components(spark, sf_dir), "idx"))


def dedup_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(spark, sf_dir).select("row_no", "root", F.col("_rank").cast("long").alias("place"))


def dedup_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_groups(_ranked(spark, sf_dir))


def dedup_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is probably a wreck: everything but the refloated."""
    return dedup_merged(spark, sf_dir).where(F.col("status").isin("wreck", "unknown")).select("root", "id", "status", "n_merged")


def dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_merged(spark, sf_dir).groupBy("status").agg(F.count("*").alias("groups"), F.sum("n_merged").alias("rows"))


def top_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 names most frequent among what is kept; equal counts by name."""
    kept = dedup_merged(spark, sf_dir).where("status <> 'refloated'")
    return kept.groupBy(norm_name(F.col("name")).alias("norm")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "norm").limit(25)


QUERIES = {f.__name__: f for f in (dedup_edges_url, dedup_edges_day, dedup_edges_month, dedup_edges_geo, dedup_components, dedup_rule_stats, dedup_rank, dedup_merged, dedup_only, dedup_report, top_names)}

_ROWS = f"""r AS (
  SELECT row_no AS idx, coalesce(id, '') AS id, coalesce(wikipedia_url, '') AS url, coalesce(date, '') AS date, {NORM.format('name')} AS norm,
    CASE WHEN date LIKE '-%' THEN regexp_replace(substr(date, 1, 5), '-+$', '') ELSE substr(coalesce(date, ''), 1, 4) END AS year, latitude AS lat, longitude AS lon FROM wikipedia_wrecks)"""


def _star(key: str, when: str) -> str:
    return f"SELECT a, idx AS b FROM (SELECT idx, min(idx) OVER (PARTITION BY {key}) AS a FROM r WHERE {when}) WHERE idx <> a"


_E_ID, _E_URL, _E_DAY = _star("id", "id <> ''"), _star("lower(url)", "url <> ''"), _star("norm, date", "norm <> '' AND length(date) >= 10")
_E_MONTH = """SELECT a, idx AS b FROM (SELECT idx, min(idx) OVER w AS a, max(CASE WHEN length(date) = 7 THEN 1 ELSE 0 END) OVER w AS partial,
  min(CASE WHEN length(date) >= 10 THEN date END) OVER w AS lo, max(CASE WHEN length(date) >= 10 THEN date END) OVER w AS hi
  FROM r WHERE norm <> '' AND length(date) >= 7 WINDOW w AS (PARTITION BY norm, substr(date, 1, 7))) WHERE idx <> a AND partial = 1 AND (lo IS NULL OR lo = hi)"""
_E_GEO = """SELECT p.idx AS a, q.idx AS b FROM r p JOIN r q ON p.norm = q.norm AND p.year = q.year AND p.idx < q.idx
  WHERE p.norm <> '' AND p.year <> '' AND 2 * 6371 * asin(sqrt(least(1, pow(sin(radians(q.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(q.lat)) * pow(sin(radians(q.lon - p.lon) / 2), 2)))) <= 10"""
_ALL = [_E_ID, _E_URL, _E_DAY, _E_MONTH, _E_GEO]


def _groups_cte(n: int, tag: str) -> str:
    edges = " UNION ".join(f"({e})" for e in _ALL[:n])
    return f"""e{tag} AS ({edges}), l{tag} AS (SELECT a, b FROM e{tag} UNION SELECT b, a FROM e{tag}),
w{tag}(idx, other) AS (SELECT idx, idx FROM r UNION SELECT w.idx, l.b FROM w{tag} w JOIN l{tag} l ON w.other = l.a),
g{tag} AS (SELECT idx, min(other) AS root FROM w{tag} GROUP BY idx)"""


_RANKED = """k AS (SELECT w.*, g5.root, row_number() OVER (PARTITION BY g5.root ORDER BY (coalesce(wikipedia_url, '') <> '') DESC, (latitude IS NOT NULL) DESC, (coalesce(depth_m, '') <> '') DESC,
  length(coalesce(date, '')) DESC, length(coalesce(note, '')) DESC, row_no) AS place FROM wikipedia_wrecks w JOIN g5 ON g5.idx = w.row_no)"""
_HEAD = f"WITH RECURSIVE {_ROWS}, {_groups_cte(5, '5')}"


def _merged_sql() -> str:
    from hullmark.plans.lists import _STATUS

    return f"""{_HEAD}, {_RANKED}, st AS {_STATUS}, x AS (SELECT k.*, st.status AS s FROM k JOIN st USING (row_no)),
parts AS (SELECT root, part, min(place * 1000 + j) AS p FROM (SELECT root, place, unnest(string_split(source_lists, ' | ')) AS part, generate_subscripts(string_split(source_lists, ' | '), 1) AS j FROM x WHERE source_lists <> '') WHERE part <> '' GROUP BY 1, 2),
src AS (SELECT root, string_agg(part, ' | ' ORDER BY p) AS source_lists FROM parts GROUP BY root),
loss AS (SELECT root, date AS ld, coalesce(date_raw, '') AS lraw, coalesce(note, '') AS ln FROM x WHERE s = 'wreck' AND coalesce(date, '') <> '' QUALIFY row_number() OVER (PARTITION BY root ORDER BY date DESC, place) = 1),
m AS (SELECT root, arg_min(id, place) AS id, first(name ORDER BY place) AS name, first(coalesce(note, '') ORDER BY place) AS note0,
  coalesce(arg_min(flag, place) FILTER (flag <> ''), '') AS flag, arg_min(date, place) FILTER (date <> '') AS date0, arg_min(date_raw, place) FILTER (date_raw <> '') AS raw0,
  first(latitude ORDER BY place) FILTER (latitude IS NOT NULL) AS latitude, first(longitude ORDER BY place) FILTER (latitude IS NOT NULL) AS longitude, first(coord_source ORDER BY place) FILTER (latitude IS NOT NULL) AS coord_source,
  first(depth_m ORDER BY place) FILTER (depth_m <> '') AS depth_m, first(depth_source ORDER BY place) FILTER (depth_m <> '') AS depth_source,
  coalesce(arg_min(wikipedia_url, place) FILTER (wikipedia_url <> ''), '') AS wikipedia_url,
  CASE WHEN bool_or(s = 'wreck') THEN 'wreck' WHEN bool_or(s = 'refloated') THEN 'refloated' ELSE 'unknown' END AS status, count(*) AS n_merged,
  coalesce(string_agg(id, ' ' ORDER BY place) FILTER (place > 1), '') AS merged_ids FROM x GROUP BY root),
merged AS (SELECT m.root, m.id, m.name, m.flag, coalesce(ld, date0, '') AS date, coalesce(lraw, raw0, '') AS date_raw, latitude, longitude, coord_source, depth_m, depth_source,
  coalesce(nullif(ln, ''), note0) AS note, wikipedia_url, coalesce(source_lists, '') AS source_lists, status, n_merged, merged_ids
  FROM m LEFT JOIN loss USING (root) LEFT JOIN src USING (root))"""


_MERGED = _merged_sql()

SQL = {
    "dedup_edges_url": f"WITH {_ROWS} {_E_URL}",
    "dedup_edges_day": f"WITH {_ROWS} {_E_DAY}",
    "dedup_edges_month": f"WITH {_ROWS} {_E_MONTH}",
    "dedup_edges_geo": f"WITH {_ROWS} {_E_GEO}",
    "dedup_components": f"{_HEAD} SELECT idx, root FROM g5",
    "dedup_rule_stats": "WITH RECURSIVE " + _ROWS + ", " + ", ".join(_groups_cte(i, str(i)) for i in range(1, 6)) + ", c(i, n) AS (SELECT 0, count(*) FROM r " + " ".join(f"UNION ALL SELECT {i}, count(DISTINCT root) FROM g{i}" for i in range(1, 6)) + """)
SELECT ['same id', 'same article', 'same name and day', 'same name and month', 'same name and year, near'][b.i] AS rule, CAST(a.n - b.n AS BIGINT) AS merges FROM c a JOIN c b ON b.i = a.i + 1""",
    "dedup_rank": f"{_HEAD}, {_RANKED} SELECT row_no, root, place FROM k",
    "dedup_merged": f"{_MERGED} SELECT * FROM merged",
    "dedup_only": f"{_MERGED} SELECT root, id, status, n_merged FROM merged WHERE status <> 'refloated'",
    "dedup_report": f"{_MERGED} SELECT status, count(*) AS groups, CAST(sum(n_merged) AS BIGINT) AS rows FROM merged GROUP BY status",
    "top_names": f"{_MERGED} SELECT {NORM.format('name')} AS norm, count(*) AS n FROM merged WHERE status <> 'refloated' GROUP BY 1 ORDER BY n DESC, norm LIMIT 25",
}
