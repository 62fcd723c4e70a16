"""Queries of the training-data problems and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hullmark.llm.abuse import scored, source_rates, trained
from hullmark.llm.encode import encode
from hullmark.llm.groups import linked_groups
from hullmark.llm.linkage import match
from hullmark.llm.mixing import mix, plain_source, reached_shares
from hullmark.llm.spellings import variant_links
from hullmark.llm.survivors import best_values, is_article, is_depth
from hullmark.session import settle, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_matches(spark, sf_dir).select("noaa_row", "wiki_row")


def p1_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of p1_found with their confidence."""
    pairs = match(table(spark, sf_dir, "noaa_enc_wrecks"), table(spark, sf_dir, "wikipedia_wrecks"))
    return pairs.select(F.col("chart_row").alias("noaa_row"), F.col("list_row").alias("wiki_row"), "confidence")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_survivors(spark, sf_dir).select("group_id", "field_name", "from_id")


def p3_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving values themselves, with the record each is from."""
    rows = table(spark, sf_dir, "dedupe_wrecks")
    grouped = rows.select("id", "wikipedia_url", "depth_m", "depth_source", "loaded_at").join(linked_groups(rows), "id")
    article = F.coalesce((F.col("depth_source") == "article").cast("int"), F.lit(0))
    return best_values(grouped, {
        "wikipedia_url": (is_article(F.col("wikipedia_url")), F.lit(0)),
        "depth_m": (is_depth(F.col("depth_m")), article),
    })


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_links(spark, sf_dir).select("row_a", "row_b")


def p4_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links of p4_found with their confidence."""
    return variant_links(table(spark, sf_dir, "wikipedia_wrecks"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_groups(table(spark, sf_dir, "dedupe_wrecks"))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = encode(docs, count=True, keep=("source",))
    return mix(sized, table(spark, sf_dir, "mix_targets"))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed(spark, sf_dir)


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reached_shares(settle(_mixed(spark, sf_dir)), table(spark, sf_dir, "mix_targets"))


# In the gap between what the model is sure of: at 0.2 and at 0.7 nearly the same documents are told (README).
HARMFUL = 0.3


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, _ = trained(docs, table(spark, sf_dir, "passage_labels"))
    return scored(docs, model)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).where(F.col("score") >= HARMFUL).select("doc_id")


def p9_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir)


def p9_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return source_rates(_scores(spark, sf_dir).join(docs, "doc_id"), plain_source(F.col("source")), HARMFUL)


QUERIES = {
    "p1_found": p1_found, "p1_matches": p1_matches, "p4_found": p4_found, "p4_links": p4_links,
    "p3_found": p3_found, "p3_survivors": p3_survivors, "p6_found": p6_found, "p7_ids": p7_ids, "p8_mix": p8_mix, "p8_shares": p8_shares,
    "p9_found": p9_found, "p9_scores": p9_scores, "p9_rates": p9_rates,
}

_GROUPS = """
WITH RECURSIVE known AS (
  SELECT DISTINCT id, regexp_replace(lower(id), '^[^a-z0-9]+|[^a-z0-9]+$', '', 'g') AS k FROM dedupe_wrecks WHERE id <> ''
), named AS (
  SELECT DISTINCT id, regexp_replace(t, '^[^a-z0-9]+|[^a-z0-9]+$', '', 'g') AS k
  FROM (SELECT id, unnest(regexp_split_to_array(lower(merged_ids), '[\\s,;|/]+')) AS t FROM dedupe_wrecks WHERE merged_ids <> '' AND id IS NOT NULL)
), one AS (SELECT n.id AS a, k.id AS b FROM named n JOIN known k USING (k) WHERE n.id <> k.id),
links AS (SELECT a, b FROM one UNION SELECT b, a FROM one),
reach AS (SELECT a AS id, b AS other FROM links UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a),
grouped AS (SELECT id, least(id, min(other)) AS group_id FROM reach GROUP BY id)
"""

# Usable values with their trust and how many fields of the record are usable; the best one of each group and field.
_FIELDS = _GROUPS + """, usable AS (
  SELECT g.group_id, r.id, r.loaded_at, r.wikipedia_url, r.depth_m, r.depth_source,
    coalesce(regexp_matches(r.wikipedia_url, '^\\s*https?://[^/]+/wiki/[^?#\\s]') AND NOT regexp_matches(lower(r.wikipedia_url), '/wiki/(list_of|lists_of|category:|file:)|[-_]class(_|$)'), false) AS url_ok,
    coalesce(r.depth_m > 0 AND r.depth_m < 11000, false) AS depth_ok
  FROM dedupe_wrecks r JOIN grouped g USING (id)
), fields AS (
  SELECT group_id, id, loaded_at, 'wikipedia_url' AS field_name, 0 AS trust, wikipedia_url AS value, CAST(url_ok AS INTEGER) + CAST(depth_ok AS INTEGER) AS whole FROM usable WHERE url_ok
  UNION ALL
  SELECT group_id, id, loaded_at, 'depth_m', CASE WHEN depth_source = 'article' THEN 1 ELSE 0 END, CAST(depth_m AS VARCHAR), CAST(url_ok AS INTEGER) + CAST(depth_ok AS INTEGER) FROM usable WHERE depth_ok
), survivors AS (
  SELECT group_id, field_name, id AS from_id, value FROM fields
  QUALIFY row_number() OVER (PARTITION BY group_id, field_name ORDER BY trust DESC, loaded_at DESC NULLS LAST, whole DESC, id, value) = 1
)
"""

SQL = {
    "p6_found": _GROUPS + "SELECT id, group_id FROM grouped",
    "p3_found": _FIELDS + "SELECT group_id, field_name, from_id FROM survivors",
    "p3_survivors": _FIELDS + "SELECT group_id, field_name, from_id, value FROM survivors",
}
