"""Articles and images of an encyclopedia, fetched in parallel, and stored as objects.

A transport is named as ``module:function``; it takes the parameters of an interface call
and gives the answer as JSON text. A failing item becomes a row with status ``error``, never a
failed job.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator
from pathlib import Path
from urllib.parse import unquote

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from hullmark.functions.depth import extract_depth
from hullmark.functions.text import safe_name
from hullmark.session import settle
from hullmark.sources.http import fetch, transport as transport_of
from hullmark.sources.pages import tree
from hullmark.sources.readers import Refused, patient, usable_images
from hullmark.sources.sinks import metadata_document

SCHEMA = "id string, status string, pageid long, title string, latitude double, longitude double, extract string, html string, error string"


def call(ask: Callable[[dict], str], params: dict, tries: int = 5, wait: float = 5.0, sleep: Callable[[float], None] = time.sleep) -> dict:
    """One call; tried again while the service says that it lags, any other error is final."""
    for turn in range(tries):
        answer = json.loads(patient(lambda: ask({"format": "json", "maxlag": "5", **params}), sleep=sleep))
        code = (answer.get("error") or {}).get("code")
        if code is None:
            return answer
        if code != "maxlag" or turn == tries - 1:
            raise Refused(str(answer["error"]))
        sleep(wait)
    raise AssertionError


def paged(ask: Callable[[dict], str], params: dict) -> Iterator[dict]:
    """Answers of a call that continues, until one names no continuation."""
    more: dict = {}
    while more is not None:
        answer = call(ask, {**params, **more})
        yield answer
        more = answer.get("continue")


def fetch_one(ask: Callable[[dict], str], title: str) -> dict | None:
    """Extract, position and page of an article; None if it is missing or only tells meanings apart."""
    found = call(ask, {"action": "query", "titles": title, "redirects": "1", "prop": "extracts|coordinates|pageprops"}).get("query", {}).get("pages") or [{}]
    page = found[0]
    if not page or page.get("missing") or "disambiguation" in (page.get("pageprops") or {}):
        return None
    html = call(ask, {"action": "parse", "pageid": page.get("pageid"), "prop": "text"})["parse"]["text"]
    spot = (page.get("coordinates") or [{}])[0]
    return {"pageid": page.get("pageid"), "title": page.get("title", title), "latitude": spot.get("lat"), "longitude": spot.get("lon"), "extract": page.get("extract") or "", "html": html}


def _fetch(transport: str, pause: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask, cols = transport_of(transport), [c.split()[0] for c in SCHEMA.split(", ")]
        for pdf in batches:
            rows = []
            for key, url in zip(pdf["id"], pdf["wikipedia_url"], strict=True):
                row = dict.fromkeys(cols) | {"id": key}
                try:
                    got = fetch_one(ask, unquote(url.split("/wiki/", 1)[1]).replace("_", " "))
                    row |= {"status": "ok", **got} if got else {"status": "missing"}
                except Exception as error:
                    row |= {"status": "error", "error": str(error)[:500]}
                rows.append(row)
                time.sleep(pause)
            yield pd.DataFrame(rows, columns=cols).astype({"latitude": "float64", "longitude": "float64", "pageid": "Int64"})

    return run


def fetch_articles(todo: DataFrame, transport: str, parallel: int = 4, pause: float = 0.0) -> DataFrame:
    """State rows of ``todo`` (id, wikipedia_url with an article), at most ``parallel`` tasks at once, with the depth the text tells."""
    rows = todo.select("id", "wikipedia_url").where("wikipedia_url like '%/wiki/%'").repartition(parallel)
    return rows.mapInPandas(_fetch(transport, pause), SCHEMA).withColumn("depth_m", extract_depth(F.col("extract")))


IMAGE = "id string, place int, file string, url string, original_url string, description_url string, mime string, width int, height int, license string, license_url string, artist string, credit string, description string"


def images_of(ask: Callable[[dict], str], pageid: int, width: int) -> Iterator[dict]:
    """The images of a page, as the interface lists them, each with its licence and maker."""
    wanted = {"action": "query", "pageids": pageid, "generator": "images", "gimlimit": "max", "prop": "imageinfo", "iiprop": "url|size|mime|extmetadata", "iiurlwidth": str(width)}
    for answer in paged(ask, wanted):
        for page in answer.get("query", {}).get("pages", []):
            for info in (page.get("imageinfo") or [])[:1]:
                said = {k: tree(str(v["value"])).text() for k, v in (info.get("extmetadata") or {}).items() if isinstance(v, dict) and v.get("value")}
                yield {
                    "file": page["title"], "url": info.get("thumburl") or info.get("url"), "original_url": info.get("url"), "description_url": info.get("descriptionurl"), "mime": info.get("mime"), "width": info.get("width"),
                    "height": info.get("height"), "license": said.get("LicenseShortName"), "license_url": said.get("LicenseUrl"), "artist": said.get("Artist"), "credit": said.get("Credit"), "description": said.get("ImageDescription"),
                }


def list_images(articles: DataFrame, transport: str, width: int = 1600, most: int = 20) -> DataFrame:
    """The first ``most`` usable images of each found article, with the names they are stored under."""
    cols = [c.split()[0] for c in IMAGE.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = transport_of(transport)
        for pdf in batches:
            rows = [{"id": key, "place": i, **image} for key, pageid in zip(pdf["id"], pdf["pageid"], strict=True) for i, image in enumerate(images_of(ask, int(pageid), width))]
            yield pd.DataFrame(rows, columns=cols).astype({"place": "Int32", "width": "Int32", "height": "Int32"})

    found = articles.where("status = 'ok' and pageid is not null").select("id", "pageid").mapInPandas(run, IMAGE)
    return image_names(usable_images(found), most)


def store_images(images: DataFrame, make_store: Callable[[], FolderStore | BucketStore], get: Callable[[str], bytes] = fetch) -> DataFrame:
    """Each image fetched and put beside its article: the images with ``key`` and ``bytes``; both null where the fetch failed."""
    schema = StructType([*images.schema.fields, StructField("key", StringType()), StructField("bytes", LongType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = make_store()
        for pdf in batches:
            keys, sizes = [], []
            for key, name, url in zip(pdf["id"], pdf["object_name"], pdf["url"], strict=True):
                try:
                    data = get(url)
                    store.put(f"{key}/{name}", data)
                    keys.append(f"{key}/{name}")
                    sizes.append(len(data))
                except Exception:
                    keys.append(None)
                    sizes.append(None)
            yield pdf.assign(key=keys, bytes=pd.array(sizes, "Int64"))

    return images.mapInPandas(run, schema)


def cached_pages(titles: DataFrame, transport: str, folder: str, refresh: bool = False) -> DataFrame:
    """``title, html`` of pages by their titles, read from ``folder`` where an earlier call stored them, else fetched and stored.

    Missing pages are stored as such and not asked for again. Pages are keyed by a hash of the title; redirects are followed, the title stays the one asked for.
    """
    spark = titles.sparkSession
    wanted = titles.select("title").where("title is not null").distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = transport_of(transport)
        for pdf in batches:
            rows = []
            for title in pdf["title"]:
                try:
                    told = call(ask, {"action": "parse", "page": title, "prop": "text|revid", "redirects": "1", "disableeditsection": "1"}).get("parse") or {}
                except Refused as error:
                    if "missingtitle" not in str(error):
                        raise
                    told = {}
                rows.append((hashlib.sha1(title.encode()).hexdigest(), title, told.get("text")))
            yield pd.DataFrame(rows, columns=["key", "title", "html"])

    schema = "key string, title string, html string"
    try:
        stored = spark.read.schema(schema).parquet(folder)
        stored.limit(1).count()
    except AnalysisException:  # nothing is stored yet
        stored = spark.createDataFrame([], schema)
    new = wanted if refresh else wanted.join(stored, "title", "left_anti")
    got = settle(new.mapInPandas(run, schema))
    if not got.isEmpty():
        got.write.mode("append").parquet(folder)
    old = stored.join(got, "title", "left_anti").join(wanted, "title", "left_semi") if refresh else stored.join(wanted, "title", "left_semi")
    return settle(old.unionByName(got).where("html is not null").dropDuplicates(["title"]).select("title", "html"))


def image_names(images: DataFrame, most: int = 20) -> DataFrame:
    """``object_name`` for the first ``most`` images (id, place, file) of each article: place, plain stem and ending; a clash gets a number."""
    n = F.row_number().over(Window.partitionBy("id").orderBy("place"))
    stem = safe_name(F.regexp_replace(F.regexp_replace("file", "^[^:]+:", ""), r"\.[^.]*$", ""))
    named = images.withColumn("_n", n).where(F.col("_n") <= most)
    named = named.withColumn("object_name", F.concat(F.lpad(F.col("_n").cast("string"), 2, "0"), F.lit("_"), stem, F.lower(F.regexp_extract("file", r"(\.[^.]*)$", 1))))
    again = F.row_number().over(Window.partitionBy("id", "object_name").orderBy("_n"))
    return named.withColumn("object_name", F.when(again > 1, F.concat_ws("_", "object_name", again.cast("string"))).otherwise(F.col("object_name"))).drop("_n")


class FolderStore:
    """Objects as files under a folder that all executors share."""

    def __init__(self, root: str, prefix: str = ""):
        self.root = Path(root) / prefix

    def put(self, key: str, data: bytes) -> None:
        path = self.root / key
        path.parent.mkdir(parents=True, exist_ok=True)
        part = path.with_name(path.name + ".part")
        part.write_bytes(data)
        part.replace(path)


class BucketStore:
    """Objects in an S3-compatible bucket; needs boto3."""

    def __init__(self, bucket: str, prefix: str = "", **client):
        import boto3

        self.bucket, self.prefix, self.client = bucket, prefix, boto3.client("s3", **client)

    def put(self, key: str, data: bytes) -> None:
        self.client.put_object(Bucket=self.bucket, Key=f"{self.prefix}/{key}".lstrip("/"), Body=data)


def store_texts(articles: DataFrame, make_store: Callable[[], FolderStore | BucketStore], images: DataFrame | None = None) -> None:
    """Text, page and metadata (with the ``images`` stored) of each article that was found, one client per partition."""
    if images is not None:
        each = F.struct(*[c for c in images.columns if c not in ("id", "place")])
        per = images.where("key is not null").groupBy("id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("place", each.alias("image"))))).alias("_images"))
        articles = articles.join(per, "id", "left")
    else:
        articles = articles.withColumn("_images", F.lit(None).cast("string"))

    def run(rows: Iterator) -> None:
        store = make_store()
        for r in rows:
            told = r.asDict()
            pictures = [x["image"] for x in json.loads(told.pop("_images") or "[]")]
            store.put(f"{r['id']}/article.txt", (r["extract"] or "").encode())
            store.put(f"{r['id']}/article.html", (r["html"] or "").encode())
            at = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
            store.put(f"{r['id']}/metadata.json", metadata_document(told, pictures, {"id": r["id"]}, at).encode())

    articles.where("status = 'ok'").foreachPartition(run)
