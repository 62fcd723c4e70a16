"""The article log as a stream: what is done, and what is still to do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SCHEMA = "line_no long, id string, status string, latitude double, longitude double, depth_m double, title string, error string, fetched_at timestamp_ntz"


def state_stream(spark: SparkSession, folder: str, files_per_trigger: int = 10) -> DataFrame:
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def latest_stream(lines: DataFrame) -> DataFrame:
    """The last line of each id so far; state holds one line per id."""
    last = F.max_by(F.struct("status", "latitude", "longitude", "depth_m", "title"), F.col("line_no"))
    return lines.where("id is not null").groupBy("id").agg(F.max("line_no").alias("line_no"), last.alias("s")).select("id", "line_no", "s.*")


def hourly_stream(lines: DataFrame, late: str = "6 hours") -> DataFrame:
    """Lines and errors per hour of fetching, closed once ``late`` has passed."""
    at = lines.withColumn("at", F.col("fetched_at").cast("timestamp")).withWatermark("at", late)
    return at.groupBy(F.window("at", "1 hour")).agg(F.count("*").alias("lines"), F.count_if(F.col("status") == "error").alias("errors")).select("window.start", "lines", "errors")


def follow(lines: DataFrame, table_path: str, checkpoint: str) -> StreamingQuery:
    """Append each batch to a table, each line once: a batch that comes again overwrites its own folder."""

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table_path}/batch={number}")

    return lines.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def still_to_do(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows with an article that were never fetched, or failed last time."""
    last = stored.where("id is not null").groupBy("id").agg(F.max_by("status", "line_no").alias("_status"))
    return rows.where("wikipedia_url like '%/wiki/%'").join(last, "id", "left").where("_status is null or _status = 'error'").drop("_status")
