"""Sessions, table access and durable intermediate tables."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "hullmark", memory: str = "8g") -> SparkSession:
    """A local session with the settings the library is tested under."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory (a parquet file or folder)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Where the session names none, a local master (as in tests) gets a folder of its own; on
    a cluster that is an error, as each executor would write to its own disk.
    """
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not place:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        place = "file://" + tempfile.mkdtemp(prefix="hullmark-")
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session may be gone already
        pass


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a cut lineage that outlives executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/hullmark-{os.getpid()}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    back = spark.read.schema(df.schema).parquet(path)
    back._settled_at = path
    _settled.append(back)
    return back


_settled: list[DataFrame] = []


def settled_from(call: Callable[[], DataFrame]) -> DataFrame:
    """``call()`` settled, and the tables that were settled on the way to it removed."""
    begun = len(_settled)
    out = settle(call())
    on_the_way = _settled[begun:-1]
    release(*on_the_way)
    del _settled[begun:]
    _settled.append(out)
    return out


def release(*settled: DataFrame | None) -> None:
    """Remove tables that ``settle`` wrote, once nothing that is still to be computed reads them."""
    for df in settled:
        path = getattr(df, "_settled_at", None)
        if path:
            _remove(df.sparkSession, path)
