"""Places in an order, for exports of any size.

Rows are laid out by ranges of the whole order, so that no task holds more than its range
however large a group is, and each row's place is its range's first place and its own within.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hullmark.session import settle

_ROW_BITS = 33  # of what monotonically_increasing_id gives, the part that counts rows


def placed(df: DataFrame, order: list[str], within: str | None = None, name: str = "place", ranges: int | None = None) -> DataFrame:
    """``df`` with each row's place (from 1) by the columns ``order``, in all or among the rows with its value of ``within``.

    ``within`` must lead the order, or rise with its first column; nulls come first. The driver holds one count per range.
    """
    ranged = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    laid = settle(ranged.sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    at = laid.withColumn("_range", F.shiftright("_id", _ROW_BITS)).withColumn("_row", F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1))
    first, begins = 0, []
    for r in at.groupBy("_range").agg(F.count("*").alias("n")).orderBy("_range").collect():
        begins.append((r["_range"], first))
        first += r["n"]
    begin = F.broadcast(df.sparkSession.createDataFrame(begins, "_range long, _begin long"))  # one row per range
    out = at.join(begin, "_range").withColumn(name, F.col("_begin") + F.col("_row") + 1)
    if within is not None:
        lead = out.groupBy(F.col(within).alias("_w")).agg(F.min(name).alias("_lead"))
        out = out.join(lead, F.col(within).eqNullSafe(F.col("_w"))).withColumn(name, F.col(name) - F.col("_lead") + 1)
    return out.select(*df.columns, F.col(name).cast("long").alias(name))
