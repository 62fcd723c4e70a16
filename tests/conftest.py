import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from hullmark.session import local_session

    s = local_session(4, memory="4g")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture
def one(spark):
    """The value of a column expression over literals."""
    from pyspark.sql import functions as F

    def value(make, *args):
        row = spark.range(1).select(*[F.lit(a).alias(f"a{i}") for i, a in enumerate(args)])
        return row.select(make(*[F.col(f"a{i}") for i in range(len(args))]).alias("v")).first()["v"]

    return value
