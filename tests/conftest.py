import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("barstream-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL


@pytest.fixture(scope="session")
def skewed(spark):
    """Bars where one symbol holds most rows, with replicas sharing dates."""
    from pyspark.sql import functions as F

    n = F.col("id")
    hot = spark.range(0, 900).select(F.lit("HOT").alias("symbol"), n)
    cold = spark.range(0, 240).select(F.concat(F.lit("C"), n % 8).alias("symbol"), (n / 8).cast("long").alias("id"))
    rows = hot.unionByName(cold).select(
        "symbol",
        F.date_add(F.lit("2020-01-01").cast("date"), (n - n % 3).cast("int")).alias("timestamp"),
        (n % 3).cast("int").alias("replica"),
        *[(F.pmod(F.xxhash64("symbol", "id", F.lit(c)), F.lit(10_000)) / 100 + 5).alias(c)
          for c in ("Open", "High", "Low", "Close")],
        F.pmod(F.xxhash64("symbol", "id"), F.lit(500)).alias("Volume"),
    )
    rows = rows.persist()
    rows.count()
    return rows


def close_rows(left, right, digits=6):
    """Two DataFrames as sorted lists of rounded rows, for comparison."""
    def rows(df):
        out = []
        for row in df.select(*sorted(left.columns)).collect():
            out.append(tuple(
                (round(v, digits) + 0.0 if v == v else "nan") if isinstance(v, float) else v
                for v in row))
        return sorted(out, key=repr)
    return rows(left), rows(right)


def nearly_equal(left, right, keys, tolerance=1e-6):
    """Row by row comparison by key with a relative tolerance on doubles."""
    a = {tuple(r[k] for k in keys): r for r in left.collect()}
    b = {tuple(r[k] for k in keys): r for r in right.collect()}
    assert a.keys() == b.keys()
    for key, row in a.items():
        for name in left.columns:
            x, y = row[name], b[key][name]
            if isinstance(x, float) and isinstance(y, float):
                assert abs(x - y) <= tolerance * max(1.0, abs(x), abs(y)), (key, name, x, y)
            else:
                assert x == y, (key, name, x, y)
