"""Queries for sources, sinks and scans."""

from __future__ import annotations

from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import functions as F

from barstream import schemas as S
from barstream.operators import cleaning, models
from barstream.plans.ingest import run_ingestion
from barstream.plans.training import stored_features
from barstream.queries import blocks as B
from barstream.queries.shape import half_up, shaped, shaped_sql
from barstream.sources import fixtures as X
from barstream.sources import readers, sinks
from barstream.storage import scratch_path

QUERIES, ORACLE = {}, {}

ROW_CAP = 4_321
BAR_SHAPE = "symbol timestamp@ Open High Low Close Volume#"

_RAW_SQL = """raw AS (
  SELECT CAST(l_partkey AS VARCHAR) AS "Ticker", strftime(l_shipdate, '%Y-%m-%d') AS "Date",
    l_extendedprice / l_quantity AS price,
    CASE WHEN l_linenumber = 4 THEN NULL ELSE l_extendedprice / l_quantity END AS close,
    CASE l_linenumber WHEN 7 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '.0'
      WHEN 6 THEN 'n/a' WHEN 5 THEN ' ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' '
      ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS "Volume",
    CASE WHEN l_linenumber IN (6, 7) THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS volume_n
  FROM lineitem)"""


def s1_read_raw(spark, sf):
    path = scratch_path(spark, "raw")
    X.raw_rows(spark, sf).write.option("header", True).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    raw = readers.read_raw(spark, path).withColumn("price", F.col("Open").try_cast("double"))
    return shaped(raw, "Ticker Date price Volume")


ORACLE["s1_read_raw"] = shaped_sql(_RAW_SQL, "raw", "Ticker Date price Volume")


def s2_standardize(spark, sf):
    return shaped(cleaning.standardize(X.raw_rows(spark, sf)), BAR_SHAPE)


ORACLE["s2_standardize"] = shaped_sql(
    _RAW_SQL + """, bars AS (SELECT "Ticker" AS symbol, CAST("Date" AS TIMESTAMP) AS "timestamp",
  price AS "Open", price AS "High", price AS "Low", close AS "Close", volume_n AS "Volume"
  FROM raw)""", "bars", BAR_SHAPE)


def _stored_bars(spark, sf):
    path = scratch_path(spark, "bars")
    sinks.write_bars(X.bars(spark, sf), path)
    return path


def s3_read_bars(spark, sf):
    stored = readers.read_bars(spark, _stored_bars(spark, sf))
    per_symbol = stored.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("bars"), F.sum("Volume").alias("volume"),
        F.max("High").alias("high"), F.min("timestamp").alias("first_day"))
    return shaped(per_symbol, "symbol bars# volume# high first_day@")


ORACLE["s3_read_bars"] = shaped_sql(
    B.BARS + """, per_symbol AS (SELECT symbol, count(*) AS bars, sum("Volume") AS volume,
  max("High") AS high, min("timestamp") AS first_day FROM bars GROUP BY symbol)""",
    "per_symbol", "symbol bars# volume# high first_day@")


def s3_ingest_round_trip(spark, sf):
    """Raw rows with zero-padded tickers through ingestion and back: text symbols, told-apart replicas."""
    raw, target = scratch_path(spark, "raw"), scratch_path(spark, "ingested")
    X.raw_rows(spark, sf).withColumn("Ticker", F.lpad("Ticker", 9, "0")).write.option("header", True).csv(raw)
    run_ingestion(spark, raw, target, multiplier=3, sigma=0.0)
    bars = readers.read_bars(spark, target)
    return shaped(bars.groupBy("symbol", "replica").agg(
        F.count(F.lit(1)).alias("bars"), F.sum("Volume").alias("volume"), F.min("timestamp").alias("first_day")),
        "symbol replica# bars# volume# first_day@")


ORACLE["s3_ingest_round_trip"] = shaped_sql(
    _RAW_SQL + """, bars AS (SELECT lpad("Ticker", 9, '0') AS symbol, replica, count(*) AS bars, sum(volume_n) AS volume,
  min(CAST("Date" AS DATE) + CAST(365 * replica AS INTEGER)) AS first_day
  FROM raw CROSS JOIN (SELECT unnest([1, 2, 3]) AS replica) WHERE close IS NOT NULL AND volume_n IS NOT NULL GROUP BY 1, 2)""",
    "bars", "symbol replica# bars# volume# first_day@")


def s4_row_capped_scan(spark, sf):
    return shaped(readers.first_rows(X.bars(spark, sf), ROW_CAP), BAR_SHAPE)


ORACLE["s4_row_capped_scan"] = shaped_sql(
    B.BARS + f""", capped AS (SELECT * FROM bars ORDER BY symbol, "timestamp" LIMIT {ROW_CAP})""",
    "capped", BAR_SHAPE)


def s5_write_bars(spark, sf):
    stored = readers.read_bars(spark, _stored_bars(spark, sf))
    return shaped(stored, BAR_SHAPE)


ORACLE["s5_write_bars"] = shaped_sql(B.BARS, "bars", BAR_SHAPE)


def s6_list_symbols(spark, sf):
    return readers.list_symbols(X.bars(spark, sf))


ORACLE["s6_list_symbols"] = (
    "SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(100.0 AS DOUBLE) AS base_price "
    "FROM lineitem ORDER BY symbol")

_REPLAY_SHAPE = "day Symbol Open~4 Close~4 Volume#"


def s10_read_replay(spark, sf):
    """Bars written as replay rows with padded symbols, bad numbers and short rows."""
    bars = X.bars(spark, sf)
    path = scratch_path(spark, "replay")
    code = F.concat(F.lit("s"), F.col("symbol"))
    bars.select(
        F.date_format("timestamp", "yyyy-MM-dd").alias("ts"),
        F.when(F.col("Volume") % 2 == 0, F.concat(F.lit(" "), code, F.lit(" "))).otherwise(code)
        .alias("symbol"),
        F.round("Open", 4).cast("string").alias("Open"), F.round("High", 4).alias("High"),
        F.round("Low", 4).alias("Low"),
        F.when(F.col("Volume") % 10 == 3, F.lit("x"))
        .otherwise(F.round("Close", 4).cast("string")).alias("Close"),
        F.when(F.col("Volume") % 10 == 7, F.lit(None)).otherwise(F.col("Volume") + F.lit(0.5))
        .alias("Volume"),
    ).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)
    wanted = spark.read.parquet(f"{sf}/supplier.parquet").filter("s_nationkey < 13").select(
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("symbol"))
    rows = readers.read_replay(spark, path, wanted)
    return shaped(rows.withColumn("day", F.date_format("timestamp", "yyyy-MM-dd")), _REPLAY_SHAPE)


ORACLE["s10_read_replay"] = shaped_sql(
    B.BARS + f""", rows AS (SELECT strftime("timestamp", '%Y-%m-%d') AS day,
  'S' || symbol AS "Symbol", {half_up('"Open"', 4)} AS "Open",
  {half_up('"Close"', 4)} AS "Close", "Volume" FROM bars
  WHERE "Volume" % 10 NOT IN (3, 7)
    AND CAST(symbol AS INTEGER) IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 13))""", "rows", _REPLAY_SHAPE)


def s13_write_runs(spark, sf):
    """Run table written as CSV and read back."""
    from barstream.queries.summaries import runs_table

    path = scratch_path(spark, "runs")
    sinks.write_runs(runs_table(spark, sf), path)
    back = spark.read.option("header", True).csv(
        path, schema="mode string, fraction double, total_time double")
    return shaped(back, "mode fraction~3 total_time~2")


ORACLE["s13_write_runs"] = shaped_sql(
    """runs AS (SELECT CASE WHEN l_linestatus = 'O' THEN 'serial' ELSE 'parallel' END AS mode,
  l_linenumber / 8.0 AS fraction, sum(l_quantity) AS total_time FROM lineitem GROUP BY 1, 2)""",
    "runs", "mode fraction~3 total_time~2")


def s14_model_round_trip(spark, sf):
    """Lasso fitted, stored and loaded with its column list: predictions per symbol and
    how many differ from those of the model before it was stored."""
    features = stored_features(X.bars(spark, sf), max_return=10.0)
    path = scratch_path(spark, "model")
    fitted = models.fit_lasso(features)
    models.save_model(fitted, path, S.LASSO_FEATURES)
    loaded = models.load_model(spark, LinearRegressionModel, path, S.LASSO_FEATURES)
    before = models.predict(fitted, features, S.LASSO_FEATURES).withColumnRenamed(
        "prediction", "before").drop("features")
    both = models.predict(loaded, before, S.LASSO_FEATURES)
    return shaped(both.groupBy("symbol").agg(
        F.count("prediction").alias("predictions"),
        F.count_if(F.col("prediction") != F.col("before")).alias("changed")),
        "symbol predictions# changed#")


ORACLE["s14_model_round_trip"] = shaped_sql(
    B.training(10.0) + """, sums AS (SELECT symbol, count(*) AS predictions, 0 AS changed
  FROM train GROUP BY 1)""", "sums", "symbol predictions# changed#")


QUERIES.update({f.__name__: f for f in (
    s1_read_raw, s2_standardize, s3_read_bars, s3_ingest_round_trip, s4_row_capped_scan, s5_write_bars, s6_list_symbols,
    s10_read_replay, s13_write_runs, s14_model_round_trip)})
