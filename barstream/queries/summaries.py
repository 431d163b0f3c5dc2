"""Queries for grouped summaries and run tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from barstream.operators import aggregates, metrics
from barstream.operators.features import train_features
from barstream.queries import blocks as B
from barstream.queries.shape import shaped, shaped_sql
from barstream.sources import fixtures as X

QUERIES, ORACLE = {}, {}

_A1 = "batch symbol Open~6 High~6 Low~6 Close~6 Volume~6 volatility~6"


def a1_batch_bars(spark, sf):
    """Ticks of every hour, bars per event type."""
    hourly = aggregates.batch_bars(
        X.ticks(spark, sf), F.floor(F.unix_seconds("timestamp") / 3600).alias("batch"))
    return shaped(hourly, _A1)


ORACLE["a1_batch_bars"] = shaped_sql(
    """ticks AS (SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) AS batch, event_type AS symbol,
  value, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
bars AS (SELECT batch, symbol, avg(value) AS "Open", avg(value) AS "High", avg(value) AS "Low",
  avg(value) AS "Close", avg(k) AS "Volume",
  coalesce(nullif(stddev_samp(value), 0), 1.0) AS volatility FROM ticks GROUP BY 1, 2)""",
    "bars", _A1)


def a2_avg_volume(spark, sf):
    """Over text volumes, some of which are not whole numbers and are skipped."""
    return shaped(aggregates.avg_volume(X.raw_rows(spark, sf)), "symbol avg_volume~2")


_AVG = """vols AS (SELECT CAST(l_partkey AS VARCHAR) AS symbol, round(avg(l_quantity), 2) AS avg_volume
  FROM lineitem WHERE l_linenumber NOT IN (6, 7) GROUP BY 1)"""
ORACLE["a2_avg_volume"] = shaped_sql(_AVG, "vols", "symbol avg_volume~2")


def a3_avg_volume_preview(spark, sf):
    return shaped(aggregates.avg_volume_preview(X.raw_rows(spark, sf)), "symbol avg_volume~2")


ORACLE["a3_avg_volume_preview"] = shaped_sql(
    _AVG, "vols", "symbol avg_volume~2", "ORDER BY symbol LIMIT 5")


def a5_row_counts(spark, sf):
    features = train_features(X.bars(spark, sf), max_return=10.0)
    return shaped(aggregates.row_counts(features), "feature_rows# train_rows# test_rows#")


ORACLE["a5_row_counts"] = shaped_sql(
    B.training(10.0) + """, counts AS (SELECT count(*) AS feature_rows,
  count(*) FILTER ("Split_Rank" < 0.8) AS train_rows,
  count(*) FILTER ("Split_Rank" >= 0.8) AS test_rows FROM train)""",
    "counts", "feature_rows# train_rows# test_rows#")


def a13_group_sizes(spark, sf):
    return shaped(aggregates.group_sizes(X.bars(spark, sf)), "symbol group_size#")


ORACLE["a13_group_sizes"] = shaped_sql(
    B.BARS + ", sizes AS (SELECT symbol, count(*) AS group_size FROM bars GROUP BY symbol)",
    "sizes", "symbol group_size#")


def a14_throughput(spark, sf):
    return shaped(aggregates.batch_throughput(X.bars(spark, sf)), "timestamp@ throughput#")


ORACLE["a14_throughput"] = shaped_sql(
    B.BARS + ', load AS (SELECT "timestamp", count(*) AS throughput FROM bars GROUP BY 1)',
    "load", "timestamp@ throughput#")


def f5_choose_fraction(spark, sf):
    features = train_features(X.bars(spark, sf), max_return=10.0)
    guard = aggregates.choose_fraction(features, 14, limit_gb=0.01)
    return shaped(guard, "estimated_gb~8 fraction~2")


ORACLE["f5_choose_fraction"] = shaped_sql(
    B.training(10.0) + """, size AS (SELECT count(*) * 14 * 8 / 1073741824.0 * 2.5 AS estimated_gb
  FROM train), guard AS (SELECT *, CASE WHEN estimated_gb < 0.01 THEN 1.0 ELSE 0.75 END AS fraction
  FROM size)""", "guard", "estimated_gb~8 fraction~2")


def runs_table(spark, sf):
    """A run table from line items: status as mode, line number as share."""
    mode = F.when(F.col("l_linestatus") == "O", "serial").otherwise("parallel").alias("mode")
    return X.table(spark, sf, "lineitem").groupBy(
        mode, (F.col("l_linenumber") / 8.0).alias("fraction")
    ).agg(F.sum("l_quantity").alias("total_time"))


_J6 = "fraction~3 serial_time_s~2 parallel_time_s~2 speedup_x~6 efficiency~6 num_cores#"


def j6_pair_runs(spark, sf):
    return shaped(metrics.pair_runs(runs_table(spark, sf), 8), _J6)


ORACLE["j6_pair_runs"] = shaped_sql(
    """runs AS (SELECT l_linestatus AS mode, l_linenumber / 8.0 AS fraction,
  sum(l_quantity) AS total_time FROM lineitem GROUP BY 1, 2),
pairs AS (SELECT s.fraction, s.total_time AS serial_time_s, p.total_time AS parallel_time_s,
  s.total_time / p.total_time AS speedup_x, s.total_time / p.total_time / 8 AS efficiency,
  8 AS num_cores FROM runs s JOIN runs p ON s.fraction = p.fraction
  WHERE s.mode = 'O' AND p.mode <> 'O')""", "pairs", _J6)


def a12_core_scaling(spark, sf):
    runs = X.table(spark, sf, "lineitem").groupBy(
        F.col("l_suppkey").alias("suite"), F.col("l_linenumber").alias("cores")
    ).agg(F.sum("l_quantity").alias("time_s"))
    return shaped(metrics.core_scaling(runs), "suite# cores# time_s~2 speedup~6 efficiency~6")


ORACLE["a12_core_scaling"] = shaped_sql(
    """runs AS (SELECT l_suppkey AS suite, l_linenumber AS cores, sum(l_quantity) AS time_s
  FROM lineitem GROUP BY 1, 2),
scaling AS (SELECT *, first_value(time_s) OVER (PARTITION BY suite ORDER BY cores) / time_s AS speedup,
  first_value(time_s) OVER (PARTITION BY suite ORDER BY cores) / time_s / cores AS efficiency
  FROM runs)""", "scaling", "suite# cores# time_s~2 speedup~6 efficiency~6")


def a12_overlap(spark, sf):
    runs = X.table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity"))).alias("lasso_duration"),
        F.sum("l_discount").alias("gbt_duration"),
        (F.count(F.lit(1)) * 13.0).alias("total_time"))
    return shaped(metrics.overlap_seconds(runs), "l_suppkey# overlap_seconds~4")


ORACLE["a12_overlap"] = """
SELECT l_suppkey, round(greatest(sum(l_quantity) FILTER (l_linestatus = 'O') + sum(l_discount)
  - count(*) * 13.0, 0.0), 4) AS overlap_seconds FROM lineitem GROUP BY 1"""

QUERIES.update({f.__name__: f for f in (
    a1_batch_bars, a2_avg_volume, a3_avg_volume_preview, a5_row_counts, a13_group_sizes,
    a14_throughput, f5_choose_fraction, j6_pair_runs, a12_core_scaling, a12_overlap)})
