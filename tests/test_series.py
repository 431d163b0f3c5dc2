"""Cutting long series must not change any value."""

import pytest
from pyspark.sql import functions as F

from barstream.operators import features, indicators, signals
from barstream.operators.series import measure_series
from barstream.params import JobParams
from barstream.plans.live import replayed_bars, signal_records
from barstream.sources import fixtures
from conftest import nearly_equal

KEYS = ["symbol", "timestamp", "replica"]
WEIGHTS = [0.0103, -0.00417, 0.0201, 0.0, 0.0031416, -0.00107, 0.000103]


def test_short_series_keep_the_plain_window(skewed):
    layout = measure_series(skewed, back=30)
    assert not layout.long and layout.keys == ["symbol"]


def test_long_series_are_cut_and_short_ones_are_not(skewed):
    layout = measure_series(skewed, back=30, ahead=1, max_rows=100)
    spread = layout.spread(skewed)
    sizes = {(r["symbol"], r["_chunk"]): r["count"]
             for r in spread.groupBy("symbol", "_chunk").count().collect()}
    assert {s for s, _ in sizes} == {"HOT"} | {f"C{i}" for i in range(8)}
    assert len([1 for s, _ in sizes if s == "HOT"]) >= 8
    assert all(chunk == 0 for s, chunk in sizes if s != "HOT")
    # No task gets much more than a chunk and its lead-in.
    assert max(sizes.values()) <= 2 * 100 + 60
    assert layout.settle(spread).count() == skewed.count()


@pytest.mark.parametrize("max_rows", [7, 40, 100, 400])
def test_training_features_agree(skewed, max_rows):
    layout = features.feature_layout(skewed, max_rows=max_rows)
    assert layout.long
    plain = features.train_features(skewed, max_return=10.0)
    cut = features.train_features(skewed, layout, max_return=10.0)
    nearly_equal(plain, cut, KEYS, 1e-9)


@pytest.mark.parametrize("max_rows", [25, 200])
def test_live_features_and_replay_agree(skewed, max_rows):
    params = JobParams(sma_window=45)
    layout = indicators.live_layout(skewed, params, max_rows=max_rows)
    assert layout.long
    nearly_equal(indicators.live_features(skewed, params),
                 indicators.live_features(skewed, params, layout), KEYS, 1e-9)
    plain = replayed_bars(skewed, WEIGHTS, -0.02513, params)
    cut = replayed_bars(skewed, WEIGHTS, -0.02513, params, max_rows=max_rows)
    nearly_equal(plain, cut, KEYS, 1e-9)


def test_macd_lead_in_is_exact_to_the_last_digits(spark):
    """A chunk far inside a long series starts from rows before it only."""
    rows = spark.range(0, 6000).select(
        F.lit("A").alias("symbol"),
        F.timestamp_seconds(F.col("id") * 60).alias("timestamp"),
        (F.pmod(F.xxhash64("id"), F.lit(100_000)) / 7 + 1).alias("Close"),
        F.lit(1).alias("Volume"))
    layout = indicators.live_layout(rows, max_rows=2000)
    assert layout.long
    nearly_equal(indicators.macd(rows), indicators.macd(rows, layout=layout),
                 ["symbol", "timestamp"], 1e-12)


def test_cut_table_may_be_joined_by_shuffle(skewed):
    from dataclasses import replace

    layout = features.feature_layout(skewed, max_rows=100)
    assert layout.small
    nearly_equal(features.rolling_features(skewed, layout),
                 features.rolling_features(skewed, replace(layout, small=False)), KEYS, 1e-12)


def test_one_shuffle_serves_all_windows(spark, sf):
    from barstream.sources import fixtures

    bars = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.col("l_suppkey").alias("symbol"), F.col("l_shipdate").cast("date").alias("timestamp"),
        *[F.col("l_extendedprice").alias(c) for c in ("Open", "High", "Low", "Close")],
        F.col("l_quantity").alias("Volume"), F.col("l_orderkey").alias("replica"))
    df = features.train_features(bars, max_return=10.0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    scored = signals.add_scores(
        indicators.live_features(fixtures.bars(spark, sf)), WEIGHTS, 0.0)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    # One shuffle builds the bars, one serves windows and MACD together.
    assert plan.count("Exchange hashpartitioning") == 2


def test_bound_spares_counting_the_rows_themselves(spark, skewed):
    """A table with at least as many rows decides when it has no long series; otherwise the rows are counted as before."""
    def never(x):
        raise AssertionError("computed")

    unread = skewed.withColumn("symbol", F.udf(never)("symbol"))
    assert not measure_series(unread, back=3, max_rows=1000, bound=skewed).long
    assert not measure_series(skewed.limit(0), back=3, bound=skewed.limit(0)).long
    twice = skewed.unionAll(skewed)
    assert not measure_series(skewed, back=3, max_rows=900, bound=twice).long
    assert measure_series(skewed, back=3, max_rows=100, bound=twice).long


def test_bars_of_short_symbols_shuffle_once(spark, sf, capsys):
    """Grouping and windows by symbol share the shuffle of the line items; with a long symbol they do not."""
    once, cut = fixtures.short_bars(spark, sf), fixtures.short_bars(spark, sf, max_rows=5)
    assert once.exceptAll(cut).isEmpty() and cut.exceptAll(once).isEmpty() and once.count() == cut.count()
    for bars, shuffles in ((once, 1), (cut, 2)):
        features.rolling_features(bars, measure_series(bars, back=30)).explain()
        assert capsys.readouterr().out.count("Exchange hashpartitioning") == shuffles


def test_records_are_not_shuffled_by_time(spark, sf, capsys):
    """The table of batch sizes is broadcast by its count, whatever Spark expects of its size."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        signal_records(fixtures.bars(spark, sf), WEIGHTS, 0.0, JobParams(use_macd=False)).explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
