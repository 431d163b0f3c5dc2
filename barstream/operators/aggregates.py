"""Grouped summaries.  All combine on the map side, so a hot symbol costs its
tasks one partial row each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def deviation_or_one(deviation: Column) -> Column:
    """A missing or zero deviation counts as 1."""
    return F.coalesce(F.nullif(deviation, F.lit(0.0)), F.lit(1.0))


def batch_bars(ticks: DataFrame, *batch: Column | str) -> DataFrame:
    """One bar per symbol (and batch): mean prices, mean volume, deviation of Close."""
    means = [F.avg(c).alias(c) for c in ("Open", "High", "Low", "Close", "Volume")]
    return ticks.groupBy(*batch, F.col("Symbol").alias("symbol")).agg(
        *means, deviation_or_one(F.stddev("Close")).alias("volatility"))


def tick_windows(width: str, ts: str = "timestamp") -> Column:
    """Start of the fixed time window a tick falls into."""
    return F.window(ts, width).start.alias("timestamp")


def avg_volume(raw: DataFrame) -> DataFrame:
    """Mean volume per symbol; rows without a whole-number volume are skipped."""
    return (
        raw.select(F.col("Ticker").alias("symbol"),
                   F.col("Volume").try_cast("bigint").alias("volume"))
        .filter((F.col("symbol") != "Ticker") & F.col("volume").isNotNull())
        .groupBy("symbol")
        .agg(F.round(F.avg("volume"), 2).alias("avg_volume"))
    )


def avg_volume_preview(raw: DataFrame, n: int = 5) -> DataFrame:
    return avg_volume(raw).orderBy("symbol").limit(n)


def row_counts(features: DataFrame, share: float = 0.8) -> DataFrame:
    """Feature, train and test rows in one pass."""
    rank = F.col("Split_Rank")
    return features.agg(
        F.count(F.lit(1)).alias("feature_rows"),
        F.count_if(rank < share).alias("train_rows"),
        F.count_if(rank >= share).alias("test_rows"),
    )


def score_checksum(scored: DataFrame, column: str = "prediction") -> DataFrame:
    return scored.agg(F.sum(column).alias("checksum"))


def batch_throughput(bars: DataFrame, batch: str = "timestamp") -> DataFrame:
    """Symbols processed per micro-batch."""
    return bars.groupBy(batch).agg(F.count(F.lit(1)).alias("throughput"))


def choose_fraction(features: DataFrame, n_columns: int, limit_gb: float = 4.0) -> DataFrame:
    """Size guard: the estimate in GB and the share of training rows to use."""
    size = F.count(F.lit(1)) * n_columns * 8 / F.lit(float(2 ** 30)) * 2.5
    return features.agg(size.alias("estimated_gb")).withColumn(
        "fraction",
        F.when(F.col("estimated_gb") < limit_gb, F.lit(1.0)).otherwise(F.lit(0.75)))


def group_sizes(df: DataFrame, key: str = "symbol") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("group_size"))
