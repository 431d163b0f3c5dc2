"""Training features: rolling windows over each symbol's history.

Frames include the current row: ten and thirty preceding rows make 11 and 31.
All columns share one window definition, so one shuffle serves them all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barstream.functions.numeric import change_or_zero, ratio_or
from barstream.operators.cleaning import bound_target, clean_features, min_price_filter
from barstream.operators.series import SeriesLayout, measure_series
from barstream.schemas import MAX_ABS_TARGET_RETURN, MIN_VALID_PRICE, TRAIN_SHARE

SHORT, LONG = 10, 30
_TINY = 1e-8


def feature_layout(bars: DataFrame, **options) -> SeriesLayout:
    return measure_series(bars, back=LONG, ahead=1, **options)


def _rolling(df: DataFrame, layout: SeriesLayout) -> DataFrame:
    w = layout.window()
    short, long = w.rowsBetween(-SHORT, 0), w.rowsBetween(-LONG, 0)
    close, volume = F.col("Close"), F.col("Volume").cast("double")

    df = df.withColumns({
        "MA_10": F.avg(close).over(short),
        "MA_30": F.avg(close).over(long),
        "Volatility": F.stddev(close).over(short),
        "Vol_MA_10": F.avg(volume).over(short),
        "_sd_long": F.stddev(close).over(long),
        "_sd_volume": F.stddev(volume).over(short),
        "_lag_1": F.lag(close, 1).over(w),
        "_lag_5": F.lag(close, 5).over(w),
        "Next_Close": F.lead(close, 1).over(w),
    })
    return df.withColumns({
        "Momentum_1": change_or_zero(close, F.col("_lag_1")),
        "Momentum_5": change_or_zero(close, F.col("_lag_5")),
        "Close_norm": F.when(F.col("_sd_long") > _TINY,
                             (close - F.col("MA_30")) / F.col("_sd_long")).otherwise(F.lit(0.0)),
        "Volume_norm": F.when(F.col("_sd_volume") > _TINY,
                              (volume - F.col("Vol_MA_10")) / F.col("_sd_volume")
                              ).otherwise(F.lit(0.0)),
        "MA_ratio_10_30": ratio_or(F.col("MA_10"), F.col("MA_30"), 1.0),
    }).drop("_sd_long", "_sd_volume", "_lag_1", "_lag_5")


def rolling_features(bars: DataFrame, layout: SeriesLayout | None = None) -> DataFrame:
    """Bars with the nine rolling columns and ``Next_Close``."""
    layout = layout or feature_layout(bars)
    return layout.settle(_rolling(layout.spread(bars), layout))


def train_features(
    bars: DataFrame,
    layout: SeriesLayout | None = None,
    min_price: float = MIN_VALID_PRICE,
    max_return: float = MAX_ABS_TARGET_RETURN,
) -> DataFrame:
    """Features, labels and chronological rank, cleaned.

    Windows see every bar; then come price floor, target, target bound, rank
    (whose denominator counts rows the last cleaning drops) and cleaning.
    """
    layout = layout or feature_layout(bars)
    df = layout.settle(_rolling(layout.spread(bars), layout), keep_chunk=True)
    df = min_price_filter(df, min_price)
    df = df.withColumn("Target_Return", (F.col("Next_Close") - F.col("Close")) / F.col("Close"))
    df = bound_target(df, max_return)
    df = df.withColumn(
        "Target_Direction",
        F.when(F.col("Next_Close") > F.col("Close"), F.lit(1.0)).otherwise(F.lit(0.0)))
    df = layout.with_percent_rank(df.drop("Next_Close"), "Split_Rank")
    return clean_features(df.drop("_chunk"))


def price_features(bars: DataFrame, layout: SeriesLayout | None = None) -> DataFrame:
    """Earlier variant: next close as regression label, no price or return bounds."""
    layout = layout or feature_layout(bars)
    df = layout.settle(_rolling(layout.spread(bars), layout))
    df = df.drop("Close_norm", "Volume_norm", "MA_ratio_10_30")
    df = df.withColumn(
        "Target_Direction",
        F.when(F.col("Next_Close") > F.col("Close"), F.lit(1.0)).otherwise(F.lit(0.0)))
    return clean_features(df.withColumnRenamed("Next_Close", "Target_Price"))


def time_split(df: DataFrame, share: float = TRAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """Earlier part of every symbol for training, the rest for testing."""
    rank = F.col("Split_Rank")
    return (df.filter(rank < share).drop("Split_Rank"),
            df.filter(rank >= share).drop("Split_Rank"))
