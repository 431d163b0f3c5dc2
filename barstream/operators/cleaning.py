"""Row filters and repairs applied before and after the feature windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barstream.schemas import BAR_COLUMNS, MAX_ABS_TARGET_RETURN, MIN_VALID_PRICE


def standardize(raw: DataFrame) -> DataFrame:
    """Rename and type raw daily rows; unreadable values become null."""
    def number(name: str, kind: str):
        return F.col(name).try_cast(kind).alias(name)

    return raw.select(
        F.col("Ticker").alias("symbol"),
        F.col("Date").try_cast("timestamp").alias("timestamp"),
        *[number(n, "double") for n in ("Open", "High", "Low", "Close")],
        number("Volume", "bigint"),
    )


def drop_incomplete_bars(bars: DataFrame) -> DataFrame:
    """Parse the time leniently, then drop bars with any missing field."""
    if isinstance(bars.schema["timestamp"].dataType, T.StringType):
        bars = bars.withColumn("timestamp", F.col("timestamp").try_cast("timestamp"))
    return bars.dropna(subset=BAR_COLUMNS)


def min_price_filter(df: DataFrame, floor: float = MIN_VALID_PRICE) -> DataFrame:
    """Both this close and the next one lie above the floor."""
    return df.filter((F.col("Close") > floor) & (F.col("Next_Close") > floor))


def bound_target(df: DataFrame, limit: float = MAX_ABS_TARGET_RETURN) -> DataFrame:
    return df.filter(F.abs("Target_Return") <= limit)


def clean_features(df: DataFrame) -> DataFrame:
    """Keep rows whose every field is present and finite.

    One filter does the work of drop-nulls, infinities-to-null, drop-nulls.
    """
    keep = F.lit(True)
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        keep = keep & column.isNotNull()
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            keep = keep & ~F.isnan(column) & (F.abs(column) != float("inf"))
    return df.filter(keep)


def limit_symbols(df: DataFrame, symbols: DataFrame, n: int) -> DataFrame:
    """Rows of the first ``n`` symbols by name.

    ``symbols`` is cut to ``n`` rows, so the broadcast side is bounded by ``n``.
    """
    chosen = symbols.select("symbol").orderBy("symbol").limit(n)
    if n <= 100_000:
        chosen = F.broadcast(chosen)
    return df.join(chosen, "symbol", "left_semi")


def watch_list(df: DataFrame, watched: DataFrame) -> DataFrame:
    """Rows of watched symbols only."""
    return df.join(watched.select("symbol"), "symbol", "left_semi")
