"""History expansion: shifted replicas, noise and candle repair."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barstream.schemas import (
    HISTORY_MULTIPLIER, MIN_NOISY_PRICE, NOISE_SEEDS, NOISE_SIGMA, SHIFT_DAYS,
)


def expand_history(bars: DataFrame, multiplier: int = HISTORY_MULTIPLIER) -> DataFrame:
    """``multiplier`` copies of every bar, copy k shifted by 365 * k days.

    The multiplier table is a constant array, so the product needs no join:
    each task expands its own rows.
    """
    replicas = F.explode(F.sequence(F.lit(1), F.lit(multiplier))).alias("replica")
    expanded = bars.select("*", replicas)
    return expanded.withColumn(
        "timestamp", F.date_add("timestamp", F.col("replica") * F.lit(SHIFT_DAYS)))


def _uniform(keys: list[Column], seed: int, stream: int) -> Column:
    """Number in (0, 1] drawn from a hash of the row key."""
    bits = F.xxhash64(*keys, F.lit(seed), F.lit(stream))
    return (F.shiftrightunsigned(bits, 11).cast("double") + 1.0) / F.lit(float(2 ** 53))


def _gaussian(keys: list[Column], seed: int) -> Column:
    radius = F.sqrt(F.lit(-2.0) * F.log(_uniform(keys, seed, 0)))
    return radius * F.cos(F.lit(2.0 * math.pi) * _uniform(keys, seed, 1))


def add_noise(
    df: DataFrame,
    sigma: float = NOISE_SIGMA,
    seeds: dict[str, int] | None = None,
    floor: float = MIN_NOISY_PRICE,
) -> DataFrame:
    """Gaussian noise on prices, floored.

    The draw depends on the row key and the seed only, so results do not change
    with the partitioning or when a task is run again.
    """
    keys = [F.col(c) for c in ("symbol", "timestamp", "replica") if c in df.columns]
    noisy = {
        name: F.greatest(F.lit(floor), F.col(name) + _gaussian(keys, seed) * F.lit(sigma))
        for name, seed in (seeds or NOISE_SEEDS).items()
    }
    return df.withColumns(noisy)


def repair_ohlc(df: DataFrame) -> DataFrame:
    """High covers all four prices first; Low is then taken against the new High."""
    df = df.withColumn("High", F.greatest("High", "Open", "Close", "Low"))
    return df.withColumn("Low", F.least("Low", "Open", "Close", "High"))
