"""Ingestion job: raw rows to expanded, stored bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barstream.operators.cleaning import drop_incomplete_bars, standardize
from barstream.operators.expansion import add_noise, expand_history, repair_ohlc
from barstream.schemas import HISTORY_MULTIPLIER, NOISE_SIGMA
from barstream.sources.readers import read_raw
from barstream.sources.sinks import write_bars


def expanded_bars(raw: DataFrame, multiplier: int = HISTORY_MULTIPLIER,
                  sigma: float = NOISE_SIGMA) -> DataFrame:
    """Typed, complete, expanded and repaired bars; narrow steps only, no shuffle."""
    bars = expand_history(drop_incomplete_bars(standardize(raw)), multiplier)
    if sigma > 0:
        bars = add_noise(bars, sigma)
    return repair_ohlc(bars)


def run_ingestion(spark: SparkSession, source: str, target: str,
                  multiplier: int = HISTORY_MULTIPLIER, sigma: float = NOISE_SIGMA) -> None:
    write_bars(expanded_bars(read_raw(spark, source), multiplier, sigma), target)
