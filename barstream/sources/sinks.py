"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_bars(bars: DataFrame, path: str, max_records_per_file: int = 5_000_000) -> None:
    """Parquet in order of symbol and time.

    Range partitions give large files of neighbouring symbols, whatever the number of
    symbols, and split a hot one along time; readers skip row groups by their statistics.
    """
    order = ["symbol", *[c for c in ("timestamp", "replica") if c in bars.columns]]
    (
        bars.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .parquet(path)
    )


def write_signals(records: DataFrame, path: str) -> None:
    records.write.mode("append").parquet(path)


def write_trades(trade_rows: DataFrame, path: str) -> None:
    """Append trades; ``(timestamp, symbol)`` orders them, there is no global counter."""
    trade_rows.write.mode("append").parquet(path)


def clear_trades(trade_rows: DataFrame, path: str) -> None:
    """Replace stored trades by none, keeping the schema."""
    trade_rows.limit(0).write.mode("overwrite").parquet(path)


def write_runs(runs: DataFrame, path: str) -> None:
    """Benchmark results as CSV with a header (a handful of rows)."""
    runs.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
