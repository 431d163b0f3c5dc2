"""Bars, ticks and raw rows derived from the relational test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barstream.operators.series import MAX_SERIES_ROWS, all_short


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str, together: bool = False) -> DataFrame:
    """Daily bar per supplier: unit prices of its line items by ship date.

    ``together`` brings the line items of a symbol into one task first: then neither the grouping nor windows by
    symbol shuffle again. It is for symbols that a task can take (see ``short_bars``) and where what is shuffled
    counts: the tasks that read take somewhat longer.
    """
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("symbol"), F.to_date("l_shipdate").alias("timestamp"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key"), "l_quantity")
    return (
        (rows.repartition("symbol") if together else rows)
        .groupBy("symbol", "timestamp")
        .agg(
            F.min_by("price", "key").alias("Open"), F.max("price").alias("High"),
            F.min("price").alias("Low"), F.max_by("price", "key").alias("Close"),
            F.sum("l_quantity").cast("bigint").alias("Volume"),
        )
    )


def short_bars(spark: SparkSession, sf_dir: str, max_rows: int = MAX_SERIES_ROWS) -> DataFrame:
    """Bars, made symbol by symbol unless some symbol has more than ``max_rows`` line items."""
    return bars(spark, sf_dir, all_short(bar_rows(spark, sf_dir), max_rows=max_rows))


def bar_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The symbol of every line item: at least as many rows of a symbol as it has bars."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("symbol"))


def ticks(spark: SparkSession, sf_dir: str, symbol: str = "event_type") -> DataFrame:
    """One tick per event: value as every price, ``$.k`` as volume."""
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col(symbol).cast("string").alias("Symbol"),
        value.alias("Open"), value.alias("High"), value.alias("Low"), value.alias("Close"),
        F.get_json_object("props", "$.k").try_cast("double").alias("Volume"),
        F.lit(None).cast("double").alias("gen_ts"),
    )


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw daily text rows; some are malformed in the ways real files are."""
    price = (F.col("l_extendedprice") / F.col("l_quantity")).cast("string")
    quantity = F.col("l_quantity").cast("bigint").cast("string")
    volume = (
        F.when(F.col("l_linenumber") == 7, F.concat(quantity, F.lit(".0")))
        .when(F.col("l_linenumber") == 6, F.lit("n/a"))
        .when(F.col("l_linenumber") == 5, F.concat(F.lit(" "), quantity, F.lit(" ")))
        .otherwise(quantity)
    )
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("string").alias("Ticker"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("Date"),
        price.alias("Open"), price.alias("High"), price.alias("Low"),
        F.when(F.col("l_linenumber") == 4, F.lit("bad")).otherwise(price).alias("Close"),
        volume.alias("Volume"),
    )
