"""Tick stream from a folder of headerless CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barstream.functions.numeric import present
from barstream.schemas import BACKLOG_FILES, TICK
from barstream.streaming.newest import newest_lines


def read_ticks(spark: SparkSession, folder: str, max_files: int = 5, newest_first: bool = False,
               clean: bool = False, max_age_seconds: int | None = None) -> DataFrame:
    """Stream of ticks.

    ``newest_first`` sheds load by taking fresh files first; ``max_age_seconds``
    ignores rows of files older than that when they are read.  ``clean`` deletes
    consumed files.
    """
    reader = (
        spark.readStream.schema(TICK)
        .option("maxFilesPerTrigger", max_files)
        .option("latestFirst", str(newest_first).lower())
        .option("cleanSource", "delete" if clean else "off")
    )
    ticks = reader.csv(folder)
    if max_age_seconds is not None:
        # Source options drop old files only without a per-trigger cap, so the
        # arrival time is checked row by row.
        arrived = F.col("_metadata.file_modification_time")
        fresh = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(arrived)
        ticks = ticks.filter(fresh < max_age_seconds)
    return _usable(ticks)


def _usable(ticks: DataFrame) -> DataFrame:
    return ticks.filter(F.col("timestamp").isNotNull() & F.col("Symbol").isNotNull() & present(F.col("Close")))


def read_newest_ticks(spark: SparkSession, folder: str, keep: int = BACKLOG_FILES, shed_log: str | None = None,
                      clean: bool = False) -> DataFrame:
    """Stream of ticks that sheds load: of the files that came since the last batch it reads the ``keep`` newest.

    Names of the others go to the folder ``shed_log``; they are never opened. ``clean`` deletes both kinds once
    their batch is done.
    """
    lines = newest_lines(spark, folder, keep, shed_log, clean)
    fields = F.from_csv("value", TICK.simpleString()[len("struct<"):-1].replace(":", " "), {"mode": "PERMISSIVE"})
    return _usable(lines.select(fields.alias("tick")).select("tick.*"))
