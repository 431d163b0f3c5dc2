"""Where intermediate tables go: the cluster's shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    A folder of our own is made only where the session names none and runs on one machine;
    on a cluster executors would not share it, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        if not named and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="barstream-"))
        current = context.getCheckpointDir()
    return named or current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system and path object of ``path``; works for every store Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if it does not exist."""
    system, place = _file_system(spark, folder)
    return [status.getPath().getName() for status in system.listStatus(place)] if system.exists(place) else []


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file under another name first, so that readers never see half of it."""
    system, place = _file_system(spark, path)
    under_way = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.writing")
    out = system.create(under_way, True)
    out.write(bytearray(text.encode()))
    out.close()
    system.delete(place, False)
    system.rename(under_way, place)


def read_small(spark: SparkSession, path: str) -> str:
    return "\n".join(row["value"] for row in spark.read.text(path).collect())


def discard(spark: SparkSession, path: str) -> None:
    """Removes a table of ours that nothing reads any more."""
    system, place = _file_system(spark, path)
    system.delete(place, True)


def place_file(spark: SparkSession, source: str, target: str, at_ms: int) -> None:
    """Moves one file of ours and sets its modification time."""
    system, place = _file_system(spark, target)
    system.mkdirs(place.getParent())
    system.rename(spark._jvm.org.apache.hadoop.fs.Path(source), place)
    system.setTimes(place, at_ms, -1)
