"""Load shedding: a stream of text files that reads the newest ones and leaves the rest out.

A file source works off its backlog however old it is. Ticks lose their worth quickly, so this source ranks the files
that came since the last batch by modification time, reads the newest ``keep`` and sheds the others: they are logged and
never opened. An offset is the mark (time, name) of the newest file seen, so it stays small; which files a batch has
follows from the folder and two marks, and a batch that is run again has the same ones. A file that turns up with a
time before the mark is older than what was read already: it counts as shed, too, but is not logged.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

LINES_PER_BATCH = 50_000
READ_BYTES = 1 << 20
_START = [-1, ""]


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder)
    return fs.LocalFileSystem(), folder


def list_marks(folder: str) -> list[list]:
    """[time in nanoseconds, name] of the folder's files, oldest first; hidden ones and those under way left out."""
    system, path = _opened(folder)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted([f.mtime_ns, f.base_name] for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", ".")))


def chosen(marks: list[list], start: list, end: list, keep: int) -> tuple[list[str], list[str]]:
    """Names of the batch between two marks: the ``keep`` newest, which are read, and the surplus."""
    arrived = [mark[1] for mark in marks if start < mark <= end]
    return arrived[-keep:], arrived[:-keep]


class FilePart(InputPartition):
    def __init__(self, folder: str, name: str):
        self.folder, self.name = folder, name


class NewestFilesReader(DataSourceStreamReader):
    def __init__(self, folder: str, keep: int, log: str | None, clean: bool):
        self.folder, self.keep, self.log, self.clean = folder, keep, log, clean

    def initialOffset(self) -> dict:
        return {"mark": _START}

    def latestOffset(self) -> dict:
        marks = list_marks(self.folder)
        return {"mark": marks[-1] if marks else _START}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        taken, shed = chosen(list_marks(self.folder), start["mark"], end["mark"], self.keep)
        if shed and self.log:
            system, path = _opened(self.log)
            system.create_dir(path)
            with system.open_output_stream(f"{path}/{end['mark'][0]}.json") as out:  # one name a batch: written again, not twice
                out.write("".join(json.dumps({"batch_mark": end["mark"][0], "file": name}) + "\n" for name in shed).encode())
        return [FilePart(self.folder, name) for name in taken]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        system, path = _opened(partition.folder)
        rest, lines = b"", []
        with system.open_input_stream(f"{path}/{partition.name}") as source:
            while chunk := source.read(READ_BYTES):
                *whole, rest = (rest + chunk).split(b"\n")
                lines += whole
                while len(lines) >= LINES_PER_BATCH:
                    yield _lines(lines[:LINES_PER_BATCH])
                    lines = lines[LINES_PER_BATCH:]
        yield _lines(lines + [rest])

    def commit(self, end: dict) -> None:
        if self.clean:
            system, path = _opened(self.folder)
            for mark in list_marks(self.folder):
                if mark <= end["mark"]:
                    system.delete_file(f"{path}/{mark[1]}")


def _lines(lines: list[bytes]) -> pa.RecordBatch:
    texts = [line.decode("utf-8", "replace").rstrip("\r") for line in lines]
    return pa.RecordBatch.from_arrays([pa.array([t for t in texts if t], pa.string())], ["value"])


class NewestFiles(DataSource):
    """Options: ``path``, ``keep``, ``log`` (folder of the shed files' names), ``clean`` (delete what was read or shed)."""

    @classmethod
    def name(cls) -> str:
        return "newest_files"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return NewestFilesReader(self.options["path"], int(self.options.get("keep", "20")), self.options.get("log"),
                                 self.options.get("clean", "false").lower() == "true")


def newest_lines(spark: SparkSession, folder: str, keep: int, log: str | None = None, clean: bool = False) -> DataFrame:
    """Lines of the newest files as a stream with one column, ``value``."""
    spark.dataSource.register(NewestFiles)
    reader = spark.readStream.format("newest_files").option("keep", keep).option("clean", str(clean).lower())
    return (reader.option("log", log) if log else reader).load(folder)


def shed_files(spark: SparkSession, log: str) -> DataFrame:
    """(batch_mark, file) of everything that was shed."""
    return spark.read.schema("batch_mark long, file string").json(log)
