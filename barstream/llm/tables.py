"""Tables between the steps of an operator."""

from __future__ import annotations


import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from barstream.storage import discard, scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: later steps neither repeat the work nor
    depend on the executors that did it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(*tables: DataFrame) -> None:
    """Removes tables made by ``stored`` from the shared folder. Whatever was to be computed from them must be stored itself."""
    for table in tables:
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            discard(table.sparkSession, folder)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def record_batch(**columns: pa.Array | object) -> pa.RecordBatch:
    arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)
