"""Small pieces the operators share."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import marlstone
from marlstone.session import scratch_dir

# A word is a run of anything but these six characters.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 4 << 20


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only `doc_id` and `text`, so that no other column of the input can clash with ours."""
    return df.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs its running tasks only, and whatever reads the table
    twice does not compute it twice.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of `batches` again, few enough at a time that their texts stay below `limit`.

    What a task makes of a text can be many times its size, so this bounds a task's memory. A
    single longer text comes alone.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        at, held = 0, 0
        for row, size in enumerate(sizes.to_pylist()):
            if held and held + size > limit:
                yield batch.slice(at, row - at)
                at, held = row, 0
            held += size
        if at < batch.num_rows:
            yield batch.slice(at)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")



def find_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where it lies.

    On a cluster the package goes to the executors by `--py-files` or is installed there.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(marlstone.__file__)))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(p for p in [root, *paths] if p)
