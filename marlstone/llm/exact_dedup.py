"""Exact duplicates by sorting content.

Rows are range-partitioned by their text on splitters Spark samples, sorted in each partition
(spilling to disk where needed), and every text is compared in full with its neighbour. A group of
equal texts may cross partition borders, since the id is part of the range key: a text that fills
a third of the table is shared out over many tasks. Each partition therefore hands on the text of
its first and of its last run only, and these few are matched with each other afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from marlstone.llm.common import col, shuffle_partitions, staged

# Splitters are sent to the driver, so they hold this much of a text and its digest, not all of it.
SPLITTER_CHARS = 64


def exact_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "largest",
    normalise=lambda text: text,
    carry: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty, and all empty texts are one group. The row with the largest (or
    smallest) id stays; null ids come first, so they stay only in a group without other ids. Of
    rows alike in text and id exactly one stays. `normalise` is a column function applied before
    comparing. Other columns of the input are ignored, or with `carry` returned in a struct `row`
    that also holds the id and the text. An empty table gives an empty result.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep must be largest or smallest, not {keep}")
    body = F.coalesce(normalise(col(text_col).cast("string")), F.lit(""))
    rows = df.select(
        col(id_col).alias("doc_id"),
        body.alias("text"),
        F.sha2(body, 256).alias("text_sha256"),
        F.substring(body, 1, SPLITTER_CHARS).alias("head"),
        *([F.struct("*").alias("row")] if carry else []),
    )
    by_id = F.col("doc_id").asc() if keep == "largest" else F.col("doc_id").desc_nulls_first()
    sorted_rows = rows.repartitionByRange(
        shuffle_partitions(df.sparkSession), "head", "text_sha256", by_id
    ).sortWithinPartitions("head", "text_sha256", "text", by_id)
    marks = T.StructType(
        [f for f in sorted_rows.schema if f.name not in ("text", "head")]
        + [
            T.StructField("part", T.IntegerType()),
            T.StructField("run", T.LongType()),
            T.StructField("ends_run", T.BooleanType()),
            T.StructField("border_text", T.StringType()),
        ]
    )
    marked = staged(sorted_rows.drop("head").mapInArrow(_mark_runs, marks), "exact-dedup")
    return _resolve(marked, F.max if keep == "largest" else F.min)


def _mark_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the runs of equal neighbours. One row is held back, to see what follows it."""
    part = TaskContext.get().partitionId()
    run, held, first = 0, None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        rows = rows.combine_chunks()
        texts = rows["text"].combine_chunks()
        count = rows.num_rows
        held = rows.slice(count - 1)
        if count == 1:
            continue
        changes = pc.not_equal(texts.slice(1), texts.slice(0, count - 1))
        numbers = pc.add(pc.cumulative_sum(pc.cast(changes, pa.int64())), run)
        runs = pa.concat_arrays([pa.array([run], pa.int64()), numbers])
        border = [texts[0].as_py() if first else None]
        yield _marks(rows.slice(0, count - 1), part, runs.slice(0, count - 1), changes, border)
        run, first = runs[count - 1].as_py(), False
    if held is not None:
        runs, ends = pa.array([run], pa.int64()), pa.array([True])
        yield _marks(held, part, runs, ends, [held["text"][0].as_py()])


def _marks(rows: pa.Table, part: int, runs, ends, border: list) -> pa.RecordBatch:
    count = rows.num_rows
    kept = rows.drop_columns(["text"])
    columns = [kept[name].combine_chunks() for name in kept.column_names]
    columns += [
        pa.array([part] * count, pa.int32()),
        runs,
        ends,
        pa.array(border + [None] * (count - 1), pa.string()),
    ]
    names = [*kept.column_names, "part", "run", "ends_run", "border_text"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _resolve(marked: DataFrame, best) -> DataFrame:
    runs = marked.groupBy("part", "run").agg(
        F.count(F.lit(1)).alias("size"),
        best("doc_id").alias("best_id"),
        F.max("border_text").alias("border_text"),
    )
    inner = runs.where("border_text is null").select(
        "part", "run", F.col("best_id").alias("keep_id"), F.col("size").alias("group_size"),
        F.col("part").alias("last_part"),
    )
    # At most two runs per partition touch a border.
    alike = Window.partitionBy("border_text")
    border = runs.where("border_text is not null").select(
        "part", "run",
        best("best_id").over(alike).alias("keep_id"),
        F.sum("size").over(alike).alias("group_size"),
        F.max("part").over(alike).alias("last_part"),
    )
    groups = inner.unionByName(border)
    kept: Column = F.col("ends_run") & (F.col("part") == F.col("last_part"))
    return marked.join(groups, ["part", "run"]).select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256",
        *(["row"] if "row" in marked.columns else []),
    )


def survivors(df: DataFrame, **options) -> DataFrame:
    """The rows of `df` that stay, with the columns of `df`, whatever their names.

    Null and empty texts are one group, of which one row stays; so does one of rows alike in text and
    id. An empty table gives an empty result.
    """
    return exact_dedup(df, carry=True, **options).where("kept").select("row.*")
