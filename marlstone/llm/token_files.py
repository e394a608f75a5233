"""Token ids in compact binary blocks, in ascending document order, and back.

Ids are renumbered by how often they occur, so that the most frequent take one byte. A number
takes one to four data bytes; how many stands in a control byte that serves four numbers, kept
apart from the data. A block holds whole documents until it has `BLOCK_TOKENS` ids. Blocks are rows
of Parquet files sorted by document id: Spark's own writer commits them on any file system, and a
task that is run again replaces what it wrote. Beside the blocks lies the small table of ranks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from marlstone.llm.byte_bpe import default_path, encoder
from marlstone.llm.packing import with_end_ids
from marlstone.llm.common import id_and_text, in_slices, shuffle_partitions, staged
from marlstone.session import scratch_dir

END_ID = 2
BLOCK_TOKENS = 1 << 16

# For each control byte: the sizes of its four numbers.
SIZES = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    ranks = ranks.astype("<u4")
    size = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = size - 1
    control = codes.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode_ranks(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The numbers again: sizes come from a table lookup, bytes are gathered at their sums."""
    sizes = SIZES[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = raw[starts].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(sizes > k)
        out[longer] |= raw[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def write_token_files(
    df: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
) -> None:
    """Encode every text, append the end id, and write `path/blocks` and `path/ranks`.

    A null text counts as empty and holds the end id alone. Null document ids come first; rows with
    the same id follow each other in no set order. Other columns are ignored. An empty table
    writes no blocks.
    """
    tokenizer = tokenizer or default_path()
    rows = id_and_text(df, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = encoder(tokenizer)
        for batch in in_slices(batches, "text"):
            ids, ends = with_end_ids(*table.encode_array(batch["text"]), end_id)
            bounds = pa.py_buffer(np.append(0, ends) * table.dtype.itemsize)
            body = pa.Array.from_buffers(
                pa.large_binary(), len(ends), [None, bounds, pa.py_buffer(ids.astype(table.dtype))]
            )
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], body.cast(pa.binary())], names=["doc_id", "ids"]
            )

    spark = df.sparkSession
    made = staged(rows.mapInArrow(tokens, f"doc_id {kind}, ids binary"), "tokens")
    dtype = encoder(tokenizer).dtype
    ranks = (
        made.select("ids")
        .mapInArrow(_counter(dtype), "id bigint, n bigint")
        .groupBy("id")
        .agg(F.sum("n").alias("n"))
        .withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1)
    )
    # As many rows as the vocabulary has ids, whatever the size of the corpus.
    ranks.select("id", "rank").coalesce(1).write.parquet(f"{path}/ranks")
    order = rank_order(spark, path)
    rank_of = np.zeros(int(order.max(initial=0)) + 1, np.uint32)
    rank_of[order] = np.arange(len(order), dtype=np.uint32)
    placed = made.repartitionByRange(shuffle_partitions(spark), "doc_id").sortWithinPartitions(
        "doc_id"
    )
    placed.mapInArrow(
        _blocks(dtype, rank_of),
        f"part int, block_start bigint, doc_ids array<{kind}>, sizes array<int>, "
        "control binary, data binary",
    ).write.option("compression", "zstd").parquet(f"{path}/blocks")


def _counter(dtype):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in in_slices(batches, "ids"):
            found = np.bincount(np.frombuffer(b"".join(batch["ids"].to_pylist()), dtype))
            if len(found) > len(total):
                total = np.pad(total, (0, len(found) - len(total)))
            total[: len(found)] += found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "n"]
        )

    return count


def _blocks(dtype, rank_of: np.ndarray):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        docs, ids, held = [], [], 0
        kind = None

        def block() -> pa.RecordBatch:
            nonlocal start, docs, ids, held
            control, data = encode_ranks(rank_of[np.concatenate(ids)])
            columns = [
                pa.array([part], pa.int32()),
                pa.array([start], pa.int64()),
                pa.array([docs], pa.list_(kind)),
                pa.array([[len(x) for x in ids]], pa.list_(pa.int32())),
                pa.array([control], pa.binary()),
                pa.array([data], pa.binary()),
            ]
            start += held
            docs, ids, held = [], [], 0
            names = ["part", "block_start", "doc_ids", "sizes", "control", "data"]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in in_slices(batches, "ids"):
            kind = batch["doc_id"].type
            for doc_id, raw in zip(batch["doc_id"].to_pylist(), batch["ids"].to_pylist()):
                docs.append(doc_id)
                ids.append(np.frombuffer(raw, dtype))
                held += len(ids[-1])
                if held >= BLOCK_TOKENS:
                    yield block()
        if docs:
            yield block()

    return write


def rank_order(spark: SparkSession, path: str) -> np.ndarray:
    """The id of each rank; a row per id of the vocabulary at most."""
    found = spark.read.parquet(f"{path}/ranks").orderBy("rank").select("id").collect()
    return np.array([row.id for row in found], np.int64)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The documents of the files: doc_id, start, n_tokens, ids (little-endian 32-bit, binary).

    `start` counts the ids of all documents before it. Empty texts have their end id alone, and rows
    written twice are read twice; a folder without blocks gives an empty result.
    """
    order = rank_order(spark, path).astype("<u4")
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    # One row per file part.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        blocks.select("part", F.explode("sizes").alias("n"))
        .groupBy("part")
        .agg(F.sum("n").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                sizes = np.array(batch["sizes"][row].values, np.int64)
                ends = np.cumsum(sizes)
                control, data = (batch[c][row].as_py() for c in ("control", "data"))
                ids = order[decode_ranks(control, data, int(ends[-1]))]
                raw = ids.tobytes()
                first = batch["first"][row].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_ids"][row].values,
                        pa.array(first + ends - sizes, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(
                            [raw[4 * a : 4 * b] for a, b in zip(ends - sizes, ends)], pa.binary()
                        ),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    placed = blocks.join(parts, "part").select(
        (F.col("part_start") + F.col("block_start")).alias("first"),
        "doc_ids", "sizes", "control", "data",
    )
    return placed.mapInArrow(read, f"doc_id {kind}, start bigint, n_tokens bigint, ids binary")


def token_file_folder(spark: SparkSession) -> str:
    return scratch_dir(spark, "token-files")
