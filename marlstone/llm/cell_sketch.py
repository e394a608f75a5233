"""Occurrence counts of 64-bit hashes in a fixed number of cells, gathered over all tasks.

The size is set by `CELLS`, not by the data, so the merged sketch may go to the driver and from
there to every task. A cell that counts nothing proves that none of its values occurred; a large
count tells that one of them is frequent.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marlstone.llm.common import col

CELLS = 1 << 24
# A task counts a cell up to here; beyond, it is frequent and that is all that is asked.
MOST = np.iinfo(np.uint16).max
CHUNK = 1 << 16
FIELDS = "chunk int, cells binary"


class Partial:
    """What one task counts, in 32 MB."""

    def __init__(self):
        self.counts = np.zeros(CELLS, np.uint16)
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, values: np.ndarray) -> None:
        self.held.append(values)
        self.size += len(values)
        if self.size > 1 << 21:
            self._flush()

    def _flush(self) -> None:
        if self.held:
            cells = cell_of(np.concatenate(self.held))
            found, times = np.unique(cells, return_counts=True)
            total = self.counts[found] + times
            self.counts[found] = np.minimum(total, MOST)
        self.held, self.size = [], 0

    def rows(self) -> tuple[pa.Array, pa.Array]:
        """Chunk numbers and packed counts of the chunks that counted something."""
        self._flush()
        chunks = self.counts.reshape(-1, CHUNK)
        used = np.flatnonzero(chunks.any(axis=1))
        packed = [zlib.compress(chunks[i].tobytes(), 1) for i in used]
        return pa.array(used, pa.int32()), pa.array(packed, pa.binary())


def cell_of(values: np.ndarray) -> np.ndarray:
    """The cell of a value, by its first bits: values are hashes already."""
    return (values >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def merged(partials: DataFrame) -> np.ndarray:
    """One byte per cell: 0 for none, else four times the logarithm of the count, plus one."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, packed in zip(batch["chunk"].to_pylist(), batch["cells"].to_pylist()):
                counts = np.frombuffer(zlib.decompress(packed), np.uint16).astype(np.uint64)
                total[chunk] = total[chunk] + counts if chunk in total else counts
        levels = [level(x).tobytes() for x in total.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array(levels, pa.binary())],
            names=["chunk", "cells"],
        )

    levels = np.zeros(CELLS, np.uint8).reshape(-1, CHUNK)
    # CELLS / CHUNK rows of CHUNK bytes.
    for row in partials.repartition("chunk").mapInArrow(add_up, FIELDS).collect():
        levels[row.chunk] = np.frombuffer(row.cells, np.uint8)
    return levels.reshape(-1)


def level(counts: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        found = np.floor(4 * np.log2(counts.astype(np.float64))) + 1
    return np.where(counts > 0, np.clip(found, 1, 255), 0).astype(np.uint8)


def sketch_of(values: DataFrame) -> np.ndarray:
    """The merged sketch of a column of long values; nulls count as 0."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Partial()
        for batch in batches:
            own.add(as_values(batch.column(0)))
        yield pa.RecordBatch.from_arrays(list(own.rows()), names=["chunk", "cells"])

    return merged(values.mapInArrow(count, FIELDS))


def as_values(column: pa.Array) -> np.ndarray:
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def without_ids(df: DataFrame, gone: DataFrame, id_col: str) -> DataFrame:
    """The rows of `df` whose id is not in the column `doc_id` of `gone`; null ids stay.

    Rows whose cell of the sketch of gone ids is empty need no join, so only the others are
    shuffled.
    """
    sketch = sketch_of(gone.select(F.xxhash64("doc_id")))
    present = df.sparkSession.sparkContext.broadcast(sketch)

    def picking(wanted: bool):
        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = present.value[cell_of(as_values(batch["key"]))] > 0
                yield batch.filter(pa.array(hit == wanted))

        return pick

    keyed = df.select(F.xxhash64(col(id_col)).alias("key"), F.struct("*").alias("row"))
    sure = keyed.mapInArrow(picking(False), keyed.schema).select("row.*")
    asked = keyed.mapInArrow(picking(True), keyed.schema).select("row.*").alias("l")
    same_id = F.col("l.`" + id_col.replace("`", "``") + "`") == F.col("g.doc_id")
    return sure.unionAll(asked.join(gone.alias("g"), same_id, "left_anti"))
