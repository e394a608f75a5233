"""Documents packed into token sequences of one length with minimum bin slack.

A document is cut into full windows and a remainder. Remainders are packed by their lengths alone,
of which there are fewer than the window is long: for each window the longest remaining length is
taken, and a subset-sum over bits of the remaining multiset, traced back to counts, finds what
fills the window closest to its capacity. The found filling is used as often as the counts allow.
So the plan depends on the histogram of lengths, a table bounded by the window, not on how many
documents there are. Each piece then looks its place up by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from marlstone.llm.byte_bpe import default_path, encoder
from marlstone.llm.common import id_and_text, in_slices, shuffle_partitions, staged

WINDOW = 2048
END_ID = 1


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length come closest to `room` from below.

    Bit s of a set tells whether some choice adds up to s. Counts go in by powers of two, and the
    sets before each step are kept to trace the best sum back.
    """
    mask = (1 << (room + 1)) - 1
    sums, steps = 1, []
    for size in sorted((s for s in counts if s <= room and counts[s]), reverse=True):
        left, some = min(counts[size], room // size), 1
        while left:
            some = min(some, left)
            left -= some
            steps.append((size, some, sums))
            sums |= (sums << (size * some)) & mask
            some *= 2
        if sums >> room & 1:
            break
    at, used = sums.bit_length() - 1, {}
    for size, some, before in reversed(steps):
        if not before >> at & 1:
            used[size] = used.get(size, 0) + some
            at -= size * some
    return used


def plan(histogram: dict[int, int], window: int) -> list[tuple[int, ...]]:
    """Rows of (length, first rank, first sequence, uses per sequence, offset, padded length).

    Ranks of a length from the first one on, as far as the next row of this length, go `uses` to a
    sequence. Every filling uses a length up to below its number of uses, so there are at most
    window * log2(window) fillings.
    """
    left = {size: n for size, n in histogram.items() if n}
    taken = dict.fromkeys(left, 0)
    rows, sequence = [], 0
    while left:
        longest = max(left)
        left[longest] -= 1
        used = fullest(left, window - longest)
        left[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        times = min(left[size] // n for size, n in used.items())
        offset, filled = 0, sum(size * n for size, n in used.items())
        padded = filled if filled & (filled - 1) == 0 else window
        for size in sorted(used, reverse=True):
            rows.append((size, taken[size], sequence, used[size], offset, padded))
            offset += size * used[size]
            taken[size] += times * used[size]
            left[size] -= times * used[size]
            if not left[size]:
                del left[size]
        sequence += times
    return rows


def cut_into_pieces(
    df: DataFrame, id_col: str, text_col: str, tokenizer: str, window: int, end_id: int
) -> DataFrame:
    """Pieces of at most a window, staged: key, doc_id, start, length, doc_tokens, ids, crc."""
    rows = id_and_text(df, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = encoder(tokenizer)
        key = TaskContext.get().partitionId() << 33
        for batch in in_slices(batches, "text"):
            ids, ends = with_end_ids(*table.encode_array(batch["text"]), end_id)
            begins = np.concatenate([[0], ends[:-1]])
            total = ends - begins
            many = -(-total // window)
            doc = np.repeat(np.arange(len(ends)), many)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)) * window
            at = begins[doc] + start
            length = np.minimum(total[doc] - start, window)
            raw = memoryview(ids).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at, at + length)]
            # The pieces lie one after the other, as they are cut.
            bounds = np.append(at, len(ids)) * 4
            body = pa.Array.from_buffers(
                pa.large_binary(), len(doc), [None, pa.py_buffer(bounds), pa.py_buffer(ids)]
            )
            keys = np.arange(key, key + len(doc))
            key += len(doc)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    batch["doc_id"].take(pa.array(doc, pa.int64())),
                    *(pa.array(x, pa.int64()) for x in (start, length, total[doc])),
                    body.cast(pa.binary()),
                    pa.array(crc, pa.int64()),
                ],
                names=["key", "doc_id", "start", "length", "doc_tokens", "ids", "ids_crc32"],
            )

    schema = (
        f"key bigint, doc_id {kind}, start bigint, length bigint, doc_tokens bigint, ids binary, "
        "ids_crc32 bigint"
    )
    return staged(rows.mapInArrow(cut, schema), "pieces")


def with_end_ids(
    ids: np.ndarray, ends: np.ndarray, end_id: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ids as 32-bit integers with one more behind each document, and where these end."""
    ends = ends + np.arange(1, len(ends) + 1)
    out = np.empty(len(ids) + len(ends), "<u4")
    own = np.ones(len(out), bool)
    own[ends - 1] = False
    out[own] = ids
    out[ends - 1] = end_id
    return out, ends


def ranked(pieces: DataFrame) -> DataFrame:
    """`key`, `length` and the rank among the pieces of one length, counted from 0.

    A length may hold a third of all pieces, so its ranks are counted in many shares and put
    after one another; the shares of one length are few rows.
    """
    shares = 4 * shuffle_partitions(pieces.sparkSession)
    shared = pieces.select(
        "key", "length", F.pmod(F.xxhash64("key"), F.lit(shares)).alias("share")
    )
    before = Window.partitionBy("length").orderBy("share").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        shared.groupBy("length", "share")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("length", "share", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    own = Window.partitionBy("length", "share").orderBy("key")
    return (
        shared.withColumn("rank", F.row_number().over(own) - 1)
        .join(starts, ["length", "share"])
        .select("key", "length", (F.col("first") + F.col("rank")).alias("rank"))
    )


def pack(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    window: int = WINDOW,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, padded_length,
    ids (little-endian 32-bit, binary), ids_crc32.

    Each text is encoded and closed by the end id; a null text counts as empty and holds that id
    alone. `offset` is the piece's place in its sequence, from 0 without gaps. A sequence is padded
    to the window, but for one that is a power of two long. Repeated rows are packed each for
    itself. Other columns are ignored. An empty table gives an empty result.
    """
    pieces = cut_into_pieces(df, id_col, text_col, tokenizer or default_path(), window, end_id)
    # One row per length, so at most as many as the window is long.
    histogram = dict(
        pieces.groupBy("length").agg(F.count(F.lit(1))).toPandas().itertuples(index=False)
    )
    rows = np.array(plan(histogram, window), np.int64).reshape(-1, 6)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    length, first, sequence, uses, offset, padded = rows.T
    keys = (length << 48) + first

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, rank = np.array(batch["length"]), np.array(batch["rank"])
            row = np.searchsorted(keys, (own << 48) + rank, side="right") - 1
            behind = rank - first[row]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["key"],
                    pa.array(sequence[row] + behind // uses[row], pa.int64()),
                    pa.array(offset[row] + behind % uses[row] * own, pa.int64()),
                    pa.array(padded[row], pa.int64()),
                ],
                names=["key", "sequence_id", "offset", "padded_length"],
            )

    schema = "key bigint, sequence_id bigint, offset bigint, padded_length bigint"
    places = ranked(pieces).mapInArrow(place, schema)
    return pieces.join(places, "key").drop("key")
