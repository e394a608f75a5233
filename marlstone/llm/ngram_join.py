"""Documents that share most of their word n-grams, found by rare-first prefix filtering.

A document is the set of its distinct five-word shingles. Two sets can reach the threshold only if
they share one of the first shingles of an order common to all, so only these prefixes are joined.
The order is rare first, by a sketch of how often each shingle occurs in the whole corpus. Pairs
that meet are cut by length and position while they are joined, then by the suffix filter, and
what is left is verified once on the whole texts.

Equal sets are one class from the start, so a group of copies is one set. Near copies in large
groups meet on the same shingles; there each set is first compared with one pivot per shingle, and
only sets still in different components are compared with each other afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marlstone.llm import cell_sketch
from marlstone.llm.cell_sketch import Partial, as_values, cell_of
from marlstone.llm.common import id_and_text, in_slices, staged
from marlstone.llm.connected import components

WORDS = 5
PERCENT = 80
PIVOT_ROUNDS = 2
TABLE_ENTRIES = 500_000
ROWS_AT_ONCE = 200_000
SETS_KEPT = 500
PARTS = 256
FACTOR = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """64-bit hashes of words, each worked out once; started again when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > TABLE_ENTRIES:
            self.clear()
        found = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = found
        return found


_hashes = _Hashes()


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes.

    Only A-Z are lower-cased, and words part at the six ASCII white space characters: both as bytes
    do it. A text with fewer words is one shingle, a text without words has none.
    """
    parts = (text or "").encode("utf-8").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(_hashes.__getitem__, parts), np.uint64, len(parts))
    width = min(words, len(own))
    count = len(own) - width + 1
    # Words are hashes spread over all bits, so a polynomial of them is one too.
    found = own[:count] + np.uint64(width)
    for k in range(1, width):
        found *= FACTOR
        found += own[k : k + count]
    found.sort()
    new = np.ones(count, bool)
    np.not_equal(found[1:], found[:-1], out=new[1:])
    return found[new]


def set_key(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def set_id(key: bytes) -> int:
    """Half of the key, to tell sets apart in the joins; what they link is verified on texts."""
    return int.from_bytes(key[:8], "little", signed=True)


def rare_first(found: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Sorted shingles by how often their cell was counted, then by hash."""
    return found[np.argsort(levels[cell_of(found)], kind="stable")]


def prefix_size(size: int, percent: int = PERCENT) -> int:
    """A partner shares at least percent of a set, so one shingle of any size - that + 1."""
    return size + (-percent * size // 100) + 1


def reaches(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted arrays."""
    need = least_overlap(len(a), len(b), percent)
    return min(len(a), len(b)) >= need <= len(np.intersect1d(a, b, assume_unique=True))


def part_sizes(found: np.ndarray) -> np.ndarray:
    """How many shingles of a set fall between each two of `PARTS` common values."""
    parts = (found >> np.uint64(64 - PARTS.bit_length() + 1)).astype(np.int64)
    return np.bincount(parts, minlength=PARTS).astype("<u4")


def suffix_overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The suffix filter's bound of the overlap: part by part, no more than the smaller has."""
    return np.minimum(a, b).sum(axis=-1)


def least_overlap(size_a, size_b, percent: int):
    """The overlap from which on two sets of these sizes reach the threshold."""
    return -(-percent * (size_a + size_b) // (100 + percent))


def describe_sets(df: DataFrame, words: int = WORDS) -> DataFrame:
    """Staged rows of doc_id, n_shingles, set_key, sid, parts; and each task's sketch beside them."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Partial()
        kind = None
        names = ["doc_id", "n_shingles", "set_key", "sid", "parts", "chunk", "cells"]
        for batch in in_slices(batches, "text"):
            kind = batch["doc_id"].type
            sizes, keys, parts = [], [], []
            for text in batch["text"].to_pylist():
                found = shingles(text, words)
                own.add(found)
                sizes.append(len(found))
                keys.append(set_key(found) if len(found) else None)
                parts.append(part_sizes(found).tobytes() if len(found) else None)
            ids = [k if k is None else set_id(k) for k in keys]
            none = pa.nulls(len(keys))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                    pa.array(ids, pa.int64()), pa.array(parts, pa.binary()),
                    none.cast(pa.int32()), none.cast(pa.binary()),
                ],
                names=names,
            )
        if kind is not None:
            chunk, cells = own.rows()
            none = pa.nulls(len(chunk))
            yield pa.RecordBatch.from_arrays(
                [
                    none.cast(kind), none.cast(pa.int64()), none.cast(pa.binary()),
                    none.cast(pa.int64()), none.cast(pa.binary()), chunk, cells,
                ],
                names=names,
            )

    kind = df.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_shingles bigint, set_key binary, sid bigint, parts binary, "
        + cell_sketch.FIELDS
    )
    return staged(df.mapInArrow(describe, schema), "shingle-sets")


def prefixes(df: DataFrame, levels, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """token, sid, size, pos for each shingle of each prefix; a task leaves out sets it has seen."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, size = [], 0
        for batch in in_slices(batches, "text"):
            for text in batch["text"].to_pylist():
                found = shingles(text, words)
                if not len(found):
                    continue
                sid = set_id(set_key(found))
                if sid in seen:
                    continue
                if len(seen) > TABLE_ENTRIES:
                    seen.clear()
                seen.add(sid)
                front = prefix_size(len(found), percent)
                held.append((rare_first(found, levels.value)[:front], sid, len(found)))
                size += front
                if size > ROWS_AT_ONCE:
                    yield _prefix_rows(held)
                    held, size = [], 0
        if held:
            yield _prefix_rows(held)

    return df.select("text").mapInArrow(cut, "token bigint, sid bigint, size int, pos int")


def _prefix_rows(held: list[tuple[np.ndarray, int, int]]) -> pa.RecordBatch:
    counts = [len(x) for x, _, _ in held]
    columns = [
        pa.array(np.concatenate([x for x, _, _ in held]).view(np.int64)),
        pa.array(np.repeat(np.array([s for _, s, _ in held], np.int64), counts)),
        pa.array(np.repeat(np.array([n for _, _, n in held], np.int32), counts)),
        pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in counts])),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["token", "sid", "size", "pos"])


def may_reach(
    size: Column, pos: Column, other: Column, percent: int, other_pos: Column | None = None
) -> Column:
    """Length and position: what is left of both sets from their first common shingle on."""
    need = percent * (size.cast("long") + other)
    enough = (100 + percent) * (size.cast("long") - pos) >= need
    if other_pos is None:
        return enough
    return (
        enough
        & ((100 + percent) * (other.cast("long") - other_pos) >= need)
        & (100 * F.least(size, other).cast("long") >= percent * F.greatest(size, other))
    )


def members(prefix_rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Staged prefix rows of shingles that several sets share, without sets too far in to match."""
    shared = (
        prefix_rows.groupBy("token")
        .agg(F.min("sid").alias("lo"), F.max("sid").alias("hi"), F.min("size").alias("least"))
        .where("lo <> hi")
        .select("token", "least")
    )
    rows = (
        prefix_rows.join(shared, "token")
        .where(may_reach(F.col("size"), F.col("pos"), F.col("least"), percent))
        .select("token", "sid", "size", "pos")
        .distinct()
    )
    return staged(rows, "shared-shingles")


def pivot_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Each set with one of its shingle's sets: the one that has the shingle furthest in front."""
    pivots = (
        rows.groupBy("token")
        .agg(
            F.min("component").alias("lo"),
            F.max("component").alias("hi"),
            F.min(F.struct("pos", "sid", "size", "component")).alias("p"),
        )
        .where("lo <> hi")
        .select("token", "p.*")
    )
    return _meeting(rows, pivots, percent)


def remaining_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """All pairs from different components. The largest component of a shingle only answers."""
    by_component = rows.groupBy("token", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = (
        by_component.groupBy("token")
        .agg(F.max(F.struct("n", "component")).alias("top"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1")
        .select("token", F.col("top.component").alias("largest"))
    )
    asking = rows.join(largest, "token").where("component <> largest").drop("largest")
    return _meeting(rows, asking, percent)


def _meeting(rows: DataFrame, asking: DataFrame, percent: int) -> DataFrame:
    a, b = rows.alias("a"), asking.alias("b")
    meets = (
        (F.col("a.token") == F.col("b.token"))
        & (F.col("a.component") != F.col("b.component"))
        & may_reach(F.col("a.size"), F.col("a.pos"), F.col("b.size"), percent, F.col("b.pos"))
    )
    return a.join(b, meets).select(
        F.least("a.sid", "b.sid").alias("a"), F.greatest("a.sid", "b.sid").alias("b")
    ).distinct()


def plausible(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The pairs the suffix filter leaves; it needs the part sizes of both sets, not their texts."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "parts_a"):
            if not batch.num_rows:
                continue
            a, b = (
                np.frombuffer(b"".join(batch[c].to_pylist()), "<u4").reshape(-1, PARTS)
                for c in ("parts_a", "parts_b")
            )
            need = least_overlap(a.sum(axis=1, dtype=np.int64), b.sum(axis=1, dtype=np.int64), percent)
            left = batch.filter(pa.array(suffix_overlap(a, b) >= need))
            yield left.select(["a", "b"])

    with_a = pairs.join(parts.select(F.col("sid").alias("a"), F.col("parts").alias("parts_a")), "a")
    both = with_a.join(parts.select(F.col("sid").alias("b"), F.col("parts").alias("parts_b")), "b")
    return both.select("a", "b", "parts_a", "parts_b").mapInArrow(check, "a bigint, b bigint")


def candidate_texts(df: DataFrame, sets: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """Staged sid and text of the sets in `pairs`.

    A sketch of the ids of one document per set keeps the other texts out of the shuffle.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    first = sets.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("doc_id"))
    ids = wanted.join(first, "sid").select(F.xxhash64("doc_id"))
    present = df.sparkSession.sparkContext.broadcast(cell_sketch.sketch_of(ids))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = present.value[cell_of(as_values(batch["key"]))] > 0
            texts = batch["text"].filter(pa.array(hit))
            found = [(set_key(shingles(t, words)), t) for t in texts.to_pylist() if t]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([set_id(k) for k, _ in found], pa.int64()),
                    pa.array([t for _, t in found], pa.string()),
                ],
                names=["sid", "text"],
            )

    texts = df.select(F.xxhash64("doc_id").alias("key"), "text").mapInArrow(
        pick, "sid bigint, text string"
    )
    return staged(
        texts.join(wanted, "sid", "left_semi").dropDuplicates(["sid"]), "candidate-texts"
    )


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose whole texts reach the threshold."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}

        def set_of(sid: int, text: str) -> np.ndarray:
            found = sets.get(sid)
            if found is None:
                if len(sets) >= SETS_KEPT:
                    sets.clear()
                found = sets[sid] = shingles(text, words)
            return found

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("a", "b", "text_a", "text_b")]
            linked = [
                (a, b)
                for a, b, text_a, text_b in zip(*columns)
                if reaches(set_of(a, text_a), set_of(b, text_b), percent)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in linked], pa.int64()) for i in (0, 1)], names=["a", "b"]
            )

    with_a = pairs.join(texts.select(F.col("sid").alias("a"), F.col("text").alias("text_a")), "a")
    both = with_a.join(texts.select(F.col("sid").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(verify, "a bigint, b bigint")


def _search(df: DataFrame, words: int, percent: int):
    """Sets of all documents, the shared prefix rows, and a function that verifies pairs."""
    made = describe_sets(df, words)
    sets = made.where("chunk is null").drop("chunk", "cells")
    levels = cell_sketch.merged(made.where("chunk is not null").select("chunk", "cells"))
    levels = df.sparkSession.sparkContext.broadcast(levels)
    rows = members(prefixes(df, levels, words, percent), percent)
    own = rows.select("sid").distinct()
    known = sets.select("sid", "parts").join(own, "sid", "left_semi").dropDuplicates(["sid"])
    parts = staged(known, "part-sizes")

    def verify(pairs: DataFrame) -> DataFrame:
        left = staged(plausible(pairs, parts, percent), "plausible-pairs")
        if left.isEmpty():
            return left
        texts = candidate_texts(df, sets, left, words)
        return staged(verified(left, texts, words, percent), "links")

    return sets.drop("parts"), rows, verify


def similar_sets(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
    percent: int = PERCENT,
) -> tuple[DataFrame, DataFrame]:
    """All links between different sets, and which document has which set.

    Returns `links` (a, b: set ids, a < b, each link once) and `sets` (doc_id, n_shingles, sid; no
    sid for a document without words, nor for a null text). Documents of one set are linked with each
    other, repeated rows too. Other columns are ignored; an empty table gives two empty ones.
    """
    own = id_and_text(df, id_col, text_col)
    sets, rows, verify = _search(own, words, percent)
    rows = rows.withColumn("component", F.col("sid"))
    return verify(staged(_meeting(rows, rows, percent), "pairs")), sets.drop("set_key")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
    percent: int = PERCENT, pivot_rounds: int = PIVOT_ROUNDS,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Two documents link when percent of the union of their shingle sets is common to both;
    `component_id` is the least id reachable by links, the document's own without any. Null, empty
    and blank texts have no shingles and link with nothing, not even each other. Documents that
    are alike, repeated rows among them, are in one component; null ids do not name a component
    unless it has no other. Other columns are ignored; an empty table gives an empty result.
    """
    own = id_and_text(df, id_col, text_col)
    sets, rows, verify = _search(own, words, percent)
    links = links_for_components(df.sparkSession, rows, verify, percent, pivot_rounds)
    return name_components(sets, components(links))


def links_for_components(
    spark: SparkSession, rows: DataFrame, verify: Callable, percent: int, rounds: int
) -> DataFrame:
    """Links enough to connect whatever is connected by links.

    A pair is left unverified only if both sets are in one component already.
    """
    links = spark.createDataFrame([], "a bigint, b bigint")
    tried = links
    steps: list[Callable] = [*[pivot_pairs] * rounds, remaining_pairs]
    for step, make_pairs in enumerate(steps):
        current = rows.withColumn("component", F.col("sid"))
        if step:
            known = components(links)
            current = rows.join(
                known.withColumnRenamed("node", "sid"), "sid", "left"
            ).withColumn("component", F.coalesce("component", "sid"))
            if make_pairs is remaining_pairs:
                current = staged(current, "members")
        pairs = make_pairs(current, percent)
        if step:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = staged(pairs, "pairs")
        links = links.unionAll(verify(pairs))
        tried = tried.unionAll(pairs)
    return links


def name_components(sets: DataFrame, known: DataFrame) -> DataFrame:
    classes = (
        sets.where("sid is not null")
        .groupBy("set_key", "sid")
        .agg(F.min("doc_id").alias("first"))
        .join(known.withColumnRenamed("node", "sid"), "sid", "left")
        .select("set_key", "first", F.coalesce("component", "sid").alias("component"))
    )
    names = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    named = classes.join(names, "component").select("set_key", "component_id")
    return sets.join(named, "set_key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def one_per_component(df: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of `df` that name their component, with the columns of `df`.

    Rows without words or without an id stay. Rows that share an id stay if one of them does.
    """
    found = staged(near_duplicates(df, id_col=id_col, **options), "near-duplicates")
    stays = F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))
    gone = found.groupBy("doc_id").agg(F.max(stays).alias("stays")).where("not stays")
    return cell_sketch.without_ids(df, staged(gone.select("doc_id"), "gone"), id_col)
