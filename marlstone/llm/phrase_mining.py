"""Phrases whose words stay together, per language.

Two passes over the texts, each in Arrow batches cut into blocks of bounded size:

1. words, pairs and triples of neighbouring words are counted in a sketch of 2^40 cells. Tasks hand
   on the cells they have met, sorted and packed by range, and the ranges are added up side by side.
   The cells that counted as many as a phrase needs go on as the bits of a filter, which grows with
   their number;
2. words and pairs the filter lets through, and triples it lets through with both their pairs, are
   candidates. No phrase that is frequent enough is lost, as a cell never counts less than one of
   its phrases. A task adds up its candidates and deals them, with their counts, into shards.

Each shard becomes one double-array trie per language in the task that holds it: the counts all tasks
found are summed at the nodes, all phrases of the shard walking at once. A triple goes to the shard
of its last two words, so their count is read off the same trie; its first two words and its single
words follow by joins. The texts are read twice however many candidates there are, and no table of
phrases is sent to the driver or to all tasks. What lies inside what follows by one join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from marlstone.llm import double_array
from marlstone.llm.common import col, in_slices, shuffle_partitions, staged

UNKNOWN = "und"
SPACES, BREAKS = b"\t", b".,;:!?\n\x0b\x0c\r"
UPPER = bytes(range(65, 91))
# Upper case to lower, white space to blanks, whatever ends a piece to line feeds.
PLAIN = bytes.maketrans(UPPER + SPACES + BREAKS, UPPER.lower() + b" " + b"\n" * len(BREAKS))

LONGEST = 3
LEAST_COUNT, INSIDE_PERCENT, BEST = 10, 50, 2000
# Bytes of text worked on at once.
BLOCK = 4 << 20
# Cells of the sketch and ranges they are added up in, as powers of two; a cell counts up to 255.
SKETCH_BITS, RANGE_BITS, MOST = 40, 12, 255
# Cells a task gathers, and phrases, before it hands them on.
HELD_CELLS, HELD_ROWS = 1 << 23, 1 << 20
# Bits of the filter, for each frequent cell and as a power of two at most.
BITS_EACH, CELL_BITS = 32, 31
# Phrases of a shard, about 60 bytes each while its trie is built.
SHARD_PHRASES = 1 << 21
WORDS = ["w1", "w2", "w3"]


def phrases(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least_count: int = LEAST_COUNT,
    inside_percent: int = INSIDE_PERCENT,
    best: int = BEST,
    cell_bits: int = CELL_BITS,
    shard_phrases: int = SHARD_PHRASES,
) -> DataFrame:
    """The first `best` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut into pieces at `.,;:!?` and line ends, and pieces into words at
    blanks and tabs. A phrase of two or three words counts if it occurs `least_count` times or
    more (`a`); `l` and `r` count the parts of its weakest cut, `n` all words. A phrase inside a
    longer one is left out if that occurs at least `inside_percent` as often. Ties go by `a`, then
    by the phrase in byte order. A null text has no words, a null language is `und`; repeated rows
    count again; other columns are ignored; an empty table gives an empty result. `cell_bits` and
    `shard_phrases` bound memory and change no result.
    """
    texts = df.select(
        F.coalesce(col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    totals, frequent, cells = _sketched(texts, least_count, cell_bits)
    shards = max(shuffle_partitions(df.sparkSession), -(-cells // shard_phrases))
    counted = staged(_counted(texts, frequent, shards, least_count), "phrases")
    # Read four times from here on.
    found = staged(_with_parts(counted), "phrase-parts")
    return _scored(found, totals, inside_percent, best)


@dataclass
class Block:
    """Words of some pieces of one language, as numbers of `words`, and which end a piece."""

    lang: str
    words: pa.Array
    number: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, lang: str, raw: bytes) -> Block | None:
        letters = np.frombuffer(raw, np.uint8)
        line_ends = letters == 10
        inside = ~(line_ends | (letters == 32))
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(starts):
            return None
        offsets = np.concatenate([[0], np.cumsum(stops - starts)])
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(letters[inside])]
        found = pa.Array.from_buffers(pa.large_string(), len(starts), buffers).dictionary_encode()
        piece = np.cumsum(line_ends)[starts]
        ends = np.append(piece[1:] != piece[:-1], True)
        number = found.indices.to_numpy().astype(np.int64)
        return cls(lang, found.dictionary.cast(pa.string()), number, ends)

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """Where a pair begins, and which of these places begin a triple too."""
        pair = np.flatnonzero(~self.ends)
        return pair, ~self.ends[np.minimum(pair + 1, len(self.ends) - 1)]

    def hashed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of `words`, of the pairs, of the triples that begin where a pair does, and where
        one does.

        A hash is two numbers, a column each. A place without a triple has the hash of nothing.
        """
        seed = np.uint64(xxhash.xxh64_intdigest(self.lang))
        raw = b"".join(map(xxhash.xxh3_128_digest, self.words.cast(pa.binary()).to_pylist()))
        word = np.frombuffer(raw, np.uint64).reshape(-1, 2)
        one, own = _mix(word + seed), word[self.number]
        pair, long = self.neighbours()
        mixed = one[self.number[pair]] + own[pair + 1]
        third = own[np.minimum(pair + 2, len(own) - 1)]
        return _mix(one), _mix(mixed), _mix(_mix(mixed) + third), long


def _cells(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of the filter for each cell of the sketch."""
    wanted = np.uint64((1 << bits) - 1)
    return (hashes & wanted).astype(np.int64), (_mix(hashes) & wanted).astype(np.int64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """The texts in blocks of one language, cut where a piece ends."""
    for batch in in_slices(batches, "text", BLOCK):
        by_language: dict[str, list[bytes]] = {}
        texts = batch["text"].cast(pa.binary()).to_pylist()
        for lang, text in zip(batch["lang"].to_pylist(), texts):
            by_language.setdefault(lang, []).append(text)
        for lang, some in by_language.items():
            raw = b"\n".join(some).translate(PLAIN)
            begin = 0
            while begin < len(raw):
                end = len(raw)
                if end - begin > 2 * BLOCK:
                    cut = raw.find(b"\n", begin + BLOCK)
                    end = end if cut < 0 else cut + 1
                made = Block.of(lang, raw[begin:end])
                if made is not None:
                    yield made
                begin = end


class _Held:
    """Phrases a task has found, each once with its count, until they are handed on by shard.

    Phrases are told apart by 128 bits of hash.
    """

    def __init__(self, shards: int):
        self.shards = shards
        self._empty()

    def _empty(self) -> None:
        self.first, self.second = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.row, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.tables: list[pa.Table] = []

    def add(self, block: Block, hashes, counts, deal, words: list[np.ndarray]) -> None:
        """Phrases of a block: hashes, counts, what to deal them by, and their words' numbers.

        No hash comes twice.
        """
        place = np.minimum(np.searchsorted(self.first, hashes[:, 0]), max(len(self.first) - 1, 0))
        new = np.ones(len(hashes), bool)
        if len(self.first):
            new = (self.first[place] != hashes[:, 0]) | (self.second[place] != hashes[:, 1])
        self.n[self.row[place[~new]]] += counts[~new]
        if not new.any():
            return
        rows = len(self.n) + np.arange(new.sum())
        first = np.concatenate([self.first, hashes[new, 0]])
        order = np.argsort(first, kind="stable")
        self.first = first[order]
        self.second = np.concatenate([self.second, hashes[new, 1]])[order]
        self.row = np.concatenate([self.row, rows])[order]
        self.n = np.concatenate([self.n, counts[new]])
        columns = {"shard": (deal[new] >> np.uint64(20)) % np.uint64(self.shards)}
        columns["lang"] = pa.repeat(pa.scalar(block.lang, pa.string()), len(rows))
        for name, numbers in zip(WORDS, words):
            columns[name] = block.words.take(pa.array(numbers[new]))
        for name in WORDS[len(words) :]:
            columns[name] = pa.nulls(len(rows), pa.string())
        self.tables.append(pa.table(columns))

    def rest(self) -> Iterator[pa.RecordBatch]:
        if len(self.n):
            rows = pa.concat_tables(self.tables).append_column("n", pa.array(self.n))
            shard = rows["shard"].to_numpy().astype(np.int64)
            # Phrases that begin alike side by side, as they pack well.
            begin = rows["w1"].combine_chunks().dictionary_encode()
            order = np.argsort(shard * len(begin.dictionary) + begin.indices.to_numpy())
            rows = rows.drop_columns(["shard"]).take(pa.array(order)).combine_chunks()
            found, starts = np.unique(shard[order], return_index=True)
            ends = np.append(starts[1:], rows.num_rows)
            packed = [_packed(rows.slice(a, b - a)) for a, b in zip(starts, ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.astype(np.int32)), pa.array(packed, pa.binary())],
                names=["shard", "packed"],
            )
        self._empty()


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, rows.schema, options=options) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(packed: bytes) -> pa.Table:
    with pa.ipc.open_stream(packed) as stream:
        return stream.read_all()


def _added(cells: list[np.ndarray]) -> np.ndarray:
    """Cells and counts, as `cell * 256 + count`, with each cell once, in order."""
    rows = np.concatenate(cells)
    rows.sort()
    own = rows >> np.uint64(8)
    first = np.flatnonzero(np.diff(own, prepend=~own[:1]))
    sums = np.add.reduceat(rows & np.uint64(MOST), first) if len(first) else first
    return own[first] << np.uint64(8) | np.minimum(sums, MOST).astype(np.uint64)


def _sketched(
    texts: DataFrame, least: int, bits: int
) -> tuple[DataFrame, np.ndarray, int]:
    """Words per language, the filter of frequent cells as bits, and how many such cells there are."""
    own_bits = SKETCH_BITS - RANGE_BITS
    schema = pa.schema(
        [("lang", pa.string()), ("n", pa.int64()), ("range", pa.int32()), ("cells", pa.binary())]
    )

    def hand_on(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        number = (rows >> np.uint64(8 + own_bits)).astype(np.int32)
        found, starts = np.unique(number, return_index=True)
        packed = [_sparse(some, own_bits) for some in np.split(rows, starts[1:])]
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(len(found), pa.string()), pa.nulls(len(found), pa.int64()),
                pa.array(found), pa.array(packed, pa.binary()),
            ],
            schema=schema,
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, size = {}, [], 0
        for block in blocks(batches):
            words[block.lang] = words.get(block.lang, 0) + len(block.number)
            one, two, three, long = block.hashed()
            often = np.minimum(np.bincount(block.number, minlength=len(one)), MOST)
            held.append(_cell(one) << np.uint64(8) | often.astype(np.uint64))
            both = np.concatenate([two[:, 0], three[long, 0]])
            held.append(_cell(both) << np.uint64(8) | np.uint64(1))
            size += len(one) + len(both)
            if size > HELD_CELLS:
                held = [_added(held)]
                size = len(held[0])
                if size > HELD_CELLS // 2:
                    yield from hand_on(held[0])
                    held, size = [], 0
        if size:
            yield from hand_on(_added(held))
        for lang, n in words.items():
            row = {"lang": lang, "n": n, "range": -1}
            yield pa.RecordBatch.from_pylist([row], schema=schema)

    def frequent(cells: list[np.ndarray]) -> bytes:
        # A task counts up to 255, so a sum that reaches it need not go on.
        rows = _added(cells)
        return _sparse(rows[(rows & np.uint64(MOST)) >= min(least, MOST)], own_bits)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size = None, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["range"] < 0:
                    yield pa.RecordBatch.from_pylist([row], schema=schema)
                    continue
                if row["range"] != now and held:
                    yield pa.RecordBatch.from_pylist(
                        [{"range": now, "cells": frequent(held)}], schema=schema
                    )
                    held, size = [], 0
                now = row["range"]
                held.append(_dense(row["cells"]))
                size += len(held[-1])
                if size > HELD_CELLS:
                    held, size = [_added(held)], 0
        if held:
            yield pa.RecordBatch.from_pylist(
                [{"range": now, "cells": frequent(held)}], schema=schema
            )

    fields = "lang string, n long, range int, cells binary"
    dealt = texts.mapInArrow(count, fields).repartition("range").sortWithinPartitions("range")
    made = staged(dealt.mapInArrow(merge, fields), "sketch")
    # About three bytes for each frequent cell come to the driver.
    found = made.where("range >= 0").select("range", "cells").collect()
    cells = [
        _dense(row.cells) >> np.uint64(8) | np.uint64(row.range) << np.uint64(own_bits)
        for row in found
    ]
    number = sum(map(len, cells))
    bits = min(bits, max(16, (BITS_EACH * number).bit_length()))
    flags = np.zeros(1 << max(bits - 3, 0), np.uint8)
    for some in cells:
        for at in _cells(some, bits):
            np.bitwise_or.at(flags, at >> 3, np.uint8(128) >> (at & 7).astype(np.uint8))
    totals = made.where("range < 0").groupBy("lang").agg(F.sum("n").alias("n"))
    return totals, flags, number


def _cell(hashes: np.ndarray) -> np.ndarray:
    """The cell of the sketch a hash falls into: its first bits."""
    first = hashes[:, 0] if hashes.ndim == 2 else hashes
    return first >> np.uint64(64 - SKETCH_BITS)


ZSTD = pa.Codec("zstd", 1)


def _sparse(rows: np.ndarray, own_bits: int) -> bytes:
    """Cells of one range and their counts, in order: steps from cell to cell, byte by byte."""
    own = (rows >> np.uint64(8)) & np.uint64((1 << own_bits) - 1)
    steps = np.diff(own, prepend=np.uint64(0)).astype(np.uint32)
    planes = steps.view(np.uint8).reshape(-1, 4).T
    counts = (rows & np.uint64(MOST)).astype(np.uint8)
    return ZSTD.compress(planes.tobytes() + counts.tobytes(), asbytes=True)


def _dense(packed: bytes) -> np.ndarray:
    """What `_sparse` has packed, the range left off."""
    raw = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(5, -1)
    steps = np.ascontiguousarray(raw[:4].T).view(np.uint32).ravel()
    return np.cumsum(steps, dtype=np.uint64) << np.uint64(8) | raw[4]


def _counted(texts: DataFrame, frequent: np.ndarray, shards: int, least: int) -> DataFrame:
    """Words and phrases that occur `least` times or more: lang, words, a, `last`.

    `last` says how often the last two words of a triple occur.
    """
    bits = (len(frequent) * 8).bit_length() - 1
    shared = texts.sparkSession.sparkContext.broadcast(frequent)

    def may_be(hashes: np.ndarray) -> np.ndarray:
        first, second = (
            (shared.value[c >> 3] >> (7 - (c & 7))) & 1 for c in _cells(_cell(hashes), bits)
        )
        return (first & second).astype(bool)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(shards)
        for block in blocks(batches):
            one, two, three, long = block.hashed()
            at = np.flatnonzero(may_be(one))
            often = np.bincount(block.number, minlength=len(one))
            held.add(block, one[at], often[at], one[at, 0], [at])
            pair, _ = block.neighbours()
            safe = may_be(two)
            # The pair that begins one word later is the next of the list.
            triple = safe & long & np.append(safe[1:], False)
            triple[triple] = may_be(three[triple])
            for found, hashes, size in ((safe, two, 2), (triple, three, 3)):
                at = np.flatnonzero(found)
                at = at[np.argsort(hashes[at, 0])]
                heads = np.any(np.diff(hashes[at], axis=0, prepend=~hashes[at][:1]) != 0, axis=1)
                heads = np.flatnonzero(heads)
                often = np.diff(np.append(heads, len(at)))
                at = at[heads]
                words = [block.number[pair[at] + n] for n in range(size)]
                held.add(block, hashes[at], often, two[at + size - 2, 0], words)
            if len(held.n) > HELD_ROWS:
                yield from held.rest()
        yield from held.rest()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tables, rows = None, [], 0
        for batch in batches:
            for shard, some in zip(batch["shard"].to_pylist(), batch["packed"].to_pylist()):
                if shard != now and tables:
                    yield from _shard_counts(tables, least)
                    tables, rows = [], 0
                now = shard
                tables.append(_unpacked(some))
                rows += tables[-1].num_rows
                if rows > 2 * HELD_ROWS:
                    tables, rows = [_summed(tables)], 0
        if tables:
            yield from _shard_counts(tables, least)

    dealt = texts.mapInArrow(find, "shard int, packed binary").repartition("shard")
    fields = "lang string, w1 string, w2 string, w3 string, a long, last long"
    return dealt.sortWithinPartitions("shard").mapInArrow(merge, fields)


def _summed(tables: list[pa.Table]) -> pa.Table:
    """Tables of phrases and counts as one, with each phrase once."""
    keys = ["lang", *WORDS]
    found = pa.concat_tables(tables).group_by(keys).aggregate([("n", "sum")])
    return found.select([*keys, "n_sum"]).rename_columns([*keys, "n"])


def _shard_counts(tables: list[pa.Table], least: int) -> Iterator[pa.RecordBatch]:
    """The frequent phrases of a shard, counted at the nodes of a trie per language."""
    rows = pa.concat_tables(tables).sort_by("lang").combine_chunks()
    langs = rows["lang"].combine_chunks().dictionary_encode()
    starts = np.unique(langs.indices.to_numpy(), return_index=True)[1]
    for start, end in zip(starts, np.append(starts[1:], rows.num_rows)):
        some = rows.slice(start, end - start)
        columns = [some[name].combine_chunks() for name in WORDS]
        trie = double_array.build(columns, np.arange(1, some.num_rows + 1))
        one, two, three = (trie.symbols(column) for column in columns)
        states = trie.walk([one])
        for deeper in (two, three):
            going = deeper > 0
            states[going] = trie.walk([deeper[going]], states[going])
        nodes = np.zeros(len(trie.base), np.int64)
        np.add.at(nodes, states, some["n"].to_numpy())
        # Each phrase once, whichever of its rows gave the trie its number.
        at = trie.phrase[trie.phrase > 0].astype(np.int64) - 1
        at = np.sort(at[nodes[states[at]] >= least])
        # The last two words of a triple are a phrase of this shard themselves.
        last = nodes[np.maximum(trie.walk([two[at], three[at]]), 0)]
        found = some.select(["lang", *WORDS]).take(pa.array(at))
        found = found.append_column("a", pa.array(nodes[states[at]]))
        last = pa.array(last, mask=three[at] == 0)
        yield from found.append_column("last", last).to_batches(1 << 16)


def _with_parts(counted: DataFrame) -> DataFrame:
    """The phrases with the counts of their parts: lang, words, a, l1, r1, l2, r2."""
    words = counted.where("w2 is null")
    first = words.select("lang", "w1", F.col("a").alias("l1"))
    end = words.select("lang", F.col("w1").alias("end"), F.col("a").alias("of_end"))
    pairs = counted.where("w2 is not null and w3 is null")
    heads = pairs.select("lang", "w1", "w2", F.col("a").alias("l2"))
    triples = counted.where("w3 is not null").join(heads, ["lang", "w1", "w2"])
    both = triples.unionByName(pairs, allowMissingColumns=True)
    both = both.withColumn("end", F.coalesce("w3", "w2"))
    joined = both.join(first, ["lang", "w1"]).join(end, ["lang", "end"])
    long = F.col("w3").isNotNull()
    return joined.select(
        "lang", *WORDS, "a", "l1",
        F.when(long, F.col("last")).otherwise(F.col("of_end")).alias("r1"),
        "l2",
        F.when(long, F.col("of_end")).alias("r2"),
    )


def _scored(
    found: DataFrame, totals: DataFrame, inside_percent: int, best: int
) -> DataFrame:
    """Scores of the weakest cuts, phrases inside longer ones left out, the first of each language."""

    def cut(n: int):
        a, left, right = (F.col(c).cast("decimal(15,0)") for c in ("a", f"l{n}", f"r{n}"))
        above = F.lit(1_000_000).cast("decimal(7,0)") * (a * a).cast("decimal(31,0)")
        score = F.call_function("div", above, (left * right).cast("decimal(31,0)"))
        return F.struct(
            score.alias("score"), F.col(f"l{n}").alias("l"), F.col(f"r{n}").alias("r")
        )

    first, second = cut(1), cut(2)
    weakest = F.when(second["score"] < first["score"], second).otherwise(first)
    scored = found.withColumn("cut", weakest).select(
        "lang", *WORDS, "a", "cut.l", "cut.r", "cut.score"
    )
    triples = found.where("w3 is not null")
    inside = (
        triples.select("lang", "w1", "w2", F.col("a").alias("longer"))
        .unionAll(triples.select("lang", "w2", "w3", "a"))
        .groupBy("lang", "w1", "w2")
        .agg(F.max("longer").alias("longer"))
    )
    covered = F.coalesce(F.col("longer") * 100 >= F.col("a") * inside_percent, F.lit(False))
    pairs = scored.where("w3 is null").join(inside, ["lang", "w1", "w2"], "left")
    alone = pairs.where(~covered).select(*scored.columns)
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (
        alone.unionByName(scored.where("w3 is not null"))
        .withColumn("phrase", F.concat_ws(" ", *WORDS))
        .withColumn("rank", F.row_number().over(place).cast("long"))
        .where(F.col("rank") <= best)
    )
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
