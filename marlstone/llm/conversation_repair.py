"""Conversations brought into a well-formed order of roles by the cheapest edits.

Turns are range-partitioned by conversation and turn, so a conversation of any length is shared
out over tasks, and sorted in each partition. A conversation that begins and ends inside one
partition is repaired there and then, as its turns stream by. The others, at most two a partition
and those too long to hold, are handed on: which of their turns repeat an earlier one is found by
an aggregate, stretches of bounded length are searched apart (`edit_lattice.stretch`) and joined,
and a last pass applies the edits to the sorted turns without holding them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from marlstone.llm import edit_lattice as lattice
from marlstone.llm.common import SPACES, col, shuffle_partitions, staged

# A conversation is held in a task up to here.
HELD_CHARS = 8 << 20
# Turns searched at once in a conversation that is not, as a power of two.
STRETCH_BITS = 12
ROLE_OF = {"s": "system", "u": "user", "a": "assistant"}

SUMMARY = {
    "gaps": "long", "blank": "long", "duplicate": "long", "truncated": "long", "illegal": "long",
    "cost": "long", "audit": "string", "repaired_sha256": "string",
}
COUNTS = ("blank", "duplicate", "truncated", "illegal")
FOUND = (*COUNTS, "cost", "audit")
NOTHING = {**dict.fromkeys(FOUND, 0), "audit": ""}
# What a row of the written table is.
SUMMARY_ROW, REPAIRED_TURN, HANDED_ON = range(3)
# Places before the first turn, in the last pass.
EDITS_AT, NAME_AT = -2, -1


def repaired_conversations(
    df: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    present: Column | None = None,
    with_turns: bool = False,
    held_chars: int = HELD_CHARS,
    stretch_bits: int = STRETCH_BITS,
) -> tuple[DataFrame, DataFrame]:
    """Two tables: one row per conversation, and one row per repaired turn.

    The first has the id, the faults found (gaps, blank, duplicate, truncated, illegal), the cost
    and the initials of the edits in order (audit) and the digest of the repaired `role:text`
    lines; the second, empty unless `with_turns`, the id, place from 0, edit (K, R or I), role and
    text of each repaired turn.

    Turns go by `turn_col` cast to long, nulls first, then by role and text; rows alike in all
    four are repeats. A null role or text counts as one space, rows with a null id are one
    conversation. Rows where `present` is not true only name their conversation, which has zeros,
    no edits and the digest of nothing if it has no other row. Other columns are ignored; an
    empty table gives empty results. `held_chars` and `stretch_bits` bound memory and change no
    result.
    """
    rows = df.select(
        col(id_col).alias("conv_id"),
        F.coalesce(present if present is not None else F.lit(True), F.lit(False)).alias("present"),
        F.expr("try_cast(`" + turn_col.replace("`", "``") + "` as long)").alias("turn"),
        F.coalesce(col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(col(text_col).cast("string"), F.lit(" ")).alias("text"),
        # Sets rows alike in all else apart, so that they need not meet in one task.
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["conv_id", "turn", "role", "text", "row"]
    parts = shuffle_partitions(df.sparkSession)
    fields = T.StructType([T.StructField("kind", T.IntegerType()), rows.schema["conv_id"]])
    for name, kind in (
        ("at", "long"), ("turn", "long"), ("edit", "string"), ("role", "string"),
        ("text", "string"), ("sign", "string"), *SUMMARY.items(),
    ):
        fields = fields.add(name, kind)
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("row")
    first = staged(ordered.mapInArrow(_whole_ones(fields, with_turns, held_chars), fields), "conversations")
    handed_on = first.where(F.col("kind") == HANDED_ON)
    last = _long_ones(handed_on, fields, parts, with_turns, stretch_bits)
    done = first.where(F.col("kind") != HANDED_ON).unionAll(last)
    summary = done.where(F.col("kind") == SUMMARY_ROW).select("conv_id", *SUMMARY)
    turns = done.where(F.col("kind") == REPAIRED_TURN)
    return summary, turns.select("conv_id", F.col("at").alias("place"), "edit", "role", "text")


def fault_in(text: str) -> int:
    """Blank, truncated or fine, by the last character that is no space."""
    body = text.rstrip(SPACES)
    if not body:
        return lattice.BLANK
    return lattice.FINE if body[-1] in ".!?" else lattice.TRUNCATED


class _Output:
    """Rows of the written table, given out a few thousand at a time."""

    def __init__(self, schema: T.StructType):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.schema = to_arrow_schema(schema)
        self.rows: list[dict] = []
        self.size = 0

    def add(self, kind: int, conv_id, **values) -> None:
        self.rows.append({"kind": kind, "conv_id": conv_id, **values})
        self.size += 200 + len(values.get("text") or "")

    def full(self) -> bool:
        return self.size > 4 << 20

    def batch(self) -> pa.RecordBatch:
        made = pa.RecordBatch.from_pylist(self.rows, schema=self.schema)
        self.rows, self.size = [], 0
        return made


class _Gaps:
    """Turn numbers missing between the first and the last, from numbers in order."""

    def __init__(self):
        self.first = self.last = None
        self.distinct = 0

    def see(self, turn: int | None) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.distinct += 1

    def count(self) -> int:
        return 0 if self.first is None else self.last - self.first + 1 - self.distinct


class _Repaired:
    """Applies edits to turns as they come: their new roles, and the digest of the outcome."""

    def __init__(self, audit: str):
        self.edits = iter(audit)
        self.state = lattice.START
        self.digest = hashlib.sha256()
        self.place = 0

    def _give(self, edit: str, role: str, text: str):
        line = f"{role}:{text}" if self.place == 0 else f"\n{role}:{text}"
        self.digest.update(line.encode("utf-8"))
        self.place += 1
        return {"at": self.place - 1, "edit": edit, "role": role, "text": text}

    def _wanted(self, edit: str, text: str):
        role = ROLE_OF[lattice.WANTED[self.state]]
        self.state = lattice.NEXT[self.state]
        return self._give(edit, role, text)

    def turn(self, role: str, text: str) -> Iterator[dict]:
        """What comes of the next turn, inserts before it included."""
        for edit in self.edits:
            if edit == lattice.INSERT:
                yield self._wanted(edit, "")
                continue
            if edit == lattice.REROLE:
                yield self._wanted(edit, text)
            elif edit == lattice.KEEP:
                self.state = lattice.STEPS[role[0], self.state]
                yield self._give(edit, role, text)
            return

    def end(self) -> Iterator[dict]:
        for edit in self.edits:
            yield self._wanted(edit, "")


def _whole_ones(schema: T.StructType, with_turns: bool, held_chars: int):
    """Repairs the conversations that lie inside a partition, hands on the turns of the others."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Output(schema)
        at = TaskContext.get().partitionId() << 40
        border = True  # the first conversation may have begun in the partition before
        held: list[tuple] = []
        size, now, begun = 0, None, False

        def hand_on():
            for place, present, turn, role, text in held:
                sign = lattice.sign(role, fault_in(text)) if present else None
                out.add(HANDED_ON, now, at=place, turn=turn, role=role, text=text, sign=sign)

        for batch in batches:
            for conv_id, present, turn, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if begun and conv_id != now:
                    if border:
                        hand_on()
                    else:
                        _finish(out, now, held, with_turns)
                    held, size, border = [], 0, False
                now, begun = conv_id, True
                held.append((at, present, turn, role, text))
                at += 1
                size += len(text) + 200
                if size > held_chars:
                    hand_on()
                    held, size, border = [], 0, True
                if out.full():
                    yield out.batch()
        hand_on()
        yield out.batch()

    return work


def _finish(out: _Output, conv_id, held: list[tuple], with_turns: bool) -> None:
    gaps, seen, signs, turns = _Gaps(), set(), [], []
    for _, present, turn, role, text in held:
        if not present:
            continue
        gaps.see(turn)
        fault = fault_in(text)
        if fault != lattice.BLANK and (role, text) in seen:
            fault = lattice.DUPLICATE
        seen.add((role, text))
        signs.append(lattice.sign(role, fault))
        turns.append((role, text))
    found = lattice.repair("".join(signs))
    repaired = _Repaired(found.audit)
    for row in chain(*(repaired.turn(*turn) for turn in turns), repaired.end()):
        if with_turns:
            out.add(REPAIRED_TURN, conv_id, **row)
    out.add(
        SUMMARY_ROW, conv_id, gaps=gaps.count(), repaired_sha256=repaired.digest.hexdigest(),
        **found._asdict(),
    )


def _long_ones(
    turns: DataFrame, fields: T.StructType, parts: int, with_turns: bool, stretch_bits: int
) -> DataFrame:
    """Repairs the conversations handed on, whose turns lie in several partitions."""
    present = turns.where("sign is not null")
    said = present.groupBy("conv_id", "role", F.sha2("text", 256)).agg(F.min("at").alias("at"))
    signs = present.select("conv_id", "at", "sign").join(
        said.select("at", F.lit(True).alias("first_said")), "at", "left"
    )
    number = F.ascii("sign") - 65
    repeats = F.col("first_said").isNull() & (number % 4 != lattice.BLANK)
    duplicate = F.char((number - number % 4 + lattice.DUPLICATE + 65).cast("long"))
    stretches = (
        signs.withColumn("sign", F.when(repeats, duplicate).otherwise(F.col("sign")))
        .groupBy("conv_id", F.shiftright("at", stretch_bits).alias("stretch"))
        .agg(F.array_sort(F.collect_list(F.struct("at", "sign"))).alias("turns"))
        .select("conv_id", "stretch", F.array_join("turns.sign", "").alias("letters"))
    )
    way = T.StructType().add("cost", "long").add("audit", "string")
    searched = T.StructType([fields["conv_id"]])
    for name, kind in (
        ("stretch", "long"), ("first", "string"), ("last", "string"),
        *((name, "long") for name in COUNTS), ("ways", T.ArrayType(T.ArrayType(way))),
    ):
        searched = searched.add(name, kind)
    pieces = stretches.mapInArrow(_search(searched), searched)
    gathered = pieces.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct(*searched.names[1:]))).alias("pieces")
    )
    edits = T.StructType([fields["conv_id"]])
    for name in FOUND:
        edits = edits.add(name, SUMMARY[name])
    found = gathered.mapInArrow(_join(edits), edits)
    stream = (
        turns.withColumn("at", F.when(F.col("sign").isNull(), NAME_AT).otherwise(F.col("at")))
        .select("conv_id", "at", "turn", "role", "text")
        .unionByName(found.withColumn("at", F.lit(EDITS_AT).cast("long")), allowMissingColumns=True)
        .repartition(parts, "conv_id")
        .sortWithinPartitions("conv_id", "at")
    )
    return stream.mapInArrow(_apply(fields, with_turns), fields)


def _search(schema: T.StructType):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for batch in batches:
            for row in batch.to_pylist():
                letters = row.pop("letters")
                faults = dict(zip(COUNTS, lattice.counts(letters)))
                ways = [[e and e._asdict() for e in some] for some in lattice.stretch(letters)]
                made = {**row, **faults, "first": letters[0], "last": letters[-1], "ways": ways}
                yield pa.RecordBatch.from_pylist([made], schema=target)

    return work


def _join(schema: T.StructType):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for batch in batches:
            for row in batch.to_pylist():
                pieces = row["pieces"]
                found = lattice.joined(
                    [[[e and lattice.Edits(**e) for e in x] for x in p["ways"]] for p in pieces]
                )
                sums = {n: sum(p[n] for p in pieces) for n in COUNTS}
                sums["illegal"] += sum(
                    lattice.counts(a["last"] + b["first"])[3] for a, b in zip(pieces, pieces[1:])
                )
                made = {"conv_id": row["conv_id"], **sums, **found._asdict()}
                yield pa.RecordBatch.from_pylist([made], schema=target)

    return work


def _apply(schema: T.StructType, with_turns: bool):
    """Streams each conversation's edits, then its turns: what is held does not grow with these.

    A digest is made byte after byte, so a conversation's turns pass through one task here.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Output(schema)
        now, begun, repaired, gaps, found = None, False, None, None, None

        def close():
            for row in repaired.end():
                if with_turns:
                    out.add(REPAIRED_TURN, now, **row)
            out.add(
                SUMMARY_ROW, now, gaps=gaps.count(), repaired_sha256=repaired.digest.hexdigest(),
                **found,
            )

        for batch in batches:
            for row in batch.to_pylist():
                if not begun or row["conv_id"] != now:
                    if begun:
                        close()
                    now, begun, gaps = row["conv_id"], True, _Gaps()
                    found = NOTHING if row["at"] != EDITS_AT else {n: row[n] for n in FOUND}
                    repaired = _Repaired(found["audit"])
                if row["at"] >= 0:
                    gaps.see(row["turn"])
                    for turn in repaired.turn(row["role"], row["text"]):
                        if with_turns:
                            out.add(REPAIRED_TURN, now, **turn)
                if out.full():
                    yield out.batch()
        if begun:
            close()
        yield out.batch()

    return work


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with faults put in by a checksum of id and turn, and `present`.

    Of twenty rows one is dropped (`present` false), one emptied, one loses its sentence marks,
    one comes twice and one is given to the user. Nulls count as one space.
    """
    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    case = F.crc32(F.concat_ws(":", text_of("conv_id"), text_of("turn")).cast("binary")) % 20
    copies = F.when(case == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.select(
        "conv_id",
        "turn",
        F.when(case == 4, "user").otherwise(text_of("role")).alias("role"),
        F.when(case == 1, "")
        .when(case == 2, F.regexp_replace(text_of("text"), "[.!?]", ""))
        .otherwise(text_of("text"))
        .alias("text"),
        (case != 0).alias("present"),
        F.explode(copies).alias("copy"),
    ).drop("copy")
