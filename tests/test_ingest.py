import datetime as dt
import gzip
import json
import os
import random
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructType,
)

from marlstone.sources import fs, schema as schema_of, store
from marlstone.sources.schema import grown, infer_or_load_schema, load_epochs, widen
from marlstone.streaming import ingest
from marlstone.streaming.ingest import (
    Feed,
    Landed,
    feed_log,
    ingest_all,
    ingest_json,
    land,
    read_bronze,
    schema_path,
    waiting_fields,
    with_audit,
)
from tests.conftest import NOW, plan_of, values


def drop(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines))


@pytest.fixture
def feed(tmp_path):
    return Feed("books", f"{tmp_path}/raw", f"{tmp_path}/bronze", f"{tmp_path}/checkpoint")


def test_each_file_once_and_new_fields_kept(spark, feed):
    drop(feed.src, "a.json", {"id": "1", "n": 1}, {"id": "2", "n": 2}, {"id": "3", "n": 3})
    assert values(ingest_all(spark, [feed], NOW)) == [("books", 3, 1)]
    assert values(ingest_all(spark, [feed], NOW)) == [("books", 0, 0)]
    drop(feed.src, "b.json", {"id": "4", "n": 4, "extra": "x"}, "{broken", "")
    assert values(ingest_all(spark, [feed], NOW)) == [("books", 2, 1)]
    assert values(ingest_all(spark, [feed], NOW)) == [("books", 0, 0)]
    rows = read_bronze(spark, feed)
    assert values(rows, "id", "n", "extra", "_rescued_line") == sorted(
        [("1", 1, None, None), ("2", 2, None, None), ("3", 3, None, None), ("4", 4, "x", None),
         (None, None, None, "{broken")], key=repr,
    )
    files = {r[0].rpartition("/")[2] for r in rows.select("_source_file").distinct().collect()}
    assert files == {"a.json", "b.json"}
    assert rows.filter("_ingestion_timestamp = timestamp'2024-02-01 06:00:00'").count() == 5
    history = store.table_history(spark, feed_log(feed)).collect()
    assert [(h.version, h.operation, h.operationMetrics["rows"]) for h in history] == [
        (1, "STREAMING UPDATE", "2"), (0, "STREAMING UPDATE", "3"),
    ]


def test_fields_outside_a_declared_schema_are_rescued(spark, feed):
    declared = StructType().add("id", "string").add("n", "integer")
    strict = Feed(feed.name, feed.src, feed.out, feed.checkpoint, schema=declared)
    odd = '{"id":"2","n":2,"more":[1]}'
    drop(feed.src, "a.json", {"id": "1", "n": 1}, odd, '{"id":"3","n":"x"}')
    ingest_all(spark, [strict])
    assert values(read_bronze(spark, strict), "id", "n", "_rescued_line") == sorted(
        [("1", 1, None), ("2", 2, odd), ("3", None, '{"id":"3","n":"x"}')], key=repr
    )


def test_old_files_in_small_batches(spark, feed):
    for i in range(5):
        drop(feed.src, f"{i}.json", {"id": str(i)})
        long_ago = time.time() - 90 * 86400 * i
        os.utime(f"{feed.src}/{i}.json", (long_ago, long_ago))
    small = Feed("books", feed.src, feed.out, feed.checkpoint, max_files=2, spread=3)
    assert values(ingest_all(spark, [small])) == [("books", 5, 3)]
    drop(feed.src, "late.json", {"id": "late"})
    os.utime(f"{feed.src}/late.json", (1000000000, 1000000000))
    assert values(ingest_all(spark, [small])) == [("books", 1, 1)]


def test_batches_bounded_by_bytes(spark, feed):
    for i in range(4):
        drop(feed.src, f"{i}.json", {"id": "x" * 600})
    bounded = Feed("books", feed.src, feed.out, feed.checkpoint, max_bytes=1000)
    (report,) = ingest_all(spark, [bounded]).collect()
    assert report.rows == 4 and report.batches > 1


def test_every_file_is_looked_at_whatever_its_date(spark, feed):
    drop(feed.src, "a.json", {"id": 1, "s": {"x": 1}})
    drop(feed.src, "b.json", {"id": 2, "z": "only here"})
    drop(feed.src, "c.json", {"id": 4, "s": {"x": 9, "nested": 8}})
    ingest_all(spark, [feed])
    drop(feed.src, "old.json", {"id": 5, "s": {"x": 3, "more": {"deep": 7}}})
    os.utime(f"{feed.src}/old.json", (1000000000, 1000000000))
    ingest_all(spark, [feed])
    rows = read_bronze(spark, feed)
    found = values(rows, "id", "z", "s.nested", "s.more.deep", "_rescued_line")
    assert found == sorted(
        [(1, None, None, None, None), (2, "only here", None, None, None),
         (4, None, 8, None, None), (5, None, None, 7, None)], key=repr,
    )


def test_fields_outside_a_declared_schema_are_rescued_at_any_depth(spark, feed):
    inner = StructType().add("x", "long")
    declared = StructType().add("id", "long").add("s", inner).add("a", ArrayType(inner))
    strict = Feed(feed.name, feed.src, feed.out, feed.checkpoint, schema=declared)
    odd = [
        '{"id":2,"s":{"x":1,"y":2}}', '{"id":3,"a":[{"x":1},{"x":2,"y":{"z":[1]}}]}',
        '{"id":4,"other":{"k":1}}',
    ]
    plain = ['{"id":1,"s":{"x":1},"a":[]}', '{"id":5,"s":{"x":1,"y":null},"other":null}']
    drop(feed.src, "a.json", *odd, *plain)
    ingest_all(spark, [strict])
    rows = read_bronze(spark, strict)
    assert values(rows, "id", "_rescued_line") == sorted(
        [(2, odd[0]), (3, odd[1]), (4, odd[2]), (1, None), (5, None)], key=repr
    )
    assert values(rows, "id", "s.x", "a.x")[1] == (2, 1, None)


def test_an_empty_list_fixes_no_type(spark, feed):
    drop(feed.src, "a.json", {"id": 1, "who": [], "none": None})
    ingest_all(spark, [feed])
    rows = read_bronze(spark, feed)
    assert dict(rows.dtypes)["who"] == "array<string>" and dict(rows.dtypes)["none"] == "string"
    drop(feed.src, "b.json", {"id": 2, "who": [{"name": "x"}], "none": 5})
    ingest_all(spark, [feed])
    rows = read_bronze(spark, feed)
    assert values(rows, "id", "who.name", "none") == [(1, None, None), (2, ["x"], 5)]
    drop(feed.src, "c.json", {"id": 3, "who": [], "none": None})
    ingest_all(spark, [feed])
    assert values(read_bronze(spark, feed), "id", "none") == [(1, None), (2, 5), (3, None)]


def test_new_rows_come_from_the_files_of_their_days(spark, feed):
    for day in range(4):
        drop(feed.src, f"{day}.json", {"id": day})
        ingest_all(spark, [feed], NOW + dt.timedelta(days=day))
    fresh = read_bronze(spark, feed, NOW + dt.timedelta(days=2))
    assert values(fresh, "id") == [(3,)]
    assert len(fresh.inputFiles()) == 4  # before partitions are pruned
    assert "PartitionFilters: [isnotnull(load_date" in plan_of(fresh)


def test_a_batch_run_again_replaces_itself(spark, feed):
    drop(feed.src, "a.json", {"id": 1}, {"id": 2})
    lines = with_audit(spark.read.text(feed.src), NOW)
    for _ in range(2):
        landed = Landed()
        land(feed, lines, 0, landed)
    assert (landed.rows, landed.batches) == (2, 1)
    assert values(read_bronze(spark, feed), "id") == [(1,), (2,)]


def test_all_failures_are_raised(spark, tmp_path):
    feeds = [
        Feed(n, f"{tmp_path}/{n}", f"{tmp_path}/out/{n}", f"{tmp_path}/cp/{n}", max_files=-1)
        for n in ("one", "two")
    ]
    for feed in feeds:
        drop(feed.src, "a.json", {"id": 1})
    with pytest.raises(ExceptionGroup) as caught:
        ingest_all(spark, feeds)
    assert len(caught.value.exceptions) == 2


def test_a_failing_feed_does_not_stop_the_others(spark, tmp_path):
    feeds = [
        Feed(n, f"{tmp_path}/raw/{n}", f"{tmp_path}/bronze/{n}", f"{tmp_path}/cp/{n}")
        for n in ("bad", "good")
    ]
    for feed in feeds:
        drop(feed.src, "a.json", {"id": 1})
    wrong = Feed("bad", feeds[0].src, feeds[0].out, feeds[0].checkpoint, max_files=-1)
    with pytest.raises(Exception, match="maxFilesPerTrigger"):
        ingest_all(spark, [wrong, feeds[1]])
    assert read_bronze(spark, feeds[1]).count() == 1


def test_compressed_files(spark, feed):
    os.makedirs(feed.src)
    with gzip.open(f"{feed.src}/a.json.gz", "wt") as out:
        out.writelines(json.dumps({"id": i}) + "\n" for i in range(1000))
    shared = Feed("books", feed.src, feed.out, feed.checkpoint, spread=4)
    assert values(ingest_all(spark, [shared])) == [("books", 1000, 1)]
    rows = read_bronze(spark, shared)
    assert rows.select("id").distinct().count() == 1000
    assert len(rows.inputFiles()) == 4


def test_feeds_side_by_side(spark, tmp_path):
    feeds = [
        Feed(n, f"{tmp_path}/raw/{n}", f"{tmp_path}/bronze/{n}", f"{tmp_path}/cp/{n}")
        for n in ("books", "reviews")
    ]
    for i, feed in enumerate(feeds):
        drop(feed.src, "a.json", *[{"id": j} for j in range(i + 1)])
    assert values(ingest_all(spark, feeds)) == [("books", 1, 1), ("reviews", 2, 1)]


def test_single_folder_form(spark, tmp_path):
    drop(f"{tmp_path}/raw", "a.json", {"id": 1})
    report = ingest_json(spark, f"{tmp_path}/raw", f"{tmp_path}/out", f"{tmp_path}/cp")
    assert values(report) == [("ingest", 1, 1)]


def test_schema_is_kept_and_widened(spark, tmp_path):
    src, kept = f"{tmp_path}/raw", f"{tmp_path}/schema.json"
    drop(src, "a.json", {"id": 1, "who": [{"x": "a"}]})
    first = infer_or_load_schema(spark, src, kept)
    assert first.simpleString() == "struct<id:bigint,who:array<struct<x:string>>>"
    assert infer_or_load_schema(spark, src, kept, evolve=False) == first
    drop(src, "b.json", {"id": "text", "who": [{"x": "a", "y": 2}], "new": True})
    second = infer_or_load_schema(spark, src, kept, grow=False)
    assert second.simpleString() == "struct<id:bigint,who:array<struct<x:string,y:bigint>>,new:boolean>"
    assert infer_or_load_schema(spark, src, kept, evolve=False) == second
    assert json.loads(fs.read_text(spark, kept))["schema"] == second.jsonValue()


def test_widen_keeps_known_types():
    left = StructType().add("a", "long").add("s", StructType().add("x", "string"))
    right = StructType().add("a", "string").add("s", StructType().add("y", "long")).add("b", "string")
    assert widen(left, right).simpleString() == "struct<a:bigint,s:struct<x:string,y:bigint>,b:string>"


def read(spark, feed, *cols):
    return values(read_bronze(spark, feed), *cols)


def test_numbers_keep_their_values_when_their_type_grows(spark, feed):
    drop(feed.src, "a.json", {"id": 1, "rating": 4, "s": {"x": 1}, "a": [{"n": 1}, None], "big": 7})
    ingest_all(spark, [feed])
    drop(feed.src, "b.json", {"id": 2, "rating": 3.5, "s": {"x": 1.25}, "a": [{"n": 2.5}]})
    ingest_all(spark, [feed])
    kept = read_bronze(spark, feed)
    assert dict(kept.dtypes)["rating"] == "double" and kept.filter("_rescued_line IS NOT NULL").count() == 0
    assert read(spark, feed, "id", "rating", "s.x", "a.n") == [
        (1, 4.0, 1.0, [1.0, None]), (2, 3.5, 1.25, [2.5])]
    drop(feed.src, "c.json", '{"id":3,"rating":"good","big":123456789012345678901}')
    ingest_all(spark, [feed])
    assert read(spark, feed, "id", "rating") == [(1, "4"), (2, "3.5"), (3, "good")]
    assert [str(r[0]) for r in read(spark, feed, "big")] == ["123456789012345678901", "7", "None"]
    drop(feed.src, "d.json", '{"id":4,"s":"text","a":{"n":1}}')
    ingest_all(spark, [feed])
    assert read(spark, feed, "id", "s", "a")[:2] == [
        (1, '{"x":1}', '[{"n":1},null]'), (2, '{"x":1.25}', '[{"n":2.5}]')]
    assert read(spark, feed, "id", "s", "a")[-1] == (4, "text", '{"n":1}')


def test_a_batch_without_values_changes_no_type(spark, feed):
    drop(feed.src, "a.json", {"id": 1, "n": 4, "who": [{"x": 1}]})
    ingest_all(spark, [feed])
    drop(feed.src, "b.json", {"id": 2, "n": None, "who": []})
    ingest_all(spark, [feed])
    assert dict(read_bronze(spark, feed).dtypes)["n"] == "bigint"
    assert read(spark, feed, "id", "n", "who.x") == [(1, 4, [1]), (2, None, [])]


def test_a_batch_run_again_after_a_type_has_grown(spark, feed):
    drop(feed.src, "a.json", {"id": 1, "n": 4})
    drop(feed.src, "b.json", {"id": 2, "n": 3.5})
    for batch, name in ((0, "a"), (1, "b"), (1, "b")):
        lines = with_audit(spark.read.text(f"{feed.src}/{name}.json"), NOW)
        land(feed, lines, batch, Landed())
    assert read(spark, feed, "id", "n") == [(1, 4.0), (2, 3.5)]
    drop(feed.src, "c.json", {"id": 3, "n": 1, "more": 5})
    land(feed, with_audit(spark.read.text(f"{feed.src}/c.json"), NOW), 2, Landed())
    assert read(spark, feed, "id", "n", "more") == [(1, 4.0, None), (2, 3.5, None), (3, 1.0, 5)]
    assert [batch for batch, _ in load_epochs(spark, schema_path(feed))] == [0, 1]


def test_types_have_an_order():
    long, double, text = LongType(), DoubleType(), StringType()
    assert grown(long, double) == grown(double, long) == grown(double, DecimalType(20, 2)) == double
    assert grown(long, DecimalType(20, 0)) == DecimalType(20, 0)
    assert grown(DecimalType(30, 0), DecimalType(30, 20)) == double
    assert grown(long, BooleanType()) == grown(text, double) == grown(StructType(), long) == text
    inner = StructType().add("x", long)
    assert grown(ArrayType(inner), ArrayType(StructType().add("x", double).add("y", text))) == ArrayType(
        StructType().add("x", double).add("y", text))


def test_inferred_schema_grows_too(spark, tmp_path):
    src, kept = f"{tmp_path}/raw", f"{tmp_path}/schema.json"
    drop(src, "a.json", {"id": 1})
    infer_or_load_schema(spark, src, kept)
    drop(src, "b.json", {"id": 1.5})
    schema = infer_or_load_schema(spark, src, kept)
    assert values(spark.read.schema(schema).json(src)) == [(1.0,), (1.5,)]


ASIDE = [
    '{"id":1,"s":{"x":1}}', '{"id":2,"s":{"x":1,"y":2},"new":"v","none":null}',
    '{"id":3,"a":[{"x":1},{"x":2,"y":{"z":[1]}}]}', '{"id":4,"s":{"y":9,"deep":{"q":true}},"new":"w"}',
    '{"id":"no number","new":"lost?"}', "{broken", '{"id":5,"s":null,"a":null}', '{"id":6,"s":7,"new":8}',
]


def test_unknown_fields_are_kept_aside_and_taken_over(spark, feed):
    inner = StructType().add("x", "long")
    first = StructType().add("id", "long").add("s", inner).add("a", ArrayType(inner))
    strict = replace(feed, schema=first, rescue="fields")
    drop(feed.src, "a.json", *ASIDE)
    ingest_all(spark, [strict])
    rows = read_bronze(spark, strict).selectExpr(
        "id", "to_json(_rescued_fields) AS more", "_rescued_line AS line")
    assert values(rows) == sorted([
        (1, None, None), (2, '{"new":"v","s":{"y":2}}', None), (3, '{"a":[{},{"y":{"z":[1]}}]}', None),
        (4, '{"new":"w","s":{"deep":{"q":true},"y":9}}', None), (5, None, None),
        (None, '{"new":"lost?"}', ASIDE[4]), (None, None, "{broken"),
        (6, '{"new":8}', ASIDE[7]),
    ], key=repr)
    assert values(waiting_fields(spark, strict)) == [(
        "OBJECT<a: ARRAY<OBJECT<y: OBJECT<z: ARRAY<BIGINT>>>>, new: VARIANT, "
        "s: OBJECT<deep: OBJECT<q: BOOLEAN>, y: BIGINT>>",
    )]

    wider = StructType().add("x", "long").add("y", "long").add("deep", StructType().add("q", "boolean"))
    second = replace(strict, schema=StructType().add("id", "long").add("s", wider)
                     .add("a", ArrayType(inner)).add("new", "string"))
    drop(feed.src, "b.json", '{"id":7,"s":{"x":3,"y":4},"new":"z","later":1}')
    ingest_all(spark, [second])
    found = read_bronze(spark, second)
    assert [f for f in values(found, "id", "s.x", "s.y", "s.deep.q", "new") if f[0]] == sorted([
        (1, 1, None, None, None), (2, 1, 2, None, "v"), (3, None, None, None, None),
        (4, None, 9, True, "w"), (5, None, None, None, None), (6, None, None, None, "8"),
        (7, 3, 4, None, "z"),
    ], key=repr)
    assert values(found.filter("id = 7").selectExpr("to_json(_rescued_fields)")) == [('{"later":1}',)]
    with pytest.raises(ValueError, match="rescue"):
        replace(feed, rescue="nothing")


def test_fields_with_values_in_the_first_lines_cost_one_pass(spark, monkeypatch):
    passes, infer = [], schema_of.infer_lines

    def noted(lines, values_only=False):
        passes.append(lines)
        return infer(lines, values_only)

    monkeypatch.setattr(schema_of, "infer_lines", noted)
    text = '{"a":"x","n":1,"b":[{"c":"y","d":[]},{"c":null,"d":["z"]}]}'
    lines = spark.createDataFrame([(text,)] * 3 + [("broken",)], "value string")
    seen = infer(lines)
    assert schema_of.learn(StructType([]), seen, lines) == (seen, seen)
    assert lines not in passes
    # A field without a value so far has to be looked for in all lines.
    more = lines.unionAll(spark.createDataFrame([('{"e":null}',)], "value string"))
    typed, whole = schema_of.learn(StructType([]), infer(more), more)
    assert typed == seen and set(whole.names) == {*seen.names, "e"}
    assert more in passes


def test_the_look_at_first_lines_changes_no_type(spark, monkeypatch):
    monkeypatch.setattr(schema_of, "FIRST_LINES", 3)
    pick = random.Random(5)

    def value(depth):
        kind = pick.randrange(9 if depth else 6)
        if kind > 6:
            return {name: value(depth - 1) for name in pick.sample("abc", pick.randrange(4))}
        if kind > 4:
            return [value(max(depth - 1, 0)) for _ in range(pick.randrange(3))]
        return [None, "", "text", 7, 2.5][kind]

    for _ in range(25):
        rows = [{name: value(2) for name in pick.sample("abcd", pick.randrange(1, 5))} for _ in range(6)]
        rows = [*rows, *[{**row, "e": "x"} for row in rows]] if pick.random() < 0.3 else rows * 2
        lines = spark.createDataFrame([(json.dumps(row),) for row in rows], "value string")
        lines = lines.coalesce(1)
        seen = schema_of.infer_lines(lines)
        wanted = schema_of.infer_lines(lines, values_only=True)
        assert schema_of.valued_fields(seen, lines) == wanted


@pytest.mark.parametrize("days", [1, 9])
def test_a_batch_of_few_dates_is_written_without_a_sort(spark, feed, monkeypatch, days):
    """Of more dates than files are held open for too, each row lands under its date."""
    name, held, folder = "spark.sql.maxConcurrentOutputFileWriters", [], ingest.batch_folder

    def noted(*args):
        held.append(spark.conf.get(name))
        return folder(*args)

    monkeypatch.setattr(ingest, "batch_folder", noted)
    before = spark.conf.get(name)
    date = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % days).cast("int"))
    rows = spark.range(400).select(
        F.to_json(F.struct("id")).alias("value"),
        date.cast("timestamp").alias("_ingestion_timestamp"),
        F.lit("file").alias("_source_file"),
    )
    land(feed, rows.coalesce(1), 0, Landed())
    assert held[0] == "4" and spark.conf.get(name) == before
    found = read_bronze(spark, feed)
    assert found.count() == found.select("id").distinct().count() == 400
    folders = [f for f in os.listdir(f"{feed.out}/batch=0") if f.startswith("load_date=")]
    assert len(folders) == days
