import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marlstone.operators import mutations
from tests.conftest import AS_OF, plan_of, values

DAY = dt.timedelta(days=1)
OPEN = dt.date(9999, 12, 31)
EARLY = dt.date(2024, 1, 1)
BOOKS = "k string, title string, pages int, brand string"
TRACKED = ["pages", "brand"]


def books(spark, *cells):
    return spark.createDataFrame(list(cells), BOOKS)


def opened(spark, *cells):
    return mutations.scd2_apply(None, books(spark, *cells), ["k"], TRACKED, EARLY)


def test_first_load(spark):
    assert values(opened(spark, ("a", "A", 1, "x"))) == [("a", "A", 1, "x", True, EARLY, OPEN)]


def test_each_case_of_a_second_day(spark):
    dim = opened(
        spark, ("gone", "G", 1, "x"), ("same", "S", 1, "x"), ("pages", "P", 1, "x"),
        ("brand", "B", 1, None), ("title", "T", 1, "x"), ("both", "D", None, "x"),
    )
    source = books(
        spark, ("same", "S", 1, "x"), ("pages", "P", 2, "x"), ("brand", "B", 1, "y"),
        ("title", "T2", 1, "x"), ("both", "D", None, "y"), ("new", "N", 5, "z"),
    )
    plain = mutations.scd2_apply(dim, source, ["k"], TRACKED, AS_OF)
    assert values(plain) == sorted(
        [
            ("gone", "G", 1, "x", True, EARLY, OPEN),
            ("same", "S", 1, "x", True, EARLY, OPEN),
            ("pages", "P", 1, "x", False, EARLY, AS_OF - DAY),
            ("pages", "P", 2, "x", True, AS_OF, OPEN),
            ("brand", "B", 1, None, True, EARLY, OPEN),  # NULL to value goes unseen
            ("title", "T", 1, "x", True, EARLY, OPEN),  # not tracked
            ("both", "D", None, "x", False, EARLY, AS_OF - DAY),  # one sure difference is enough
            ("both", "D", None, "y", True, AS_OF, OPEN),
            ("new", "N", 5, "z", True, AS_OF, OPEN),
        ], key=repr,
    )
    safe = mutations.scd2_apply(dim, source, ["k"], TRACKED, AS_OF, nulls="distinct")
    assert values(safe.filter("k = 'brand'")) == sorted(
        [("brand", "B", 1, None, False, EARLY, AS_OF - DAY), ("brand", "B", 1, "y", True, AS_OF, OPEN)],
        key=repr,
    )
    with pytest.raises(ValueError, match="nulls"):
        mutations.scd2_apply(dim, source, ["k"], TRACKED, AS_OF, nulls="maybe")


def test_rerun_changes_nothing(spark):
    dim, source = opened(spark, ("a", "A", 1, "x")), books(spark, ("a", "A", 2, "x"), ("b", "B", 1, "x"))
    once = mutations.scd2_apply(dim, source, ["k"], TRACKED, AS_OF)
    assert values(mutations.scd2_apply(once, source, ["k"], TRACKED, AS_OF)) == values(once)


def test_second_change_on_one_day(spark):
    dim = mutations.versioned(books(spark, ("a", "A", 1, "x")), AS_OF)
    source = books(spark, ("a", "A", 2, "x"))
    kept = mutations.scd2_apply(dim, source, ["k"], TRACKED, AS_OF)
    assert values(kept, "pages", "is_current", "valid_from", "valid_to") == [
        (1, False, AS_OF, AS_OF - DAY), (2, True, AS_OF, OPEN),
    ]
    replaced = mutations.scd2_apply(dim, source, ["k"], TRACKED, AS_OF, same_day="replace")
    assert values(replaced, "pages", "is_current") == [(2, True)]


def test_missing_keys_expire_on_request(spark):
    dim, source = opened(spark, ("a", "A", 1, "x")), books(spark, ("b", "B", 1, "x"))
    out = mutations.scd2_apply(dim, source, ["k"], TRACKED, AS_OF, expire_missing=True)
    assert values(out, "k", "is_current", "valid_to") == [("a", False, AS_OF - DAY), ("b", True, OPEN)]


def test_columns_that_come_and_go(spark):
    dim = opened(spark, ("a", "A", 1, "x"))
    source = books(spark, ("a", "A", 2, "x")).drop("title").withColumn("lang", F.lit("ENG"))
    out = mutations.scd2_apply(dim, source, ["k"], TRACKED, AS_OF)
    assert values(out, "title", "pages", "lang") == sorted(
        [("A", 1, None), (None, 2, "ENG")], key=repr
    )


def two_step(dim, source, as_of):
    """Expire with a merge, then insert what a left join leaves unmatched: in plain Python."""
    out, current = [], {}
    for row in dim:
        if row["is_current"]:
            current[row["k"]] = row
        else:
            out.append(row)
    for key, row in current.items():
        new = source.get(key)
        differs = new and any(
            row[c] is not None and new[c] is not None and row[c] != new[c] for c in TRACKED
        )
        out.append({**row, "is_current": False, "valid_to": as_of - DAY} if differs else row)
        if differs:
            out.append({**new, "is_current": True, "valid_from": as_of, "valid_to": OPEN})
    for key, new in source.items():
        if key not in current:
            out.append({**new, "is_current": True, "valid_from": as_of, "valid_to": OPEN})
    return sorted((tuple(r.values()) for r in out), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_three_random_days_match_the_two_step_form(spark, seed):
    dice = random.Random(seed)

    def snapshot():
        return {
            f"k{i}": {
                "k": f"k{i}", "title": dice.choice("AB"), "pages": dice.choice([None, 1, 2]),
                "brand": dice.choice([None, "x", "y"]),
            }
            for i in range(60) if dice.random() < 0.8
        }

    names = ["k", "title", "pages", "brand", "is_current", "valid_from", "valid_to"]
    dim, wanted = None, []
    for day in range(3):
        as_of, source = EARLY + day * DAY, snapshot()
        df = books(spark, *[tuple(r.values()) for r in source.values()])
        dim = mutations.scd2_apply(dim, df, ["k"], TRACKED, as_of)
        wanted = two_step([dict(zip(names, r)) for r in wanted], source, as_of)
        dim = spark.createDataFrame(dim.collect(), dim.schema)
    assert values(dim) == wanted
    current = dim.filter("is_current").groupBy("k").count().filter("count > 1")
    assert current.count() == 0


def test_scd2_needs_one_join_and_leaves_history_out(spark, tmp_path):
    opened(spark, ("a", "A", 1, "x")).write.parquet(f"{tmp_path}/dim")
    dim = spark.read.parquet(f"{tmp_path}/dim")
    plan = plan_of(mutations.scd2_apply(dim, books(spark, ("a", "A", 2, "x")), ["k"], TRACKED, AS_OF))
    assert plan.count("FullOuter") == 1 and plan.count("Join") == 1
    assert "EqualTo(is_current,true)" in plan or "[is_current" in plan


def test_append_takes_new_keys_only(spark):
    target = spark.createDataFrame([("r1", 5), ("r2", 3)], "k string, v int")
    source = spark.createDataFrame([("r2", 9), ("r3", 4)], "k string, v int")
    out = mutations.append_new(target, source, ["k"])
    assert values(out) == [("r1", 5), ("r2", 3), ("r3", 4)]
    assert values(mutations.append_new(out, source, ["k"])) == values(out)
    assert values(mutations.append_new(None, source, ["k"])) == values(source)


def test_keys_that_arrive_are_replaced_whole(spark):
    schema = "k string, label string, n int"
    target = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3), ("c", "x", 4)], schema)
    source = spark.createDataFrame([("a", "z", 9)], schema)
    assert values(mutations.replace_keys(target, source, ["k"])) == [
        ("a", "z", 9), ("b", "x", 3), ("c", "x", 4),
    ]
    arrived = spark.createDataFrame([("a",), ("c",), ("c",)], "k string")
    assert values(mutations.replace_keys(target, source, ["k"], arrived)) == [("a", "z", 9), ("b", "x", 3)]
    assert values(mutations.replace_keys(None, source, ["k"])) == values(source)


MERGE = "u string, b string, v string, at int, kept string"


def test_merge_cases(spark):
    target = spark.createDataFrame(
        [
            ("u", "only", "t", 5, "t"), ("u", "newer", "t", 5, "t"), ("u", "older", "t", 5, "t"),
            ("u", "equal", "t", 5, "t"), ("u", "tnull", "t", None, "t"), ("u", "snull", "t", 5, "t"),
            ("u", "both", "t", None, "t"),
        ], MERGE,
    )
    source = spark.createDataFrame(
        [
            ("u", "newer", "s", 6, "s"), ("u", "older", "s", 4, "s"), ("u", "equal", "s", 5, "s"),
            ("u", "tnull", "s", 1, "s"), ("u", "snull", "s", None, "s"), ("u", "both", None, None, "s"),
            ("u", "fresh", "s", 1, "s"),
        ], MERGE,
    )
    args = (["u", "b"], "at", ["v", "at"])
    out = mutations.merge_newest(target, source, *args)
    wanted = sorted(
        [
            ("u", "only", "t", 5, "t"), ("u", "newer", "s", 6, "t"), ("u", "older", "t", 5, "t"),
            ("u", "equal", "t", 5, "t"), ("u", "tnull", "s", 1, "t"), ("u", "snull", "t", 5, "t"),
            ("u", "both", None, None, "t"), ("u", "fresh", "s", 1, "s"),
        ], key=repr,
    )
    assert values(out) == wanted
    assert values(mutations.merge_newest(out, source, *args)) == wanted
    assert values(mutations.merge_newest(None, source, *args)) == values(source)


def test_merges_of_distinct_times_commute(spark):
    dice = random.Random(7)
    times = iter(dice.sample(range(1000), 120))

    def batch():
        return spark.createDataFrame(
            [("u", f"b{i}", dice.choice("xyz"), next(times), "-") for i in dice.sample(range(60), 30)],
            MERGE,
        )

    target, one, two = batch(), batch(), batch()
    args = (["u", "b"], "at", ["v", "at"])
    there = mutations.merge_newest(mutations.merge_newest(target, one, *args), two, *args)
    back = mutations.merge_newest(mutations.merge_newest(target, two, *args), one, *args)
    assert values(there) == values(back)


def test_a_repeated_day_replaces_its_snapshot(spark):
    def snapshot(n):
        return spark.createDataFrame([("a", n)], "k string, n int")

    table = mutations.snapshot_supersede(None, snapshot(0), EARLY)
    for n in (1, 2, 3):
        table = mutations.snapshot_supersede(table, snapshot(n), AS_OF)
    assert values(table, "n", "is_current") == [(0, False), (3, True)]
    assert table.filter("valid_to < valid_from").count() == 0
    current = mutations.supersede_delta(None, snapshot(1), AS_OF)
    assert values(mutations.supersede_delta(current, snapshot(2), AS_OF), "n") == [(2,)]
    closed = mutations.supersede_delta(current, snapshot(2), AS_OF, same_day="close")
    assert values(closed, "n", "is_current") == [(1, False), (2, True)]
    with pytest.raises(ValueError, match="same_day"):
        mutations.supersede_delta(current, snapshot(2), AS_OF, same_day="other")


def test_snapshots_supersede_each_other(spark):
    def snapshot(day, *keys):
        return spark.createDataFrame([(k, day) for k in keys], "k string, n int")

    table = None
    for day, keys in enumerate((("a", "b"), ("b",), ("b", "c"))):
        fresh = snapshot(day, *keys) if day < 2 else snapshot(day, *keys).withColumn("x", F.lit(1))
        table = mutations.snapshot_supersede(table, fresh, EARLY + day * DAY)
    assert values(table, "k", "n", "is_current", "valid_to", "x") == sorted(
        [
            ("a", 0, False, EARLY, None), ("b", 0, False, EARLY, None),
            ("b", 1, False, EARLY + DAY, None), ("b", 2, True, OPEN, 1), ("c", 2, True, OPEN, 1),
        ], key=repr,
    )
    assert "Exchange" not in plan_of(table) and "Join" not in plan_of(table)
    parts = mutations.supersede_delta(None, snapshot(0, "a"), EARLY)
    after = mutations.supersede_delta(parts, snapshot(1, "b"), AS_OF)
    assert values(after, "k", "is_current") == [("a", False), ("b", True)]
