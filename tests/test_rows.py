import datetime as dt

import pytest
from pyspark.sql import functions as F

from marlstone.operators import calendar, features, manifest, monitor, rows
from marlstone.operators.dedupe import dedupe, dedupe_repeated, latest_per_key
from tests.conftest import plan_of, values


def test_require(spark):
    df = spark.createDataFrame([("a", "x"), (None, "x"), ("b", None), ("c", "")], "k string, v string")
    assert values(rows.require(df, "k", "v")) == [("a", "x"), ("c", "")]
    assert values(rows.require(df, "k", "v", blank=False)) == [("a", "x")]


def test_expectations(spark):
    df = spark.createDataFrame([("a", None), ("b", "x")], "k string, v string")
    rows.expect_no_nulls(df, ["k"])
    with pytest.raises(ValueError, match="'v': 1"):
        rows.expect_no_nulls(df, ["k", "v"])
    with pytest.raises(ValueError, match="missing"):
        rows.expect_no_nulls(df, ["w"])


def test_explode_drops_empty_and_keeps_null_fields(spark):
    df = spark.createDataFrame(
        [("b1", [("a1", "Author"), (None, "x")]), ("b2", []), ("b3", None)],
        "b string, authors array<struct<author_id string, role string>>",
    )
    out = rows.explode_structs(df, "authors", {"author_id": "id", "role": "role"}, ["b"])
    assert out.columns == ["b", "id", "role"]
    assert values(out) == [("b1", "a1", "Author"), ("b1", None, "x")]


def test_latest_takes_newest_then_breaks_ties_by_all_columns(spark):
    cells = [
        ("u", 1, "a"), ("u", 2, "a"), ("u", 2, "b"), ("u", None, "z"),
        ("v", None, "a"), ("v", None, "c"), (None, 5, "q"),
    ]
    df = spark.createDataFrame(cells, "k string, t int, x string")
    wanted = [(None, 5, "q"), ("u", 2, "b"), ("v", None, "c")]
    assert values(latest_per_key(df, ["k"], ["t"])) == sorted(wanted, key=repr)
    for parts in (1, 3, 7):
        shuffled = df.orderBy(F.rand(parts)).repartition(parts)
        assert values(latest_per_key(shuffled, ["k"], ["t"])) == sorted(wanted, key=repr)


def test_dedupe_prefers_the_last_load(spark):
    df = spark.createDataFrame([("b", "z", 1), ("b", "a", 2)], "k string, x string, _ingestion_timestamp int")
    assert values(dedupe(df, ["k"])) == [("b", "a", 2)]
    assert values(dedupe(df.drop("_ingestion_timestamp"), ["k"])) == [("b", "z")]
    assert values(dedupe_repeated(df.union(df), ["k"]), "k", "x") == [("b", "a")]
    assert values(dedupe_repeated(df.drop("_ingestion_timestamp"), ["k"])) == [("b", "z")]


def test_hot_key_sends_one_row_per_task(spark):
    """A key holding a third of all rows is cut down before the shuffle."""
    df = spark.range(0, 90000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("t")
    )
    out = latest_per_key(df, ["k"], ["t"])
    plan = plan_of(out)
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert out.filter("k = -1").first().t == 89997
    assert out.count() == 60001


def test_review_and_interaction_aggregates(spark):
    reviews = spark.createDataFrame(
        [("b", 5, 2), ("b", 4, None), ("b", 2, 3), ("c", 3, 0)], "book_id string, rating int, n_votes int"
    )
    assert values(features.reviews_agg(reviews)) == [("b", 3, 3.67, 2, 1, 2.5), ("c", 1, 3.0, 0, 0, 0.0)]
    interactions = spark.createDataFrame(
        [("b", 1, 0, None), ("b", None, 1, 4), ("b", 0, 1, 3)],
        "book_id string, is_read int, has_review int, rating int",
    )
    assert values(features.interactions_agg(interactions)) == [("b", 3, 1, 2, 3.5)]


def test_label_columns_in_one_scan(spark, tmp_path):
    df = spark.createDataFrame(
        [("b", "to-read", 7), ("b", "read", 2), ("c", "poetry", 1), ("d", "currently-reading", 3)],
        "book_id string, shelf_name string, shelf_count long",
    )
    df.write.parquet(str(tmp_path / "s"))
    out = features.label_columns(spark.read.parquet(str(tmp_path / "s")))
    assert values(out) == [("b", 7, None, 2), ("d", None, 3, None)]
    assert plan_of(out).count("FileScan") == 1


def test_author_list_is_sorted_and_leaves_other_roles_out(spark):
    df = spark.createDataFrame(
        [("b", "9", "Author"), ("b", "10", "Author"), ("b", "1", "Editor"), ("c", "2", "Editor")],
        "book_id string, author_id string, role string",
    )
    assert values(features.author_list(df)) == [("b", "10, 9")]


def test_joined_lists_are_sorted(spark):
    import random

    ids = [str(i) for i in range(0, 3000, 7)] + ["é1", "a", "ab", "abc", "", "Z"]
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([("b", i) for i in ids] + [("c", None)], "book_id string, v string")
    (row,) = features.joined_list(df, "book_id", "v", "vs").collect()
    assert row.vs.split(", ") == sorted(ids, key=lambda v: v.encode())


def test_enrich_keeps_every_base_row(spark):
    base = spark.createDataFrame([("a",), ("b",)], "book_id string")
    f = spark.createDataFrame([("a", 1)], "book_id string, n int")
    assert values(features.enrich(base, f)) == [("a", 1), ("b", None)]


def test_top_n_never_sorts_globally(spark):
    df = spark.range(1000).withColumn("s", F.col("id") % 7)
    out = rows.top_n(df, 3, "s", F.col("id").asc())
    assert "TakeOrderedAndProject" in plan_of(out)
    assert [(r.id, r.s) for r in out.collect()] == [(6, 6), (13, 6), (20, 6)]


def test_calendar(spark):
    days = calendar.calendar(spark)
    assert days.count() == 14975
    leap = days.filter("date_id = '2024-02-29' OR date_id = '20240229'").first()
    assert tuple(leap) == ("20240229", dt.date(2024, 2, 29), 2024, 2, 29, 1, "February", "Thursday")


def test_calendar_of_several_columns(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 3), dt.date(2024, 1, 1)), (dt.date(2024, 1, 2), None)], "a date, b date"
    )
    assert [r.date_id for r in calendar.calendar_of(df, "a", "b").orderBy("date_id").collect()] == [
        "20240101", "20240102", "20240103",
    ]


def test_row_count_delta(spark):
    now = dt.datetime(2024, 2, 2, tzinfo=dt.timezone.utc)
    df = spark.sql("SELECT explode(array(timestamp'2024-01-30', timestamp'2024-02-01 12:00:00')) AS ts")
    assert values(monitor.row_count_delta(df, "ts", now)) == [(1, 2, 1, "Loaded")]
    late = df.filter("ts > '2024-02-01'")
    assert values(monitor.row_count_delta(late, "ts", now)) == [(None, 1, None, "First load")]


def test_summaries(spark):
    dim = spark.createDataFrame([(1, True), (1, False), (2, True)], "k int, is_current boolean")
    assert values(monitor.version_counts(dim)) == [(3, 2, 1)]
    out = monitor.layer_summary({"dim": (dim, "versions"), "flat": (dim.drop("is_current"), "replace")})
    assert values(out) == [("dim", 3, 2, "versions"), ("flat", 3, 3, "replace")]


BASES = {"complete": "w/", "byGenre": "g/"}
FOLDERS = {"complete": "c/", "books": "b/", "reviews": "r/", "interactions": "i/"}


def test_routing(spark):
    catalogue = spark.createDataFrame(
        [
            ("complete", "books.json"), ("byGenre", "reviews_of_books.json"),
            ("byGenre", "reviews_x.json"), ("byGenre", "interactions.json"),
        ],
        "type string, name string",
    )
    assert [r.path for r in manifest.route_files(catalogue, BASES, FOLDERS).collect()] == [
        "c/books.json", "b/reviews_of_books.json", "r/reviews_x.json", "i/interactions.json",
    ]


@pytest.mark.parametrize("kind, name, word", [("other", "books", "type"), ("byGenre", "authors", "folder")])
def test_routing_fails_on_unknown_files(spark, kind, name, word):
    catalogue = spark.createDataFrame([(kind, name)], "type string, name string")
    with pytest.raises(Exception, match=word):
        manifest.route_files(catalogue, BASES, FOLDERS).collect()
    reported = manifest.route_files(catalogue, BASES, FOLDERS, unknown="null")
    with pytest.raises(ValueError, match="NULLs"):
        rows.expect_no_nulls(reported, ["url", "path"])


def test_pending_and_status(spark):
    wanted = spark.createDataFrame([("a", "p/a"), ("b", "p/b")], "name string, path string")
    listing = spark.createDataFrame([("p/a", 1048576)], "path string, length long")
    assert values(manifest.pending_files(wanted, listing), "name") == [("b",)]
    status = manifest.fetch_status(wanted, listing)
    assert values(status, "name", "status", "size_mb") == [("a", "skipped", 1.0), ("b", "pending", None)]


def test_status_summary_with_failures(spark):
    results = spark.createDataFrame(
        [("a", "success", 1.25, None), ("b", "failed", 0.0, "timeout"), ("c", "success", 2.0, None)],
        "name string, status string, size_mb double, error string",
    )
    assert values(manifest.status_summary(results)) == [("failed", 1, 0.0), ("success", 2, 3.3)]
