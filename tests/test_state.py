"""What a day leaves for the next: partial sums, small joins, buckets, order, counts in footers."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marlstone.operators.features import (
    interaction_features,
    interaction_sums,
    interactions_agg,
    review_features,
    review_sums,
    reviews_agg,
)
from marlstone.operators.monitor import row_count_delta
from marlstone.operators.mutations import met_keys, new_rows
from marlstone.plans import gold, live
from marlstone.plans import lake as jobs
from marlstone.plans.rollup import Rollup, pending, pending_rows, refresh
from marlstone.session import bloom_filtered
from marlstone.sources import catalog, files, store
from marlstone.streaming import ingest
from marlstone.streaming.ingest import LOADED_AT, Feed, ingest_all, read_bronze
from marlstone.workload import inputs
from tests.conftest import NOW, plan_of, values
from tests.test_lake import DAY1, DAY2, at, book, interaction, put, review

REVIEWS = "book_id string, rating int, n_votes int"
INTERACTIONS = "book_id string, is_read int, has_review int, rating int, month string"


def some(schema, rows, seed):
    pick = random.Random(seed)
    if schema is REVIEWS:
        return [(f"b{pick.randrange(9)}", pick.randrange(1, 6), pick.choice([None, 0, 3, 7]))
                for _ in range(rows)]
    return [(f"b{pick.randrange(9)}", pick.choice([None, 0, 1]), pick.randrange(2),
             pick.choice([None, 1, 4, 5]), f"20{pick.randrange(10, 14)}01") for _ in range(rows)]


@pytest.fixture
def review_rollup(spark, tmp_path):
    return Rollup(f"{tmp_path}/reviews", f"{tmp_path}/sums", ["book_id"],
                  ["book_id", "rating", "n_votes"], review_sums)


@pytest.fixture
def month_rollup(spark, tmp_path):
    return Rollup(f"{tmp_path}/interactions", f"{tmp_path}/sums", ["book_id"],
                  ["book_id", "is_read", "has_review", "rating"], interaction_sums)


def test_sums_of_appended_rows_come_from_new_runs_alone(spark, review_rollup):
    source = review_rollup.source
    for day in range(3):
        store.append(spark.createDataFrame(some(REVIEWS, 50, day), REVIEWS), source)
        todo = pending(spark, review_rollup)
        assert todo.runs == {"all": [day]} and not todo.replaced
        opened = pending_rows(spark, review_rollup, todo)
        assert all(f"/run_id={day}/" in path for path in opened.inputFiles())
        assert "ReadSchema: struct<book_id:string,rating:int,n_votes:int>" in plan_of(opened)
        refresh(spark, review_rollup)
        assert refresh(spark, review_rollup) is None  # a repeat adds nothing
        sums = store.read_table(spark, review_rollup.root)
        assert values(review_features(sums)) == values(reviews_agg(store.read_table(spark, source)))


def test_sums_are_folded_when_there_are_many_pieces(spark, review_rollup):
    for day in range(7):
        store.append(spark.createDataFrame(some(REVIEWS, 20, day), REVIEWS), review_rollup.source)
        refresh(spark, review_rollup, most_pieces=3)
        assert len(store.state(spark, review_rollup.root)["parts"]["all"]) <= 3
    sums = store.read_table(spark, review_rollup.root)
    whole = store.read_table(spark, review_rollup.source)
    assert values(review_features(sums)) == values(reviews_agg(whole))


def test_sums_of_rewritten_months_are_replaced(spark, month_rollup):
    source, month = month_rollup.source, F.col("month")

    def same():
        sums = store.read_table(spark, month_rollup.root)
        whole = store.read_table(spark, source)
        assert values(interaction_features(sums)) == values(interactions_agg(whole))

    first = spark.createDataFrame(some(INTERACTIONS, 80, 1), INTERACTIONS)
    store.write_parts(first, source, month)
    refresh(spark, month_rollup)
    same()
    # One month rewritten, one added to, two left alone.
    more = spark.createDataFrame(some(INTERACTIONS, 60, 2), INTERACTIONS)
    store.write_parts(more.filter("month IN ('201001', '201101')"), source, month, ["201001"])
    todo = pending(spark, month_rollup)
    assert todo.replaced == ["201001"] and todo.runs == {"201001": [1], "201101": [1]}
    opened = pending_rows(spark, month_rollup, todo).inputFiles()
    assert all("/run_id=1/" in path for path in opened)
    refresh(spark, month_rollup, most_pieces=1)
    same()
    # A month given up without new rows.
    store.write_parts(more.filter("month = '201301'"), source, month, ["201201"])
    refresh(spark, month_rollup)
    same()
    store.write_parts(more.limit(0), source, month, ["201301"])
    refresh(spark, month_rollup)
    same()
    assert pending(spark, month_rollup).runs == {}


def test_features_of_no_rows_and_of_nulls(spark):
    rows = [("b", None, None), ("c", 5, 1)]
    df = spark.createDataFrame(rows, REVIEWS)
    assert values(review_features(review_sums(df, ["book_id"]))) == values(reviews_agg(df))
    assert review_features(review_sums(df.limit(0), ["book_id"])).count() == 0


def test_gold_opens_new_reviews_only(spark, tmp_path):
    raw = {e: f"{tmp_path}/raw/{e}" for e in jobs.ENTITIES}
    lake = jobs.Lake(spark, f"{tmp_path}/lake", raw)
    for day, moment in ((1, DAY1), (2, DAY2)):
        put(raw["books"], f"day{day}", [book(f"b{day}")])
        put(raw["reviews"], f"day{day}", [review(f"r{day}", "b1", 5), review(f"s{day}", "b2", day)])
        put(raw["interactions"], f"day{day}", [interaction(f"u{day}", "b1", "")])
        report = jobs.run_day(lake, at(moment))
        assert report["bronze_reviews"] == {"rows": 2, "rescued": 0}
    assert store.state(spark, lake.path("sums", "reviews"))["parts"] == {"all": [0, 1]}
    assert refresh(spark, jobs.rollups(lake)["reviews"]) is None
    row = lake.current("gold", "audiobook_priority").filter("book_id = 'b1'").first()
    assert (row.total_reviews, row.positive_reviews, row.total_interactions) == (2, 2, 2)


def test_append_filters_stored_ids_before_they_are_shuffled(spark, tmp_path):
    stored = spark.range(5000).selectExpr("concat('r', id) AS review_id", "id AS n")
    day = spark.range(4900, 5100).selectExpr("concat('r', id) AS review_id", "id AS n")
    store.append(stored, f"{tmp_path}/stored")
    written = store.replace(day, f"{tmp_path}/day")
    ids, fresh = (store.read_table(spark, f"{tmp_path}/{n}") for n in ("stored", "day"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        with bloom_filtered(spark, written["rows"]):
            added = new_rows(met_keys(ids, fresh, ["review_id"]), fresh, ["review_id"])
            plan = plan_of(added)
            asked = plan[plan.index("LeftSemi") : plan.rindex("Sort [review_id")]
            assert "might_contain" in asked and "FileScan parquet [review_id" in asked
            assert "bloom_filter_agg(xxhash64(review_id" in plan and "200, 65536" in plan
            assert sorted(r.n for r in added.collect()) == list(range(5000, 5100))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.numBits") == "8388608"


def test_empty_ids_are_met_like_others(spark):
    old = spark.createDataFrame([("",), ("a",)], "k string")
    new = spark.createDataFrame([("",), ("b",)], "k string")
    assert values(new_rows(met_keys(old, new, ["k"]), new, ["k"])) == [("b",)]


def test_a_junk_year_makes_no_part(spark, tmp_path):
    raw = {e: f"{tmp_path}/raw/{e}" for e in jobs.ENTITIES}
    lake = jobs.Lake(spark, f"{tmp_path}/lake", raw)
    years = ("0012", "1989", "1990", "2012", "2030", "2031", "9999")
    for day in (1, 2):
        put(raw["interactions"], f"day{day}", [
            interaction(f"u{y}", "b1", f"Tue Jun {day + 10} 08:59:04 -0700 2012", rating=day)
            | {"date_added": f"Tue Jun 12 08:59:04 -0700 {y}"} for y in years
        ])
        ingest_all(spark, [lake.feed("interactions")], NOW + dt.timedelta(days=day))
        jobs.load_interactions(lake)
    parts = store.state(spark, lake.path("silver", "interactions"))["parts"]
    assert sorted(parts) == ["199006", "201206", "203006", "undated"]
    assert values(lake.read("silver", "interactions"), "rating") == [(2,)] * len(years)


def test_buckets_spare_gold_its_shuffles(spark, tmp_path):
    raw = {e: f"{tmp_path}/raw/{e}" for e in jobs.ENTITIES}
    plain = jobs.Lake(spark, f"{tmp_path}/plain", raw)
    hashed = jobs.Lake(spark, f"{tmp_path}/hashed", raw, buckets=3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for day, moment in ((1, DAY1), (2, DAY2)):
        put(raw["books"], f"day{day}", [book(f"b{n}", count=f"{n + day}") for n in range(9)])
        put(raw["reviews"], f"day{day}", [review(f"r{day}-{n}", f"b{n}", 5) for n in range(9)])
        put(raw["interactions"], f"day{day}", [interaction(f"u{n}", f"b{n}", "") for n in range(9)])
        for lake in (plain, hashed):
            jobs.run_day(lake, at(moment))
    for name in jobs.PRODUCTS:
        tables = [lake.read("gold", name).drop("_gold_timestamp") for lake in (plain, hashed)]
        assert values(tables[0]) == values(tables[1])
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "hashpartitioning" in plan_of(jobs.signals_from(*jobs.gold_inputs(plain)))
        plan = plan_of(jobs.signals_from(*jobs.gold_inputs(hashed)))
        assert "SortMergeJoin" in plan and "hashpartitioning" not in plan
        assert "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    root = hashed.path("silver", "dim_shelves")
    assert values(catalog.bucketed(spark, root)) == values(store.read_table(spark, root))
    catalog.forget(spark, root)


def rows_scanned(df) -> int:
    """Rows the scans of a query gave out, after row groups were skipped."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    found, todo = 0, [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        stage = "QueryStage" in node.nodeName()
        children = [node.plan()] if stage else [node.children().apply(i) for i in range(node.children().size())]
        todo += children
    return found


def test_a_product_in_its_readers_order_is_read_in_part(spark, tmp_path):
    rows = spark.range(40_000).selectExpr(
        "concat('b', id) AS book_id",
        "element_at(array('High', 'Medium', 'Low'), cast(id % 3 + 1 AS int)) AS audiobook_priority",
        "cast(id * 7919 % 40009 AS double) AS popularity_score",
        "true AS is_current",
    ).repartition(4)
    conf = spark._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", "16384")
    conf.set("parquet.page.size", "1024")
    try:
        by_label = ("audiobook_priority", "popularity_score")
        store.write_versions(rows, f"{tmp_path}/plain")
        store.write_versions(rows, f"{tmp_path}/ordered", cluster=by_label)
    finally:
        conf.unset("parquet.block.size")
        conf.unset("parquet.page.size")
    best = [gold.top_priority(store.read_current(spark, f"{tmp_path}/{n}"))
            for n in ("plain", "ordered")]
    assert values(best[0]) == values(best[1])
    assert "PushedFilters: [IsNotNull(audiobook_priority)" in plan_of(best[1])
    assert rows_scanned(best[1]) < 0.6 * rows_scanned(best[0])


@pytest.fixture
def feed(tmp_path):
    return Feed("events", f"{tmp_path}/raw", f"{tmp_path}/bronze", f"{tmp_path}/checkpoint")


def test_bronze_is_counted_from_footers(spark, feed):
    for day in range(4):
        put(feed.src, f"{day}", [{"id": n} for n in range(day + 2)])
        ingest_all(spark, [feed], NOW + dt.timedelta(days=day))
    with ingest.footers_counted(spark):
        plan = plan_of(ingest.folder_counts(spark, feed))
    assert "PushedAggregation: [COUNT(*)]" in plan
    assert "PushedGroupBy: [batch, load_date]" in plan
    assert "HashAggregate" not in plan[plan.index("BatchScan") :]
    whole = read_bronze(spark, feed)
    for lag in (dt.timedelta(hours=1), dt.timedelta(days=1), dt.timedelta(days=2, hours=7),
                dt.timedelta(days=30)):
        now = NOW + dt.timedelta(days=3)
        wanted = row_count_delta(whole, LOADED_AT, now, lag)
        assert values(ingest.bronze_row_delta(spark, feed, now, lag)) == values(wanted)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_counts_of_an_empty_bronze(spark, feed):
    [(before, now, more, status)] = values(ingest.bronze_row_delta(spark, feed, NOW))
    assert (before, now, more, status) == (None, 0, None, "First load")
    assert ingest.rescued_by_day(spark, feed).count() == 0


def test_inventory_difference(spark, tmp_path):
    def listing(rows):
        return spark.createDataFrame(rows, "path string, length long, modificationTime int")

    before = listing([("a", 1, 1), ("b", 2, 1), ("c", 3, 1), ("d", 4, 1), ("e", None, None)])
    after = listing([("a", 1, 1), ("b", 5, 2), ("d", 4, 9), ("n", 7, 1), ("e", None, None)])
    assert values(files.inventory_difference(before, after)) == sorted([
        ("b", "changed", 2, 5, 3), ("c", "gone", 3, None, -3), ("d", "changed", 4, 4, 0),
        ("n", "new", None, 7, 7),
    ])
    assert files.inventory_difference(before, before).count() == 0
    assert files.inventory_difference(before.limit(0), after).filter("change <> 'new'").count() == 0


def test_listings_of_a_folder_on_two_days(spark, tmp_path):
    raw = f"{tmp_path}/raw"
    put(raw, "a", [{"n": 1}])
    put(raw, "b", [{"n": 1}])
    store.replace(files.list_files(spark, raw), f"{tmp_path}/listing")
    put(raw, "b", [{"n": 1}, {"n": 2}])
    put(raw, "c", [{"n": 1}])
    found = files.inventory_difference(
        store.read_table(spark, f"{tmp_path}/listing"), files.list_files(spark, raw)
    )
    named = found.withColumn("path", F.substring_index("path", "/", -1))
    assert values(named, "path", "change", "bytes_added") == [("b.json", "changed", 9), ("c.json", "new", 9)]


def test_live_batches_equal_days_and_count_once(spark, tmp_path):
    raw = {e: f"{tmp_path}/raw/{e}" for e in jobs.ENTITIES}
    lake = jobs.Lake(spark, f"{tmp_path}/live", raw)
    daily = jobs.Lake(spark, f"{tmp_path}/daily", raw)
    for wave in range(3):
        put(raw["reviews"], f"w{wave}", [review(f"r{n}", "b1", 1 + (wave + n) % 5) for n in range(wave, wave + 4)])
        put(raw["interactions"], f"w{wave}", [
            interaction(f"u{n}", "b1", f"Tue Jun {11 + wave} 08:59:04 -0700 2012", rating=wave + 1)
            for n in range(wave, wave + 3)])
        now = NOW + dt.timedelta(days=wave)
        live.drain_live(lake, now)
        for entity in live.JOBS:
            assert live.take_batch(lake, entity, wave, now) is None
            assert store.notes(spark, lake.path("silver", entity))["batch"] == wave
        ingest_all(spark, [daily.feed(e) for e in live.JOBS], now)
        since = now - dt.timedelta(days=1) if wave else None
        jobs.load_reviews(daily, now, since)
        jobs.load_interactions(daily, now, since)
    for entity in live.JOBS:
        assert values(lake.read("silver", entity)) == values(daily.read("silver", entity))


def test_a_batch_that_fails_after_bronze_is_taken_in_later(spark, tmp_path, monkeypatch):
    raw = {e: f"{tmp_path}/raw/{e}" for e in jobs.ENTITIES}
    lake = jobs.Lake(spark, f"{tmp_path}/lake", raw)
    put(raw["reviews"], "w0", [review("r1", "b1", 5), review("r2", "b1", 4)])
    with monkeypatch.context() as patch:
        clean, _ = live.JOBS["reviews"]
        patch.setitem(live.JOBS, "reviews", (clean, lambda *a, **k: 1 / 0))
        with pytest.raises(Exception):
            live.drain_live(lake, NOW, ("reviews",))
    assert not lake.has("silver", "reviews")
    live.drain_live(lake, NOW, ("reviews",))
    assert values(lake.read("silver", "reviews"), "review_id") == [("r1",), ("r2",)]
    assert lake.bronze("reviews").count() == 2


def test_a_live_feed_goes_on_until_it_is_stopped(spark, tmp_path):
    raw = {e: f"{tmp_path}/raw/{e}" for e in jobs.ENTITIES}
    lake = jobs.Lake(spark, f"{tmp_path}/lake", raw)
    put(raw["reviews"], "w0", [review("r1", "b1", 5)])
    query = live.start_live(lake, "reviews", every="1 second")
    try:
        query.processAllAvailable()
        put(raw["reviews"], "w1", [review("r2", "b1", 4)])
        query.processAllAvailable()
    finally:
        query.stop()
    assert values(lake.read("silver", "reviews"), "review_id") == [("r1",), ("r2",)]


def test_known_reviews_are_found_without_shuffling_whole_ones(spark, tmp_path):
    lake = jobs.Lake(spark, str(tmp_path), {})
    root, columns = lake.path("staging", "reviews"), "review_id string, book_id string, note string"
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for last in (20, 50):
            rows = [(f"r{n}", f"b{n % 3}", f"{n} of {last}") for n in range(last)]
            written = jobs.stage_reviews(spark.createDataFrame(rows, columns), root)
            staged = jobs.staged_table(spark, root)
            plan = plan_of(new_rows(spark.createDataFrame([("r1",)], "review_id string"), staged,
                                    ["review_id"]))
            assert "Bucketed: true" in plan and plan.count("hashpartitioning") == 1
            jobs.append_reviews(lake, staged, written["rows"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    kept = [(f"r{n}", f"b{n % 3}", f"{n} of {20 if n < 20 else 50}") for n in range(50)]
    assert values(lake.read("silver", "reviews")) == sorted(kept, key=repr)
    catalog.forget(spark, root)


def test_a_table_replaced_whole_takes_the_buckets_given(spark, tmp_path):
    for count in (2, 5):
        store.replace(spark.range(40).withColumnRenamed("id", "k"), str(tmp_path), buckets=(count, "k"))
        assert store.notes(spark, str(tmp_path))[store.BUCKETS] == [count, "k"]
        assert values(catalog.bucketed(spark, str(tmp_path))) == [(n,) for n in sorted(range(40), key=str)]
    catalog.forget(spark, str(tmp_path))


def test_raw_lines_are_compressed_and_split(spark, tmp_path):
    rows = spark.range(1_000_002).select("id", F.lit(None).cast("string").alias("none")).coalesce(1)
    folder = tmp_path / "lines"
    inputs.write_lines(rows, str(folder))
    found = [f.name for f in folder.iterdir() if f.name.startswith("part-")]
    assert len(found) == 3 and all(name.endswith(".json.gz") for name in found)
    lines = spark.read.text(str(folder))
    assert lines.count() == 1_000_002
    assert lines.filter(F.contains("value", F.lit('"none":null'))).count() == 1_000_002


def test_large_books_are_joined_by_number(spark, tmp_path):
    parts = [(n, f"name {n}", "Brand#1", f"TYPE {n}", n % 50) for n in (1, 2, 3, 5)]
    spark.createDataFrame(
        parts, "p_partkey int, p_name string, p_brand string, p_type string, p_size int"
    ).write.parquet(f"{tmp_path}/part.parquet")
    lines = [(7, 1, 4, 1, "A"), (7, 2, 4, 2, "N"), (8, 2, 6, 1, "R"), (9, 4, 6, 1, "R"), (9, None, 6, 2, "R")]
    spark.createDataFrame(
        lines, "l_orderkey long, l_partkey int, l_suppkey int, l_linenumber int, l_returnflag string"
    ).selectExpr("*", "2.0D AS l_quantity", "timestamp_ntz'1998-05-01' AS l_shipdate").write.parquet(
        f"{tmp_path}/lineitem.parquet"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        books = inputs.whole_books(spark, str(tmp_path))
        assert "hashpartitioning(l_partkey" in plan_of(books)
        found = values(books, "book_id", "title", "ratings_count")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == [("1", " name 1 ", "2"), ("2", " name 2 ", "2"), ("2", " name 2 ", "3")]
    assert books.columns[:4] == ["book_id", "authors", "popular_shelves", "l_shipdate"]


def test_raw_lines_are_written_in_narrow_splits(spark, tmp_path):
    """Tasks take few rows each, whatever the session's splits are."""
    wanted = []
    rows = spark.range(10)

    class Noted:
        sparkSession = spark
        _jdf = rows._jdf

        @property
        def write(self):
            return self

        def option(self, *_):
            return self

        def json(self, folder):
            wanted.append(int(spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("b")))

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    inputs.write_lines(Noted(), str(tmp_path / "lines"))
    assert wanted == [16 << 20] and spark.conf.get("spark.sql.files.maxPartitionBytes") == before
