"""The registered queries. Each reads whole tables and returns a DataFrame.

Run times are never part of a result; dates the jobs would take from the clock are literals.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from marlstone import fixed_values as fixed
from marlstone.functions.cleaning import (
    at_least,
    at_most,
    megabytes,
    null_if,
    pseudonymise,
    safe_cast,
)
from marlstone.functions.kinds import by_kind
from marlstone.functions.times import date_key, parse_offset_ts
from marlstone.operators import features, manifest, monitor, mutations, rows
from marlstone.operators.calendar import calendar as whole_calendar, calendar_of
from marlstone.plans import activity, books, gold, live
from marlstone.plans import lake as jobs
from marlstone.plans.rollup import refresh
from marlstone.session import buckets_for, narrow_splits, prepared, scratch_dir
from marlstone.sources import catalog, files, store
from marlstone.sources.schema import infer_or_load_schema
from marlstone.streaming import ingest
from marlstone.streaming.ingest import Feed, ingest_all, read_bronze, waiting_fields
from marlstone.workload import inputs
from marlstone.workload.inputs import AS_OF, EARLIER, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_TIMES = ("last_updated_at", "_staging_timestamp")
BASES = {"complete": "site/whole/", "byGenre": "site/genre/"}
FOLDERS = {word: f"raw/{word}/" for word in (fixed.WHOLE_SET_TYPE, *fixed.NAME_KEYWORDS)}


def query(make: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with prepared(spark):
            return make(spark, sf_dir)

    QUERIES[make.__name__] = run
    return run


def seconds(df: DataFrame, *cols: str) -> DataFrame:
    """Timestamps as epoch seconds, which read the same in every time zone."""
    return df.withColumns({c: F.unix_timestamp(c) for c in cols})


# Cleaning and typing


@query
def clean_books(spark, sf_dir):
    return books.staging_books(inputs.raw_books(spark, sf_dir)).drop(*RUN_TIMES)


@query
def parse_offset_timestamps(spark, sf_dir):
    raw = inputs.raw_reviews(spark, sf_dir)
    return raw.select(
        "review_id",
        F.unix_timestamp(parse_offset_ts("date_added")).alias("added"),
        F.unix_timestamp(parse_offset_ts("read_at")).alias("read"),
        F.unix_timestamp(parse_offset_ts("started_at")).alias("started"),
        date_key(parse_offset_ts("date_added")).alias("date_id"),
    )


@query
def pseudonymise_users(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", pseudonymise("c_custkey").alias("user_id")
    )


@query
def sentiment_flags(spark, sf_dir):
    return inputs.raw_reviews(spark, sf_dir).select(
        "review_id",
        "book_id",
        safe_cast("n_votes", "int").alias("n_votes"),
        null_if("rating", 0).alias("score"),
        at_least("rating", fixed.POSITIVE_FROM).alias("is_positive"),
        at_most("rating", fixed.NEGATIVE_UP_TO).alias("is_negative"),
    )


@query
def null_expectations(spark, sf_dir):
    cleaned = rows.clean(inputs.raw_books(spark, sf_dir), by_kind(books.BOOK_KINDS))
    return rows.null_counts(
        cleaned, ["book_id", "title", "average_rating", "publication_month", "is_ebook"]
    )


# One row per key


@query
def dedupe_reviews(spark, sf_dir):
    staged = activity.staging_reviews(inputs.raw_reviews(spark, sf_dir)).drop(*RUN_TIMES)
    return seconds(staged, "date_added", "date_updated", "read_at", "started_at")


@query
def latest_interactions(spark, sf_dir):
    staged = activity.staging_interactions(inputs.raw_interactions(spark, sf_dir))
    dates = ("date_added", "date_updated", "read_at", "started_at", "last_updated_at")
    return seconds(staged.drop("_staging_timestamp"), *dates)


# Nested arrays


@query
def role_default(spark, sf_dir):
    listed = books.book_author_rows(inputs.raw_deliveries(spark, sf_dir))
    return listed.select("book_id", "author_id", "role")


@query
def author_versions(spark, sf_dir):
    return books.author_versions(inputs.raw_deliveries(spark, sf_dir))


@query
def bridge_item_authors(spark, sf_dir):
    return books.bridge_book_authors(inputs.raw_deliveries(spark, sf_dir))


@query
def author_list(spark, sf_dir):
    return features.author_list(books.bridge_book_authors(inputs.raw_deliveries(spark, sf_dir)))


@query
def canonical_shelves(spark, sf_dir):
    return books.dim_shelves(inputs.raw_deliveries(spark, sf_dir), dedupe_books=False)


@query
def canonical_shelves_latest(spark, sf_dir):
    return books.dim_shelves(inputs.raw_deliveries(spark, sf_dir), dedupe_books=True)


@query
def top_shelves(spark, sf_dir):
    return books.top_shelves(
        books.dim_shelves(inputs.raw_deliveries(spark, sf_dir), dedupe_books=False)
    )


@query
def shelf_signals(spark, sf_dir):
    return features.label_columns(
        books.dim_shelves(inputs.raw_deliveries(spark, sf_dir), dedupe_books=False)
    )


# Aggregates and calendar


@query
def calendar(spark, sf_dir):
    return calendar_of(table(spark, sf_dir, "orders"), "o_orderdate")


@query
def orders_by_weekday(spark, sf_dir):
    """The calendar dimension joined to a fact."""
    orders = table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("full_date"), "o_totalprice"
    )
    return (
        orders.join(whole_calendar(spark), "full_date")
        .groupBy("year", "quarter", "month_name", "day_of_week")
        .agg(F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("largest"))
    )


@query
def reviews_agg(spark, sf_dir):
    return features.reviews_agg(activity.staging_reviews(inputs.raw_reviews(spark, sf_dir)))


@query
def interactions_agg(spark, sf_dir):
    staged = activity.staging_interactions(inputs.raw_interactions(spark, sf_dir))
    return features.interactions_agg(staged)


# Table mutations

PART_TRACKED = ("num_pages", "publisher")


@query
def scd2_first_load(spark, sf_dir):
    return mutations.scd2_apply(
        None, inputs.offered_parts(spark, sf_dir), ["book_id"], PART_TRACKED, AS_OF
    )


def _second_day(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    stored = inputs.stored_parts(spark, sf_dir)
    incoming = inputs.incoming_parts(spark, sf_dir)
    return mutations.scd2_apply(stored, incoming, ["book_id"], PART_TRACKED, AS_OF, **options)


@query
def scd2_second_day(spark, sf_dir):
    return _second_day(spark, sf_dir)


@query
def scd2_null_safe(spark, sf_dir):
    return _second_day(spark, sf_dir, nulls="distinct")


@query
def scd2_current(spark, sf_dir):
    return rows.current_rows(_second_day(spark, sf_dir))


@query
def scd2_version_counts(spark, sf_dir):
    return monitor.version_counts(_second_day(spark, sf_dir))


@query
def scd2_authors(spark, sf_dir):
    """Authors as known from the deliveries before 1999, then from all of them."""
    raw = inputs.raw_deliveries(spark, sf_dir)
    early = books.author_versions(raw.filter("_ingestion_timestamp < '1999-01-01'"))
    first = mutations.scd2_apply(None, early, ["author_id"], fixed.AUTHOR_TRACKED, EARLIER)
    return mutations.scd2_apply(
        first, books.author_versions(raw), ["author_id"], fixed.AUTHOR_TRACKED, AS_OF
    )


@query
def append_new_reviews(spark, sf_dir):
    """Reviews loaded before 1999 are stored; all reviews come in."""
    raw = inputs.raw_reviews(spark, sf_dir)
    stored = activity.staging_reviews(raw.filter("_ingestion_timestamp < '1999-01-01'"))
    table_ = mutations.append_new(stored, activity.staging_reviews(raw), ["review_id"])
    return table_.select("review_id", "book_id", "user_id", "rating", "review_text", "n_votes")


@query
def append_to_stored_reviews(spark, sf_dir):
    """The same by the daily job: a stored table, of whose ids few are shuffled."""
    lake = jobs.Lake(spark, scratch_dir(spark, "append"), {})
    raw, staged = inputs.raw_reviews(spark, sf_dir), lake.path("staging", "reviews")
    for day in (raw.filter("_ingestion_timestamp < '1999-01-01'"), raw):
        with narrow_splits(day):
            written = jobs.stage_reviews(activity.staging_reviews(day), staged)
        jobs.append_reviews(lake, catalog.bucketed(spark, staged), written["rows"])
    return lake.read("silver", "reviews").select(
        "review_id", "book_id", "user_id", "rating", "review_text", "n_votes"
    )


@query
def summed_up_signals(spark, sf_dir):
    """Partial sums brought up to date over three days, two of which correct earlier ones."""
    base = scratch_dir(spark, "sums")
    lake = jobs.Lake(spark, base, {})
    reviews, interactions = (lake.path("silver", n) for n in ("reviews", "interactions"))
    clean = activity.staging_reviews(inputs.raw_reviews(spark, sf_dir))
    events = activity.staging_interactions(inputs.raw_interactions(spark, sf_dir))
    day_added, last = F.coalesce("date_id", F.lit("undated")), F.substring("date_id", 8, 1)
    wrong = events.withColumns({"rating": F.lit(5), "is_read": F.lit(1)})
    for day in range(3):
        due = clean.filter(F.crc32(F.col("review_id").cast("binary")) % 3 == day)
        store.append(due.select("review_id", "book_id", "rating", "n_votes"), reviews)
        if day == 0:
            store.write_parts(wrong, interactions, day_added)
        else:
            odd = F.coalesce(last.cast("int") % 2 == day - 1, F.lit(day == 1))
            held = store.state(spark, interactions)["parts"]
            redone = [n for n in held if (int(n[-1]) % 2 if n[-1].isdigit() else 0) == day - 1]
            store.write_parts(events.filter(odd), interactions, day_added, redone)
        for rollup in jobs.rollups(lake).values():
            refresh(spark, rollup)
    rated = features.review_features(lake.read("sums", "reviews"))
    used = features.interaction_features(lake.read("sums", "interactions"))
    return rated.join(used, "book_id", "full")


@query
def merge_newest_interactions(spark, sf_dir):
    merged = mutations.merge_newest(
        inputs.merge_target(spark, sf_dir),
        inputs.merge_source(spark, sf_dir),
        ["user_id", "book_id"],
        "date_updated",
        fixed.INTERACTION_UPDATES,
    )
    micros = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    dates = ("date_added", "date_updated", "last_updated_at")
    return merged.drop("read_at", "started_at").withColumns(
        {c: F.date_format(c, micros) for c in dates}
    )


@query
def supersede_snapshot(spark, sf_dir):
    """Three snapshots of the parts, the last with a column more, the second made twice."""
    part = table(spark, sf_dir, "part")
    january = part.filter("p_partkey % 3 <> 0").selectExpr("p_partkey AS book_id", "p_size AS score")
    february = part.selectExpr("p_partkey AS book_id", "p_size + 1 AS score")
    march = part.filter("p_partkey % 4 <> 0").selectExpr(
        "p_partkey AS book_id", "p_size + 2 AS score", "p_brand AS label"
    )
    first = mutations.snapshot_supersede(None, january, EARLIER)
    wrong = february.withColumn("score", F.col("score") - 100)
    once = mutations.snapshot_supersede(first, wrong, AS_OF)
    second = mutations.snapshot_supersede(once, february, AS_OF)
    return mutations.snapshot_supersede(second, march, dt.date(2024, 3, 1))


# Gold products


def _signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    deliveries = inputs.raw_deliveries(spark, sf_dir)
    return gold.book_signals(
        books.staging_books(inputs.raw_books(spark, sf_dir)),
        activity.staging_reviews(inputs.raw_reviews(spark, sf_dir)),
        activity.staging_interactions(inputs.raw_interactions(spark, sf_dir)),
        books.dim_shelves(deliveries, dedupe_books=False),
        books.bridge_book_authors(deliveries),
    )


@query
def priority_product(spark, sf_dir):
    snapshot = gold.as_snapshot(gold.priority_rows(_signals(spark, sf_dir)), AS_OF)
    return snapshot.drop("_gold_timestamp")


@query
def feature_product(spark, sf_dir):
    snapshot = gold.as_snapshot(gold.feature_rows(_signals(spark, sf_dir)), AS_OF)
    return snapshot.drop("_gold_timestamp")


@query
def top_priority(spark, sf_dir):
    product = gold.priority_rows(_signals(spark, sf_dir))
    return gold.top_priority(product).select(*fixed.TOP_TITLE_COLUMNS)


@query
def bucketed_signals(spark, sf_dir):
    """The feature product from tables kept hashed on the book, joined without a shuffle."""
    buckets = buckets_for(8, *(table(spark, sf_dir, t) for t in ("lineitem", "events", "part")))
    lake = jobs.Lake(spark, scratch_dir(spark, "bucketed"), {}, buckets=buckets)
    deliveries, by_book = inputs.raw_deliveries(spark, sf_dir), lake.by_book()
    current = mutations.versioned(books.staging_books(inputs.raw_books(spark, sf_dir)), EARLIER)
    store.write_versions(current, lake.path("silver", "dim_books"), buckets=by_book)
    for name, rows_ in (
        ("dim_shelves", books.dim_shelves(deliveries, dedupe_books=False)),
        ("bridge_book_authors", books.bridge_book_authors(deliveries)),
    ):
        store.replace(rows_, lake.path("silver", name), buckets=by_book)
    reviews, events = inputs.raw_reviews(spark, sf_dir), inputs.raw_interactions(spark, sf_dir)
    with narrow_splits(reviews, events):
        store.append(activity.staging_reviews(reviews), lake.path("silver", "reviews"))
        store.write_parts(
            activity.staging_interactions(events),
            lake.path("silver", "interactions"),
            jobs.added_month(),
        )
    for rollup in jobs.rollups(lake).values():
        refresh(spark, rollup)
    rows_ = gold.feature_rows(jobs.signals_from(*jobs.gold_inputs(lake)))
    return gold.as_snapshot(rows_, AS_OF).drop("_gold_timestamp")


@query
def clustered_top(spark, sf_dir):
    """The best titles of a stored product, written by label and score."""
    root = scratch_dir(spark, "clustered")
    product = gold.as_snapshot(gold.priority_rows(_signals(spark, sf_dir)), AS_OF)
    store.write_versions(product, root, cluster=("audiobook_priority", "popularity_score"))
    best = gold.top_priority(store.read_current(spark, root))
    return best.select(*fixed.TOP_TITLE_COLUMNS)


# Files and catalogues


@query
def catalogue_counts(spark, sf_dir):
    return features.count_by(inputs.order_catalogue(spark, sf_dir), "type", "files")


@query
def route_files(spark, sf_dir):
    catalogue = inputs.order_catalogue(spark, sf_dir).select("type", "name")
    return manifest.route_files(catalogue, BASES, FOLDERS)


def _manifest_and_listing(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every order's file is wanted; about a third are there already."""
    routed = manifest.route_files(inputs.order_catalogue(spark, sf_dir), BASES, FOLDERS)
    return routed.drop("length"), routed.filter("length % 3 = 0").select("path", "length")


@query
def pending_files(spark, sf_dir):
    return manifest.pending_files(*_manifest_and_listing(spark, sf_dir))


@query
def file_status_summary(spark, sf_dir):
    return manifest.status_summary(
        manifest.fetch_status(*_manifest_and_listing(spark, sf_dir)).fillna({"size_mb": 0.0})
    )


@query
def read_catalogue(spark, sf_dir):
    """Orders written as catalogue lines, one in five broken, and read back."""
    folder = scratch_dir(spark, "catalogue")
    lines = inputs.order_catalogue(spark, sf_dir).selectExpr(
        "CASE cast(regexp_extract(name, '([0-9]+)', 1) AS bigint) % 10"
        " WHEN 3 THEN name WHEN 7 THEN concat(type, ',', name, ',more')"
        " WHEN 5 THEN concat('  ', type, ' ,  ', name, ' ')"
        " ELSE concat(type, ',', name) END AS `type, name`"
    )
    lines.write.option("header", True).option("sep", "\u0001").option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(folder)
    return files.read_catalogue(spark, folder)


@query
def manifest_job(spark, sf_dir):
    """Orders written as a catalogue, and the checked manifest made of it."""
    folder = scratch_dir(spark, "manifest")
    lines = inputs.order_catalogue(spark, sf_dir).select("type", "name")
    lines.write.option("header", True).csv(folder)
    return jobs.build_manifest(spark, folder, BASES, FOLDERS)


@query
def file_sizes(spark, sf_dir):
    """Orders' file names written as text, a folder per type, and the bytes listed there."""
    folder = scratch_dir(spark, "sizes")
    names = inputs.order_catalogue(spark, sf_dir).select(F.col("name").alias("value"), "type")
    names.write.partitionBy("type").text(folder)
    listed = files.list_files(spark, folder).withColumn(
        "type", F.regexp_extract("path", "/type=([A-Za-z]+)/", 1)
    )
    sums = listed.groupBy("type").agg(F.sum("length").alias("bytes"))
    return sums.withColumn("size_mb", megabytes("bytes"))


@query
def inventory_difference(spark, sf_dir):
    """Two listings of parts' names, a folder per brand: some changed, some new, some gone."""
    base, part = scratch_dir(spark, "inventory"), table(spark, sf_dir, "part")
    brand = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int")
    lines = part.select(F.col("p_name").alias("value"), brand.alias("brand"))
    more = part.filter(brand % 3 == 0).select(F.lit("more").alias("value"), brand.alias("brand"))
    waves = (lines.filter("brand % 5 <> 0"), lines.unionAll(more).filter("brand % 7 <> 0"))
    listings = []
    for n, rows_ in enumerate(waves):
        rows_.repartition("brand").write.partitionBy("brand").text(f"{base}/{n}")
        listed = files.list_files(spark, f"{base}/{n}").filter("length > 0")
        store.replace(
            listed.select(
                F.regexp_extract("path", "/(brand=[0-9]+)/", 1).alias("folder"),
                "length",
                F.lit(0).alias("modificationTime"),
            ),
            f"{base}/listing{n}",
        )
    found = [store.read_table(spark, f"{base}/listing{n}") for n in range(2)]
    return files.inventory_difference(*found, key="folder")


# Monitoring


@query
def bronze_row_delta(spark, sf_dir):
    """Events taken in on five days; a bronze table's rows now and two days before the last."""
    base = scratch_dir(spark, "delta")
    feed = Feed("events", f"{base}/raw", f"{base}/bronze", f"{base}/checkpoint")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    start = dt.datetime(2024, 1, 31, 6, tzinfo=dt.timezone.utc)
    for day in range(5):
        events.filter(F.col("event_id") % 5 == day).write.json(f"{feed.src}/{day}")
        ingest_all(spark, [feed], start + dt.timedelta(days=day))
    return ingest.bronze_row_delta(spark, feed, start + dt.timedelta(days=4), dt.timedelta(days=2))


@query
def row_count_delta(spark, sf_dir):
    now = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)
    return monitor.row_count_delta(table(spark, sf_dir, "events"), "ts", now, dt.timedelta(days=2))


@query
def read_as_of(spark, sf_dir):
    cutoff = dt.datetime(2024, 1, 20, 12, tzinfo=dt.timezone.utc)
    events = rows.read_as_of(table(spark, sf_dir, "events"), "ts", cutoff)
    return features.count_by(events, "event_type", "events")


@query
def layer_summary(spark, sf_dir):
    deliveries = inputs.raw_deliveries(spark, sf_dir)
    return monitor.layer_summary(
        {
            "dim_books": (_second_day(spark, sf_dir), "SCD Type 2"),
            "bridge_book_authors": (books.bridge_book_authors(deliveries), "Overwrite"),
            "reviews": (activity.staging_reviews(inputs.raw_reviews(spark, sf_dir)), "Append only"),
        }
    )


# Stored tables and ingest


@query
def published_table(spark, sf_dir):
    """Replaced, then appended to with one column more, after an earlier run was replaced."""
    root = scratch_dir(spark, "orders")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    store.ensure_table(spark, root, lambda: orders.filter("o_orderstatus = 'F'"))
    store.replace(orders.filter("o_orderstatus <> 'F'"), root)
    store.append(orders.filter("o_orderstatus = 'F'").withColumn("late", F.lit(1)), root)
    return store.read_table(spark, root)


@query
def versioned_table(spark, sf_dir):
    """The two-day dimension as the job stores it: current rows rewritten, closed ones added."""
    root = scratch_dir(spark, "parts")
    store.write_versions(inputs.stored_parts(spark, sf_dir), root)
    delta = mutations.scd2_delta(
        store.read_current(spark, root),
        inputs.incoming_parts(spark, sf_dir),
        ["book_id"],
        PART_TRACKED,
        AS_OF,
    )
    store.write_versions(delta, root)
    return store.read_table(spark, root)


@query
def registered_table(spark, sf_dir):
    """Row counts through the catalog name of a versioned table."""
    root, name = scratch_dir(spark, "registered"), f"registered_{uuid.uuid4().hex}.parts"
    store.write_versions(inputs.stored_parts(spark, sf_dir), root)
    delta = mutations.supersede_delta(
        store.read_current(spark, root), inputs.incoming_parts(spark, sf_dir), AS_OF
    )
    store.write_versions(delta, root)
    catalog.register_table(spark, name, root)
    return spark.sql(
        f"SELECT count(*) AS total_rows, count_if(is_current) AS current_rows FROM {name}"
    )


@query
def inferred_json(spark, sf_dir):
    """Orders as JSON, read back with the schema found in them and kept."""
    base = scratch_dir(spark, "inferred")
    columns = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    table(spark, sf_dir, "orders").select(*columns).write.json(f"{base}/raw")
    infer_or_load_schema(spark, f"{base}/raw", f"{base}/schema.json")
    kept = infer_or_load_schema(spark, f"{base}/raw", f"{base}/schema.json", evolve=False)
    return spark.read.schema(kept).json(f"{base}/raw").select(*columns)


@query
def stream_ingest(spark, sf_dir):
    """Events as JSON, drained in two goes; the second has new fields and broken lines.

    One of the new fields is inside a struct.
    """
    base = scratch_dir(spark, "ingest")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    feed = Feed("events", f"{base}/raw", f"{base}/bronze", f"{base}/checkpoint")
    known, added = (F.col("event_id") % 7).alias("known"), (F.col("event_id") % 5).alias("added")
    early, late = events.filter("event_id % 2 = 0"), events.filter("event_id % 2 = 1")
    early = early.withColumn("more", F.struct(known))
    late = late.withColumn("more", F.struct(known, added))
    early.write.json(f"{base}/raw/early")
    ingest_all(spark, [feed])
    late.withColumn("source", F.lit("late")).write.json(f"{base}/raw/late")
    broken = late.filter("event_id % 101 = 0").select(F.concat(F.lit("{broken "), "event_id"))
    broken.write.text(f"{base}/raw/broken")
    ingest_all(spark, [feed])
    ingest_all(spark, [feed])
    return read_bronze(spark, feed).select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "source",
        "more.known",
        "more.added",
        F.col("_rescued_line").alias("broken_line"),
        F.regexp_extract("_source_file", "/raw/([a-z]+)/", 1).alias("wave"),
        F.col("_ingestion_timestamp").isNotNull().alias("dated"),
    )


@query
def growing_types(spark, sf_dir):
    """Parts as JSON in three goes: a number, then fractions, then text, beside it and in a list.

    Rows taken in while the type was narrower are cast when they are read.
    """
    base = scratch_dir(spark, "types")
    feed = Feed("parts", f"{base}/raw", f"{base}/bronze", f"{base}/checkpoint")
    part = table(spark, sf_dir, "part")
    size, third = F.col("p_size").cast("long"), F.col("p_partkey") % 3
    for wave, value in enumerate((size, size + 0.5, F.concat("p_size", F.lit(" cm")))):
        inner = size + 0.5 if wave == 1 else size
        due = part.filter(third == wave).select(
            "p_partkey", value.alias("width"), (size + 0.25 if wave else size).alias("depth"),
            F.array(F.struct(inner.alias("x"))).alias("sides"),
        )
        due.write.json(f"{feed.src}/wave{wave}")
        ingest_all(spark, [feed])
    return read_bronze(spark, feed).select(
        "p_partkey", "width", "depth", F.col("sides")[0]["x"].alias("side"),
        F.col("_rescued_line").isNotNull().alias("rescued"),
    )


def _part_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as JSON lines with fields a first schema does not know; every tenth is broken."""
    part = table(spark, sf_dir, "part")
    brand = F.when(F.col("p_partkey") % 4 != 0, F.col("p_brand"))
    line = F.to_json(
        F.struct(
            "p_partkey", F.struct("p_name", F.col("p_size").alias("size")).alias("what"),
            brand.alias("brand"), F.array("p_type").alias("types"),
        )
    )
    broken = F.concat(F.lit("{broken "), "p_partkey")
    value = F.when(F.col("p_partkey") % 10 == 0, broken).otherwise(line).alias("value")
    return part.select("p_partkey", value)


def _part_feed(base: str, known: str) -> Feed:
    return Feed(
        "parts", f"{base}/raw", f"{base}/bronze", f"{base}/checkpoint",
        schema=StructType.fromDDL(known), rescue="fields",
    )


@query
def promoted_fields(spark, sf_dir):
    """Fields kept aside as VARIANT, then declared: rows loaded before have their values."""
    base = scratch_dir(spark, "promoted")
    lines = _part_lines(spark, sf_dir)
    first = _part_feed(base, "p_partkey long, what struct<p_name:string>")
    second = _part_feed(
        base, "p_partkey long, what struct<p_name:string,size:long>, brand string"
    )
    for feed, wave in ((first, 0), (second, 1)):
        due = lines.filter(F.col("p_partkey") % 2 == wave)
        due.select("value").write.text(f"{base}/raw/wave{wave}")
        ingest_all(spark, [feed])
    return read_bronze(spark, second).select(
        "p_partkey", "what.p_name", "what.size", "brand",
        F.try_variant_get(F.col("_rescued_fields"), "$.types[0]", "string").alias("waiting_type"),
        F.col("_rescued_line").alias("broken_line"),
    )


@query
def waiting_fields_by_name(spark, sf_dir):
    """The names and types of all that a feed's schema does not know yet."""
    base = scratch_dir(spark, "waiting")
    feed = _part_feed(base, "p_partkey long, what struct<p_name:string>")
    _part_lines(spark, sf_dir).select("value").write.text(f"{base}/raw/wave0")
    ingest_all(spark, [feed])
    return waiting_fields(spark, feed)


@query
def rescued_by_day(spark, sf_dir):
    """Broken lines counted per entity and load date, over two days."""
    base = scratch_dir(spark, "rescued")
    raw = {entity: f"{base}/raw/{entity}" for entity in jobs.ENTITIES}
    lake = jobs.Lake(spark, f"{base}/lake", raw)
    _two_days_of_lines(lake, sf_dir)
    return jobs.rescued_lines(lake)


def _two_days_of_lines(lake: jobs.Lake, sf_dir: str) -> None:
    """Three feeds of JSON lines, some broken, taken in on two days: even keys, then odd ones."""
    spark = lake.spark
    order = F.to_json(F.struct("o_orderkey", "o_orderstatus"))
    lines = {
        "books": _part_lines(spark, sf_dir).toDF("key", "value"),
        "reviews": table(spark, sf_dir, "orders").select(
            "o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, "[").otherwise(order)
        ).toDF("key", "value"),
        "interactions": table(spark, sf_dir, "customer").select(
            "c_custkey", F.to_json(F.struct("c_custkey", "c_name"))
        ).toDF("key", "value"),
    }
    for day, now in enumerate((AS_OF, AS_OF + dt.timedelta(days=1))):
        for entity, rows_ in lines.items():
            due = rows_.filter(F.col("key") % 2 == day)
            due.select("value").write.text(f"{lake.raw[entity]}/day{day}")
        jobs.ingest_bronze(lake, dt.datetime(now.year, now.month, now.day, 9, tzinfo=dt.timezone.utc))


@query
def monitored_feeds(spark, sf_dir):
    """What monitoring says of three feeds an hour after their second day."""
    base = scratch_dir(spark, "monitored")
    raw = {entity: f"{base}/raw/{entity}" for entity in jobs.ENTITIES}
    lake = jobs.Lake(spark, f"{base}/lake", raw)
    _two_days_of_lines(lake, sf_dir)
    now = dt.datetime(AS_OF.year, AS_OF.month, AS_OF.day + 1, 10, tzinfo=dt.timezone.utc)
    return jobs.monitored_rows(lake, now)


@query
def file_inventory(spark, sf_dir):
    """Sizes of orders' file names written as text, a file per type, as the inventory lists them."""
    folder = scratch_dir(spark, "inventory")
    names = inputs.order_catalogue(spark, sf_dir).select(F.col("name").alias("value"), "type")
    names.repartition("type").write.partitionBy("type").text(folder)
    return files.file_inventory(spark, folder).filter("size_mb IS NOT NULL").select(
        "size_mb",
        F.col("file_name").rlike("^part-[0-9]+.*[.]txt$").alias("named"),
        F.to_timestamp("last_modified").isNotNull().alias("dated"),
    )


@query
def day_report(spark, sf_dir):
    """What a first day took in and wrote, as its report tells it."""
    base = scratch_dir(spark, "report")
    raw = {entity: f"{base}/raw/{entity}" for entity in jobs.ENTITIES}
    lake = jobs.Lake(spark, f"{base}/lake", raw)
    for entity, rows_ in (
        ("books", inputs.whole_books(spark, sf_dir).drop("l_shipdate")),
        ("reviews", inputs.raw_reviews(spark, sf_dir).drop("_ingestion_timestamp")),
        ("interactions", inputs.raw_interactions(spark, sf_dir)),
    ):
        inputs.write_lines(rows_, raw[entity])
    now = dt.datetime(AS_OF.year, AS_OF.month, AS_OF.day, tzinfo=dt.timezone.utc)
    report = jobs.run_day(lake, now, AS_OF)
    wanted = ("bronze_books", "bronze_reviews", "bronze_interactions", "reviews", "interactions")
    return jobs.report_table(spark, {name: report[name] for name in wanted})


@query
def live_silver(spark, sf_dir):
    """Reviews and interactions taken in batch by batch; batches run again change nothing."""
    base = scratch_dir(spark, "live")
    raw = {entity: f"{base}/raw/{entity}" for entity in ("reviews", "interactions")}
    lake = jobs.Lake(spark, f"{base}/lake", raw)
    records = {
        "reviews": (inputs.raw_reviews(spark, sf_dir).withColumnRenamed(
            "_ingestion_timestamp", "l_shipdate"), F.col("l_shipdate") < "1999-01-01"),
        "interactions": (inputs.raw_interactions(spark, sf_dir, keep=["ts"]),
                         F.col("ts") < "2024-01-16"),
    }
    for wave in range(2):
        for entity, (rows_, early) in records.items():
            due = rows_.filter(early if wave == 0 else ~early).drop("l_shipdate", "ts")
            inputs.write_lines(due, f"{raw[entity]}/wave{wave}")
        live.drain_live(lake)
        for entity in records:
            live.take_batch(lake, entity, wave)
    rated = features.reviews_agg(lake.read("silver", "reviews"))
    used = features.interactions_agg(lake.read("silver", "interactions"))
    return rated.drop("avg_votes").join(used.select("book_id", "total_interactions", "total_read"),
                                        "book_id", "full")


@query
def lake_two_days(spark, sf_dir):
    """From JSON files to the business product, in two daily runs as a user starts them.

    The first day brings what was shipped before 1999 and the events up to mid January.
    """
    base = scratch_dir(spark, "lake")
    raw = {entity: f"{base}/raw/{entity}" for entity in jobs.ENTITIES}
    lake = jobs.Lake(spark, f"{base}/lake", raw)
    shipped, happened = F.col("l_shipdate"), F.col("ts")
    records = {
        "books": (inputs.whole_books(spark, sf_dir), shipped),
        "reviews": (inputs.raw_reviews(spark, sf_dir).withColumnRenamed(
            "_ingestion_timestamp", "l_shipdate"), shipped),
        "interactions": (inputs.raw_interactions(spark, sf_dir, keep=["ts"]), happened),
    }
    for day, as_of in enumerate((AS_OF, AS_OF + dt.timedelta(days=1))):
        for entity, (rows_, moment) in records.items():
            turn = F.lit("2024-01-16" if entity == "interactions" else "1999-01-01")
            due = moment < turn if day == 0 else moment >= turn
            inputs.write_lines(
                rows_.filter(due).drop("l_shipdate", "ts"), f"{raw[entity]}/day{day}"
            )
        now = dt.datetime(as_of.year, as_of.month, as_of.day, tzinfo=dt.timezone.utc)
        jobs.run_day(lake, now, as_of)
    return lake.current("gold", "audiobook_priority").drop("_gold_timestamp")
