"""A lake folder, and the jobs that fill it day by day.

Each job reads stored tables, and writes one run of one table. Nothing is handed from job to
job in memory, so any of them can be run again alone after a failure.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from marlstone import fixed_values as fixed
from marlstone.functions.cleaning import stamp
from marlstone.operators import manifest as files
from marlstone.operators.calendar import calendar
from marlstone.operators.features import (
    interaction_features,
    interaction_sums,
    review_features,
    review_sums,
)
from marlstone.operators.monitor import layer_summary
from marlstone.operators.mutations import (
    merge_matches,
    merge_newest,
    met_keys,
    new_rows,
    replace_keys,
    scd2_delta,
    supersede_delta,
)
from marlstone.operators.rows import expect_no_nulls
from marlstone.plans import activity, books, gold
from marlstone.plans.rollup import Rollup, refresh
from marlstone.session import bloom_filtered, narrow_splits, sized_for
from marlstone.sources import catalog, fs, store
from marlstone.sources.files import file_inventory, read_catalogue
from marlstone.streaming.ingest import (
    Feed,
    bronze_row_delta,
    drain,
    feed_log,
    ingest_all,
    read_bronze,
    rescued_by_day,
)

ENTITIES = ("books", "reviews", "interactions")
STRATEGIES = fixed.STRATEGIES
PRODUCTS = {"audiobook_priority": "business", "book_features": "modelling"}


@dataclass(frozen=True)
class Lake:
    """Where the tables are. `raw` maps an entity to its folder of JSON files.

    `feeds` holds `Feed` settings for ingest, such as `max_bytes` or `spread`. With `buckets` what
    gold reads is kept hashed on the book in that many files a run, and gold joins it without a
    shuffle; a table that is added to keeps the number it began with.
    """

    spark: SparkSession
    root: str
    raw: dict[str, str]
    feeds: dict = field(default_factory=dict)
    buckets: int | None = None

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def feed(self, entity: str) -> Feed:
        out, checkpoint = self.path("bronze", entity), self.path("checkpoints", entity)
        return Feed(entity, self.raw[entity], out, checkpoint, **self.feeds)

    def bronze(self, entity: str, since: dt.datetime | None = None) -> DataFrame:
        return read_bronze(self.spark, self.feed(entity), since)

    def read(self, layer: str, name: str, parts: Collection[str] | None = None) -> DataFrame:
        return store.read_table(self.spark, self.path(layer, name), parts=parts)

    def by_book(self) -> tuple[int, str] | None:
        return (self.buckets, "book_id") if self.buckets else None

    def read_by_book(self, layer: str, name: str) -> DataFrame:
        return staged_table(self.spark, self.path(layer, name))

    def current(self, layer: str, name: str) -> DataFrame:
        return store.read_current(self.spark, self.path(layer, name))

    def stored(self, name: str, since: dt.datetime | None) -> DataFrame | None:
        """The silver table a run adds to; None where it starts from all of bronze."""
        if since is None or not self.has("silver", name):
            return None
        return self.read("silver", name)

    def has(self, layer: str, name: str) -> bool:
        return store.has_table(self.spark, self.path(layer, name))


def build_manifest(
    spark: SparkSession, catalogue_path: str, bases: dict[str, str], folders: dict[str, str]
) -> DataFrame:
    """Catalogue file to checked manifest: name, type, address, target path."""
    catalogue = read_catalogue(spark, catalogue_path)
    manifest = files.route_files(catalogue, bases, folders, unknown="null")
    expect_no_nulls(manifest, ["url", "path"])
    return manifest


def ingest_bronze(lake: Lake, now: dt.datetime | None = None) -> DataFrame:
    return ingest_all(lake.spark, [lake.feed(e) for e in ENTITIES], now)


def rescued_lines(lake: Lake) -> DataFrame:
    """Per entity and load date: rows, and lines kept whole because they could not be read.

    No silver job takes rescued lines, so a day that has any has lost them until they are mended.
    """
    parts = [
        rescued_by_day(lake.spark, lake.feed(e)).select(F.lit(e).alias("entity"), "*")
        for e in ENTITIES
    ]
    return reduce(DataFrame.unionAll, parts)


def _staged(lake: Lake, name: str, build: Callable[[DataFrame], DataFrame], since) -> DataFrame:
    """Write the cleaned snapshot and read it back, so that later steps do not clean again."""
    raw, root = lake.bronze(name, since), lake.path("staging", name)
    with sized_for(raw), narrow_splits(raw):
        stage(name, build(raw), root)
    return staged_table(lake.spark, root)


def stage(name: str, rows: DataFrame, root: str) -> dict[str, int]:
    return stage_reviews(rows, root) if name == "reviews" else store.replace(rows, root)


def stage_reviews(rows: DataFrame, root: str) -> dict[str, int]:
    """Write clean reviews hashed on their id, as their ranking leaves them.

    The joins that find those stored already then move ids, never whole reviews.
    """
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return store.replace(rows, root, buckets=(count, "review_id"))


def staged_table(spark: SparkSession, root: str) -> DataFrame:
    """A stored table, by its buckets where it has any."""
    if store.BUCKETS in store.notes(spark, root):
        return catalog.bucketed(spark, root)
    return store.read_table(spark, root)


def _apply_scd2(
    lake: Lake, name: str, source: DataFrame, keys, tracked, as_of, nulls, buckets=None
) -> dict:
    """Current rows are rewritten, closed ones added; stored history is not even read."""
    current = lake.current("silver", name) if lake.has("silver", name) else None
    delta = scd2_delta(current, source, keys, tracked, as_of, nulls)
    with sized_for(source if current is None else current, source):
        return store.write_versions(delta, lake.path("silver", name), buckets=buckets)


def load_books(lake: Lake, as_of: dt.date, now=None, since=None, nulls: str = "sql") -> dict:
    """Clean the books and open a new version of each whose tracked columns changed.

    `since` limits the work to rows loaded after that time. A key missing from the source
    stays current, so the result is the same as over all rows.
    """
    staged = _staged(lake, "books", lambda raw: books.staging_books(raw, now), since)
    source = staged.withColumn("_silver_timestamp", stamp(now))
    return _apply_scd2(
        lake, "dim_books", source, ["book_id"], fixed.BOOK_TRACKED, as_of, nulls, lake.by_book()
    )


def load_authors(lake: Lake, as_of: dt.date, now=None, since=None, nulls: str = "sql") -> dict:
    raw = lake.bronze("books", since)
    source = books.author_versions(raw).withColumn("_silver_timestamp", stamp(now))
    return _apply_scd2(lake, "dim_authors", source, ["author_id"], fixed.AUTHOR_TRACKED, as_of, nulls)


def load_bridge(lake: Lake, now=None, since=None) -> dict:
    """With `since`, pairs delivered after it replace the stored ones; the others are kept."""
    raw = lake.bronze("books", since)
    rows = books.bridge_book_authors(raw)
    stored = lake.stored("bridge_book_authors", since)
    merged = replace_keys(stored, rows, ["book_id", "author_id"])
    with sized_for(raw.select("book_id", "authors"), rows if stored is None else stored):
        return store.replace(
            merged.withColumn("_silver_timestamp", stamp(now)),
            lake.path("silver", "bridge_book_authors"),
            buckets=lake.by_book(),
        )


def load_shelves(lake: Lake, now=None, since=None, dedupe_books: bool = True) -> dict:
    """With `since`, books delivered after it get their shelves anew; the others are kept.

    Where all deliveries add up, all are read each time: adding to stored counts would count a
    delivery again when a run is repeated.
    """
    since = since if dedupe_books else None
    raw = lake.bronze("books", since)
    rows = books.dim_shelves(raw, dedupe_books)
    stored = lake.stored("dim_shelves", since)
    arrived = raw.select(F.col("book_id").cast("string").alias("book_id"))
    merged = replace_keys(stored, rows, ["book_id"], arrived)
    with sized_for(raw.select("book_id", "popular_shelves"), rows if stored is None else stored):
        return store.replace(
            merged.withColumn("_silver_timestamp", stamp(now)),
            lake.path("silver", "dim_shelves"),
            buckets=lake.by_book(),
        )


def load_calendar(lake: Lake) -> DataFrame:
    return store.ensure_table(
        lake.spark, lake.path("silver", "dim_date"), lambda: calendar(lake.spark)
    )


def load_reviews(lake: Lake, now=None, since=None) -> dict:
    """Add reviews not seen before; a stored review never changes."""
    staged = _staged(lake, "reviews", lambda raw: activity.staging_reviews(raw, now), since)
    return append_reviews(lake, staged, store.rows_written(lake.spark, lake.path("staging", "reviews")))


def append_reviews(lake: Lake, staged: DataFrame, rows: int, **options) -> dict:
    """Add those of a written table of clean reviews, `rows` in all, that are not stored yet.

    Of the stored table the ids are read, and few of them shuffled.
    """
    root = lake.path("silver", "reviews")
    if not store.has_table(lake.spark, root):
        with sized_for(staged):
            return store.append(staged, root, **options)
    ids = lake.read("silver", "reviews").select("review_id")
    with sized_for(ids, staged), bloom_filtered(lake.spark, rows):
        known = met_keys(ids, staged, ["review_id"])
        return store.append(new_rows(known, staged, ["review_id"]), root, **options)


def added_month():
    """The month an interaction was added, which a merge never changes: the part it is kept in.

    Dates are free text. Those outside the calendar's span share a part with the missing ones, so
    that there are never more parts than months in the calendar, and one.
    """
    first, last = (d.strftime("%Y%m") for d in (fixed.CALENDAR_START, fixed.CALENDAR_END))
    month = F.substring("date_id", 1, 6)
    return F.when(month.between(first, last), month).otherwise("undated")


def load_interactions(lake: Lake, now=None, since=None) -> dict:
    """Merge newest-wins, rewriting only the months in which a row changes."""
    staged = _staged(
        lake, "interactions", lambda raw: activity.staging_interactions(raw, now), since
    )
    rows = store.rows_written(lake.spark, lake.path("staging", "interactions"))
    return merge_interactions(lake, staged, rows)


def merge_interactions(lake: Lake, staged: DataFrame, rows: int, **options) -> dict:
    """Merge a written table of clean interactions, `rows` in all, one per user and book.

    A first pass over the keys finds the stored rows the source meets. Months without a change
    stay as they are, or are added to where new rows fall into them.
    """
    root, keys = lake.path("silver", "interactions"), ["user_id", "book_id"]
    if not lake.has("silver", "interactions"):
        with sized_for(staged):
            return store.write_parts(staged, root, added_month(), **options)

    stored = lake.read("silver", "interactions")
    # Spark filters the stored side by a side it takes for selective; every user passes this test.
    wanted = staged.filter(F.col("user_id") >= "")
    matches = merge_matches(stored, wanted, keys, "date_updated", added_month())
    read = stored.select(*keys, "date_updated", "date_id")
    with sized_for(read, staged), bloom_filtered(lake.spark, rows):
        store.replace(matches, lake.path("staging", "interaction_matches"))
    matches = lake.read("staging", "interaction_matches")
    months = [r.part for r in matches.filter("newer").select("part").distinct().collect()]
    unchanged = matches.filter(~F.col("part").isin(months)).select(*keys)
    touched = lake.read("silver", "interactions", parts=months)
    merged = merge_newest(
        touched,
        staged.join(unchanged, keys, "left_anti"),
        keys,
        "date_updated",
        fixed.INTERACTION_UPDATES,
    )
    with sized_for(touched, staged):
        return store.write_parts(merged, root, added_month(), replaced=months, **options)


def rollups(lake: Lake) -> dict[str, Rollup]:
    """The partial sums gold keeps of the two large tables, per book and part."""
    wanted = {
        "reviews": (("book_id", "rating", "n_votes"), review_sums),
        "interactions": (("book_id", "is_read", "has_review", "rating"), interaction_sums),
    }
    return {
        name: Rollup(
            lake.path("silver", name), lake.path("sums", name), ("book_id",), columns, sums,
            lake.by_book(),
        )
        for name, (columns, sums) in wanted.items()
    }


def gold_inputs(lake: Lake) -> list[DataFrame]:
    """Current books, the sums of reviews and interactions, shelves and the bridge to authors."""
    books_ = lake.read_by_book("silver", "dim_books").filter("is_current")
    if not lake.buckets:
        books_ = lake.current("silver", "dim_books")
    wanted = (
        ("sums", "reviews"), ("sums", "interactions"), ("silver", "dim_shelves"),
        ("silver", "bridge_book_authors"),
    )
    return [books_, *(lake.read_by_book(layer, name) for layer, name in wanted)]


def signals_from(books_, review_sums_, interaction_sums_, shelves, bridge) -> DataFrame:
    rated, used = review_features(review_sums_), interaction_features(interaction_sums_)
    return gold.signals_of(books_, rated, used, shelves, bridge)


def load_gold(lake: Lake, as_of: dt.date, now=None) -> dict:
    """Both products from one wide table, written once and read twice.

    Each is written in the order its readers ask for it: by label and score, by score.
    Of reviews and interactions only new runs and rewritten months are opened: the sums of the
    others are kept.
    """
    for rollup in rollups(lake).values():
        refresh(lake.spark, rollup)
    tables = gold_inputs(lake)
    with sized_for(*tables):
        store.replace(signals_from(*tables), lake.path("staging", "book_signals"))
    signals = lake.read("staging", "book_signals")
    report = {}
    for name, rows, cluster in (
        ("audiobook_priority", gold.priority_rows(signals), ("audiobook_priority", "popularity_score")),
        ("book_features", gold.feature_rows(signals), ("popularity_score",)),
    ):
        snapshot = gold.as_snapshot(rows, as_of, now)
        former = lake.current("gold", name) if lake.has("gold", name) else None
        delta = supersede_delta(former, snapshot, as_of)
        report[name] = store.write_versions(
            delta, lake.path("gold", name), "APPEND", cluster=cluster
        )
    return report


def register_gold(lake: Lake, schema: str = "gold") -> None:
    for name in PRODUCTS:
        catalog.register_table(lake.spark, f"{schema}.{name}", lake.path("gold", name))


def run_silver(lake: Lake, as_of: dt.date, now=None, since=None) -> dict[str, dict]:
    report = {
        "dim_books": load_books(lake, as_of, now, since),
        "dim_authors": load_authors(lake, as_of, now, since),
        "bridge_book_authors": load_bridge(lake, now, since),
        "dim_shelves": load_shelves(lake, now, since),
        "reviews": load_reviews(lake, now, since),
        "interactions": load_interactions(lake, now, since),
    }
    load_calendar(lake)
    return report


def loaded_until(lake: Lake) -> dt.datetime | None:
    """The ingest time up to which all of bronze has reached gold; None before the first day."""
    path = f"{lake.root}/loaded_until.txt"
    if not fs.exists(lake.spark, path):
        return None
    return dt.datetime.fromisoformat(fs.read_text(lake.spark, path).strip())


def run_day(lake: Lake, now: dt.datetime, as_of: dt.date | None = None) -> dict[str, dict]:
    """Every job in turn, over the rows that came in since the last day that went through.

    After a failure simply run it again: rows the failed day took in are still to be loaded.
    `now` has to be later than that of the last day that went through, or what comes in under
    it would count as loaded already.
    """
    since, as_of = loaded_until(lake), as_of or now.date()
    if since is not None and now <= since:
        raise ValueError(f"{now} is not after {since}, up to which everything has been loaded")
    landed = drain(lake.spark, [lake.feed(e) for e in ENTITIES], now)
    report = {
        f"bronze_{name}": {"rows": found.rows, "rescued": found.rescued}
        for name, found in landed.items()
    }
    report |= run_silver(lake, as_of, now, since) | load_gold(lake, as_of, now)
    fs.write_text(lake.spark, f"{lake.root}/loaded_until.txt", now.isoformat(), overwrite=True)
    return report


def report_table(spark: SparkSession, report: dict[str, dict[str, int]]) -> DataFrame:
    """Row counts of the runs just made, as observed while writing: table, metric, value."""
    lines = [(name, metric, n) for name, found in report.items() for metric, n in found.items()]
    return spark.createDataFrame(lines, "table string, metric string, value long")


def silver_summary(lake: Lake) -> DataFrame:
    return layer_summary(
        {name: (lake.read("silver", name), note) for name, note in STRATEGIES.items()}
    )


def gold_summary(lake: Lake) -> DataFrame:
    return layer_summary(
        {name: (lake.read("gold", name), note) for name, note in PRODUCTS.items()}
    )


def top_titles(lake: Lake, n: int = 10) -> DataFrame:
    product = lake.current("gold", "audiobook_priority")
    return gold.top_priority(product, n).select(*fixed.TOP_TITLE_COLUMNS)


def monitored_rows(
    lake: Lake, now: dt.datetime, lag: dt.timedelta = dt.timedelta(days=1)
) -> DataFrame:
    """Row counts of all bronze tables against `lag` ago, a row per entity."""
    parts = [
        bronze_row_delta(lake.spark, lake.feed(e), now, lag).select(F.lit(e).alias("entity"), "*")
        for e in ENTITIES
    ]
    return reduce(DataFrame.unionAll, parts)


def monitor(lake: Lake, now: dt.datetime, lag: dt.timedelta = dt.timedelta(days=1)) -> dict:
    """Per bronze table: row counts against `lag` ago, last runs, and the raw files' sizes."""
    return {
        entity: {
            "rows": bronze_row_delta(lake.spark, lake.feed(entity), now, lag),
            "history": store.table_history(lake.spark, feed_log(lake.feed(entity))),
            "files": file_inventory(lake.spark, lake.raw[entity]),
        }
        for entity in ENTITIES
    }
