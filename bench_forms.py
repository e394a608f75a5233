"""Time the chosen form of a job against the plain one it replaces, on the same data.

    python bench_forms.py [sf_dir]

One warm-up, then the median of 3. Both forms of a pair write what they compute.
"""

from __future__ import annotations

import statistics
import sys
import time

from pyspark.sql import DataFrame, functions as F

from marlstone import fixed_values as fixed
from marlstone.functions.kinds import by_kind
from marlstone.operators import features, mutations
from marlstone.operators.dedupe import latest_per_key
from marlstone.operators.rows import clean
from marlstone.plans import activity, books, gold
from marlstone.session import build_session, scratch_dir
from marlstone.sources import store
from marlstone.workload import inputs
from marlstone.workload.inputs import AS_OF

TRACKED = ["num_pages", "publisher"]
KEYS = ["user_id", "book_id"]
UPDATES = ["review_id", "is_read", "rating", "date_updated", "has_review"]


def sink(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


class Forms:
    def __init__(self, spark, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.reviews = self.kept(inputs.raw_reviews(spark, sf_dir))
        self.interactions = self.kept(inputs.raw_interactions(spark, sf_dir))
        self.deliveries = self.kept(inputs.raw_deliveries(spark, sf_dir))
        self.books = self.kept(books.staging_books(inputs.raw_books(spark, sf_dir)))
        self.shelves = self.kept(books.dim_shelves(self.deliveries, dedupe_books=False))
        self.bridge = self.kept(books.bridge_book_authors(self.deliveries))
        self.silver_reviews = self.kept(activity.staging_reviews(self.reviews))
        self.silver_interactions = self.kept(activity.staging_interactions(self.interactions))
        self.dim = self.kept(inputs.stored_parts(spark, sf_dir))
        self.incoming = self.kept(inputs.incoming_parts(spark, sf_dir))
        self.target = self.kept(inputs.merge_target(spark, sf_dir))
        self.source = self.kept(inputs.merge_source(spark, sf_dir))
        self.day = self.kept(self.source.filter("date_added >= '2024-01-30'"))

    def kept(self, df: DataFrame) -> DataFrame:
        path = scratch_dir(self.spark, "form")
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    # cleaning and deduplication of reviews

    def clean_ranked(self):
        sink(activity.staging_reviews(self.reviews))

    def clean_drop_duplicates(self):
        kept = activity.valid_reviews(self.reviews).dropDuplicates(["review_id"])
        sink(clean(kept, by_kind(activity.REVIEW_KINDS)))

    # newest row per key

    # one result for both: the last row by date as it is written, other columns breaking ties

    def newest_ranked(self):
        sink(latest_per_key(self.interactions, ["user_id", "book_id"], ["date_updated"]))

    def newest_struct(self):
        rest = [c for c in self.interactions.columns if c not in ("user_id", "book_id")]
        order = ["date_updated", *[c for c in rest if c != "date_updated"]]
        newest = F.max(F.struct(*order)).alias("row")
        rows = self.interactions.groupBy("user_id", "book_id").agg(newest)
        sink(rows.select("user_id", "book_id", "row.*"))

    # versioned dimension

    def scd2_one_join(self):
        root = scratch_dir(self.spark, "form")
        current = self.dim.filter("is_current")
        store.write_versions(
            mutations.scd2_delta(current, self.incoming, ["book_id"], TRACKED, AS_OF), root
        )

    def scd2_expire_then_insert(self):
        """Close changed rows and rewrite; read back, left join, count, append."""
        path = scratch_dir(self.spark, "form")
        new = self.incoming.select("book_id", F.struct(*TRACKED).alias("new"))
        differs = mutations.changed([(F.col(c), F.col("new")[c]) for c in TRACKED])
        hit = F.col("is_current") & differs
        until = F.when(hit, F.lit(AS_OF)).otherwise(F.col("valid_to"))
        closed = self.dim.join(new, "book_id", "left").withColumns(
            {"is_current": F.col("is_current") & ~hit, "valid_to": until}
        )
        closed.drop("new").write.parquet(path)
        now = self.spark.read.parquet(path).filter("is_current").select("book_id")
        fresh = self.incoming.join(now, "book_id", "left_anti")
        if fresh.count():
            mutations.versioned(fresh, AS_OF).write.mode("append").parquet(path)

    # shelf columns

    def shelves_one_pass(self):
        sink(features.label_columns(self.shelves))

    def shelves_by_label(self):
        wide = None
        for label, name in fixed.SHELF_SIGNALS.items():
            part = self.shelves.filter(F.col("shelf_name") == label)
            column = part.select("book_id", F.col("shelf_count").alias(name))
            wide = column if wide is None else wide.join(column, "book_id", "full")
        sink(wide)

    # newest-wins merge

    def day_full_join(self):
        self._merge(self.day)

    def day_update_then_insert(self):
        self._update_then_insert(self.day)

    def half_full_join(self):
        self._merge(self.source)

    def half_update_then_insert(self):
        self._update_then_insert(self.source)

    def _merge(self, source: DataFrame):
        sink(mutations.merge_newest(self.target, source, KEYS, "date_updated", UPDATES))

    def _update_then_insert(self, source: DataFrame):
        fresh = source.select(*KEYS, F.struct(*UPDATES).alias("new"))
        newer = F.col("new.date_updated") > F.col("date_updated")
        takes = F.col("new").isNotNull() & (F.col("date_updated").isNull() | newer)
        updated = self.target.join(fresh, KEYS, "left").withColumns(
            {c: F.when(takes, F.col("new")[c]).otherwise(F.col(c)) for c in UPDATES}
        )
        added = mutations.new_rows(self.target, source, KEYS)
        sink(updated.drop("new").unionByName(added))

    # both products

    def products_shared(self):
        signals = self.kept(self._signals())
        sink(gold.priority_rows(signals))
        sink(gold.feature_rows(signals))

    def products_apart(self):
        sink(gold.priority_rows(self._signals()))
        sink(gold.feature_rows(self._signals()))

    def _signals(self):
        return gold.book_signals(
            self.books, self.silver_reviews, self.silver_interactions, self.shelves, self.bridge
        )


PAIRS = {
    "clean and dedupe reviews": ("clean_ranked", "clean_drop_duplicates"),
    "newest interaction per key": ("newest_ranked", "newest_struct"),
    "versioned dimension": ("scd2_one_join", "scd2_expire_then_insert"),
    "shelf columns": ("shelves_one_pass", "shelves_by_label"),
    "newest-wins merge, one day": ("day_full_join", "day_update_then_insert"),
    "newest-wins merge, half": ("half_full_join", "half_update_then_insert"),
    "both gold products": ("products_shared", "products_apart"),
}


def median(run) -> float:
    taken = []
    for _ in range(4):
        begun = time.perf_counter()
        run()
        taken.append(time.perf_counter() - begun)
    return statistics.median(taken[1:])


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(
        "forms", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    forms = Forms(spark, sf_dir)
    for job, (chosen, plain) in PAIRS.items():
        ours, other = median(getattr(forms, chosen)), median(getattr(forms, plain))
        print(f"{job:28} {chosen:18} {ours:6.2f} s   {plain:24} {other:6.2f} s", flush=True)


if __name__ == "__main__":
    main()
