"""Reviews and interactions kept up to date batch by batch, as files arrive.

Each batch goes to bronze, and from there its rows alone into silver: one row per key, then appended
or merged. The silver run that takes a batch in notes the batch's number and is committed with it,
so a batch that is run again after a failure changes nothing. Numbers are those of the feed's
checkpoint: who starts a checkpoint anew has to start silver anew as well, or take the files in by
the daily jobs.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from marlstone.plans import activity
from marlstone.plans.lake import Lake, append_reviews, merge_interactions, stage, staged_table
from marlstone.session import narrow_splits, sized_for
from marlstone.sources import store
from marlstone.streaming.ingest import After, Feed, ingest_all, read_bronze, start_ingest

BATCH = "batch"
JOBS = {
    "reviews": (activity.staging_reviews, append_reviews),
    "interactions": (activity.staging_interactions, merge_interactions),
}


def take_batch(
    lake: Lake, entity: str, batch: int, now: dt.datetime | None = None
) -> dict[str, int] | None:
    """Bring one bronze batch into silver; None where it is in already.

    Batches are taken in the order of their numbers, as a stream hands them over.
    """
    spark, silver = lake.spark, lake.path("silver", entity)
    if store.notes(spark, silver).get(BATCH, -1) >= batch:
        return None
    clean, put = JOBS[entity]
    raw, staging = read_bronze(spark, lake.feed(entity), batch=batch), lake.path("live", entity)
    with sized_for(raw), narrow_splits(raw):
        written = stage(entity, clean(raw, now), staging)
    return put(lake, staged_table(spark, staging), written["rows"], notes={BATCH: batch})


def into_silver(lake: Lake, now: dt.datetime | None = None) -> After:
    """What a feed does after each of its batches. A batch has a session of its own."""

    def after(spark: SparkSession, feed: Feed, batch: int) -> None:
        take_batch(replace(lake, spark=spark), feed.name, batch, now)

    return after


def drain_live(
    lake: Lake, now: dt.datetime | None = None, entities: tuple[str, ...] = tuple(JOBS)
) -> DataFrame:
    """Take in whatever files are there, batch by batch up to silver, and stop."""
    return ingest_all(lake.spark, [lake.feed(e) for e in entities], now, into_silver(lake, now))


def start_live(lake: Lake, entity: str, every: str = "1 minute") -> StreamingQuery:
    """Go on taking in files as they arrive, until the query is stopped."""
    return start_ingest(lake.spark, lake.feed(entity), after=into_silver(lake), every=every)
