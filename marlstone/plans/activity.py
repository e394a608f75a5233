"""Reviews and interactions: clean, typed, one row per key."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from marlstone import fixed_values as fixed
from marlstone.functions.cleaning import at_least, at_most, present, safe_cast, stamp
from marlstone.functions.kinds import by_kind
from marlstone.functions.times import date_key, parse_offset_ts
from marlstone.operators.dedupe import dedupe, latest_per_key
from marlstone.operators.rows import clean, require
from marlstone.plans.books import with_load_time

REVIEW_KINDS = {
    "review_id": "plain",
    "book_id": "plain",
    "user_id": "hashed",
    "rating": "int",
    "review_text": "plain",
    "n_votes": "int",
    "n_comments": "int",
    "date_added": "time",
    "date_updated": "time",
    "read_at": "time",
    "started_at": "time",
}

INTERACTION_KINDS = {
    "user_id": "hashed",
    "book_id": "plain",
    "review_id": "plain",
    "is_read": "flag",
    "rating": "score",
    "date_added": "time",
    "date_updated": "time",
    "read_at": "time",
    "started_at": "time",
}


def valid_reviews(raw: DataFrame) -> DataFrame:
    low, high = fixed.REVIEW_RATING_RANGE
    rated = safe_cast("rating", "int").between(low, high)
    return require(with_load_time(raw, REVIEW_KINDS), "review_id", "book_id").filter(rated)


def staging_reviews(raw: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    """One clean row per rated review; dates are parsed and ids hashed for survivors only."""
    survivors = dedupe(valid_reviews(raw), ["review_id"])
    return clean(survivors, by_kind(REVIEW_KINDS)).withColumns(
        {
            "is_positive": at_least("rating", fixed.POSITIVE_FROM),
            "is_negative": at_most("rating", fixed.NEGATIVE_UP_TO),
            "date_id": date_key("date_added"),
            "last_updated_at": stamp(now),
            "_staging_timestamp": stamp(now),
        }
    )


def latest_interactions(raw: DataFrame) -> DataFrame:
    """The newest raw row per user and book; ties go to the highest review id."""
    known = require(raw.select(*INTERACTION_KINDS), "user_id", "book_id")
    dated = known.withColumn("_updated", parse_offset_ts("date_updated"))
    return latest_per_key(dated, ["user_id", "book_id"], ["_updated", "review_id"]).drop("_updated")


def staging_interactions(
    raw: DataFrame, now: dt.datetime | None = None, blank_reviews: bool = True
) -> DataFrame:
    """One clean row per user and book. An empty review id counts as a review by default."""
    return clean(latest_interactions(raw), by_kind(INTERACTION_KINDS)).withColumns(
        {
            "has_review": present("review_id", blank=blank_reviews),
            "date_id": date_key("date_added"),
            "last_updated_at": F.col("date_updated"),
            "_staging_timestamp": stamp(now),
        }
    )
