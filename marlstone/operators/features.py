"""Per-item aggregates and the wide join.

Each aggregate combines map-side, so only one partial row per key and task is shuffled,
and comes out hashed on the key, which the joins reuse.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from marlstone import fixed_values as fixed


def reviews_agg(
    reviews: DataFrame, key: str = "book_id", rating: str = "rating", votes: str = "n_votes"
) -> DataFrame:
    return reviews.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_reviews"),
        F.round(F.avg(rating), 2).alias("avg_review_rating"),
        F.count_if(F.col(rating) >= fixed.POSITIVE_FROM).alias("positive_reviews"),
        F.count_if(F.col(rating) <= fixed.NEGATIVE_UP_TO).alias("negative_reviews"),
        F.round(F.avg(votes), 2).alias("avg_votes"),
    )


def interactions_agg(
    interactions: DataFrame,
    key: str = "book_id",
    read: str = "is_read",
    reviewed: str = "has_review",
    rating: str = "rating",
) -> DataFrame:
    return interactions.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_interactions"),
        F.sum(read).alias("total_read"),
        F.sum(reviewed).alias("total_reviewed"),
        F.round(F.avg(rating), 2).alias("avg_interaction_rating"),
    )


def review_sums(
    reviews: DataFrame, keys: Sequence[str], rating: str = "rating", votes: str = "n_votes"
) -> DataFrame:
    """What `review_features` needs of some of the reviews: sums that add up over any split."""
    return reviews.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("reviews"),
        F.sum(F.col(rating).cast("long")).alias("rating_sum"),
        F.count(rating).alias("rating_count"),
        F.count_if(F.col(rating) >= fixed.POSITIVE_FROM).alias("positive"),
        F.count_if(F.col(rating) <= fixed.NEGATIVE_UP_TO).alias("negative"),
        F.sum(F.col(votes).cast("long")).alias("votes_sum"),
        F.count(votes).alias("votes_count"),
    )


def review_features(sums: DataFrame, key: str = "book_id") -> DataFrame:
    """`reviews_agg` from partial sums, several rows per key."""
    return add_up(sums, [key]).select(
        key,
        F.col("reviews").alias("total_reviews"),
        mean_of("rating_sum", "rating_count").alias("avg_review_rating"),
        F.col("positive").alias("positive_reviews"),
        F.col("negative").alias("negative_reviews"),
        mean_of("votes_sum", "votes_count").alias("avg_votes"),
    )


def interaction_sums(
    interactions: DataFrame,
    keys: Sequence[str],
    read: str = "is_read",
    reviewed: str = "has_review",
    rating: str = "rating",
) -> DataFrame:
    """What `interaction_features` needs of some of the interactions."""
    return interactions.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("interactions"),
        F.sum(read).alias("read"),
        F.sum(reviewed).alias("reviewed"),
        F.sum(F.col(rating).cast("long")).alias("rating_sum"),
        F.count(rating).alias("rating_count"),
    )


def interaction_features(sums: DataFrame, key: str = "book_id") -> DataFrame:
    """`interactions_agg` from partial sums, several rows per key."""
    return add_up(sums, [key]).select(
        key,
        F.col("interactions").alias("total_interactions"),
        F.col("read").alias("total_read"),
        F.col("reviewed").alias("total_reviewed"),
        mean_of("rating_sum", "rating_count").alias("avg_interaction_rating"),
    )


def add_up(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partial sums put together: one row per key, every other column summed."""
    rest = [c for c in sums.columns if c not in keys]
    return sums.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in rest])


def mean_of(total: str, count: str, digits: int = 2) -> Column:
    """A rounded mean; NULL where nothing was counted."""
    return F.round(F.try_divide(F.col(total).cast("double"), F.col(count)), digits)


def label_totals(df: DataFrame, keys: Sequence[str], value: str, total: str) -> DataFrame:
    """Sum of `value` per key combination."""
    return df.groupBy(*keys).agg(F.sum(value).alias(total))


def label_columns(
    df: DataFrame,
    key: str = "book_id",
    label: str = "shelf_name",
    value: str = "shelf_count",
    columns: Mapping[str, str] = fixed.SHELF_SIGNALS,
) -> DataFrame:
    """One column per wanted label, in a single scan and aggregate.

    `df` holds each (key, label) once, as `label_totals` leaves it.
    """
    picks = [
        F.max(F.when(F.col(label) == word, F.col(value))).alias(name)
        for word, name in columns.items()
    ]
    return df.filter(F.col(label).isin(*columns)).groupBy(key).agg(*picks)


def joined_list(
    df: DataFrame, key: str, value: str, alias: str, separator: str = ", "
) -> DataFrame:
    """Values per key as one sorted text; keys without a value drop out.

    The list is the cell of one row, so one aggregate gathers and sorts it.
    """
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(key)
        .agg(F.concat_ws(separator, F.array_sort(F.collect_list(value))).alias(alias))
    )


def author_list(
    bridge: DataFrame, key: str = "book_id", role: str = fixed.DEFAULT_ROLE
) -> DataFrame:
    """Ids of the item's authors proper, other roles left out."""
    return joined_list(bridge.filter(F.col("role") == role), key, "author_id", "author_ids")


def enrich(base: DataFrame, *features: DataFrame, on: str = "book_id") -> DataFrame:
    """Left join features that hold each key at most once, so no row multiplies."""
    wide = base
    for feature in features:
        wide = wide.join(feature, on, "left")
    return wide


def count_by(df: DataFrame, col: str, alias: str = "n") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(alias))
