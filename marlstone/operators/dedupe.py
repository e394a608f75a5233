"""One row per key, the same one on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import MapType, VariantType


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ()
) -> DataFrame:
    """The first row per key by `order`; names sort descending with NULLs last.

    All other sortable columns break ties, so rows that still tie are equal and the result
    does not depend on input order or partitioning. A NULL key is a group of its own.

    Spark plans the rank filter as a group limit on both sides of the shuffle: each map
    task sends at most one row per key, so a key holding most of the rows stays cheap.
    """
    named = {o for o in order if isinstance(o, str)} | set(keys)
    ties = [
        f.name
        for f in df.schema.fields
        if f.name not in named and not isinstance(f.dataType, (MapType, VariantType))
    ]
    sort = [
        F.col(o).desc_nulls_last() if isinstance(o, str) else o for o in [*order, *ties]
    ] or [F.lit(1)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*sort))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def dedupe(
    df: DataFrame, keys: Sequence[str], loaded_at: str | None = "_ingestion_timestamp"
) -> DataFrame:
    """Drop repeated keys, keeping the row loaded last where a load time column is there."""
    order = [loaded_at] if loaded_at in df.columns else []
    return latest_per_key(df, keys, order)


def dedupe_repeated(
    df: DataFrame, keys: Sequence[str], loaded_at: str = "_ingestion_timestamp"
) -> DataFrame:
    """`dedupe` for narrow rows that repeat a lot, such as one row per mention of an author.

    Equal rows are folded by a hash aggregate first, so little is left to sort and shuffle.
    """
    if loaded_at not in df.columns:
        return dedupe(df.distinct(), keys)
    rest = [c for c in df.columns if c != loaded_at]
    return dedupe(df.groupBy(*rest).agg(F.max(loaded_at).alias(loaded_at)), keys, loaded_at)
