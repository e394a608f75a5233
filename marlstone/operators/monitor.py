"""Counts and summaries, each one pass over its table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def row_count_delta(
    df: DataFrame, ts_col: str, now: dt.datetime | Column, lag: dt.timedelta = dt.timedelta(days=1)
) -> DataFrame:
    """Rows now, rows `lag` ago and the difference.

    Where nothing was there `lag` ago, the earlier count and the difference are NULL and the
    status says so, so the columns keep their number type.
    """
    cutoff = (now if isinstance(now, Column) else F.lit(now)) - F.lit(lag)
    counts = df.agg(
        F.count_if(F.col(ts_col) <= cutoff).alias("_before"),
        F.count(F.lit(1)).alias("_now"),
    )
    return count_delta(counts, F.col("_before"), F.col("_now"))


def count_delta(counts: DataFrame, before: Column, today: Column) -> DataFrame:
    """One row of two counts as yesterday, today, difference and status."""
    yesterday = F.nullif(before, F.lit(0))
    return counts.select(
        yesterday.alias("yesterday"),
        today.alias("today"),
        (today - yesterday).alias("difference"),
        F.when(yesterday.isNull(), "First load").otherwise("Loaded").alias("status"),
    )


def version_counts(dim: DataFrame, flag: str = "is_current") -> DataFrame:
    return dim.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(flag)).alias("current"),
        F.count_if(~F.col(flag)).alias("history"),
    )


def layer_summary(
    tables: Mapping[str, tuple[DataFrame, str]], flag: str = "is_current"
) -> DataFrame:
    """One row per table: name, rows, current rows, and its note such as the load strategy.

    A table without the flag counts as current throughout.
    """
    lines = [
        df.agg(
            F.count(F.lit(1)).alias("rows"),
            (F.count_if(F.col(flag)) if flag in df.columns else F.count(F.lit(1))).alias("current"),
        ).select(F.lit(name).alias("table"), "rows", "current", F.lit(note).alias("strategy"))
        for name, (df, note) in tables.items()
    ]
    return reduce(DataFrame.unionByName, lines)
