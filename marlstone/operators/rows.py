"""Row-level operators: select lists, filters, expectations, nested arrays, top-n."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def clean(df: DataFrame, spec: Mapping[str, Column]) -> DataFrame:
    """Select exactly the columns of `spec`, name -> expression, in its order."""
    return df.select(*[expr.alias(name) for name, expr in spec.items()])


def require(df: DataFrame, *cols: str, blank: bool = True) -> DataFrame:
    """Keep rows whose `cols` are all set. With blank=False empty text is dropped too."""
    tests = [F.col(c).isNotNull() for c in cols]
    if not blank:
        tests += [F.col(c) != "" for c in cols]
    return df.filter(reduce(lambda a, b: a & b, tests))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the number of NULLs of each column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def expect_no_nulls(df: DataFrame, cols: Sequence[str]) -> None:
    """Raise when a column is missing or holds a NULL."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    found = {c: n for c, n in null_counts(df, cols).first().asDict().items() if n}
    if found:
        raise ValueError(f"NULLs found: {found}")


def explode_structs(
    df: DataFrame, array: str, fields: Mapping[str, str], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per array element, with `fields` (struct field -> column) and the `keep` columns.

    Rows whose array is NULL or empty drop out.
    """
    element = F.col("_element")
    return df.select(*keep, F.explode(array).alias("_element")).select(
        *keep, *[element.getField(field).alias(name) for field, name in fields.items()]
    )


def current_rows(df: DataFrame, flag: str = "is_current") -> DataFrame:
    return df.filter(F.col(flag))


def read_as_of(df: DataFrame, ts_col: str, cutoff) -> DataFrame:
    """The rows an append-only table held at `cutoff`."""
    return df.filter(F.col(ts_col) <= F.lit(cutoff))


def loaded_after(df: DataFrame, ts_col: str, since) -> DataFrame:
    """The rows that came in after `since`; all of them when it is None."""
    return df if since is None else df.filter(F.col(ts_col) > F.lit(since))


def top_n(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """First n rows by `order`; names sort descending with NULLs last.

    Each task keeps its own n rows, so only those reach the final merge.
    """
    sort = [F.col(o).desc_nulls_last() if isinstance(o, str) else o for o in order]
    return df.orderBy(*sort).limit(n)
