"""Table mutations as DataFrame transformations.

Every mutation comes in two forms: the whole new table, and the part a run has to write
(`scd2_delta`, `supersede_delta`, `new_rows`), so closed history and old facts are never
rewritten. A target of None is a first load.

Sources hold each key at most once and no NULL key, and so do a target's current rows: the
cleaning jobs see to that. Matching is therefore one to one and a join has no hot keys.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from marlstone import fixed_values as fixed
from marlstone.operators.rows import current_rows


def changed(pairs: Sequence[tuple[Column, Column]], nulls: str = "sql") -> Column:
    """True where any pair differs.

    nulls="sql": a comparison with NULL never counts as a difference, so a value that
    appears or vanishes goes unseen. nulls="distinct": NULL differs from every value.
    """
    if nulls not in ("sql", "distinct"):
        raise ValueError(f"nulls must be 'sql' or 'distinct', not {nulls!r}")
    tests = [a != b if nulls == "sql" else ~a.eqNullSafe(b) for a, b in pairs]
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def align(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both with the columns of `left`, then those only `right` has; NULL where one lacks them."""
    types = {f.name: f.dataType for f in [*right.schema.fields, *left.schema.fields]}
    names = left.columns + [c for c in right.columns if c not in left.columns]

    def padded(df: DataFrame) -> DataFrame:
        have = set(df.columns)
        return df.select(
            *[(F.col(n) if n in have else F.lit(None)).cast(types[n]).alias(n) for n in names]
        )

    return padded(left), padded(right)


def paired(old: DataFrame, new: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join two aligned tables on `keys`, each side's other columns as one struct.

    A struct is NULL exactly where that side has no row.
    """
    payload = [c for c in old.columns if c not in keys]
    left = old.select(*keys, F.struct(*payload).alias("old"))
    right = new.select(*keys, F.struct(*payload).alias("new"))
    return left.join(right, list(keys), how)


def versioned(
    df: DataFrame,
    as_of: dt.date,
    flag: str = "is_current",
    start: str = "valid_from",
    end: str = "valid_to",
) -> DataFrame:
    """Open a version of every row at `as_of`."""
    return df.withColumns({flag: F.lit(True), start: F.lit(as_of), end: F.lit(fixed.OPEN_END)})


def _day_before(as_of: dt.date) -> Column:
    return F.lit(as_of - dt.timedelta(days=1))


def scd2_delta(
    current: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: dt.date,
    nulls: str = "sql",
    expire_missing: bool = False,
    same_day: str = "keep",
    flag: str = "is_current",
    start: str = "valid_from",
    end: str = "valid_to",
) -> DataFrame:
    """The current rows after the run plus the versions it closes, from one full join.

    A changed key gives two rows, the closed version and the new one; any other key one.
    A key missing from the source stays current unless `expire_missing`. With
    same_day="replace" a version opened on `as_of` itself is replaced instead of closed.
    """
    opened = versioned(source, as_of, flag, start, end)
    if current is None:
        return opened
    old_rows, new_rows_ = align(current, opened)
    old, new = F.col("old"), F.col("new")
    closed = old.withField(flag, F.lit(False)).withField(end, _day_before(as_of))
    differs = changed([(old[c], new[c]) for c in tracked], nulls)
    result = F.when(old.isNull(), F.array(new)).when(
        new.isNull(), F.array(closed if expire_missing else old)
    )
    if same_day == "replace":
        result = result.when(differs & (old[start] == F.lit(as_of)), F.array(new))
    result = result.when(differs, F.array(closed, new)).otherwise(F.array(old))
    return (
        paired(old_rows, new_rows_, keys, "full")
        .select(*keys, F.inline(result))
        .select(*old_rows.columns)
    )


def scd2_apply(
    dim: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: dt.date,
    flag: str = "is_current",
    **options,
) -> DataFrame:
    """The whole dimension after the run. Closed versions pass by untouched, outside the join."""
    if dim is None:
        return scd2_delta(None, source, keys, tracked, as_of, flag=flag, **options)
    delta = scd2_delta(
        current_rows(dim, flag), source, keys, tracked, as_of, flag=flag, **options
    )
    history = dim.filter(~F.col(flag).eqNullSafe(True))
    return history.unionByName(delta, allowMissingColumns=True)


def new_rows(target: DataFrame | None, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks. Of the target only the key columns are read."""
    if target is None:
        return source
    return source.join(target.select(*keys), list(keys), "left_anti")


def met_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source keys the target holds, one key column: never more rows than the source's.

    For a large target. Only its key column is read, and inside `session.bloom_filtered` only the
    stored keys a Bloom filter of the source's lets through are shuffled. An anti-join cannot be
    filtered like that, so `new_rows` is then asked against these few.
    """
    [key] = keys
    # Spark makes the filter only of a side it takes for selective; every key passes this test.
    wanted = source.select(key).filter(F.col(key) >= F.lit(""))
    return target.select(key).join(wanted, key, "left_semi")


def append_new(target: DataFrame | None, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target plus the source rows whose key it lacks; rows already there never change."""
    if target is None:
        return source
    return target.unionByName(new_rows(target, source, keys), allowMissingColumns=True)


def replace_keys(
    target: DataFrame | None, source: DataFrame, keys: Sequence[str], arrived: DataFrame | None = None
) -> DataFrame:
    """The target with all rows of the keys that arrived given up for those of the source.

    `arrived` names the keys where some may have no row in the source.
    """
    if target is None:
        return source
    given_up = (source if arrived is None else arrived).select(*keys).distinct()
    kept = target.join(given_up, list(keys), "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def merge_newest(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    ts: str,
    update_cols: Sequence[str],
) -> DataFrame:
    """Newest wins: a matched row takes `update_cols` from the source when that is newer by
    `ts` or the target has no `ts`; its other columns stay. Unmatched source rows come in whole.
    One full join.
    """
    if target is None:
        return source
    stored, fresh = align(target, source)
    old, new = F.col("old"), F.col("new")
    newer = new.isNotNull() & (old[ts].isNull() | F.coalesce(new[ts] > old[ts], F.lit(False)))

    columns = []
    for name in stored.columns:
        if name in keys:
            columns.append(F.col(name))
        else:
            takes = old.isNull() | newer if name in update_cols else old.isNull()
            columns.append(F.when(takes, new[name]).otherwise(old[name]).alias(name))
    return paired(stored, fresh, keys, "full").select(*columns)


def merge_matches(
    target: DataFrame, source: DataFrame, keys: Sequence[str], ts: str, part: Column
) -> DataFrame:
    """The matched keys of a newest-wins merge, the target row's part, and whether it changes.

    Reads the key columns and `ts` alone, so a merge can find the parts it has to rewrite
    before it opens them. Never more rows than the source.
    """
    stored = target.select(*keys, F.col(ts).alias("_old"), part.alias("part"))
    newer = F.col("_old").isNull() | F.coalesce(F.col("_new") > F.col("_old"), F.lit(False))
    fresh = source.select(*keys, F.col(ts).alias("_new"))
    return stored.join(fresh, list(keys)).select(*keys, "part", newer.alias("newer"))


def _given_up(start: str, as_of: dt.date, same_day: str) -> Column:
    """Which current rows the new snapshot replaces instead of closing."""
    if same_day not in ("replace", "close"):
        raise ValueError(f"same_day must be 'replace' or 'close', not {same_day!r}")
    same = F.col(start).eqNullSafe(F.lit(as_of))
    return same if same_day == "replace" else F.lit(False)


def supersede_delta(
    current: DataFrame | None,
    snapshot: DataFrame,
    as_of: dt.date,
    flag: str = "is_current",
    start: str = "valid_from",
    end: str = "valid_to",
    same_day: str = "replace",
) -> DataFrame:
    """The snapshot as the only current rows, and the former current rows closed.

    Rows opened on `as_of` itself are replaced, so a repeated day changes nothing. With
    same_day="close" they are closed like any others, a day before they opened.
    """
    opened = versioned(snapshot, as_of, flag, start, end)
    if current is None:
        return opened
    former = current.filter(~_given_up(start, as_of, same_day))
    closed = former.withColumns({flag: F.lit(False), end: _day_before(as_of)})
    return closed.unionByName(opened, allowMissingColumns=True)


def snapshot_supersede(
    target: DataFrame | None,
    snapshot: DataFrame,
    as_of: dt.date,
    flag: str = "is_current",
    start: str = "valid_from",
    end: str = "valid_to",
    same_day: str = "replace",
) -> DataFrame:
    """The whole table after the run, in one pass over the target and without a shuffle."""
    opened = versioned(snapshot, as_of, flag, start, end)
    if target is None:
        return opened
    was_current = F.col(flag).eqNullSafe(True)
    kept = target.filter(~(was_current & _given_up(start, as_of, same_day)))
    closed = kept.withColumns(
        {flag: F.lit(False), end: F.when(was_current, _day_before(as_of)).otherwise(F.col(end))}
    )
    return closed.unionByName(opened, allowMissingColumns=True)
