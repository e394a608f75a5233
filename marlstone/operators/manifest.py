"""From a catalogue of files to a manifest, what is still to fetch, and how it went."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from marlstone import fixed_values as fixed


def _choose(cases: Sequence[tuple[Column, str]], name: Column, problem: Column | None) -> Column:
    chosen = [F.when(test, F.concat(F.lit(prefix), name)) for test, prefix in cases]
    return F.coalesce(*chosen, F.lit(None) if problem is None else F.raise_error(problem))


def route_files(
    catalogue: DataFrame,
    bases: Mapping[str, str],
    folders: Mapping[str, str],
    unknown: str = "error",
) -> DataFrame:
    """Add the address (by type) and the target path (by type, else by keyword in the name).

    `bases` maps a type to its address prefix. `folders` maps the whole-set type and each
    name keyword to a folder; the first keyword found in the name decides. Rows that fit
    nothing fail the job, or with unknown="null" get NULL for `expect_no_nulls` to report.
    Other columns are kept.
    """
    kind, name = F.col("type"), F.col("name")
    by_type = [(kind == t, prefix) for t, prefix in bases.items()]
    by_name = [(kind == fixed.WHOLE_SET_TYPE, folders[fixed.WHOLE_SET_TYPE])] + [
        (name.contains(word), folders[word]) for word in fixed.NAME_KEYWORDS
    ]
    bad_type = F.concat(F.lit("unknown dataset type: "), kind)
    bad_name = F.concat(F.lit("no folder for file: "), name)
    strict = unknown == "error"
    return catalogue.select(
        "name",
        "type",
        _choose(by_type, name, bad_type if strict else None).alias("url"),
        _choose(by_name, name, bad_name if strict else None).alias("path"),
        *[c for c in catalogue.columns if c not in ("name", "type")],
    )


def pending_files(manifest: DataFrame, listing: DataFrame, on: str = "path") -> DataFrame:
    """Manifest rows whose file is not there yet."""
    return manifest.join(listing.select(on), on, "left_anti")


def fetch_status(manifest: DataFrame, listing: DataFrame, on: str = "path") -> DataFrame:
    """Every manifest row: 'skipped' with its size where the file is there, else 'pending'."""
    found = listing.select(on, F.col("length").alias("_length"))
    return manifest.join(found, on, "left").select(
        *manifest.columns,
        F.when(F.col("_length").isNull(), "pending").otherwise("skipped").alias("status"),
        (F.col("_length") / F.lit(1024 * 1024)).alias("size_mb"),
    )


def status_summary(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(
        F.count(F.lit(1)).alias("count"), F.round(F.sum("size_mb"), 1).alias("total_mb")
    )
