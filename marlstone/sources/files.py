"""Delimited catalogue and raw file listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marlstone.functions.cleaning import megabytes


def read_catalogue(
    spark: SparkSession, path: str, columns: tuple[str, ...] = ("type", "name")
) -> DataFrame:
    """Comma-separated text with a header; names and values trimmed, columns found by name.

    Lines whose field count is not the header's drop out. All fields are parsed even when few
    are read, or such lines would slip into a plain count. Quotes have no meaning.
    """
    table = (
        spark.read.option("header", True)
        .option("quote", "")
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("mode", "DROPMALFORMED")
        .option("columnPruning", False)
        .option("emptyValue", "")
        .csv(path)
    )
    missing = [c for c in columns if c not in table.columns]
    if missing:
        raise ValueError(f"catalogue lacks {missing}")
    return table.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns])


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """path, length and modificationTime of every file below; contents are never opened."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", "modificationTime")
    )


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    return list_files(spark, path).select(
        F.substring_index("path", "/", -1).alias("file_name"),
        megabytes("length").alias("size_mb"),
        F.date_format("modificationTime", "yyyy-MM-dd HH:mm:ss").alias("last_modified"),
    )


def inventory_difference(before: DataFrame, after: DataFrame, key: str = "path") -> DataFrame:
    """What two listings differ in: key, change (new, changed, gone), lengths, bytes added.

    Both hold `key` at most once, as listings do, and come out of the join hashed on it. A file is
    changed when its length is, or when it was written anew with the same.
    """
    def side(listing: DataFrame, name: str) -> DataFrame:
        return listing.select(key, F.struct("length", "modificationTime").alias(name))

    old, new = F.col("old"), F.col("new")
    change = (
        F.when(old.isNull(), "new")
        .when(new.isNull(), "gone")
        .when(~old.eqNullSafe(new), "changed")
    )
    length = [F.coalesce(x["length"], F.lit(0)) for x in (old, new)]
    return (
        side(before, "old")
        .join(side(after, "new"), key, "full")
        .select(
            key,
            change.alias("change"),
            old["length"].alias("length_before"),
            new["length"].alias("length_now"),
            (length[1] - length[0]).alias("bytes_added"),
        )
        .filter("change IS NOT NULL")
    )
