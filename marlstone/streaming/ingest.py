"""JSON files into append-only bronze tables, each file once.

Each stream drains what is there and stops. The checkpoint remembers the files taken, so a
run after a lost driver or executor carries on where the last committed batch ended. A batch has a
folder of its own, which a batch that is run again writes anew, and in it one per load date, so a
reader that wants new rows opens new files alone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    ArrayType,
    DataType,
    MapType,
    StringType,
    StructType,
    VariantType,
)

from marlstone.operators.monitor import count_delta
from marlstone.session import kept_settings
from marlstone.sources import fs, store
from marlstone.sources.schema import (
    conform,
    infer_lines,
    keep_schema,
    learn,
    load_epochs,
    load_schema,
    outside,
    widen,
    with_batch,
)

LOADED_AT = "_ingestion_timestamp"
SOURCE_FILE = "_source_file"
RESCUED_LINE = "_rescued_line"
RESCUED_FIELDS = "_rescued_fields"
LOAD_DATE = "load_date"


After = Callable[[SparkSession, "Feed", int], None]


@dataclass(frozen=True)
class Feed:
    """One folder (or glob) of newline-delimited JSON and the table it feeds.

    `max_files` or `max_bytes` bounds a batch, so that a first run over a large
    folder commits as it goes.

    Without a declared `schema` each batch adds the fields it brings, and types grow with the
    values. A line that does not parse, or holds a value in a field outside a declared schema, at
    any depth, is kept as it was in `_rescued_line`. With rescue="fields" what lies outside a
    declared schema is kept by itself instead, as one VARIANT in `_rescued_fields`; once the schema
    declares such a field, `read_bronze` takes its earlier values from there. `spread` hands lines round over that many tasks before they are parsed: worth
    it for compressed files, which one task each has to read from end to end.
    """

    name: str
    src: str
    out: str
    checkpoint: str
    schema: StructType | None = None
    max_files: int | None = None
    max_bytes: int | None = None
    spread: int | None = None
    rescue: str = "line"

    def __post_init__(self):
        if self.rescue not in ("line", "fields"):
            raise ValueError(f"rescue must be 'line' or 'fields', not {self.rescue!r}")

    def keeps_fields(self) -> bool:
        return self.schema is not None and self.rescue == "fields"


@dataclass
class Landed:
    """What a run has written, and how many of its lines were rescued whole."""

    rows: int = 0
    batches: int = 0
    rescued: int = 0


def with_audit(df: DataFrame, now: dt.datetime | None = None) -> DataFrame:
    """Add load time and source file. Needs a DataFrame read straight from files."""
    return df.withColumns(
        {
            LOADED_AT: F.current_timestamp() if now is None else F.lit(now),
            SOURCE_FILE: F.col("_metadata.file_path"),
        }
    )


def schema_path(feed: Feed) -> str:
    return f"{feed.checkpoint}/schema/schema.json"


def feed_schema(spark: SparkSession, feed: Feed) -> StructType:
    """The fields of a feed: declared, or those its batches have brought so far."""
    if feed.schema:
        return feed.schema
    kept = load_schema(spark, schema_path(feed))
    return kept[1] if kept else StructType([])


def parse_lines(
    lines: DataFrame, schema: StructType, wide: StructType | None = None
) -> DataFrame:
    """Text lines (`value`) to the columns of `schema` and `_rescued_line`; others pass through.

    `wide` has the fields the lines may hold beyond `schema`; a line with a value in one of
    them is rescued.
    """
    wide = wide or schema
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUED_LINE}
    fields = StructType(list(wide.fields)).add(RESCUED_LINE, StringType())
    kept: Column = F.col("_row")[RESCUED_LINE]
    strange = outside(F.col("_row"), schema, wide)
    if strange is not None:
        kept = F.coalesce(kept, F.when(strange, F.col("value")))
    trimmed = StructType(list(schema.fields))
    others = [c for c in lines.columns if c != "value"]
    return (
        lines.filter(F.trim("value") != "")
        .withColumn("_row", F.from_json("value", fields, options))
        .withColumn("_known", F.from_json("value", trimmed, {"mode": "PERMISSIVE"})
                    if strange is not None else F.col("_row"))
        .select(
            *[F.col("_known")[name].alias(name) for name in schema.fieldNames()],
            kept.alias(RESCUED_LINE),
            *others,
        )
    )


def unknown_fields(fields: Column, known: StructType) -> Column:
    """Of a JSON object's fields, as a map of variants, those `known` lacks, at any depth.

    Nulls are left out. What is unknown inside a known struct comes under the struct's name, and
    inside a known list of structs as a list as long as the known one.
    """
    out = F.map_filter(fields, lambda k, v: ~k.isin(*known.names) & ~F.is_variant_null(v))
    for field in known.fields:
        inside = _unknown_inside(F.try_element_at(fields, F.lit(field.name)), field.dataType)
        if inside is not None:
            more = F.map_concat(out, F.create_map(F.lit(field.name), inside))
            out = F.when(inside.isNotNull(), more).otherwise(out)
    return out


def _unknown_inside(value: Column, known: DataType) -> Column | None:
    """The unknown parts of a variant as a variant; None where `known` has no fields."""
    objects = "map<string,variant>"
    if isinstance(known, StructType):
        found = unknown_fields(F.try_variant_get(value, "$", objects), known)
        return F.when(F.size(found) > 0, F.to_variant_object(found))
    if isinstance(known, ArrayType) and isinstance(known.elementType, StructType):
        rows = F.try_variant_get(value, "$", f"array<{objects}>")
        found = F.transform(rows, lambda row: unknown_fields(row, known.elementType))
        return F.when(F.exists(found, lambda row: F.size(row) > 0), F.to_variant_object(found))
    return None


def parse_known(lines: DataFrame, schema: StructType) -> DataFrame:
    """Text lines (`value`) to the columns of `schema`, `_rescued_line` and `_rescued_fields`.

    The first holds lines that do not parse or have a known field of another type, the second
    what else the other fields hold; others pass through. The lines need no look ahead.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUED_LINE}
    fields = StructType(list(schema.fields)).add(RESCUED_LINE, StringType())
    objects = F.from_json("value", MapType(StringType(), VariantType()))
    others = [c for c in lines.columns if c != "value"]
    unknown = F.col("_unknown")
    return (
        lines.filter(F.trim("value") != "")
        .withColumn("_row", F.from_json("value", fields, options))
        .withColumn("_unknown", unknown_fields(objects, schema))
        .select(
            *[F.col("_row")[name].alias(name) for name in schema.fieldNames()],
            F.col("_row")[RESCUED_LINE].alias(RESCUED_LINE),
            F.when(F.size(unknown) > 0, F.to_variant_object(unknown)).alias(RESCUED_FIELDS),
            *others,
        )
    )


def land(feed: Feed, lines: DataFrame, batch: int, landed: Landed) -> None:
    """Write one batch into its own folder, in place of what an earlier try left there."""
    spark = lines.sparkSession
    path, texts = schema_path(feed), lines.filter(F.trim("value") != "")
    epochs = load_epochs(spark, path)
    if feed.keeps_fields():
        typed = whole = feed.schema
        rows = parse_known(lines, feed.schema)
    elif feed.schema:
        typed = whole = feed.schema
        rows = parse_lines(lines, feed.schema, widen(feed.schema, infer_lines(texts)))
    else:
        typed, known = load_schema(spark, path) or (StructType([]), StructType([]))
        typed, found = learn(typed, infer_lines(texts), texts)
        whole = widen(found, known)
        # Fields without a value so far are not written: their type is still open.
        rows = parse_lines(lines, typed)
    epochs = with_batch(epochs, batch, typed, same_fields=feed.keeps_fields())
    keep_schema(spark, path, typed, whole, epochs)
    seen = Observation()
    rows = rows.withColumn(LOAD_DATE, F.to_date(LOADED_AT)).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count(RESCUED_LINE).alias("rescued")
    )
    writer = rows.write.mode("overwrite").option("compression", "zstd").partitionBy(LOAD_DATE)
    with few_dates(spark):
        writer.parquet(batch_folder(feed, batch))
    landed.rows += int(seen.get["rows"])
    landed.rescued += int(seen.get["rescued"])
    landed.batches += 1


@contextmanager
def few_dates(spark: SparkSession):
    """Write inside with a file open for each of a few load dates.

    A batch mostly has one. By default a task sorts all its rows by date first, and spills them; past
    four dates it still does.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    with kept_settings(spark, [name]):
        spark.conf.set(name, "4")
        yield


def batch_folder(feed: Feed, batch: int) -> str:
    return f"{feed.out}/batch={batch}"


def start_ingest(
    spark: SparkSession,
    feed: Feed,
    now: dt.datetime | None = None,
    landed: Landed | None = None,
    after: After | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Drain a feed; with `every`, such as '1 minute', go on looking for files until stopped.

    `after` is called for each batch once it is in bronze, with the batch's own session and its
    number. A batch that fails there is run again, `after` included.
    """
    landed = landed or Landed()
    reader = (
        spark.readStream.format("text")
        .option("recursiveFileLookup", True)
        # By default files a week older than the newest are skipped without a word.
        .option("maxFileAge", "36500d")
    )
    if feed.max_files:
        reader = reader.option("maxFilesPerTrigger", feed.max_files)
    if feed.max_bytes:
        reader = reader.option("maxBytesPerTrigger", feed.max_bytes)
    if now is None and not every:
        now = dt.datetime.now(dt.timezone.utc)
    lines = with_audit(reader.load(feed.src), now)
    if feed.spread:
        lines = lines.repartition(feed.spread)

    def take(rows: DataFrame, batch: int) -> None:
        land(feed, rows, batch, landed)
        if after:
            after(rows.sparkSession, feed, batch)

    return (
        lines.writeStream.foreachBatch(take)
        .option("checkpointLocation", feed.checkpoint)
        .trigger(**({"processingTime": every} if every else {"availableNow": True}))
        .queryName(f"{feed.name} into {feed.out}")
        .start()
    )


def ingest_all(
    spark: SparkSession,
    feeds: list[Feed],
    now: dt.datetime | None = None,
    after: After | None = None,
) -> DataFrame:
    """Drain all feeds side by side; report rows and batches of each, and log those that grew.

    Feeds that fail are raised once the others are through, all of them.
    """
    report = [(name, x.rows, x.batches) for name, x in drain(spark, feeds, now, after).items()]
    return spark.createDataFrame(report, "feed string, rows long, batches long")


def drain(
    spark: SparkSession,
    feeds: list[Feed],
    now: dt.datetime | None = None,
    after: After | None = None,
) -> dict[str, Landed]:
    """`ingest_all`, what it has written by feed."""
    started, report, failed = [], {}, []
    for feed in feeds:
        landed = Landed()
        try:
            started.append((feed, landed, start_ingest(spark, feed, now, landed, after)))
        except PySparkException as error:
            failed.append(error)
    for feed, landed, query in started:
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            failed.append(error)
        report[feed.name] = landed
        if landed.rows:
            root = feed_log(feed)
            metrics = {"rows": landed.rows, "batches": landed.batches, "rescued": landed.rescued}
            run_id = store.next_run(spark, root)
            schema = feed_schema(spark, feed)
            store.log_run(spark, root, run_id, "STREAMING UPDATE", metrics, schema, {}, now)
    if len(failed) > 1:
        raise ExceptionGroup("several feeds failed", failed)
    if failed:
        raise failed[0]
    return report


def feed_log(feed: Feed) -> str:
    """Where a feed's run log is, in the form `store.table_history` reads."""
    return f"{feed.checkpoint}/runs"


def ingest_json(
    spark: SparkSession,
    src: str,
    out: str,
    checkpoint: str,
    schema: StructType | None = None,
    now: dt.datetime | None = None,
    name: str = "ingest",
) -> DataFrame:
    return ingest_all(spark, [Feed(name, src, out, checkpoint, schema)], now)


def read_bronze(
    spark: SparkSession, feed: Feed, since: dt.datetime | None = None, batch: int | None = None
) -> DataFrame:
    """The bronze table, or of it the rows loaded after `since`, from the files of those days.

    Fields the source gained later are NULL in older rows, or taken from `_rescued_fields` where
    the feed keeps that; values whose type has grown since are cast. The kept schema spares a look
    into every file's footer. `batch` reads a single batch.
    """
    fields = feed_schema(spark, feed)
    if not fs.exists(spark, feed.out if batch is None else batch_folder(feed, batch)):
        kept = _with_provenance(feed, fields)
        return spark.createDataFrame([], kept).drop("batch", LOAD_DATE)
    epochs = load_epochs(spark, schema_path(feed)) or [(0, fields)]
    parts = []
    for n, (first, had) in enumerate(epochs):
        # The last types hold for fields that have none yet as well.
        had = widen(had, fields) if n + 1 == len(epochs) and not feed.keeps_fields() else had
        rows = spark.read.schema(_with_provenance(feed, had)).parquet(feed.out)
        if n:
            rows = rows.filter(F.col("batch") >= first)
        if n + 1 < len(epochs):
            rows = rows.filter(F.col("batch") < epochs[n + 1][0])
        if batch is not None:
            rows = rows.filter(F.col("batch") == batch)
        if since is not None:
            # The date is a folder's name; a session's time zone may move it by a day.
            day = F.lit((since - dt.timedelta(days=1)).date())
            rows = rows.filter((F.col(LOAD_DATE) >= day) & (F.col(LOADED_AT) > F.lit(since)))
        parts.append(_as_fields(feed, rows, had, fields))
    return reduce(DataFrame.unionAll, parts)


def _with_provenance(feed: Feed, fields: StructType) -> StructType:
    kept = StructType(list(fields.fields)).add(RESCUED_LINE, "string")
    if feed.keeps_fields():
        kept = kept.add(RESCUED_FIELDS, VariantType())
    kept = kept.add(LOADED_AT, "timestamp").add(SOURCE_FILE, "string")
    return kept.add("batch", "long").add(LOAD_DATE, "date")


def _as_fields(feed: Feed, rows: DataFrame, had: StructType, fields: StructType) -> DataFrame:
    """Rows written with other fields or types as `fields` has them now."""

    def absent(names: tuple, kind: DataType) -> Column:
        if not feed.keeps_fields():
            return F.lit(None).cast(kind)
        path = "$" + "".join(f'["{name}"]' for name in names)
        return F.try_variant_get(F.col(RESCUED_FIELDS), path, kind.simpleString())

    ours = {f.name: f.dataType for f in had.fields}
    columns = []
    for f in fields.fields:
        if f.name not in ours:
            value = absent((f.name,), f.dataType)
        else:
            value = conform(
                F.col(f"`{f.name}`"), ours[f.name], f.dataType,
                lambda names, kind, top=f.name: absent((top, *names), kind),
            )
        columns.append(value.alias(f.name))
    others = [c for c in rows.columns if c not in ours and c not in ("batch", LOAD_DATE)]
    return rows.select(*columns, *others)


def waiting_fields(spark: SparkSession, feed: Feed) -> DataFrame:
    """One row, `fields`: names and types of all that is kept in `_rescued_fields` so far."""
    rows = read_bronze(spark, feed)
    return rows.select(F.schema_of_variant_agg(RESCUED_FIELDS).alias("fields"))


def rescued_by_day(spark: SparkSession, feed: Feed) -> DataFrame:
    """Rows and rescued lines per load date, of one narrow column."""
    kept = StructType().add(RESCUED_LINE, "string").add("batch", "long").add(LOAD_DATE, "date")
    if not fs.exists(spark, feed.out):
        rows = spark.createDataFrame([], kept)
    else:
        rows = spark.read.schema(kept).parquet(feed.out)
    return rows.groupBy(LOAD_DATE).agg(
        F.count(F.lit(1)).alias("rows"), F.count(RESCUED_LINE).alias("rescued")
    )


@contextmanager
def footers_counted(spark: SparkSession):
    """Count rows inside from Parquet footers, where groups are whole folders."""
    wanted = {
        "spark.sql.parquet.aggregatePushdown": "true",
        # Only the newer reader hands an aggregate down.
        "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
    }
    with kept_settings(spark, wanted):
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield


def folder_counts(spark: SparkSession, feed: Feed) -> DataFrame:
    """Rows per batch and load date; inside `footers_counted` no row is read for it."""
    fields = feed_schema(spark, feed).add("batch", "long").add(LOAD_DATE, "date")
    fields = StructType([f for f in fields.fields if f.name in ("batch", LOAD_DATE)])
    if not fs.exists(spark, feed.out):
        rows = spark.createDataFrame([], fields)
    else:
        rows = spark.read.schema(fields).parquet(feed.out)
    return rows.groupBy("batch", LOAD_DATE).agg(F.count(F.lit(1)).alias("rows"))


def bronze_row_delta(
    spark: SparkSession, feed: Feed, now: dt.datetime, lag: dt.timedelta = dt.timedelta(days=1)
) -> DataFrame:
    """`row_count_delta` of a bronze table, whose rows are read for the day of the cutoff alone.

    All other days count by their files' footers.
    """
    cutoff = now - lag
    # The date is a folder's name; a session's time zone may move it by a day.
    first, last = (cutoff + dt.timedelta(days=n) for n in (-1, 1))
    with footers_counted(spark):
        # One row per folder of the table.
        folders = spark.createDataFrame(
            folder_counts(spark, feed).collect(), f"batch long, {LOAD_DATE} date, rows long"
        )
    before = F.when(F.col(LOAD_DATE) < F.lit(first.date()), F.col("rows")).otherwise(0)
    counted = folders.select(before.alias("before"), F.col("rows").alias("now"))
    times = StructType().add(LOADED_AT, "timestamp").add("batch", "long").add(LOAD_DATE, "date")
    if not fs.exists(spark, feed.out):
        rows = spark.createDataFrame([], times)
    else:
        rows = spark.read.schema(times).parquet(feed.out)
    near = rows.filter(F.col(LOAD_DATE).between(F.lit(first.date()), F.lit(last.date())))
    edge = near.agg(
        F.count_if(F.col(LOADED_AT) <= F.lit(cutoff)).alias("before"), F.lit(0).alias("now")
    )
    sums = counted.unionAll(edge).agg(F.sum("before").alias("before"), F.sum("now").alias("now"))
    return count_delta(sums, F.col("before"), F.col("now"))
