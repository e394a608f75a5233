"""Tables as Parquet runs.

A table is a folder with `data/run_id=N/`, one per run, and `log/N.json`, written last: a run
counts once its log line is there, so a job lost half way leaves no trace for readers and can
simply be run again. One writer per table at a time.

Rows may be split into parts, as `data/run_id=N/part=<name>/`. The log line says which runs
hold the rows of each part, so a run rewrites the parts it replaces, adds to others, and
leaves the rest where it is:

* replace         one part; the run is the whole table
* append          one part; the run adds to it
* write_versions  'current' is replaced, 'closed' is added to, so history is written once
* write_parts     the parts named are replaced, others added to

Earlier runs stay readable with `run=` until `drop_old_runs` removes what only they hold. A run may
leave notes in its log line, such as how far it has read its source; they stay until a later run
replaces them, and are committed together with the rows.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from marlstone.sources import fs

LOG_SCHEMA = (
    "version long, timestamp string, operation string, operationMetrics map<string,string>, "
    "table_schema string, parts map<string,array<long>>"
)
WHOLE = "all"
BUCKETS = "buckets"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed runs, oldest first."""
    names = fs.list_names(spark, f"{root}/log")
    return sorted(int(n.removesuffix(".json")) for n in names if n[0].isdigit())


def has_table(spark: SparkSession, root: str) -> bool:
    return bool(versions(spark, root))


def log_path(root: str, run_id: int) -> str:
    return f"{root}/log/{run_id:010d}.json"


def run_folder(root: str, run_id: int, part: str = WHOLE) -> str:
    folder = f"{root}/data/run_id={run_id}"
    return folder if part == WHOLE else f"{folder}/part={part}"


def replace(df: DataFrame, root: str, operation: str = "WRITE", **options) -> dict[str, int]:
    return _publish(df, root, operation, None, None, **options)


def append(df: DataFrame, root: str, operation: str = "APPEND", **options) -> dict[str, int]:
    return _publish(df, root, operation, None, (), **options)


def write_versions(
    df: DataFrame, root: str, operation: str = "MERGE", flag: str = "is_current", **options
) -> dict[str, int]:
    """`df` holds all current rows, and of the closed ones those this run closed."""
    part = F.when(F.col(flag), "current").otherwise("closed")
    counts = {"current": F.count_if(F.col(flag))}
    return _publish(df, root, operation, part, ("current",), counts, **options)


def write_parts(
    df: DataFrame,
    root: str,
    part: Column,
    replaced: Collection[str] = (),
    operation: str = "MERGE",
    balance: bool = True,
    **options,
) -> dict[str, int]:
    """`part` names each row's part; few names in all, as each is a folder.

    With `balance` rows are first brought together by part, large parts over several tasks, or
    every task would leave a small file in every part.
    """
    return _publish(df, root, operation, part, replaced, balance=balance, **options)


def _publish(
    df: DataFrame,
    root: str,
    operation: str,
    part: Column | None,
    replaced: Collection[str] | None,
    counts: dict[str, Column] | None = None,
    run_id: int | None = None,
    now: dt.datetime | None = None,
    balance: bool = False,
    notes: dict | None = None,
    cluster: Sequence[str] = (),
    buckets: tuple[int, str] | None = None,
) -> dict[str, int]:
    """Write a run, then commit it; returns row counts observed during the write.

    Parts in `replaced` (all when None) give up the runs that held them. With `cluster` rows are
    dealt to files by ranges of those columns and sorted by them, so that readers who ask for few
    values skip most row groups. With `buckets`, a count and a column, files are kept hashed on
    the column, and `catalog.bucketed` reads it that way; a table that is added to keeps the buckets
    it began with, one that is replaced whole takes those given.
    """
    spark = df.sparkSession
    done = versions(spark, root)
    run_id = next_run(spark, root) if run_id is None else run_id
    if done and run_id <= done[-1]:
        raise ValueError(f"{root}: run {run_id} is not after run {done[-1]}")
    former = state(spark, root) if done else {}
    held = former.get("parts", {})
    gone = held if replaced is None else replaced
    held = {name: numbers for name, numbers in held.items() if name not in gone}
    if held and (WHOLE in held) != (part is None):
        raise ValueError(f"{root} is kept in {'one part' if WHOLE in held else 'parts'}")

    seen = Observation()
    counts = {"rows": F.count(F.lit(1)), **(counts or {})}
    rows = df if part is None else df.withColumn("part", part)
    lead = [] if part is None else ["part"]
    held_in = former.get("notes", {}).get(BUCKETS) or buckets
    if replaced is None:
        held_in = buckets or held_in
    if held_in:
        rows = rows.repartition(*held_in).sortWithinPartitions(*lead, held_in[1])
    elif cluster:
        rows = rows.repartitionByRange(*lead, *cluster).sortWithinPartitions(*lead, *cluster)
    elif balance:
        rows = rows.hint("rebalance", F.col("part"))
    writer = rows.observe(seen, *[c.alias(n) for n, c in counts.items()]).write.mode("overwrite")
    writer = writer.option("compression", "zstd")
    target = run_folder(root, run_id)
    if part is not None:
        writer = writer.partitionBy("part")
    if held_in:
        notes = {**(notes or {}), BUCKETS: list(held_in)}
        _write_buckets(spark, writer, target, *held_in)
    else:
        writer.parquet(target)
    if part is None:
        written = [WHOLE]
    else:
        folders = fs.list_names(spark, target)
        written = [f.removeprefix("part=") for f in folders if f.startswith("part=")]
    for name in written:
        held[name] = [*held.get(name, []), run_id]
    metrics = {name: int(count) for name, count in seen.get.items()}
    schema = df.schema if part is None else df.drop("part").schema
    notes = {**former.get("notes", {}), **(notes or {})}
    log_run(spark, root, run_id, operation, metrics, schema, held, now, notes)
    return metrics


def _write_buckets(spark: SparkSession, writer, target: str, count: int, column: str) -> None:
    """Spark writes buckets to named tables only; the name goes again, the files stay."""
    name = f"bucketed_{uuid.uuid4().hex}"
    writer = writer.format("parquet").option("path", target)
    writer.bucketBy(count, column).sortBy(column).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")


def log_run(
    spark: SparkSession,
    root: str,
    run_id: int,
    operation: str,
    metrics: dict[str, int],
    schema: StructType,
    parts: dict[str, list[int]],
    now: dt.datetime | None = None,
    notes: dict | None = None,
) -> None:
    """Commit a run by its log line."""
    line = {
        "version": run_id,
        "timestamp": (now or dt.datetime.now(dt.timezone.utc)).strftime("%Y-%m-%d %H:%M:%S"),
        "operation": operation,
        "operationMetrics": {name: str(count) for name, count in metrics.items()},
        "table_schema": schema.json(),
        "parts": parts,
        "notes": notes or {},
    }
    fs.write_text(spark, log_path(root, run_id), json.dumps(line) + "\n")


def next_run(spark: SparkSession, root: str) -> int:
    return max(versions(spark, root), default=-1) + 1


def state(spark: SparkSession, root: str, run: int | None = None) -> dict:
    """The log line that describes the table as of `run`: one small file, however many runs."""
    done = [v for v in versions(spark, root) if run is None or v <= run]
    if not done:
        raise FileNotFoundError(f"no committed run in {root}")
    return json.loads(fs.read_text(spark, log_path(root, done[-1])))


def notes(spark: SparkSession, root: str) -> dict:
    """What the runs so far have noted; nothing where there is no table."""
    return state(spark, root).get("notes", {}) if has_table(spark, root) else {}


def rows_written(spark: SparkSession, root: str) -> int:
    """How many rows the last run wrote, as counted while it did."""
    return int(state(spark, root)["operationMetrics"]["rows"])


def table_schema(line: dict) -> StructType:
    return StructType.fromJson(json.loads(line["table_schema"]))


def read_table(
    spark: SparkSession,
    root: str,
    run: int | None = None,
    parts: Collection[str] | None = None,
) -> DataFrame:
    """The table as of `run` (the latest when None), or of its `parts` those wanted.

    The schema is the latest run's; columns added over time are NULL in older rows.
    """
    line = state(spark, root, run)
    paths = [
        run_folder(root, number, name)
        for name, numbers in line["parts"].items()
        if parts is None or name in parts
        for number in numbers
    ]
    schema = table_schema(line)
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def read_runs(spark: SparkSession, root: str, runs: dict[str, list[int]]) -> DataFrame:
    """The rows that some runs wrote of some parts, with the part's name in `part`."""
    schema = table_schema(state(spark, root))
    if WHOLE in runs:
        folders = [run_folder(root, number) for number in runs[WHOLE]]
        return spark.read.schema(schema).parquet(*folders).withColumn("part", F.lit(WHOLE))
    folders = [run_folder(root, number, name) for name, some in runs.items() for number in some]
    reader = spark.read.schema(schema.add("part", "string")).option("basePath", f"{root}/data")
    return reader.parquet(*folders).drop("run_id")


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The current rows of a versioned table, without opening its history."""
    return read_table(spark, root, parts=("current",))


def ensure_table(spark: SparkSession, root: str, build) -> DataFrame:
    """Read the table, building it first with `build()` when it has no run yet."""
    if not has_table(spark, root):
        replace(build(), root, "CREATE")
    return read_table(spark, root)


def table_history(spark: SparkSession, root: str, n: int = 5) -> DataFrame:
    """The last n runs, newest first: version, timestamp, operation, operationMetrics."""
    return (
        spark.read.schema(LOG_SCHEMA)
        .json(f"{root}/log")
        .select("version", "timestamp", "operation", "operationMetrics")
        .orderBy(F.col("version").desc())
        .limit(n)
    )


def drop_old_runs(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Delete the folders none of the last `keep` runs needs, and the log lines before them.

    Pick `keep` so that no reader still works on an older run.
    """
    done = versions(spark, root)

    def folders(numbers: list[int]) -> set[str]:
        lines = [state(spark, root, number) for number in numbers]
        return {
            run_folder(root, run, part)
            for line in lines
            for part, held in line["parts"].items()
            for run in held
        }

    unneeded = sorted(folders(done[:-keep]) - folders(done[-keep:]))
    for number in done[:-keep]:  # first, so that no line is left that points to a deleted folder
        fs.delete(spark, log_path(root, number))
    for folder in unneeded:
        fs.delete(spark, folder)
    return unneeded
