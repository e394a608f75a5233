"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

MB = 1 << 20

# Runtime settings the results or the plans lean on. Sizes that depend on the
# cluster (executors, memory, shuffle partitions) are left to the submitter.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "marlstone", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def plan_bytes(df: DataFrame) -> int:
    """Spark's size estimate. Most exact for a table as written; a staging table is one."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def sizes_for(input_bytes: int) -> dict[str, int]:
    """Split size, file size and shuffle partition count for an input of that many bytes.

    About 256 MB of input per shuffle partition. Past 10 TB splits grow as well, to 1 GB, and
    partitions stop at 40,000: the driver keeps a size per map task and partition. At 100 TB
    that is 100,000 map tasks and 2.5 GB per partition, which spills but fits. What adaptive
    execution merges or splits a shuffle to, and so the size of files, grows to 512 MB.
    """
    return {
        "spark.sql.files.maxPartitionBytes": min(max(128 * MB, input_bytes // 100_000), 1024 * MB),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": min(
            max(64 * MB, input_bytes // 200_000), 512 * MB
        ),
        "spark.sql.shuffle.partitions": min(-(-input_bytes // (256 * MB)), 40_000),
    }


@contextmanager
def kept_settings(spark: SparkSession, names):
    """Put the named settings back afterwards as they were, set or not."""
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def prepared(spark: SparkSession):
    """Work inside with the runtime settings in a session somebody else built.

    Plans made inside keep them; the session gets its own back.
    """
    with kept_settings(spark, SETTINGS):
        for key, value in SETTINGS.items():
            spark.conf.set(key, value)
        yield spark


@contextmanager
def sized_for(*inputs: DataFrame):
    """Run the writes inside with `sizes_for` the inputs where they are above the session's own.

    Adaptive execution merges shuffle partitions that turn out small, but cannot split those of
    an aggregate, so the count has to be high enough to start with.
    """
    spark = inputs[0].sparkSession
    bytes_of = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    sizes = sizes_for(sum(plan_bytes(df) for df in inputs))
    with kept_settings(spark, sizes):
        for name, wanted in sizes.items():
            if wanted > bytes_of(spark.conf.get(name)):
                spark.conf.set(name, str(wanted))
        yield


@contextmanager
def narrow_splits(*inputs: DataFrame):
    """Run the writes inside with splits whose rows a task can sort in memory.

    Where one row per key is wanted, a task sorts whole rows as it has read them, and 128 MB of
    Parquet may be millions. Past 1.6 TB splits grow, so that there are never many more than 100,000.
    """
    spark, name = inputs[0].sparkSession, "spark.sql.files.maxPartitionBytes"
    wanted = max(16 * MB, sum(plan_bytes(df) for df in inputs) // 100_000)
    bytes_of = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    with kept_settings(spark, [name]):
        if wanted < bytes_of(spark.conf.get(name)):
            spark.conf.set(name, str(wanted))
        yield


def buckets_for(least: int, *inputs: DataFrame) -> int:
    """`least` buckets, or as many more as it takes for each to stand for 8 MB of the inputs.

    A bucket is sorted and joined by one task, so a fixed count would have tasks grow.
    """
    return max(least, -(-sum(plan_bytes(df) for df in inputs) // (8 * MB)))


@contextmanager
def bloom_filtered(spark: SparkSession, items: int):
    """Run the jobs inside with Spark's runtime Bloom filters, sized for that many keys.

    Spark builds one from the small side of a shuffled join and filters the large side's scan with
    it, before anything of it is shuffled. Ten bits a key let one row in a hundred through for
    nothing; at the limit of 64 MB it is more, never a wrong result.
    """
    base = "spark.sql.optimizer.runtime.bloomFilter."
    bits = min(max(10 * items, 1 << 16), 1 << 29)
    wanted = {
        "enabled": "true",
        "expectedNumItems": items,
        "maxNumItems": max(items, 1),
        "numBits": bits,
        "maxNumBits": bits,
        # The small side is a written table of keys, cheap to read twice, whatever its size.
        "creationSideThreshold": str(1 << 40),
        "applicationSideScanSizeThreshold": "0",
    }
    with kept_settings(spark, [base + name for name in wanted]):
        for name, value in wanted.items():
            spark.conf.set(base + name, str(value))
        yield


def scratch_base(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names.

    Only a local session may do without the setting: its tasks share one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _local:
        _local[context.applicationId] = tempfile.mkdtemp(prefix="marlstone-")
    return _local[context.applicationId]


_local: dict[str, str] = {}


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for one step of a run, below one folder per application."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def scratch_root(spark: SparkSession) -> str:
    return f"{scratch_base(spark)}/marlstone/{spark.sparkContext.applicationId}"


def free_scratch(spark: SparkSession) -> None:
    """Delete all scratch folders of this application.

    Call it once results are read or written: whatever still reads a scratch table fails.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)
