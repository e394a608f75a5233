"""The few file system calls Spark's reader and writer do not cover."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    """Plain existence test; any other trouble with the path is raised, not read as absence."""
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _resolve(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def total_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    fs, target = _resolve(spark, path)
    return fs.getContentSummary(target).getLength()


def read_text(spark: SparkSession, path: str) -> str:
    """Read a small file whole."""
    fs, target = _resolve(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """Write a small file whole: under a hidden name first, then renamed into place.

    With `overwrite` the rename itself replaces the file, so one of both is always there.
    """
    fs, target = _resolve(spark, path)
    if not overwrite and fs.exists(target):
        raise FileExistsError(path)
    jvm = spark._jvm.org.apache.hadoop.fs
    part = jvm.Path(target.getParent(), f"_{target.getName()}.part")
    out = fs.create(part, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if overwrite:
        context = jvm.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
        options = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 1)
        options[0] = getattr(jvm, "Options$Rename").OVERWRITE
        context.rename(fs.makeQualified(part), fs.makeQualified(target), options)
    elif not fs.rename(part, target):
        raise OSError(f"could not put {path} in place")


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, True)
