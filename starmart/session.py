"""Session settings, and the shared folder for intermediate tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Rows in memory take several times the room of compressed files: size estimates have to allow for it.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # The JVM never compiles methods above this size; stages that would need one fall back to smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build(app: str = "starmart", **settings: str) -> SparkSession:
    """Session with these settings; `settings` add to them or replace them."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, fallback: str) -> str:
    """Folder for intermediate tables: the one the cluster names, else `fallback` (on shared storage too)."""
    return spark.conf.get("spark.checkpoint.dir", None) or fallback


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
BYTES_PER_PARTITION = 256 * 1024 * 1024


@contextmanager
def sized_shuffles(spark: SparkSession, shuffled_bytes: int) -> Iterator[None]:
    """Within, shuffles start with as many partitions as the data needs, or with more if the session asks for more.

    Adaptive execution merges partitions that turn out small, but does not split the input of an aggregation. The
    caller's setting comes back at the end.
    """
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    wanted = shuffled_bytes // BYTES_PER_PARTITION
    if wanted <= int(before or spark.conf.get("spark.sql.shuffle.partitions")):
        yield
        return
    spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    try:
        yield
    finally:
        spark.conf.unset(INITIAL_PARTITIONS) if before is None else spark.conf.set(INITIAL_PARTITIONS, before)


def _located(spark: SparkSession, path: str):
    """The file system that holds a path, and the path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table on whichever file system holds it."""
    system, target = _located(spark, path)
    system.delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _located(spark, path)
    return system.exists(target)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a table in the place of another, on the same file system."""
    system, to = _located(spark, target)
    system.delete(to, True)
    system.mkdirs(to.getParent())
    if not system.rename(spark._jvm.org.apache.hadoop.fs.Path(source), to):
        raise OSError(f"{source} could not be moved to {target}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file; None if there is none."""
    system, target = _located(spark, path)
    if not system.exists(target):
        return None
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, there whole or not at all: written beside, then renamed over the old one."""
    system, target = _located(spark, path)
    fs = spark._jvm.org.apache.hadoop.fs
    beside = target.suffix(".new")
    stream = system.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = getattr(fs, "Options$Rename")
    options = spark._sc._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(beside, target, options)
