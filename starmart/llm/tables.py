"""Intermediate tables in the folder that all executors share, and small helpers on frames."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import session


@lru_cache(maxsize=1)
def _local() -> str:
    path = tempfile.mkdtemp(prefix="starmart-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`. Where it is unset, a folder of this machine, if all of Spark runs on it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return _local()
    raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")


#: Rows that tasks hand to Python at a time while a table is written; texts are long.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


#: For each `passing` that is open, the folders written within.
_passing: ContextVar[tuple[list[str], ...]] = ContextVar("passing", default=())


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Within, tables that are written go at the end, except those that stay. What is returned reads only the latter."""
    own: list[str] = []
    token = _passing.set((*_passing.get(), own))
    try:
        yield
    finally:
        _passing.reset(token)
        for path in own:
            session.remove(spark, path)


def written(df: DataFrame, name: str, stays: bool = False) -> DataFrame:
    """The same rows, read back from a table: later steps neither repeat this work nor depend on its shuffles.

    Within `passing` the table goes when that ends; one that `stays` goes when the `passing` around it ends, if any.
    """
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    lists = _passing.get()[: -1 if stays else None]
    if lists:
        lists[-1].append(path)
    before = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, str(BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_BATCH) if before is None else spark.conf.set(_BATCH, before)
    return spark.read.schema(df.schema).parquet(path)


def free(df: DataFrame, name: str) -> str:
    """This name, or a longer one that no column of the frame has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shuffles(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, all else unchanged."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
