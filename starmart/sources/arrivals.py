"""Reading raw arrivals."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE_FILE = "source_file"
SOURCE_ROW = "source_row"
ORIGIN = (SOURCE_FILE, SOURCE_ROW)


def read(
    spark: SparkSession,
    *paths: str,
    schema: T.StructType | None = None,
    drop_columns: Sequence[str] = (),
    origin: bool = False,
    skip_corrupt: bool = False,
) -> DataFrame:
    """Arrivals of all parquet files under the paths.

    `schema` spares the look into a file footer. `drop_columns` leaves columns out of the scan, for instance
    those a null profile shows to be nearly empty. `origin` adds the file and the row number within it.
    `skip_corrupt` passes over unreadable files instead of failing; without a schema the footers of all files are
    then read, since the first one may be unreadable. `skipped` names those files.
    """
    reader = spark.read.option("ignoreCorruptFiles", str(skip_corrupt).lower())
    if schema is not None:
        reader = reader.schema(schema)
    elif skip_corrupt:
        reader = reader.option("mergeSchema", "true")
    raw = reader.parquet(*paths)
    dropped = [c for c in drop_columns if c in raw.columns]
    return (with_origin(raw) if origin else raw).drop(*dropped)


def with_origin(raw: DataFrame) -> DataFrame:
    """Add the source file and the row number within it to a parquet scan."""
    return raw.select(
        "*",
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.row_index").alias(SOURCE_ROW),
    )


# Unreadable files up to this size are opened once more, in a task, to say what is wrong with them.
PROBE_BYTES = 256 * 1024 * 1024


def skipped(spark: SparkSession, paths: Sequence[str], schema: T.StructType, read_rows: DataFrame | None = None) -> DataFrame:
    """Files that `skip_corrupt` passed over, wholly or in part: file, bytes, file_rows, read_rows, error.

    The files are listed; a scan of no columns, which reads footers only, counts the rows of those it can open.
    `read_rows` (file, read_rows) says how many rows a real scan got: fewer mean that it broke off within the file.
    Files that cannot be opened are few; a task opens each of them and notes the error, null rows and all. A readable
    file without rows is not reported.
    """
    name = F.col("_metadata.file_path").alias("file")
    listed = spark.read.format("binaryFile").load(list(paths)).select(name, F.col("length").alias("bytes"))
    footers = (
        spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(*paths)
        .select(name).groupBy("file").agg(F.count(F.lit(1)).alias("file_rows"))
    )
    found = listed.join(footers, "file", "left")
    found = found.withColumn("read_rows", F.lit(None).cast("long")) if read_rows is None else found.join(read_rows, "file", "left")
    short = found.where(F.col("file_rows").isNull() | (F.coalesce("read_rows", F.lit(0)) < F.col("file_rows")) if read_rows is not None else F.col("file_rows").isNull())
    suspects = short.collect()  # no more than the driver lists anyway
    shut = [unquote(r.file) for r in suspects if r.file_rows is None and r.bytes <= PROBE_BYTES]
    errors = {}
    if shut:
        opened = spark.read.format("binaryFile").load(shut).select(name, "content").repartition(len(shut))
        errors = {r.file: r.error for r in opened.mapInArrow(_probed, "file string, error string").collect()}
    rows = []
    for r in suspects:
        error = errors.get(r.file, "not opened again: too large") if r.file_rows is None else "broken off while it was read"
        if error is not None:
            rows.append((r.file, r.bytes, r.file_rows, r.read_rows, error))
    return spark.createDataFrame(rows, "file string, bytes long, file_rows long, read_rows long, error string")


def _probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is wrong with the files whose content this is; null for a file that is only empty of rows."""
    for batch in batches:
        errors = []
        for content in batch["content"]:
            try:
                pq.ParquetFile(pa.BufferReader(content.as_buffer()))
                errors.append(None)
            except (pa.ArrowException, OSError) as error:
                errors.append(f"{type(error).__name__}: {error}"[:500])
        yield pa.RecordBatch.from_arrays([batch["file"], pa.array(errors, pa.string())], names=["file", "error"])


def sample(df: DataFrame, target_rows: int = 1_000_000, assumed_rows: int = 40_000_000, seed: int = 42) -> DataFrame:
    """Row sample that comes to about `target_rows` when the table has `assumed_rows`."""
    return df.sample(fraction=min(1.0, target_rows / assumed_rows), seed=seed)


# Parts into which a range of digests is cut in each pass of `sample_rows`.
PARTS = 1024
_DIGESTS = 1 << 52


def _digest(*parts: str) -> Column:
    text = F.concat_ws("#", *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def sample_rows(df: DataFrame, rows: int, key: str, by: str) -> DataFrame:
    """Exactly `rows` rows of each value of `by`, or all it has: those with the least digests of `by` and `key`.

    The same rows in every run, however the table is partitioned, if `key` tells the rows of a value apart. No row is
    sorted or moved: for each value, digests are counted in parts of their range by partial aggregation, the part that
    holds the last row wanted is cut again, and so on until it ends with that row. Each pass reads two columns only.
    """
    spark = df.sparkSession
    digests = df.select(F.col(by).alias("of"), _digest(by, key).alias("digest"))
    size = F.expr(f"(high - low) div {PARTS} + 1")
    open_ = digests.select("of").distinct().select("of", F.lit(0).cast("long").alias("low"), F.lit(_DIGESTS - 1).alias("high"), F.lit(rows).cast("long").alias("need"))
    ends, schema = [], "of {}, low long, high long, need long".format(df.schema[by].dataType.simpleString())
    bounds = spark.createDataFrame(open_.collect(), schema)
    while not bounds.isEmpty():
        parts = (
            digests.join(F.broadcast(bounds.withColumnRenamed("of", "own")), F.col("of").eqNullSafe(F.col("own")) & F.col("digest").between(F.col("low"), F.col("high")))
            .groupBy("of", "low", "high", "need", F.expr(f"(digest - low) div ((high - low) div {PARTS} + 1)").alias("part"))
            .agg(F.count(F.lit(1)).alias("rows"))
        )
        upto = parts.withColumn("upto", F.sum("rows").over(W.partitionBy("of").orderBy("part")))
        held = upto.where("upto >= need AND upto - rows < need").select(
            "of", (F.col("low") + F.col("part") * size).alias("low"), F.least("high", F.col("low") + (F.col("part") + 1) * size - 1).alias("high"),
            (F.col("need") - F.col("upto") + F.col("rows")).alias("need"), "rows",
        ).collect()  # one row for each value of `by`
        # done where the part ends with the last row wanted, or is a single digest; `need` of that digest's rows stay
        ends += [(r.of, r.high, None if r.rows == r.need else r.need) for r in held if r.rows == r.need or r.low == r.high]
        bounds = spark.createDataFrame([(r.of, r.low, r.high, r.need) for r in held if r.rows != r.need and r.low < r.high], schema)
    last = spark.createDataFrame(ends, "_own {}, _last long, _ties long".format(df.schema[by].dataType.simpleString()))
    marked = df.withColumn("_digest", _digest(by, key)).join(F.broadcast(last), F.col(by).eqNullSafe(F.col("_own")), "left")
    whole = marked.where(F.col("_last").isNull() | (F.col("_digest") < F.col("_last")) | ((F.col("_digest") == F.col("_last")) & F.col("_ties").isNull()))
    tied = marked.where((F.col("_digest") == F.col("_last")) & F.col("_ties").isNotNull())
    place = F.row_number().over(W.partitionBy(by).orderBy(key))
    tied = tied.withColumn("_place", place).where("_place <= _ties")
    return whole.select(*df.columns).unionByName(tied.select(*df.columns))


def sample_files(raw: DataFrame, rows: int) -> DataFrame:
    """Exactly `rows` rows of each file, or all it has; `raw` was read with its origin."""
    return sample_rows(raw, rows, SOURCE_ROW, SOURCE_FILE)


def sample_by_key(df: DataFrame, key: str, share: float) -> DataFrame:
    """About this share of the keys with all their rows, the same in every run and on every engine: by digest."""
    place = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 13), 16, 10).cast("double")
    return df.where(place < share * 16**13)


def peek(df: DataFrame, rows: int = 5, by: Sequence[str] = ()) -> DataFrame:
    """A few rows to look at: the first by the given columns, or whichever come first."""
    return (df.orderBy(*by) if by else df).limit(rows)


def fields(df: DataFrame) -> list[tuple[str, str]]:
    """Column names and types; runs no job."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
