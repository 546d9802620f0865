"""Code lookups: tables (lookup, code, description) from CSV files or from a value-format catalog."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import schemas
from starmart.functions.text import strip

# Lookups with numeric codes, and the one lookup whose CSV is trimmed.
NUMERIC_CODES = (schemas.COUNTRY, schemas.MODE, schemas.VISA)
TRIMMED = schemas.COUNTRY

Lookups = dict[str, DataFrame]


def last_wins(lookup: DataFrame, keys: Sequence[str], position: Column) -> DataFrame:
    """One row per key; of repeated keys the one at the last position stays."""
    return lookup.groupBy(*keys).agg(F.max_by("description", position).alias("description"))


def unique(lookup: DataFrame) -> DataFrame:
    """One row per code, for tables without an order: the greatest description stays."""
    return lookup.groupBy("code").agg(F.max("description").alias("description"))


def read_named(
    spark: SparkSession, path: str, names: Iterable[str] | None = None, trim_codes: bool = False
) -> Lookups:
    """Lookup CSVs of a folder as one (code, description) frame each, or just the named ones.

    A file `NAME.csv`, or files under `lookup=NAME/`, make lookup NAME. Columns go by their header names, so
    they may stand in any order and among others. Of repeated codes the last stays.
    """
    files = _files(spark, path)
    if names is not None:
        files = {name: files.get(name, []) for name in names}
        absent = [name for name, found in files.items() if not found]
        if absent:
            raise FileNotFoundError(f"no CSV in {path} for lookup(s) {', '.join(absent)}")
    if not files:
        raise FileNotFoundError(f"no lookup CSV in {path}")
    lookups = {}
    for name, found in files.items():
        rows = reduce(DataFrame.unionByName, [_rows(spark, file) for file in found])
        if name == TRIMMED:
            rows = rows.withColumns({c: strip(F.col(c)) for c in ("code", "description")})
        elif trim_codes:
            rows = rows.withColumn("code", strip(F.col("code")))
        lookups[name] = last_wins(rows.where("code is not null"), ["code"], F.col("position"))
    return lookups


def read_csv_dir(
    spark: SparkSession, path: str, names: Iterable[str] | None = None, trim_codes: bool = False
) -> DataFrame:
    """The lookups `read_named` reads, as one table (lookup, code, description)."""
    tables = read_named(spark, path, names, trim_codes).items()
    return reduce(DataFrame.unionByName, [table.select(F.lit(name).alias("lookup"), "*") for name, table in tables])


def _rows(spark: SparkSession, file: str) -> DataFrame:
    """Code, description and position of each line; quoted commas, doubled quotes and outer blanks are kept."""
    rows = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(file)
    )
    missing = {"code", "description"} - set(rows.columns)
    if missing:
        raise ValueError(f"lookup file {file} lacks column(s) {', '.join(sorted(missing))}")
    position = F.struct(F.lit(file), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return rows.select("code", "description", position.alias("position"))


def _files(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """CSV files of a folder by lookup name: a list as long as the folder, no file is read."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(_lookup_name(F.col("path")).alias("lookup"), "path")
        .orderBy("path")
    )
    files: dict[str, list[str]] = {}
    for row in listing.collect():
        files.setdefault(row.lookup, []).append(row.path)
    return files


def _lookup_name(path: Column) -> Column:
    folder = F.regexp_extract(path, r"/lookup=([^/]+)/[^/]*$", 1)
    stem = F.regexp_extract(path, r"([^/]+)\.csv$", 1)
    return F.when(folder != "", folder).otherwise(stem)


def from_format_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Lookups of a value-format catalog: blocks `value NAME` or `value $NAME` closed by `;`.

    A line `code = 'text'` makes a row; blanks and quotes around both go. Codes of numeric lookups lose leading
    zeros and the like. A repeated code keeps its last text.
    """
    return parse_catalogs(spark.read.text(path, wholetext=True))


def parse_catalogs(texts: DataFrame) -> DataFrame:
    """Lookups of whole catalogs, one per row of the column `value`."""
    blocks = (
        texts.select(F.explode(F.regexp_extract_all("value", F.lit(r"(?s)value\s+(\$?\w+.*?);"), F.lit(1))).alias("block"))
        .select(
            F.regexp_extract("block", r"^\$?(\w+)", 1).alias("lookup"),
            F.regexp_replace("block", r"^\$?\w+", "").alias("body"),
        )
    )
    lines = blocks.select("lookup", F.posexplode(F.split("body", r"\r?\n")).alias("position", "line")).where(
        F.col("line").contains("=")
    )
    halves = F.split("line", "=", 2)
    code = F.btrim(strip(F.get(halves, F.lit(0))), F.lit("'"))
    whole = code.try_cast("bigint").cast("string")
    rows = lines.select(
        "lookup",
        "position",
        F.when(F.col("lookup").isin(*NUMERIC_CODES), F.coalesce(whole, code)).otherwise(code).alias("code"),
        strip(F.btrim(strip(F.get(halves, F.lit(1))), F.lit("'"))).alias("description"),
    )
    return last_wins(rows, ["lookup", "code"], F.col("position"))


def write_csv(lookups: DataFrame, path: str) -> None:
    """One folder `lookup=NAME/` of CSV with header per lookup; `read_csv_dir` reads it back."""
    (
        lookups.select("lookup", "code", "description")
        .hint("rebalance", "lookup")
        .sortWithinPartitions("lookup", "code")
        .write.mode("overwrite")
        .partitionBy("lookup")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def names(lookups: DataFrame) -> list[str]:
    """Lookup names present, as many as there are files."""
    return sorted(row.lookup for row in lookups.select("lookup").distinct().collect())


def require(present: Iterable[str], wanted: Iterable[str] = schemas.REQUIRED_LOOKUPS) -> None:
    """Fail unless every wanted lookup is there."""
    absent = [name for name in wanted if name not in set(present)]
    if absent:
        raise ValueError(f"missing lookup(s): {', '.join(absent)}")


def by_name(lookups: DataFrame, present: Iterable[str] | None = None) -> Lookups:
    """Split the long table into one (code, description) frame per lookup."""
    return {
        name: lookups.where(F.col("lookup") == name).select("code", "description")
        for name in (names(lookups) if present is None else present)
    }


def from_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType = schemas.LOOKUP) -> DataFrame:
    """Rows at hand as a table with an explicit schema."""
    return spark.createDataFrame(list(rows), schema)
