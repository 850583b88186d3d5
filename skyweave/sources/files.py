"""Raw datasets: file lists, key tables, index files and scans that attach per-file keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweave.operators.numbering import number_groups, number_rows, zip_by_position
from skyweave.runtime import broadcast_checked

# The two target sizes of the partition-size estimate.
LOW_TARGET_BYTES = 300 * 1024 * 1024
HIGH_TARGET_BYTES = 1024 * 1024 * 1024


def normal_path(path: Column) -> Column:
    """One spelling for a path, with or without a ``file:`` scheme and repeated slashes."""
    bare = F.concat(F.lit("/"), F.ltrim(F.substr(path, F.lit(6)), F.lit("/")))
    return F.when(path.startswith("file:"), bare).otherwise(path)


def _in_file_order(df: DataFrame) -> DataFrame:
    """Add ``_row``, the position of a line in its files, taken by path and offset."""
    placed = df.withColumns(
        {
            "_path": F.col("_metadata.file_path"),
            "_block": F.col("_metadata.file_block_start"),
            "_line": F.monotonically_increasing_id(),
        }
    )
    return number_rows(placed, ["_path", "_block", "_line"]).drop("_path", "_block", "_line")


def read_path_list(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines of a text file, trimmed, with their position: ``path, _row``."""
    lines = spark.read.text(path)
    kept = lines.select(F.trim("value").alias("path"), "_metadata").where(F.length("path") > 0)
    return _in_file_order(kept).select("path", "_row")


def read_key_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A CSV table with header and the position of each row; types are inferred without a schema."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    table = reader.csv(path)
    return _in_file_order(table.select("*", "_metadata")).drop("_metadata")


def file_inventory(
    spark: SparkSession, root: str, keys: Mapping[str, tuple[str, str]], pattern: str = "*.parquet"
) -> DataFrame:
    """Every file of a dataset with its size, time and keys.

    ``keys`` maps a column to a regular expression with one group, searched in the path, and the
    type of the result. Only the listing is read, never the content.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(root)
    )
    found = [
        F.nullif(F.regexp_extract("path", regex, 1), F.lit("")).cast(kind).alias(name)
        for name, (regex, kind) in keys.items()
    ]
    return files.select(
        normal_path(F.col("path")).alias("path"),
        *found,
        F.col("length").alias("n_bytes"),
        F.col("modificationTime").alias("modified"),
    )


def join_keys_to_paths(keys: DataFrame, paths: DataFrame) -> DataFrame:
    """Key table beside the path list, by position; unequal lengths are an error."""
    return zip_by_position(keys, paths).drop("_row")


def write_size_table(table: DataFrame, path: str) -> None:
    """Keys and paths as CSV with header."""
    table.write.mode("overwrite").option("header", True).csv(path)


def write_index_files(
    table: DataFrame, dims: Sequence[str], group_by: Sequence[str], path: str
) -> None:
    """CSV files of dims and paths, one folder ``group_no=N`` per key group in sorted key order."""
    table = table.select(*dims, "path")
    numbers = broadcast_checked(number_groups(table, group_by))
    grouped = table.join(numbers, list(group_by)).select(*dims, "path", "group_no")
    laid_out = grouped.hint("rebalance", "group_no")
    laid_out.write.mode("overwrite").partitionBy("group_no").option("header", True).csv(path)


def read_index_files(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Index rows with their ``group_no``."""
    return spark.read.option("header", True).schema(schema).csv(path)


def seeded_schema(first: T.StructType, index: T.StructType, dims: Sequence[str]) -> T.StructType:
    """Schema of the first file without metadata, plus the dims it lacks, typed as in the index."""
    own = [T.StructField(f.name, f.dataType, True) for f in first.fields]
    names = {f.name for f in own}
    return T.StructType(own + [T.StructField(d, index[d].dataType, True) for d in dims if d not in names])


def first_file_schema(spark: SparkSession, paths: DataFrame) -> T.StructType:
    """Schema of the first file of a path list; one footer is read."""
    first = paths.orderBy("_row").limit(1).first()
    return spark.read.parquet(first["path"]).schema


# What stands in a key column for rows of files that lack it, by type.
_ABSENT = {
    "string": "'\\u0000absent'",
    "tinyint": "cast(-128 as tinyint)",
    "smallint": "cast(-32768 as smallint)",
    "int": "-2147483648",
    "bigint": "-9223372036854775808",
    "float": "cast(-3.4028234663852886E38 as float)",
    "double": "-1.7976931348623157E308D",
    "date": "date '0001-01-01'",
}


def listed_files(index: DataFrame) -> list[str]:
    """The indexed files, each once; only their paths come to the driver, which plans the scan of them."""
    return [row["path"] for row in index.select("path").where(F.col("path").isNotNull()).distinct().orderBy("path").toLocalIterator()]


def indexed_scan(
    spark: SparkSession,
    index: DataFrame,
    *,
    dims: Sequence[str] | None = None,
    schema: T.StructType | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Read the indexed files and attach each file's keys as constant columns.

    ``index`` holds ``path`` and the keys. File by file, a key is attached only where the file has
    no column of that name; a file's own column stays, nulls included. Files may differ in their
    columns: the result has all of them, or those of ``schema``. ``columns`` reads just those
    columns and attaches no keys. Nothing but the listed files is opened, neither for the rows nor for
    their schema. Keys are of the types of ``_ABSENT``, whose values no file may hold in a key column.
    """
    dims = [c for c in index.columns if c != "path"] if dims is None else list(dims)
    files = listed_files(index)
    if not files:
        if schema is None:
            raise ValueError("an empty index has no schema to read")
        return _without_files(spark, schema, index, dims, columns)
    reader = spark.read.option("recursiveFileLookup", True)
    own = schema or reader.option("mergeSchema", True).parquet(*files).schema
    if columns is not None:
        return reader.schema(own).parquet(*files).select(*columns)

    fields = [f for f in own.fields if f.name not in dims]
    fields += [_with_default(own[d].dataType if d in own.names else index.schema[d].dataType, d) for d in dims]
    rows = _with_keys(reader.schema(T.StructType(fields)).parquet(*files), index, dims)
    kinds = {f.name: f.dataType for f in fields}

    def key(name: str) -> Column:
        lacking = F.col(name) == F.expr(_ABSENT[kinds[name].simpleString()])
        return F.when(lacking, F.col(f"_key_{name}").cast(kinds[name])).otherwise(F.col(name)).alias(name)

    return rows.select(*[f.name for f in own.fields if f.name not in dims], *[key(d) for d in dims])


def _with_default(kind: T.DataType, name: str) -> T.StructField:
    """A column that reads as its absent value from files without it."""
    default = _ABSENT[kind.simpleString()]
    return T.StructField(name, kind, True, {"EXISTS_DEFAULT": default, "CURRENT_DEFAULT": default})


def _without_files(
    spark: SparkSession, schema: T.StructType, index: DataFrame, dims: Sequence[str], columns: Sequence[str] | None
) -> DataFrame:
    added = [T.StructField(d, index.schema[d].dataType, True) for d in dims if d not in schema.names]
    empty = spark.createDataFrame([], T.StructType([*schema.fields, *added]))
    return empty.select(*columns) if columns is not None else empty


def _with_keys(files: DataFrame, index: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Rows with the keys of their file as ``_key_…``."""
    keys = index.select(
        normal_path(F.col("path")).alias("_listed"), *[F.col(d).alias(f"_key_{d}") for d in dims]
    ).distinct()
    marked = files.withColumn("_listed", normal_path(F.col("_metadata.file_path")))
    return marked.join(broadcast_checked(keys), "_listed")


def partition_size_estimate(spark: SparkSession, paths: DataFrame) -> DataFrame:
    """Rows that fill 300 MiB and 1 GiB, judged by all files of a path list.

    Gives ``n_files, n_rows, n_bytes, low_rows, high_rows``; the estimates are null without data.
    Rows are counted from the footers, sizes come from the listing.
    """
    listed = listed_files(paths)
    if not listed:
        empty = "0L as n_files", "0L as n_rows", "0L as n_bytes", "null as low_rows", "null as high_rows"
        return spark.range(1).selectExpr(*empty)
    counted = spark.read.option("recursiveFileLookup", True).parquet(*listed).agg(F.count(F.lit(1)).alias("n_rows"))
    # Files without rows appear in no scan, so sizes come from the listing.
    inventory = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(listed)
    files = inventory.agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))
    both = files.withColumn("n_rows", counted.scalar())

    def fill(target: int) -> Column:
        return F.floor(F.try_divide(F.lit(float(target)), F.col("n_bytes")) * F.col("n_rows"))

    return both.select(
        "n_files",
        "n_rows",
        "n_bytes",
        fill(LOW_TARGET_BYTES).alias("low_rows"),
        fill(HIGH_TARGET_BYTES).alias("high_rows"),
    )
