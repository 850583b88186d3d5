"""Ingest raw files as they arrive, each one once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from skyweave.operators.calibration import calibrate
from skyweave.plans.release import take_in
from skyweave.plans.settings import CatalogSettings
from skyweave.runtime import broadcast_checked, materialize
from skyweave.sources.catalog import DEFAULT_HIGHEST_ORDER, finished_files
from skyweave.sources.files import normal_path

# The file that a row of a stream came from.
FILE = "_file"


def stream_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    pattern: str = "*.parquet",
    max_files_per_trigger: int = 1_000,
) -> DataFrame:
    """New parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    return reader.option("maxFilesPerTrigger", max_files_per_trigger).parquet(folder)


def ingest_available(
    rows: DataFrame,
    output: str,
    checkpoint: str,
    prefixes: Sequence[str] = (),
    visits: DataFrame | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Calibrate everything that has arrived and stop; started again, it takes what is new.

    The checkpoint remembers finished files and the parquet sink commits each batch once, so a
    restart after a failure neither loses nor repeats rows.
    """
    calibrated = calibrate(rows, prefixes, visits)
    writer = calibrated.writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return (
        writer.option("checkpointLocation", checkpoint)
        .option("path", output)
        .trigger(availableNow=True)
        .start()
    )


def stream_keyed_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    keys: Mapping[str, tuple[str, str]],
    pattern: str = "*.parquet",
    max_files_per_trigger: int = 1_000,
) -> DataFrame:
    """As ``stream_files`` over all levels of a folder, with the keys of each row's file and its path as ``_file``.

    ``keys`` are given as for ``file_inventory``: a regular expression with one group, searched in the
    path, and a type. A key that is a column of ``schema`` comes from the file. A key not found is null.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    rows = reader.option("maxFilesPerTrigger", max_files_per_trigger).parquet(folder)
    path = normal_path(F.col("_metadata.file_path"))
    found = [
        F.nullif(F.regexp_extract(path, regex, 1), F.lit("")).cast(kind).alias(name)
        for name, (regex, kind) in keys.items()
        if name not in schema.names
    ]
    return rows.select(*schema.names, *found, path.alias(FILE))


def import_available(
    rows: DataFrame,
    root: str,
    name: str,
    settings: CatalogSettings,
    checkpoint: str,
    *,
    visits: DataFrame | None = None,
    highest_order: int = DEFAULT_HIGHEST_ORDER,
) -> StreamingQuery:
    """Take every file that has arrived into a catalog and stop; started again, it takes what is new.

    Each batch of ``stream_keyed_files`` becomes one version, which records the files of the batch; an
    overfull partition is split. Files that a version holds already are left out, so a batch that is
    run again, another checkpoint over the same folder, or files from ``import_new_files`` add nothing
    twice. One stream at a time writes a catalog: of two versions with one number, one is an error.
    """

    def add(batch: DataFrame, _number: int) -> None:
        spark = batch.sparkSession
        # Only the paths are read here, none of the columns.
        arrived = batch.select(F.col(FILE).alias("path")).distinct()
        new = materialize(arrived.join(finished_files(spark, root).distinct(), "path", "left_anti"))
        if new.isEmpty():
            return
        raw = batch.join(broadcast_checked(new.withColumnRenamed("path", FILE)), FILE, "left_semi").drop(FILE)
        take_in(spark, raw, new, root, name, settings, visits=visits, highest_order=highest_order)

    writer = rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
