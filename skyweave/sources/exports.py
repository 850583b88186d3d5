"""Side tables, statistics and summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.operators.nesting import PART
from skyweave.functions.labels import joined_label, readable_size
from skyweave.sources.catalog import Catalog


def export_tables(spark: SparkSession, tables: Mapping[str, str], folder: str) -> list[str]:
    """Copy parquet tables, name → source path, into a folder; nothing to do for no tables."""
    written = []
    for name, source in tables.items():
        target = f"{folder}/{name}"
        spark.read.parquet(source).write.mode("overwrite").parquet(target)
        written.append(target)
    return written


def visit_detector_source(spark: SparkSession, path: str) -> DataFrame:
    """The six columns the correction needs."""
    return spark.read.parquet(path).select(
        "visitId", "detector", "skyBg", "seeing", "expTime", "band"
    )


def write_statistics(statistics: DataFrame, path: str) -> None:
    statistics.write.mode("overwrite").parquet(path)


def write_feature_table(features: DataFrame, path: str, keys: Sequence[str] = ("visit", "detector")) -> None:
    """Features sorted by their keys across files, so that a lookup of few keys reads few of them."""
    features.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def _links(pairs: Sequence[tuple[str, str]]) -> Column:
    links = [F.struct(F.lit(label).alias("label"), F.lit(url).alias("url")) for label, url in pairs]
    return F.array(*links) if links else F.array().cast("array<struct<label:string,url:string>>")


def collection_summary(
    catalog: Catalog,
    name: str,
    *,
    version: str,
    run: str | None = None,
    tag: str | None = None,
    other_urls: Sequence[tuple[str, str]] = (),
    badges: Sequence[str] = (),
) -> DataFrame:
    """One-row description of a collection: its properties, and the objects of a nested catalog."""
    spark, properties = catalog.spark, catalog.properties
    rows, n_rows = catalog.all_rows(), F.lit(properties["total_rows"])
    if PART in rows.columns:
        n_rows = F.lit(rows.where(F.col(PART) == 0).count())
    run_c, tag_c = F.lit(run).cast("string"), F.lit(tag).cast("string")
    titles = [F.struct(F.lit(badge).alias("title")) for badge in badges]
    path = joined_label("/", F.lit("DRP"), run_c, F.lit(version), tag_c)
    return spark.range(1).select(
        F.lit(f"{version}/{name}").alias("label"),
        joined_label(" ", run_c, F.lit(version), F.lit(name)).alias("name"),
        F.concat_ws(" ", path, F.lit(name)).alias("description"),
        F.struct(F.lit(catalog.root).alias("catalog")).alias("urls"),
        _links(other_urls).alias("other_urls"),
        F.struct(
            n_rows.cast("long").alias("numRows"),
            F.lit(properties["n_columns"]).cast("long").alias("numColumns"),
            F.lit(properties["n_partitions"]).cast("long").alias("numPartitions"),
            readable_size(F.lit(properties["est_size_kb"]).cast("long") * 1024).alias("sizeOnDisk"),
            F.lit(properties["builder"]).alias("builder"),
        ).alias("metadata"),
        (F.array(*titles) if titles else F.array().cast("array<struct<title:string>>")).alias("badges"),
    )


def write_summaries(summaries: Sequence[DataFrame], path: str) -> None:
    """All summaries of a data release as JSON lines."""
    rows = summaries[0]
    for more in summaries[1:]:
        rows = rows.unionByName(more)
    rows.coalesce(1).write.mode("overwrite").json(path)
