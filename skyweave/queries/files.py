"""Raw files, index files, exports and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.plans.release import import_catalog, import_new_files
from skyweave.plans.settings import CatalogSettings
from skyweave.queries import fixtures as data
from skyweave.queries import sql
from skyweave.queries.registry import query
from skyweave.runtime import materialize, scratch_path
from skyweave.sources.catalog import finished_files, is_valid_catalog, open_catalog
from skyweave.sources.exports import export_tables, visit_detector_source
from skyweave.sources.files import (
    file_inventory,
    first_file_schema,
    indexed_scan,
    join_keys_to_paths,
    partition_size_estimate,
    read_index_files,
    read_key_table,
    read_path_list,
    seeded_schema,
    write_index_files,
    write_size_table,
)
from skyweave.streaming.ingest import import_available, ingest_available, stream_files, stream_keyed_files

_KEYS = {"band": (r"/band=([a-z])/", "string"), "tract": (r"/tract=(\d+)/", "bigint")}


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources with positions, and the tract that their files go by."""
    rows = data.forced_sources(spark, sf_dir).drop("midpointMjdTai")
    ra, dec = data.position(F.col("objectId"))
    return rows.withColumns({"coord_ra": ra, "coord_dec": dec, "tract": F.col("visit") % 4})


def raw_files(spark: SparkSession, sf_dir: str) -> str:
    """Sources as raw files whose band and tract stand only in their paths."""
    root = scratch_path(spark, "raw")
    raw_rows(spark, sf_dir).write.partitionBy("tract", "band").parquet(root)
    return root


def add_raw_files(rows: DataFrame, folder: str) -> None:
    """Further raw files, one for each tract and band, or several where a task would get too many rows."""
    rows.hint("rebalance", "tract", "band").write.mode("append").partitionBy("tract", "band").parquet(folder)


def raw_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_inventory(spark, raw_files(spark, sf_dir), _KEYS).select("path", *_KEYS)


_RAW = f"SELECT *, visit % 4 AS tract FROM ({sql.FORCED})"


@query(f"SELECT DISTINCT band, tract FROM ({_RAW})")
def file_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of every raw file, taken from the listing."""
    return raw_index(spark, sf_dir).select("band", "tract").distinct()


@query(f"SELECT objectId, sourceId, visit, detector, psfFlux, band, tract FROM ({_RAW})")
def indexed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the indexed files with each file's keys."""
    rows = indexed_scan(spark, raw_index(spark, sf_dir))
    return rows.select("objectId", "sourceId", "visit", "detector", "psfFlux", "band", "tract")


@query(f"SELECT objectId, psfFlux FROM ({_RAW})")
def projected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns of the indexed files and no keys."""
    return indexed_scan(spark, raw_index(spark, sf_dir), columns=["objectId", "psfFlux"])


@query(f"""
SELECT objectId, sourceId, CASE WHEN band IN ('g', 'i') THEN nullif(visit % 4, 2) + 100 ELSE visit % 4 END AS tract,
       CASE WHEN band = 'i' THEN detector END AS extra
FROM ({sql.FORCED})""")
def mixed_schema_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of which some hold the key as a column, nulls included, and some a further column."""
    rows = data.forced_sources(spark, sf_dir).select("objectId", "sourceId", "band", "visit", "detector")
    tract, root = F.col("visit") % 4, scratch_path(spark, "raw-mixed")
    rows = rows.withColumn("file_tract", tract)
    own = rows.withColumn("tract", F.nullif(tract, F.lit(2)) + 100)
    kinds = {
        "with": own.where("band = 'g'").drop("detector"),
        "more": own.where("band = 'i'").withColumnRenamed("detector", "extra"),
        "without": rows.where("band NOT IN ('g', 'i')").drop("detector"),
    }
    for name, kind in kinds.items():
        kind.drop("band", "visit").write.partitionBy("file_tract").parquet(f"{root}/{name}")
    index = file_inventory(spark, root, {"tract": (r"/file_tract=(\d+)/", "bigint")})
    scan = indexed_scan(spark, index.select("path", "tract"))
    return scan.select("objectId", "sourceId", "tract", "extra")


@query(f"""
SELECT DISTINCT dense_rank() OVER (ORDER BY tract, band) - 1 AS group_no, tract, band FROM ({_RAW})""")
def index_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index files per key group, numbered in key order, read back."""
    path = scratch_path(spark, "index")
    write_index_files(raw_index(spark, sf_dir), ["tract", "band"], ["tract", "band"], path)
    index = read_index_files(spark, path, "tract bigint, band string, path string, group_no bigint")
    return index.select("group_no", "tract", "band").distinct()


@query(f"SELECT DISTINCT band, tract, TRUE AS agrees FROM ({_RAW})")
def zipped_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A path list and a key table in the same order, put side by side by position."""
    index = raw_index(spark, sf_dir).orderBy("path")
    paths_file, keys_file = scratch_path(spark, "paths"), scratch_path(spark, "refs")
    padded = index.select(F.concat(F.lit("  "), "path", F.lit(" \n")).alias("value"))
    padded.write.text(paths_file)
    index.select("band", "tract").write.option("header", True).csv(keys_file)
    keys = read_key_table(spark, keys_file, "band string, tract bigint")
    sizes = scratch_path(spark, "sizes")
    write_size_table(join_keys_to_paths(keys, read_path_list(spark, paths_file)), sizes)
    rows = read_key_table(spark, sizes)
    in_path = F.concat(F.lit("/tract="), "tract", F.lit("/band="), "band", F.lit("/"))
    return rows.select(
        "band", F.col("tract").cast("long").alias("tract"), F.col("path").contains(in_path).alias("agrees")
    ).distinct()


@query(f"SELECT count(*) AS n_rows, TRUE AS all_files, TRUE AS in_proportion FROM ({_RAW})")
def size_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that fill a partition, judged by all files; the bytes themselves depend on the writer."""
    paths_file, index = scratch_path(spark, "paths"), raw_index(spark, sf_dir)
    index.select("path").write.text(paths_file)
    n_files = index.count()
    found = partition_size_estimate(spark, read_path_list(spark, paths_file))
    share = F.col("n_rows") / F.col("n_bytes") * 1024 * 1024
    near = (F.abs(F.col("low_rows") - share * 300) <= 1) & (F.abs(F.col("high_rows") - share * 1024) <= 1)
    return found.select("n_rows", (F.col("n_files") == n_files).alias("all_files"), near.alias("in_proportion"))


@query(f"SELECT objectId, psfFlux, tract FROM ({_RAW})")
def seeded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files read with a schema fixed from the first one and the missing keys."""
    index = raw_index(spark, sf_dir)
    paths_file = scratch_path(spark, "paths")
    index.select("path").write.text(paths_file)
    schema = seeded_schema(first_file_schema(spark, read_path_list(spark, paths_file)), index.schema, ["tract"])
    own = [f for f in schema.fields if f.name != "tract"]
    rows = indexed_scan(spark, index, dims=["tract"], schema=type(schema)(own))
    return rows.select([F.col(f.name).cast(f.dataType) for f in schema.fields]).select("objectId", "psfFlux", "tract")


@query(f"""
SELECT s.objectId, s.band, s.visit % 4 AS tract, v.expMidptMJD AS midpointMjdTai, s.psfFlux::FLOAT AS psfFlux,
       ({sql.magnitude('psfFlux')})::FLOAT AS psfMag
FROM ({sql.FORCED}) s LEFT JOIN ({sql.VISITS}) v ON s.visit = v.visitId""")
def imported_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files scanned through their index, calibrated, and written as a catalog."""
    settings = CatalogSettings(
        dims=("band", "tract"), group_by=("tract",), ra="coord_ra", dec="coord_dec",
        catalog_type="source", threshold=20_000, flux_prefixes=("psf",), add_time=True,
    )
    catalog = import_catalog(
        spark, raw_index(spark, sf_dir), scratch_path(spark, "forced"), "forced", settings,
        visits=data.visits(spark, sf_dir),
    )
    return catalog.all_rows().select(
        "objectId", "band", "tract", "midpointMjdTai", "psfFlux",
        "psfMag",
    )


@query(f"""
SELECT s.objectId, s.band, s.visit % 4 AS tract, v.expMidptMJD AS midpointMjdTai, s.psfFlux::FLOAT AS psfFlux,
       ({sql.magnitude('psfFlux')})::FLOAT AS psfMag, TRUE AS each_file_once, TRUE AS valid
FROM ({sql.FORCED}) s LEFT JOIN ({sql.VISITS}) v ON s.visit = v.visitId""")
def imported_in_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files imported as they come: first those of two tracts, then what is new in two steps, then nothing."""
    threshold = max(50, data.table(spark, sf_dir, "lineitem").count() // 20)
    settings = CatalogSettings(
        dims=("band", "tract"), group_by=("tract",), ra="coord_ra", dec="coord_dec",
        catalog_type="source", threshold=threshold, flux_prefixes=("psf",), add_time=True,
    )
    index, root = materialize(raw_index(spark, sf_dir)), scratch_path(spark, "forced")
    some = index.where("tract < 2")
    n_new = index.count() - some.count()

    def run(files: DataFrame, step: int) -> int:
        return len(import_new_files(spark, files, root, "forced", settings, visits=data.visits(spark, sf_dir), files_per_step=step))

    steps = (run(some, 1_000_000), run(index, -(-n_new // 2)), run(index, 1))
    once = steps == (1, 2, 0) and finished_files(spark, root).exceptAll(index.select("path")).isEmpty()
    catalog = open_catalog(spark, root)
    valid = is_valid_catalog(spark, root, strict=True)
    return catalog.all_rows().select(
        "objectId", "band", "tract", "midpointMjdTai", "psfFlux", "psfMag", F.lit(once).alias("each_file_once"), F.lit(valid).alias("valid")
    )


@query(f"SELECT * FROM ({sql.VISIT_DETECTORS})")
def side_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A side table exported and its six columns read back."""
    source, target = scratch_path(spark, "visit_detector"), scratch_path(spark, "public")
    wider = data.visit_detectors(spark, sf_dir).withColumn("unused", F.lit(1))
    wider.write.parquet(source)
    assert export_tables(spark, {}, target) == []
    (path,) = export_tables(spark, {"ccd_visit.parquet": source}, target)
    return visit_detector_source(spark, path)


@query(f"""
SELECT s.objectId, s.visit, s.psfFlux::FLOAT AS psfFlux, v.expMidptMJD AS midpointMjdTai,
       ({sql.magnitude('psfFlux')})::FLOAT AS psfMag
FROM ({sql.FORCED}) s LEFT JOIN ({sql.VISITS}) v ON s.visit = v.visitId""")
def streamed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files taken up as a stream and calibrated; a second run finds nothing new."""
    schema = data.table(spark, sf_dir, "lineitem").schema
    output, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-checkpoint")
    for _ in range(2):
        rows = stream_files(spark, sf_dir, schema, pattern="lineitem.parquet").select(
            F.col("l_orderkey").alias("objectId"),
            F.col("l_suppkey").alias("visit"),
            F.col("l_extendedprice").alias("psfFlux"),
        )
        ingest_available(rows, output, checkpoint, ["psf"], data.visits(spark, sf_dir)).awaitTermination()
    return spark.read.parquet(output)


@query(f"""
SELECT s.objectId, s.band, s.visit % 4 AS tract, v.expMidptMJD AS midpointMjdTai, s.psfFlux::FLOAT AS psfFlux,
       ({sql.magnitude('psfFlux')})::FLOAT AS psfMag, 3::BIGINT AS n_versions, TRUE AS each_file_once, TRUE AS split,
       TRUE AS valid
FROM ({sql.FORCED}) s LEFT JOIN ({sql.VISITS}) v ON s.visit = v.visitId""")
def streamed_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files streamed into a catalog in three batches; afterwards all of them arrive again and change nothing."""
    threshold = max(50, data.table(spark, sf_dir, "lineitem").count() // 20)
    settings = CatalogSettings(
        dims=("band", "tract"), group_by=("tract",), ra="coord_ra", dec="coord_dec",
        catalog_type="source", threshold=threshold, flux_prefixes=("psf",), add_time=True,
    )
    rows, folder = raw_rows(spark, sf_dir), scratch_path(spark, "arriving")
    root, checkpoint = scratch_path(spark, "streamed"), scratch_path(spark, "streamed-checkpoint")
    schema = rows.drop("band", "tract").schema
    sizes = []

    def take(checkpoint: str, files_per_batch: int = 1_000) -> None:
        stream = stream_keyed_files(spark, folder, schema, _KEYS, max_files_per_trigger=files_per_batch)
        visits = data.visits(spark, sf_dir)
        import_available(stream, root, "forced", settings, checkpoint, visits=visits).awaitTermination()
        sizes.append(open_catalog(spark, root).properties["n_partitions"])

    add_raw_files(rows.where("tract < 2"), folder)
    n_files = file_inventory(spark, folder, _KEYS).count()
    take(checkpoint, -(-n_files // 2))
    add_raw_files(rows.where("tract >= 2"), folder)
    take(checkpoint, file_inventory(spark, folder, _KEYS).count())
    take(checkpoint)
    take(f"{checkpoint}-new")
    catalog = open_catalog(spark, root)
    paths = file_inventory(spark, folder, _KEYS).select("path")
    taken = finished_files(spark, root)
    once = paths.exceptAll(taken).isEmpty() and taken.exceptAll(paths).isEmpty()
    overfull = catalog.partitions().where((F.col("n_rows") > threshold) & (F.col("Norder") < 10)).count()
    return catalog.all_rows().select(
        "objectId", "band", "tract", "midpointMjdTai", "psfFlux", "psfMag",
        F.lit(catalog.properties["number"]).cast("long").alias("n_versions"),
        F.lit(once).alias("each_file_once"),
        F.lit(overfull == 0 and sizes[0] < sizes[1]).alias("split"),
        F.lit(is_valid_catalog(spark, root, strict=True)).alias("valid"),
    )
