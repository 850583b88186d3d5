"""Sky-partitioned catalogs on disk.

A catalog is a folder with one ``data-<version>`` dataset per version, laid out as
``Norder=/Dir=/Npix=`` folders, a ``partitions-<version>`` table of its pixels, and a
``properties`` log. The row with the highest number names the version in force, so a rewrite becomes
visible at once, and readers of the previous version keep their files. A version that changes or adds
some partitions writes only these and names the earlier folders that hold the others. Of two writers that took
the same number at the same time, one wins for all readers and the other gets an error.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweave import __version__
from skyweave.functions.nested import available_columns, full_column_names, select_columns
from skyweave.functions.sky import FINEST_ORDER, LAYOUT_COLUMNS, PIXEL, with_pixel
from skyweave.operators.alignment import CELL, cell_number, with_cell_of
from skyweave.operators.keys import HASH, HASHES, id_hash, lookup_ids
from skyweave.operators.partitioning import (
    assign_partitions,
    partition_map,
    pixel_histogram,
)
from skyweave.functions.pixels import coverage
from skyweave.operators.spatial import (
    cone_search,
    margin_rows,
    multi_cone,
    partitions_in_cone,
    partitions_in_coverage,
    rows_in_coverage,
)
from skyweave.operators.statistics import merged_statistics, partition_statistics
from skyweave.runtime import PLAIN_LOCAL_FILES, broadcast_checked, list_by_cores, materialize, read_folders

# Finest partition order unless a catalog asks for another.
DEFAULT_HIGHEST_ORDER = 10

_PROPERTIES_SCHEMA = """
    number bigint, version string, created timestamp, catalog_name string, catalog_type string,
    ra_column string, dec_column string, total_rows bigint, n_partitions bigint,
    n_columns bigint, est_size_kb bigint, highest_order int, builder string,
    default_columns string, margin_threshold double, source_version string, row_schema string,
    n_buckets int, cells_of string, data_versions string, batch string, n_files bigint
"""
_PARTITIONS_SCHEMA = "Norder int, Dir bigint, Npix bigint, n_rows bigint, n_bytes bigint, data_version string"
_LAYOUT = ("Norder", "Dir", "Npix")


@dataclass(frozen=True)
class Catalog:
    """An opened catalog."""

    spark: SparkSession
    root: str
    properties: Row
    # Folders that were listed: the files of a version do not change once it is recorded.
    _listed: dict[str, DataFrame] = field(default_factory=dict, repr=False, compare=False)

    @property
    def data_path(self) -> str:
        return f"{self.root}/data-{self.properties['version']}"

    @property
    def density_path(self) -> str:
        """Where density maps of this version are kept."""
        return f"{self.root}/density-{self.properties['version']}"

    @property
    def position(self) -> tuple[str, str]:
        return self.properties["ra_column"], self.properties["dec_column"]

    @property
    def data_versions(self) -> list[str]:
        """Versions in whose folders the rows lie: earlier ones that share partitions, then its own."""
        return (self.properties["data_versions"] or self.properties["version"]).split(",")

    def placed_partitions(self) -> DataFrame:
        """``partitions`` with ``data_version``, a row for each folder that holds rows of a partition."""
        path = f"{self.root}/partitions-{self.properties['version']}"
        own = F.coalesce("data_version", F.lit(self.properties["version"]))
        return self.spark.read.schema(_PARTITIONS_SCHEMA).parquet(path).withColumn("data_version", own)

    def partitions(self) -> DataFrame:
        """``Norder, Dir, Npix, n_rows, n_bytes`` as recorded when the version was written."""
        placed = self.placed_partitions()
        if len(self.data_versions) == 1:
            return placed.drop("data_version")
        sizes = [F.sum(c).alias(c) for c in ("n_rows", "n_bytes")]
        return placed.groupBy(*_LAYOUT).agg(*sizes)

    def _folder(self, version: str) -> DataFrame:
        if version not in self._listed:
            schema = T.StructType.fromJson(json.loads(self.properties["row_schema"]))
            self._listed[version] = read_folders(self.spark, schema, f"{self.root}/data-{version}")
        return self._listed[version]

    def all_rows(self) -> DataFrame:
        """Everything, with the recorded schema; nothing has to be inferred, also not from no files.

        Of folders of earlier versions only the partitions that are still shared are read.
        """
        *earlier, own = self.data_versions
        rows = self._folder(own)
        for version in earlier:
            held = self.placed_partitions().where((F.col("data_version") == version) & (F.col("Npix") >= 0))
            folder = self._folder(version)
            shared = folder.join(broadcast_checked(held.select("Norder", "Npix")), ["Norder", "Npix"], "left_semi")
            rows = rows.unionByName(shared.select(*folder.columns))
        return rows

    def measured_partitions(self) -> DataFrame:
        """``partitions`` as the files of all folders have them."""
        *earlier, own = self.data_versions
        found = _measured_partitions(self._folder(own))
        for version in earlier:
            held = self.placed_partitions().where(F.col("data_version") == version).select(*_LAYOUT)
            found = found.unionByName(_measured_partitions(self._folder(version)).join(held, list(_LAYOUT), "left_semi"))
        return found.groupBy(*_LAYOUT).agg(F.sum("n_rows").alias("n_rows"), F.sum("n_bytes").alias("n_bytes"))

    def cells(self) -> DataFrame:
        """All rows with ``CELL``, in buckets of it, for joins that move no row; of a catalog written with buckets."""
        n_buckets = self.properties["n_buckets"]
        if not n_buckets:
            raise ValueError(f"the catalog at {self.root} was written without buckets")
        name = f"skyweave_{self.properties['version']}"
        if not self.spark.catalog.tableExists(name):
            schema = T.StructType.fromJson(json.loads(self.properties["row_schema"]))
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(_LAYOUT)})"
                f" CLUSTERED BY ({CELL}) INTO {n_buckets} BUCKETS LOCATION '{self.data_path}'"
            )
            self.spark.sql(f"MSCK REPAIR TABLE {name}")
        list_by_cores(self.spark)
        return self.spark.read.table(name)

    def rows(self, columns: Sequence[str] | str | None = None) -> DataFrame:
        """Default columns, all columns (``"all"``), or the listed ones (``nested.field`` too)."""
        data = self.all_rows()
        if columns == "all":
            return data
        if columns is None:
            default = self.properties["default_columns"]
            if not default:
                return data
            columns = default.split(",")
        return select_columns(data, columns)

    def map_batches(self, function, schema: T.StructType | str, columns=None) -> DataFrame:
        """Apply a function to pandas batches of the catalog's rows; rows stay in their tasks."""

        def apply(batches):
            for batch in batches:
                yield function(batch)

        return self.rows(columns).mapInPandas(apply, schema)

    def cone(self, ra: float, dec: float, radius_arcsec: float) -> DataFrame:
        """Rows in a cone; folders of far partitions are skipped, row groups pruned by position."""
        near = broadcast_checked(
            partitions_in_cone(self.partitions().select("Norder", "Npix"), ra, dec, radius_arcsec)
        )
        rows = cone_search(self.all_rows(), ra, dec, radius_arcsec, *self.position)
        return rows.join(near, ["Norder", "Npix"], "left_semi")


    def partition_statistics(self) -> DataFrame:
        """Statistics of each partition, one row each, as kept by ``write_statistics``."""
        return self.spark.read.parquet(f"{self.root}/statistics-{self.properties['version']}")

    def statistics(self, partitions: DataFrame | None = None) -> DataFrame:
        """``column_statistics`` of all or the given partitions (``Norder, Npix``), merged from what is kept."""
        kept = self.partition_statistics()
        if partitions is not None:
            kept = kept.join(broadcast_checked(partitions.select("Norder", "Npix")), ["Norder", "Npix"], "left_semi")
        return merged_statistics(kept, self.all_rows().schema)

    def cones(self, fields: Mapping[str, tuple[float, float]], radius_arcsec: float) -> DataFrame:
        """Rows of several named cones with the name as ``field``; see ``multi_cone``.

        The cones are covered by ranges of pixels: folders outside them are skipped, and row groups
        within folders are skipped by the pixel the files are sorted by.
        """
        ranges = coverage([(ra, dec, radius_arcsec) for ra, dec in fields.values()])
        near = broadcast_checked(partitions_in_coverage(self.partitions().select("Norder", "Npix"), ranges))
        rows = rows_in_coverage(self.all_rows(), ranges).join(near, ["Norder", "Npix"], "left_semi")
        return multi_cone(rows, fields, radius_arcsec, *self.position)


def dataset_exists(spark: SparkSession, path: str) -> bool:
    """Whether a parquet dataset can be read at a path."""
    try:
        spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def properties_of(spark: SparkSession, root: str) -> Row | None:
    """Properties of the version in force, or None where there is no catalog."""
    try:
        log = spark.read.schema(_PROPERTIES_SCHEMA).json(f"{root}/properties")
        return log.orderBy(F.desc("number"), "version").limit(1).first()
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def open_catalog(spark: SparkSession, root: str) -> Catalog:
    properties = properties_of(spark, root)
    if properties is None:
        raise FileNotFoundError(f"no catalog at {root}")
    return Catalog(spark, root, properties)


def read_remote(
    spark: SparkSession, path: str, endpoint: str | None = None, anonymous: bool = False
) -> DataFrame:
    """Parquet of an outside survey; an object-store endpoint can be read without credentials.

    Spark lists no folders over https, so such a path is an error; copy the survey or name its bucket.
    """
    if path.startswith(("http://", "https://")):
        raise ValueError(f"{path}: a survey is read from a folder or a bucket (s3://…), not over http")
    reader = spark.read
    if endpoint is not None:
        reader = reader.option("fs.s3a.endpoint", endpoint)
        if anonymous:
            provider = "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider"
            reader = reader.option("fs.s3a.aws.credentials.provider", provider)
        path = path.replace("s3://", "s3a://", 1)
    return reader.parquet(path)


# ---------------------------------------------------------------------------------------------
# writing


def with_positions(df: DataFrame, ra: str, dec: str) -> DataFrame:
    """Add the finest-order pixel; a row without a position fails the job that meets it."""
    placed = with_pixel(df, ra, dec)
    message = F.lit(f"a row has no position in {ra}, {dec}")
    checked = F.when(F.col(PIXEL).isNotNull(), F.col(PIXEL)).otherwise(F.raise_error(message).cast("long"))
    return placed.withColumn(PIXEL, checked)


def plan_partitions(df: DataFrame, threshold: int, highest_order: int) -> DataFrame:
    """Fixed partitions of rows that carry a finest-order pixel."""
    histogram = materialize(pixel_histogram(df.select(PIXEL), highest_order))
    return materialize(partition_map(histogram, highest_order, threshold))


# Small files that one task writes, and how many rows a file may hold to count as small: opening one
# takes longer than writing its rows, so tasks are dealt by files there and not by bytes. Nested rows are long.
FILES_PER_TASK = 256
SMALL_FILE_ROWS, SMALL_NESTED_ROWS = 2_048, 256


def _dealt(df: DataFrame, planned: DataFrame | None, max_records_per_file: int) -> DataFrame:
    """Rows shuffled by partition for a write, over tasks of like bytes or, where files are small, of as many files.

    The rebalance splits a partition that is far larger than the others over several tasks, so a
    crowded pixel is never written by one. Among small files, which it would leave to few tasks, such
    a partition is cut into pieces of as many rows as a task has on average; ``planned`` lists the
    partitions with ``n_rows``.
    """
    balanced = df.hint("rebalance", *_LAYOUT)
    if planned is None:
        return balanced
    totals = planned.agg(F.count(F.lit(1)).alias("parts"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n")).first()
    files = totals["parts"] + (totals["n"] // max_records_per_file if max_records_per_file else 0)
    nested = any(isinstance(f.dataType, (T.ArrayType, T.MapType)) for f in df.schema.fields)
    if files <= FILES_PER_TASK or totals["n"] > files * (SMALL_NESTED_ROWS if nested else SMALL_FILE_ROWS):
        return balanced
    n_tasks = -(-files // FILES_PER_TASK)
    most = -(-totals["n"] // n_tasks)
    crowded = planned.where(F.col("n_rows") > most).select("Norder", "Npix", F.ceil(F.col("n_rows") / most).alias("_pieces"))
    pieces = df.join(F.broadcast(crowded), ["Norder", "Npix"], "left").select(*df.columns, F.coalesce("_pieces", F.lit(1)).alias("_pieces"))
    numbered = pieces.withColumn("_piece", F.pmod(F.monotonically_increasing_id(), "_pieces")).drop("_pieces")
    return numbered.repartition(n_tasks, *_LAYOUT, "_piece").drop("_piece")


def _lay_out(
    df: DataFrame,
    path: str,
    max_records_per_file: int,
    options: dict[str, str],
    n_buckets: int = 0,
    name: str = "",
    planned: DataFrame | None = None,
) -> None:
    """Write rows by partition, clustered along the sky curve inside each file.

    A crowded pixel is never written by one task, nor are very many small files (``_dealt``). With
    ``n_buckets`` the files also go by bucket of the cell, under a table name of the session, which
    is what Spark writes buckets for.
    """
    dealt = _dealt(df, planned, max_records_per_file)
    options = {**PLAIN_LOCAL_FILES, **options}
    if n_buckets:
        rows = dealt
        list_by_cores(df.sparkSession)
        writer = rows.write.mode("errorifexists").format("parquet").options(**options).option("maxRecordsPerFile", max_records_per_file)
        writer.partitionBy(*_LAYOUT).bucketBy(n_buckets, CELL).sortBy(PIXEL).option("path", path).saveAsTable(name)
        return
    rows = dealt.sortWithinPartitions(*_LAYOUT, PIXEL)
    writer = rows.write.mode("errorifexists").options(**options)
    writer.option("maxRecordsPerFile", max_records_per_file).partitionBy(*_LAYOUT).parquet(path)


def _lay_out_counted(rows: DataFrame, path: str) -> None:
    """As ``_lay_out``, for rows whose number in each partition is not known: they are kept, counted and written.

    There may be as many small files as partitions, which bytes alone would leave to a few tasks.
    """
    rows = materialize(rows)
    planned = materialize(rows.groupBy(*_LAYOUT).agg(F.count(F.lit(1)).alias("n_rows")))
    _lay_out(rows, path, 0, {}, planned=planned)


def _measured_partitions(data: DataFrame) -> DataFrame:
    """Rows and bytes per partition as they are in the files; no column is read."""
    rows = data.select(
        *_LAYOUT, F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b")
    )
    files = rows.groupBy("Norder", "Dir", "Npix", "f").agg(
        F.count(F.lit(1)).alias("n_rows"), F.first("b").alias("b")
    )
    return files.groupBy("Norder", "Dir", "Npix").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("b").alias("n_bytes")
    )


def _stored_schema(schema: T.StructType) -> T.StructType:
    """Schema as it is read back: partition columns last, of fixed types, everything nullable."""
    types = {"Norder": T.IntegerType(), "Dir": T.LongType(), "Npix": T.LongType()}
    own = [T.StructField(f.name, f.dataType, True) for f in schema.fields if f.name not in types]
    return T.StructType(own + [T.StructField(name, kind, True) for name, kind in types.items()])


def record_version(
    spark: SparkSession,
    root: str,
    version: str,
    schema: T.StructType,
    *,
    name: str,
    catalog_type: str,
    ra: str,
    dec: str,
    highest_order: int,
    default_columns: Sequence[str] = (),
    margin_threshold: float | None = None,
    source_version: str | None = None,
    n_buckets: int = 0,
    cells_of: str | None = None,
    shared: DataFrame | None = None,
    batch: str | None = None,
    files: DataFrame | None = None,
) -> Catalog:
    """Count what was written, store the partition table and make the version the one in force.

    ``shared`` lists partitions that stay in folders of earlier versions (``placed_partitions``),
    ``batch`` and ``files`` (``path``) name what the version took in.
    """
    before = properties_of(spark, root)
    number = 1 if before is None else before["number"] + 1
    data_path = f"{root}/data-{version}"
    partitions_path = f"{root}/partitions-{version}"
    schema = _stored_schema(schema)
    data = read_folders(spark, schema, data_path)
    measured = _measured_partitions(data).withColumn("data_version", F.lit(version))
    if shared is not None:
        measured = measured.unionByName(shared)
    measured.write.mode("overwrite").parquet(partitions_path)
    stored = spark.read.schema(_PARTITIONS_SCHEMA).parquet(partitions_path)
    earlier = stored.where(F.col("data_version") != version).select("data_version").distinct().orderBy("data_version")
    data_versions = [*[r[0] for r in earlier.collect()], version]
    n_files = None
    if files is not None:
        files.select("path").write.mode("overwrite").parquet(f"{root}/files-{version}")
        n_files = spark.read.schema("path string").parquet(f"{root}/files-{version}").count()
    n_columns = len(full_column_names(data))
    totals = stored.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_rows"),
        F.count_distinct("Norder", "Npix").alias("n_partitions"),
        F.coalesce(F.floor(F.sum("n_bytes") / 1024), F.lit(0)).alias("est_size_kb"),
    )
    row = totals.select(
        F.lit(number).cast("long").alias("number"),
        F.lit(version).alias("version"),
        F.current_timestamp().alias("created"),
        F.lit(name).alias("catalog_name"),
        F.lit(catalog_type).alias("catalog_type"),
        F.lit(ra).alias("ra_column"),
        F.lit(dec).alias("dec_column"),
        "total_rows",
        "n_partitions",
        F.lit(n_columns).cast("long").alias("n_columns"),
        "est_size_kb",
        F.lit(highest_order).alias("highest_order"),
        F.lit(f"skyweave v{__version__}").alias("builder"),
        F.lit(",".join(default_columns)).alias("default_columns"),
        F.lit(margin_threshold).cast("double").alias("margin_threshold"),
        F.lit(source_version).cast("string").alias("source_version"),
        F.lit(schema.json()).alias("row_schema"),
        F.lit(n_buckets).alias("n_buckets"),
        F.lit(cells_of).cast("string").alias("cells_of"),
        F.lit(",".join(data_versions)).alias("data_versions"),
        F.lit(batch).cast("string").alias("batch"),
        F.lit(n_files).cast("long").alias("n_files"),
    )
    row.coalesce(1).write.mode("append").json(f"{root}/properties")
    catalog = open_catalog(spark, root)
    if catalog.properties["number"] == number and catalog.properties["version"] != version:
        raise RuntimeError(f"another writer made version {number} of {root} at the same time")
    if catalog.properties["version"] == version:
        catalog._listed[version] = data
    return catalog


def write_catalog(
    df: DataFrame,
    root: str,
    *,
    name: str,
    catalog_type: str,
    ra: str,
    dec: str,
    threshold: int,
    highest_order: int = DEFAULT_HIGHEST_ORDER,
    positions: DataFrame | None = None,
    default_columns: Sequence[str] = (),
    resume: bool = False,
    overwrite: bool = False,
    max_records_per_file: int = 0,
    write_options: dict[str, str] | None = None,
    n_buckets: int = 0,
    align_to: Catalog | None = None,
    batch: str | None = None,
    files: DataFrame | None = None,
) -> Catalog:
    """Partition a table adaptively on the sky and write it.

    The rows are counted per pixel first. Where ``df`` is costly to compute, ``positions`` can
    be a cheaper frame with the same positions, such as the objects of a nested table. With
    ``resume`` a valid catalog is returned as it is; without ``overwrite`` an existing one is
    refused. Requested default columns that do not exist are left out.

    With ``n_buckets`` rows carry their cell, the partition they lie in, and are stored in buckets of
    it; ``align_to`` names another catalog of as many buckets, whose partitions are the cells then.
    """
    if align_to is not None:
        if n_buckets not in (0, align_to.properties["n_buckets"]) or not align_to.properties["n_buckets"]:
            raise ValueError(f"{align_to.root} has {align_to.properties['n_buckets']} buckets")
        n_buckets = align_to.properties["n_buckets"]
    spark = df.sparkSession
    existing = properties_of(spark, root)
    if existing is not None and resume and is_valid_catalog(spark, root):
        return open_catalog(spark, root)
    if existing is not None and not overwrite and not resume:
        raise FileExistsError(f"a catalog exists at {root}")
    df = df.drop(*LAYOUT_COLUMNS, CELL)
    counted = (df if positions is None else positions).select(ra, dec)
    partitions = plan_partitions(with_positions(counted, ra, dec), threshold, highest_order)
    rows = assign_partitions(with_positions(df, ra, dec), partitions)
    version = uuid.uuid4().hex
    cells_of = None
    if n_buckets:
        cells_of = version if align_to is None else align_to.properties["version"]
        rows = rows.withColumn(CELL, cell_number("Norder", "Npix")) if align_to is None else with_cell_of(rows, align_to.partitions())
    _lay_out(rows, f"{root}/data-{version}", max_records_per_file, write_options or {}, n_buckets, f"skyweave_{version}", partitions)
    chosen, _ = available_columns(df, default_columns)
    return record_version(
        spark,
        root,
        version,
        rows.schema,
        name=name,
        catalog_type=catalog_type,
        ra=ra,
        dec=dec,
        highest_order=highest_order,
        default_columns=chosen,
        n_buckets=n_buckets,
        cells_of=cells_of,
        batch=batch,
        files=files,
    )


def write_statistics(catalog: Catalog, before: Catalog | None = None, changed: DataFrame | None = None) -> DataFrame:
    """Keep minimum, maximum, sum, nulls and rows of every column and partition beside a version.

    They are mergeable, so those of any set of partitions follow without reading a data row. With the
    version ``before`` and the partitions that ``changed`` since (``Norder, Npix``), only these are read.
    """
    rows = catalog.all_rows()
    if changed is not None:
        listed = broadcast_checked(changed.select("Norder", "Npix").distinct().where(F.col("Npix") >= 0))
        rows = rows.join(listed, ["Norder", "Npix"], "left_semi")
    kept = partition_statistics(rows)
    if changed is not None:
        same = before.partition_statistics().join(listed, ["Norder", "Npix"], "left_anti")
        kept = same.unionByName(kept, allowMissingColumns=True)
    kept.write.mode("overwrite").parquet(f"{catalog.root}/statistics-{catalog.properties['version']}")
    return catalog.partition_statistics()


def _write_in_place(rows: DataFrame, writer_options: dict[str, str], path: str) -> None:
    """Write rows that were read from a catalog to the same partitions, without a shuffle.

    A task's rows come from few partitions, in order, and go to as few folders again.
    """
    writer = rows.sortWithinPartitions(*_LAYOUT, PIXEL).write.options(**{**PLAIN_LOCAL_FILES, **writer_options})
    writer.mode("overwrite").partitionBy(*_LAYOUT).parquet(path)


def rewrite_catalog(catalog: Catalog, transform) -> Catalog:
    """Apply a row-wise transform to a catalog and put the result in its place.

    The transform keeps the layout columns, so partitions stay as they are. The result is a new
    version; the old files are not touched while they are read.
    """
    version = uuid.uuid4().hex
    rows = transform(catalog.all_rows())
    _write_in_place(rows, {}, f"{catalog.root}/data-{version}")
    properties = catalog.properties
    ra, dec = catalog.position
    return record_version(
        catalog.spark,
        catalog.root,
        version,
        rows.schema,
        name=properties["catalog_name"],
        catalog_type=properties["catalog_type"],
        ra=ra,
        dec=dec,
        highest_order=properties["highest_order"],
        default_columns=[c for c in (properties["default_columns"] or "").split(",") if c],
    )


def _next_version(catalog: Catalog, rows: DataFrame, shared: DataFrame, planned: DataFrame | None = None, **taken) -> Catalog:
    """Record a version of laid-out ``rows`` beside partitions that stay where they are."""
    version = uuid.uuid4().hex
    stored = rows.select(*catalog.all_rows().columns)
    _lay_out(stored, f"{catalog.root}/data-{version}", 0, {}, planned=planned)
    properties = catalog.properties
    ra, dec = catalog.position
    return record_version(
        catalog.spark,
        catalog.root,
        version,
        stored.schema,
        name=properties["catalog_name"],
        catalog_type=properties["catalog_type"],
        ra=ra,
        dec=dec,
        highest_order=properties["highest_order"],
        default_columns=[c for c in (properties["default_columns"] or "").split(",") if c],
        shared=shared,
        **taken,
    )


def replace_partitions(catalog: Catalog, rows: DataFrame, changed: DataFrame) -> Catalog:
    """The next version, with ``rows`` in place of the partitions ``changed`` (``Norder, Npix``).

    Rows carry the layout columns. All other partitions are shared with the version before: their
    folders are neither read nor written. ``rewrite_catalog`` brings everything into one folder again.
    """
    gone = broadcast_checked(changed.select("Norder", "Npix").distinct())
    replaced = materialize(catalog.partitions().join(gone, ["Norder", "Npix"], "left_semi"))
    return _next_version(catalog, rows, catalog.placed_partitions().join(gone, ["Norder", "Npix"], "left_anti"), planned=replaced)


def was_taken(spark: SparkSession, root: str, batch: str) -> bool:
    """Whether a version of the catalog took in a batch of this name."""
    log = spark.read.schema(_PROPERTIES_SCHEMA).json(f"{root}/properties")
    return not log.where(F.col("batch") == batch).isEmpty()


def finished_files(spark: SparkSession, root: str) -> DataFrame:
    """``path`` of all files that versions of the catalog took in; none where there is no catalog."""
    if properties_of(spark, root) is None:
        return spark.createDataFrame([], "path string")
    log = spark.read.schema(_PROPERTIES_SCHEMA).json(f"{root}/properties").where(F.col("n_files").isNotNull())
    folders = [f"{root}/files-{row['version']}" for row in log.select("version").collect()]
    return spark.read.schema("path string").parquet(*folders) if folders else spark.createDataFrame([], "path string")


def append_rows(
    catalog: Catalog, rows: DataFrame, threshold: int, batch: str | None = None, files: DataFrame | None = None
) -> Catalog:
    """The next version, with further rows added; only these and the partitions they overfill are written.

    Rows in a partition with room become further files of it. A partition that would hold more than
    ``threshold`` rows is read and split, down to the catalog's finest order; rows outside all
    partitions get new ones, as coarse as the threshold and the other partitions allow. Columns that
    the catalog lacks are left out, those that rows lack are null. A ``batch`` that was taken in
    before changes nothing, so a step that is run again after a failure adds its rows once.
    """
    spark, order = catalog.spark, catalog.properties["highest_order"]
    if batch is not None and was_taken(spark, catalog.root, batch):
        return catalog
    if catalog.properties["n_buckets"]:
        raise ValueError(f"the catalog at {catalog.root} is stored in buckets of another layout")
    schema = catalog.all_rows().schema
    own = [f for f in schema.fields if f.name not in (*_LAYOUT, PIXEL)]
    given = [F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None) for f in own]
    rows = rows.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(given, own)])
    ra, dec = catalog.position
    counted = with_positions(rows.select(ra, dec), ra, dec).select(PIXEL)

    before = materialize(catalog.partitions().select("Norder", "Npix", "n_rows"))
    inside = assign_partitions(counted, before, outside="drop").groupBy("Norder", "Npix").agg(F.count(F.lit(1)).alias("added"))
    full = inside.join(before, ["Norder", "Npix"]).where((F.col("n_rows") + F.col("added") > threshold) & (F.col("Norder") < order))
    full = materialize(full.select("Norder", "Npix"))
    kept = materialize(before.join(broadcast_checked(full), ["Norder", "Npix"], "left_anti").select("Norder", "Npix"))
    opened = catalog.all_rows().join(broadcast_checked(full.where(F.col("Npix") >= 0)), ["Norder", "Npix"], "left_semi")

    # Partitions that stay weigh more than a partition may, so no new one can hold any of them.
    first = F.expr(f"shiftleft(Npix, 2 * ({order} - Norder))").alias("pixel")
    stays = kept.select(first, F.lit(threshold + 1).cast("long").alias("n_rows"))
    loose = pixel_histogram(counted.unionByName(opened.select(PIXEL)), order).select(F.col("pixel").alias("_at"), "n_rows")
    covered = assign_partitions(
        loose.withColumn(PIXEL, F.expr(f"shiftleft(_at, 2 * ({FINEST_ORDER} - {order}))")), kept, outside="drop"
    )
    loose = loose.join(covered.select("_at"), "_at", "left_anti").select(F.col("_at").alias("pixel"), "n_rows")
    planned = partition_map(materialize(loose.unionByName(stays)), order, threshold)
    blocked = stays.select(F.lit(order).alias("Norder"), F.col("pixel").alias("Npix"))
    new = planned.join(blocked, ["Norder", "Npix"], "left_anti").select("Norder", "Npix")
    partitions = materialize(new.unionByName(kept))

    moved = opened.select(*[f.name for f in own]).unionByName(rows)
    laid_out = assign_partitions(with_positions(moved, ra, dec), partitions)
    gone = broadcast_checked(full)
    shared = catalog.placed_partitions().join(gone, ["Norder", "Npix"], "left_anti")
    return _next_version(catalog, laid_out, shared, batch=batch, files=files)


def write_in_same_partitions(rows: DataFrame, like: Catalog, root: str) -> Catalog:
    """A new catalog of rows that carry the layout columns of an existing one."""
    version = uuid.uuid4().hex
    _lay_out(rows, f"{root}/data-{version}", 0, {}, planned=like.partitions())
    properties = like.properties
    ra, dec = like.position
    return record_version(
        like.spark,
        root,
        version,
        rows.schema,
        name=properties["catalog_name"],
        catalog_type=properties["catalog_type"],
        ra=ra,
        dec=dec,
        highest_order=properties["highest_order"],
    )


def repartition_catalog(
    catalog: Catalog,
    root: str,
    *,
    threshold: int,
    highest_order: int,
    default_columns: Sequence[str] = (),
    **kwargs,
) -> Catalog:
    """Write a catalog anew with another threshold, finest order and default columns."""
    ra, dec = catalog.position
    return write_catalog(
        catalog.all_rows(),
        root,
        name=catalog.properties["catalog_name"],
        catalog_type=catalog.properties["catalog_type"],
        ra=ra,
        dec=dec,
        threshold=threshold,
        highest_order=highest_order,
        default_columns=default_columns,
        **kwargs,
    )


def process_partitions(
    catalog: Catalog, output: str, transform, rules: str, partitions: DataFrame | None = None
) -> DataFrame:
    """Transform the partitions that ``output`` lacks, and leave the finished ones alone.

    ``rules`` names what the transform does. A log beside the output holds, for each partition, the
    rules it was last written by and the version it was read from; only partitions logged with both
    the same are skipped. ``partitions`` (``Norder, Npix``) restricts the run. Gives the tally
    ``status, n_partitions``.
    """
    spark, layout, log_path = catalog.spark, list(_LAYOUT), f"{output}-log"
    wanted = catalog.partitions().select(*layout)
    if partitions is not None:
        wanted = wanted.join(partitions, ["Norder", "Npix"], "left_semi")
    stamp = F.lit(f"{catalog.properties['version']} {rules}")
    if dataset_exists(spark, log_path):
        log = spark.read.parquet(log_path)
        last = log.groupBy(*layout).agg(F.max(F.struct("run", "stamp")).alias("last"))
        runs = log.agg(F.max("run")).first()[0] + 1
        finished = last.where(F.col("last.stamp") == stamp).select(*layout, F.lit(True).alias("finished"))
        wanted = wanted.join(finished, layout, "left")
    else:
        runs, wanted = 1, wanted.withColumn("finished", F.lit(None).cast("boolean"))
    marked = materialize(wanted.withColumn("finished", F.coalesce("finished", F.lit(False))))
    todo = marked.where(~F.col("finished")).select(*layout)
    # The comparison makes Spark prune the folders of finished partitions at run time.
    listed = broadcast_checked(todo.where(F.col("Npix") >= 0))
    rows = catalog.all_rows().join(listed, layout, "left_semi")
    _write_in_place(transform(rows), {"partitionOverwriteMode": "dynamic"}, output)
    todo.select(*layout, stamp.alias("stamp"), F.lit(runs).alias("run")).write.mode("append").parquet(log_path)
    status = F.when(F.col("finished"), "skipped").otherwise("processed").alias("status")
    return marked.groupBy(status).agg(F.count(F.lit(1)).alias("n_partitions"))


# ---------------------------------------------------------------------------------------------
# checks


def catalog_problems(spark: SparkSession, root: str) -> DataFrame:
    """Disagreements between a catalog's records and its files: ``problem, n``; empty if valid."""
    catalog = open_catalog(spark, root)
    recorded = catalog.partitions().select("Norder", "Npix", F.col("n_rows").alias("recorded"))
    rows = catalog.all_rows()
    misplaced = F.expr(f"shiftright({PIXEL}, 2 * ({FINEST_ORDER} - cast(Norder as int))) <> Npix")
    measured = rows.groupBy("Norder", "Npix").agg(
        F.count(F.lit(1)).alias("found"), F.count_if(F.coalesce(misplaced, F.lit(True))).alias("misplaced")
    )
    both = materialize(recorded.join(measured, ["Norder", "Npix"], "full"))
    total = F.lit(catalog.properties["total_rows"])
    summary = both.agg(
        F.count_if(F.col("found").isNull()).alias("partitions without files"),
        F.count_if(F.col("recorded").isNull()).alias("partitions not recorded"),
        F.count_if(F.col("found") != F.col("recorded")).alias("partitions with another row count"),
        F.coalesce(F.sum("misplaced"), F.lit(0)).alias("rows outside their pixel"),
        F.abs(F.coalesce(F.sum("found"), F.lit(0)) - total).alias("difference to the recorded total"),
    )
    long = summary.unpivot([], summary.columns, "problem", "n")
    return long.where(F.col("n") > 0)


def is_valid_catalog(spark: SparkSession, root: str, strict: bool = False) -> bool:
    """Whether records and files agree; ``strict`` also checks every row's pixel."""
    properties = properties_of(spark, root)
    if properties is None:
        return False
    if strict:
        return catalog_problems(spark, root).isEmpty()
    try:
        catalog = Catalog(spark, root, properties)
        recorded = catalog.partitions().select(*_LAYOUT, "n_rows")
        found = catalog.measured_partitions().select(*_LAYOUT, F.col("n_rows").alias("found"))
        both = recorded.join(found, list(_LAYOUT), "full").agg(
            F.count_if(~F.col("n_rows").eqNullSafe(F.col("found"))).alias("wrong"),
            F.coalesce(F.sum("found"), F.lit(0)).alias("total"),
        ).first()
        return both["wrong"] == 0 and both["total"] == properties["total_rows"]
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def is_reusable_margin(catalog: Catalog, root: str, threshold_arcsec: float) -> bool:
    """Whether a valid margin table of this version of the catalog, with the same threshold, is there."""
    if not is_valid_catalog(catalog.spark, root):
        return False
    margin = properties_of(catalog.spark, root)
    same_source = margin["source_version"] == catalog.properties["version"]
    return same_source and margin["margin_threshold"] == threshold_arcsec


# ---------------------------------------------------------------------------------------------
# margin, index, collection


def write_margin(
    catalog: Catalog, root: str, threshold_arcsec: float, resume: bool = False
) -> Catalog:
    """Margin table of a catalog: rows just outside each partition, stored under that partition.

    The pixel column keeps the row's own pixel, which lies outside its folder here.
    """
    spark = catalog.spark
    if resume and is_reusable_margin(catalog, root, threshold_arcsec):
        return open_catalog(spark, root)
    # Only orders in use matter: every partition is a union of pixels of the finest one.
    order = catalog.partitions().agg(F.max("Norder")).first()[0] or 0
    rows = margin_rows(catalog.all_rows().drop(CELL), catalog.partitions(), threshold_arcsec, *catalog.position)
    version = uuid.uuid4().hex
    path = f"{root}/data-{version}"
    _lay_out_counted(rows, path)
    properties = catalog.properties
    return record_version(
        spark,
        root,
        version,
        rows.schema,
        name=f"{properties['catalog_name']}_margin",
        catalog_type="margin",
        ra=properties["ra_column"],
        dec=properties["dec_column"],
        highest_order=order,
        margin_threshold=threshold_arcsec,
        source_version=properties["version"],
    )


# Index rows in one folder.
INDEX_ROWS = 1 << 22


def write_index(catalog: Catalog, path: str, id_column: str, rows_per_folder: int = INDEX_ROWS) -> DataFrame:
    """Table of ids and their places, in folders by id hash, sorted by id, with Bloom filters of the ids."""
    n = max(1, -(-catalog.properties["total_rows"] // rows_per_folder))
    rows = catalog.all_rows().select(id_column, PIXEL, "Norder", "Dir", "Npix")
    placed = rows.withColumns({HASHES: F.lit(n), HASH: id_hash(id_column, n)})
    # The rebalance splits the folder of an id that fills many rows over several tasks.
    placed = placed.hint("rebalance", HASHES, HASH).sortWithinPartitions(HASHES, HASH, id_column, PIXEL)
    writer = placed.write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{id_column}", "true")
    writer.option(f"parquet.bloom.filter.expected.ndv#{id_column}", min(rows_per_folder, 1 << 20)).partitionBy(HASHES, HASH).parquet(path)
    return catalog.spark.read.schema(placed.schema).parquet(path)


@dataclass(frozen=True)
class Collection:
    """A catalog with its margin table and id index."""

    catalog: Catalog
    margin: Catalog
    index_path: str
    id_column: str

    def index(self) -> DataFrame:
        return self.catalog.spark.read.parquet(self.index_path)

    def rows_of(self, wanted: DataFrame) -> DataFrame:
        """Rows of the wanted ids, read from the partitions that hold them."""
        return lookup_ids(self.catalog.all_rows(), self.index(), wanted, self.id_column)


def build_collection(
    catalog: Catalog, root: str, *, margin_arcsec: float, id_column: str, resume: bool = False
) -> Collection:
    """Margin table and id index beside a catalog; both belong to its version."""
    margin = write_margin(catalog, f"{root}/margin", margin_arcsec, resume)
    index_path = f"{root}/index-{catalog.properties['version']}"
    if not (resume and dataset_exists(catalog.spark, index_path)):
        write_index(catalog, index_path, id_column)
    return Collection(catalog, margin, index_path, id_column)


def write_association(
    pairs: DataFrame, catalog: Catalog, index: DataFrame, root: str, id_column: str, name: str
) -> Catalog:
    """Matched id pairs with distances as a catalog of their own, in the partitions of the primary one.

    Its position columns are named like the primary's, which it can be joined with by id.
    """
    layout = list(_LAYOUT)
    placed = pairs.join(index.select(id_column, PIXEL, *layout).distinct(), id_column)
    version = uuid.uuid4().hex
    _lay_out_counted(placed, f"{root}/{name}/data-{version}")
    properties = catalog.properties
    return record_version(
        catalog.spark,
        f"{root}/{name}",
        version,
        placed.schema,
        name=name,
        catalog_type="association",
        ra=properties["ra_column"],
        dec=properties["dec_column"],
        highest_order=properties["highest_order"],
        source_version=properties["version"],
    )
