"""The jobs that turn raw files into a release: import, nest, collect, match, correct, report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweave.functions.nested import START, available_columns, full_column_names
from skyweave.operators.calibration import calibrate, is_processed
from skyweave.operators.correction import Model, correct_errors, detector_coordinates, visit_detector_features
from skyweave.operators.alignment import CELL
from skyweave.operators.keys import lookup_places
from skyweave.operators.nesting import MAX_ROWS_PER_PART, PART, merge_sources, nest_in_cells, nest_sources, object_parts
from skyweave.operators.numbering import number_rows
from skyweave.operators.partitioning import density_map, pixel_histogram
from skyweave.operators.spatial import crossmatch, multi_cone
from skyweave.operators.statistics import (
    FIELD_RADIUS_ARCSEC,
    SKY_FIELDS,
    band_statistics,
    column_statistics,
    combine_band_statistics,
    field_report,
    null_report,
    numeric_columns,
    range_checks,
    without_magnitudes,
)
from skyweave.plans.settings import (
    CatalogSettings,
    CollectionSettings,
    CorrectionSettings,
    NestingSettings,
    SurveySettings,
)
from skyweave.runtime import broadcast_checked, materialize
from skyweave.sources.catalog import (
    DEFAULT_HIGHEST_ORDER,
    Catalog,
    Collection,
    append_rows,
    build_collection,
    finished_files,
    is_valid_catalog,
    open_catalog,
    properties_of,
    read_remote,
    replace_partitions,
    rewrite_catalog,
    write_association,
    write_catalog,
    write_in_same_partitions,
)
from skyweave.sources.exports import write_feature_table
from skyweave.sources.files import indexed_scan, seeded_schema, write_index_files


def import_catalog(
    spark: SparkSession,
    index: DataFrame,
    root: str,
    name: str,
    settings: CatalogSettings,
    *,
    visits: DataFrame | None = None,
    resume: bool = False,
    index_path: str | None = None,
    **scan,
) -> Catalog:
    """Indexed files → calibrated rows → sky partitions, as one plan with two actions.

    The first action counts positions per pixel and reads only those; the second writes. With
    ``index_path`` the index is first written there, a folder for each key group. Where the settings
    say so, all files are read with the schema of the first one and the keys it lacks.
    """
    index = materialize(index)
    if index_path is not None:
        write_index_files(index, settings.dims, settings.group_by, index_path)
    if settings.seed_schema and "schema" not in scan:
        first = index.orderBy("path").limit(1).first()
        seeded = seeded_schema(spark.read.parquet(first["path"]).schema, index.schema, settings.dims)
        scan = {**scan, "schema": seeded}
    raw = indexed_scan(spark, index, dims=settings.dims, **scan)
    times = visits if settings.add_time else None
    rows = calibrate(raw, settings.flux_prefixes, times)
    return write_catalog(
        rows,
        root,
        name=name,
        catalog_type=settings.catalog_type,
        ra=settings.ra,
        dec=settings.dec,
        threshold=settings.threshold,
        positions=raw,
        resume=resume,
    )


def take_in(
    spark: SparkSession,
    raw: DataFrame,
    files: DataFrame,
    root: str,
    name: str,
    settings: CatalogSettings,
    *,
    visits: DataFrame | None = None,
    highest_order: int = DEFAULT_HIGHEST_ORDER,
) -> Catalog:
    """The raw rows of some files, calibrated and added to a catalog; the files (``path``) are recorded with its version.

    The first call makes the catalog, later ones append. Rows and record become visible together.
    """
    rows = calibrate(raw, settings.flux_prefixes, visits if settings.add_time else None)
    if properties_of(spark, root) is not None:
        return append_rows(open_catalog(spark, root), rows, settings.threshold, files=files)
    return write_catalog(
        rows, root, name=name, catalog_type=settings.catalog_type, ra=settings.ra, dec=settings.dec,
        threshold=settings.threshold, highest_order=highest_order, positions=raw, files=files,
    )


def import_new_files(
    spark: SparkSession,
    index: DataFrame,
    root: str,
    name: str,
    settings: CatalogSettings,
    *,
    visits: DataFrame | None = None,
    files_per_step: int = 10_000,
    highest_order: int = DEFAULT_HIGHEST_ORDER,
    schema: T.StructType | None = None,
) -> list[str]:
    """Import the indexed files that no version of the catalog has taken in yet, in steps; gives their versions.

    Each step reads its own files only, appends their rows and records them with the version, in one
    move: an import that was interrupted goes on with the files of the step that failed. A file counts by
    its path; one that changed under the same path is not read again. Files in the index twice with
    different keys give their rows for each, like ``indexed_scan``.
    """
    finished = finished_files(spark, root)
    todo = materialize(index.join(finished.select("path").distinct(), "path", "left_anti"))
    numbered = number_rows(todo.select("path").where(F.col("path").isNotNull()).distinct(), ["path"])
    numbered = materialize(numbered.select("path", F.floor(F.col("_row") / files_per_step).alias("_step")))
    n_steps = numbered.agg(F.coalesce(F.max("_step") + 1, F.lit(0))).first()[0]
    versions = []
    for step in range(n_steps):
        files = numbered.where(F.col("_step") == step).select("path")
        raw = indexed_scan(spark, todo.join(broadcast_checked(files), "path", "left_semi"), dims=settings.dims, schema=schema)
        catalog = take_in(spark, raw, files, root, name, settings, visits=visits, highest_order=highest_order)
        versions.append(catalog.properties["version"])
    return versions


def calibrate_catalog(catalog: Catalog, settings: CatalogSettings, visits: DataFrame | None = None) -> Catalog:
    """The catalog with the magnitudes and times that the settings ask for; the same version where it has them all.

    Partitions of one version share their schema, so the schema tells whether anything is to do.
    """
    columns = catalog.all_rows().columns
    wanted = bool(settings.flux_prefixes) or settings.add_time
    if not wanted or is_processed(columns, settings.flux_prefixes, settings.add_time):
        return catalog
    return rewrite_catalog(catalog, lambda rows: calibrate(rows, settings.flux_prefixes, visits if settings.add_time else None))


def build_features(visit_detectors: DataFrame, detectors: DataFrame, path: str) -> DataFrame:
    """The feature table of the correction, written sorted by visit and detector, and read again."""
    write_feature_table(visit_detector_features(visit_detectors, detector_coordinates(detectors)), path)
    return visit_detectors.sparkSession.read.parquet(path)


def add_sources(
    catalog: Catalog,
    late: Mapping[str, DataFrame],
    settings: NestingSettings,
    *,
    index: DataFrame | None = None,
    tie_break: Sequence[str] = (),
    max_rows: int = MAX_ROWS_PER_PART,
) -> Catalog:
    """The next version of a nested catalog, with late sources merged into their light curves.

    ``late`` holds late rows by nested column. Only partitions with an object of theirs are read and
    written, all others are shared with the version before. Those partitions are found in the id
    ``index`` of this version, or else by a scan of the ids. Late rows of unknown objects are left out.
    """
    on, layout = settings.join_id, ["Norder", "Dir", "Npix"]
    ids = [rows.select(F.col(on)).dropna().distinct() for rows in late.values()]
    wanted = ids[0]
    for more in ids[1:]:
        wanted = wanted.unionByName(more)
    wanted = materialize(wanted.distinct())
    if index is None:
        places = catalog.all_rows().select(on, *layout).join(broadcast_checked(wanted), on, "left_semi")
    else:
        places = lookup_places(index, wanted, on)
    changed = materialize(places.select(*layout).distinct())
    # The comparison makes Spark prune the folders of other partitions at run time.
    rows = catalog.all_rows().join(broadcast_checked(changed.where(F.col("Npix") >= 0)), layout, "left_semi")
    merged = merge_sources(
        rows, late, on=on, into=settings.nested_columns, sort_by=settings.sort_by, tie_break=tie_break, max_rows=max_rows
    )
    result = replace_partitions(catalog, merged, changed)
    if settings.density_orders:
        catalog.spark.read.parquet(catalog.density_path).write.mode("overwrite").parquet(result.density_path)
    return result


def nest_catalog(
    objects: Catalog,
    sources: Sequence[Catalog],
    root: str,
    name: str,
    settings: NestingSettings,
    *,
    tie_break: Sequence[str] = (),
    max_rows: int = MAX_ROWS_PER_PART,
    resume: bool = False,
) -> Catalog:
    """Light-curve catalog: objects with their sources as time-sorted nested columns.

    Sources in catalogs aligned to the objects' partitions are nested cell by cell and not shuffled; all
    others by id. Neither needs margins, and rows are written once, straight to their partitions. The
    partitions are planned from the objects, each as often as it has nested rows. Where the settings
    name density orders, a density map of each is written beside the data.
    """
    layout = ["_healpix_29", "Norder", "Dir", "Npix"]
    own = objects.all_rows().drop(*layout, CELL)
    tables = [s.all_rows().drop(*layout, CELL) for s in sources]
    aligned = objects.properties["n_buckets"] and all(
        s.properties["cells_of"] == objects.properties["version"] for s in sources
    )
    join, left, right = nest_sources, own, tables
    if aligned:
        join, left, right = nest_in_cells, objects.cells().drop(*layout), [s.cells().drop(*layout) for s in sources]
    nested = join(
        left,
        right,
        on=settings.join_id,
        into=settings.nested_columns,
        sort_by=settings.sort_by,
        tie_break=tie_break,
        max_rows=max_rows,
    )
    ra, dec = objects.position
    default = [*settings.default_columns, PART, START] if settings.default_columns else []
    catalog = write_catalog(
        nested,
        root,
        name=name,
        catalog_type="object",
        ra=ra,
        dec=dec,
        threshold=settings.threshold,
        highest_order=settings.highest_order,
        positions=object_parts(own.select(settings.join_id, ra, dec), tables, settings.join_id, max_rows),
        default_columns=available_columns(nested, default)[0],
        resume=resume,
    )
    if settings.density_orders:
        catalog_density(catalog, settings.density_orders).write.mode("overwrite").parquet(catalog.density_path)
    return catalog


def catalog_density(catalog: Catalog, orders: Sequence[int]) -> DataFrame:
    """Rows per pixel at several orders; of an object with several rows the first counts."""
    finest = max(orders)
    return density_map(pixel_histogram(first_rows(catalog.all_rows()), finest), finest, orders)


def first_rows(df: DataFrame) -> DataFrame:
    """One row for each object, where light curves go on over several."""
    return df.where(F.col(PART) == 0) if PART in df.columns else df


def collect(catalog: Catalog, root: str, settings: CollectionSettings, resume: bool = False) -> Collection:
    return build_collection(
        catalog, root, margin_arcsec=settings.margin_arcsec, id_column=settings.index_column, resume=resume
    )


def match_surveys(
    collections: Mapping[str, Collection],
    surveys: Mapping[str, SurveySettings],
    root: str,
    resume: bool = False,
) -> dict[str, str]:
    """Association catalog of every collection with every survey; returns their folders by name.

    With ``resume``, valid ones made from this version of the collection's catalog are left alone.
    """
    written = {}
    for survey_name, survey in surveys.items():
        for collection in collections.values():
            catalog, id_column = collection.catalog, collection.id_column
            name = f"{catalog.properties['catalog_name']}_x_{survey_name}"
            written[name] = f"{root}/{name}"
            if resume and is_valid_catalog(catalog.spark, written[name]):
                made_from = open_catalog(catalog.spark, written[name]).properties["source_version"]
                if made_from == catalog.properties["version"]:
                    continue
            outside = read_remote(catalog.spark, survey.path, survey.endpoint, survey.anonymous)
            rows = first_rows(catalog.all_rows())
            pairs = crossmatch(
                rows,
                outside,
                left_id=id_column,
                right_id=survey.join_id,
                radius_arcsec=survey.radius_arcsec,
                n_neighbors=survey.n_neighbors,
                suffix=survey.suffix,
                left_position=catalog.position,
                right_position=(survey.ra, survey.dec),
            )
            write_association(pairs, catalog, collection.index(), root, id_column, name)
    return written


def correct_collection(
    catalog: Catalog,
    root: str,
    settings: CorrectionSettings,
    models: Mapping[str, Model],
    features: DataFrame,
    id_column: str,
) -> Catalog:
    """The catalog with corrected errors, under its own name, in the same partitions."""
    rows = catalog.all_rows()
    keys = [id_column, PART] if PART in rows.columns else [id_column]
    corrected = correct_errors(
        rows,
        settings.columns,
        dict(models),
        features,
        keys=keys,
        per_band_extendedness=settings.per_band_extendedness,
    )
    return write_in_same_partitions(corrected, catalog, root)


def catalog_report(catalog: Catalog) -> DataFrame:
    """One row: ``catalog_name, valid, n_partitions, n_rows, n_columns``, measured, not as recorded."""
    rows = catalog.all_rows()
    measured = rows.groupBy("Norder", "Npix").agg(F.count(F.lit(1)).alias("n"))
    return measured.agg(
        F.lit(catalog.properties["catalog_name"]).alias("catalog_name"),
        F.lit(is_valid_catalog(catalog.spark, catalog.root)).alias("valid"),
        F.count(F.lit(1)).alias("n_partitions"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.lit(len(full_column_names(rows))).cast("long").alias("n_columns"),
    )


def verify_columns(
    df: DataFrame, rules: Mapping[str, Sequence[str]]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Statistics, range checks and null report of a catalog; magnitudes are left out."""
    statistics = without_magnitudes(column_statistics(df))
    return statistics, range_checks(statistics, rules), null_report(statistics)


def field_statistics(
    df: DataFrame,
    fields: Mapping[str, tuple[float, float]] = SKY_FIELDS,
    radius_arcsec: float = FIELD_RADIUS_ARCSEC,
    columns: Sequence[str] | None = None,
    position: tuple[str, str] = ("ra", "dec"),
    exact: bool = True,
) -> DataFrame:
    """Per-field per-band statistics; one scan serves all fields.

    ``exact=False`` combines per-partition means weighted by row counts, which differs from the
    mean where values are missing; it needs the layout columns.
    """
    columns = list(columns) if columns is not None else numeric_columns(df)
    rows = multi_cone(df, fields, radius_arcsec, *position)
    if exact:
        return band_statistics(rows, columns, by=["field"])
    parts = band_statistics(rows, columns, by=["field", "Norder", "Npix"])
    return combine_band_statistics(parts, columns, by=["field"])


def field_statistics_report(
    df: DataFrame, columns: Sequence[str], fields: Mapping[str, tuple[float, float]] = SKY_FIELDS, **kwargs
) -> DataFrame:
    return field_report(field_statistics(df, fields, columns=columns, **kwargs), columns, list(fields))
