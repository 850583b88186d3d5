"""Catalogs written, opened, rewritten, checked, indexed and described."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.functions.nested import flatten, full_column_names
from skyweave.operators.calibration import calibrate
from skyweave.operators.statistics import SKY_FIELDS, size_histogram
from skyweave.operators.nesting import nest_sources, object_parts
from skyweave.plans.release import add_sources, calibrate_catalog, catalog_report, collect, correct_collection, match_surveys, nest_catalog
from skyweave.plans.settings import (
    CatalogSettings,
    CollectionSettings,
    CorrectionSettings,
    NestingSettings,
    SurveySettings,
    corrected_columns,
)
from skyweave.functions.labels import gibibytes, readable_size
from skyweave.queries import fixtures as data
from skyweave.queries import sql
from skyweave.queries.correction import demo_models, features
from skyweave.queries.registry import query
from skyweave.queries.sky import _match_sql, margin_sql
from skyweave.runtime import scratch_path
from skyweave.sources.catalog import (
    Catalog,
    Collection,
    append_rows,
    build_collection,
    catalog_problems,
    is_reusable_margin,
    is_valid_catalog,
    open_catalog,
    process_partitions,
    repartition_catalog,
    rewrite_catalog,
    write_catalog,
    write_margin,
    write_statistics,
)
from skyweave.sources.exports import collection_summary, write_summaries

_ORDER, _ROWS = 7, 5_000


def object_catalog(spark: SparkSession, sf_dir: str, threshold: int = _ROWS) -> Catalog:
    return write_catalog(
        data.objects(spark, sf_dir, crowded=True),
        scratch_path(spark, "object"),
        name="object",
        catalog_type="object",
        ra="ra",
        dec="dec",
        threshold=threshold,
        highest_order=_ORDER,
    )


def source_catalog(spark: SparkSession, sf_dir: str, name: str = "forced") -> Catalog:
    ra, dec = data.crowded_position(F.col("objectId"))
    sources = data.forced_sources(spark, sf_dir).drop("midpointMjdTai")
    return write_catalog(
        sources.withColumns({"coord_ra": ra, "coord_dec": dec}),
        scratch_path(spark, name),
        name=name,
        catalog_type="source",
        ra="coord_ra",
        dec="coord_dec",
        threshold=20_000,
        highest_order=_ORDER,
    )


_NESTING = NestingSettings(
    object_catalog="object",
    join_id="objectId",
    source_catalogs=("forced",),
    nested_columns=("objectForcedSource",),
    threshold=3_000,
    highest_order=8,
    default_columns=("objectId", "ra", "dec", "objectForcedSource.psfFlux", "objectForcedSource.midpointMjdTai"),
)
_CALIBRATION = CatalogSettings(
    dims=(), group_by=(), ra="coord_ra", dec="coord_dec", catalog_type="source", threshold=20_000,
    flux_prefixes=("psf",), add_time=True,
)
_COLLECTION = CollectionSettings("object_lc", "objectId", margin_arcsec=60.0)


def light_curve_catalog(spark: SparkSession, sf_dir: str, max_rows: int = 4) -> Catalog:
    sources = source_catalog(spark, sf_dir)
    timed = calibrate_catalog(sources, _CALIBRATION, data.visits(spark, sf_dir))
    return nest_catalog(
        object_catalog(spark, sf_dir),
        [timed],
        scratch_path(spark, "object_lc"),
        "object_lc",
        _NESTING,
        tie_break=("sourceId", "visit", "detector", "quantity"),
        max_rows=max_rows,
    )


def object_collection(spark: SparkSession, sf_dir: str, margin_arcsec: float = 60.0) -> Collection:
    catalog = object_catalog(spark, sf_dir)
    settings = replace(_COLLECTION, margin_arcsec=margin_arcsec)
    return collect(catalog, scratch_path(spark, "object_collection"), settings)


@query(f"SELECT objectId, ra, dec, pixel AS _healpix_29 FROM ({sql.pixels(29, sql.CROWDED)})")
def catalog_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects written as a catalog and read back from the folders their pixels belong to."""
    catalog = object_catalog(spark, sf_dir)
    rows = open_catalog(spark, catalog.root).rows()
    inside = F.expr("shiftright(_healpix_29, 2 * (29 - cast(Norder as int))) = Npix")
    return rows.where(inside).select("objectId", "ra", "dec", "_healpix_29")


@query(f"""
SELECT 'all' AS catalog_name, count(*) AS total_rows, 4::BIGINT + 3 AS n_columns FROM ({sql.CROWDED})""")
def catalog_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals recorded with a catalog: rows counted from the files, columns with layout columns."""
    catalog = object_catalog(spark, sf_dir)
    n_columns = F.lit(catalog.properties["n_columns"]).cast("long").alias("n_columns")
    return catalog.partitions().agg(
        F.lit("all").alias("catalog_name"), F.sum("n_rows").alias("total_rows"), F.first(n_columns).alias("n_columns")
    )


@query(f"SELECT objectId, ra, dec, TRUE AS finer FROM ({sql.CROWDED})")
def repartitioned_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog written anew with smaller partitions, default columns and a finer order."""
    n_rows = data.table(spark, sf_dir, "orders").count()
    first = object_catalog(spark, sf_dir, threshold=n_rows)
    second = repartition_catalog(
        first,
        scratch_path(spark, "object_fine"),
        threshold=n_rows // 8,
        highest_order=9,
        default_columns=["objectId", "ra", "dec", "unknown"],
    )
    finer = second.properties["n_partitions"] > first.properties["n_partitions"]
    return second.rows().withColumn("finer", F.lit(finer))


_REWRITTEN = f"""
SELECT s.objectId, s.sourceId, s.visit, s.detector, s.psfFlux::FLOAT AS psfFlux, v.expMidptMJD AS midpointMjdTai,
       ({sql.magnitude('psfFlux')})::FLOAT AS psfMag
FROM ({sql.FORCED}) s LEFT JOIN ({sql.VISITS}) v ON s.visit = v.visitId"""


@query(_REWRITTEN)
def rewritten_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source catalog post-processed in place: same partitions, new version."""
    before = source_catalog(spark, sf_dir)
    after = rewrite_catalog(before, lambda df: calibrate(df, ["psf"], data.visits(spark, sf_dir)))
    assert after.properties["total_rows"] == before.properties["total_rows"]
    assert after.properties["n_partitions"] == before.properties["n_partitions"]
    return open_catalog(spark, after.root).all_rows().select(
        "objectId", "sourceId", "visit", "detector", "psfFlux", "midpointMjdTai",
        "psfMag",
    )


_EDGES = (2_000.0, 9_000.0, 30_000.0, 55_000.0, 90_000.0)


@query(f"""
SELECT objectId, sourceId, {' + '.join(f'(psfFlux >= {e})::BIGINT' for e in _EDGES)} AS bin FROM ({sql.FORCED})""")
def mapped_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A function applied to pandas batches of a catalog: fluxes sorted into uneven bins by bisection."""

    def binned(batch):
        import numpy as np

        return batch[["objectId", "sourceId"]].assign(bin=np.digitize(batch["psfFlux"].to_numpy(), _EDGES).astype("int64"))

    return source_catalog(spark, sf_dir).map_batches(binned, "objectId long, sourceId long, bin long")


@query(f"SELECT 'object' AS catalog_name, TRUE AS valid, count(*) AS n_rows, 7::BIGINT AS n_columns FROM ({sql.CROWDED})")
def catalog_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity and sizes of a catalog as they are in its files."""
    return catalog_report(object_catalog(spark, sf_dir)).select("catalog_name", "valid", "n_rows", "n_columns")


@query(f"SELECT count(*) AS n_rows, TRUE AS in_chunks FROM ({sql.CROWDED})")
def chunked_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog written in files of at most 40 rows."""
    catalog = write_catalog(
        data.objects(spark, sf_dir, crowded=True), scratch_path(spark, "chunked"), name="object", catalog_type="object",
        ra="ra", dec="dec", threshold=_ROWS, highest_order=_ORDER, max_records_per_file=40,
    )
    files = catalog.all_rows().groupBy(F.col("_metadata.file_path")).agg(F.count(F.lit(1)).alias("n"))
    return files.agg(F.sum("n").alias("n_rows"), (F.max("n") <= 40).alias("in_chunks"))


@query(f"""
WITH m AS ({_match_sql(0.2, 20).replace(sql.OBJECTS, sql.CROWDED)})
SELECT c.catalog, s.survey, m.objectId, m.objectid_ztf AS other
FROM m, (SELECT unnest(['first', 'second']) AS catalog) c, (SELECT unnest(['near', 'far']) AS survey) s""")
def association_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two collections matched with two surveys: four association catalogs, opened."""
    collections, surveys = {}, {}
    for name in ("first", "second"):
        catalog = write_catalog(
            data.objects(spark, sf_dir, crowded=True), scratch_path(spark, name), name=name, catalog_type="object",
            ra="ra", dec="dec", threshold=_ROWS, highest_order=_ORDER,
        )
        collections[name] = collect(catalog, scratch_path(spark, f"{name}_collection"), _COLLECTION)
    for name, suffix in (("near", "_n"), ("far", "_f")):
        folder = scratch_path(spark, name)
        data.survey(spark, sf_dir).write.parquet(folder)
        surveys[name] = SurveySettings(folder, suffix, "objectid")
    root = scratch_path(spark, "matches")
    written = match_surveys(collections, surveys, root)
    assert match_surveys(collections, surveys, root, resume=True) == written
    rows = None
    for catalog in collections:
        for name, survey in surveys.items():
            pairs = open_catalog(spark, written[f"{catalog}_x_{name}"]).all_rows().select(
                F.lit(catalog).alias("catalog"), F.lit(name).alias("survey"), "objectId",
                F.col(f"objectid{survey.suffix}").alias("other"),
            )
            rows = pairs if rows is None else rows.unionByName(pairs)
    return rows


@query(f"""
SELECT 'difference to the recorded total' AS problem, count(*) AS n FROM ({sql.CROWDED}) WHERE objectId % 3 = 0""")
def catalog_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Disagreements between records and files: none, until every third object is lost from the files."""
    catalog = object_catalog(spark, sf_dir)
    assert is_valid_catalog(spark, catalog.root) and catalog_problems(spark, catalog.root).isEmpty()
    lost, version = scratch_path(spark, "damaged"), catalog.properties["version"]
    spark.read.text(f"{catalog.root}/properties").write.text(f"{lost}/properties")
    catalog.partitions().write.parquet(f"{lost}/partitions-{version}")
    kept = catalog.all_rows().where("objectId % 3 <> 0")
    kept.write.partitionBy("Norder", "Dir", "Npix").parquet(f"{lost}/data-{version}")
    assert not is_valid_catalog(spark, lost)
    return catalog_problems(spark, lost).where("problem = 'difference to the recorded total'")


@query(f"""
SELECT (objectId % 2 = 0) AS even, count(*) AS n, 2.0::DOUBLE AS rules FROM ({sql.CROWDED}) GROUP BY even""")
def resumed_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the partitions processed by old rules, a part of them again by new ones, then the rest."""
    catalog = object_catalog(spark, sf_dir)
    output = scratch_path(spark, "processed")

    def add_flux(rules: float):
        return lambda df: calibrate(df.withColumn("psfFlux", F.col("ra") + 1.0), ["psf"]).withColumn("rules", F.lit(rules))

    def tally(rules: float, chosen: DataFrame | None = None) -> dict[str, int]:
        done = process_partitions(catalog, output, add_flux(rules), f"rules {rules}", chosen)
        return {r["status"]: r["n_partitions"] for r in done.collect()}

    n = catalog.properties["n_partitions"]
    even = catalog.partitions().where("Npix % 2 = 0").select("Norder", "Npix")
    n_even, n_fourth = even.count(), even.where("Npix % 4 = 0").count()
    assert tally(1.0, even).get("processed", 0) == n_even
    assert tally(2.0, even.where("Npix % 4 = 0")).get("processed", 0) == n_fourth
    rest = tally(2.0)
    assert (rest.get("processed", 0), rest.get("skipped", 0)) == (n - n_fourth, n_fourth)
    assert tally(2.0) == {"skipped": n}
    rows = spark.read.parquet(output)
    return rows.groupBy((F.col("objectId") % 2 == 0).alias("even")).agg(
        F.count("psfMag").alias("n"), F.min("rules").alias("rules")
    )


@query(f"""
SELECT objectId, ra, dec FROM ({sql.CROWDED}) WHERE objectId IN (SELECT user_id FROM events WHERE event_type = 'error')""")
def lookup_after_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog written anew with finer partitions: its collection gets a new index and margin."""
    first = object_collection(spark, sf_dir)
    ra, dec = first.catalog.position
    finer = write_catalog(
        first.catalog.all_rows(), first.catalog.root, name="object", catalog_type="object", ra=ra, dec=dec,
        threshold=1_000, highest_order=_ORDER, overwrite=True,
    )
    root = first.margin.root.removesuffix("/margin")
    second = build_collection(finer, root, margin_arcsec=60.0, id_column="objectId", resume=True)
    assert second.index_path != first.index_path
    assert second.margin.properties["source_version"] == finer.properties["version"]
    events = data.table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    return second.rows_of(events.select(F.col("user_id").alias("objectId"))).select("objectId", "ra", "dec")


@query(f"""
SELECT o AS map_order, pixel >> (2 * (6 - o)) AS pixel, count(*) AS n_rows
FROM ({sql.pixels(6, sql.CROWDED)}), (SELECT unnest([2, 4, 6]) AS o) GROUP BY ALL""")
def nested_density_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Density maps written with a nested catalog: objects count once, however many rows they fill."""
    return spark.read.parquet(light_curve_catalog(spark, sf_dir).density_path).select("map_order", "pixel", "n_rows")


@query(f"""
SELECT objectId, row_number() OVER (PARTITION BY objectId ORDER BY midpointMjdTai NULLS LAST, sourceId, visit,
       detector, quantity) - 1 AS pos, midpointMjdTai
FROM (SELECT s.* EXCLUDE (midpointMjdTai), v.expMidptMJD AS midpointMjdTai
      FROM ({sql.FORCED}) s LEFT JOIN ({sql.VISITS}) v ON s.visit = v.visitId)""")
def nested_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects and calibrated sources nested and written; the default columns opened again."""
    rows = light_curve_catalog(spark, sf_dir).rows()
    return flatten(rows, "objectForcedSource", ["objectId"], position="pos").select("objectId", "pos", "midpointMjdTai")


def aligned_catalogs(spark: SparkSession, sf_dir: str, threshold: int = 100, n_buckets: int = 8) -> tuple[Catalog, Catalog]:
    """Objects in buckets of their partitions, and sources scattered round them in the same buckets."""
    common = dict(catalog_type="object", highest_order=_ORDER)
    objects = write_catalog(
        data.objects(spark, sf_dir, crowded=True), scratch_path(spark, "cells"), name="object", ra="ra", dec="dec",
        threshold=threshold, n_buckets=n_buckets, **common,
    )
    ra, dec = data.crowded_position(F.col("objectId"))
    shift = (F.col("sourceId") % 7 - 3) * 0.01
    scattered = data.forced_sources(spark, sf_dir).withColumns({"coord_ra": ra, "coord_dec": F.greatest(F.lit(-90.0), F.least(F.lit(90.0), dec + shift))})
    sources = write_catalog(
        scattered, scratch_path(spark, "cell-sources"), name="forced", ra="coord_ra", dec="coord_dec",
        threshold=4 * threshold, align_to=objects, **common,
    )
    return objects, sources


_TIES = "sourceId, visit, detector, quantity"


@query(f"""
SELECT objectId, row_number() OVER (PARTITION BY objectId ORDER BY midpointMjdTai NULLS LAST, {_TIES}) - 1 AS pos, sourceId, psfFlux
FROM ({sql.FORCED}) WHERE objectId IN (SELECT objectId FROM ({sql.CROWDED}))""")
def nested_in_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources nested cell by cell, with some beyond the border of their object's cell and some objects in parts."""
    objects, sources = aligned_catalogs(spark, sf_dir)
    settings = replace(_NESTING, nested_columns=("lc",), default_columns=(), density_orders=())
    nested = nest_catalog(
        objects, [sources], scratch_path(spark, "nested-cells"), "object_lc", settings,
        tie_break=("sourceId", "visit", "detector", "quantity"), max_rows=5,
    )
    return flatten(nested.all_rows(), "lc", ["objectId"], position="pos").select("objectId", "pos", "sourceId", "psfFlux")


@query(f"""
SELECT objectId, row_number() OVER (PARTITION BY objectId ORDER BY midpointMjdTai NULLS LAST, {_TIES}) - 1 AS pos, sourceId, psfFlux,
       TRUE AS shared, TRUE AS valid
FROM ({sql.FORCED}) WHERE objectId IN (SELECT objectId FROM ({sql.CROWDED}))""")
def late_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Light curves written without half of the sources of crowded objects, which then come late; other partitions stay."""
    settings = replace(_NESTING, nested_columns=("lc",), density_orders=())
    objects, sources = data.objects(spark, sf_dir, crowded=True), data.forced_sources(spark, sf_dir)
    late = (F.col("objectId") % 3 == 0) & (F.col("sourceId") % 2 == 0)
    ties, max_rows = tuple(_TIES.split(", ")), 4
    early = sources.where(~late)
    nested = nest_sources(
        objects, [early], on="objectId", into=["lc"], sort_by=settings.sort_by, tie_break=ties, max_rows=max_rows
    )
    before = write_catalog(
        nested, scratch_path(spark, "growing"), name="object_lc", catalog_type="object", ra="ra", dec="dec", threshold=100,
        highest_order=_ORDER, positions=object_parts(objects, [early], "objectId", max_rows),
    )
    after = add_sources(before, {"lc": sources.where(late)}, settings, tie_break=ties, max_rows=max_rows)
    written = after.placed_partitions().where(F.col("data_version") == after.properties["version"])
    shared = 0 < written.count() < after.properties["n_partitions"] == before.properties["n_partitions"]
    valid = is_valid_catalog(spark, after.root, strict=True)
    rows = flatten(open_catalog(spark, after.root).all_rows(), "lc", ["objectId"], position="pos")
    return rows.select("objectId", "pos", "sourceId", "psfFlux", F.lit(shared).alias("shared"), F.lit(valid).alias("valid"))


@query(f"""
SELECT objectId, ra, dec, TRUE AS grown, TRUE AS valid FROM ({sql.CROWDED})""")
def appended_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog that grows by batches, one of them given twice; overfull partitions are split."""
    threshold = max(20, data.table(spark, sf_dir, "orders").count() // 40)
    objects = data.objects(spark, sf_dir, crowded=True)
    batch = F.col("objectId") % 4
    first = write_catalog(
        objects.where(batch == 0), scratch_path(spark, "batches"), name="object", catalog_type="object", ra="ra", dec="dec",
        threshold=threshold, highest_order=_ORDER,
    )
    catalog = first
    for k in (1, 2, 2, 3):
        catalog = append_rows(catalog, objects.where(batch == k), threshold, batch=f"batch {k}")
    numbers = (first.properties["number"], catalog.properties["number"])
    sizes = catalog.partitions()
    overfull = sizes.where((F.col("n_rows") > threshold) & (F.col("Norder") < _ORDER)).count()
    grown = numbers == (1, 4) and overfull == 0 and catalog.properties["n_partitions"] > first.properties["n_partitions"]
    valid = is_valid_catalog(spark, catalog.root, strict=True)
    return catalog.all_rows().select("objectId", "ra", "dec", F.lit(grown).alias("grown"), F.lit(valid).alias("valid"))


@query(f"""
SELECT objectId, ra, dec FROM ({sql.CROWDED}) WHERE {sql.separation('ra', 'dec', '40.4', '10.3')} <= 1""")
def catalog_cone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cone on a written catalog, reading only the folders it can touch."""
    return object_catalog(spark, sf_dir).cone(40.4, 10.3, 3600.0).select("objectId", "ra", "dec")


@query(f"""
SELECT objectId, ra, dec FROM ({sql.CROWDED}) WHERE objectId IN (SELECT user_id FROM events WHERE event_type = 'error')""")
def index_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects with an error event, found through the id index of a collection."""
    collection = object_collection(spark, sf_dir)
    events = data.table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    wanted = events.select(F.col("user_id").alias("objectId"))
    return collection.rows_of(wanted).select("objectId", "ra", "dec")


@query(f"{margin_sql(_ROWS, 150.0)} SELECT objectId, Norder, Npix, TRUE AS reused FROM margin")
def collection_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Margin table of a collection: rows near another partition; a second build reuses it."""
    collection = object_collection(spark, sf_dir, margin_arcsec=150.0)
    margin = collection.margin
    usable = is_valid_catalog(spark, margin.root) and is_reusable_margin(collection.catalog, margin.root, 150.0)
    other = is_reusable_margin(collection.catalog, margin.root, 5.0)
    again = write_margin(collection.catalog, margin.root, 150.0, resume=True).properties
    reused = F.lit(usable and not other and again == margin.properties)
    return margin.all_rows().select("objectId", "Norder", "Npix", reused.alias("reused"))


_IN_CONES = f"SELECT field, objectId, ra, dec FROM ({sql.CROWDED}) JOIN ({sql.fields()}) ON {sql.separation('ra', 'dec', 'ra0', 'dec0')} <= 3"


@query(f"""
WITH r AS (SELECT * FROM ({sql.CROWDED}))
SELECT 'objectId' AS "column", min(objectId)::DOUBLE AS min_value, max(objectId)::DOUBLE AS max_value, 0::BIGINT AS null_count, count(*) AS n_rows,
       avg(objectId)::FLOAT AS mean_value FROM r
UNION ALL SELECT 'ra', min(ra), max(ra), count(*) FILTER (ra IS NULL), count(*), avg(ra)::FLOAT FROM r
UNION ALL SELECT 'dec', min(dec), max(dec), count(*) FILTER (dec IS NULL), count(*), avg(dec)::FLOAT FROM r""")
def stored_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extremes, nulls and means of a written catalog from the statistics kept with it; no data row is read."""
    catalog = object_catalog(spark, sf_dir, threshold=500)
    write_statistics(catalog)
    rows = catalog.statistics().where(F.col("column").isin("objectId", "ra", "dec"))
    number = lambda c: F.col(c).cast("double").alias(c)
    return rows.select("column", number("min_value"), number("max_value"), "null_count", "n_rows", F.col("mean_value").cast("float").alias("mean_value"))


@query(_IN_CONES)
def catalog_cones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fields cut from a written catalog in one pass, by the pixel ranges that cover them."""
    catalog = object_catalog(spark, sf_dir, threshold=100)
    return catalog.cones(SKY_FIELDS, 3 * 3600.0).select("field", "objectId", "ra", "dec")


@query(_match_sql(0.2, 20).replace(sql.OBJECTS, sql.CROWDED))
def association_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A collection matched with a survey table, written by partition and read back."""
    collection = object_collection(spark, sf_dir)
    folder = scratch_path(spark, "survey")
    data.survey(spark, sf_dir).write.parquet(folder)
    surveys = {"ztf_dr22": SurveySettings(folder, "_ztf", "objectid")}
    written = match_surveys({"object_collection": collection}, surveys, scratch_path(spark, "matches"))
    rows = open_catalog(spark, written["object_x_ztf_dr22"]).all_rows()
    return rows.select("objectId", "objectid_ztf", F.round("_dist_arcsec", 6).alias("_dist_arcsec"))


# Columns of the light curves: of the object, its part, the nested sources without their own key, and the layout.
_SOURCE_FIELDS = (
    "sourceId", "visit", "detector", "band", "psfFlux", "psfFluxErr", "psfDiffFlux", "psfDiffFluxErr", "quantity",
    "coord_ra", "coord_dec", "psfMag", "psfMagErr", "midpointMjdTai",
)
_RECORDED = ",".join([
    "objectId", "ra", "dec", "_part", "_start", *[f"objectForcedSource.{f}" for f in _SOURCE_FIELDS],
    "_healpix_29", "Norder", "Dir", "Npix",
])


@query(f"""
SELECT s.objectId, s.sourceId, v.expMidptMJD AS midpointMjdTai, ({sql.magnitude('psfFlux')})::FLOAT AS psfMag,
       2::BIGINT AS n_versions
FROM ({sql.FORCED}) s LEFT JOIN ({sql.VISITS}) v ON s.visit = v.visitId""")
def calibrated_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of a written catalog calibrated once; the second time the schema says that nothing is to do."""
    catalog = source_catalog(spark, sf_dir)
    for _ in range(2):
        catalog = calibrate_catalog(catalog, _CALIBRATION, data.visits(spark, sf_dir))
    number = F.lit(open_catalog(spark, catalog.root).properties["number"]).cast("long")
    return catalog.all_rows().select("objectId", "sourceId", "midpointMjdTai", "psfMag", number.alias("n_versions"))


@query(f"""
SELECT (SELECT count(*) FROM ({sql.CROWDED})) AS "numRows", (SELECT count(*) FROM ({sql.FORCED})) AS n_sources,
       'w_2026_01/object_lc' AS label, 'd1 w_2026_01 object_lc' AS name,
       'DRP/d1/w_2026_01/T-1 object_lc' AS description, len(string_split(fields, ','))::BIGINT AS "numColumns",
       fields, TRUE AS partitions_agree, TRUE AS size_agrees, TRUE AS url_agrees, TRUE AS builder_agrees,
       'Column descriptions' AS link, 'https://example.org/columns' AS link_url, 1 AS n_links, 'Internal,DP' AS badges
FROM (SELECT '{_RECORDED}' AS fields)""")
def collection_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary record of a nested catalog, written as JSON and read back, beside what its files hold."""
    catalog = light_curve_catalog(spark, sf_dir)
    path = scratch_path(spark, "summary")
    summary = collection_summary(
        catalog, "object_lc", version="w_2026_01", run="d1", tag="T-1", badges=["Internal", "DP"],
        other_urls=[("Column descriptions", "https://example.org/columns")],
    )
    write_summaries([summary], path)
    rows = catalog.all_rows()
    sizes = F.coalesce(F.size("objectForcedSource.psfFlux"), F.lit(0)).cast("long")
    n_sources = rows.agg(F.sum(sizes).alias("n"))
    # Measured anew: folders that hold rows, and bytes of the data files as the folder lists them.
    n_partitions = rows.agg(F.count_distinct("Norder", "Npix").alias("n"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    n_bytes = files.load(catalog.data_path).agg((F.floor(F.sum("length") / 1024) * 1024).alias("n"))
    fields = ",".join(full_column_names(rows))
    return spark.read.json(path).select(
        F.col("metadata.numRows").alias("numRows"),
        F.lit(n_sources.scalar()).alias("n_sources"),
        "label",
        "name",
        "description",
        F.col("metadata.numColumns").alias("numColumns"),
        F.lit(fields).alias("fields"),
        (F.col("metadata.numPartitions") == n_partitions.scalar()).alias("partitions_agree"),
        (F.col("metadata.sizeOnDisk") == readable_size(n_bytes.scalar())).alias("size_agrees"),
        (F.col("urls.catalog") == catalog.root).alias("url_agrees"),
        (F.col("metadata.builder") == catalog.properties["builder"]).alias("builder_agrees"),
        F.col("other_urls")[0]["label"].alias("link"),
        F.col("other_urls")[0]["url"].alias("link_url"),
        F.size("other_urls").alias("n_links"),
        F.array_join("badges.title", ",").alias("badges"),
    )


@query(f"SELECT count(*) AS n_rows, 10::BIGINT AS n_bins, TRUE AS all_counted, TRUE AS in_bins FROM ({sql.CROWDED})")
def partition_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of partition file sizes: every partition is in one of ten bins; the bytes depend on the writer."""
    sizes = object_catalog(spark, sf_dir).partitions()
    bins = size_histogram(sizes.withColumn("gib", gibibytes(F.col("n_bytes"))), "gib")
    counted = bins.agg(F.count(F.lit(1)).alias("n_bins"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    parts = sizes.agg(
        F.sum("n_rows").alias("n_rows"), F.count(F.lit(1)).alias("parts"),
        F.min(gibibytes(F.col("n_bytes"))).alias("least"), F.max(gibibytes(F.col("n_bytes"))).alias("most"),
    )
    near = (F.abs(F.col("low") - F.col("least")) < 1e-12) & (F.abs(F.col("high") - F.col("most")) < 1e-12)
    return parts.join(counted, F.col("parts") == F.col("n"), "left").select(
        "n_rows", "n_bins", F.col("n").isNotNull().alias("all_counted"), near.alias("in_bins")
    )


@query("""
WITH r AS (SELECT min(s_acctbal) AS lo, max(s_acctbal) AS hi FROM supplier),
     b AS (SELECT unnest(range(1, 11))::INTEGER AS bin),
     k AS (SELECT least(floor((s_acctbal - lo) / ((hi - lo) / 10))::INTEGER + 1, 10) AS bin FROM supplier, r)
SELECT b.bin, round(lo + (hi - lo) / 10 * (b.bin - 1), 6) AS low, round(lo + (hi - lo) / 10 * b.bin, 6) AS high,
       (SELECT count(*) FROM k WHERE k.bin = b.bin) AS n
FROM b, r""")
def value_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten equal-width bins between minimum and maximum."""
    bins = size_histogram(data.table(spark, sf_dir, "supplier"), "s_acctbal")
    return bins.select("bin", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "n")


@query(f"""
SELECT count(*) AS n_sources, count(*) FILTER (WHERE psfFluxErr > 0) AS n_with_error FROM ({sql.FORCED})""")
def corrected_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested catalog corrected and written in its own partitions; no source is lost."""
    catalog = light_curve_catalog(spark, sf_dir)
    corrected = correct_collection(
        catalog,
        scratch_path(spark, "object_lc_corrected"),
        CorrectionSettings(False, corrected_columns("objectForcedSource")),
        demo_models(),
        features(spark, sf_dir),
        "objectId",
    )
    assert corrected.properties["total_rows"] == catalog.properties["total_rows"]
    value = F.explode("objectForcedSource.psfFluxErr_corrected").alias("value")
    return corrected.all_rows().select(value).agg(
        F.count(F.lit(1)).alias("n_sources"), F.count_if(F.col("value") > 0).alias("n_with_error")
    )
