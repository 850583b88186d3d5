"""Pixels, cones, cross-match, margins, field statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.functions.sky import FINEST_ORDER, PIXEL, parent_pixel, settled, with_pixel
from skyweave.operators.alignment import refinement
from skyweave.operators.partitioning import (
    assign_partitions,
    density_map,
    first_partitions,
    partition_map,
    pixel_histogram,
)
from skyweave.operators.spatial import attach_matched_columns, cone_search, crossmatch, margin_rows
from skyweave.operators.statistics import SKY_FIELDS, numeric_columns
from skyweave.plans.release import field_statistics, field_statistics_report
from skyweave.queries import fixtures as data
from skyweave.queries import sql
from skyweave.queries.registry import query
from skyweave.runtime import materialize

_FIELD_RADIUS = 36_000.0
_VALUES = ["psfFlux", "psfFluxErr"]


@query(f"SELECT objectId, pixel FROM ({sql.pixels(29, sql.OBJECTS)})")
def sky_pixel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finest-order pixel of every object."""
    return with_pixel(data.objects(spark, sf_dir), out="pixel").select("objectId", "pixel")


@query(f"SELECT pixel, count(*) AS n_rows FROM ({sql.pixels(5, sql.CROWDED)}) GROUP BY pixel")
def pixel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per pixel at order 5, as parents of the finest pixels."""
    return pixel_histogram(with_pixel(data.objects(spark, sf_dir, crowded=True)), 5)


@query(" UNION ALL ".join(
    f"SELECT {o} AS map_order, pixel, count(*) AS n_rows FROM ({sql.pixels(o, sql.CROWDED)}) GROUP BY pixel"
    for o in (2, 4, 6)))
def density_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Density at orders 2, 4 and 6, rolled up from one histogram."""
    rows = with_pixel(data.objects(spark, sf_dir, crowded=True))
    return density_map(pixel_histogram(rows, 6), 6, (2, 4, 6))


_MAP_ORDER, _MAP_ROWS = 7, 150
_LEVELS = " UNION ALL ".join(
    f"SELECT pixel AS fine, n, {o} AS o, pixel >> {2 * (_MAP_ORDER - o)} AS p FROM h" for o in range(_MAP_ORDER + 1)
)


def map_sql(most: int) -> str:
    """CTEs up to ``m`` (Norder, Npix, n), one row for each finest pixel with the partition it belongs to."""
    return f"""
WITH h AS (SELECT pixel, count(*) AS n FROM ({sql.pixels(_MAP_ORDER, sql.CROWDED)}) GROUP BY pixel),
     l AS ({_LEVELS}),
     t AS (SELECT o, p, sum(n) AS total FROM l GROUP BY o, p),
     c AS (SELECT fine, n, coalesce(min(CASE WHEN total <= {most} THEN o END), {_MAP_ORDER}) AS o
           FROM l JOIN t USING (o, p) GROUP BY fine, n),
     m AS (SELECT o AS Norder, fine >> (2 * ({_MAP_ORDER} - o)) AS Npix, n FROM c)"""


def margin_sql(most: int, threshold_arcsec: float) -> str:
    """``map_sql`` and further CTEs up to ``margin`` of the crowded objects."""
    rows = f"""SELECT objectId, ra, dec, c.o, r.pixel >> (2 * ({_MAP_ORDER} - c.o)) AS p
               FROM ({sql.pixels(_MAP_ORDER, sql.CROWDED)}) r JOIN c ON c.fine = r.pixel"""
    return f"{map_sql(most)}, {sql.margins(rows, 'SELECT DISTINCT Norder, Npix FROM m', threshold_arcsec)}"


_MAP_CTE = map_sql(_MAP_ROWS)


def _map(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = with_pixel(data.objects(spark, sf_dir, crowded=True))
    histogram = materialize(pixel_histogram(rows, _MAP_ORDER))
    return rows, materialize(partition_map(histogram, _MAP_ORDER, _MAP_ROWS))


@query(f"""{_MAP_CTE}
SELECT Norder, Npix // 10000 * 10000 AS Dir, Npix, sum(n)::BIGINT AS n_rows FROM m GROUP BY Norder, Npix""")
def adaptive_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions of a sky with a crowded patch."""
    return _map(spark, sf_dir)[1]


def _ranges_sql(alias: str) -> tuple[str, str]:
    return f"({alias}.Npix << (2 * (29 - {alias}.Norder)))", f"(({alias}.Npix + 1) << (2 * (29 - {alias}.Norder)))"


_COARSE_ROWS = 600


@query(f"""{_MAP_CTE},
     w AS (SELECT DISTINCT Norder, Npix FROM m),
     u AS (SELECT DISTINCT o AS Norder, fine >> (2 * ({_MAP_ORDER} - o)) AS Npix FROM (
           SELECT fine, n, coalesce(min(CASE WHEN total <= {_COARSE_ROWS} THEN o END), {_MAP_ORDER}) AS o
           FROM l JOIN t USING (o, p) WHERE fine % 3 = 0 GROUP BY fine, n))
SELECT w.Norder::INTEGER AS left_order, w.Npix AS left_pixel, u.Norder::INTEGER AS right_order, u.Npix AS right_pixel,
       greatest(w.Norder, u.Norder)::INTEGER AS "order", CASE WHEN u.Norder >= w.Norder THEN u.Npix ELSE w.Npix END AS pixel
FROM w LEFT JOIN u ON {_ranges_sql('w')[0]} < {_ranges_sql('u')[1]} AND {_ranges_sql('u')[0]} < {_ranges_sql('w')[1]}""")
def aligned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Common refinement of a partition list and a coarser one that covers a part of it."""
    rows = with_pixel(data.objects(spark, sf_dir, crowded=True))
    histogram = materialize(pixel_histogram(rows, _MAP_ORDER))
    fine = partition_map(histogram, _MAP_ORDER, _MAP_ROWS)
    levels = materialize(partition_map(histogram, _MAP_ORDER, _COARSE_ROWS))
    # Partitions that hold a pixel whose number divides by three.
    some = histogram.where("pixel % 3 = 0").select(F.shiftleft("pixel", 2 * (FINEST_ORDER - _MAP_ORDER)).alias(PIXEL))
    coarse = assign_partitions(some, levels).select("Norder", "Npix").distinct()
    both = refinement(materialize(fine), materialize(coarse), how="left")
    return both.withColumn("pixel", F.coalesce("pixel", "left_pixel"))


@query(f"""{_MAP_CTE},
     f AS (SELECT Norder, Npix FROM m GROUP BY Norder, Npix ORDER BY Npix << (2 * (29 - Norder)) LIMIT 10),
     r AS (SELECT objectId, pixel FROM ({sql.pixels(_MAP_ORDER, sql.CROWDED)}))
SELECT r.objectId, f.Norder, f.Npix FROM r JOIN f ON r.pixel >> (2 * ({_MAP_ORDER} - f.Norder)) = f.Npix""")
def first_ten_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of the first ten partitions along the sky curve."""
    rows, partitions = _map(spark, sf_dir)
    chosen = first_partitions(assign_partitions(rows, partitions), partitions, 10)
    return chosen.select("objectId", F.col("Norder").cast("int").alias("Norder"), "Npix")


@query(f"""
SELECT objectId, ra, dec FROM ({sql.OBJECTS})
WHERE {sql.separation('ra', 'dec', '2.5', '-84.0')} <= 12""")
def cone_near_pole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cone that holds the south pole and crosses ra = 0."""
    return cone_search(data.objects(spark, sf_dir), 2.5, -84.0, 12 * 3600.0)


@query(f"""
SELECT objectId, ra, dec FROM ({sql.OBJECTS})
WHERE {sql.separation('ra', 'dec', '358.0', '20.0')} <= 8""")
def cone_over_wrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cone that crosses ra = 0."""
    return cone_search(data.objects(spark, sf_dir), 358.0, 20.0, 8 * 3600.0)


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    ra, dec = data.position(F.col("objectId"))
    error = F.col("psfFluxErr")
    rows = data.forced_sources(spark, sf_dir).withColumns({"ra": ra, "dec": dec})
    # Positions are columns of a real table; here they are computed once, not again per filter.
    rows = settled(rows, ["ra", "dec"], [])
    return rows.withColumn("psfFluxErr", F.when(error != 0, error))


_MEASURED = f"""
SELECT * EXCLUDE (psfFluxErr), nullif(psfFluxErr, 0) AS psfFluxErr, {sql.position('objectId')} FROM ({sql.FORCED})"""
_IN_FIELDS = f"""
SELECT field, m.* FROM ({_MEASURED}) m JOIN ({sql.fields()}) ON {sql.separation('ra', 'dec', 'ra0', 'dec0')} <= 10"""


def _by_band(values: list[str], mean) -> str:
    return ", ".join(
        f"({mean(v)})::FLOAT AS mean_{v}, min({v}) AS min_{v}, max({v}) AS max_{v}" for v in values
    )


@query(f"""
SELECT field, band, count(*) AS len, {_by_band(_VALUES, lambda v: f'avg({v})')}
FROM ({_IN_FIELDS}) GROUP BY field, band""")
def field_band_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics per field and band, all fields in one pass."""
    rows = field_statistics(_measured(spark, sf_dir), radius_arcsec=_FIELD_RADIUS, columns=_VALUES)
    return rows.withColumns({f"mean_{v}": F.col(f"mean_{v}").cast("float") for v in _VALUES})


_PARTS = ", ".join(
    f"avg({v}) AS mean_{v}, min({v}) AS min_{v}, max({v}) AS max_{v}" for v in _VALUES
)
_COMBINED = ", ".join(
    f"(coalesce(sum(mean_{v} * len), 0) / sum(len))::FLOAT AS mean_{v},"
    f" min(min_{v}) AS min_{v}, max(max_{v}) AS max_{v}"
    for v in _VALUES
)


@query(f"""
SELECT field, band, sum(len)::BIGINT AS len, {_COMBINED}
FROM (SELECT field, pixel, band, count(*) AS len, {_PARTS}
      FROM ({sql.pixels(3, _IN_FIELDS)}) GROUP BY field, pixel, band)
GROUP BY field, band""")
def field_weighted_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-partition statistics combined with row counts as weights."""
    placed = with_pixel(_measured(spark, sf_dir)).withColumns(
        {"Norder": F.lit(3), "Npix": parent_pixel(F.col(PIXEL), FINEST_ORDER, 3)}
    )
    rows = field_statistics(placed, radius_arcsec=_FIELD_RADIUS, columns=_VALUES, exact=False)
    return rows.withColumns({f"mean_{v}": F.col(f"mean_{v}").cast("float") for v in _VALUES})


_STATISTICS = " UNION ALL ".join(
    f"SELECT field, '{kind}_{v}_' || band AS statistic, {function}({v}) AS value FROM r GROUP BY field, band"
    for v in _VALUES
    for kind, function in (("mean", "avg"), ("min", "min"), ("max", "max"))
)
_FIELD_COLUMNS = ", ".join(
    f"max(CASE WHEN field = '{name}' THEN value END)::FLOAT AS \"{name}\"" for name in sql.FIELDS
)


@query(f"""
WITH r AS ({_IN_FIELDS}), s AS ({_STATISTICS})
SELECT statistic, {_FIELD_COLUMNS} FROM s GROUP BY statistic""")
def field_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics as rows, fields as columns."""
    report = field_statistics_report(_measured(spark, sf_dir), _VALUES, radius_arcsec=_FIELD_RADIUS)
    return report.withColumns({name: F.col(f"`{name}`").cast("float") for name in SKY_FIELDS})


@query(f"""
SELECT band, count(*) AS len, avg(psfFlux)::FLOAT AS mean_psfFlux,
       avg(psfDiffFlux)::FLOAT AS mean_psfDiffFlux, avg(quantity)::FLOAT AS mean_quantity
FROM ({sql.FORCED}) GROUP BY band""")
def numeric_column_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of all numeric columns that are neither ids nor magnitudes."""
    from skyweave.operators.statistics import band_statistics

    rows = data.forced_sources(spark, sf_dir)
    columns = numeric_columns(rows)
    assert "sourceId" not in columns and "psfFlux" in columns
    means = ["mean_psfFlux", "mean_psfDiffFlux", "mean_quantity"]
    stats = band_statistics(rows, columns)
    return stats.select("band", "len", *[F.col(m).cast("float").alias(m) for m in means])


def _matched(spark: SparkSession, sf_dir: str, radius: float, n: int) -> DataFrame:
    return crossmatch(
        data.objects(spark, sf_dir),
        data.survey(spark, sf_dir),
        left_id="objectId",
        right_id="objectid",
        radius_arcsec=radius,
        n_neighbors=n,
        suffix="_ztf",
    )


def _match_sql(radius: float, n: int, digits: int = 6) -> str:
    angle = f"3600 * {sql.separation('o.ra', 'o.dec', 's.ra', 's.dec')}"
    return f"""
SELECT objectId, objectid_ztf, round(d, {digits}) AS _dist_arcsec
FROM (SELECT *, row_number() OVER (PARTITION BY objectId ORDER BY d, objectid_ztf) AS rank
      FROM (SELECT o.objectId, s.objectid AS objectid_ztf, {angle} AS d
            FROM ({sql.OBJECTS}) o JOIN ({sql.SURVEY}) s ON abs(o.dec - s.dec) <= {radius / 3600 + 1e-6})
      WHERE d <= {radius}) WHERE rank <= {n}"""


@query(_match_sql(0.2, 20))
def crossmatch_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours within 0.2 arcsec."""
    return _matched(spark, sf_dir, 0.2, 20).withColumn("_dist_arcsec", F.round("_dist_arcsec", 6))


@query(_match_sql(7200.0, 3, digits=3))
def crossmatch_nearest_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three nearest survey rows within two degrees."""
    return _matched(spark, sf_dir, 7200.0, 3).withColumn("_dist_arcsec", F.round("_dist_arcsec", 3))


@query(f"""
SELECT m.objectId, o.ra, o.dec, m.objectid_ztf, s.ra AS ra_ztf, s.dec AS dec_ztf, m._dist_arcsec
FROM ({_match_sql(0.2, 20)}) m JOIN ({sql.OBJECTS}) o ON m.objectId = o.objectId
JOIN ({sql.SURVEY}) s ON m.objectid_ztf = s.objectid""")
def crossmatch_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched pairs with the columns of both sides, the survey's under their suffix."""
    pairs = _matched(spark, sf_dir, 0.2, 20)
    rows = attach_matched_columns(
        pairs, data.objects(spark, sf_dir), data.survey(spark, sf_dir), "objectId", "objectid", "_ztf"
    )
    return rows.withColumn("_dist_arcsec", F.round("_dist_arcsec", 6))


@query(f"""{margin_sql(_MAP_ROWS, 2500.0)}
SELECT objectId, Norder, Npix // 10000 * 10000 AS Dir, Npix FROM margin""")
def margin_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of objects within 2,500 arcsec of another partition, more than the width of the smallest."""
    rows, partitions = _map(spark, sf_dir)
    return margin_rows(assign_partitions(rows, partitions), partitions, 2500.0).select("objectId", "Norder", "Dir", "Npix")
