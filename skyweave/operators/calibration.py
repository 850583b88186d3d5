"""Post-processing of source tables: magnitudes, times, narrower floats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweave.functions.photometry import ab_magnitude, ab_magnitude_error
from skyweave.runtime import broadcast_checked

TIME_COLUMN = "midpointMjdTai"

# Position and time columns that keep double precision.
DOUBLE_COLUMNS = frozenset(
    [
        "ra",
        "dec",
        "raErr",
        "decErr",
        "x",
        "y",
        "xErr",
        "yErr",
        "coord_ra",
        "coord_dec",
        "coord_raErr",
        "coord_decErr",
        "midpointMjdTai",
    ]
)


def add_magnitudes(df: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """``{p}Mag`` from ``{p}Flux``, and ``{p}MagErr`` where ``{p}FluxErr`` exists; one projection."""
    added = {}
    for prefix in prefixes:
        flux = F.col(f"{prefix}Flux")
        added[f"{prefix}Mag"] = ab_magnitude(flux)
        if f"{prefix}FluxErr" in df.columns:
            added[f"{prefix}MagErr"] = ab_magnitude_error(flux, F.col(f"{prefix}FluxErr"))
    return df.withColumns(added) if added else df


def last_per_key(lookup: DataFrame, key: str, value: str, ordinal: str | None) -> DataFrame:
    """One value per key: that of the highest ordinal, or the largest where rows have none."""
    chosen = F.max_by(value, ordinal) if ordinal else F.max(value)
    return lookup.groupBy(key).agg(chosen.alias(value))


def add_visit_time(
    df: DataFrame,
    visits: DataFrame,
    visit_key: str = "visitId",
    visit_time: str = "expMidptMJD",
    ordinal: str | None = None,
) -> DataFrame:
    """Time of each row's visit; null for an unknown visit."""
    if "visit" not in df.columns:
        raise ValueError("column 'visit' is missing")
    if TIME_COLUMN in df.columns:
        raise ValueError(f"column '{TIME_COLUMN}' exists already")
    known = visits.where(F.col(visit_key).isNotNull())
    times = last_per_key(known, visit_key, visit_time, ordinal).select(
        F.col(visit_key).alias("visit"), F.col(visit_time).cast("double").alias(TIME_COLUMN)
    )
    joined = df.join(broadcast_checked(times), "visit", "left")
    return joined.select(*df.columns, TIME_COLUMN)


def narrow_floats(df: DataFrame, keep: frozenset[str] = DOUBLE_COLUMNS) -> DataFrame:
    """Cast top-level double columns to float, except those that need the precision."""
    return df.select(
        [
            F.col(f.name).cast("float").alias(f.name)
            if isinstance(f.dataType, T.DoubleType) and f.name not in keep
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def is_processed(columns: Sequence[str], prefixes: Sequence[str], add_time: bool) -> bool:
    """Whether the schema shows that the requested columns are there; false if none is requested."""
    if not prefixes and not add_time:
        return False
    present = set(columns)
    return {f"{p}Mag" for p in prefixes} <= present and (not add_time or TIME_COLUMN in present)


def calibrate(
    df: DataFrame,
    prefixes: Sequence[str] = (),
    visits: DataFrame | None = None,
    ordinal: str | None = None,
) -> DataFrame:
    """Magnitudes, then visit times, then narrower floats; columns that exist are left alone."""
    missing = [p for p in prefixes if f"{p}Mag" not in df.columns]
    df = add_magnitudes(df, missing)
    if visits is not None and TIME_COLUMN not in df.columns:
        df = add_visit_time(df, visits, ordinal=ordinal)
    return narrow_floats(df)
