"""Magnitudes, times and band features as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# AB zero point for fluxes in nanojansky, and the survey's filter bands.
AB_ZERO_POINT_NJY = 31.4
BANDS = ("u", "g", "r", "i", "z", "y")


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def _ab_magnitude_double(flux: Column) -> Column:
    # NaN orders above every number in Spark, so it has to go before the comparison.
    clean = nan_to_null(flux.cast("double"))
    return F.when(clean > 0, -2.5 * F.log10(clean) + AB_ZERO_POINT_NJY).when(
        clean == 0, F.lit(float("inf"))
    )


def ab_magnitude(flux: Column) -> Column:
    """AB magnitude of a nJy flux: null below zero, infinite at zero, null for null or NaN."""
    return _ab_magnitude_double(flux).cast("float")


def ab_magnitude_error(flux: Column, error: Column) -> Column:
    """Half the magnitude span of flux ± error; null where that span is undefined."""
    flux, error = flux.cast("double"), error.cast("double")
    span = _ab_magnitude_double(flux - error) - _ab_magnitude_double(flux + error)
    return nan_to_null(span / 2).cast("float")


def modified_julian_date(timestamp: Column) -> Column:
    """MJD of a timestamp read as UTC; for zone-less timestamps no session zone is involved."""
    day = F.datediff(F.to_date(timestamp), F.lit("1858-11-17").cast("date"))
    seconds = F.hour(timestamp) * 3600 + F.minute(timestamp) * 60
    micros = (F.extract(F.lit("SECOND"), timestamp) * 1000000).cast("long")
    return day + (seconds.cast("long") * 1000000 + micros) / F.lit(86400000000.0)


def band_flags(band: Column) -> dict[str, Column]:
    """One-hot columns ``is_{band}_band``; a null band gives zeros."""
    return {
        f"is_{name}_band": F.coalesce((band == name).cast("float"), F.lit(0.0).cast("float"))
        for name in BANDS
    }


def band_selected(value_of_band: dict[str, Column], flag_of_band: dict[str, Column]) -> Column:
    """Σ over bands of value · flag, with missing values as zero."""
    total = F.lit(0.0).cast("float")
    for name, value in value_of_band.items():
        filled = F.coalesce(value.cast("float"), F.lit(0.0).cast("float"))
        total = total + filled * flag_of_band[name].cast("float")
    return total


def polar_features(x: Column, y: Column, prefix: str = "detector") -> dict[str, Column]:
    """Distance and direction of a plane position, direction as cosine and sine."""
    angle = F.atan2(y.cast("double"), x.cast("double"))
    return {
        f"{prefix}_rho": F.hypot(x.cast("double"), y.cast("double")).cast("float"),
        f"{prefix}_cos_phi": F.cos(angle).cast("float"),
        f"{prefix}_sin_phi": F.sin(angle).cast("float"),
    }


def clip(value: Column, low: float, high: float) -> Column:
    """Clip to [low, high]; NaN and null stay as they are."""
    bounded = F.greatest(F.least(value, F.lit(high)), F.lit(low))
    return F.when(value.isNull() | F.isnan(value), value).otherwise(bounded)


def out_of_range(value: Column, low: float, high: float) -> Column:
    """True outside [low, high]; NaN compares false, as does null."""
    outside = ((value < low) | (value > high)) & ~F.isnan(value)
    return F.coalesce(outside, F.lit(False))
