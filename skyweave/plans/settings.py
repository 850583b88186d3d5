"""Settings of the catalog family, as plain dataclasses passed to the plans."""

from __future__ import annotations

from dataclasses import dataclass, field

from skyweave.operators.correction import CorrectedColumn


@dataclass(frozen=True)
class CatalogSettings:
    """One imported catalog."""

    dims: tuple[str, ...]
    group_by: tuple[str, ...]
    ra: str
    dec: str
    catalog_type: str
    threshold: int
    flux_prefixes: tuple[str, ...] = ()
    add_time: bool = False
    seed_schema: bool = False


@dataclass(frozen=True)
class NestingSettings:
    """One nested catalog."""

    object_catalog: str
    join_id: str
    source_catalogs: tuple[str, ...]
    nested_columns: tuple[str, ...]
    sort_by: str = "midpointMjdTai"
    threshold: int = 150_000
    highest_order: int = 11
    density_orders: tuple[int, ...] = (2, 4, 6)
    default_columns: tuple[str, ...] = ()


@dataclass(frozen=True)
class CollectionSettings:
    """Margin and index of a nested catalog."""

    nested_catalog: str
    index_column: str
    margin_arcsec: float = 5.0


@dataclass(frozen=True)
class SurveySettings:
    """One outside survey to match against."""

    path: str
    suffix: str
    join_id: str
    ra: str = "ra"
    dec: str = "dec"
    radius_arcsec: float = 0.2
    n_neighbors: int = 20
    endpoint: str | None = None
    anonymous: bool = False


@dataclass(frozen=True)
class CorrectionSettings:
    """Corrected columns of one collection, and whether its objects have extendedness per band."""

    per_band_extendedness: bool
    columns: tuple[CorrectedColumn, ...] = field(default_factory=tuple)


# Fixed values from here on: dimensions, thresholds and column lists of the shipped catalogs.

CATALOGS = {
    "dia_object": CatalogSettings(
        dims=("tract",), group_by=("tract",), ra="ra", dec="dec",
        catalog_type="object", threshold=5_000_000, seed_schema=True,
    ),
    "dia_source": CatalogSettings(
        dims=("tract",), group_by=("tract",), ra="ra", dec="dec",
        catalog_type="source", threshold=4_000_000, flux_prefixes=("psf", "science"),
    ),
    "dia_object_forced_source": CatalogSettings(
        dims=("patch", "tract"), group_by=("tract",), ra="coord_ra", dec="coord_dec",
        catalog_type="source", threshold=25_000_000, flux_prefixes=("psf",), add_time=True,
    ),
    "object": CatalogSettings(
        dims=("tract",), group_by=("tract",), ra="coord_ra", dec="coord_dec",
        catalog_type="object", threshold=300_000,
        flux_prefixes=(
            "u_psf", "u_kron", "u_cModel",
            "g_psf", "g_kron", "g_cModel",
            "r_psf", "r_kron", "r_cModel",
            "i_psf", "i_kron", "i_cModel",
            "z_psf", "z_kron", "z_cModel",
            "y_psf", "y_kron", "y_cModel",
        ),
        seed_schema=True,
    ),
    "source": CatalogSettings(
        dims=("band", "day_obs", "physical_filter", "visit"), group_by=("band", "day_obs"),
        ra="ra", dec="dec", catalog_type="source", threshold=1_000_000,
        flux_prefixes=("psf",), add_time=True,
    ),
    "object_forced_source": CatalogSettings(
        dims=("patch", "tract"), group_by=("tract",), ra="coord_ra", dec="coord_dec",
        catalog_type="source", threshold=25_000_000, flux_prefixes=("psf",), add_time=True,
    ),
}

NESTINGS = {
    "dia_object_lc": NestingSettings(
        object_catalog="dia_object",
        join_id="diaObjectId",
        source_catalogs=("dia_source", "dia_object_forced_source"),
        nested_columns=("diaSource", "diaObjectForcedSource"),
        default_columns=(
            "dec",
            "diaObjectForcedSource.band",
            "diaObjectForcedSource.coord_dec",
            "diaObjectForcedSource.coord_ra",
            "diaObjectForcedSource.diff_PixelFlags_nodataCenter",
            "diaObjectForcedSource.invalidPsfFlag",
            "diaObjectForcedSource.midpointMjdTai",
            "diaObjectForcedSource.pixelFlags_bad",
            "diaObjectForcedSource.pixelFlags_cr",
            "diaObjectForcedSource.pixelFlags_crCenter",
            "diaObjectForcedSource.pixelFlags_edge",
            "diaObjectForcedSource.pixelFlags_interpolated",
            "diaObjectForcedSource.pixelFlags_interpolatedCenter",
            "diaObjectForcedSource.pixelFlags_nodata",
            "diaObjectForcedSource.pixelFlags_saturated",
            "diaObjectForcedSource.pixelFlags_saturatedCenter",
            "diaObjectForcedSource.pixelFlags_suspect",
            "diaObjectForcedSource.pixelFlags_suspectCenter",
            "diaObjectForcedSource.psfDiffFlux",
            "diaObjectForcedSource.psfDiffFlux_flag",
            "diaObjectForcedSource.psfDiffFluxErr",
            "diaObjectForcedSource.psfFlux",
            "diaObjectForcedSource.psfFlux_flag",
            "diaObjectForcedSource.psfFluxErr",
            "diaObjectForcedSource.psfMag",
            "diaObjectForcedSource.psfMagErr",
            "diaObjectForcedSource.visit",
            "diaObjectId",
            "diaSource.band",
            "diaSource.centroid_flag",
            "diaSource.dec",
            "diaSource.decErr",
            "diaSource.ra",
            "diaSource.raErr",
            "diaSource.diaSourceId",
            "diaSource.forced_PsfFlux_flag",
            "diaSource.forced_PsfFlux_flag_edge",
            "diaSource.forced_PsfFlux_flag_noGoodPixels",
            "diaSource.midpointMjdTai",
            "diaSource.pixelFlags",
            "diaSource.pixelFlags_bad",
            "diaSource.pixelFlags_cr",
            "diaSource.pixelFlags_crCenter",
            "diaSource.pixelFlags_edge",
            "diaSource.pixelFlags_interpolated",
            "diaSource.pixelFlags_interpolatedCenter",
            "diaSource.pixelFlags_nodata",
            "diaSource.pixelFlags_nodataCenter",
            "diaSource.pixelFlags_offimage",
            "diaSource.pixelFlags_saturated",
            "diaSource.pixelFlags_saturatedCenter",
            "diaSource.pixelFlags_streak",
            "diaSource.pixelFlags_streakCenter",
            "diaSource.pixelFlags_suspect",
            "diaSource.pixelFlags_suspectCenter",
            "diaSource.psfFlux",
            "diaSource.psfFlux_flag",
            "diaSource.psfFlux_flag_edge",
            "diaSource.psfFlux_flag_noGoodPixels",
            "diaSource.psfFluxErr",
            "diaSource.psfMag",
            "diaSource.psfMagErr",
            "diaSource.reliability",
            "diaSource.scienceFlux",
            "diaSource.scienceFluxErr",
            "diaSource.scienceMag",
            "diaSource.scienceMagErr",
            "diaSource.shape_flag",
            "diaSource.shape_flag_no_pixels",
            "diaSource.shape_flag_not_contained",
            "diaSource.shape_flag_parent_source",
            "diaSource.snr",
            "diaSource.trail_flag_edge",
            "diaSource.visit",
            "diaSource.x",
            "diaSource.xErr",
            "diaSource.y",
            "diaSource.yErr",
            "nDiaSources",
            "ra",
            "tract",
        ),
    ),
    "object_lc": NestingSettings(
        object_catalog="object",
        join_id="objectId",
        source_catalogs=("object_forced_source",),
        nested_columns=("objectForcedSource",),
        default_columns=(
            "coord_dec",
            "coord_decErr",
            "coord_ra",
            "coord_raErr",
            "g_psfFlux",
            "g_psfFluxErr",
            "g_psfMag",
            "g_psfMagErr",
            "i_psfFlux",
            "i_psfFluxErr",
            "i_psfMag",
            "i_psfMagErr",
            "objectForcedSource.band",
            "objectForcedSource.coord_dec",
            "objectForcedSource.coord_ra",
            "objectForcedSource.detector",
            "objectForcedSource.invalidPsfFlag",
            "objectForcedSource.midpointMjdTai",
            "objectForcedSource.pixelFlags_bad",
            "objectForcedSource.pixelFlags_cr",
            "objectForcedSource.pixelFlags_crCenter",
            "objectForcedSource.pixelFlags_edge",
            "objectForcedSource.pixelFlags_interpolated",
            "objectForcedSource.pixelFlags_interpolatedCenter",
            "objectForcedSource.pixelFlags_nodata",
            "objectForcedSource.pixelFlags_saturated",
            "objectForcedSource.pixelFlags_saturatedCenter",
            "objectForcedSource.pixelFlags_suspect",
            "objectForcedSource.pixelFlags_suspectCenter",
            "objectForcedSource.psfDiffFlux",
            "objectForcedSource.psfDiffFlux_flag",
            "objectForcedSource.psfDiffFluxErr",
            "objectForcedSource.psfFlux",
            "objectForcedSource.psfFlux_flag",
            "objectForcedSource.psfFluxErr",
            "objectForcedSource.psfMag",
            "objectForcedSource.psfMagErr",
            "objectForcedSource.visit",
            "objectId",
            "patch",
            "r_psfFlux",
            "r_psfFluxErr",
            "r_psfMag",
            "r_psfMagErr",
            "refBand",
            "shape_flag",
            "shape_xx",
            "shape_xy",
            "shape_yy",
            "tract",
            "u_psfFlux",
            "u_psfFluxErr",
            "u_psfMag",
            "u_psfMagErr",
            "y_psfFlux",
            "y_psfFluxErr",
            "y_psfMag",
            "y_psfMagErr",
            "z_psfFlux",
            "z_psfFluxErr",
            "z_psfMag",
            "z_psfMagErr",
        ),
    ),
}

COLLECTIONS = {
    "dia_object_collection": CollectionSettings("dia_object_lc", "diaObjectId"),
    "object_collection": CollectionSettings("object_lc", "objectId"),
}

# Join id, suffix, radius and neighbour count of the two outside surveys; the path is the user's.
SURVEY_SUFFIXES = {"ztf_dr22": ("_ztf", "objectid"), "ps1": ("_ps1", "objID")}

SCIENCE_INPUTS = (
    "psfFlux",
    "psfFluxErr",
    "extendedness",
    "skyBg",
    "seeing",
    "expTime",
    "detector_rho",
    "detector_cos_phi",
    "detector_sin_phi",
    "is_u_band",
    "is_g_band",
    "is_r_band",
    "is_i_band",
    "is_z_band",
    "is_y_band",
)

DIFFERENCE_INPUTS = (
    "psfDiffFlux",
    "psfDiffFluxErr",
    "psfFlux",
    "extendedness",
    "skyBg",
    "seeing",
    "expTime",
    "detector_rho",
    "detector_cos_phi",
    "detector_sin_phi",
    "is_u_band",
    "is_g_band",
    "is_r_band",
    "is_i_band",
    "is_z_band",
    "is_y_band",
)

# Model names with their input counts and accepted ranges.
MODEL_RANGES = {"science_source": (15, 0.1, 50.0), "diff_source": (16, 0.1, 50.0)}


def corrected_columns(source_column: str) -> tuple[CorrectedColumn, ...]:
    """The two corrected errors of a forced-source column."""
    return (
        CorrectedColumn(
            source_column, "science_source", SCIENCE_INPUTS, "psfFluxErr_corrected", "psfFluxErr"
        ),
        CorrectedColumn(
            source_column, "diff_source", DIFFERENCE_INPUTS, "psfDiffFluxErr_corrected", "psfDiffFluxErr"
        ),
    )


CORRECTIONS = {
    "object_collection": CorrectionSettings(True, corrected_columns("objectForcedSource")),
    "dia_object_collection": CorrectionSettings(False, corrected_columns("diaObjectForcedSource")),
}

# Columns of each kind whose ranges are checked per catalog.
RANGE_RULES = {
    "dia_object": {"RIGHT ASCENSION": ("ra",), "DECLINATION": ("dec",), "MJD": ()},
    "dia_source": {
        "RIGHT ASCENSION": ("ra", "trailRa"),
        "DECLINATION": ("dec", "trailDec"),
        "FLUX": (
            "apFlux", "psfFlux", "trailFlux", "dipoleMeanFlux", "dipoleFluxDiff", "scienceFlux",
            "ixxPSF", "iyyPSF", "ixyPSF",
        ),
        "FLUX ERROR": (
            "apFluxErr", "psfFluxErr", "dipoleMeanFluxErr", "dipoleFluxDiffErr", "scienceFluxErr",
        ),
        "MJD": ("midpointMjdTai",),
    },
    "dia_object_forced_source": {
        "RIGHT ASCENSION": ("coord_ra",),
        "DECLINATION": ("coord_dec",),
        "FLUX": ("psfFlux", "psfDiffFlux"),
        "FLUX ERROR": ("psfFluxErr", "psfDiffFluxErr"),
        "MJD": ("midpointMjdTai",),
    },
    "object": {
        "RIGHT ASCENSION": ("coord_ra",),
        "DECLINATION": ("coord_dec",),
        "FLUX": tuple(f"{b}_{kind}Flux" for b in "ugrizy" for kind in ("psf", "kron")),
        "FLUX ERROR": tuple(f"{b}_{kind}FluxErr" for b in "ugrizy" for kind in ("psf", "kron")),
    },
    "source": {
        "RIGHT ASCENSION": ("ra",),
        "DECLINATION": ("dec",),
        "FLUX": (
            "calibFlux", "ap03Flux", "ap06Flux", "ap09Flux", "ap12Flux", "ap17Flux", "ap25Flux",
            "ap35Flux", "ap50Flux", "ap70Flux", "psfFlux", "gaussianFlux", "apFlux_12_0_instFlux",
            "apFlux_17_0_instFlux", "apFlux_35_0_instFlux", "apFlux_50_0_instFlux",
            "normCompTophatFlux_instFlux", "localBackground_instFlux",
        ),
        "FLUX ERROR": (
            "calibFluxErr", "ap03FluxErr", "ap06FluxErr", "ap09FluxErr", "ap12FluxErr", "ap17FluxErr",
            "ap25FluxErr", "ap35FluxErr", "ap50FluxErr", "ap70FluxErr", "psfFluxErr",
            "gaussianFluxErr", "apFlux_12_0_instFluxErr", "apFlux_17_0_instFluxErr",
            "apFlux_35_0_instFluxErr", "apFlux_50_0_instFluxErr", "normCompTophatFlux_instFluxErr",
            "localBackground_instFluxErr",
        ),
        "MJD": ("midpointMjdTai",),
    },
    "object_forced_source": {
        "RIGHT ASCENSION": ("coord_ra",),
        "DECLINATION": ("coord_dec",),
        "FLUX": ("psfFlux", "psfDiffFlux"),
        "FLUX ERROR": ("psfFluxErr", "psfDiffFluxErr"),
        "MJD": ("midpointMjdTai",),
    },
}
