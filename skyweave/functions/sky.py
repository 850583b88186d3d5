"""Positions on the sphere: unit vectors, separations and equal-area nested pixels.

The pixel scheme is HEALPix (Górski et al. 2005, ApJ 622, 759) in nested numbering. Everything
is built from Spark expressions; the steps are separate projections, so that Spark computes each
intermediate once and fuses them in one generated stage.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The finest order, and the layout columns of a spatially partitioned catalog.
FINEST_ORDER = 29
PIXEL = "_healpix_29"
LAYOUT_COLUMNS = ("_healpix_29", "Norder", "Dir", "Npix")
PIXELS_PER_DIR = 10_000

ARCSEC_PER_RADIAN = 180.0 * 3600.0 / math.pi

# (shift, mask) pairs that move the bits of a 32-bit number to the even positions of 64 bits.
_SPREAD = (
    (16, 0x0000FFFF0000FFFF),
    (8, 0x00FF00FF00FF00FF),
    (4, 0x0F0F0F0F0F0F0F0F),
    (2, 0x3333333333333333),
    (1, 0x5555555555555555),
)


def chord(radius_arcsec: float) -> float:
    """Straight-line distance on the unit sphere for an angle."""
    return 2.0 * math.sin(radius_arcsec / ARCSEC_PER_RADIAN / 2.0)


def unit_vector(ra: Column, dec: Column) -> tuple[Column, Column, Column]:
    ra, dec = F.radians(ra.cast("double")), F.radians(dec.cast("double"))
    return F.cos(dec) * F.cos(ra), F.cos(dec) * F.sin(ra), F.sin(dec)


def with_unit_vector(df: DataFrame, ra: str, dec: str, names: tuple[str, str, str]) -> DataFrame:
    return df.withColumns(dict(zip(names, unit_vector(F.col(ra), F.col(dec)))))


def squared_chord(a: tuple[str, str, str], b: tuple[str, str, str]) -> Column:
    """Squared distance between two vectors given by column names."""
    dx, dy, dz = (F.col(p) - F.col(q) for p, q in zip(a, b))
    return dx * dx + dy * dy + dz * dz


def separation_arcsec(squared: Column) -> Column:
    """Angle for a squared chord; accurate for tiny separations."""
    return F.degrees(2.0 * F.asin(F.least(F.sqrt(squared) / 2.0, F.lit(1.0)))) * 3600.0


def ra_dec_of(x: Column, y: Column, z: Column) -> tuple[Column, Column]:
    """Position in degrees of a vector of any length."""
    return F.degrees(F.atan2(y, x)), F.degrees(F.atan2(z, F.hypot(x, y)))


def parent_pixel(pixel: Column, from_order: int, to_order: int) -> Column:
    return F.shiftright(pixel, 2 * (from_order - to_order))


def directory_of(pixel: Column) -> Column:
    """Directory number that groups pixels in a catalog's layout."""
    return (F.floor(pixel / PIXELS_PER_DIR) * PIXELS_PER_DIR).cast("long")


def settled(df: DataFrame, names: list[str], drop: list[str]) -> DataFrame:
    """Pass computed columns through a one-element ``inline``.

    Spark moves a filter below the projections that compute its columns by writing them out in
    full, which for these step-wise expressions grows without bound; it does not move filters
    below a generator.
    """
    kept = [c for c in df.columns if c not in names and c not in drop]
    return df.select(*kept, F.inline(F.array(F.struct(*names))))


def with_pixel(
    df: DataFrame,
    ra: str = "ra",
    dec: str = "dec",
    out: str = PIXEL,
    order: int = FINEST_ORDER,
    keep_face: bool = False,
) -> DataFrame:
    """Add the nested pixel number of a position; null where the position is null or NaN.

    With ``keep_face`` the base face and the position on it stay as ``_face, _ix, _iy``.
    """
    n = 1 << order
    ra_c, dec_c = F.col(ra).cast("double"), F.col(dec).cast("double")
    bad = ra_c.isNull() | dec_c.isNull() | F.isnan(ra_c) | F.isnan(dec_c)
    turn = F.pmod(ra_c, F.lit(360.0))
    staged = df.withColumns(
        {
            "_z": F.when(~bad, F.sin(F.radians(dec_c))),
            "_cos": F.cos(F.radians(dec_c)),
            "_quarter": F.when(turn >= 360.0, 0.0).otherwise(turn / 90.0),
        }
    )
    z, height, quarter = F.col("_z"), F.abs(F.col("_z")), F.col("_quarter")
    near_pole = F.col("_cos") / F.sqrt((1.0 + height) / 3.0)
    staged = staged.withColumns(
        {
            "_belt": height <= 2.0 / 3.0,
            "_cap": F.least(F.floor(quarter), F.lit(3)),
            "_scale": n * F.when(height > 0.99, near_pole).otherwise(F.sqrt(3.0 * (1.0 - height))),
        }
    )
    belt, cap = F.col("_belt"), F.col("_cap")
    within = quarter - cap
    last = F.lit(n - 1).cast("long")

    def diagonal(in_belt: Column, in_cap: Column) -> Column:
        return F.when(belt, F.floor(in_belt)).otherwise(F.least(last, F.floor(in_cap * F.col("_scale"))))

    staged = staged.withColumns(
        {
            "_rise": diagonal(n * (0.5 + quarter) - 0.75 * n * z, within),
            "_fall": diagonal(n * (0.5 + quarter) + 0.75 * n * z, 1.0 - within),
        }
    )
    rise, fall = F.col("_rise"), F.col("_fall")
    face_up, face_down = F.shiftright(rise, order), F.shiftright(fall, order)
    belt_face = (
        F.when(face_up == face_down, face_up.bitwiseOR(F.lit(4).cast("long")))
        .when(face_up < face_down, face_up)
        .otherwise(face_down + 8)
    )
    north = z > 0
    staged = staged.withColumns(
        {
            "_face": F.when(belt, belt_face).when(north, cap).otherwise(cap + 8),
            "_ix": F.when(belt, fall.bitwiseAND(last)).when(north, last - fall).otherwise(rise),
            "_iy": F.when(belt, last - rise.bitwiseAND(last)).when(north, last - rise).otherwise(fall),
        }
    )
    staged = staged.withColumns({"_sx": F.col("_ix"), "_sy": F.col("_iy")})
    for shift, mask in _SPREAD:
        staged = staged.withColumns(
            {
                name: F.col(name).bitwiseOR(F.shiftleft(name, shift)).bitwiseAND(F.lit(mask))
                for name in ("_sx", "_sy")
            }
        )
    pixel = F.shiftleft(F.col("_face"), 2 * order) + F.col("_sx") + F.shiftleft("_sy", 1)
    pixel = F.when(z.isNotNull(), pixel)
    drop = ["_z", "_cos", "_quarter", "_belt", "_cap", "_scale", "_rise", "_fall", "_sx", "_sy"]
    face = ["_face", "_ix", "_iy"]
    if not keep_face:
        drop += face
    return settled(staged.withColumn(out, pixel), [out, *face] if keep_face else [out], drop)


def with_face_position(df: DataFrame, pixel: str, order: str) -> DataFrame:
    """Split nested pixel numbers, each of its own order, into ``_face, _ix, _iy``."""
    inside = f"{pixel} & (shiftleft(1L, 2 * cast({order} as int)) - 1)"
    even = 0x5555555555555555
    staged = df.withColumns(
        {
            "_face": F.expr(f"shiftright({pixel}, 2 * cast({order} as int))"),
            "_ix": F.expr(f"({inside}) & {even}L"),
            "_iy": F.expr(f"shiftright({inside}, 1) & {even}L"),
        }
    )
    masks = [mask for _, mask in _SPREAD[:-1]][::-1] + [0x00000000FFFFFFFF]
    for shift, mask in zip((1, 2, 4, 8, 16), masks):
        staged = staged.withColumns(
            {
                name: F.col(name).bitwiseOR(F.shiftright(name, shift)).bitwiseAND(F.lit(mask))
                for name in ("_ix", "_iy")
            }
        )
    return settled(staged, ["_face", "_ix", "_iy"], [])


# Fixed values of the pixel scheme: ring and longitude index of each base face.
_FACE_RING = (2, 2, 2, 2, 3, 3, 3, 3, 4, 4, 4, 4)
_FACE_LONGITUDE = (1, 3, 5, 7, 0, 2, 4, 6, 1, 3, 5, 7)


def with_face_vector(
    df: DataFrame, face: str, x: Column, y: Column, n: Column, names: tuple[str, str, str]
) -> DataFrame:
    """Unit vector of the point (x, y), each in [0, n], on a base face of n × n pixels."""
    index = F.col(face).cast("int") + 1
    rings = F.element_at(F.array([F.lit(v) for v in _FACE_RING]), index)
    longitudes = F.element_at(F.array([F.lit(v) for v in _FACE_LONGITUDE]), index)
    staged = df.withColumns({"_n": n.cast("double"), "_jr": rings * n - x - y, "_dxy": x - y})
    n, ring = F.col("_n"), F.col("_jr")
    north, south = ring < n, ring > 3 * n
    staged = staged.withColumn("_nr", F.when(north, ring).when(south, 4 * n - ring).otherwise(n))
    nr = F.col("_nr")
    cap_height = 1.0 - nr * nr / (3.0 * n * n)
    staged = staged.withColumns(
        {
            "_height": F.when(north, cap_height)
            .when(south, -cap_height)
            .otherwise(2.0 * (2.0 * n - ring) / (3.0 * n)),
            "_phi": F.when(nr > 0, F.lit(math.pi / 4.0) * (longitudes * nr + F.col("_dxy")) / F.nullif(nr, F.lit(0.0)))
            .otherwise(0.0),
        }
    )
    height = F.col("_height")
    radius = F.when(north | south, nr / n * F.sqrt((1.0 + F.abs(height)) / 3.0)).otherwise(
        F.sqrt(1.0 - height * height)
    )
    vector = (radius * F.cos("_phi"), radius * F.sin("_phi"), height)
    done = staged.withColumns(dict(zip(names, vector)))
    return settled(done, list(names), ["_n", "_jr", "_dxy", "_nr", "_height", "_phi"])


def pixel_width_arcsec(order: int) -> float:
    """Square root of a pixel's area."""
    return math.sqrt(4.0 * math.pi / 12.0) / (1 << order) * ARCSEC_PER_RADIAN


def pixel_reach(n: Column) -> Column:
    """Upper bound, in radians, of the distance from a pixel's centre to its points.

    The farthest corner lies 0.85/n to 1.07/n away, depending on the resolution.
    """
    return 1.1 / n
