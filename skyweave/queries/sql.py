"""SQL for the derived tables and for the geometry, written independently of the library."""

from __future__ import annotations

FIELDS = {
    "ECDFS": (53.13, -28.10),
    "EDFS": (59.10, -48.73),
    "SV_38_7": (37.86, 6.98),
    "SV_95_-25": (95.00, -25.00),
    "47_Tuc": (6.02, -72.08),
    "Fornax_dSph": (40.00, -34.45),
}

_SCATTERED = "({k}::DOUBLE * 137.50776405::DOUBLE) % 360 AS ra, ({k}::DOUBLE * 73.13::DOUBLE) % 180 - 90 AS dec"


def position(key: str) -> str:
    return _SCATTERED.format(k=key)


def mjd(column: str) -> str:
    return (
        f"(date_diff('day', DATE '1858-11-17', {column}::DATE)"
        f" + (epoch_us({column}) % 86400000000)::DOUBLE / 86400000000::DOUBLE)"
    )


def band(number: str) -> str:
    return f"substr('ugrizy', ({number} % 6)::INTEGER + 1, 1)"


OBJECTS = f"SELECT o_orderkey AS objectId, {position('o_orderkey')} FROM orders"

CROWDED = f"""
SELECT objectId,
       CASE WHEN objectId % 3 = 0 THEN 40::DOUBLE + (objectId % 97) * 0.01::DOUBLE ELSE ra END AS ra,
       CASE WHEN objectId % 3 = 0 THEN 10::DOUBLE + (objectId % 89) * 0.01::DOUBLE ELSE dec END AS dec
FROM ({OBJECTS})"""

FORCED = f"""
SELECT l_orderkey AS objectId, l_partkey AS sourceId, l_suppkey AS visit,
       l_linenumber::BIGINT AS detector, {band('l_linenumber')} AS band,
       {mjd('l_shipdate')} AS midpointMjdTai, l_extendedprice AS psfFlux,
       l_extendedprice * l_tax AS psfFluxErr, l_extendedprice - 50000::DOUBLE AS psfDiffFlux,
       l_extendedprice * l_discount AS psfDiffFluxErr, l_quantity AS quantity
FROM lineitem"""

FORCED_TIES = "sourceId, visit, detector, quantity, psfFlux, psfFluxErr, psfDiffFluxErr"

DETECTIONS = f"""
SELECT user_id AS objectId, event_id AS detectionId, event_type AS band,
       {mjd('ts')} AS midpointMjdTai, value AS psfFlux
FROM events"""

VISITS = "SELECT s_suppkey AS visitId, 60600::DOUBLE + s_suppkey % 100 + 0.5::DOUBLE AS expMidptMJD FROM supplier"

VISIT_DETECTORS = f"""
SELECT s_suppkey AS visitId, detector, s_acctbal / 10::DOUBLE AS skyBg,
       CASE WHEN (s_suppkey + detector) % 5 <> 0
            THEN 0.6::DOUBLE + ((s_suppkey + detector) % 7) * 0.125::DOUBLE END AS seeing,
       15::DOUBLE + (s_suppkey % 2) * 15::DOUBLE AS expTime, {band('s_suppkey')} AS band
FROM supplier, (SELECT unnest(range(1, 8)) AS detector)"""

DETECTORS = """
SELECT DISTINCT l_linenumber::BIGINT AS detector, (l_linenumber - 4)::DOUBLE AS x,
       (l_linenumber % 3 - 1)::DOUBLE AS y
FROM lineitem"""

SURVEY = f"""
SELECT objectid, ra, dec + CASE WHEN objectid % 2 = 0 THEN 0.05::DOUBLE / 3600 ELSE 0.5::DOUBLE / 3600 END AS dec
FROM (SELECT c_custkey AS objectid, {position('c_custkey')} FROM customer)"""

SIGNED = """
SELECT c_custkey AS objectId,
       CASE WHEN c_custkey % 11 = 0 THEN 0::DOUBLE WHEN c_custkey % 13 <> 0 THEN c_acctbal END AS psfFlux,
       CASE WHEN c_custkey % 7 = 0 THEN abs(c_acctbal) ELSE (c_custkey % 50) * 10::DOUBLE END AS psfFluxErr,
       c_acctbal * 2 AS kronFlux
FROM customer"""


def magnitude(flux: str) -> str:
    return (
        f"CASE WHEN {flux} > 0 THEN -2.5::DOUBLE * log10({flux}) + 31.4::DOUBLE"
        f" WHEN {flux} = 0 THEN 'infinity'::DOUBLE END"
    )


def magnitude_error(flux: str, error: str) -> str:
    faint, bright = magnitude(f"({flux} - {error})"), magnitude(f"({flux} + {error})")
    span = f"(({faint}) - ({bright})) / 2"
    return f"CASE WHEN NOT isnan({span}) THEN {span} END"


def separation(ra1: str, dec1: str, ra2: str, dec2: str) -> str:
    """Haversine angle in degrees."""
    return (
        f"degrees(2 * asin(least(1, sqrt(pow(sin(radians({dec1} - ({dec2})) / 2), 2)"
        f" + cos(radians({dec1})) * cos(radians({dec2})) * pow(sin(radians({ra1} - ({ra2})) / 2), 2)))))"
    )


def fields() -> str:
    rows = ", ".join(f"('{name}', {ra}::DOUBLE, {dec}::DOUBLE)" for name, (ra, dec) in FIELDS.items())
    return f"SELECT * FROM (VALUES {rows}) AS f(field, ra0, dec0)"


def pixels(order: int, source: str) -> str:
    """``source`` with the nested pixel of ``ra, dec``, computed directly at the given order."""
    n = 1 << order

    def bits(v: str) -> str:
        return " + ".join(f"((({v}) >> {b}) & 1) * {4**b}::BIGINT" for b in range(order)) or "0"

    return f"""
SELECT * EXCLUDE (z, tt, cd, belt, nt, sc, jp, jm, face, ix, iy),
       face * {n * n}::BIGINT + ({bits('ix')}) + 2 * ({bits('iy')}) AS pixel
FROM (SELECT *,
             CASE WHEN belt THEN CASE WHEN jp // {n} = jm // {n} THEN CASE WHEN jp // {n} = 4 THEN 4 ELSE jp // {n} + 4 END
                                      WHEN jp // {n} < jm // {n} THEN jp // {n} ELSE jm // {n} + 8 END
                  WHEN z > 0 THEN nt ELSE nt + 8 END AS face,
             CASE WHEN belt THEN jm % {n} WHEN z > 0 THEN {n} - jm - 1 ELSE jp END AS ix,
             CASE WHEN belt THEN {n} - (jp % {n}) - 1 WHEN z > 0 THEN {n} - jp - 1 ELSE jm END AS iy
      FROM (SELECT *,
                   CASE WHEN belt THEN floor({n} * (0.5::DOUBLE + tt) - 0.75::DOUBLE * {n} * z)::BIGINT
                        ELSE least({n} - 1, floor((tt - nt) * sc))::BIGINT END AS jp,
                   CASE WHEN belt THEN floor({n} * (0.5::DOUBLE + tt) + 0.75::DOUBLE * {n} * z)::BIGINT
                        ELSE least({n} - 1, floor((1 - (tt - nt)) * sc))::BIGINT END AS jm
            FROM (SELECT *, abs(z) <= 2::DOUBLE / 3 AS belt, least(3, floor(tt))::BIGINT AS nt,
                         {n} * CASE WHEN abs(z) > 0.99::DOUBLE THEN cd / sqrt((1 + abs(z)) / 3)
                                    ELSE sqrt(3 * (1 - abs(z))) END AS sc
                  FROM (SELECT *, sin(radians(dec)) AS z, cos(radians(dec)) AS cd,
                               ((ra % 360 + 360) % 360) / 90 AS tt FROM ({source})))))"""


# Ring and longitude index of each base face of the pixel scheme, as lists.
_FACE_RING, _FACE_LONGITUDE = "[2, 2, 2, 2, 3, 3, 3, 3, 4, 4, 4, 4]", "[1, 3, 5, 7, 0, 2, 4, 6, 1, 3, 5, 7]"


def _face_point(source: str) -> str:
    """``source`` (face, n, px, py and more) with the unit vector qx, qy, qz of that point of a face."""
    return f"""
SELECT * EXCLUDE (jr, nr, h, ph, fl), fl * cos(ph) AS qx, fl * sin(ph) AS qy, h AS qz
FROM (SELECT *, CASE WHEN nr > 0 THEN pi() / 4 * ({_FACE_LONGITUDE}[face + 1] * nr + px - py) / nr ELSE 0 END AS ph,
             CASE WHEN jr < n OR jr > 3 * n THEN nr / n * sqrt((1 + abs(h)) / 3) ELSE sqrt(greatest(1 - h * h, 0)) END AS fl
      FROM (SELECT *, CASE WHEN jr < n THEN 1 - nr * nr / (3 * n * n) WHEN jr > 3 * n THEN nr * nr / (3 * n * n) - 1
                           ELSE 2 * (2 * n - jr) / (3 * n) END AS h
            FROM (SELECT *, CASE WHEN jr < n THEN jr WHEN jr > 3 * n THEN 4 * n - jr ELSE n END AS nr
                  FROM (SELECT *, {_FACE_RING}[face + 1] * n - px - py AS jr FROM ({source})))))"""


def margins(rows: str, partitions: str, threshold_arcsec: float) -> str:
    """CTEs up to ``margin`` (objectId, Norder, Npix): rows within the threshold of a partition they are not in.

    ``rows`` has objectId, ra, dec and the own o, p; ``partitions`` has Norder, Npix. The outline of every
    near partition is tried at 33 points an edge, and then four times closer round the nearest ones.
    """
    angle = threshold_arcsec / 3600 * 3.141592653589793 / 180
    even = lambda v: " + ".join(f"((({v}) >> {2 * b}) & 1) * {1 << b}" for b in range(12))
    spread = "(2 * asin(least(1, sqrt(pow(qx - vx, 2) + pow(qy - vy, 2) + pow(qz - vz, 2)) / 2)))"
    points = lambda source, width: f"""
SELECT *, CASE e WHEN 0 THEN x + t WHEN 1 THEN x + t WHEN 2 THEN x ELSE x + 1 END AS px,
       CASE e WHEN 0 THEN y WHEN 1 THEN y + 1 ELSE y + t END AS py
FROM (SELECT * EXCLUDE (c, d), greatest(0, least(1, c + {width!r}::DOUBLE * s / 32)) AS t FROM ({source}), (SELECT unnest(range(-16, 17)) AS s))"""  # noqa: E731
    best = lambda source: f"""
SELECT k, any_value(objectId) AS objectId, any_value(Norder) AS Norder, any_value(Npix) AS Npix, any_value(vx) AS vx, any_value(vy) AS vy,
       any_value(vz) AS vz, any_value(face) AS face, any_value(n) AS n, any_value(x) AS x, any_value(y) AS y, e, arg_min(t, d) AS c, min(d) AS d
FROM (SELECT *, {spread} AS d FROM ({_face_point(source)})) GROUP BY k, e"""  # noqa: E731
    steps = [f"z1 AS ({best(points('SELECT *, 0.5::DOUBLE AS c, 0 AS d FROM q, (SELECT unnest(range(4)) AS e)', 1.0))})"]
    for level in range(2, 6):
        keep = f"SELECT * FROM z{level - 1} WHERE d <= {angle!r}::DOUBLE + {3.0 / 16 ** (level - 2)!r}::DOUBLE / n"
        steps.append(f"z{level} AS ({best(points(keep, 2.0 / 16 ** (level - 1)))})")
    return f"""
     a AS (SELECT *, cos(radians(dec)) * cos(radians(ra)) AS vx, cos(radians(dec)) * sin(radians(ra)) AS vy, sin(radians(dec)) AS vz FROM ({rows})),
     b AS (SELECT *, Npix >> (2 * Norder) AS face, (1 << Norder)::DOUBLE AS n, Npix & ((1::BIGINT << (2 * Norder)) - 1) AS inside FROM ({partitions})),
     f AS (SELECT Norder, Npix, face, n, ({even('inside')})::DOUBLE AS x, ({even('inside >> 1')})::DOUBLE AS y FROM b),
     g AS ({_face_point('SELECT *, x + 0.5 AS px, y + 0.5 AS py FROM f')}),
     q AS (SELECT row_number() OVER () AS k, objectId, vx, vy, vz, Norder, Npix, face, n, x, y FROM a, g
           WHERE (a.o <> g.Norder OR a.p <> g.Npix) AND {spread} <= {angle!r}::DOUBLE + 1.1::DOUBLE / n),
     {', '.join(steps)},
     margin AS (SELECT k, any_value(objectId) AS objectId, any_value(Norder)::INTEGER AS Norder, any_value(Npix) AS Npix FROM z5
                WHERE d <= {angle!r}::DOUBLE GROUP BY k)"""
