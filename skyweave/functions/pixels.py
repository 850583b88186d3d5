"""Pixel geometry on numpy arrays: outlines, exact distances and coverage of cones.

The same scheme as in ``sky``; used on the driver for a few cones and inside tasks for the rows near
a pixel's edge, where the distance to a curved edge needs iteration.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable

import numpy as np

from skyweave.functions.sky import FINEST_ORDER

# Fixed values of the pixel scheme: ring and longitude index of each base face.
_RING = np.array((2, 2, 2, 2, 3, 3, 3, 3, 4, 4, 4, 4))
_LONGITUDE = np.array((1, 3, 5, 7, 0, 2, 4, 6, 1, 3, 5, 7))

# Upper bound of the distance from a pixel's centre to its points, times the pixels along a face.
REACH = 1.1

# Points tried along an edge, and how often the best one's surroundings are tried again.
_POINTS, _ZOOMS = 17, 7


def split_pixel(pixel: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(face, x, y) of nested pixel numbers of given orders."""
    pixel, order = np.asarray(pixel, np.int64), np.asarray(order, np.int64)
    face = pixel >> (2 * order)
    inside = pixel - (face << (2 * order))
    x, y = np.zeros_like(inside), np.zeros_like(inside)
    for bit in range(FINEST_ORDER):
        x |= ((inside >> (2 * bit)) & 1) << bit
        y |= ((inside >> (2 * bit + 1)) & 1) << bit
    return face, x, y


def face_vector(face: np.ndarray, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Unit vectors, last axis 3, of points (x, y), each in [0, n], on base faces of n x n pixels."""
    ring = _RING[face] * n - x - y
    north, south = ring < n, ring > 3 * n
    nr = np.where(north, ring, np.where(south, 4 * n - ring, n))
    cap = 1.0 - nr * nr / (3.0 * n * n)
    height = np.where(north, cap, np.where(south, -cap, 2.0 * (2.0 * n - ring) / (3.0 * n)))
    with np.errstate(all="ignore"):
        phi = np.where(nr > 0, math.pi / 4.0 * (_LONGITUDE[face] * nr + x - y) / nr, 0.0)
    flat = np.where(north | south, nr / n * np.sqrt((1.0 + np.abs(height)) / 3.0), np.sqrt(np.maximum(1.0 - height * height, 0.0)))
    return np.stack([flat * np.cos(phi), flat * np.sin(phi), height], -1)


def edge_distance(vector: np.ndarray, pixel: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Angle in radians from each unit vector to the outline of a pixel.

    Every edge is tried at some points and then ever closer round the best of them; edges are far
    straighter than the steps of the first round, so no nearer stretch is overlooked.
    """
    face, x, y = split_pixel(pixel, order)
    n = np.left_shift(1, np.asarray(order, np.int64)).astype(np.float64)
    best = np.full(len(x), np.inf)
    steps = np.linspace(0.0, 1.0, _POINTS)
    for along_x, at in ((True, 0), (True, 1), (False, 0), (False, 1)):
        low, width = np.zeros(len(x)), np.ones(len(x))
        for _ in range(_ZOOMS):
            t = low[:, None] + width[:, None] * steps
            px = x[:, None] + (t if along_x else at)
            py = y[:, None] + (at if along_x else t)
            points = face_vector(np.broadcast_to(face[:, None], t.shape), px, py, n[:, None])
            chords = np.sqrt(((points - vector[:, None, :]) ** 2).sum(-1))
            k = chords.argmin(1)
            nearest = t[np.arange(len(k)), k]
            width = width * (2.0 / (_POINTS - 1))
            low = np.clip(nearest - width / 2.0, 0.0, 1.0 - width)
        best = np.minimum(best, chords.min(1))
    return 2.0 * np.arcsin(np.minimum(best / 2.0, 1.0))


# Points of the first look at an edge, and by how much a stretch of it may exceed its chord.
_LOOK, _BEND = 9, 1.05


def near_edge(vector: np.ndarray, pixel: np.ndarray, order: np.ndarray, angle: float) -> np.ndarray:
    """Whether the outline of a pixel lies within an angle of each unit vector: ``edge_distance <= angle``.

    A corner or a few points of the edges mostly tell: one within the angle, or all farther by more than
    the stretches between them could bend. Only for the rest the distance itself is found.
    """
    near, open_rows = np.zeros(len(pixel), bool), np.arange(len(pixel))
    for points in (2, _LOOK):
        nearest, bound = _first_look(vector[open_rows], pixel[open_rows], order[open_rows], points)
        hit, miss = nearest <= angle * (1.0 - 1e-9), bound > angle * (1.0 + 1e-9)
        near[open_rows[hit]] = True
        open_rows = open_rows[~hit & ~miss if points == _LOOK else ~hit]
    near[open_rows] = edge_distance(vector[open_rows], pixel[open_rows], order[open_rows]) <= angle
    return near


def _first_look(vector: np.ndarray, pixel: np.ndarray, order: np.ndarray, points: int) -> tuple[np.ndarray, np.ndarray]:
    """Angles to the nearest of some points round each outline, and below the angle to any of its points."""
    face, x, y = split_pixel(pixel, order)
    n = np.left_shift(1, np.asarray(order, np.int64)).astype(np.float64)
    t = np.linspace(0.0, 1.0, points)[:-1]
    zero, one = np.zeros_like(t), np.ones_like(t)
    px = x[:, None] + np.concatenate([t, one, 1.0 - t, zero])
    py = y[:, None] + np.concatenate([zero, t, one, 1.0 - t])
    outline = face_vector(np.broadcast_to(face[:, None], px.shape), px, py, n[:, None])
    angles = 2.0 * np.arcsin(np.minimum(np.sqrt(((outline - vector[:, None, :]) ** 2).sum(-1)) / 2.0, 1.0))
    steps = 2.0 * np.arcsin(np.minimum(np.sqrt(((outline - np.roll(outline, -1, 1)) ** 2).sum(-1)) / 2.0, 1.0))
    below = (angles + np.roll(angles, -1, 1) - _BEND * steps) / 2.0
    return angles.min(1), below.min(1)


def cone_pixels(ra: float, dec: float, radius_arcsec: float, most: int = 256) -> list[tuple[int, int]]:
    """(order, pixel) of disjoint pixels that together hold a cone; never misses a point.

    The coarsest pixel on the cone's edge is cut into four, and what lies outside dropped, until there
    are ``most`` pixels or the pixels on the edge are far smaller than the cone.
    """
    radius = min(radius_arcsec / 3600.0, 180.0) * math.pi / 180.0
    centre = _vector(ra, dec)
    finest = min(FINEST_ORDER, max(0, math.ceil(math.log2(32.0 * REACH / max(radius, 1e-12)))))
    inner: list[tuple[int, int]] = []
    border: list[tuple[int, int]] = []

    def place(order: int, pixels: np.ndarray) -> None:
        n = float(1 << order)
        face, x, y = split_pixel(pixels, np.full(len(pixels), order))
        middle = face_vector(face, x + 0.5, y + 0.5, np.full(len(pixels), n))
        angle = 2.0 * np.arcsin(np.minimum(np.sqrt(((middle - centre) ** 2).sum(-1)) / 2.0, 1.0))
        reach = REACH / n
        for pixel, far in zip(pixels.tolist(), angle.tolist()):
            if far + reach <= radius:
                inner.append((order, pixel))
            elif far - reach <= radius + 1e-9:
                heapq.heappush(border, (order, pixel))

    place(0, np.arange(12))
    while border and border[0][0] < finest and len(inner) + len(border) + 3 <= most:
        order, pixel = heapq.heappop(border)
        place(order + 1, np.arange(4 * pixel, 4 * pixel + 4))
    return sorted(inner + border)


def _vector(ra: float, dec: float) -> np.ndarray:
    ra, dec = math.radians(ra), math.radians(dec)
    return np.array([math.cos(dec) * math.cos(ra), math.cos(dec) * math.sin(ra), math.sin(dec)])


def coverage(cones: Iterable[tuple[float, float, float]], most: int = 64) -> list[tuple[int, int]]:
    """Sorted ranges [low, high) of finest-order pixels that hold all cones (ra, dec, radius in arcsec).

    At most ``most`` ranges: those with the smallest gaps between them are joined, so the ranges may
    hold more than the cones but never less.
    """
    spans = []
    for ra, dec, radius in cones:
        for order, pixel in cone_pixels(ra, dec, radius):
            shift = 2 * (FINEST_ORDER - order)
            spans.append((pixel << shift, (pixel + 1) << shift))
    ranges: list[list[int]] = []
    for low, high in sorted(spans):
        if ranges and low <= ranges[-1][1]:
            ranges[-1][1] = max(ranges[-1][1], high)
        else:
            ranges.append([low, high])
    gaps = sorted((b[0] - a[1] for a, b in zip(ranges, ranges[1:])), reverse=True)[: most - 1]
    least = gaps[-1] if len(gaps) == most - 1 and gaps else 0
    joined: list[list[int]] = []
    left = most - 1
    for low, high in ranges:
        if joined and (low - joined[-1][1] < least or left == 0):
            joined[-1][1] = high
        else:
            left -= bool(joined)
            joined.append([low, high])
    return [(low, high) for low, high in joined]
