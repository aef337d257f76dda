"""Directions on the sky, regions, and the map between sky and pixels, as columns."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def unit_vector(ra: Column, dec: Column) -> tuple[Column, Column, Column]:
    """Unit vector of a position in degrees."""
    a, d = F.radians(ra), F.radians(dec)
    return F.cos(d) * F.cos(a), F.cos(d) * F.sin(a), F.sin(d)


def chord(p: tuple[Column, ...], q: tuple[Column, ...]) -> Column:
    """Length of the straight line between two unit vectors."""
    return F.sqrt(sum(((a - b) * (a - b) for a, b in zip(p, q, strict=True)), F.lit(0.0)))


def ra_difference(a: Column, b: Column) -> Column:
    """a - b wrapped to [-180, 180), rounded step by step as in SQL that has no ``pmod``: near-equal scores then rank alike."""
    return ((a - b + 180.0) % 360.0 + 360.0) % 360.0 - 180.0


def separation_cos(ra: Column, dec: Column, ra0: float, dec0: float) -> Column:
    x, y, z = unit_vector(ra, dec)
    c = vector(ra0, dec0)
    return x * float(c[0]) + y * float(c[1]) + z * float(c[2])


def in_cone(ra: Column, dec: Column, ra0: float, dec0: float, radius: float) -> Column:
    """Within ``radius`` degrees of a centre, the edge included."""
    return separation_cos(ra, dec, ra0, dec0) >= math.cos(math.radians(radius))


# --- regions: a handful of vertices per visit, worked out on the driver ------------------------------------------


def vector(ra: float, dec: float) -> np.ndarray:
    a, d = math.radians(ra), math.radians(dec)
    return np.array([math.cos(d) * math.cos(a), math.cos(d) * math.sin(a), math.sin(d)])


@dataclass(frozen=True)
class Polygon:
    """A convex polygon of unit vectors, counter-clockwise seen from outside the sphere."""

    corners: tuple[tuple[float, float, float], ...]

    @classmethod
    def of_degrees(cls, corners: list[tuple[float, float]]) -> Polygon:
        return cls.hull([vector(*c) for c in corners])

    @classmethod
    def hull(cls, vectors: list[np.ndarray]) -> Polygon:
        """Convex hull, taken in the tangent plane at the centroid."""
        v = np.array(vectors, dtype=float)
        c = v.sum(axis=0) / np.linalg.norm(v.sum(axis=0))
        east = np.cross([0.0, 0.0, 1.0], c)
        east = east / np.linalg.norm(east) if np.linalg.norm(east) > 1e-12 else np.array([1.0, 0.0, 0.0])
        north = np.cross(c, east)
        flat = sorted((float(p @ east / (p @ c)), float(p @ north / (p @ c)), i) for i, p in enumerate(v))

        def half(points):
            out: list[tuple[float, float, int]] = []
            for p in points:
                while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                    out.pop()
                out.append(p)
            return out[:-1]

        return cls(tuple(tuple(float(x) for x in v[i]) for _, _, i in half(flat) + half(flat[::-1])))

    @property
    def centre(self) -> np.ndarray:
        c = np.sum(self.corners, axis=0)
        return c / np.linalg.norm(c)

    def normals(self) -> list[np.ndarray]:
        v = [np.array(c) for c in self.corners]
        return [np.cross(a, b) for a, b in zip(v, v[1:] + v[:1], strict=True)]

    def contains(self, ra: Column, dec: Column) -> Column:
        """On the inner side of every edge."""
        x, y, z = unit_vector(ra, dec)
        inside = F.lit(True)
        for n in self.normals():
            inside = inside & (x * float(n[0]) + y * float(n[1]) + z * float(n[2]) >= 0)
        return inside

    def padded(self, margin_arcsec: float) -> Polygon:
        """Every corner moved away from the centre by margin times the square root of two, then the hull."""
        out, c, step = [], self.centre, math.radians(margin_arcsec / 3600) * math.sqrt(2)
        for corner in self.corners:
            v = np.array(corner)
            away = v - (v @ c) * c
            away = away / np.linalg.norm(away)
            angle = math.atan2(np.linalg.norm(np.cross(c, v)), float(v @ c)) + step
            out.append(math.cos(angle) * c + math.sin(angle) * away)
        return Polygon.hull(out)

    def bounding_circle(self) -> tuple[float, float, float]:
        """ra, dec and radius in degrees of a circle around the centre that holds all corners."""
        c = self.centre
        radius = max(math.degrees(math.atan2(np.linalg.norm(np.cross(c, v)), float(np.array(v) @ c))) for v in self.corners)
        return math.degrees(math.atan2(c[1], c[0])) % 360, math.degrees(math.asin(c[2])), radius


@dataclass(frozen=True)
class Box:
    """Whole pixels, both ends included; a point belongs to the pixel whose centre is nearest."""

    min_x: int
    min_y: int
    max_x: int
    max_y: int

    def grown(self, by: int) -> Box:
        return Box(self.min_x - by, self.min_y - by, self.max_x + by, self.max_y + by)

    def contains(self, x: Column, y: Column) -> Column:
        return (x >= self.min_x - 0.5) & (x < self.max_x + 0.5) & (y >= self.min_y - 0.5) & (y < self.max_y + 0.5)


@dataclass(frozen=True)
class Wcs:
    """A tangent-plane (TAN) or orthographic (SIN) projection with a linear pixel grid (reference pixel, CD matrix in degrees)."""

    crval: tuple[float, float]
    crpix: tuple[float, float]
    cd: tuple[tuple[float, float], tuple[float, float]]
    kind: str = "TAN"

    def sky_to_pixel(self, ra: Column, dec: Column) -> tuple[Column, Column]:
        a, d = F.radians(ra - self.crval[0]), F.radians(dec)
        s, c = math.sin(math.radians(self.crval[1])), math.cos(math.radians(self.crval[1]))
        depth = s * F.sin(d) + c * F.cos(d) * F.cos(a)
        over = depth if self.kind == "TAN" else F.lit(1.0)
        seen = F.when(depth > 0, over)  # the far side of the sky has no pixel
        xi, eta = F.degrees(F.cos(d) * F.sin(a) / seen), F.degrees((c * F.sin(d) - s * F.cos(d) * F.cos(a)) / seen)
        (p, q), (r, t) = self.cd
        det = p * t - q * r
        return (t * xi - q * eta) / det + self.crpix[0], (p * eta - r * xi) / det + self.crpix[1]

    def pixel_to_sky(self, x: Column, y: Column) -> tuple[Column, Column]:
        (p, q), (r, t) = self.cd
        u, v = x - self.crpix[0], y - self.crpix[1]
        xi, eta = F.radians(p * u + q * v), F.radians(r * u + t * v)
        s, c = math.sin(math.radians(self.crval[1])), math.cos(math.radians(self.crval[1]))
        depth = F.lit(1.0) if self.kind == "TAN" else F.sqrt(1 - xi * xi - eta * eta)
        ra = F.pmod(self.crval[0] + F.degrees(F.atan2(xi, depth * c - eta * s)), F.lit(360.0))
        norm = F.sqrt(xi * xi + eta * eta + depth * depth)
        return ra, F.degrees(F.asin((depth * s + eta * c) / norm))

    def corners(self, box: Box) -> Polygon:
        """The region of a box: its four corners on the sky."""
        out = []
        (p, q), (r, t) = self.cd
        s, c = math.sin(math.radians(self.crval[1])), math.cos(math.radians(self.crval[1]))
        for x, y in ((box.min_x, box.min_y), (box.max_x, box.min_y), (box.max_x, box.max_y), (box.min_x, box.max_y)):
            u, v = x - self.crpix[0], y - self.crpix[1]
            xi, eta = math.radians(p * u + q * v), math.radians(r * u + t * v)
            depth = 1.0 if self.kind == "TAN" else math.sqrt(1 - xi * xi - eta * eta)
            ra = self.crval[0] + math.degrees(math.atan2(xi, depth * c - eta * s))
            out.append((ra % 360, math.degrees(math.asin((depth * s + eta * c) / math.sqrt(xi * xi + eta * eta + depth * depth)))))
        return Polygon.of_degrees(out)

    def local_matrix(self, x: Column, y: Column) -> Column:
        """Change of ra and dec, in degrees, per pixel of x and of y around a point: [ra by x, ra by y, dec by x, dec by y]."""
        half = 0.5
        (ra_r, dec_r), (ra_l, dec_l) = self.pixel_to_sky(x + half, y), self.pixel_to_sky(x - half, y)
        (ra_u, dec_u), (ra_d, dec_d) = self.pixel_to_sky(x, y + half), self.pixel_to_sky(x, y - half)
        return F.array(ra_difference(ra_r, ra_l), ra_difference(ra_u, ra_d), dec_r - dec_l, dec_u - dec_d)


def pixel_scale(cd: tuple[Column, Column, Column, Column]) -> Column:
    """Arcseconds per pixel from the four CD columns in degrees: the square root of the area of a pixel."""
    a, b, c, d = cd
    return F.sqrt(F.abs(a * d - b * c)) * 3600.0


def position_angle(angle: Column, cd: tuple[Column, Column, Column, Column]) -> Column:
    """Angle east of north in degrees [0, 360) of a direction given in radians from the x axis of the detector."""
    a, b, c, d = cd
    east, north = a * F.cos(angle) + b * F.sin(angle), c * F.cos(angle) + d * F.sin(angle)
    return F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0))
