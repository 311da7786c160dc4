"""Geometry without libraries: pixel-centre tests and geodesic areas."""

from __future__ import annotations

import json
import math
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: WGS84: equatorial radius in metres and first eccentricity squared.
RADIUS, ECCENTRICITY2 = 6_378_137.0, 0.00669437999014


def rings(geometry: dict) -> list[list[tuple[float, float]]]:
    """All rings of a GeoJSON geometry, feature or collection, closed."""
    kind = geometry.get("type")
    if kind == "FeatureCollection":
        return [r for f in geometry["features"] for r in rings(f)]
    if kind == "Feature" or "geometry" in geometry:
        return rings(geometry["geometry"])
    if kind == "GeometryCollection":
        return [r for g in geometry["geometries"] for r in rings(g)]
    if kind not in ("Polygon", "MultiPolygon"):
        raise ValueError(f"no area in a {kind}")
    found = geometry["coordinates"] if kind == "Polygon" else [r for p in geometry["coordinates"] for r in p]
    out = []
    for r in found:
        points = [(float(p[0]), float(p[1])) for p in r]
        if len(points) >= 3:
            out.append(points if points[0] == points[-1] else [*points, points[0]])
    return out


def from_wkb(text: str) -> dict:
    """A GeoJSON polygon or multipolygon of well-known binary, as hexadecimal digits; further dimensions are dropped."""
    data, at = bytes.fromhex(text), 0

    def read(form: str, order: str) -> tuple:
        nonlocal at
        found = struct.unpack_from(order + form, data, at)
        at += struct.calcsize(order + form)
        return found

    def shape() -> tuple[str, list]:
        order = "<" if read("b", "<")[0] else ">"
        (kind,) = read("I", order)
        dims = 2 + bool(kind & 0x80000000 or kind % 0x20000000 // 1000 in (1, 3)) + bool(kind & 0x40000000 or kind % 0x20000000 // 1000 in (2, 3))
        if kind & 0x20000000:
            read("I", order)  # the reference system
        (n,) = read("I", order)
        if kind % 1000 == 3:
            return "Polygon", [[list(read(f"{dims}d", order)[:2]) for _ in range(read("I", order)[0])] for _ in range(n)]
        if kind % 1000 == 6:
            return "MultiPolygon", [shape()[1] for _ in range(n)]
        raise ValueError(f"no area in well-known binary of type {kind % 1000}")

    kind, coordinates = shape()
    return {"type": kind, "coordinates": coordinates}


def parse(text: str) -> dict:
    """A geometry given as GeoJSON text or as hexadecimal well-known binary."""
    return json.loads(text) if text.lstrip().startswith("{") else from_wkb(text.strip())


def holds_centre(geometry: dict, x0: float, y0: float, resolution: float) -> bool:
    """Whether any centre (x0 + i * resolution, y0 - j * resolution) lies within, row by row, until one is found."""
    e = np.array(edges(geometry))
    _, low, _, high = bounds(geometry)
    for j in range(math.ceil((y0 - high) / resolution), math.floor((y0 - low) / resolution) + 1):
        y = y0 - j * resolution
        own = e[(e[:, 1] > y) != (e[:, 3] > y)]
        x = np.sort((own[:, 2] - own[:, 0]) * (y - own[:, 1]) / (own[:, 3] - own[:, 1]) + own[:, 0])
        # A centre lies within from an odd crossing up to the next one.
        first = np.ceil((x[0::2] - x0) / resolution)
        if (first * resolution + x0 < x[1::2]).any():
            return True
    return False


def edges(geometry: dict) -> list[tuple[float, float, float, float]]:
    """(x1, y1, x2, y2) of each edge."""
    return [(*p, *q) for r in rings(geometry) for p, q in zip(r, r[1:], strict=False) if p != q]


def bounds(geometry: dict) -> tuple[float, float, float, float]:
    points = [p for r in rings(geometry) for p in r]
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    return min(xs), min(ys), max(xs), max(ys)


def inside(x: Column, y: Column, edge_array: Column) -> Column:
    """Even-odd rule: whether a ray to the right crosses an odd number of edges.

    ``edge_array`` is an array of structs (x1, y1, x2, y2); holes are edges
    like any other.  Stays in the JVM.
    """

    def crossed(e: Column) -> Column:
        return ((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"])

    return F.size(F.filter(edge_array, crossed)) % 2 == 1


def _authalic(lat: np.ndarray) -> np.ndarray:
    """Sine of the authalic latitude, times half of what it is at the pole."""
    e = math.sqrt(ECCENTRICITY2)
    s = np.sin(lat)
    return (1 - ECCENTRICITY2) / 2 * (s / (1 - ECCENTRICITY2 * s * s) + np.arctanh(e * s) / e)


def ring_area(points: list[tuple[float, float]]) -> float:
    """Signed square metres between a ring and the pole, on the ellipsoid.

    Edges are followed as lines of longitude and latitude, subdivided so that
    an edge's authalic latitude is close to linear in each part.
    """
    total = 0.0
    for (x1, y1), (x2, y2) in zip(points, points[1:], strict=False):
        parts = max(1, int(math.ceil(max(abs(x2 - x1), abs(y2 - y1)))))
        at = np.linspace(0.0, 1.0, parts + 1)
        q = _authalic(np.radians(y1 + (y2 - y1) * at))
        dx = math.radians((x2 - x1 + 180) % 360 - 180) / parts
        total += dx * float(((q[1:] + q[:-1]) / 2).sum())
    return -total * RADIUS**2


def geodesic_area_ha(geometry: dict) -> float:
    """Hectares within a geometry; holes, whose rings turn the other way, are taken off.

    Each polygon counts by its outer ring less its holes, whichever way the
    rings turn.
    """
    kind = geometry.get("type")
    if kind == "FeatureCollection":
        return sum(geodesic_area_ha(f) for f in geometry["features"])
    if kind == "Feature" or "geometry" in geometry:
        return geodesic_area_ha(geometry["geometry"])
    if kind == "GeometryCollection":
        return sum(geodesic_area_ha(g) for g in geometry["geometries"])
    polygons = [geometry["coordinates"]] if kind == "Polygon" else geometry["coordinates"] if kind == "MultiPolygon" else []
    total = 0.0
    for p in polygons:
        outer, *holes = rings({"type": "Polygon", "coordinates": p})
        total += abs(ring_area(outer)) - sum(abs(ring_area(h)) for h in holes)
    return total / 10_000


def geodesic_area(geojson: Column) -> Column:
    """Hectares of a column of GeoJSON texts or hexadecimal WKB: a vectorised Pandas UDF, as no built-in function has it."""
    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda t: geodesic_area_ha(parse(t)) if t else None).astype("float64")

    return run(geojson)
