"""Geometry on plain columns.

A ring is array<struct<lon,lat>>, a polygon is an array of rings (the first is the
outline, the others are holes) and a shape is an array of polygons.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6378100.0
SHAPE_TYPE = "array<array<array<struct<lon:double,lat:double>>>>"


def point(lat: Column, lng: Column) -> Column:
    """Longitude-first point; null unless both coordinates are there."""
    return F.when(lat.isNotNull() & lng.isNotNull(), F.struct(lng.alias("lon"), lat.alias("lat")))


def distance_m(lon_a: Column, lat_a: Column, lon_b: Column, lat_b: Column) -> Column:
    """Great-circle distance in metres (haversine)."""
    half_lat = F.sin(F.radians(lat_b - lat_a) / 2)
    half_lon = F.sin(F.radians(lon_b - lon_a) / 2)
    h = half_lat * half_lat + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def reach_lat(radius_m: float) -> float:
    """Degrees of latitude that a circle of this radius spans to each side."""
    return math.degrees(radius_m / EARTH_RADIUS_M) * (1 + 1e-9)


def reach_lon(lat: Column, radius_m: float) -> Column:
    """Degrees of longitude spanned to each side; 180 when the circle covers a pole."""
    ratio = F.lit(math.sin(radius_m / EARTH_RADIUS_M)) / F.cos(F.radians(lat))
    over_pole = F.abs(lat) + reach_lat(radius_m) >= 90
    return F.when(over_pole, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) * (1 + 1e-9)
    )


def tidy_shape(shape: str) -> Column:
    """Remove vertices equal to the one before them, in every ring."""
    return F.expr(
        f"""transform({shape}, polygon -> transform(polygon, ring ->
            filter(ring, (p, i) -> i = 0 OR p <> ring[greatest(i - 1, 0)])))"""
    )


def vertex_centroid(shape: str) -> Column:
    """Mean of the outline vertices of each part, then the mean over parts.

    The closing vertex counts like any other, and parts weigh the same whatever
    their area.
    """
    def mean(axis: str) -> str:
        ring_mean = f"aggregate(polygon[0], 0D, (s, p) -> s + p.{axis}) / nullif(size(polygon[0]), 0)"
        return f"aggregate({shape}, 0D, (s, polygon) -> s + {ring_mean}) / nullif(size({shape}), 0)"

    return F.expr(f"named_struct('lon', {mean('lon')}, 'lat', {mean('lat')})")


def shape_edges(shape: str) -> Column:
    """Consecutive vertex pairs of all rings of a shape, rings closed where they are not."""
    return F.expr(
        f"""flatten(transform(flatten({shape}), ring -> transform(ring, (p, i) -> named_struct(
            'x1', p.lon, 'y1', p.lat,
            'x2', ring[(i + 1) % size(ring)].lon, 'y2', ring[(i + 1) % size(ring)].lat))))"""
    )


def area_centroid(shape: str) -> Column:
    """Centroid by area: parts weigh by size and holes count against them.

    Each ring's moments are taken about the shape's first vertex ``o``, which keeps
    the products small, and signed so that outlines add and holes subtract whatever
    way they are wound. A shape without area gives its vertex centroid. One-element
    arrays bind a value that is used more than once.
    """
    nothing = "named_struct('a', 0D, 'mx', 0D, 'my', 0D)"
    cross = "(e.x1 * e.y2 - e.x2 * e.y1)"
    sign = "(CASE WHEN r = 0 THEN 1D ELSE -1D END) * (CASE WHEN m.a < 0 THEN -1D ELSE 1D END)"
    edges = """transform(ring, (p, i) -> named_struct(
        'x1', p.lon - o.lon, 'y1', p.lat - o.lat,
        'x2', ring[(i + 1) % size(ring)].lon - o.lon, 'y2', ring[(i + 1) % size(ring)].lat - o.lat))"""
    ring_moments = f"""aggregate({edges}, {nothing}, (m, e) -> named_struct(
        'a', m.a + {cross}, 'mx', m.mx + (e.x1 + e.x2) * {cross}, 'my', m.my + (e.y1 + e.y2) * {cross}))"""
    signed = f"""transform(array({ring_moments}), m -> named_struct(
        'a', {sign} * m.a, 'mx', {sign} * m.mx, 'my', {sign} * m.my))[0]"""
    total = f"""aggregate(
        flatten(transform({shape}, polygon -> transform(polygon, (ring, r) -> {signed}))), {nothing},
        (t, m) -> named_struct('a', t.a + m.a, 'mx', t.mx + m.mx, 'my', t.my + m.my))"""
    by_area = "named_struct('lon', o.lon + t.mx / (3 * t.a), 'lat', o.lat + t.my / (3 * t.a))"
    centre = F.expr(
        f"""transform(array({shape}[0][0][0]), o -> transform(array({total}), t ->
            CASE WHEN t.a <> 0 THEN {by_area} END)[0])[0]"""
    )
    return F.coalesce(centre, vertex_centroid(shape))


def inside(lon: str, lat: str, edges: str) -> Column:
    """Even-odd ray cast over all edges of a shape, holes and further parts included.

    Edges are half-open in latitude and the crossing must lie strictly to the east,
    so of two shapes that share an edge exactly one holds a point on it. An edge that
    spans the latitude is never level, so the division is safe.
    """
    spans = f"(e.y1 > {lat}) <> (e.y2 > {lat})"
    crossing = f"(e.x2 - e.x1) * ({lat} - e.y1) / (e.y2 - e.y1) + e.x1"
    return F.expr(
        f"""aggregate({edges}, 0, (n, e) ->
            n + CASE WHEN {spans} THEN CASE WHEN {lon} < {crossing} THEN 1 ELSE 0 END ELSE 0 END) % 2 = 1"""
    )


def bounds(edges: str) -> Column:
    def extreme(pick: str, field: str) -> str:
        return f"{pick}({edges}.{field})"

    return F.expr(
        f"""named_struct('west', {extreme('array_min', 'x1')}, 'east', {extreme('array_max', 'x1')},
            'south', {extreme('array_min', 'y1')}, 'north', {extreme('array_max', 'y1')})"""
    )


def touched(edges: str, west: str, south: str, east: str, north: str) -> Column:
    """Whether any edge meets a rectangle: its box does, and the corners do not all lie on one side of it."""
    boxes = (
        f"greatest(e.x1, e.x2) >= {west} AND least(e.x1, e.x2) <= {east}"
        f" AND greatest(e.y1, e.y2) >= {south} AND least(e.y1, e.y2) <= {north}"
    )

    def side(x: str, y: str) -> str:
        return f"((e.x2 - e.x1) * ({y} - e.y1) - (e.y2 - e.y1) * ({x} - e.x1))"

    corners = ", ".join(side(x, y) for x in (west, east) for y in (south, north))
    return F.expr(f"exists({edges}, e -> {boxes} AND least({corners}) <= 0 AND greatest({corners}) >= 0)")
