"""Near, radius and point-in-polygon queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import nearby
from tessera.session import settle
from tessera.sources import readers
from tessera.workload import roles
from tessera.workload.oracle import haversine
from tessera.workload.registry import query

_FROM_POINT = haversine("-73.9857::DOUBLE", "40.7484::DOUBLE", "lon", "lat")


@query(
    "geo_near",
    f"""SELECT place_id, name, round({_FROM_POINT}, 3) AS dist_metres FROM place
    WHERE place_type = 'ECONOMY' AND {_FROM_POINT} <= 6000 ORDER BY {_FROM_POINT}, place_id LIMIT 20""",
)
def geo_near(spark, sf):
    """The 20 nearest places of a type within 6 km of a point."""
    found = roles.places(spark, sf).filter(F.array_contains("types", "ECONOMY"))
    hits = nearby.near(found, -73.9857, 40.7484, 6000.0, 20)
    return hits.select("place_id", "name", F.round("dist_metres", 3).alias("dist_metres"))


_CENTRE_LON, _CENTRE_LAT = f"(x + {roles.CELL_LON}::DOUBLE / 2)", f"(y + {roles.CELL_LAT}::DOUBLE / 2)"


@query(
    "geo_radius_join",
    f"""SELECT s.neighbourhood, place_id, round({haversine(_CENTRE_LON, _CENTRE_LAT, 'lon', 'lat')}, 2) AS dist_metres
    FROM shape s, place p WHERE {haversine(_CENTRE_LON, _CENTRE_LAT, 'lon', 'lat')} <= 1000""",
)
def geo_radius_join(spark, sf):
    """Every place within 1,000 m of the middle of every boundary."""
    boundaries = readers.boundary_documents(roles.shapes(spark, sf))
    centres = settle(boundaries.select("neighbourhood", "area_centroid.lon", "area_centroid.lat"), "boundary-centres")
    joined = nearby.radius_join(centres, roles.places(spark, sf), 1000.0, "neighbourhood", "place_id")
    return joined.withColumn("dist_metres", F.round("dist_metres", 2))


def _in_square(inset: float) -> str:
    return (
        f"lon >= x + {inset} * {roles.CELL_LON}::DOUBLE AND lon < x + {1 - inset} * {roles.CELL_LON}::DOUBLE"
        f" AND lat >= y + {inset} * {roles.CELL_LAT}::DOUBLE AND lat < y + {1 - inset} * {roles.CELL_LAT}::DOUBLE"
    )


@query(
    "point_in_polygon",
    f"""SELECT s.neighbourhood, place_id FROM shape s, place p
    WHERE ({_in_square(0.0)} AND NOT ({_in_square(0.25)})) OR ({_in_square(0.375)})""",
)
def point_in_polygon(spark, sf):
    """Places inside two-part boundaries with a hole."""
    found = roles.places(spark, sf).select("place_id", "lon", "lat")
    return nearby.points_in_shapes(found, roles.shapes(spark, sf), "place_id", "neighbourhood")
