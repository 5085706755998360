"""Spatial queries: near a point, within a radius, inside a shape."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import geo
from tessera.session import settle


def near(points: DataFrame, lon: float, lat: float, radius_m: float, n: int, id_column: str = "place_id") -> DataFrame:
    """The ``n`` closest points within the radius, with their distance.

    The box test uses bare coordinate columns so that it reaches the file scan; the
    distance is computed for rows inside the box only.
    """
    dlat = geo.reach_lat(radius_m)
    box = F.col("lat").between(lat - dlat, lat + dlat)
    ratio = math.sin(radius_m / geo.EARTH_RADIUS_M) / max(math.cos(math.radians(lat)), 1e-12)
    if abs(lat) + dlat < 90 and ratio < 1:
        dlon = math.degrees(math.asin(ratio)) * (1 + 1e-9)
        if -180 <= lon - dlon and lon + dlon <= 180:
            box = box & F.col("lon").between(lon - dlon, lon + dlon)
    dist = geo.distance_m(F.lit(float(lon)), F.lit(float(lat)), F.col("lon"), F.col("lat"))
    return (
        points.filter(box)
        .withColumn("dist_metres", dist)
        .filter(F.col("dist_metres") <= radius_m)
        .orderBy("dist_metres", id_column)
        .limit(n)
    )


def _cell(value: Column, low: float, width: float | Column) -> Column:
    return F.floor((value - low) / width)


def radius_join(
    centres: DataFrame,
    points: DataFrame,
    radius_m: float,
    centre_id: str,
    point_id: str,
    salts: int = 8,
) -> DataFrame:
    """Every (centre, point) within the radius, by an equi-join on grid cells.

    Both sides carry ``lon`` and ``lat``. A centre is repeated for the cells its
    circle can touch and for each salt; a point has one cell and one salt, so the
    points of a crowded cell are spread over ``salts`` join keys and any further
    imbalance is split by the adaptive skew join. Exact at every latitude and across
    the date line.
    """
    width = max(geo.reach_lat(radius_m), 1e-6)
    around = math.ceil(360.0 / width)
    dlat = F.lit(geo.reach_lat(radius_m))
    dlon = F.least(geo.reach_lon(F.col("lat"), radius_m), F.lit(180.0))
    rows = F.sequence(_cell(F.col("lat") - dlat, -90.0, width), _cell(F.col("lat") + dlat, -90.0, width))
    first = _cell(F.col("lon") - dlon, -180.0, width)
    # when the date line cuts a cell short, one cell more keeps the wrapped part covered
    columns = F.array_distinct(
        F.transform(
            F.sequence(first - 1, _cell(F.col("lon") + dlon, -180.0, width) + 1),
            lambda c: F.pmod(c, F.lit(around).cast("bigint")),
        )
    )
    spread = (
        centres.select(centre_id, F.col("lon").alias("_clon"), F.col("lat").alias("_clat"), rows.alias("_rows"), columns.alias("_cols"))
        .withColumn("_row", F.explode("_rows"))
        .withColumn("_column", F.explode("_cols"))
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        .drop("_rows", "_cols")
    )
    placed = points.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull()).select(
        point_id,
        F.col("lon").alias("_plon"),
        F.col("lat").alias("_plat"),
        _cell(F.col("lat"), -90.0, width).alias("_row"),
        F.pmod(_cell(F.col("lon"), -180.0, width), F.lit(around).cast("bigint")).alias("_column"),
        F.pmod(F.xxhash64(point_id), F.lit(salts)).cast("int").alias("_salt"),
    )
    dist = geo.distance_m(F.col("_clon"), F.col("_clat"), F.col("_plon"), F.col("_plat"))
    return (
        placed.join(spread, ["_row", "_column", "_salt"])
        .withColumn("dist_metres", dist)
        .filter(F.col("dist_metres") <= radius_m)
        .select(centre_id, point_id, "dist_metres")
    )


# Cells of a shape's bounding box along its longer side, at most.
CELLS_ACROSS = 64
# Degrees by which a cell is taken wider when edges are tested against it; far above what rounding does.
CELL_MARGIN = 1e-9


def shape_cells(shapes: DataFrame, shape_id: str, cell_degrees: float = 0.05) -> DataFrame:
    """The cover of every shape: (shape_id, level, row, column, border, edges).

    Cells double in size until a shape's bounding box is at most 64 across (``level`` counts the doublings), so a
    continent has no more cells than a block of houses. A cell that no edge touches is wholly inside or
    wholly outside: inner cells have no edges, outer ones are not in the cover. A border cell holds
    the edges that a ray to the east can meet from within it: those that reach into its row of cells
    and not only to the west of it.
    """
    edged = shapes.select(shape_id, geo.shape_edges("shape").alias("_edges")).withColumn("_box", geo.bounds("_edges"))
    extent = F.greatest(F.col("_box.north") - F.col("_box.south"), F.col("_box.east") - F.col("_box.west"))
    doublings = F.ceil(F.log2(F.greatest(extent / (CELLS_ACROSS * cell_degrees), F.lit(1.0))))
    edged = edged.withColumn("level", F.coalesce(doublings, F.lit(0)).cast("int")).filter("_box.west IS NOT NULL")
    edged = edged.withColumn("_width", F.lit(float(cell_degrees)) * F.pow(F.lit(2.0), F.col("level")))

    def span(low: str, high: str, start: float) -> Column:
        return F.explode(F.sequence(_cell(F.col(low), start, F.col("_width")), _cell(F.col(high), start, F.col("_width"))))

    rows = edged.withColumn("row", span("_box.south", "_box.north", -90.0))
    rows = rows.withColumn("_south", F.expr(f"row * _width - 90D - {CELL_MARGIN}D"))
    rows = rows.withColumn("_north", F.expr(f"_south + _width + {2 * CELL_MARGIN}D"))
    in_row = "greatest(e.y1, e.y2) >= _south AND least(e.y1, e.y2) <= _north"
    rows = rows.withColumn("_edges", F.expr(f"filter(_edges, e -> {in_row})"))
    cells = rows.withColumn("column", span("_box.west", "_box.east", -180.0))
    cells = cells.withColumn("_west", F.expr(f"column * _width - 180D - {CELL_MARGIN}D"))
    cells = cells.withColumn("_east", F.expr(f"_west + _width + {2 * CELL_MARGIN}D"))
    return cells.select(
        shape_id,
        "level",
        "row",
        "column",
        geo.touched("_edges", "_west", "_south", "_east", "_north").alias("border"),
        geo.inside("(_west + _east) / 2", "(_south + _north) / 2", "_edges").alias("_centre_inside"),
        F.expr("filter(_edges, e -> greatest(e.x1, e.x2) >= _west)").alias("edges"),
    ).filter("border OR _centre_inside").select(
        shape_id, "level", "row", "column", "border", F.when(F.col("border"), F.col("edges")).alias("edges")
    )


def points_in_shapes(
    points: DataFrame, shapes: DataFrame, point_id: str, shape_id: str, cell_degrees: float = 0.05, salts: int = 8
) -> DataFrame:
    """Every (shape, point) with the point inside, by an equi-join with the shapes' cells.

    A point has one cell for each of the few sizes in use. In an inner cell the join decides; only in border cells a
    ray is cast, over that cell's edges. Cells are repeated for each salt, so the points of a crowded cell
    are spread over ``salts`` keys.
    """
    cover = settle(shape_cells(shapes, shape_id, cell_degrees), "shape-cells")
    # no more numbers than doublings from the smallest cell to the globe
    levels = sorted(r["level"] for r in cover.select("level").distinct().collect())
    width = F.lit(float(cell_degrees)) * F.pow(F.lit(2.0), F.col("level"))
    placed = (
        points.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull())
        .select(point_id, F.col("lon").alias("_lon"), F.col("lat").alias("_lat"))
        .withColumn("level", F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>")))
        .withColumn("row", _cell(F.col("_lat"), -90.0, width))
        .withColumn("column", _cell(F.col("_lon"), -180.0, width))
        .withColumn("_salt", F.pmod(F.xxhash64(point_id), F.lit(salts)).cast("int"))
    )
    salted = cover.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    met = placed.join(salted, ["level", "row", "column", "_salt"])
    return met.filter(~F.col("border") | geo.inside("_lon", "_lat", "edges")).select(shape_id, point_id)
