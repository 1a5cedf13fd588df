"""Points to regions, and points around a centre."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from regionlake import config as C
from regionlake.functions.geo import ellipsoid_distance_m, radius_box, strictly_inside
from regionlake.functions.cleaning import in_box
from regionlake.operators.sizing import salted_join, sized
from regionlake.session import durable

# Grid of the polygon index: cells across a typical region, and cells overall.
CELLS_ACROSS = 24
MAX_CELLS = 100_000


def polygon_edges(polygons: DataFrame, key: str = C.REGION) -> DataFrame:
    """One row per region with the edges of all its rings.

    ``polygons`` has the region and ``parts``: polygons, each a list of rings, each a
    list of [longitude, latitude] pairs, as in a GeoJSON MultiPolygon.
    """
    def ring_edges(ring: Column) -> Column:
        steps = F.when(F.size(ring) >= 2, F.sequence(F.lit(0), F.size(ring) - 2)).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(
            steps,
            lambda i: F.struct(
                F.get(F.get(ring, i), F.lit(0)).alias("x1"),
                F.get(F.get(ring, i), F.lit(1)).alias("y1"),
                F.get(F.get(ring, i + 1), F.lit(0)).alias("x2"),
                F.get(F.get(ring, i + 1), F.lit(1)).alias("y2"),
            ),
        )

    rings = F.flatten(F.col("parts"))
    return polygons.where(F.col(key).isNotNull() & F.col("parts").isNotNull()).select(
        F.col(key).cast("int").alias(key), F.flatten(F.transform(rings, ring_edges)).alias("edges")
    )


def suitable_cell(extent: DataFrame) -> float:
    """Cell size from the regions' boxes: a typical region spans ``CELLS_ACROSS`` cells,
    unless the whole set would then need more than ``MAX_CELLS``."""
    w, h = F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0")
    r = extent.agg(F.avg(F.sqrt(w * h)).alias("side"), F.sum(w * h).alias("area"), F.max(F.greatest(w, h)).alias("long")).first()
    if not r["long"]:
        return 1.0
    return max(r["side"] / CELLS_ACROSS, math.sqrt(r["area"] / MAX_CELLS), r["long"] / MAX_CELLS)


def cell_index(polygons: DataFrame, key: str = C.REGION, cell: float | None = None) -> tuple[DataFrame, float]:
    """One row per grid cell with the candidate regions and the edges that matter there,
    and the cell size.

    Edges become rows of their own first. Each goes to the grid rows it touches, and what is grouped after the shuffle is
    one grid row of one region, never a whole polygon. An edge matters in a cell if it overlaps the cell's latitude range and does not lie
    entirely west of it: only such edges can be crossed by the eastward ray of a point
    in the cell, or touch the point. A cell no edge reaches is wholly inside or outside;
    its centre decides here, once, and its points need no test. ``_sole`` is the region
    of a cell whose smallest candidate covers it whole.
    """
    edge = ["x1", "y1", "x2", "y2"]
    edges = durable(polygon_edges(polygons, key).select(key, F.inline("edges")))
    if cell is None:
        cell = suitable_cell(edges.groupBy(key).agg(
            F.min(F.least("x1", "x2")).alias("_x0"), F.max(F.greatest("x1", "x2")).alias("_x1"),
            F.min(F.least("y1", "y2")).alias("_y0"), F.max(F.greatest("y1", "y2")).alias("_y1")))
    # Cells are widened a little, so a rounded cell number never loses an edge.
    slack = cell * 1e-6
    number = lambda v: F.floor(v / F.lit(cell))
    rows = edges.withColumn("_cy", F.explode(F.sequence(
        number(F.least("y1", "y2") - F.lit(slack)), number(F.greatest("y1", "y2") + F.lit(slack)))))
    rows = rows.groupBy(key, "_cy").agg(
        F.collect_list(F.struct(*edge)).alias("edges"),
        F.min(number(F.least("x1", "x2"))).alias("_cx0"), F.max(number(F.greatest("x1", "x2"))).alias("_cx1"))
    boxes = rows.select(key, "edges", "_cy", F.explode(F.sequence("_cx0", "_cx1")).alias("_cx")).select(
        "*",
        (F.col("_cx") * F.lit(cell) - F.lit(slack)).alias("_w"),
        ((F.col("_cx") + 1) * F.lit(cell) + F.lit(slack)).alias("_e"),
        (F.col("_cy") * F.lit(cell) - F.lit(slack)).alias("_s"),
        ((F.col("_cy") + 1) * F.lit(cell) + F.lit(slack)).alias("_n"),
    )
    kept = boxes.withColumn("edges", F.filter("edges", lambda e: F.greatest(e["x1"], e["x2"]) >= F.col("_w"))).where(F.size("edges") > 0)
    # Every kept edge overlaps the cell's rows and does not end west of it.
    mixed = F.exists("edges", lambda e: F.least(e["x1"], e["x2"]) <= F.col("_e"))
    middle = strictly_inside((F.col("_w") + F.col("_e")) / 2.0, (F.col("_s") + F.col("_n")) / 2.0, F.col("edges"))
    sorted_out = kept.withColumn("_mixed", mixed).where(F.col("_mixed") | middle)
    candidate = F.struct(
        F.col(key).alias("region"), (~F.col("_mixed")).alias("whole"),
        F.when(F.col("_mixed"), F.col("edges")).alias("edges"),
    )
    index = sorted_out.groupBy("_cx", "_cy").agg(F.array_sort(F.collect_list(candidate)).alias("_candidates"))
    first = F.get("_candidates", F.lit(0))
    return index.withColumn("_sole", F.when(first["whole"], first["region"])), cell


def _index_bytes() -> Column:
    """Bytes of an index row: its candidates, and four coordinates an edge."""
    return F.aggregate("_candidates", F.lit(64).cast("bigint"), lambda n, c: n + 32 + 40 * F.coalesce(F.size(c["edges"]), F.lit(0)))


def with_region(
    points: DataFrame, polygons: DataFrame, lat: str = "lat", lon: str = "lon", out: str = C.REGION,
    key: str = C.REGION, cell: float | None = None, salts: int = 32, broadcast_rows: int = C.BROADCAST_ROWS,
) -> DataFrame:
    """Left join of points to the region they lie strictly inside.

    Points meet the polygons of their grid cell through an equi join on a unique cell,
    then the exact test runs on that cell's edges. A boundary point has no region; a
    point in several regions gets the smallest code. The index is broadcast if its rows and
    bytes allow; otherwise the points are salted, so a crowded cell spreads over tasks.
    """
    cells, cell = cell_index(polygons, key, cell)
    index = sized(cells, broadcast_rows, _index_bytes())
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    placed = points.withColumn("_cx", F.floor(x / F.lit(cell))).withColumn("_cy", F.floor(y / F.lit(cell)))
    if index.small:
        joined = placed.join(F.broadcast(index.df), ["_cx", "_cy"], "left")
    else:
        joined = salted_join(placed, index.df, ["_cx", "_cy"], salts, "left")
    hit = F.filter(
        "_candidates", lambda c: c["whole"] | strictly_inside(F.col("_x"), F.col("_y"), c["edges"])
    )
    tested = F.get(F.transform(hit, lambda c: c["region"]), F.lit(0))
    others = [c for c in points.columns if c != out]
    return (
        joined.withColumn("_x", x).withColumn("_y", y)
        .select(*others, F.when(F.col("_sole").isNotNull(), F.col("_sole")).otherwise(tested).alias(out))
    )


def enriched(
    points: DataFrame, polygons: DataFrame | None, key: str = C.REGION,
) -> DataFrame:
    """Fill the regions that are missing from coordinates, where there are any."""
    if polygons is None or not {"lat", "lon"} <= set(points.columns):
        return points
    if key not in points.columns:
        points = points.withColumn(key, F.lit(None).cast("int"))
    located = with_region(points, polygons, out="_geo", key=key)
    return located.withColumn(key, F.coalesce(key, "_geo")).select(*points.columns)


def within_radius(
    sales: DataFrame, lat: float, lon: float, radius_m: float = 500, lat_col: str = "latitude",
    lon_col: str = "longitude", tie: str = "id", top: int | None = C.RADIUS_TOP,
) -> DataFrame:
    """Rows within the radius of a centre, nearest first, at most ``top``.

    The degrees box is a range filter the scan can skip files and row groups with; the
    exact distance then decides. Sort and limit run as a per-task top-k.
    """
    low, high = C.RADIUS_BOUNDS_M
    if not low <= radius_m <= high:
        raise ValueError(f"radius_m must lie in {low}..{high}")
    near = sales.where(in_box(lat_col, lon_col, radius_box(lat, lon, radius_m)))
    near = near.withColumn("distance_m", ellipsoid_distance_m(lat_col, lon_col, lat, lon))
    near = near.where(F.col("distance_m") <= float(radius_m))
    ordered = near.orderBy("distance_m", tie)
    return ordered if top is None else ordered.limit(top)
