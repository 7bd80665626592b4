"""Edges of scenes: what lies too near to the outline of a scene's own footprint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRES_BY_DEGREE = 111_320.0


def edge_pieces(footprints: DataFrame, metres: float, cell: float, scene: str = "scene_id") -> DataFrame:
    """(scene, cx, cy, ax, ay, bx, by) of (scene, ring array<struct<lon, lat>>): the rings' edges in pieces no longer than
    a cell, each in all cells of ``cell`` degrees that it comes within ``metres`` of."""
    n = F.size("ring")
    edge = F.explode(F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(F.element_at("ring", i).alias("a"), F.element_at("ring", i % n + 1).alias("b"))))
    edges = footprints.where(n > 0).select(scene, edge.alias("e")).select(scene, *[F.col(f"e.{p}.{c}").cast("double").alias(f"{p}_{c}") for p in "ab" for c in ("lon", "lat")])
    pieces = F.greatest(F.lit(1), F.ceil(F.greatest(F.abs(F.col("b_lon") - F.col("a_lon")), F.abs(F.col("b_lat") - F.col("a_lat"))) / cell)).cast("int")
    cut = edges.withColumn("of", pieces).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
    at = lambda c, k: F.col(f"a_{c}") + (F.col(f"b_{c}") - F.col(f"a_{c}")) * k / F.col("of")
    cut = cut.select(scene, at("lon", F.col("k")).alias("ax"), at("lat", F.col("k")).alias("ay"), at("lon", F.col("k") + 1).alias("bx"), at("lat", F.col("k") + 1).alias("by"))
    margin_y = F.lit(metres / METRES_BY_DEGREE * 1.001)
    margin_x = margin_y / F.greatest(F.lit(0.01), F.cos(F.radians(F.greatest(F.abs("ay"), F.abs("by")) + margin_y)))
    cells = lambda a, b, margin: F.explode(F.sequence(F.floor((F.least(a, b) - margin) / cell), F.floor((F.greatest(a, b) + margin) / cell)))
    return cut.withColumn("cx", cells("ax", "bx", margin_x)).withColumn("cy", cells("ay", "by", margin_y))


def distance_m(lon: Column, lat: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Metres from a point to a stretch, on the point's local plane."""
    wide = F.cos(F.radians(lat)) * METRES_BY_DEGREE
    px, py, qx, qy = (ax - lon) * wide, (ay - lat) * METRES_BY_DEGREE, (bx - lon) * wide, (by - lat) * METRES_BY_DEGREE
    dx, dy = qx - px, qy - py
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(-(px * dx + py * dy), dx * dx + dy * dy), F.lit(0.0))))
    return F.hypot(px + t * dx, py + t * dy)


def trimmed(obs: DataFrame, footprints: DataFrame, metres: float = 3000.0, cell: float = 0.25, scene: str = "scene_id", lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Observations ``metres`` or more from every edge of their own scene's footprint; those of scenes without one stay.

    The join is on scene and cell, so each meets only what can be near it, and no row is copied or counted.
    """
    o = obs.withColumns({"__cx": F.floor(F.col(lon) / cell), "__cy": F.floor(F.col(lat) / cell)}).alias("o")
    e = edge_pieces(footprints, metres, cell, scene).alias("e")
    near = distance_m(F.col(f"o.{lon}"), F.col(f"o.{lat}"), *[F.col(f"e.{c}") for c in ("ax", "ay", "bx", "by")]) < metres
    on = (F.col(f"o.{scene}") == F.col(f"e.{scene}")) & (F.col("__cx") == F.col("e.cx")) & (F.col("__cy") == F.col("e.cy")) & near
    return o.join(e, on, "left_anti").select(*obs.columns)
