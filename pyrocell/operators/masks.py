"""What doesn't count as burned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrocell.model import by_key
from pyrocell.operators.spatial import dilated
from pyrocell.sources.scans import carried_forward, dimension


def excluded_by_rules(fire: DataFrame, cover: DataFrame, rules: DataFrame) -> DataFrame:
    """Fire whose land-cover class no rule excludes. A rule (biome, region, year, class) holds for all regions or years
    where these are void; a year past the last of the land cover takes its last."""
    last = cover.agg(F.max("year").alias("__last"))
    known = fire.join(F.broadcast(last)).withColumn("__year", F.least("year", "__last"))
    c = cover.select("pixel_id", F.col("year").alias("__year"), "class")
    r = dimension(rules.select(F.col("biome").alias("rb"), F.col("region").alias("rr"), F.col("year").alias("ry"), F.col("class").alias("rc")))
    tested = known.join(by_key(c), ["pixel_id", "__year"], "left")
    fits = (F.col("biome") == F.col("rb")) & (F.col("class") == F.col("rc")) & (F.col("rr").isNull() | (F.col("region") == F.col("rr"))) & (F.col("ry").isNull() | (F.col("year") == F.col("ry")))
    return tested.join(r, fits, "left_anti").select(*fire.columns)


def without_water(fire: DataFrame, water: DataFrame) -> DataFrame:
    return fire.join(by_key(water.select("pixel_id")), "pixel_id", "left_anti")


def buffered_class(cover: DataFrame, classes: list[int], cells: int, within: DataFrame | None = None) -> DataFrame:
    """(x, y, year) of cells within a square of ``cells`` about pixels of the classes; only cells of ``within``, if given."""
    out = dilated(cover.where(F.col("class").isin(classes)).select("x", "y", "year"), cells, keys=["year"])
    return out.join(by_key(within.select("x", "y").distinct()), ["x", "y"], "left_semi") if within is not None else out


def without_buffered(fire: DataFrame, buffer: DataFrame) -> DataFrame:
    return fire.join(by_key(buffer), ["x", "y", "year"], "left_anti")


def exempted(fire: DataFrame, mask: DataFrame, polygon: DataFrame, exempt: str = "drop") -> DataFrame:
    """Fire outside ``mask``. In the polygon the mask is void: ``drop`` loses these pixels, ``keep`` spares them."""
    if exempt not in ("drop", "keep"):
        raise ValueError(exempt)
    area = by_key(polygon.select("pixel_id").distinct())
    outside = fire.join(area, "pixel_id", "left_anti").join(by_key(mask.select("pixel_id", "year").distinct()), ["pixel_id", "year"], "left_anti")
    return outside if exempt == "drop" else outside.select(*fire.columns).unionByName(fire.join(area, "pixel_id", "left_semi").select(*fire.columns))


def near_hotspots(obs: DataFrame, hotspots: DataFrame, cells: int, by_month: bool = True) -> DataFrame:
    """Observations within ``cells`` of a hotspot of their year (and month)."""
    keys = ["year", "month"] if by_month else ["year"]
    spots = hotspots.withColumns({"year": F.year("ts"), "month": F.month("ts")}).select("x", "y", *keys).distinct()
    dated = obs.withColumns({"year": F.year("acq_ts"), "month": F.month("acq_ts")})
    return dated.join(by_key(dilated(spots, cells, keys=keys)), ["x", "y", *keys], "left_semi").select(*obs.columns)


def earlier_months(spark) -> DataFrame:
    """(month, year_offset, earlier): which months' burns exclude a detection. January looks back to August, February
    to October and January, later months to all before them in the year."""
    rows = [(1, -1, m) for m in range(8, 13)] + [(2, -1, m) for m in range(10, 13)] + [(2, 0, 1)] + [(m, 0, e) for m in range(3, 13) for e in range(1, m)]
    return spark.createDataFrame(rows, "month int, year_offset int, earlier int")


def first_detections(detections: DataFrame, burned: DataFrame) -> DataFrame:
    """Detections (pixel_id, year, month) not burned in the months before that exclude them.

    The rules turn each burn into the months it excludes, so this is one equi anti join.
    """
    rules = F.broadcast(earlier_months(detections.sparkSession).withColumnRenamed("month", "later"))
    barred = burned.select("pixel_id", "year", "month").join(rules, F.col("month") == F.col("earlier")).select("pixel_id", (F.col("year") - F.col("year_offset")).alias("year"), F.col("later").alias("month")).distinct()
    return detections.join(by_key(barred), ["pixel_id", "year", "month"], "left_anti")


def in_yearly_mask(obs: DataFrame, mask: DataFrame) -> DataFrame:
    """Rows whose (pixel_id, year) is in the year's mask."""
    return obs.join(by_key(mask.select("pixel_id", "year")), ["pixel_id", "year"], "left_semi")


def monitor_cover_mask(cover: DataFrame, excluded: list[int]) -> DataFrame:
    return carried_forward(cover).where(~F.col("class").isin(excluded))


def by_fire_month(product: DataFrame, fire: DataFrame) -> DataFrame:
    """A yearly product with the month in which its pixel burned."""
    return product.join(by_key(fire.select("pixel_id", "year", "month")), ["pixel_id", "year"])
