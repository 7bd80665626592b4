"""Fire scars: tables of components, their sizes, and their attributes on pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pyrocell.functions.products import size_class
from pyrocell.model import by_key
from pyrocell.operators.spatial import connected


def scar_table(labelled: DataFrame, area_m2: float = 900.0) -> DataFrame:
    """(year, scar_id, unique_id, n_pixels, area_ha, x0, y0, x1, y1) from cells with their component.

    ``area_ha`` is whole square metres over 10 000; ``unique_id`` counts 1, 2, ... within a year by scar_id.
    """
    table = labelled.groupBy("year", F.col("component").alias("scar_id")).agg(
        F.count("*").alias("n_pixels"), (F.floor(F.count("*") * area_m2) / 10_000.0).alias("area_ha"),
        F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"),
    )
    return numbered(table)


def numbered(table: DataFrame, bucket: int = 64 << 32) -> DataFrame:
    """``unique_id`` by year in the order of scar_id: ranks within ranges of ids (64 rows of the grid), plus the counts
    of the ranges before, so a year's scars are many small windows and only the counts meet in one."""
    ranged = table.withColumn("__range", F.floor(F.col("scar_id") / bucket))
    counts = ranged.groupBy("year", "__range").agg(F.count("*").alias("n"))
    before = counts.select("year", "__range", F.coalesce(F.sum("n").over(Window.partitionBy("year").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    ranked = ranged.withColumn("__rank", F.row_number().over(Window.partitionBy("year", "__range").orderBy("scar_id")))
    return ranked.join(by_key(before), ["year", "__range"]).withColumn("unique_id", F.col("__rank") + F.col("__before")).drop("__range", "__rank", "__before")


def scars_of(fire: DataFrame, area_m2: float = 900.0) -> tuple[DataFrame, DataFrame]:
    """Labelled cells and the scar table of burned pixels (x, y, year)."""
    labelled = connected(fire.select("x", "y", "year"), ["year"])
    return labelled, scar_table(labelled, area_m2)


def painted(labelled: DataFrame, table: DataFrame) -> DataFrame:
    """Each cell with its scar's number, area and size class."""
    attributes = table.select("year", F.col("scar_id").alias("component"), "unique_id", "area_ha", size_class(F.col("area_ha")).alias("size_class"))
    return labelled.join(by_key(attributes), ["year", "component"])
