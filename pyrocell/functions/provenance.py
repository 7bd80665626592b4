"""Where a pixel came from: scene identifiers taken apart and put together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SENSOR_NUMBERS = {"LT05": 5, "LE07": 7, "LC08": 8, "LC09": 9}


def landsat_flags(df: DataFrame, scene: str = "scene_id", ts: str = "acq_ts") -> DataFrame:
    """Adds sensor number, path, row and the parts of the date of a ``LC08_006065_20190914`` scene."""
    part = F.split(F.col(scene), "_")
    return df.withColumns({
        "sensor_no": F.right(part[0], F.lit(1)).cast("int"), "path": F.substring(part[1], 1, 3).cast("int"), "row": F.substring(part[1], 4, 3).cast("int"),
        "dayOfYear": F.dayofyear(ts), "monthOfYear": F.month(ts), "year": F.year(ts), "dayOfMonth": F.dayofmonth(ts),
    })


def landsat_scene(sensor_no: Column, path: Column, row: Column, year: Column, month: Column, day: Column) -> Column:
    """The scene's name, numbers filled with zeros."""
    name = F.element_at(F.create_map(*[x for k, v in SENSOR_NUMBERS.items() for x in (F.lit(v), F.lit(k))]), sensor_no)
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return F.concat(name, F.lit("_"), pad(path, 3), pad(row, 3), F.lit("_"), year.cast("string"), pad(month, 2), pad(day, 2))


def sentinel_flags(df: DataFrame, tiles: DataFrame, scene: str = "scene_id") -> DataFrame:
    """Adds propertie_0..4 of a ``20170328T083601_20170328T084228_T35RNK`` scene; tile numbers come from a dimension."""
    part = F.split(F.col(scene), "[T_]+")
    out = df.withColumns({f"propertie_{k}": part[k].cast("int") for k in range(4)}).withColumn("tile", part[4])
    return out.join(tiles.select("tile", F.col("number").alias("propertie_4")), "tile", "left").drop("tile")


def sentinel_scene(df: DataFrame, tiles: DataFrame) -> DataFrame:
    """The scene's name from its numbers; the times are filled with zeros."""
    pad = lambda c: F.lpad(F.col(c).cast("string"), 6, "0")
    named = df.join(tiles.select(F.col("number").alias("propertie_4"), "tile"), "propertie_4", "left")
    return named.withColumn("scene_name", F.concat(F.col("propertie_0").cast("string"), F.lit("T"), pad("propertie_1"), F.lit("_"), F.col("propertie_2").cast("string"), F.lit("T"), pad("propertie_3"), F.lit("_T"), "tile")).drop("tile")
