"""Cloud and projected shadow on a grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrocell.model import by_key
from pyrocell.operators.spatial import changed, dilate, open_by


def cloud_and_shadow(obs: DataFrame, azimuth: str = "solar_azimuth", probability: float = 40, dark: float = 1500, cells: int = 20, grow: int = 5, erode: int = 2) -> DataFrame:
    """Cells (scene_id, x, y) of clouds and of dark, dry pixels in the clouds' shadow; small patches removed by an
    opening, the rest grown.

    Every cloud pixel throws its shadow along the angle 90 - azimuth, ``cells`` steps long; the steps are an explode,
    so the test for shadow is an equi-join with dark pixels.
    """
    clouds = obs.where(F.col("cloud_probability") > probability)
    angle = F.radians(F.lit(90.0) - F.col(azimuth))
    step = F.explode(F.sequence(F.lit(1), F.lit(cells)))
    thrown = clouds.select("scene_id", "x", "y", angle.alias("a"), step.alias("s")).select("scene_id", (F.col("x") + F.round(F.col("s") * F.cos("a"))).cast("int").alias("x"), (F.col("y") - F.round(F.col("s") * F.sin("a"))).cast("int").alias("y")).distinct()
    dark_dry = obs.where((F.col("scl") != 6) & (F.col("nir_dn") < dark)).select("scene_id", "x", "y")
    both = clouds.select("scene_id", "x", "y").union(dark_dry.join(by_key(thrown), ["scene_id", "x", "y"], "left_semi")).distinct()
    return changed(both, open_by(erode) + dilate(grow), ["scene_id"])


def without_cloud_and_shadow(obs: DataFrame, **options) -> DataFrame:
    return obs.join(by_key(cloud_and_shadow(obs, **options)), ["scene_id", "x", "y"], "left_anti").select(*obs.columns)
