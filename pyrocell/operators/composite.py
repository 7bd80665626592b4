"""Many observations of a pixel as one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrocell.model import by_key


def quality_mosaic(obs: DataFrame, keys: list[str], index: str, bands: list[str], ties: list[str]) -> DataFrame:
    """Of each key the whole observation whose index is largest; void indices don't count, ties go to the greatest
    ``ties``. One partial and one final aggregate, no sort of a pixel's observations by Python or window."""
    best = F.max_by(F.struct(index, *bands), F.struct(index, *ties)).alias("best")
    return obs.where(F.col(index).isNotNull()).groupBy(*keys).agg(best).select(*keys, "best.*")


def mean_mosaic(df: DataFrame, keys: list[str], value: str = "burned") -> DataFrame:
    """The mean of what isn't void, and whether it reaches 1."""
    return df.groupBy(*keys).agg(F.avg(value).alias("mean")).withColumn("burned", (F.col("mean") >= 1).cast("int"))


def any_of(df: DataFrame, keys: list[str], value: str = "burned") -> DataFrame:
    """1 where any row has a value of 1 or more."""
    return df.groupBy(*keys).agg((F.sum(value) >= 1).cast("int").alias("burned"))


def mean_and_any(df: DataFrame, keys: list[str], value: str = "burned") -> DataFrame:
    """Both of the above from one aggregate: ``mean``, ``burned`` and ``any_burned``."""
    both = df.groupBy(*keys).agg(F.avg(value).alias("mean"), (F.sum(value) >= 1).cast("int").alias("any_burned"))
    return both.withColumn("burned", (F.col("mean") >= 1).cast("int"))


def month_of_burn(obs: DataFrame, burned: DataFrame, ties: list[str]) -> DataFrame:
    """Burned pixels and years with the month of their most burned observation.

    The burned side filters before observations are reduced.
    """
    dated = obs.withColumns({"year": F.year("acq_ts"), "month": F.month("acq_ts")}).join(by_key(burned.select("pixel_id", "year")), ["pixel_id", "year"], "left_semi")
    return quality_mosaic(dated, ["pixel_id", "year"], "nbr", ["month"], ties).select("pixel_id", "year", "month")
