"""Burn severity: the change of the inverted index at a pixel's own fire month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrocell.functions.products import severity_class
from pyrocell.model import by_key
from pyrocell.operators.composite import quality_mosaic


def post_fire(obs: DataFrame, ties: list[str]) -> DataFrame:
    """The largest inverted index of each pixel and year."""
    return quality_mosaic(obs.withColumn("year", F.year("acq_ts")), ["pixel_id", "year"], "nbr", [], ties).select("pixel_id", "year", F.col("nbr").alias("post"))


def pre_fire(obs: DataFrame, fire: DataFrame, ties: list[str], pick: str = "latest", window_index: str = "max") -> DataFrame:
    """(pixel_id, year, pre) for each burn: the index of the best observation in [fire - 2 months, fire - 1 month), else
    of one observation in [fire - 6 months, fire): the latest or the earliest.

    An observation can only concern burns of the six months after its own, so it is joined on (pixel, month): one
    equi-join for both windows instead of a range join, and one aggregate.
    """
    month_no = lambda y, m: y * 12 + m - 1
    burns = fire.select("pixel_id", "year", "month", month_no(F.col("year"), F.col("month")).alias("at"))
    dated = obs.where(F.col("nbr").isNotNull()).withColumn("seen", month_no(F.year("acq_ts"), F.month("acq_ts")))
    near = dated.withColumn("at", F.explode(F.sequence(F.col("seen") + 1, F.col("seen") + 6))).join(by_key(burns), ["pixel_id", "at"])
    ahead = F.col("at") - F.col("seen")
    order = F.struct("acq_ts", *ties)
    index = F.struct(F.col("nbr") if window_index == "max" else -F.col("nbr"), order)
    last = F.max_by("nbr", order) if pick == "latest" else F.min_by("nbr", order)
    best = F.max_by("nbr", F.when(ahead == 2, index))
    return near.groupBy("pixel_id", "year", "month").agg(F.coalesce(best, last).alias("pre"))


def dnbr(obs: DataFrame, fire: DataFrame, ties: list[str], pick: str = "latest") -> DataFrame:
    """(pixel_id, year, month, dnbr, severity) of burned pixels that have both values."""
    change = pre_fire(obs, fire, ties, pick).join(by_key(post_fire(obs, ties)), ["pixel_id", "year"])
    out = change.withColumn("dnbr", F.col("post") - F.col("pre"))
    return out.withColumn("severity", severity_class(F.col("dnbr"))).select("pixel_id", "year", "month", "dnbr", "severity")
