"""The year series of a pixel: time since and before fire, intervals, frequencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyrocell.model import by_key


def chronosequence(fire: DataFrame, first: int, last: int) -> DataFrame:
    """For each ever-burned pixel and year first..last+1: time_after, time_before, interval, year_last, year_next, burns.

    ``time_after`` is the years since the last burn before the year; else 0 if burned in it; else void. The year after
    the last counts as burned where the last one is. ``time_before`` likewise looks ahead. ``interval`` is time_after
    in burned years. One shuffle by pixel; a pixel is at most as many rows as years.
    """
    years = fire.select("pixel_id", "year").distinct().groupBy("pixel_id").agg(F.sort_array(F.collect_set("year")).alias("burned"))
    spine = years.withColumn("year", F.explode(F.sequence(F.lit(first), F.lit(last + 1))))
    in_year = F.array_contains("burned", F.col("year")) | ((F.col("year") == last + 1) & F.array_contains("burned", F.lit(last)))
    before = F.array_max(F.filter("burned", lambda b: b < F.col("year")))
    after = F.array_min(F.filter("burned", lambda b: b > F.col("year")))
    out = spine.withColumns({"time_after": F.coalesce(F.col("year") - before, F.when(in_year, 0)), "time_before": F.when(F.col("year") <= last, F.coalesce(after - F.col("year"), F.when(in_year, 0))), "burns": F.size("burned")})
    return out.withColumns({"interval": F.when(in_year & (F.col("year") <= last), F.col("time_after")), "year_last": F.when(F.col("time_after") > 0, F.col("year") - F.col("time_after")), "year_next": F.when(F.col("time_before") > 0, F.col("year") + F.col("time_before"))}).drop("burned")


def intervals(fire: DataFrame) -> DataFrame:
    """Years since the burn before, 0 for the first: a lag over the burned years alone."""
    by = Window.partitionBy("pixel_id").orderBy("year")
    return fire.select("pixel_id", "year").distinct().withColumn("interval", F.coalesce(F.col("year") - F.lag("year").over(by), F.lit(0)))


def mean_interval(fire: DataFrame) -> DataFrame:
    """The mean return interval of a pixel; first burns don't count."""
    return intervals(fire).groupBy("pixel_id").agg(F.avg(F.nullif("interval", F.lit(0))).alias("mean_interval"))


def burn_counts(fire: DataFrame) -> DataFrame:
    """Each burn with the number of its pixel's burns."""
    return fire.withColumn("burns", F.count("*").over(Window.partitionBy("pixel_id")))


def running_frequency(fire: DataFrame, first: int, last: int) -> DataFrame:
    """Burns up to each year and from each year on, of ever-burned pixels: (pixel_id, year, so_far, to_come)."""
    years = fire.select("pixel_id", "year").distinct().groupBy("pixel_id").agg(F.collect_set("year").alias("burned"))
    spine = years.withColumn("year", F.explode(F.sequence(F.lit(first), F.lit(last)))).select("pixel_id", "year", F.array_contains("burned", F.col("year")).cast("int").alias("b"))
    by = Window.partitionBy("pixel_id").orderBy("year")
    return spine.select("pixel_id", "year", F.sum("b").over(by.rowsBetween(Window.unboundedPreceding, 0)).alias("so_far"), F.sum("b").over(by.rowsBetween(0, Window.unboundedFollowing)).alias("to_come"))


def periods(spark, first: int, last: int, special: list[tuple[int, int]] = []) -> DataFrame:
    """(y0, y1): from the first year to each, from each to the last, and special ones; each once."""
    rows = [(first, y) for y in range(first, last + 1)] + [(y, last) for y in range(first, last + 1)] + list(special)
    return spark.createDataFrame(rows, "y0 int, y1 int").dropDuplicates(["y0", "y1"])


#: Periods of five, ten and fifteen years of the older collection (fixed values).
SPECIAL_PERIODS = [(1990, 1995), (1995, 2000), (2000, 2005), (2005, 2010), (2010, 2015), (2015, 2020), (1995, 2005), (2005, 2015), (2000, 2015)]


def _burned_years(fire: DataFrame, of: DataFrame) -> tuple[DataFrame, Column]:
    """(pixel_id, years), one bit a year, one row a pixel; and the periods (y0, y1, mask) as one array.

    Periods are some dozens, and their years 64 at most.
    """
    spans = [(r["y0"], r["y1"]) for r in of.select("y0", "y1").distinct().collect()]
    if not spans:
        return fire.select("pixel_id", F.lit(0).cast("long").alias("years")).limit(0), F.lit([]).cast("array<struct<y0:int,y1:int,mask:bigint>>")
    first, last = min(a for a, _ in spans), max(b for _, b in spans)
    if last - first >= 64:
        raise ValueError("periods of more than 64 years together")
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    masks = [(a, b, signed(sum(1 << y - first for y in range(a, b + 1)))) for a, b in sorted(spans)]
    periods = F.array(*[F.struct(F.lit(a).alias("y0"), F.lit(b).alias("y1"), F.lit(m).cast("long").alias("mask")) for a, b, m in masks])
    bit = F.expr(f"shiftleft(1L, CAST(year - {first} AS INT))")
    return fire.where(F.col("year").between(first, last)).groupBy("pixel_id").agg(F.bit_or(bit).alias("years")), periods


def _met(periods: Column, years: Column, keep=lambda p: F.lit(True)) -> Column:
    """A row for each period in which one of the years lies."""
    return F.explode(F.filter(periods, lambda p: keep(p) & (p["mask"].bitwiseAND(years) != 0)))


def frequency(fire: DataFrame, of: DataFrame) -> DataFrame:
    """Burned years of each pixel in each period; a pixel that didn't burn in it is absent. One row a pixel is shuffled,
    whatever the number of periods: these are met after it."""
    burned, periods = _burned_years(fire, of)
    rows = burned.select("pixel_id", "years", _met(periods, F.col("years")).alias("p"))
    return rows.select("pixel_id", "p.y0", "p.y1", F.bit_count(F.col("years").bitwiseAND(F.col("p.mask"))).cast("long").alias("frequency"))


def accumulated(fire: DataFrame, of: DataFrame, cover: DataFrame) -> DataFrame:
    """Pixels that burned in a period, with the land cover of its last year: one join on the pixel, after which each year
    of its cover meets the periods that end in it."""
    burned, periods = _burned_years(fire, of)
    both = burned.join(by_key(cover.select("pixel_id", "year", "class")), "pixel_id")
    rows = both.select("pixel_id", "class", _met(periods, F.col("years"), lambda p: p["y1"] == F.col("year")).alias("p"))
    return rows.select("pixel_id", "p.y1", "p.y0", "class")
