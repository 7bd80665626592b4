"""Reading observations, land cover, reference products and points; writing products."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyrocell.functions.hooks import DATA_SETS, data_set
from pyrocell.functions.optics import CONSTELLATION
from pyrocell.model import by_key, merged

#: A dimension (rules, lists, legends) is broadcast up to this many rows and joined by shuffle beyond.
SMALL_ROWS = 100_000


def dimension(df: DataFrame, most: int = SMALL_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most`` rows.

    Up to one row more is fetched to find out; these rows are what is broadcast then, so a small input is computed once.
    """
    rows = df.limit(most + 1).toArrow()
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)) if len(rows) <= most else df


def scene_scan(obs: DataFrame, start: datetime, end: datetime, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Observations from ``start`` up to, not including, ``end``, in a box (x0, y0, x1, y1), edges included."""
    out = obs.where((F.col("acq_ts") >= F.lit(start)) & (F.col("acq_ts") < F.lit(end)))
    if box:
        out = out.where(F.col("x").between(box[0], box[2]) & F.col("y").between(box[1], box[3]))
    return out


def constellation(spark: SparkSession) -> DataFrame:
    """(year_from, year_to, sensor): which sensors serve which years."""
    return spark.createDataFrame([(a, b, s) for a, b, ss in CONSTELLATION for s in ss], "year_from int, year_to int, sensor string")


def of_constellation(obs: DataFrame) -> DataFrame:
    """Observations by sensors that serve their year; the dimension is eight rows."""
    c = F.broadcast(constellation(obs.sparkSession)).withColumnRenamed("sensor", "serving")
    return obs.join(c, (F.col("sensor") == F.col("serving")) & F.year("acq_ts").between(F.col("year_from"), F.col("year_to")), "left_semi")


def without_blocked(obs: DataFrame, blocklist: DataFrame) -> DataFrame:
    """Observations of scenes that aren't on the list."""
    return obs.join(dimension(blocklist.select("scene_id").distinct()), "scene_id", "left_anti")


def with_scores(obs: DataFrame, scores: DataFrame) -> DataFrame:
    """The score of the same scene and pixel beside each observation; both sides are large, so this is a shuffle."""
    return obs.join(by_key(scores), ["scene_id", "pixel_id"])


def carried_forward(cover: DataFrame, years: int = 1, last: int | None = None) -> DataFrame:
    """Land cover with its last year repeated for the ``years`` after it; the table is read once. Where ``last`` isn't
    given it is looked up first, from the year column alone."""
    if last is None:
        last = cover.agg(F.max("year").alias("last")).first()["last"]
    year = F.col("year")
    repeated = F.when(year == F.lit(last), F.sequence(year, year + years)).otherwise(F.array("year"))
    return cover.withColumn("year", F.explode(repeated)).select(*cover.columns)


def of_country(cover: DataFrame, country: str) -> DataFrame:
    """One country's partition."""
    return cover.where(F.col("country") == country)


def years_to_rows(wide: DataFrame, key: str = "pixel_id", prefix: str = "burned_monthly_", legacy: bool = False) -> DataFrame:
    """Year bands as (key, year, month) rows: one for each pixel and year whose value is a month; ``legacy`` values
    are month * 100 + class."""
    bands = [c for c in wide.columns if c.startswith(prefix)]
    rows = wide.unpivot(key, bands, "band", "month")
    month = F.floor(F.col("month") / 100).cast("int") if legacy else F.col("month").cast("int")
    return rows.select(key, F.right("band", F.lit(4)).cast("int").alias("year"), month.alias("month")).where(F.col("month").between(1, 12))


def months_of(static: DataFrame) -> DataFrame:
    """Yearly rows repeated for each month."""
    return static.withColumn("month", F.explode(F.sequence(F.lit(1), F.lit(12))))


def heat_points(points: DataFrame, year: int, months: list[int], box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Points of a year's months, in a box (x0, y0, x1, y1)."""
    out = points.where((F.year("ts") == year) & F.month("ts").isin(months))
    return out.where(F.col("x").between(box[0], box[2]) & F.col("y").between(box[1], box[3])) if box else out


def month_start(year: Column, month: Column) -> Column:
    """The first day of a month, as the time a row stands for."""
    return F.make_date(year, month, F.lit(1))


# Reference products, each as (pixel_id, year, month, source).


def _conformed(df: DataFrame, year: Column, month: Column, source: str) -> DataFrame:
    return df.select("pixel_id", year.cast("int").alias("year"), month.cast("int").alias("month"), F.lit(source).alias("source"))


@data_set("burn dates")
def conform_burn_dates(df: DataFrame, source: str) -> DataFrame:
    """Images with a ``burn_date`` (day of the year, 0 where unburned): void and 0 drop out, the day gives the month."""
    day = F.date_add(F.make_date(F.year("ts"), F.lit(1), F.lit(1)), (F.col("burn_date") - 1).cast("int"))
    return _conformed(df.where("burn_date >= 1"), F.year("ts"), F.month(day), source)


@data_set("yearly")
def conform_yearly(df: DataFrame, source: str) -> DataFrame:
    """Yearly bands ``..._YYYY`` of 0/1: burned at an unknown month, so the month is void."""
    bands = [c for c in df.columns if c != "pixel_id"]
    rows = df.unpivot("pixel_id", bands, "band", "v").where("v <> 0")
    return _conformed(rows, F.right("band", F.lit(4)), F.lit(None), source)


@data_set("brightness")
def conform_brightness(df: DataFrame, source: str, band: str = "t21") -> DataFrame:
    """Active-fire images: any value counts in the month of its image."""
    return _conformed(df.where(F.col(band).isNotNull()), F.year("ts"), F.month("ts"), source)


@data_set("month codes")
def conform_month_codes(df: DataFrame, source: str) -> DataFrame:
    """Yearly images whose value is the month."""
    return _conformed(df.where(F.col("value").between(1, 12)), F.col("year"), F.col("value"), source)


def reference_products(parts: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """All products (kind, images, source name) as one table; ``hooks.data_set`` adds kinds."""
    return merged([DATA_SETS[kind](df, source) for kind, df, source in parts])


SAMPLES = ["red", "nir", "swir1", "swir2", "label"]


def samples_scan(df: DataFrame, columns: list[str] = SAMPLES) -> DataFrame:
    """Rows without any NaN in ``columns``; nulls count as NaN."""
    out = df
    for c in columns:
        out = out.where(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")))
    return out


def scars_scan(spark: SparkSession, path: str, years: list[int]) -> DataFrame:
    """Scars of some years; only their partitions are read."""
    return spark.read.parquet(path).where(F.col("year").isin(years))


# Sinks


def write_product(df: DataFrame, path: str, by: list[str] = ["year"]) -> None:
    """A product in directories by year; only those that ``df`` has are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_statistics(df: DataFrame, path: str, selectors: list[str]) -> None:
    """CSV with a header and columns in the order given."""
    df.select(*selectors).write.mode("overwrite").option("header", True).csv(path)


def mosaic_bands(df: DataFrame, keep: list[str] = ["pixel_id"]) -> DataFrame:
    """The four bands that models take, as float."""
    return df.select(*keep, *[F.col(b).cast(T.FloatType()).alias(b) for b in ("red", "nir", "swir1", "swir2")])


def labelled_samples(mosaic: DataFrame, labels: DataFrame) -> DataFrame:
    """Training samples: bands of the pixels that have a label."""
    return mosaic_bands(mosaic).join(by_key(labels.select("pixel_id", "label")), "pixel_id").select("pixel_id", *SAMPLES)
