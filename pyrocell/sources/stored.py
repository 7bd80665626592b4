"""Tables laid out for the joins and boxes that come most often.

By pixel: bucketed and sorted on the pixel, with one number of buckets for all tables that meet there, so that
observations, burns, cover and territory join without a shuffle. By tile: sorted along a Morton curve, so that a box of
the grid is in few row groups, whose least and greatest x and y the scan looks at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyrocell.model import by_key

#: Buckets of a table by pixel, about one for 128 MB of the largest table that it meets.
BUCKETS = 64


def store_by_pixel(df: DataFrame, table: str, path: str, buckets: int = BUCKETS, key: str = "pixel_id") -> None:
    """``df`` as the catalog's table ``table`` in the folder ``path``: a file a bucket, in order of the key."""
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).mode("overwrite").option("path", path).saveAsTable(table)


def by_pixel(spark: SparkSession, table: str) -> DataFrame:
    """A table stored by pixel. Joins on the pixel and more columns then keep its buckets too: the session is told that a
    part of the keys may place the rows."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return by_key(spark.table(table))


def morton(x: Column, y: Column, bits: int = 20) -> Column:
    """The place of a tile (x, y) on the Morton curve: their bits in turn; both are 0 or more and below 2^bits."""
    spread = lambda c, k: [F.shiftleft(F.shiftright(c.cast("long"), b).bitwiseAND(F.lit(1).cast("long")), 2 * b + k) for b in range(bits)]
    return reduce(lambda a, b: a.bitwiseOR(b), [*spread(x, 0), *spread(y, 1)])


def store_by_tile(df: DataFrame, path: str, cell: int = 256, files: int | None = None) -> None:
    """``df`` (x, y, ...) with its ``tile``, in ranges of the curve and sorted along it; x and y are 0 or more."""
    at = lambda c: F.floor(F.col(c) / cell)
    tiled = df.withColumn("tile", morton(at("x"), at("y")))
    ranged = tiled.repartitionByRange(files, "tile") if files else tiled.repartitionByRange("tile")
    ranged.sortWithinPartitions("tile", "y", "x").write.parquet(path)
