"""Rasters as tables: one row for each pixel (and year, month or scene); a void pixel is a null or an absent row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Storage types by declared type; 0 is void in all of them.
STORAGE = {"binary": "byte", "byte": "short", "int16": "short", "uint16": "int", "int32": "int", "float": "float"}


def self_mask(v: Column) -> Column:
    """0 becomes void."""
    return F.when(v != 0, v)


def update_mask(v: Column, mask: Column) -> Column:
    """Kept where the mask is neither 0 nor void."""
    return F.when(mask.isNotNull() & (mask != 0), v)


def unmask(v: Column, other: Column | int | float = 0) -> Column:
    """Void becomes ``other``."""
    return F.coalesce(v, other if isinstance(other, Column) else F.lit(other))


def where(v: Column, *changes: tuple[Column, Column | int]) -> Column:
    """``v`` with (condition, value) changes; the later wins, void conditions change nothing."""
    out = None
    for test, value in reversed(changes):
        out = F.when(test, value) if out is None else out.when(test, value)
    return v if out is None else out.otherwise(v)


def blend(below: Column, above: Column) -> Column:
    """``above`` where it isn't void, else ``below``."""
    return F.coalesce(above, below)


def ladder(v: Column, bounds: list[float], first: int = 1, strict: bool = False) -> Column:
    """Class by ascending lower bounds: below bounds[0] ``first``, and one more from each bound on (``strict``: above it)."""
    out = F.when(v.isNull(), F.lit(None).cast("int"))
    for k in range(len(bounds) - 1, -1, -1):
        out = out.when((v > bounds[k]) if strict else (v >= bounds[k]), first + k + 1)
    return out.otherwise(first)


def cast_product(df: DataFrame, kind: str, column: str = "value") -> DataFrame:
    """A product's column in its storage type, 0 as void; values out of the type's range become void too."""
    to = STORAGE[kind]
    return df.withColumn(column, self_mask(df[column].try_cast(to)))


def merged(parts: list[DataFrame]) -> DataFrame:
    """Collections of one schema as one."""
    return reduce(DataFrame.unionByName, parts)


def by_key(df: DataFrame) -> DataFrame:
    """A table that grows with the grid, marked for joins by shuffle and sort, whatever its size is guessed to be.

    A few packed megabytes of pixels are hundreds as a hash table, which the driver would build for a broadcast. A
    broadcast hint on the other side still counts.
    """
    return df.hint("merge")


def mosaic(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """The last value that isn't void, by ``order``, of each key."""
    return df.where(df[value].isNotNull()).groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))


def year_stack(df: DataFrame, years: list[int], key: str = "pixel_id", value: str = "value", prefix: str = "band") -> DataFrame:
    """Rows of (key, year, value) as one column for each year; the wide form is only for the edge of a job."""
    wide = df.groupBy(key).pivot("year", years).agg(F.first(value))
    return wide.select(key, *[F.col(str(y)).alias(f"{prefix}_{y}") for y in years])
