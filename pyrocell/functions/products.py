"""Codes and classes of the yearly products."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pyrocell.model import ladder

#: Lower bounds in hectares of scar-size classes 2..8 (fixed values).
SIZE_BOUNDS = [10, 250, 500, 5_000, 10_000, 50_000, 100_000]


def packed(value: Column, cover: Column) -> Column:
    """value * 100 + land-cover class; void if either is."""
    return value * 100 + cover


def unpacked(code: Column) -> tuple[Column, Column]:
    """The value and the land-cover class of a packed code."""
    return F.floor(code / 100).cast("int"), (code % 100).cast("int")


def severity_class(dnbr: Column) -> Column:
    """1 below 0, 2 from 0, 3 from 270, 4 from 440, 5 from 660 and 6 above 1350."""
    return F.when(dnbr.isNull(), F.lit(None).cast("int")).when(dnbr > 1350, 6).otherwise(ladder(dnbr, [0, 270, 440, 660]))


def size_class(hectares: Column, zero_is_small: bool = False) -> Column:
    """Scar-size class 1..8; 0 hectares is void unless ``zero_is_small``."""
    small = F.lit(1 if zero_is_small else None).cast("int")
    return F.when(hectares.isNull(), F.lit(None).cast("int")).when(hectares <= 0, small).otherwise(ladder(hectares, SIZE_BOUNDS))


def interval_class(interval: Column, time_after: Column, burns: Column) -> Column:
    """Return-interval class: 1..9 by length in years, 10 where just burned, 11 where burned once; later rules win."""
    classes = F.when(burns == 1, 11).when(time_after == 0, 10)
    for k, most in zip(range(9, 0, -1), (None, 20, 15, 10, 7, 5, 4, 3, 2), strict=True):
        least = {9: 20, 8: 15, 7: 10, 6: 7, 5: 5, 4: 4, 3: 3, 2: 2, 1: 0}[k]
        classes = classes.when((interval > least) if most is None else (interval > least) & (interval <= most), k)
    return classes


def product_kind(name: Column) -> Column:
    """monthly, annual, period or other, by the words in a product's name."""
    n = F.lower(F.coalesce(name, F.lit("")))
    return F.when(n.contains("monthly"), "monthly").when(n.contains("annual"), "annual").when(n.rlike("frequency|accumulated|recurrence|time_after|year_last|interval"), "period").otherwise("other")


def short_name(name: Column, publisher: str = r"[a-z]+") -> Column:
    """The name without its publisher's prefix, its collection and its version."""
    out = F.regexp_replace(F.coalesce(name, F.lit("")), rf"^{publisher}_(\w+_)?fire_", "")
    return F.regexp_replace(F.regexp_replace(out, r"^collection\d+_?", ""), r"_v\d+$", "")


def is_vectorizable(name: Column) -> Column:
    return (product_kind(name) == "annual") & (short_name(name) == "annual_burned")


def collection_path(collection: Column) -> Column:
    """collection_02 -> collection2, collection_03_1 -> collection3_1, collection_00 -> collection."""
    rest = F.regexp_replace(collection, "^collection_", "")
    rest = F.when(rest == "00", "").when(rest.startswith("00_"), F.substr(rest, F.lit(3))).otherwise(F.regexp_replace(rest, r"^0(?=\d)", ""))
    return F.when(collection.startswith("collection_"), F.concat(F.lit("collection"), rest)).otherwise(collection)


def unit_key(kind: Column, ts: Column) -> Column:
    """YYYY_MM for monthly products, else YYYY."""
    return F.when(kind == "monthly", F.date_format(ts, "yyyy_MM")).otherwise(F.date_format(ts, "yyyy"))
