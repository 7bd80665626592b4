"""Product catalog and processing state as small tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyrocell.functions.products import unit_key

FLAGS = ["exported", "mosaiced", "vectorized_gcs", "vectorized_gee", "published_mosaic", "published_vector", "temp_cleaned"]
CATALOG = "country string, themes array<struct<theme: string, collections: array<struct<collection: string, products: array<struct<product: string, asset: string, type: string, vectorize: boolean, visible: boolean, scale: int>>>>>>"


def catalog_rows(nested: DataFrame, hidden: bool = False) -> DataFrame:
    """Rows (country, theme, collection, product, ...) of the nested catalog; hidden products only on request."""
    rows = nested.select("country", F.explode("themes").alias("t")).select("country", "t.theme", F.explode("t.collections").alias("c")).select("country", "theme", "c.collection", F.explode("c.products").alias("p")).select("country", "theme", "collection", "p.*")
    return rows if hidden else rows.where("visible")


def upserted(catalog: DataFrame, changes: DataFrame, keys: list[str] = ["country", "collection", "product"]) -> DataFrame:
    """Rows added or replaced by key."""
    return catalog.join(changes.select(*keys), keys, "left_anti").select(*catalog.columns).unionByName(changes)


def removed(catalog: DataFrame, keys: DataFrame) -> DataFrame:
    return catalog.join(keys, keys.columns, "left_anti")


def shown(catalog: DataFrame, product: str, visible: bool) -> DataFrame:
    return catalog.withColumn("visible", F.when(F.col("product") == product, visible).otherwise(F.col("visible")))


def tile_unit(name: Column, prefix: str) -> Column:
    """The unit in a tile's file name ``<prefix><unit>_<tile>.tif``; void for other files."""
    rest = F.regexp_replace(F.substr(name, F.lit(len(prefix) + 1)), r"\.tif$", "")
    return F.when(F.startswith(name, F.lit(prefix)), F.regexp_replace(rest, "_[^_]*$", ""))


def artifact_units(files: DataFrame, prefix: str) -> DataFrame:
    """(unit, name) of a listing's tiles."""
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(tile_unit(name, prefix).alias("unit"), name.alias("name"), "size").where("unit IS NOT NULL")


def merged_states(storage: DataFrame, assets: DataFrame, units: DataFrame) -> DataFrame:
    """The state of every unit that any of three sources knows; unknown flags are false. ``vectorized_gee`` is told by
    ``assets``, the others by ``storage``."""
    out = storage.withColumnsRenamed({f: f"s_{f}" for f in FLAGS}).join(assets.select("unit", F.col("vectorized_gee").alias("a_vectorized_gee")), "unit", "full").join(units.select("unit").distinct(), "unit", "full")
    return out.select("unit", *[F.coalesce(("a_" if f == "vectorized_gee" else "s_") + f, F.lit(False)).alias(f) for f in FLAGS])


def complete(flags: list[str] = ["published_mosaic", "published_vector", "temp_cleaned"]) -> Column:
    out = F.lit(True)
    for f in flags:
        out = out & F.col(f)
    return out


def pending(states: DataFrame, year: int | None = None) -> DataFrame:
    """Units that aren't complete, newest first; of one year, if given."""
    out = states.where(~complete())
    return (out.where(F.startswith("unit", F.lit(str(year)))) if year else out).orderBy(F.desc("unit"))


def to_copy(source: DataFrame, target: DataFrame, force: bool = False) -> DataFrame:
    """Files that the target lacks or has in another size."""
    return source if force else source.join(target.select("name", "size"), ["name", "size"], "left_anti")


def unclassified(mosaics: DataFrame, results: DataFrame) -> DataFrame:
    """Mosaics ``sensor_region_year...`` that no result of the same sensor, region and year stands for."""
    def keyed(df: DataFrame) -> DataFrame:
        part = F.split("name", "_")
        return df.select("name", part[0].alias("sensor"), part[1].alias("region"), part[2].alias("year"))

    return keyed(mosaics).join(keyed(results).drop("name"), ["sensor", "region", "year"], "left_anti").select("name", "sensor", "region", "year")


def images_of_units(images: DataFrame, units: DataFrame, kind: str) -> DataFrame:
    """The first image, by time and name, whose time gives the unit's key."""
    keyed = images.withColumn("unit", unit_key(F.lit(kind), F.col("ts"))).groupBy("unit").agg(F.min_by("name", F.struct("ts", "name")).alias("name"))
    return units.select("unit").join(keyed, "unit")


def months_present(images: DataFrame) -> DataFrame:
    return images.select(F.date_format("ts", "yyyy_MM").alias("unit")).distinct()


def tile_counts(tiles: DataFrame) -> DataFrame:
    return tiles.groupBy("unit").agg(F.count("*").alias("tiles"))


def profile(observed: DataFrame) -> DataFrame:
    """Each product's observed range, rows and bands, and its first and last time."""
    return observed.groupBy("product").agg(F.max("value").alias("max"), F.min("value").alias("min"), F.count("value").alias("n"), F.array_sort(F.collect_set("band")).alias("bands"), F.min("ts").alias("t_start"), F.max("ts").alias("t_end"))


def in_both(a: DataFrame, b: DataFrame) -> DataFrame:
    """Units of both."""
    return a.select("unit").intersect(b.select("unit"))


def without_tiles(mosaics: DataFrame, tiles: DataFrame) -> DataFrame:
    """Mosaics whose tiles are gone."""
    return mosaics.select("unit").distinct().join(tiles.select("unit"), "unit", "left_anti")


def all_units(*sources: DataFrame) -> DataFrame:
    out = sources[0].select("unit")
    for s in sources[1:]:
        out = out.union(s.select("unit"))
    return out.distinct()


def merged_versions(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two versions (name, pixel_id, value) matched on the name without its last three characters, the first above
    the second."""
    stem = F.left("name", F.length("name") - 3)
    a = first.select(stem.alias("stem"), "pixel_id", F.col("value").alias("v1"))
    b = second.select(stem.alias("stem"), "pixel_id", F.col("value").alias("v2"))
    return a.join(b, ["stem", "pixel_id"], "full").select("stem", "pixel_id", F.coalesce("v1", "v2").alias("value"))


def burned_wins(versions: DataFrame, keys: list[str]) -> DataFrame:
    """Versions (keys, priority, value) as one: the last value above 0, else the last value."""
    return versions.groupBy(*keys).agg(F.max_by("value", F.struct((F.col("value") > 0).alias("b"), "priority")).alias("value"))
