"""State tables and version merges (C18-C23, D18-D19, B35, F3, G)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrocell.operators import catalog
from pyrocell.plans.registry import query


def unit(c: str):
    return F.date_format(c, "yyyy_MM")


U = "strftime({}, '%Y_%m')"


def states(v) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Storage, asset and collection states by month, from orders, shipments and events."""
    o = v.table("orders").groupBy(unit("o_orderdate").alias("unit")).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("k"))
    storage = o.where("k % 5 <> 0").select("unit", *[(F.col("k") % (i + 2) != 0).alias(f) for i, f in enumerate(catalog.FLAGS)])
    assets = o.where("k % 3 <> 0").select("unit", (F.col("k") % 2 == 0).alias("vectorized_gee"))
    return storage, assets, v.table("events").select(unit("ts").alias("unit")).distinct()


SO = f"SELECT {U.format('o_orderdate')} AS unit, sum(o_orderkey) AS k FROM orders GROUP BY 1"
MERGED = f"""SELECT coalesce(s.unit, a.unit, e.unit) AS unit, {', '.join(f"coalesce({'a.k % 2 = 0' if f == 'vectorized_gee' else f's.k % {i + 2} <> 0'}, FALSE) AS {f}" for i, f in enumerate(['exported', 'mosaiced', 'vectorized_gcs', 'vectorized_gee', 'published_mosaic', 'published_vector', 'temp_cleaned']))}
FROM (SELECT * FROM ({SO}) WHERE k % 5 <> 0) s FULL JOIN (SELECT * FROM ({SO}) WHERE k % 3 <> 0) a ON a.unit = s.unit FULL JOIN (SELECT DISTINCT {U.format('ts')} AS unit FROM events) e ON e.unit = coalesce(s.unit, a.unit)"""


@query(MERGED)
def c20_merged_states(v) -> DataFrame:
    return catalog.merged_states(*states(v))


@query(f"SELECT * FROM ({MERGED}) WHERE NOT (published_mosaic AND published_vector AND temp_cleaned) AND unit LIKE '1997%'")
def b35_f3_pending(v) -> DataFrame:
    return catalog.pending(catalog.merged_states(*states(v)), 1997)


VERSIONS = "SELECT pixel_id, year, month AS value, 1 AS priority FROM fire UNION ALL SELECT pixel_id, year, CASE WHEN x % 3 = 0 THEN 0 ELSE 12 END, 2 FROM fire WHERE year > 1997"


@query(f"SELECT pixel_id, year, arg_max(value, (value > 0, priority)) AS value FROM ({VERSIONS}) GROUP BY 1, 2")
def c18_burned_wins(v) -> DataFrame:
    first = v.fire.select("pixel_id", "year", F.col("month").alias("value"), F.lit(1).alias("priority"))
    second = v.fire.where("year > 1997").select("pixel_id", "year", F.when(F.col("x") % 3 == 0, 0).otherwise(12).alias("value"), F.lit(2).alias("priority"))
    return catalog.burned_wins(first.union(second), ["pixel_id", "year"])


@query("SELECT concat('PAMPA-', coalesce(a.year, b.year)) AS stem, coalesce(a.pixel_id, b.pixel_id) AS pixel_id, coalesce(a.month, b.month + 100) AS value FROM (SELECT * FROM fire WHERE x < 30) a FULL JOIN (SELECT * FROM fire WHERE x >= 20) b ON a.year = b.year AND a.pixel_id = b.pixel_id")
def c19_merged_versions(v) -> DataFrame:
    name = lambda n: F.concat(F.lit("PAMPA-"), F.col("year").cast("string"), F.lit(n))
    return catalog.merged_versions(v.fire.where("x < 30").select(name("-v1").alias("name"), "pixel_id", F.col("month").alias("value")), v.fire.where("x >= 20").select(name("-v2").alias("name"), "pixel_id", (F.col("month") + 100).alias("value")))


@query("SELECT c_name AS name, c_custkey AS size FROM customer WHERE c_custkey % 4 = 1 OR c_custkey % 6 = 0")
def c21_to_copy(v) -> DataFrame:
    files = v.table("customer").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("size"))
    target = files.where("size % 4 <> 1").withColumn("size", F.when(F.col("size") % 6 == 0, F.col("size") + 1).otherwise(F.col("size")))
    return catalog.to_copy(files, target)


@query("SELECT concat(sensor, '_r', b, '_', y, '_mosaic') AS name, sensor, concat('r', b) AS region, concat('', y) AS year FROM (SELECT DISTINCT sensor, pixel_id % 5 AS b, year(acq_ts) AS y FROM obs) WHERE y < 1999")
def c22_unclassified(v) -> DataFrame:
    base = v.obs.select("sensor", (F.col("pixel_id") % 5).cast("string").alias("b"), F.year("acq_ts").cast("string").alias("y")).distinct()
    name = lambda tail: F.concat("sensor", F.lit("_r"), "b", F.lit("_"), "y", F.lit(tail))
    return catalog.unclassified(base.select(name("_mosaic").alias("name")), base.where("y >= '1999'").select(name("_result_v1").alias("name")))


@query(f"SELECT u.unit, arg_min(o.o_orderkey::VARCHAR, (o.o_orderdate, o.o_orderkey::VARCHAR)) AS name FROM (SELECT DISTINCT {U.format('l_shipdate')} AS unit FROM lineitem WHERE year(l_shipdate) = 1996) u JOIN orders o ON {U.format('o.o_orderdate')} = u.unit GROUP BY 1")
def c23_f2_images_of_units(v) -> DataFrame:
    images = v.table("orders").select(F.col("o_orderkey").cast("string").alias("name"), F.col("o_orderdate").cast("timestamp").alias("ts"))
    units = v.obs.where(F.year("acq_ts") == 1996).select(unit("acq_ts").alias("unit")).distinct()
    return catalog.images_of_units(images, units, "monthly")


@query(f"SELECT u.unit, arg_min(o.o_orderkey::VARCHAR, (o.o_orderdate, o.o_orderkey::VARCHAR)) AS name FROM (SELECT DISTINCT {U.format('l_shipdate')} AS unit FROM lineitem) u JOIN orders o ON {U.format('o.o_orderdate')} = u.unit GROUP BY 1")
def c23_f2_images_of_all_units(v) -> DataFrame:
    images = v.table("orders").select(F.col("o_orderkey").cast("string").alias("name"), F.col("o_orderdate").cast("timestamp").alias("ts"))
    return catalog.images_of_units(images, v.obs.select(unit("acq_ts").alias("unit")).distinct(), "monthly")


@query(f"SELECT DISTINCT {U.format('acq_ts')} AS unit FROM obs")
def d19_months(v) -> DataFrame:
    return catalog.months_present(v.obs.select(F.col("acq_ts").alias("ts")))


@query("SELECT sensor AS product, max(nir_dn) AS max, min(nir_dn) AS min, count(nir_dn) AS n, list_sort(list(DISTINCT qa_pixel)) AS bands, min(acq_ts) AS t_start, max(acq_ts) AS t_end FROM obs GROUP BY sensor")
def d18_profile(v) -> DataFrame:
    return catalog.profile(v.obs.select(F.col("sensor").alias("product"), F.col("nir_dn").alias("value"), F.col("qa_pixel").alias("band"), F.col("acq_ts").alias("ts")))


MO, ML = f"SELECT DISTINCT {U.format('o_orderdate')} AS unit FROM orders WHERE o_orderkey % 7 = 0 AND year(o_orderdate) <> 1996", f"SELECT DISTINCT {U.format('l_shipdate')} AS unit FROM lineitem WHERE l_orderkey % 11 = 0"


def two(v) -> tuple[DataFrame, DataFrame]:
    return v.table("orders").where("o_orderkey % 7 = 0 AND year(o_orderdate) <> 1996").select(unit("o_orderdate").alias("unit")).distinct(), v.obs.where("order_no % 11 = 0").select(unit("acq_ts").alias("unit")).distinct()


@query(f"SELECT 'both' AS kind, unit FROM ({MO} INTERSECT {ML}) UNION ALL SELECT 'gone', unit FROM ({ML} EXCEPT {MO}) UNION ALL SELECT 'all', unit FROM ({MO} UNION {ML})")
def g1_g5_set_operations(v) -> DataFrame:
    a, b = two(v)
    tag = lambda name, df: df.select(F.lit(name).alias("kind"), "unit")
    return tag("both", catalog.in_both(a, b)).union(tag("gone", catalog.without_tiles(b, a))).union(tag("all", catalog.all_units(a, b)))
