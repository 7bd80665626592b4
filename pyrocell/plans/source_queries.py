"""Scans, sources and sinks (A), as queries over the derived tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrocell import model
from pyrocell.functions import optics, products
from pyrocell.operators import catalog
from pyrocell.plans.registry import query
from pyrocell.plans.views import LAST_YEAR, YEARS
from pyrocell.sources import scans
from pyrocell.sources.shared import new_path


@query("""SELECT pixel_id, x, y, acq_ts, sensor, scene_id, order_no, line_no FROM obs
WHERE acq_ts >= TIMESTAMP '1997-01-01' AND acq_ts < TIMESTAMP '1998-01-01' AND x BETWEEN 5 AND 30 AND y BETWEEN 0 AND 1000""")
def a1_scene_scan(v) -> DataFrame:
    out = scans.scene_scan(v.obs, datetime(1997, 1, 1), datetime(1998, 1, 1), (5, 0, 30, 1000))
    return out.select("pixel_id", "x", "y", "acq_ts", "sensor", "scene_id", "order_no", "line_no")


@query("""SELECT CAST(year(acq_ts) AS INT) AS year, sensor, count(*) AS n FROM obs
WHERE (year(acq_ts) <= 1998 AND sensor = 'LT05') OR (year(acq_ts) BETWEEN 1999 AND 2012 AND sensor IN ('LT05', 'LE07'))
   OR (year(acq_ts) BETWEEN 2013 AND 2021 AND sensor IN ('LE07', 'LC08')) OR (year(acq_ts) >= 2022 AND sensor IN ('LC08', 'LC09')) GROUP BY 1, 2""")
def a2_constellation(v) -> DataFrame:
    return scans.of_constellation(v.obs).groupBy(F.year("acq_ts").alias("year"), "sensor").agg(F.count("*").alias("n"))


@query("SELECT sensor, count(*) AS n, min(acq_ts) AS first_ts, max(acq_ts) AS last_ts FROM obs GROUP BY sensor")
def a3_merged_collections(v) -> DataFrame:
    parts = [v.obs.where(F.col("sensor") == s) for s in ("LT05", "LE07", "LC08", "LC09")]
    return model.merged(parts).groupBy("sensor").agg(F.count("*").alias("n"), F.min("acq_ts").alias("first_ts"), F.max("acq_ts").alias("last_ts"))


BLOCKED = "SELECT scene_id FROM obs GROUP BY scene_id HAVING min(qa_pixel) >= 128"


@query(f"SELECT scene_id, count(*) AS n FROM obs WHERE scene_id NOT IN ({BLOCKED}) GROUP BY scene_id")
def a4_without_blocked(v) -> DataFrame:
    blocked = v.obs.groupBy("scene_id").agg(F.min("qa_pixel").alias("q")).where("q >= 128")
    return scans.without_blocked(v.obs, blocked).groupBy("scene_id").agg(F.count("*").alias("n"))


SCORES = "SELECT scene_id, pixel_id, max(cloud_probability) / 100.0::DOUBLE AS cs FROM obs GROUP BY 1, 2"


@query(f"SELECT o.scene_id, o.pixel_id, o.order_no, o.line_no, s.cs FROM obs o JOIN ({SCORES}) s USING (scene_id, pixel_id) WHERE s.cs >= 0.4")
def a5_b11_cloud_score(v) -> DataFrame:
    scores = v.obs.groupBy("scene_id", "pixel_id").agg((F.max("cloud_probability") / F.lit(100.0)).alias("cs"))
    return scans.with_scores(v.obs, scores).where(optics.cloud_score_clear(F.col("cs"))).select("scene_id", "pixel_id", "order_no", "line_no", "cs")


@query("SELECT pixel_id, year, class FROM cover_all")
def a6_carried_forward(v) -> DataFrame:
    return scans.carried_forward(v.cover).select("pixel_id", "year", "class")


@query("SELECT c.pixel_id, c.year, c.class, b.biome AS country FROM cover c JOIN territory t USING (pixel_id) JOIN biomes b ON b.code = t.biome_id WHERE b.biome = 'ASIA'")
def a7_country_cover(v) -> DataFrame:
    named = v.cover.select("pixel_id", "year", "class").join(v.territory.select("pixel_id", F.col("biome_id").alias("code")), "pixel_id").join(F.broadcast(v.biomes), "code").withColumnRenamed("biome", "country")
    return scans.of_country(named, "ASIA").select("pixel_id", "year", "class", "country")


@query("""SELECT pixel_id, year, month, 'dates' AS source FROM (
  SELECT pixel_id, CAST(year(acq_ts) AS INT) AS year, CAST(month(make_date(year(acq_ts), 1, 1) + (line_no * 40 - 1)::INT) AS INT) AS month FROM obs WHERE line_no <> 3)
UNION ALL SELECT pixel_id, CAST(year(acq_ts) AS INT), CAST(month(acq_ts) AS INT), 'heat' FROM obs WHERE b8a IS NOT NULL
UNION ALL SELECT pixel_id, year, month, 'codes' FROM fire
UNION ALL SELECT DISTINCT pixel_id, year, CAST(NULL AS INT), 'yearly' FROM fire""")
def a8_reference_products(v) -> DataFrame:
    dates = v.obs.select("pixel_id", F.col("acq_ts").alias("ts"), F.when(F.col("line_no") != 3, F.col("line_no") * 40).otherwise(0).alias("burn_date"))
    heat = v.obs.select("pixel_id", F.col("acq_ts").alias("ts"), F.col("b8a").alias("t21"))
    yearly = model.year_stack(v.fire.withColumn("value", F.lit(1)), [*YEARS, LAST_YEAR], prefix="burned")
    codes = v.fire.select("pixel_id", "year", F.col("month").alias("value"))
    return scans.reference_products([("burn dates", dates, "dates"), ("brightness", heat, "heat"), ("month codes", codes, "codes"), ("yearly", yearly, "yearly")])


@query("SELECT pixel_id, year, month FROM fire")
def a9_years_to_rows(v) -> DataFrame:
    wide = model.year_stack(v.fire.withColumn("value", F.col("month") * 100 + 3), [*YEARS, LAST_YEAR], prefix="burned_monthly")
    return scans.years_to_rows(wide, legacy=True)


@query("SELECT c.pixel_id, c.year, c.class, CAST(m.m AS INT) AS month FROM cover c, range(1, 13) AS m(m)")
def a10_months_of_cover(v) -> DataFrame:
    return scans.months_of(v.cover.select("pixel_id", "year", "class"))


@query("SELECT event_id, ts, pixel_id, x, y FROM hotspots WHERE year(ts) = 2024 AND month(ts) IN (1, 2) AND x BETWEEN 0 AND 25 AND y BETWEEN 0 AND 20")
def a11_heat_points(v) -> DataFrame:
    return scans.heat_points(v.hotspots, 2024, [1, 2], (0, 0, 25, 20)).select("event_id", "ts", "pixel_id", "x", "y")


@query("SELECT pixel_id, make_date(year, month, 1) AS stamp FROM fire")
def a12_month_stamp(v) -> DataFrame:
    return v.fire.select("pixel_id", scans.month_start(F.col("year"), F.col("month")).alias("stamp"))


@query("SELECT order_no, line_no, CAST(b8a AS DOUBLE) AS red, CAST(b9 AS DOUBLE) AS nir, label FROM obs WHERE b8a IS NOT NULL AND b9 IS NOT NULL")
def a13_samples(v) -> DataFrame:
    rows = v.obs.select("order_no", "line_no", F.coalesce(F.col("b8a").cast("double"), F.lit(float("nan"))).alias("red"), F.col("b9").cast("double").alias("nir"), "label")
    return scans.samples_scan(rows, ["red", "nir", "label"])


@query("SELECT pixel_id, month, year FROM fire WHERE year IN (1996, 1997)")
def a14_a15_a16_yearly_product(v) -> DataFrame:
    path = new_path(v.spark)
    scans.write_product(v.fire.select("pixel_id", "month", "year"), path)
    scans.write_product(v.fire.where("year = 1997").select("pixel_id", "month", "year"), path)
    return scans.scars_scan(v.spark, path, [1996, 1997]).select("pixel_id", "month", "year")


@query("SELECT year, class, sum(area_km2) * 100 AS area_ha FROM fire f JOIN cover_all c USING (pixel_id, year) JOIN territory t USING (pixel_id) GROUP BY 1, 2")
def a17_statistics_csv(v) -> DataFrame:
    area = v.fire.select("pixel_id", "year").join(scans.carried_forward(v.cover).select("pixel_id", "year", "class"), ["pixel_id", "year"]).join(v.territory.select("pixel_id", "area_km2"), "pixel_id").groupBy("class", "year").agg((F.sum("area_km2") * 100).alias("area_ha"))
    path = new_path(v.spark)
    scans.write_statistics(area, path, ["year", "class", "area_ha"])
    return v.spark.read.schema("year int, class int, area_ha double").option("header", True).csv(path)


@query("SELECT o.pixel_id, o.order_no, o.line_no, CAST(o.red_dn AS FLOAT) AS red, CAST(o.nir_dn AS FLOAT) AS nir, CAST(o.swir1_dn AS FLOAT) AS swir1, CAST(o.swir2_dn AS FLOAT) AS swir2 FROM obs o")
def a18_mosaic_bands(v) -> DataFrame:
    named = v.obs.select("pixel_id", "order_no", "line_no", *[F.col(f"{b}_dn").alias(b) for b in ("red", "nir", "swir1", "swir2")])
    return scans.mosaic_bands(named, ["pixel_id", "order_no", "line_no"])


@query("""SELECT pixel_id, CAST(max(red_dn) AS FLOAT) AS red, CAST(max(nir_dn) AS FLOAT) AS nir, CAST(max(swir1_dn) AS FLOAT) AS swir1, CAST(max(swir2_dn) AS FLOAT) AS swir2,
  CAST(pixel_id % 2 AS INT) AS label FROM obs WHERE pixel_id % 7 < 3 GROUP BY pixel_id""")
def a19_labelled_samples(v) -> DataFrame:
    mosaic = v.obs.groupBy("pixel_id").agg(*[F.max(f"{b}_dn").alias(b) for b in ("red", "nir", "swir1", "swir2")])
    labels = v.territory.where("pixel_id % 7 < 3").select("pixel_id", (F.col("pixel_id") % 2).cast("int").alias("label"))
    return scans.labelled_samples(mosaic, labels)


@query("SELECT pixel_id, CAST(CASE WHEN v BETWEEN -32768 AND 32767 AND v <> 0 THEN v END AS SMALLINT) AS value FROM (SELECT pixel_id, CAST(sum(nir_dn) - 60000 AS BIGINT) AS v FROM obs GROUP BY pixel_id)")
def a20_typed_product(v) -> DataFrame:
    return model.cast_product(v.obs.groupBy("pixel_id").agg((F.sum("nir_dn") - 60000).alias("value")), "int16")


@query("SELECT pixel_id, " + ", ".join(f"CAST(max(CASE WHEN year = {y} THEN month END) AS INT) AS burned_{y}" for y in [*YEARS, LAST_YEAR]) + " FROM fire GROUP BY pixel_id")
def a21_year_stack(v) -> DataFrame:
    return model.year_stack(v.fire.withColumn("value", F.col("month")), [*YEARS, LAST_YEAR], prefix="burned")


@query("""SELECT r_name AS country, CASE WHEN n_nationkey % 2 = 0 THEN 'fire' ELSE 'monitor' END AS theme, concat('collection_0', n_nationkey % 3) AS collection, n_name AS product, n_nationkey % 4 <> 1 AS visible
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 4 NOT IN (1, 2)
UNION ALL SELECT 'ASIA', 'fire', 'collection_09', 'added', TRUE""")
def a22_catalog(v) -> DataFrame:
    n = v.table("nation").join(F.broadcast(v.table("region")), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = n.select("r_name", F.when(F.col("n_nationkey") % 2 == 0, "fire").otherwise("monitor").alias("theme"), F.concat(F.lit("collection_0"), (F.col("n_nationkey") % 3).cast("string")).alias("collection"), F.col("n_name").alias("product"), (F.col("n_nationkey") % 4 != 1).alias("visible"), (F.col("n_nationkey") % 4).alias("k"))
    item = F.struct("product", F.lit(None).cast("string").alias("asset"), F.lit("byte").alias("type"), F.lit(False).alias("vectorize"), "visible", F.lit(30).alias("scale"))
    nested = rows.groupBy("r_name", "theme", "collection").agg(F.collect_list(item).alias("products")).groupBy("r_name", "theme").agg(F.collect_list(F.struct("collection", "products")).alias("collections")).groupBy(F.col("r_name").alias("country")).agg(F.collect_list(F.struct("theme", "collections")).alias("themes"))
    flat = catalog.catalog_rows(nested)
    new = v.spark.sql("SELECT 'ASIA' AS country, 'fire' AS theme, 'collection_09' AS collection, 'added' AS product, CAST(NULL AS STRING) AS asset, 'byte' AS type, false AS vectorize, true AS visible, 30 AS scale")
    gone = rows.where("k = 2").select("product").distinct()
    return catalog.removed(catalog.upserted(flat, new), gone).select("country", "theme", "collection", "product", "visible")


@query("""SELECT concat('2024_', lpad(concat('', page_id % 12 + 1), 2, '0')) AS unit, count(*) AS tiles FROM pages WHERE page_id % 5 <> 0 GROUP BY 1""")
def a23_d20_artifact_units(v) -> DataFrame:
    unit = F.concat(F.lit("2024_"), F.lpad((F.col("page_id") % 12 + 1).cast("string"), 2, "0"))
    path = F.when(F.col("page_id") % 5 == 0, F.lit("root/temp/other.tif")).otherwise(F.concat(F.lit("root/temp/fire_monitor_v1_burned_"), unit, F.lit("_"), F.col("page_id").cast("string"), F.lit(".tif")))
    files = v.table("pages").select(path.alias("path"), F.col("page_id").alias("size"))
    return catalog.tile_counts(catalog.artifact_units(files, "fire_monitor_v1_burned_"))


@query("""SELECT url, CASE WHEN lower(url) LIKE '%monthly%' THEN 'monthly' WHEN lower(url) LIKE '%annual%' THEN 'annual' WHEN regexp_matches(lower(url), 'frequency|accumulated|recurrence|time_after|year_last|interval') THEN 'period' ELSE 'other' END AS kind,
regexp_replace(regexp_replace(url, '^collection[0-9]+_?', ''), '_v[0-9]+$', '') AS short FROM (SELECT CASE page_id % 5 WHEN 0 THEN 'collection4_annual_burned_v1' WHEN 1 THEN 'monthly_burned_v12' WHEN 2 THEN 'fire_frequency_v2' WHEN 3 THEN 'collection41_time_after_fire' ELSE concat('product', page_id, '_v', page_id) END AS url FROM pages)""")
def b34_product_names(v) -> DataFrame:
    k = F.col("page_id") % 5
    name = F.when(k == 0, "collection4_annual_burned_v1").when(k == 1, "monthly_burned_v12").when(k == 2, "fire_frequency_v2").when(k == 3, "collection41_time_after_fire").otherwise(F.concat(F.lit("product"), F.col("page_id").cast("string"), F.lit("_v"), F.col("page_id").cast("string")))
    return v.table("pages").select(name.alias("url")).select("url", products.product_kind(F.col("url")).alias("kind"), products.short_name(F.col("url")).alias("short"))
