"""Optics, quality masks, indices and composites (B1-B21, D1-D5, C8, S)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrocell import model
from pyrocell.functions import optics, products, provenance
from pyrocell.operators import composite, footprints, sentinel, severity
from pyrocell.plans.registry import query

TIES = ["acq_ts", "order_no", "line_no"]
ID = ["order_no", "line_no"]


def indexed(v, index) -> DataFrame:
    return v.obs.withColumn("nbr", index(F.col("nir_dn"), F.col("swir2_dn")))


@query("""SELECT order_no, line_no, nir_dn * 0.0000275::DOUBLE - 0.2::DOUBLE AS nir, st_dn * 0.00341802::DOUBLE + 149.0::DOUBLE AS st,
  floor((red_dn * 0.0000275::DOUBLE - 0.2::DOUBLE) * 10000.0::DOUBLE - 55.0::DOUBLE + 0.5::DOUBLE) / 10000.0::DOUBLE AS red FROM obs WHERE sensor IN ('LC08', 'LC09')""")
def b1_b2_reflectance(v) -> DataFrame:
    new = v.obs.where(F.col("sensor").isin("LC08", "LC09"))
    red = optics.rectified(optics.reflectance(F.col("red_dn")))
    return new.select(*ID, optics.reflectance(F.col("nir_dn")).alias("nir"), optics.temperature(F.col("st_dn")).alias("st"), red.alias("red"))


@query("""SELECT sensor, count(*) AS n, sum(CASE WHEN sensor IN ('LT05', 'LE07') THEN (qa_pixel & 8 = 0 AND qa_pixel & 32 = 0)::INT ELSE (NOT ((qa_pixel & 8 <> 0 AND qa_pixel & 512 <> 0) OR qa_pixel & 16 <> 0))::INT END)::BIGINT AS clear,
  sum((qa_pixel & 192 <> 0)::INT)::BIGINT AS clear_or_water, sum((qa_radsat & 127 = 0)::INT)::BIGINT AS unsaturated, sum(((qa_pixel >> 3) & 7)::INT)::BIGINT AS bits_3_5 FROM obs GROUP BY sensor""")
def b3_b7_quality_bits(v) -> DataFrame:
    n = lambda c: F.sum(c.cast("int"))
    qa, sat = F.col("qa_pixel"), F.col("qa_radsat")
    clear = F.when(F.col("sensor").isin("LT05", "LE07"), optics.clear_old(qa)).otherwise(optics.clear_new(qa))
    return v.obs.groupBy("sensor").agg(F.count("*").alias("n"), n(clear).alias("clear"), n(optics.clear_or_water(qa)).alias("clear_or_water"), n(optics.unsaturated(sat)).alias("unsaturated"), n(optics.bits(qa, 3, 5)).alias("bits_3_5"))



@query("SELECT order_no, line_no FROM obs WHERE blue_dn * 0.0000275::DOUBLE - 0.2::DOUBLE > 0 AND green_dn * 0.0000275::DOUBLE - 0.2::DOUBLE > 0 AND red_dn * 0.0000275::DOUBLE - 0.25::DOUBLE > 0 AND nir_dn * 0.0000275::DOUBLE - 0.2::DOUBLE > 0 AND swir1_dn * 0.0000275::DOUBLE - 0.2::DOUBLE > 0 AND swir2_dn * 0.0000275::DOUBLE - 0.2::DOUBLE > 0")
def b8_positive(v) -> DataFrame:
    r = {b: optics.reflectance(F.col(f"{b}_dn")) for b in optics.BANDS}
    r["red"] = F.col("red_dn") * 0.0000275 - 0.25
    return v.obs.where(optics.positive(*r.values())).select(*ID)


@query("""SELECT 'low' AS mask, count(*) AS n FROM obs WHERE b8a IS NOT NULL AND b9 IS NOT NULL AND cloud_probability < 65
UNION ALL SELECT 'scl', count(*) FROM obs WHERE b8a IS NOT NULL AND b9 IS NOT NULL AND cloud_probability < 65 AND scl NOT IN (1, 3, 8, 9)
UNION ALL SELECT 'strict', count(*) FROM obs WHERE b8a IS NOT NULL AND b9 IS NOT NULL AND cloud_probability < 65 AND scl NOT IN (1, 3, 6, 8, 9, 10) AND qa60 < 1""")
def b9_b10_b12_sentinel_masks(v) -> DataFrame:
    low = optics.low_cloud(F.col("cloud_probability"), F.col("b8a"), F.col("b9"))
    tests = {"low": low, "scl": low & optics.scene_class_clear(F.col("scl")), "strict": low & optics.strictly_clear(F.col("scl"), F.col("qa60"))}
    counts = v.obs.agg(*[F.count_if(t).alias(n) for n, t in tests.items()])
    return counts.unpivot([], list(tests), "mask", "n")


@query("""WITH o AS (SELECT concat(sensor, '_', year(acq_ts)) AS scene_id, x, y, max(cloud_probability) AS p, min(scl) AS scl, min(nir_dn) AS nir FROM obs GROUP BY 1, 2, 3),
c AS (SELECT scene_id, x, y FROM o WHERE p > 97),
t AS (SELECT DISTINCT scene_id, x + k AS x, y FROM c, range(1, 21) r(k)),
b AS (SELECT * FROM c UNION SELECT o.scene_id, o.x, o.y FROM o JOIN t USING (scene_id, x, y) WHERE o.scl <> 6 AND o.nir < 10500),
m AS (SELECT scene_id, x + i AS x, y + j AS y FROM b, range(-1, 1) a(i), range(-1, 1) d(j) GROUP BY 1, 2, 3 HAVING count(*) = 4),
w AS (SELECT DISTINCT scene_id, x + i AS x, y + j AS y FROM m, range(0, 2) a(i), range(0, 2) d(j)),
q AS (SELECT DISTINCT scene_id, x + i AS x, y FROM w, range(-5, 6) a(i)),
g AS (SELECT DISTINCT scene_id, x, y + j AS y FROM q, range(-5, 6) d(j))
SELECT o.scene_id, o.x, o.y FROM o WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.scene_id = o.scene_id AND g.x = o.x AND g.y = o.y)""")
def b13_cloud_and_shadow(v) -> DataFrame:
    """A scene is a sensor's year; sizes are the operator's, the two levels are those of these data."""
    o = v.obs.groupBy(F.concat_ws("_", "sensor", F.year("acq_ts")).alias("scene_id"), "x", "y").agg(F.max("cloud_probability").alias("cloud_probability"), F.min("scl").alias("scl"), F.min("nir_dn").alias("nir_dn")).withColumn("solar_azimuth", F.lit(90.0))
    return sentinel.without_cloud_and_shadow(o, probability=97, dark=10500).select("scene_id", "x", "y")


@query("""WITH o AS (SELECT concat(sensor, '_', year(acq_ts)) AS scene_id, x, y, max(cloud_probability) AS p, min(scl) AS scl, min(nir_dn) AS nir, radians(90.0::DOUBLE - (37.0::DOUBLE + 13.0::DOUBLE * (year(acq_ts) - 1990) + 7.0::DOUBLE * ascii(sensor[4]))) AS a FROM obs GROUP BY 1, 2, 3, 7),
c AS (SELECT scene_id, x, y, a FROM o WHERE p > 97),
t AS (SELECT DISTINCT scene_id, x + CAST(round(k * cos(a)) AS INT) AS x, y - CAST(round(k * sin(a)) AS INT) AS y FROM c, range(1, 21) r(k)),
b AS (SELECT scene_id, x, y FROM c UNION SELECT o.scene_id, o.x, o.y FROM o JOIN t USING (scene_id, x, y) WHERE o.scl <> 6 AND o.nir < 10500),
m AS (SELECT scene_id, x + i AS x, y + j AS y FROM b, range(-1, 1) a(i), range(-1, 1) d(j) GROUP BY 1, 2, 3 HAVING count(*) = 4),
w AS (SELECT DISTINCT scene_id, x + i AS x, y + j AS y FROM m, range(0, 2) a(i), range(0, 2) d(j)),
q AS (SELECT DISTINCT scene_id, x + i AS x, y FROM w, range(-5, 6) a(i)),
g AS (SELECT DISTINCT scene_id, x, y + j AS y FROM q, range(-5, 6) d(j))
SELECT o.scene_id, o.x, o.y FROM o WHERE NOT EXISTS (SELECT 1 FROM g WHERE g.scene_id = o.scene_id AND g.x = o.x AND g.y = o.y)""")
def b13_shadows_by_azimuth(v) -> DataFrame:
    """As above, with an azimuth of its own for each scene."""
    azimuth = 37.0 + 13.0 * (F.year("acq_ts") - 1990) + 7.0 * F.ascii(F.substring("sensor", 4, 1))
    o = v.obs.groupBy(F.concat_ws("_", "sensor", F.year("acq_ts")).alias("scene_id"), "x", "y", azimuth.alias("solar_azimuth"))
    o = o.agg(F.max("cloud_probability").alias("cloud_probability"), F.min("scl").alias("scl"), F.min("nir_dn").alias("nir_dn"))
    return sentinel.without_cloud_and_shadow(o, probability=97, dark=10500).select("scene_id", "x", "y")


@query("""SELECT order_no, line_no, nir_dn * 0.0000275::DOUBLE - 0.2::DOUBLE AS nir, CASE WHEN sensor IN ('LC08', 'LC09') THEN floor((red_dn * 0.0000275::DOUBLE - 0.2::DOUBLE) * 10000.0::DOUBLE - 55.0::DOUBLE + 0.5::DOUBLE) / 10000.0::DOUBLE ELSE red_dn * 0.0000275::DOUBLE - 0.2::DOUBLE END AS red, st_dn * 0.00341802::DOUBLE + 149.0::DOUBLE AS st FROM obs""")
def b1_reflectance_of_all_sensors(v) -> DataFrame:
    """All four sensors; the correction is that of the newer two."""
    red = optics.corrected(F.col("sensor"), optics.reflectance(F.col("red_dn")))
    return v.obs.select(*ID, optics.reflectance(F.col("nir_dn")).alias("nir"), red.alias("red"), optics.temperature(F.col("st_dn")).alias("st"))


SIDES = "CASE sensor WHEN 'LT05' THEN 0 WHEN 'LE07' THEN 2 WHEN 'LC08' THEN 4 ELSE 6 END"


@query(f"""WITH o AS (SELECT order_no, line_no, x, y, {SIDES} AS k FROM obs), d AS (SELECT *, greatest(k - x, 0, x - (40 + k)) AS dx, greatest(2 * k - y, 0, y - (30 + 3 * k)) AS dy, least(x - k, 40 + k - x, y - 2 * k, 30 + 3 * k - y) AS inner_d FROM o)
SELECT order_no, line_no FROM d WHERE CASE WHEN dx > 0 OR dy > 0 THEN sqrt(dx * dx + dy * dy) ELSE inner_d END >= 3""")
def b15_scene_footprints(v) -> DataFrame:
    """Each sensor's scene has a footprint of its own; a cell stands for a hundred-thousandth of a degree."""
    d, k = 1e-5, F.expr(SIDES)
    corner = lambda x, y: F.struct((x * d).alias("lon"), (y * d).alias("lat"))
    ring = F.array(corner(k, 2 * k), corner(k + 40, 2 * k), corner(k + 40, 3 * k + 30), corner(k, 3 * k + 30))
    scenes = v.spark.createDataFrame([("LT05",), ("LE07",), ("LC08",), ("LC09",)], "sensor string").select("sensor", ring.alias("ring"))
    o = v.obs.select(*ID, "sensor", (F.col("x") * d).alias("lon"), (F.col("y") * d).alias("lat"))
    return footprints.trimmed(o, scenes, 3 * 1.1132 - 1e-3, 8 * d, "sensor").select(*ID)


@query("SELECT order_no, line_no, blue_dn AS blue, green_dn AS green, red_dn AS red, nir_dn AS nir, swir1_dn AS swir1, swir2_dn AS swir2 FROM obs")
def b14_band_names(v) -> DataFrame:
    raw = [v.obs.where(F.col("sensor") == s).select(*ID, *[F.col(f"{b}_dn").alias(n) for b, n in zip(optics.BANDS, names, strict=True)]) for s, names in optics.SOURCE_BANDS.items() if s != "S2"]
    return model.merged([optics.harmonised(df, s, ID) for df, s in zip(raw, [s for s in optics.SOURCE_BANDS if s != "S2"], strict=True)])


@query("SELECT pixel_id FROM territory WHERE CASE WHEN y <= 60 THEN least(x, 49 - x, y, 60 - y) ELSE y - 60 END >= 3")
def b15_scene_edge(v) -> DataFrame:
    """The ring is in cells that stand for a hundred-thousandth of a degree, so 3 cells are 3 * 1.1132 metres."""
    d = 1e-5
    ring = F.array(*[F.struct(F.lit(a * d).alias("lon"), F.lit(b * d).alias("lat")) for a, b in ((0, 0), (49, 0), (49, 60), (0, 60))])
    far = optics.edge_distance_m(F.col("x") * d, F.col("y") * d, ring) >= 3 * 1.1132 - 1e-3
    return v.territory.where(far).select("pixel_id")


@query("SELECT order_no, line_no, CAST(trunc((1.0::DOUBLE - r) * 1000.0::DOUBLE) AS INT) AS burn_index, CAST(trunc(-(r + 1.0::DOUBLE) * 1000.0::DOUBLE) AS INT) AS severity_index FROM (SELECT *, (nir_dn - swir2_dn)::DOUBLE / (nir_dn + swir2_dn) AS r FROM obs)")
def b16_b17_burn_indices(v) -> DataFrame:
    return v.obs.select(*ID, optics.burn_index(F.col("nir_dn"), F.col("swir2_dn")).alias("burn_index"), optics.severity_index(F.col("nir_dn"), F.col("swir2_dn")).alias("severity_index"))


def fractions() -> str:
    """Unmixing as SQL: the pseudo-inverse's rows as sums over the bands."""
    inverse = np.linalg.pinv(np.array(list(optics.ENDMEMBERS.values())).T)
    total = lambda row: " + ".join(f"({b}_dn * 0.0000275::DOUBLE - 0.2::DOUBLE) * 10000.0::DOUBLE * ({float(w)!r})::DOUBLE" for b, w in zip(optics.BANDS, row, strict=True))
    each = ", ".join(f"CAST(floor(least(greatest({total(row)}, 0.0) * 100.0, 255.0)) AS INT) AS {n}" for n, row in zip(optics.ENDMEMBERS, inverse, strict=True))
    return f"SELECT *, abs(gv + npv + soil + cloud - 100) AS shade, gv * 100.0::DOUBLE / nullif(gv + npv + soil + cloud, 0) AS gvs, gv + soil + cloud AS \"npvSoil\" FROM (SELECT order_no, line_no, {each} FROM obs)"


@query(fractions())
def b18_unmixing(v) -> DataFrame:
    r = v.obs.select(*ID, *[optics.reflectance(F.col(f"{b}_dn")).alias(b) for b in optics.BANDS])
    return optics.unmixed(r).drop(*optics.BANDS)


@query("""SELECT order_no, line_no, scene_id AS scene_name, CAST(CASE sensor WHEN 'LT05' THEN 5 WHEN 'LE07' THEN 7 WHEN 'LC08' THEN 8 ELSE 9 END AS INT) AS sensor_no, CAST(substr(scene_id, 6, 3) AS INT) AS path, CAST(substr(scene_id, 9, 3) AS INT) AS row,
  CAST(dayofyear(acq_ts) AS INT) AS "dayOfYear", CAST(month(acq_ts) AS INT) AS "monthOfYear", CAST(year(acq_ts) AS INT) AS year, CAST(day(acq_ts) AS INT) AS "dayOfMonth" FROM obs""")
def b19_b21_landsat_flags(v) -> DataFrame:
    f = provenance.landsat_flags(v.obs)
    name = provenance.landsat_scene(F.col("sensor_no"), F.col("path"), F.col("row"), F.col("year"), F.col("monthOfYear"), F.col("dayOfMonth"))
    return f.select(*ID, name.alias("scene_name"), "sensor_no", "path", "row", "dayOfYear", "monthOfYear", "year", "dayOfMonth")


@query("""SELECT event_id, concat(strftime(ts, '%Y%m%d'), 'T', strftime(ts, '%H%M%S'), '_', strftime(ts, '%Y%m%d'), 'T', strftime(ts, '%H%M%S'), '_T', 21 + event_id % 3, 'K', chr(65 + CAST(event_id % 5 AS INT)), 'A') AS scene_name,
  CAST(event_id % 3 * 5 + event_id % 5 AS INT) AS propertie_4 FROM events WHERE event_type = 'error'""")
def b20_b21_sentinel_flags(v) -> DataFrame:
    tiles = v.spark.createDataFrame([(f"{21 + a}K{chr(65 + b)}A", a * 5 + b) for a in range(3) for b in range(5)], "tile string, number int")
    stamp = F.date_format("ts", "yyyyMMdd'T'HHmmss")
    tile = F.concat((F.col("event_id") % 3 + 21).cast("string"), F.lit("K"), F.char((F.col("event_id") % 5 + 65).cast("int")), F.lit("A"))
    scenes = v.hotspots.select("event_id", F.concat(stamp, F.lit("_"), stamp, F.lit("_T"), tile).alias("scene_id"))
    return provenance.sentinel_scene(provenance.sentinel_flags(scenes, F.broadcast(tiles)), F.broadcast(tiles)).select("event_id", "scene_name", "propertie_4")


@query("""SELECT pixel_id, year, nbr, month, scene_id FROM (SELECT pixel_id, CAST(year(acq_ts) AS INT) AS year, nbr, CAST(month(acq_ts) AS INT) AS month, scene_id,
  row_number() OVER (PARTITION BY pixel_id, year(acq_ts) ORDER BY nbr DESC, acq_ts DESC, order_no DESC, line_no DESC) AS rn FROM nbr
  WHERE (CASE WHEN sensor IN ('LT05', 'LE07') THEN qa_pixel & 40 = 0 ELSE NOT ((qa_pixel & 8 <> 0 AND qa_pixel & 512 <> 0) OR qa_pixel & 16 <> 0) END) AND qa_pixel & 192 <> 0 AND qa_radsat & 127 = 0) WHERE rn = 1""")
def d1_quality_mosaic(v) -> DataFrame:
    good = indexed(v, optics.burn_index).where(optics.valid(F.col("sensor"), F.col("qa_pixel"), F.col("qa_radsat")))
    dated = good.withColumns({"year": F.year("acq_ts"), "month": F.month("acq_ts")})
    return composite.quality_mosaic(dated, ["pixel_id", "year"], "nbr", ["month", "scene_id"], TIES)


@query("SELECT pixel_id, nir_dn AS value FROM (SELECT *, row_number() OVER (PARTITION BY pixel_id ORDER BY acq_ts DESC, order_no DESC, line_no DESC) AS rn FROM obs WHERE b8a IS NOT NULL) WHERE rn = 1")
def d2_f1_last_mosaic(v) -> DataFrame:
    rows = v.obs.withColumn("value", F.when(F.col("b8a").isNotNull(), F.col("nir_dn")))
    return model.mosaic(rows, ["pixel_id"], "value", TIES)


@query("SELECT pixel_id, avg(label::DOUBLE) AS mean, (avg(label::DOUBLE) >= 1)::INT AS burned, (sum(label) >= 1)::INT AS any_burned FROM obs GROUP BY pixel_id")
def d3_d4_mean_and_any(v) -> DataFrame:
    return composite.mean_and_any(v.obs, ["pixel_id"], "label")


@query("SELECT pixel_id, year, (class IN (24, 30, 33))::INT AS excluded FROM cover")
def d5_any_class(v) -> DataFrame:
    return v.cover.select("pixel_id", "year", F.col("class").isin(24, 30, 33).cast("int").alias("excluded"))


@query("""SELECT pixel_id, year, month FROM (SELECT n.pixel_id, f.year, CAST(month(n.acq_ts) AS INT) AS month, row_number() OVER (PARTITION BY n.pixel_id, f.year ORDER BY nbr DESC, acq_ts DESC, order_no DESC, line_no DESC) AS rn
  FROM nbr n JOIN fire f ON f.pixel_id = n.pixel_id AND f.year = year(n.acq_ts)) WHERE rn = 1""")
def c8_month_of_burn(v) -> DataFrame:
    return composite.month_of_burn(indexed(v, optics.burn_index), v.fire, TIES)


POST = "SELECT pixel_id, year(acq_ts) AS year, max(nbr) AS post FROM inv GROUP BY 1, 2"
PRE = """SELECT f.pixel_id, f.year, f.month, coalesce(
  (SELECT max(o.nbr) FROM inv o WHERE o.pixel_id = f.pixel_id AND o.acq_ts >= make_date(f.year, f.month, 1) - INTERVAL 2 MONTH AND o.acq_ts < make_date(f.year, f.month, 1) - INTERVAL 1 MONTH),
  (SELECT arg_max(o.nbr, (o.acq_ts, o.order_no, o.line_no)) FROM inv o WHERE o.pixel_id = f.pixel_id AND o.acq_ts >= make_date(f.year, f.month, 1) - INTERVAL 6 MONTH AND o.acq_ts < make_date(f.year, f.month, 1))) AS pre FROM fire f"""


@query(f"SELECT * FROM ({PRE}) WHERE pre IS NOT NULL")
def c9_c10_s2_pre_fire(v) -> DataFrame:
    return severity.pre_fire(indexed(v, optics.severity_index), v.fire, TIES)


@query("SELECT pixel_id, CAST(year(acq_ts) AS INT) AS year, max(nbr) AS post FROM inv GROUP BY 1, 2")
def s1_post_fire(v) -> DataFrame:
    return severity.post_fire(indexed(v, optics.severity_index), TIES)


@query(f"""SELECT pixel_id, CAST(p.year AS INT) AS year, month, post - pre AS dnbr, CAST(CASE WHEN post - pre < 0 THEN 1 WHEN post - pre < 270 THEN 2 WHEN post - pre < 440 THEN 3 WHEN post - pre < 660 THEN 4 WHEN post - pre <= 1350 THEN 5 ELSE 6 END AS INT) AS severity
FROM ({PRE}) p JOIN ({POST}) q USING (pixel_id, year) WHERE pre IS NOT NULL""")
def s3_b26_severity(v) -> DataFrame:
    return severity.dnbr(indexed(v, optics.severity_index), v.fire, TIES)


@query(f"""SELECT CAST(p.year AS INT) AS year, CAST(CASE WHEN post - pre < 0 THEN 1 WHEN post - pre < 270 THEN 2 WHEN post - pre < 440 THEN 3 WHEN post - pre < 660 THEN 4 WHEN post - pre <= 1350 THEN 5 ELSE 6 END AS INT) AS severity, count(*) AS pixels
FROM ({PRE}) p JOIN ({POST}) q USING (pixel_id, year) WHERE pre IS NOT NULL GROUP BY 1, 2""")
def s4_severity_by_year(v) -> DataFrame:
    return severity.dnbr(indexed(v, optics.severity_index), v.fire, TIES).groupBy("year", "severity").agg(F.count("*").alias("pixels"))


@query("""SELECT order_no, CAST(CASE WHEN v <= 0 THEN NULL WHEN v < 10 THEN 1 WHEN v < 250 THEN 2 WHEN v < 500 THEN 3 WHEN v < 5000 THEN 4 WHEN v < 10000 THEN 5 WHEN v < 50000 THEN 6 WHEN v < 100000 THEN 7 ELSE 8 END AS INT) AS size_class FROM (SELECT o_orderkey AS order_no, o_totalprice / 4 - 300 AS v FROM orders)""")
def b27_size_class(v) -> DataFrame:
    return v.table("orders").select(F.col("o_orderkey").alias("order_no"), products.size_class(F.col("o_totalprice") / 4 - 300).alias("size_class"))
