"""Masks, morphology, components and scars (C4-C7, C15-C17, C24, D21, I1-I8, E7, D14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrocell.functions import optics
from pyrocell.operators import masks, scars, spatial
from pyrocell.plans.registry import query
from pyrocell.plans.views import LAST_YEAR, YEARS


def located(v) -> DataFrame:
    return v.fire.join(v.territory.select("pixel_id", F.col("biome_id").alias("biome"), F.col("state_id").alias("region")), "pixel_id")


@query("""SELECT f.pixel_id, f.year, f.month FROM fire f JOIN territory t USING (pixel_id) WHERE NOT EXISTS (SELECT 1 FROM cover c JOIN rules r ON r.class = c.class
  WHERE c.pixel_id = f.pixel_id AND c.year = least(f.year, 2000) AND r.biome = t.biome_id AND (r.region IS NULL OR r.region = t.state_id) AND (r.year IS NULL OR r.year = f.year))""")
def c4_rule_mask(v) -> DataFrame:
    return masks.excluded_by_rules(located(v), v.cover, v.rules).select("pixel_id", "year", "month")


@query("SELECT pixel_id, year, month FROM fire WHERE pixel_id NOT IN (SELECT pixel_id FROM cover WHERE class = 33 GROUP BY pixel_id HAVING count(*) >= 1)")
def c5_water_mask(v) -> DataFrame:
    return masks.without_water(v.fire, v.cover.where("class = 33").select("pixel_id").distinct()).select("pixel_id", "year", "month")


@query("""SELECT f.pixel_id, f.year FROM fire f WHERE NOT EXISTS (SELECT 1 FROM cover c WHERE c.class = 24 AND c.year = f.year AND c.x BETWEEN f.x - 1 AND f.x + 1 AND c.y BETWEEN f.y - 1 AND f.y + 1) OR f.x >= 25""")
def c6_buffer_mask(v) -> DataFrame:
    lakes = v.territory.where("x < 25").select("x", "y")
    return masks.without_buffered(v.fire, masks.buffered_class(v.cover, [24], 1, lakes)).select("pixel_id", "year")


MASKED = "SELECT pixel_id, year FROM cover_all WHERE class IN (24, 33)"


@query(f"SELECT 'drop' AS exempt, count(*) AS n FROM fire f WHERE x >= 10 AND NOT EXISTS (SELECT 1 FROM ({MASKED}) m WHERE m.pixel_id = f.pixel_id AND m.year = f.year) UNION ALL SELECT 'keep', count(*) FROM fire f WHERE x < 10 OR NOT EXISTS (SELECT 1 FROM ({MASKED}) m WHERE m.pixel_id = f.pixel_id AND m.year = f.year)")
def c7_exemption(v) -> DataFrame:
    from pyrocell.sources.scans import carried_forward

    mask = carried_forward(v.cover).where(F.col("class").isin(24, 33)).select("pixel_id", "year")
    area = v.territory.where("x < 10").select("pixel_id")
    n = lambda how: masks.exempted(v.fire, mask, area, how).agg(F.lit(how).alias("exempt"), F.count("*").alias("n"))
    return n("drop").union(n("keep"))


@query("""SELECT f.pixel_id, f.year, f.month FROM fire f WHERE EXISTS (SELECT 1 FROM hotspots h WHERE month(h.ts) = f.month AND h.x BETWEEN f.x - 2 AND f.x + 2 AND h.y BETWEEN f.y - 2 AND f.y + 2)""")
def c15_near_hotspots(v) -> DataFrame:
    """The hotspots are of one year; each stands for its month in all years of the burns."""
    month = lambda year: F.make_timestamp(year, F.col("month"), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    spots = v.hotspots.select("x", "y", F.month("ts").alias("month"), F.explode(F.lit([*YEARS, LAST_YEAR])).alias("year")).select("x", "y", month(F.col("year")).alias("ts"))
    return masks.near_hotspots(v.fire.withColumn("acq_ts", month(F.col("year"))), spots, 2).select("pixel_id", "year", "month")


MONTHS = "SELECT DISTINCT l_partkey AS pixel_id, CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month FROM lineitem WHERE l_returnflag = 'R'"


@query(f"""WITH d AS ({MONTHS}) SELECT * FROM d WHERE NOT EXISTS (SELECT 1 FROM d b WHERE b.pixel_id = d.pixel_id AND (
  (d.month = 1 AND b.year = d.year - 1 AND b.month >= 8) OR (d.month = 2 AND ((b.year = d.year - 1 AND b.month >= 10) OR (b.year = d.year AND b.month = 1))) OR (d.month >= 3 AND b.year = d.year AND b.month < d.month)))""")
def c16_first_detections(v) -> DataFrame:
    d = v.obs.where("label = 1").select("pixel_id", F.year("acq_ts").alias("year"), F.month("acq_ts").alias("month")).distinct()
    return masks.first_detections(d, d)


@query("SELECT f.pixel_id, f.year, f.month FROM fire f JOIN cover_all c USING (pixel_id, year) WHERE c.class NOT IN (24, 30, 33)")
def c17_yearly_mask(v) -> DataFrame:
    return masks.in_yearly_mask(v.fire, masks.monitor_cover_mask(v.cover, [24, 30, 33])).select("pixel_id", "year", "month")


@query("SELECT f.pixel_id, f.year, c.class AS value, f.month FROM fire f JOIN cover c USING (pixel_id, year)")
def c24_by_fire_month(v) -> DataFrame:
    return masks.by_fire_month(v.cover.select("pixel_id", "year", F.col("class").alias("value")), v.fire)


CELLS = "SELECT DISTINCT year, x, y FROM fire"


def cells(v) -> DataFrame:
    return v.fire.select("year", "x", "y")


def squares(name: str, low: int, high: int) -> str:
    return f"range({low}, {high + 1}) {name}1({name}x), range({low}, {high + 1}) {name}2({name}y)"


@query(f"SELECT DISTINCT year, CAST(x + ax AS INT) AS x, CAST(y + ay AS INT) AS y FROM ({CELLS}), {squares('a', -1, 1)}")
def i4_dilated(v) -> DataFrame:
    return spatial.dilated(cells(v), 1, ["year"])


@query(f"SELECT year, x, y FROM (SELECT year, CAST(x + ax AS INT) AS x, CAST(y + ay AS INT) AS y FROM ({CELLS}), {squares('a', -1, 1)}) GROUP BY 1, 2, 3 HAVING count(*) = 9")
def i5_eroded(v) -> DataFrame:
    return spatial.eroded(cells(v), 1, ["year"])


@query(f"SELECT year, x, y FROM (SELECT year, CAST(x + ex AS INT) AS x, CAST(y + ey AS INT) AS y FROM (SELECT DISTINCT year, x + ax AS x, y + ay AS y FROM ({CELLS}), {squares('a', -2, 2)}), {squares('e', -1, 1)}) GROUP BY 1, 2, 3 HAVING count(*) = 9")
def i5_eroded_of_dilated(v) -> DataFrame:
    """Erosion of a set that has something to leave: the burns grown by two."""
    return spatial.eroded(spatial.dilated(cells(v), 2, ["year"]), 1, ["year"])


OPENED = f"SELECT DISTINCT year, x + gx AS x, y + gy AS y FROM (SELECT year, x + ax AS x, y + ay AS y FROM ({CELLS}), {squares('a', -1, 0)} GROUP BY 1, 2, 3 HAVING count(*) = 4), range(0, 2) g1(gx), range(0, 2) g2(gy)"


@query(f"""SELECT year, CAST(x AS INT) AS x, CAST(y AS INT) AS y FROM (SELECT year, x + dx AS x, y + dy AS y FROM (SELECT DISTINCT year, x + cx AS x, y + cy AS y FROM ({OPENED}), {squares('c', 0, 3)}), {squares('d', -3, 0)}) GROUP BY 1, 2, 3 HAVING count(*) = 16""")
def i6_opened_closed(v) -> DataFrame:
    return spatial.filtered(cells(v), 2, 4, ["year"])


COMPONENTS = """WITH RECURSIVE s AS (SELECT year, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, CAST(y AS BIGINT) * 4294967296 + x AS cell FROM fire),
h AS (SELECT a.year, a.cell AS a, b.cell AS b FROM s a JOIN s b ON b.year = a.year AND b.cell = a.cell + 1 AND b.y = a.y UNION ALL SELECT a.year, a.cell, b.cell FROM s a JOIN s b ON b.year = a.year AND b.cell = a.cell + 4294967296),
e AS (SELECT year, a, b FROM h UNION ALL SELECT year, b, a FROM h),
r AS (SELECT year, cell, cell AS other FROM s UNION SELECT r.year, r.cell, e.b FROM r JOIN e ON e.year = r.year AND e.a = r.other),
c AS (SELECT year, cell, min(other) AS component FROM r GROUP BY 1, 2)"""


@query(f"{COMPONENTS} SELECT CAST(s.x AS INT) AS x, CAST(s.y AS INT) AS y, s.year, c.component FROM s JOIN c USING (year, cell)")
def i1_components(v) -> DataFrame:
    return spatial.connected(v.fire.select("x", "y", "year"), ["year"], tile=16)


@query(f"{COMPONENTS} SELECT CAST(s.x AS INT) AS x, CAST(s.y AS INT) AS y, s.year FROM s JOIN c USING (year, cell) JOIN (SELECT year, component, count(*) AS n FROM c GROUP BY 1, 2) k USING (year, component) WHERE k.n > 2")
def d21_without_solitary(v) -> DataFrame:
    return spatial.without_solitary(v.fire.select("x", "y", "year"), 2, ["year"])


TABLE = f"""{COMPONENTS}, t AS (SELECT s.year, c.component AS scar_id, count(*) AS n_pixels, floor(count(*) * 1.0e8::DOUBLE) / 10000.0::DOUBLE AS area_ha, CAST(min(s.x) AS INT) AS x0, CAST(min(s.y) AS INT) AS y0, CAST(max(s.x) AS INT) AS x1, CAST(max(s.y) AS INT) AS y1 FROM s JOIN c USING (year, cell) GROUP BY 1, 2),
u AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY scar_id) AS unique_id FROM t)"""
SIZES = "SELECT CAST(s.x AS INT) AS x, CAST(s.y AS INT) AS y, s.year, u.unique_id, u.area_ha, CAST(CASE WHEN area_ha < 10 THEN 1 WHEN area_ha < 250 THEN 2 WHEN area_ha < 500 THEN 3 WHEN area_ha < 5000 THEN 4 WHEN area_ha < 10000 THEN 5 WHEN area_ha < 50000 THEN 6 WHEN area_ha < 100000 THEN 7 ELSE 8 END AS INT) AS size_class FROM s JOIN c USING (year, cell) JOIN u ON u.year = s.year AND u.scar_id = c.component"


@query(f"{TABLE} SELECT * FROM u")
def i2_e7_d14_scar_table(v) -> DataFrame:
    """100 square kilometres a pixel, so that scars fall into several size classes."""
    return scars.scars_of(v.fire, 1.0e8)[1]


@query(f"{TABLE} {SIZES}")
def i3_scars_on_pixels(v) -> DataFrame:
    labelled, table = scars.scars_of(v.fire, 1.0e8)
    return scars.painted(labelled, table).select("x", "y", "year", "unique_id", "area_ha", "size_class")


@query("SELECT x, y, CAST(arg_max(label, scene_id) AS INT) AS value FROM obs WHERE label = 1 GROUP BY x, y")
def i7_merged_pieces(v) -> DataFrame:
    return spatial.merged_pieces(v.obs.select("x", "y", "scene_id", F.col("label").alias("value")), ["x", "y"], ["scene_id"])


@query("SELECT pixel_id, round(100.0::DOUBLE / (111320.0::DOUBLE * cos(radians(-y / 100.0::DOUBLE))), 12) AS d_lon, 100.0::DOUBLE / 111320.0::DOUBLE AS d_lat, round(pow(6371007.2::DOUBLE, 2) * radians(0.00027::DOUBLE) * (sin(radians(-y / 100.0::DOUBLE + 0.000135::DOUBLE)) - sin(radians(-y / 100.0::DOUBLE - 0.000135::DOUBLE))), 2) AS area_m2 FROM territory")
def i8_d13_degrees_and_area(v) -> DataFrame:
    lat = -F.col("y") / 100.0
    d_lon, d_lat = optics.metres_to_degrees(F.lit(100.0), lat)
    return v.territory.select("pixel_id", F.round(d_lon, 12).alias("d_lon"), d_lat.alias("d_lat"), F.round(optics.cell_area_m2(lat, 0.00027, 0.00027), 2).alias("area_m2"))
