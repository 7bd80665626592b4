"""Yearly products: covers, codes, frequencies and year series (B22-B28, C1-C3, D6-D9, E)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrocell.functions import products
from pyrocell.operators import series, zonal
from pyrocell.plans.registry import query
from pyrocell.plans.views import LAST_YEAR
from pyrocell.sources import scans

FIRST = 1995


def cover(v) -> DataFrame:
    return scans.carried_forward(v.cover).select("pixel_id", "year", "class")


@query("SELECT f.pixel_id, f.year, f.month * 100 + c.class AS code, c.class AS burned_cover FROM fire f JOIN cover_all c USING (pixel_id, year)")
def c1_b22_b24_burned_cover(v) -> DataFrame:
    both = v.fire.select("pixel_id", "year", "month").join(cover(v), ["pixel_id", "year"])
    return both.select("pixel_id", "year", products.packed(F.col("month"), F.col("class")).alias("code"), F.col("class").alias("burned_cover"))


@query("SELECT f.pixel_id, f.year, f.month AS month, c.class AS class, (f.month * 100 + c.class > 0)::INT AS burned FROM fire f JOIN cover_all c USING (pixel_id, year)")
def b23_b25_unpacked(v) -> DataFrame:
    code = c1_b22_b24_burned_cover(v)
    month, cls = products.unpacked(F.col("code"))
    return code.select("pixel_id", "year", month.alias("month"), cls.alias("class"), (F.col("code") > 0).cast("int").alias("burned"))


@query("SELECT c.pixel_id, c.year, c.class, coalesce(f.month, 0) AS value FROM cover_all c LEFT JOIN fire f USING (pixel_id, year)")
def c2_product_on_cover(v) -> DataFrame:
    return zonal.product_on_cover(cover(v), v.fire.select("pixel_id", "year", F.col("month").alias("value")))


@query("SELECT c.pixel_id, c.year, c.class FROM cover c WHERE EXISTS (SELECT 1 FROM fire f WHERE f.pixel_id = c.pixel_id)")
def c3_cover_of_burned(v) -> DataFrame:
    return v.cover.select("pixel_id", "year", "class").join(v.fire.select("pixel_id"), "pixel_id", "left_semi")


BOUNDS = "(SELECT min(year) AS lo, max(year) AS hi FROM fire) b, range(0, 100) r(k)"
PERIODS = f"""SELECT DISTINCT y0, y1 FROM (SELECT lo AS y0, CAST(lo + k AS INT) AS y1 FROM {BOUNDS} WHERE lo + k <= hi UNION ALL SELECT CAST(hi - k AS INT), hi FROM {BOUNDS} WHERE hi - k >= lo
UNION ALL SELECT * FROM (VALUES (1990, 1995), (1995, 2000), (2000, 2005), (2005, 2010), (2010, 2015), (2015, 2020), (1995, 2005), (2005, 2015), (2000, 2015)) s(y0, y1))"""


@query(PERIODS)
def d8_b36_periods(v) -> DataFrame:
    """From the first burned year to each, from each to the last, and the special ones."""
    first, last = v.fire.agg(F.min("year"), F.max("year")).first()
    return series.periods(v.spark, first, last, series.SPECIAL_PERIODS)


@query(f"SELECT p.y0, p.y1, count(*) AS pixels FROM fire f JOIN (SELECT * FROM ({PERIODS}) ORDER BY y0, y1 LIMIT 10) p ON f.year BETWEEN p.y0 AND p.y1 GROUP BY 1, 2")
def f6_f7_first_periods(v) -> DataFrame:
    """Burns of the first ten periods in order."""
    few = d8_b36_periods(v).orderBy("y0", "y1").limit(10)
    return v.fire.join(scans.dimension(few), F.col("year").between(F.col("y0"), F.col("y1"))).groupBy("y0", "y1").agg(F.count("*").alias("pixels"))


@query(f"SELECT f.pixel_id, p.y0, p.y1, count(*) AS frequency FROM fire f JOIN ({PERIODS}) p ON f.year BETWEEN p.y0 AND p.y1 GROUP BY 1, 2, 3")
def d6_frequency(v) -> DataFrame:
    return series.frequency(v.fire, d8_b36_periods(v))


@query(f"SELECT DISTINCT f.pixel_id, p.y1, p.y0, c.class FROM fire f JOIN ({PERIODS}) p ON f.year BETWEEN p.y0 AND p.y1 JOIN cover_all c ON c.pixel_id = f.pixel_id AND c.year = p.y1")
def d7_accumulated(v) -> DataFrame:
    return series.accumulated(v.fire, d8_b36_periods(v), cover(v))


SPINE = """WITH s AS (SELECT p.pixel_id, CAST(y AS INT) AS year FROM (SELECT DISTINCT pixel_id FROM fire) p, range(1995, 2003) r(y)),
e AS (SELECT s.pixel_id, s.year, max(CASE WHEN f.year < s.year THEN f.year END) AS before, min(CASE WHEN f.year > s.year THEN f.year END) AS after,
  max((f.year = s.year OR (s.year = 2002 AND f.year = 2001))::INT) AS burned, count(*) AS burns FROM s JOIN fire f USING (pixel_id) GROUP BY 1, 2),
t AS (SELECT pixel_id, year, burned, CAST(burns AS INT) AS burns, coalesce(year - before, CASE WHEN burned = 1 THEN 0 END) AS time_after, CASE WHEN year <= 2001 THEN coalesce(after - year, CASE WHEN burned = 1 THEN 0 END) END AS time_before FROM e)"""


@query(f"""{SPINE} SELECT pixel_id, year, time_after, time_before, burns, CASE WHEN burned = 1 AND year <= 2001 THEN time_after END AS interval,
  CASE WHEN time_after > 0 THEN year - time_after END AS year_last, CASE WHEN time_before > 0 THEN year + time_before END AS year_next FROM t""")
def e1_e5_chronosequence(v) -> DataFrame:
    return series.chronosequence(v.fire, FIRST, LAST_YEAR).select("pixel_id", "year", "time_after", "time_before", "burns", "interval", "year_last", "year_next")


@query("""SELECT pixel_id, year, sum(b) OVER (PARTITION BY pixel_id ORDER BY year)::BIGINT AS so_far, sum(b) OVER (PARTITION BY pixel_id ORDER BY year ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS to_come
FROM (SELECT p.pixel_id, CAST(r.yr AS INT) AS year, (f.pixel_id IS NOT NULL)::INT AS b FROM (SELECT DISTINCT pixel_id FROM fire) p CROSS JOIN range(1995, 2002) r(yr) LEFT JOIN fire f ON f.pixel_id = p.pixel_id AND f.year = r.yr)""")
def e6_running_frequency(v) -> DataFrame:
    return series.running_frequency(v.fire, FIRST, LAST_YEAR)


@query("SELECT pixel_id, year, coalesce(year - lag(year) OVER (PARTITION BY pixel_id ORDER BY year), 0) AS interval FROM fire")
def e3_intervals(v) -> DataFrame:
    return series.intervals(v.fire)


@query("SELECT pixel_id, year, count(*) OVER (PARTITION BY pixel_id) AS burns FROM fire")
def e8_burn_counts(v) -> DataFrame:
    return series.burn_counts(v.fire).select("pixel_id", "year", "burns")


@query("SELECT pixel_id, avg(nullif(i, 0)::DOUBLE) AS mean_interval FROM (SELECT pixel_id, year - lag(year) OVER (PARTITION BY pixel_id ORDER BY year) AS i FROM fire) GROUP BY pixel_id")
def d9_mean_interval(v) -> DataFrame:
    return series.mean_interval(v.fire)


@query(f"""{SPINE} SELECT pixel_id, year, CAST(CASE WHEN burns = 1 THEN 11 WHEN time_after = 0 THEN 10 WHEN i > 20 THEN 9 WHEN i > 15 THEN 8 WHEN i > 10 THEN 7 WHEN i > 7 THEN 6 WHEN i > 5 THEN 5 WHEN i > 4 THEN 4 WHEN i > 3 THEN 3 WHEN i > 2 THEN 2 WHEN i > 0 THEN 1 END AS INT) AS class
FROM (SELECT *, CASE WHEN burned = 1 AND year <= 2001 THEN time_after END AS i FROM t)""")
def b28_interval_class(v) -> DataFrame:
    s = series.chronosequence(v.fire, FIRST, LAST_YEAR)
    return s.select("pixel_id", "year", products.interval_class(F.col("interval"), F.col("time_after"), F.col("burns")).alias("class"))


@query("SELECT pixel_id, year, month FROM fire WHERE year IN (1996, 1998) AND x < 20")
def b31_b32_b33_filters(v) -> DataFrame:
    region = v.territory.where("x < 20").select("pixel_id")
    return v.fire.where(F.col("year").isin(1996, 1998)).join(region, "pixel_id", "left_semi").select("pixel_id", "year", "month")
