"""Pixel tables derived from the given tables, for Spark and, as the same expressions, for SQL.

The grid has 50 columns: a part is a pixel, a line item an observation, a returned and discounted one a burn, an error
event a hotspot. Expressions are written once; ``//`` is integer division (``div`` in Spark).
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyrocell.model import by_key

YEARS = list(range(1995, 2001))
LAST_YEAR = 2001

OBS = [
    "l_partkey AS pixel_id", "CAST(l_partkey % 50 AS INT) AS x", "CAST(l_partkey // 50 AS INT) AS y", "l_shipdate AS acq_ts",
    "CASE l_suppkey % 4 WHEN 0 THEN 'LT05' WHEN 1 THEN 'LE07' WHEN 2 THEN 'LC08' ELSE 'LC09' END AS sensor",
    "concat(CASE l_suppkey % 4 WHEN 0 THEN 'LT05' WHEN 1 THEN 'LE07' WHEN 2 THEN 'LC08' ELSE 'LC09' END, '_', lpad(concat('', 200 + l_suppkey % 30), 3, '0'), lpad(concat('', 60 + l_linenumber), 3, '0'), '_', concat('', year(l_shipdate)), lpad(concat('', month(l_shipdate)), 2, '0'), lpad(concat('', day(l_shipdate)), 2, '0')) AS scene_id",
    "CAST(l_orderkey AS BIGINT) AS order_no", "CAST(l_linenumber AS INT) AS line_no",
    "CAST(7400 + CAST(l_quantity AS INT) * 100 AS INT) AS blue_dn", "CAST(7500 + CAST(l_quantity AS INT) * 120 AS INT) AS green_dn",
    "CAST(8000 + CAST(round(l_tax * 100) AS INT) * 1000 AS INT) AS red_dn", "CAST(8000 + CAST(l_quantity AS INT) * 200 AS INT) AS nir_dn",
    "CAST(9000 + CAST(round(l_discount * 100) AS INT) * 500 AS INT) AS swir1_dn", "CAST(8000 + CAST(round(l_discount * 100) AS INT) * 1000 AS INT) AS swir2_dn",
    "CAST(40000 + CAST(l_quantity AS INT) * 50 AS INT) AS st_dn",
    "CAST(CASE l_linenumber WHEN 4 THEN 128 WHEN 5 THEN 520 WHEN 6 THEN 16 WHEN 7 THEN 8 ELSE 64 END AS INT) AS qa_pixel",
    "CAST(CASE WHEN l_suppkey % 11 = 0 THEN 4 WHEN l_suppkey % 13 = 0 THEN 128 ELSE 0 END AS INT) AS qa_radsat",
    "CAST(l_returnflag = 'R' AS INT) AS label", "CAST(l_orderkey % 100 AS INT) AS cloud_probability", "CAST(l_orderkey % 12 AS INT) AS scl",
    "CAST(l_orderkey % 2 AS INT) AS qa60", "CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_quantity AS INT) END AS b8a", "CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(l_quantity AS INT) END AS b9",
]
FIRE = ["l_partkey AS pixel_id", "CAST(l_partkey % 50 AS INT) AS x", "CAST(l_partkey // 50 AS INT) AS y", "CAST(year(l_shipdate) AS INT) AS year", "CAST(min(month(l_shipdate)) AS INT) AS month"]
FIRE_WHERE = "l_returnflag = 'R' AND l_discount >= 0.075"
CLASS = "CAST(CASE (p_size + year - 1995) % 10 WHEN 0 THEN 3 WHEN 1 THEN 4 WHEN 2 THEN 12 WHEN 3 THEN 15 WHEN 4 THEN 21 WHEN 5 THEN 24 WHEN 6 THEN 33 WHEN 7 THEN 39 WHEN 8 THEN 30 ELSE 11 END AS INT) AS class"
TERRITORY = [
    "p_partkey AS pixel_id", "CAST(p_partkey % 50 AS INT) AS x", "CAST(p_partkey // 50 AS INT) AS y", "CAST(p_partkey % 25 % 5 + 1 AS INT) AS biome_id", "CAST(p_partkey % 25 + 1 AS INT) AS state_id",
    "CAST(p_size % 21 + 1 AS INT) AS tenure_id", "CAST(p_partkey % 97 AS INT) AS municipality_id", "CAST(CASE WHEN p_size % 7 = 0 THEN p_partkey % 6 + 1 ELSE 0 END AS INT) AS ti_id",
    "CAST(CASE WHEN p_size % 5 = 0 THEN p_partkey % 9 + 1 ELSE 0 END AS INT) AS uc_id", "CAST(0.25 AS DOUBLE) * (p_partkey % 8 + 1) AS area_km2",
    *[f"CAST(CASE WHEN p_size % 11 = {k} THEN p_partkey % {7 + k} + 1 END AS INT) AS {c}" for k, c in enumerate(["uc_state_strict", "uc_state_use", "uc_federal_strict", "uc_federal_use"])],
]
HOTSPOTS = ["event_id", "ts", "user_id AS pixel_id", "CAST(user_id % 50 AS INT) AS x", "CAST(user_id // 50 AS INT) AS y", "value"]

SQL = {
    "obs": "SELECT " + ", ".join(OBS) + " FROM lineitem",
    "fire": "SELECT " + ", ".join(FIRE) + f" FROM lineitem WHERE {FIRE_WHERE} GROUP BY l_partkey, year(l_shipdate)",
    "cover": f"SELECT p_partkey AS pixel_id, CAST(p_partkey % 50 AS INT) AS x, CAST(p_partkey // 50 AS INT) AS y, year, {CLASS} FROM part, (VALUES {', '.join(f'(CAST({y} AS INT))' for y in YEARS)}) AS ys(year)",
    "cover_all": "SELECT * FROM cover UNION ALL SELECT pixel_id, x, y, CAST(2001 AS INT), class FROM cover WHERE year = 2000",
    "territory": "SELECT " + ", ".join(TERRITORY) + " FROM part",
    "hotspots": "SELECT " + ", ".join(HOTSPOTS) + " FROM events WHERE event_type = 'error'",
    "biomes": "SELECT CAST(r_regionkey + 1 AS INT) AS code, r_name AS biome FROM region",
    "states": "SELECT CAST(n_nationkey + 1 AS INT) AS code, n_name AS state FROM nation",
    "legend": "SELECT * FROM (VALUES (3, 'Forest Formation', 'Natural'), (4, 'Savanna Formation', 'Natural'), (11, 'Wetland', 'Natural'), (12, 'Grassland', 'Natural'), (15, 'Pasture', 'Converted'), (21, 'Mosaic of Uses', 'Converted'), (24, 'Urban Area', 'Converted'), (30, 'Mining', 'Converted'), (33, 'Water', 'Natural')) AS l(code, class_name, origin)",
    "rules": "SELECT CAST(biome AS INT) AS biome, CAST(region AS INT) AS region, CAST(year AS INT) AS year, CAST(class AS INT) AS class FROM (VALUES (1, NULL, NULL, 33), (1, NULL, NULL, 24), (2, 7, NULL, 21), (3, NULL, 1998, 3), (4, NULL, NULL, 30), (5, 10, 1999, 15)) AS r(biome, region, year, class)",
    "nbr": "SELECT *, CAST(trunc((1.0::DOUBLE - (nir_dn - swir2_dn)::DOUBLE / (nir_dn + swir2_dn)) * 1000.0::DOUBLE) AS INT) AS nbr FROM obs",
    "inv": "SELECT *, CAST(trunc(-((nir_dn - swir2_dn)::DOUBLE / (nir_dn + swir2_dn) + 1.0::DOUBLE) * 1000.0::DOUBLE) AS INT) AS nbr FROM obs",
}


def with_views(sql: str) -> str:
    """The SQL with the definitions, before it, of the views that it names."""
    used: list[str] = []

    def need(text: str) -> None:
        for name in SQL:
            if name not in used and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                need(SQL[name])
                used.append(name)

    need(sql)
    parts = [f"{n} AS ({SQL[n]})" for n in used]
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        recursive = body[5:15].upper().startswith("RECURSIVE")
        body = body[5 + 10 * recursive :]
        return f"WITH {'RECURSIVE ' * recursive}{', '.join([*parts, ''])}{body}"
    return (f"WITH {', '.join(parts)} " if parts else "") + body


class Views:
    """The same as DataFrames; only the columns a query uses are read. Pixel tables are joined by key (``by_key``)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @staticmethod
    def _of(expressions: list[str]) -> list[str]:
        return [e.replace(" // ", " div ") for e in expressions]

    @cached_property
    def obs(self) -> DataFrame:
        return by_key(self.table("lineitem").selectExpr(*self._of(OBS)))

    @cached_property
    def fire(self) -> DataFrame:
        keys = self.table("lineitem").where(FIRE_WHERE).groupBy("l_partkey", F.year("l_shipdate").alias("year")).agg(F.min(F.month("l_shipdate")).cast("int").alias("month"))
        return by_key(keys.selectExpr(*self._of(FIRE[:3]), "year", "month"))

    @cached_property
    def cover(self) -> DataFrame:
        years = self.table("part").withColumn("year", F.explode(F.lit(YEARS)))
        return by_key(years.selectExpr("p_partkey AS pixel_id", "CAST(p_partkey % 50 AS INT) AS x", "CAST(p_partkey div 50 AS INT) AS y", "year", CLASS))

    @cached_property
    def territory(self) -> DataFrame:
        return by_key(self.table("part").selectExpr(*self._of(TERRITORY)))

    @cached_property
    def hotspots(self) -> DataFrame:
        return by_key(self.table("events").where("event_type = 'error'").selectExpr(*self._of(HOTSPOTS)))

    @cached_property
    def biomes(self) -> DataFrame:
        return self.table("region").selectExpr("CAST(r_regionkey + 1 AS INT) AS code", "r_name AS biome")

    @cached_property
    def states(self) -> DataFrame:
        return self.table("nation").selectExpr("CAST(n_nationkey + 1 AS INT) AS code", "n_name AS state")

    @cached_property
    def legend(self) -> DataFrame:
        return self.spark.sql(SQL["legend"])

    @cached_property
    def rules(self) -> DataFrame:
        return self.spark.sql(SQL["rules"])
