"""Area statistics, polygons, overviews and models (C11-C14, D10-D12, D15-D17, B29, B30, B37, M)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrocell.functions import products
from pyrocell.model import by_key
from pyrocell.operators import classify, networks, scars, series, zonal
from pyrocell.plans.mask_queries import SIZES, TABLE
from pyrocell.plans.registry import query
from pyrocell.plans.views import YEARS
from pyrocell.sources import scans, stored
from pyrocell.sources.shared import Rounds, new_path


def burned(v) -> DataFrame:
    """Burns with land cover and territory; the key of both joins is the pixel."""
    cover = scans.carried_forward(v.cover, last=max(YEARS)).select("pixel_id", "year", "class")
    return v.fire.select("pixel_id", "year", "month").join(cover, ["pixel_id", "year"]).join(v.territory.drop("x", "y"), "pixel_id")


BURNED = "fire f JOIN cover_all c USING (pixel_id, year) JOIN territory t USING (pixel_id)"


@query(f"""SELECT b.biome, s.state, l.class_name, a.year, a.area_ha FROM (SELECT t.biome_id, t.state_id, c.class, f.year, sum(t.area_km2) * 100 AS area_ha FROM {BURNED} GROUP BY 1, 2, 3, 4) a
LEFT JOIN biomes b ON b.code = a.biome_id LEFT JOIN states s ON s.code = a.state_id LEFT JOIN legend l ON l.code = a.class""")
def burned_area_by_territory(v) -> DataFrame:
    """The flagship: burned hectares by biome, state, land-cover class and year."""
    area = zonal.zonal_area(burned(v), ["biome_id", "state_id", "class", "year"])
    named = zonal.decoded(zonal.decoded(zonal.decoded(area, v.biomes, "biome_id", ["biome"]), v.states, "state_id", ["state"]), v.legend, "class", ["class_name"])
    return named.select("biome", "state", "class_name", "year", "area_ha")


@query(f"SELECT t.biome_id * 100 + t.state_id AS territory, c.class, f.year, sum(t.area_km2) * 100 AS area_ha FROM {BURNED} GROUP BY 1, 2, 3")
def c12_d10_zonal_area(v) -> DataFrame:
    return zonal.zonal_area(burned(v).withColumn("territory", F.col("biome_id") * 100 + F.col("state_id")), ["territory", "class", "year"])


def stored_tables(v, buckets: int = 8) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Burns, cover and territory stored by pixel."""
    out = []
    for name, df in (("fire", v.fire), ("cover", scans.carried_forward(v.cover, last=max(YEARS))), ("territory", v.territory.drop("x", "y"))):
        path = new_path(v.spark)
        table = f"{name}_{path.rsplit('-', 1)[1]}"
        stored.store_by_pixel(df, table, path, buckets)
        out.append(stored.by_pixel(v.spark, table))
    return tuple(out)


@query(f"SELECT t.biome_id, t.state_id, c.class, f.year, sum(t.area_km2) * 100 AS area_ha FROM {BURNED} GROUP BY 1, 2, 3, 4")
def c1_d10_stored_by_pixel(v) -> DataFrame:
    """Burned area of tables stored by pixel: nothing is shuffled before the sums."""
    fire, cover, territory = stored_tables(v)
    both = fire.select("pixel_id", "year").join(cover.select("pixel_id", "year", "class"), ["pixel_id", "year"]).join(territory, "pixel_id")
    return zonal.zonal_area(both, ["biome_id", "state_id", "class", "year"])


@query("SELECT pixel_id, x, y FROM territory WHERE x BETWEEN 10 AND 30 AND y BETWEEN 5 AND 25")
def a1_box_of_tiles(v) -> DataFrame:
    """A box of pixels stored along the curve."""
    path = new_path(v.spark)
    stored.store_by_tile(v.territory.select("pixel_id", "x", "y"), path, 8)
    return v.spark.read.parquet(path).where(F.col("x").between(10, 30) & F.col("y").between(5, 25)).select("pixel_id", "x", "y")


def products_of(v) -> DataFrame:
    """One row for each pixel and year with a value of some product, its land cover and territory."""
    keys = ["pixel_id", "year"]
    last = max(YEARS) + 1
    burns = v.fire.select(*keys, F.lit(1).alias("annual_burned"), F.col("month").alias("monthly_burned"), "x", "y")
    labelled, table = scars.scars_of(v.fire, 1.0e8)
    sizes = scars.painted(labelled, table).select("x", "y", "year", F.col("size_class").alias("scar_size_range"))
    burns = burns.join(by_key(sizes), ["x", "y", "year"]).drop("x", "y")
    so_far = series.running_frequency(v.fire, YEARS[0], last).where("so_far > 0").select(*keys, F.col("so_far").alias("fire_frequency"), F.lit(1).alias("accumulated_burned"))
    times = series.chronosequence(v.fire, YEARS[0], last).where(f"year <= {last}").select(*keys, F.col("year_last").alias("year_last_fire"), F.col("time_after").alias("time_after_fire"))
    wide = times.join(by_key(so_far), keys, "left").join(by_key(burns), keys, "left").join(scans.carried_forward(v.cover, last=max(YEARS)).select(*keys, "class"), keys, "left")
    land = v.territory.drop("x", "y").withColumn("ti_id", F.nullif("ti_id", F.lit(0)))
    return zonal.product_rows(wide.join(land, "pixel_id"))


PACKED = {
    "biome": "biome_id", "state": "biome_id * 100 + state_id", "tenure": "biome_id * 10000 + state_id * 100 + tenure_id", "indigenous": "biome_id * 1000000 + nullif(ti_id, 0)",
    "protected_state_strict": "biome_id * 1000000 + uc_state_strict", "protected_state_use": "biome_id * 1000000 + uc_state_use", "protected_federal_strict": "biome_id * 1000000 + uc_federal_strict",
    "protected_federal_use": "biome_id * 1000000 + uc_federal_use", "municipality": "biome_id * 10000000 + municipality_id", "municipality_alone": "municipality_id", "indigenous_alone": "nullif(ti_id, 0)",
}
TIMES = "SELECT s.pixel_id, s.year, max(CASE WHEN f.year < s.year THEN f.year END) AS last_burn, max((f.year = s.year)::INT) AS burned, sum((f.year <= s.year)::INT) AS so_far FROM (SELECT p.pixel_id, CAST(y AS INT) AS year FROM (SELECT DISTINCT pixel_id FROM fire) p, range(1995, 2002) r(y)) s JOIN fire f USING (pixel_id) GROUP BY 1, 2"
WIDE = f"""SELECT t.pixel_id, t.year, CASE WHEN f.pixel_id IS NOT NULL THEN 1 END AS annual_burned, f.month AS monthly_burned, nullif(t.so_far, 0) AS fire_frequency, t.last_burn AS year_last_fire,
  z.size_class AS scar_size_range, coalesce(t.year - t.last_burn, CASE WHEN t.burned = 1 THEN 0 END) AS time_after_fire, CASE WHEN t.so_far > 0 THEN 1 END AS accumulated_burned, c.class
FROM ({TIMES}) t LEFT JOIN fire f USING (pixel_id, year) LEFT JOIN z ON z.x = f.x AND z.y = f.y AND z.year = f.year LEFT JOIN cover_all c ON c.pixel_id = t.pixel_id AND c.year = t.year"""
ALL_UNITS = f"""{TABLE}, z AS ({SIZES}), w AS ({WIDE}),
p AS ({' UNION ALL '.join(f"SELECT pixel_id, year, '{n}' AS product, CAST({n} AS INT) AS value FROM w WHERE {n} IS NOT NULL UNION ALL SELECT pixel_id, year, '{n}_coverage', CAST({n} * 100 + class AS INT) FROM w WHERE {n} IS NOT NULL AND class IS NOT NULL" for n in zonal.PRODUCTS)}),
o AS ({' UNION ALL '.join(f"SELECT pixel_id, area_km2, '{n}' AS unit, CAST({e} AS BIGINT) AS territory FROM territory WHERE ({e}) IS NOT NULL" for n, e in PACKED.items())}),
a AS (SELECT product, value, year, unit, territory, sum(area_km2) * 100 AS area_ha FROM p JOIN o USING (pixel_id) GROUP BY 1, 2, 3, 4, 5)"""


@query(f"{ALL_UNITS} SELECT * FROM a")
def d11_all_units(v) -> DataFrame:
    """All fourteen products by all territory units."""
    return zonal.all_units(products_of(v), ["product", "value", "year"])


@query(f"""WITH o AS ({' UNION ALL '.join(f"SELECT pixel_id, area_km2, '{n}' AS unit, CAST({e} AS BIGINT) AS territory FROM territory WHERE ({e}) IS NOT NULL" for n, e in PACKED.items())}),
a AS (SELECT f.month, c.class, f.year, unit, territory, sum(area_km2) * 100 AS area_ha FROM fire f JOIN cover_all c USING (pixel_id, year) JOIN o USING (pixel_id) GROUP BY 1, 2, 3, 4, 5),
d AS (SELECT *, CAST(CASE unit WHEN 'biome' THEN territory WHEN 'state' THEN territory // 100 WHEN 'tenure' THEN territory // 10000 WHEN 'municipality' THEN territory // 10000000 WHEN 'municipality_alone' THEN NULL WHEN 'indigenous_alone' THEN NULL ELSE territory // 1000000 END AS INT) AS biome_id,
  CAST(CASE unit WHEN 'state' THEN territory % 100 WHEN 'tenure' THEN territory // 100 % 100 END AS INT) AS state_id FROM a)
SELECT year, unit, territory, biome_id, biome AS biome_id_name, state_id, state AS state_id_name, CAST(month AS INT) AS month, class, class_name, area_ha FROM d LEFT JOIN biomes b ON b.code = biome_id LEFT JOIN states s ON s.code = state_id LEFT JOIN legend l ON l.code = class""")
def c12_b30_named_units(v) -> DataFrame:
    """Monthly burns crossed with land cover by all units; the packed codes of both taken apart and named."""
    land = v.territory.drop("x", "y").withColumn("ti_id", F.nullif("ti_id", F.lit(0)))
    rows = burned(v).select("pixel_id", "year", "class", F.col("month").alias("monthly_burned")).join(land, "pixel_id")
    crossed = zonal.product_rows(rows, ["monthly_burned"]).where("product = 'monthly_burned_coverage'")
    area = zonal.all_units(crossed, ["value", "year"])
    named = zonal.named_units(area, {"biome_id": v.biomes.withColumnRenamed("biome", "name"), "state_id": v.states.withColumnRenamed("state", "name")})
    month, cls = products.unpacked(F.col("value"))
    out = zonal.decoded(named.withColumns({"month": month, "class": cls}), v.legend, "class", ["class_name"])
    return out.select("year", "unit", "territory", "biome_id", "biome_id_name", "state_id", "state_id_name", "month", "class", "class_name", "area_ha")


@query("SELECT year, month, sum(area_km2) * 100 AS area_ha FROM fire JOIN territory USING (pixel_id) GROUP BY ROLLUP (year, month) HAVING year IS NOT NULL")
def d12_area_by_period(v) -> DataFrame:
    return zonal.area_by_period(v.fire.withColumn("value", F.lit(1.0)).join(v.territory.select("pixel_id", "area_km2"), "pixel_id"))


def modes(levels: list[int]) -> str:
    cells = " UNION ALL ".join(f"SELECT year, x // {1 << n} AS x, y // {1 << n} AS y, CAST({n} AS INT) AS level, class, count(*) AS n FROM cover GROUP BY ALL" for n in levels)
    return f"SELECT year, level, x, y, min(class) AS value FROM (SELECT *, max(n) OVER (PARTITION BY year, level, x, y) AS most FROM ({cells})) WHERE n = most GROUP BY 1, 2, 3, 4"


@query(f"SELECT year, x, y, value FROM ({modes([2])})")
def d15_overview_mode(v) -> DataFrame:
    return zonal.overview(v.cover.withColumnRenamed("class", "value"), 2, how="mode", keys=["year"])


@query(modes([1, 2, 3, 4]))
def d15_pyramid(v) -> DataFrame:
    return zonal.pyramid(v.cover.withColumnRenamed("class", "value"), [1, 2, 3, 4], keys=["year"])


@query(" UNION ALL ".join(f"SELECT year, CAST({n} AS INT) AS level, x // {1 << n} AS x, y // {1 << n} AS y, median(class)::DOUBLE AS median_value, avg(class::DOUBLE) AS mean_value, arg_max(class, n * 1000 - class) AS mode_value FROM (SELECT *, count(*) OVER (PARTITION BY year, x // {1 << n}, y // {1 << n}, class) AS n FROM cover) GROUP BY ALL" for n in (1, 2, 3, 4)))
def d15_pyramid_all(v) -> DataFrame:
    """Mode, mean and median of four levels from one read."""
    return zonal.pyramid(v.cover.withColumnRenamed("class", "value"), [1, 2, 3, 4], how=["mode", "mean", "median"], keys=["year"])


@query("SELECT year, x // 4 AS x, y // 4 AS y, median(class)::DOUBLE AS median_value, avg(class::DOUBLE) AS mean_value FROM cover GROUP BY 1, 2, 3")
def d15_overview_median_mean(v) -> DataFrame:
    return zonal.overview(v.cover.withColumnRenamed("class", "value"), 2, how=["median", "mean"], keys=["year"])


def triangles(v) -> DataFrame:
    """A triangle at every 40th row of the grid, from a territory's pixels."""
    base = v.territory.where("y % 40 = 0 AND x = 0").select(F.col("pixel_id").alias("code"), "y")
    point = lambda x, dy: F.struct(F.lit(x).alias("lon"), (F.col("y") + F.lit(dy)).alias("lat"))
    return base.select("code", F.array(point(2.25, 1.5), point(40.75, 6.5), point(10.5, 30.25)).alias("ring"))


@query("""SELECT p.pixel_id, b.pixel_id AS code FROM territory p JOIN territory b ON b.y % 40 = 0 AND b.x = 0 AND p.y BETWEEN b.y + 1 AND b.y + 31
WHERE ((p.x - 2.25::DOUBLE) * 5.0 - (p.y - b.y - 1.5::DOUBLE) * 38.5 <= 0) AND ((p.x - 40.75::DOUBLE) * 23.75 - (p.y - b.y - 6.5::DOUBLE) * (-30.25) <= 0) AND ((p.x - 10.5::DOUBLE) * (-28.75) - (p.y - b.y - 30.25::DOUBLE) * (-8.25) <= 0)""")
def c11_polygon_labels(v) -> DataFrame:
    return zonal.labelled_by_polygon(v.territory.select("pixel_id", "x", "y"), triangles(v)).select("pixel_id", "code")


def features(v) -> DataFrame:
    """The triangles with a rectangular hole each, and a square beside it as a second part."""
    point = lambda x, dy: F.struct(F.lit(x).alias("lon"), (F.element_at("ring", 1)["lat"] + F.lit(dy)).alias("lat"))
    box = lambda x0, y0, x1, y1: F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1))
    return triangles(v).select("code", F.array("ring", box(12.5, 7.0, 20.5, 13.0), box(44.5, 19.0, 48.5, 23.0)).alias("rings"))


@query("""SELECT p.pixel_id, b.pixel_id AS code FROM territory p JOIN territory b ON b.y % 40 = 0 AND b.x = 0 AND p.y BETWEEN b.y + 1 AND b.y + 31
WHERE (((p.x - 2.25::DOUBLE) * 5.0 - (p.y - b.y - 1.5::DOUBLE) * 38.5 <= 0) AND ((p.x - 40.75::DOUBLE) * 23.75 - (p.y - b.y - 6.5::DOUBLE) * (-30.25) <= 0) AND ((p.x - 10.5::DOUBLE) * (-28.75) - (p.y - b.y - 30.25::DOUBLE) * (-8.25) <= 0)
  AND NOT (p.x BETWEEN 13 AND 20 AND p.y - b.y BETWEEN 9 AND 14)) OR (p.x BETWEEN 45 AND 48 AND p.y - b.y BETWEEN 21 AND 24)""")
def c11_polygons_with_holes(v) -> DataFrame:
    return zonal.labelled_by_polygon(v.territory.select("pixel_id", "x", "y"), features(v)).select("pixel_id", "code")


@query("SELECT coalesce(a.pixel_id, b.pixel_id) AS pixel_id, coalesce(a.uc_id, b.ti_id) AS code FROM (SELECT pixel_id, uc_id FROM territory WHERE uc_id > 0) a FULL JOIN (SELECT pixel_id, ti_id FROM territory WHERE ti_id > 0) b ON a.pixel_id = b.pixel_id")
def c13_overlaid(v) -> DataFrame:
    return zonal.overlaid(v.territory.where("uc_id > 0").select("pixel_id", F.col("uc_id").alias("code")), v.territory.where("ti_id > 0").select("pixel_id", F.col("ti_id").alias("code")))


@query("SELECT concat('s', s.state_id) AS scene, p.pixel_id FROM territory p JOIN (SELECT state_id, min(x) AS x0, min(y) AS y0, min(x) + 6 AS x1, min(y) + 6 AS y1 FROM territory GROUP BY 1) s ON p.x BETWEEN s.x0 - 1 AND s.x1 + 1 AND p.y BETWEEN s.y0 - 1 AND s.y1 + 1")
def c14_clipped(v) -> DataFrame:
    scenes = v.territory.groupBy("state_id").agg(F.min("x").alias("x0"), F.min("y").alias("y0")).select(F.concat(F.lit("s"), F.col("state_id").cast("string")).alias("scene"), "x0", "y0", (F.col("x0") + 6).alias("x1"), (F.col("y0") + 6).alias("y1"))
    return zonal.clipped_to_scenes(v.territory.select("pixel_id", "x", "y"), scenes, 1.0).select("scene", "pixel_id")


@query("SELECT pixel_id, CAST(CASE WHEN tenure_id <= 5 THEN 1 ELSE 2 END AS INT) AS tenure_id FROM territory WHERE tenure_id <= 12")
def b29_remapped(v) -> DataFrame:
    pairs = v.spark.createDataFrame([(k, 1 if k <= 5 else 2) for k in range(1, 13)], "from int, to int")
    return zonal.remapped(v.territory.select("pixel_id", "tenure_id"), pairs, "tenure_id")


@query("SELECT t.pixel_id, t.year, l.class_name, l.origin FROM cover t LEFT JOIN legend l ON l.code = t.class")
def b30_decoded(v) -> DataFrame:
    return zonal.decoded(v.cover, v.legend, "class", ["class_name", "origin"]).select("pixel_id", "year", "class_name", "origin")


@query("SELECT c_custkey AS id, concat(upper(c_mktsegment[1]), lower(c_mktsegment[2:])) AS label, try_cast(replace(c_name, 'Customer#', '') AS INT) AS number FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def b37_prepared_layer(v) -> DataFrame:
    layer = v.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("name"), F.replace("c_name", F.lit("Customer#"), F.lit("")).alias("id_text"))
    return zonal.prepared_layer(layer, ["BUILDING", "MACHINERY"]).select("id", "label", "number")


def samples(v) -> DataFrame:
    return v.obs.select("order_no", "line_no", "pixel_id", *[(F.col(f"{b}_dn") / 10000.0).alias(b) for b in classify.INPUTS], "label")


@query("SELECT round(avg(nir_dn / 10000.0::DOUBLE), 9) AS mean_nir, round(stddev_pop(nir_dn / 10000.0::DOUBLE), 9) AS std_nir, round(avg(swir2_dn / 10000.0::DOUBLE), 9) AS mean_swir2, round(stddev_pop(swir2_dn / 10000.0::DOUBLE), 9) AS std_swir2 FROM obs")
def d16_band_statistics(v) -> DataFrame:
    s = samples(v)
    return s.agg(*[F.round(f(b), 9).alias(f"{n}_{b}") for b in ("nir", "swir2") for n, f in (("mean", F.avg), ("std", F.stddev_pop))])


@query("SELECT o.order_no, o.line_no, round((nir_dn / 10000.0::DOUBLE - m) / s, 6) AS nir FROM obs o, (SELECT avg(nir_dn / 10000.0::DOUBLE) AS m, stddev_pop(nir_dn / 10000.0::DOUBLE) AS s FROM obs)")
def m1_standardised(v) -> DataFrame:
    s = samples(v)
    return classify.standardised(s, *classify.band_statistics(s)).select("order_no", "line_no", F.round("nir", 6).alias("nir"))


#: A small network whose result SQL can say: class 1 where nir > swir2 and red > 1.1 after standardising by (1, 1).
WEIGHTS = json.dumps({"data_mean": [1.0, 1.0, 1.0, 1.0], "data_std": [1.0, 1.0, 1.0, 1.0], "layers": [{"w": [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0], [0.0, -1.0]], "b": [-0.1, 0.0]}, {"w": [[0.0, 1.0], [0.0, 1.0]], "b": [0.25, 0.0]}]})


@query("SELECT order_no, line_no, CAST(CASE WHEN greatest(red_dn / 10000.0::DOUBLE - 1.0 - 0.1::DOUBLE, 0) + greatest((nir_dn / 10000.0::DOUBLE - 1.0) - (swir2_dn / 10000.0::DOUBLE - 1.0), 0) > 0.25 THEN 1 ELSE 0 END AS INT) AS prediction FROM obs WHERE (red_dn + nir_dn + swir2_dn) % 7 <> 0")
def m3_inference(v) -> DataFrame:
    s = samples(v).withColumn("k", F.round((F.col("red") + F.col("nir") + F.col("swir2")) * 10000).cast("int") % 7).withColumn("red", F.when(F.col("k") != 0, F.col("red")))
    return classify.infer(s, classify.weights_from_json(WEIGHTS)).where("prediction IS NOT NULL").select("order_no", "line_no", "prediction")


HASHED = "md5(concat_ws('-', {}, order_no, line_no, pixel_id))"


@query(f"SELECT {HASHED.format(0)} < 'b3333333' AS training, count(*) AS n FROM obs GROUP BY 1")
def f4_training_split(v) -> DataFrame:
    """How many observations are for training and for validation."""
    s = v.obs.select("order_no", "line_no", "pixel_id").withColumn("training", classify.in_training("order_no", "line_no", "pixel_id"))
    return s.groupBy("training").agg(F.count("*").alias("n"))


@query()
def m2_m5_d17_trained_accuracy(v) -> DataFrame:
    """A perceptron for each half of the grid, tested on the rows that it didn't learn from."""
    s = samples(v).withColumn("region", F.when(F.col("pixel_id") % 50 < 25, "west").otherwise("east"))
    s = s.select("region", classify.in_training("order_no", "line_no", "pixel_id").alias("training"), *classify.INPUTS, "label")
    s = Rounds(v.spark).put(s)  # read by every pass of both regions
    s = classify.standardised(s, *classify.band_statistics(s))
    models = classify.train_by_region(s.where("training"), ["east", "west"], steps=15)
    parts = [classify.accuracy(classify.predicted(m, s.where(~F.col("training") & (F.col("region") == r)))).withColumn("region", F.lit(r)) for r, m in models.items()]
    return parts[0].unionByName(parts[1])


@query()
def m2_m5_training_report(v) -> DataFrame:
    """ReLU networks of eight regions (a sensor's half of the grid) in one loop: the hold-out after every 20 steps."""
    region = F.concat_ws("-", "sensor", F.when(F.col("pixel_id") % 50 < 25, "west").otherwise("east"))
    s = v.obs.select(region.alias("region"), "order_no", "line_no", "pixel_id", *[(F.col(f"{b}_dn") / 10000.0).alias(b) for b in classify.INPUTS], "label")
    s = s.withColumn("training", classify.in_training("order_no", "line_no", "pixel_id"))
    return networks.train(s, ["order_no", "line_no", "pixel_id"], classify.INPUTS, classify.LAYERS, steps=60, every=20)[1]


@query("""SELECT sensor, avg((prediction = label)::INT::DOUBLE) AS accuracy, count(*) AS n FROM (SELECT sensor, label, CASE WHEN greatest(red_dn / 10000.0::DOUBLE - 1.0 - 0.1::DOUBLE, 0) + greatest((nir_dn / 10000.0::DOUBLE - 1.0) - (swir2_dn / 10000.0::DOUBLE - 1.0), 0) > 0.25 THEN 1 ELSE 0 END AS prediction FROM obs) GROUP BY 1""")
def d17_accuracy(v) -> DataFrame:
    """How often a given network is right, by sensor."""
    s = v.obs.select("sensor", *[(F.col(f"{b}_dn") / 10000.0).alias(b) for b in classify.INPUTS], "label")
    return classify.accuracy(classify.infer(s, classify.weights_from_json(WEIGHTS)), by=["sensor"])


@query(f"SELECT order_no, line_no, pixel_id, red_dn / 10000.0::DOUBLE AS red, nir_dn / 10000.0::DOUBLE AS nir, swir1_dn / 10000.0::DOUBLE AS swir1, swir2_dn / 10000.0::DOUBLE AS swir2, label FROM obs ORDER BY {HASHED.format(3)}, order_no, line_no, pixel_id LIMIT 1000")
def f5_batch_sample(v) -> DataFrame:
    return classify.batch_sample(samples(v), 1000, 3, "order_no", "line_no", "pixel_id")


def squares(name: str, low: int, high: int) -> str:
    return f"range({low}, {high + 1}) {name}1({name}x), range({low}, {high + 1}) {name}2({name}y)"


S = "region, year, scene_id"
FOUND = "SELECT DISTINCT sensor AS region, CAST(year(acq_ts) AS INT) AS year, month(acq_ts) AS scene_id, x, y FROM obs WHERE sensor <> 'LT05' AND greatest(red_dn / 10000.0::DOUBLE - 1.0 - 0.1::DOUBLE, 0) + greatest((nir_dn / 10000.0::DOUBLE - 1.0) - (swir2_dn / 10000.0::DOUBLE - 1.0), 0) > 0.25"
OPEN = f"SELECT DISTINCT {S}, x + gx AS x, y + gy AS y FROM (SELECT {S}, x + ax AS x, y + ay AS y FROM ({FOUND}), {squares('a', -1, 0)} GROUP BY ALL HAVING count(*) = 4), range(0, 2) g1(gx), range(0, 2) g2(gy)"
CLOSED = f"SELECT {S}, x, y FROM (SELECT {S}, x + dx AS x, y + dy AS y FROM (SELECT DISTINCT {S}, x + cx AS x, y + cy AS y FROM ({OPEN}), {squares('c', 0, 3)}), {squares('d', -3, 0)}) GROUP BY ALL HAVING count(*) = 16"


@query(f"SELECT DISTINCT region, year, CAST(x AS INT) AS x, CAST(y AS INT) AS y, CAST(1 AS INT) AS value FROM ({CLOSED})")
def m4_i6_classification_job(v) -> DataFrame:
    """All years of three sensors' regions are pending; a scene is a month."""
    comp = v.obs.select("x", "y", *[(F.col(f"{b}_dn") / 10000.0).alias(b) for b in classify.INPUTS], F.col("sensor").alias("region"), F.year("acq_ts").alias("year"), F.month("acq_ts").alias("scene_id"))
    pending = comp.where("region <> 'LT05'").select("region", "year").distinct()
    return classify.classification_job(comp, classify.weights_from_json(WEIGHTS), pending, 2, 4)
