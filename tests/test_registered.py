"""Every registered query against its SQL, and its shape where SQL can't say it."""

import pytest
from conftest import SF
from support import database, rows_of, rows_of_sql

from pyrocell.plans import registry
from pyrocell.plans.session import prepared

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, con, name):
    assert rows_of(prepared(QUERIES[name])(spark, SF)) == rows_of_sql(con, SQL[name])


@pytest.mark.parametrize(
    "name, legends",
    {"b23_b25_unpacked": 0, "burned_area_by_territory": 3, "c12_b30_named_units": 3, "c12_d10_zonal_area": 0, "d7_accumulated": 0, "c1_b22_b24_burned_cover": 0, "c4_rule_mask": 1, "c24_by_fire_month": 0, "d11_all_units": 0}.items(),
)
def test_pixel_tables_are_never_broadcast(spark, name, legends):
    """Their files are far below the threshold here; only legends and rules are sent to all."""
    plan = prepared(QUERIES[name])(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == legends and "SortMergeJoin" in plan


def test_unmixing_recovers_its_endmembers(spark):
    from pyrocell.functions import optics

    rows = [(n, *[x / 10000 for x in bands]) for n, bands in optics.ENDMEMBERS.items()]
    df = spark.createDataFrame(rows, "name string, " + ", ".join(f"{b} double" for b in optics.BANDS))
    for r in optics.unmixed(df).collect():
        for n in optics.ENDMEMBERS:
            assert r[n] in ((99, 100, 101) if n == r["name"] else (0, 1)), (r["name"], n, r[n])


def test_trained_models_beat_chance(spark):
    for r in prepared(QUERIES["m2_m5_d17_trained_accuracy"])(spark, SF).collect():
        assert r["accuracy"] > 0.5 and r["n"] > 100


def test_split_takes_seven_tenths_of_the_same_rows(spark):
    n = {r["training"]: r["n"] for r in QUERIES["f4_training_split"](spark, SF).collect()}
    assert n == {r["training"]: r["n"] for r in QUERIES["f4_training_split"](spark, SF).repartition(7).collect()}
    assert 0.67 < n[True] / (n[True] + n[False]) < 0.73


def test_months_are_added_to_and_replays_change_nothing(spark, tmp_path):
    """Three micro-batches of one month, a replay of one of them, and a second query."""
    from pyrocell.streaming import jobs

    schema, path = "pixel_id long, year int, month int", str(tmp_path / "months")
    for k in range(3):
        spark.createDataFrame([(k, 2024, 1), (9, 2024, 1), (k, 2024, 2 + k)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    want = sorted([(0, 2024, 1), (1, 2024, 1), (2, 2024, 1), (9, 2024, 1), (0, 2024, 2), (1, 2024, 3), (2, 2024, 4)])
    q = jobs.upsert_months(stream(), path, str(tmp_path / "c"))
    q.awaitTermination()
    assert sorted(map(tuple, jobs.months(spark, path).collect())) == want and len(q.recentProgress) >= 3
    (tmp_path / "c" / "commits" / "2").unlink()  # as after a crash between a batch's write and its commit
    for f in (tmp_path / "c" / "commits").glob(".2.*"):
        f.unlink()
    jobs.upsert_months(stream(), path, str(tmp_path / "c")).awaitTermination()
    assert sorted(map(tuple, jobs.months(spark, path).collect())) == want
    spark.createDataFrame([(77, 2024, 1)], schema).write.parquet(str(tmp_path / "more"))
    jobs.upsert_months(spark.readStream.schema(schema).parquet(str(tmp_path / "more")), path, str(tmp_path / "d")).awaitTermination()
    assert sorted(map(tuple, jobs.months(spark, path).collect())) == sorted([*want, (77, 2024, 1)])
    jobs.compacted(spark, path, str(tmp_path / "small"))
    assert sorted(map(tuple, jobs.months(spark, str(tmp_path / "small")).collect())) == sorted([*want, (77, 2024, 1)])


def test_polygons_by_the_ray_test(spark):
    """Concave, self-crossing, clockwise and two-of-a-code polygons, points on edges and corners, empty rings."""
    from pyspark.sql import functions as F

    from pyrocell.functions.optics import inside_ring
    from pyrocell.operators import zonal

    rings = [
        (1, [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (5.0, 4.0), (0.0, 10.0)]), (2, [(2.0, 2.0), (300.5, 2.0), (150.0, 30.7)]), (2, [(2.0, 20.0), (2.0, 28.0), (12.0, 28.0), (12.0, 20.0)]),
        (3, [(0.0, 0.0), (20.0, 20.0), (20.0, 0.0), (0.0, 20.0)]), (4, [(5.0, 5.0)]), (5, []), (6, [(-3.5, -2.0), (4.0, -2.5), (3.0, 6.0)]),
    ]
    polygons = spark.createDataFrame([(c, [{"lon": x, "lat": y} for x, y in r]) for c, r in rings], "code int, ring array<struct<lon: double, lat: double>>")
    pixels = spark.range(310 * 36).selectExpr("cast(id % 310 - 4 as int) AS x", "cast(id div 310 - 4 as int) AS y")
    want = pixels.crossJoin(polygons).where(inside_ring(F.col("x").cast("double"), F.col("y").cast("double"), F.col("ring"))).select("x", "y", "code")
    got = zonal.labelled_by_polygon(pixels, polygons, cell=64)
    assert rows_of(got) == rows_of(want) and got.count() > 4000
    assert zonal.labelled_by_polygon(pixels, polygons.limit(0)).count() == 0


def test_features_of_parts_and_holes_by_the_ray_test(spark):
    """Rings within and beside each other, shared edges, and a point inside an even number of rings."""
    from pyrocell.operators import zonal

    square = lambda x0, y0, x1, y1: [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    rings = {
        1: [square(0.0, 0.0, 20.0, 20.0), square(5.0, 5.0, 15.0, 15.0)[::-1], square(8.0, 8.0, 12.0, 12.0), square(30.0, 3.0, 33.5, 9.5)], 2: [square(20.0, 0.0, 30.0, 20.0)],
        3: [square(5.0, 5.0, 15.0, 15.0)], 4: [square(0.0, 20.0, 20.0, 25.0), []], 5: [[]], 6: [],
    }
    df = spark.createDataFrame([(c, [[{"lon": x, "lat": y} for x, y in r] for r in rs]) for c, rs in rings.items()], "code int, rings array<array<struct<lon: double, lat: double>>>")

    def inside(x, y, ring):
        crossed = 0
        for (ax, ay), (bx, by) in zip(ring, [*ring[1:], *ring[:1]], strict=True):
            crossed += (ay > y) != (by > y) and x < ax + (y - ay) * (bx - ax) / (by - ay)
        return crossed

    pixels = [(x, y) for x in range(-2, 40) for y in range(-2, 30)]
    want = sorted((x, y, c) for x, y in pixels for c, rs in rings.items() if sum(inside(x, y, r) for r in rs if r) % 2)
    got = zonal.labelled_by_polygon(spark.createDataFrame(pixels, "x int, y int"), df, cell=8)
    assert sorted((r["x"], r["y"], r["code"]) for r in got.collect()) == want
    on_shared = [c for x, y, c in want if x == 20 and 0 < y < 20]
    assert len(on_shared) == 19 and set(on_shared) == {2}


def test_periods_by_masks(spark):
    """Against counting, with repeated rows, years outside all periods, and a span of 64 years."""
    from pyrocell.operators import series

    burns = [(1, 1960), (1, 1990), (1, 1990), (1, 2023), (2, 1961), (2, 2030), (3, 1900)]
    spans = [(1960, 2023), (1961, 1989), (1990, 1990), (2023, 2023)]
    fire, of = spark.createDataFrame(burns, "pixel_id long, year int"), spark.createDataFrame(spans, "y0 int, y1 int")
    cover = spark.createDataFrame([(p, y, p * 10) for p in (1, 2) for y in (1989, 1990, 2023)], "pixel_id long, year int, class int")
    want = {(p, a, b): len({y for q, y in burns if q == p and a <= y <= b}) for p in (1, 2, 3) for a, b in spans}
    assert {(r["pixel_id"], r["y0"], r["y1"]): r["frequency"] for r in series.frequency(fire, of).collect()} == {k: n for k, n in want.items() if n}
    assert {(r["pixel_id"], r["y0"], r["y1"], r["class"]) for r in series.accumulated(fire, of, cover).collect()} == {(*k, k[0] * 10) for k, n in want.items() if n}
    assert series.frequency(fire.limit(0), of).count() == series.frequency(fire, of.limit(0)).count() == 0
    with pytest.raises(ValueError):
        series.frequency(fire, spark.createDataFrame([(1900, 1999)], "y0 int, y1 int"))


def test_tables_stored_by_pixel_join_without_a_shuffle(spark):
    from pyrocell.plans import zonal_queries
    from pyrocell.plans.views import Views

    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fire, cover, territory = zonal_queries.stored_tables(Views(spark, SF))
        joined = fire.join(cover.select("pixel_id", "year", "class"), ["pixel_id", "year"]).join(territory, "pixel_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString() and joined.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)


def test_boxes_are_in_few_files(spark, tmp_path):
    from pyspark.sql import functions as F

    from pyrocell.sources import stored

    grid = spark.range(256 * 256).selectExpr("cast(id % 256 as int) AS x", "cast(id div 256 as int) AS y")
    stored.store_by_tile(grid, str(tmp_path / "t"), cell=16, files=32)
    read = spark.read.parquet(str(tmp_path / "t"))
    box = read.where(F.col("x").between(64, 95) & F.col("y").between(128, 159))
    assert box.count() == 32 * 32 and read.count() == 256 * 256
    spans = read.groupBy(F.input_file_name().alias("f")).agg(*[g(c).alias(f"{g.__name__}_{c}") for g in (F.min, F.max) for c in "xy"])
    assert spans.where("min_x <= 95 AND max_x >= 64 AND min_y <= 159 AND max_y >= 128").count() <= 4
    for x, y, want in ((0, 0, 0), (1, 0, 1), (0, 1, 2), (3, 5, 0b100111), ((1 << 20) - 1, 0, sum(1 << 2 * b for b in range(20)))):
        assert spark.range(1).select(stored.morton(F.lit(x), F.lit(y)).alias("m")).first()["m"] == want


def test_observations_near_their_own_footprint(spark):
    """Slanted edges longer than a cell, other scenes' edges, scenes without a footprint; by distances in the plane."""
    import math
    import random

    from pyrocell.operators import footprints

    rnd = random.Random(8)
    rings = {"a": [(0.0, 40.0), (2.0, 40.3), (1.7, 41.5), (-0.2, 41.0)], "b": [(0.5, 40.2), (1.0, 41.4), (1.5, 40.2)], "c": []}
    df = spark.createDataFrame([(s, [{"lon": x, "lat": y} for x, y in r]) for s, r in rings.items()], "scene_id string, ring array<struct<lon: double, lat: double>>")
    obs = [(k, rnd.choice("abcd"), rnd.uniform(-0.5, 2.3), rnd.uniform(39.8, 41.7)) for k in range(3000)]

    def near(lon, lat, ring):
        wide, high, best = 111_320 * math.cos(math.radians(lat)), 111_320, math.inf
        for (ax, ay), (bx, by) in zip(ring, [*ring[1:], *ring[:1]], strict=True):
            px, py, dx, dy = (lon - ax) * wide, (lat - ay) * high, (bx - ax) * wide, (by - ay) * high
            t = max(0.0, min(1.0, (px * dx + py * dy) / (dx * dx + dy * dy)))
            best = min(best, math.hypot(px - t * dx, py - t * dy))
        return best

    want = {k for k, s, lon, lat in obs if near(lon, lat, rings.get(s, [])) >= 3000}
    for cell in (0.05, 0.25, 3.0):
        got = footprints.trimmed(spark.createDataFrame(obs, "id int, scene_id string, lon double, lat double"), df, 3000.0, cell)
        assert {r["id"] for r in got.collect()} == want
    assert 50 < len(obs) - len(want) < 1000


def test_unit_codes_come_apart(spark):
    from pyspark.sql import functions as F

    from pyrocell.operators import zonal

    df = spark.createDataFrame([(3, 41, 7, 123456), (6, 9, 99, 1)], "biome_id int, state_id int, tenure_id int, ti_id int")
    for name in ("state", "tenure", "indigenous"):
        unit = zonal.UNITS[name]
        for r in df.select("*", *[c.alias(f"got_{k}") for k, c in zonal.unpacked_code(zonal.packed_code(unit), unit).items()]).collect():
            assert all(r[k] == r[f"got_{k}"] for k in unit)
    assert df.select(zonal.packed_code({"biome_id": 100, "none": 1}).alias("c") if "none" in df.columns else F.lit(None).alias("c")).first()["c"] is None


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["biome", "state", "class_name", "year", "area_ha"]
