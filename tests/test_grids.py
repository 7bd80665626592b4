"""Hand-made grids, null rules and series."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pyrocell import model
from pyrocell.functions import products
from pyrocell.operators import masks, series, severity, spatial
from pyrocell.sources import scans


def grid(spark, cells):
    return spark.createDataFrame([(x, y) for x, y in cells], "x int, y int")


def found(df):
    return {(r["x"], r["y"]) for r in df.collect()}


def parts(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["component"], set()).add((r["x"], r["y"]))
    return sorted(map(sorted, out.values()))


def brute_parts(cells):
    left, out = set(cells), []
    while left:
        todo, part = [left.pop()], []
        while todo:
            x, y = todo.pop()
            part.append((x, y))
            for n in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                if n in left:
                    left.remove(n)
                    todo.append(n)
        out.append(sorted(part))
    return sorted(out)


def test_corner_touch_is_two_components(spark):
    cells = [(x, y) for x in (0, 1) for y in (0, 1)] + [(x, y) for x in (2, 3) for y in (2, 3)]
    assert parts(spatial.connected(grid(spark, cells))) == brute_parts(cells)


def test_components_cross_tiles(spark):
    snake = [(x, y) for y in range(0, 20, 2) for x in range(20)] + [(19 if y % 4 == 1 else 0, y) for y in range(1, 19, 2)]
    assert len(parts(spatial.connected(grid(spark, snake), tile=4))) == 1
    rnd = random.Random(5)
    cells = {(rnd.randrange(-10, 20), rnd.randrange(-10, 20)) for _ in range(420)}
    assert parts(spatial.connected(grid(spark, cells), tile=5)) == brute_parts(cells)
    assert spatial.connected(grid(spark, [])).count() == 0
    named = spatial.connected(grid(spark, cells).withColumn("Scene", F.lit("s")), ["Scene"], tile=5)
    assert named.columns == ["x", "y", "Scene", "component"] and parts(named) == brute_parts(cells)


def test_solitary_thresholds(spark):
    cells = [(x, 10 * k) for k, n in enumerate((2, 3, 6, 7)) for x in range(n)]
    sizes = lambda df: sorted({y // 10 for _, y in found(df)})
    assert sizes(spatial.without_solitary(grid(spark, cells))) == [3]
    assert sizes(spatial.without_solitary(grid(spark, cells), 2)) == [1, 2, 3]


def test_dilation_and_opening(spark):
    assert len(found(spatial.dilated(grid(spark, [(0, 0)]), 3))) == 49
    assert found(spatial.opened(grid(spark, [(0, 0)]), 2)) == set()
    block = {(0, 0), (0, 1), (1, 0), (1, 1)}
    assert found(spatial.opened(grid(spark, block), 2)) == block
    assert found(spatial.filtered(grid(spark, block), 1, 0)) == block
    hole = {(x, y) for x in range(5) for y in range(5)} - {(2, 2)}
    assert found(spatial.closed(grid(spark, hole), 2)) == hole | {(2, 2)}


def windows(cells, low, high, every):
    """Cells of which any or every cell from p - high to p - low is in the set."""
    spots = [(dx, dy) for dx in range(low, high + 1) for dy in range(low, high + 1)]
    near = {(x + dx, y + dy) for x, y in cells for dx, dy in spots}
    return {(x, y) for x, y in near if all((x - dx, y - dy) in cells for dx, dy in spots)} if every else near


def test_morphology_by_brute_force_across_tiles_and_grids(spark):
    rnd = random.Random(3)
    grids = {k: {(x + rnd.randrange(2), y) for x in range(-70, 75) for y in range(-66, -60) if rnd.random() < 0.9} | {(63, 0), (64, 0), (-64, -64)} for k in ("a", None)}
    rows = [(x, y, k) for k, cells in grids.items() for x, y in cells] * 2 + [(None, 1, "a")]
    df = spark.createDataFrame(rows, "x int, y int, Scene string")
    steps = spatial.open_by(2) + spatial.close_by(4) + spatial.erode(1) + spatial.dilate(2)
    got = spatial.changed(df, steps, ["Scene"], tile=64).collect()
    assert len(got) == len(set(got))
    for k, cells in grids.items():
        for step in steps:
            cells = windows(cells, step.low, step.high, step.every)
        assert cells and {(r["x"], r["y"]) for r in got if r["Scene"] == k} == cells
    assert spatial.changed(df.limit(0), steps, ["Scene"]).count() == 0


def test_steps_that_reach_further_than_a_tile(spark):
    block = {(x, y) for x in range(3) for y in range(-2, 1)}
    grown = spatial.changed(grid(spark, block), spatial.dilate(150), tile=64)
    assert grown.count() == 303 * 303
    assert found(spatial.changed(grown, spatial.erode(150), tile=64)) == block


def test_runs_stay_runs(spark):
    runs = spark.createDataFrame([(0, -130, 130), (0, 5, 9), (1, -1, 63), (2, 64, 64), (3, 4, 3)], "y int, x0 int, x1 int")
    cells = {(x, y) for y, a, b in [(0, -130, 130), (1, -1, 63), (2, 64, 64)] for x in range(a, b + 1)}
    bits = spatial.words_of_runs(runs)
    assert sorted(bits.collect()) == sorted(spatial.words(grid(spark, cells)).collect())
    out = spatial.morphed(bits, spatial.dilate(1), tile=64)
    assert out.columns == ["y", "x0", "x1"] and out.count() < 30
    assert found(spatial.cells_of(out)) == windows(cells, -1, 1, False)
    plan = spatial.dilated(grid(spark, cells), 20)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "-20" not in plan


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.tuples(st.integers(0, 8), st.integers(0, 8)), max_size=40))
def test_opening_is_idempotent_and_inside(spark, cells):
    once = found(spatial.opened(grid(spark, cells), 2))
    assert once <= cells and found(spatial.opened(grid(spark, once), 2)) == once


def test_severity_classes(spark):
    values = [-1, 0, 269, 270, 439, 440, 659, 660, 1350, 1351, None]
    df = spark.createDataFrame([(v,) for v in values], "v int").select(products.severity_class(F.col("v")).alias("c"))
    assert [r["c"] for r in df.collect()] == [1, 2, 2, 3, 3, 4, 4, 5, 5, 6, None]


@pytest.mark.parametrize("zero", [False, True])
def test_size_classes(spark, zero):
    values = [0.0, 9.99, 10.0, 250.0, 500.0, 5000.0, 10000.0, 50000.0, 100000.0]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(products.size_class(F.col("v"), zero).alias("c"))
    assert [r["c"] for r in df.collect()] == [1 if zero else None, 1, 2, 3, 4, 5, 6, 7, 8]


def test_null_rules(spark):
    df = spark.createDataFrame([(0, None), (3, 0), (None, 1), (5, 2)], "a int, m int")
    a, m = F.col("a"), F.col("m")
    got = df.select(model.self_mask(a), model.update_mask(a, m), model.unmask(a, 9), model.blend(a, m), model.where(a, (m > 0, 7), (m > 1, 8))).collect()
    assert [tuple(r) for r in got] == [(None, None, 0, 0, 0), (3, None, 3, 0, 3), (None, None, 9, 1, 7), (5, 5, 5, 2, 8)]


def test_typed_save_voids_zero_and_overflow(spark):
    df = model.cast_product(spark.createDataFrame([(0,), (7,), (40_000,)], "value int"), "int16")
    assert [r["value"] for r in df.collect()] == [None, 7, None] and df.schema["value"].dataType.simpleString() == "smallint"


def recursion(burned, first, last):
    """Time after fire, year by year."""
    out, before = {}, None
    for y in range(first, last + 2):
        now = y in burned or (y == last + 1 and last in burned)
        value = None if before is None else y - before
        out[y] = value if value is not None else (0 if now else None)
        if y in burned:
            before = y
    return out


def test_time_after_matches_the_recursion(spark):
    rnd = random.Random(9)
    burns = {p: {y for y in range(1985, 2026) if rnd.random() < rnd.choice((0.02, 0.2, 0.9))} for p in range(60)}
    fire = spark.createDataFrame([(p, y) for p, ys in burns.items() for y in ys], "pixel_id long, year int")
    got = {(r["pixel_id"], r["year"]): r["time_after"] for r in series.chronosequence(fire, 1985, 2025).collect()}
    want = {(p, y): t for p, ys in burns.items() if ys for y, t in recursion(ys, 1985, 2025).items()}
    assert got == want


def test_prefix_and_suffix_frequencies_add_up(spark):
    fire = spark.createDataFrame([(1, 1995), (1, 1997), (2, 2001)], "pixel_id long, year int")
    for r in series.running_frequency(fire, 1995, 2001).collect():
        own = {(1, 1995), (1, 1997), (2, 2001)} & {(r["pixel_id"], r["year"])}
        assert r["so_far"] + r["to_come"] - len(own) == {1: 2, 2: 1}[r["pixel_id"]]


def test_months_that_exclude(spark):
    rules = {}
    for r in masks.earlier_months(spark).collect():
        rules.setdefault(r["month"], []).append((r["year_offset"], r["earlier"]))
    assert sorted(rules[1]) == [(-1, m) for m in (8, 9, 10, 11, 12)]
    assert sorted(rules[2]) == [(-1, 10), (-1, 11), (-1, 12), (0, 1)]
    assert sorted(rules[6]) == [(0, m) for m in range(1, 6)]


def test_fallback_takes_the_latest_or_earliest(spark):
    obs = spark.createDataFrame([(1, "1998-01-10", -900), (1, "1998-03-10", -700)], "pixel_id long, d string, nbr int").withColumn("acq_ts", F.to_timestamp("d"))
    fire = spark.createDataFrame([(1, 1998, 6)], "pixel_id long, year int, month int")
    assert severity.pre_fire(obs, fire, []).first()["pre"] == -700
    assert severity.pre_fire(obs, fire, [], pick="earliest").first()["pre"] == -900


def test_large_dimension_is_not_broadcast(spark):
    plan = lambda df: df._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(scans.dimension(spark.range(10), 10))
    assert "broadcast" not in plan(scans.dimension(spark.range(11), 10))


def test_users_add_data_sets_and_sensors(spark):
    from pyspark.sql import functions as F

    from pyrocell.functions import hooks, optics
    from pyrocell.sources import scans

    added = [(hooks.DATA_SETS, "weeks"), (hooks.CLEAR_TESTS, "XX01"), (hooks.CORRECTIONS, "XX01")]
    try:
        hooks.data_set("weeks")(lambda df, source: df.select("pixel_id", "year", F.ceil(F.col("week") / 4.4).cast("int").alias("month"), F.lit(source).alias("source")))
        hooks.clear_test("XX01")(lambda qa: qa == 64)
        hooks.correction("XX01")(lambda r: r * 2)
        weeks = spark.createDataFrame([(1, 2020, 9)], "pixel_id long, year int, week int")
        assert [tuple(r) for r in scans.reference_products([("weeks", weeks, "w")]).collect()] == [(1, 2020, 3, "w")]
        rows = spark.createDataFrame([("XX01", 64, 0.1), ("XX01", 72, 0.1), ("LT05", 72, 0.1), ("LC08", 64, 0.1)], "s string, qa int, r double")
        got = rows.select(optics.valid(F.col("s"), F.col("qa"), F.lit(0)).alias("ok"), optics.corrected(F.col("s"), F.col("r")).alias("r")).collect()
        assert [r["ok"] for r in got] == [True, False, False, True] and [round(r["r"], 6) for r in got] == [0.2, 0.2, 0.1, 0.0945]
    finally:
        for table, name in added:
            table.pop(name, None)


def test_pyramid_of_many_levels_in_one_shuffle(spark, monkeypatch):
    """Levels within a tile's and beyond; negative places too."""
    from pyrocell.operators import zonal

    monkeypatch.setattr(zonal, "PYRAMID_ROWS", 500)
    df = spark.range(3000).selectExpr("int(id * 7919 % 6007 - 900) AS x", "int(id * 104729 % 5003 - 700) AS y", "int(id % 2) AS year", "int(nullif(id * id % 5, 1)) AS value").withColumn("x", F.col("x") - F.col("x") % 3)
    levels, how = [1, 4, 11, 12], ["mode", "mean", "median"]
    got = {(r["level"], r["year"], r["x"], r["y"]): tuple(round(r[f"{h}_value"], 9) for h in how) for r in zonal.pyramid(df, levels, how=how, keys=["year"]).collect()}
    want = {(n, r["year"], r["x"], r["y"]): tuple(round(r[f"{h}_value"], 9) for h in how) for n in levels for r in zonal.overview(df.where("value IS NOT NULL"), n, how=how, keys=["year"]).collect()}
    assert got == want
    plan = zonal.pyramid(df, [1, 2, 3], keys=["year"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
