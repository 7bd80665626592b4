"""Areas by territory and class, polygons on the grid, overviews."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyrocell.model import by_key
from pyrocell.sources.scans import dimension

#: Territory units: the columns of a composite code with their factors, the coarsest first (fixed values). A pixel
#: outside one of a unit's layers (void there) isn't part of the unit.
UNITS = {
    "biome": {"biome_id": 1},
    "state": {"biome_id": 100, "state_id": 1},
    "tenure": {"biome_id": 10_000, "state_id": 100, "tenure_id": 1},
    "indigenous": {"biome_id": 1_000_000, "ti_id": 1},
    "protected_state_strict": {"biome_id": 1_000_000, "uc_state_strict": 1},
    "protected_state_use": {"biome_id": 1_000_000, "uc_state_use": 1},
    "protected_federal_strict": {"biome_id": 1_000_000, "uc_federal_strict": 1},
    "protected_federal_use": {"biome_id": 1_000_000, "uc_federal_use": 1},
    "municipality": {"biome_id": 10_000_000, "municipality_id": 1},
    "municipality_alone": {"municipality_id": 1},
    "indigenous_alone": {"ti_id": 1},
}


def packed_code(unit: dict[str, int]) -> Column:
    """A unit's composite code; void where one of its columns is."""
    return reduce(add, [F.col(c).cast("long") * f for c, f in unit.items()])


def unpacked_code(code: Column, unit: dict[str, int]) -> dict[str, Column]:
    """The columns that a composite code was packed from."""
    whole = [None, *unit.values()]  # what a column can't reach is the factor of the coarser one
    return {c: (F.floor(code / f) if above is None else F.floor(code % above / f)).cast("int") for (c, f), above in zip(unit.items(), whole, strict=False)}


def product_on_cover(cover: DataFrame, product: DataFrame, keys: list[str] = ["pixel_id", "year"]) -> DataFrame:
    """Every land-cover pixel with the product's value, 0 where it has none."""
    return cover.join(by_key(product.select(*keys, "value")), keys, "left").withColumn("value", F.coalesce("value", F.lit(0)))


def zonal_area(df: DataFrame, by: list[str]) -> DataFrame:
    """Hectares of ``area_km2`` by columns: map-side partial sums, so skewed biomes don't matter."""
    return df.groupBy(*by).agg((F.sum("area_km2") * 100).alias("area_ha"))


def all_units(df: DataFrame, by: list[str], units: dict[str, dict[str, int]] = UNITS) -> DataFrame:
    """Hectares by ``by`` and every territory unit in one scan: (by, unit, territory, area_ha), ``territory`` packed.

    Pixels are first summed by all territory columns together, which is far fewer rows; these are then counted in each
    of their units.
    """
    columns = list(dict.fromkeys(c for u in units.values() for c in u))
    fine = df.groupBy(*by, *columns).agg(F.sum("area_km2").alias("__area"))
    codes = F.array_compact(F.array(*[F.when(packed_code(u).isNotNull(), F.struct(F.lit(n).alias("unit"), packed_code(u).alias("territory"))) for n, u in units.items()]))
    each = fine.select(*by, "__area", F.explode(codes).alias("__u"))
    return each.groupBy(*by, F.col("__u.unit").alias("unit"), F.col("__u.territory").alias("territory")).agg((F.sum("__area") * 100).alias("area_ha"))


def named_units(df: DataFrame, legends: dict[str, DataFrame], units: dict[str, dict[str, int]] = UNITS) -> DataFrame:
    """Rows with (unit, territory) and, for each legend (column -> code, name), the column's number and its name; void
    where the unit hasn't the column or the legend hasn't the code."""
    out = df
    for column, legend in legends.items():
        number = reduce(lambda x, nu: x.when(F.col("unit") == nu[0], unpacked_code(F.col("territory"), nu[1])[column]), [(n, u) for n, u in units.items() if column in u], F.when(F.lit(False), F.lit(None).cast("int")))
        named = legend.select(F.col("code").alias(column), F.col("name").alias(f"{column}_name"))
        out = out.withColumn(column, number).join(dimension(named), column, "left")
    return out


#: The products whose values are crossed with land cover as value * 100 + class, and by themselves (fixed names).
PRODUCTS = ["annual_burned", "monthly_burned", "fire_frequency", "year_last_fire", "scar_size_range", "time_after_fire", "accumulated_burned"]


def product_rows(wide: DataFrame, products: list[str] = PRODUCTS, cover: str = "class") -> DataFrame:
    """(product, value) rows from one column for each product; with land cover each product comes twice, alone and as
    ``..._coverage`` with the packed code. Void values drop out, and void covers with their codes. The other columns
    stay."""
    alone = [F.when(F.col(p).isNotNull(), F.struct(F.lit(p).alias("product"), F.col(p).cast("int").alias("value"))) for p in products]
    crossed = [F.when(F.col(p).isNotNull() & F.col(cover).isNotNull(), F.struct(F.lit(f"{p}_coverage").alias("product"), (F.col(p) * 100 + F.col(cover)).cast("int").alias("value"))) for p in products]
    rest = [c for c in wide.columns if c not in (*products, cover)]
    return wide.select(*rest, F.explode(F.array_compact(F.array(*alone, *crossed))).alias("__p")).select(*rest, "__p.product", "__p.value")


def area_by_period(df: DataFrame, least: float = 0.001) -> DataFrame:
    """Hectares where the value reaches ``least``, by month and by year (month void)."""
    return df.where(F.col("value") >= least).rollup("year", "month").agg((F.sum("area_km2") * 100).alias("area_ha")).where("year IS NOT NULL")


def decoded(df: DataFrame, legend: DataFrame, code: str, labels: list[str]) -> DataFrame:
    """Labels of a code from a legend (code, labels...); void where the legend hasn't it."""
    return df.join(dimension(legend.select(F.col("code").alias(code), *labels)), code, "left")


def remapped(df: DataFrame, pairs: DataFrame, column: str) -> DataFrame:
    """Classes mapped by (from, to); rows whose class isn't in the list drop out."""
    return df.join(dimension(pairs.select(F.col("from").alias(column), "to")), column).drop(column).withColumnRenamed("to", column)


def overlaid(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two layers (pixel_id, code) as one, the first above the second."""
    return first.select("pixel_id", F.col("code").alias("a")).join(by_key(second.select("pixel_id", F.col("code").alias("b"))), "pixel_id", "full").select("pixel_id", F.coalesce("a", "b").alias("code"))


def prepared_layer(layer: DataFrame, names: list[str], name: str = "name", number: str = "id_text") -> DataFrame:
    """Features of some names, with a label and the number in a text column (void where it is none)."""
    return layer.where(F.col(name).isin(names)).withColumns({"label": F.initcap(name), "number": F.col(number).try_cast("int")})


def scanlines(polygons: DataFrame) -> DataFrame:
    """(code, y, x0, x1) for every row of the grid that a polygon covers: its points there are x0 <= x < x1.

    A polygon is (code, ring array<struct<lon, lat>>), or (code, rings array of such) for a feature of several parts and
    holes; what an even number of its rings holds is outside. Each edge gives one crossing for each row that it spans; a
    row's crossings in order are the ends of its stretches. So a polygon costs what its outline costs, whatever its area,
    and no row carries a ring. Points on an edge count as the ray test going east has them, so a point on an edge that two
    polygons share is in exactly one. Polygons of one code are told apart; equal ones count once.
    """
    rings = F.col("rings") if "rings" in polygons.columns else F.array("ring")
    next_of = lambda ring, i: F.element_at(ring, i % F.size(ring) + 1)
    edges_of = lambda ring: F.when(F.size(ring) > 0, F.transform(F.sequence(F.lit(1), F.size(ring)), lambda i: F.struct(F.element_at(ring, i).alias("a"), next_of(ring, i).alias("b"))))
    edges = polygons.select("code", rings.alias("rings")).distinct().withColumn("__polygon", F.xxhash64("code", "rings"))
    edges = edges.select("__polygon", "code", F.explode("rings").alias("ring")).select("__polygon", "code", F.explode(edges_of(F.col("ring"))).alias("e"))
    low, high = F.least("e.a.lat", "e.b.lat"), F.greatest("e.a.lat", "e.b.lat")
    rows = edges.withColumns({"__from": F.ceil(low).cast("int"), "__to": (F.ceil(high) - 1).cast("int")}).where("__from <= __to")
    rows = rows.withColumn("y", F.explode(F.sequence("__from", "__to")))
    at = F.col("e.a.lon") + (F.col("y") - F.col("e.a.lat")) * (F.col("e.b.lon") - F.col("e.a.lon")) / (F.col("e.b.lat") - F.col("e.a.lat"))
    ends = rows.select("__polygon", "code", "y", at.alias("at")).groupBy("__polygon", "code", "y").agg(F.array_sort(F.collect_list("at")).alias("ends"))
    stretch = F.explode(F.transform(F.sequence(F.lit(1), F.floor(F.size("ends") / 2).cast("int")), lambda k: F.struct(F.element_at("ends", 2 * k - 1).alias("x0"), F.element_at("ends", 2 * k).alias("x1"))))
    return ends.select("code", "y", stretch.alias("s")).select("code", "y", "s.x0", "s.x1")


def labelled_by_polygon(pixels: DataFrame, polygons: DataFrame, cell: int = 256) -> DataFrame:
    """Pixels (x, y) that lie in polygons (code, and ring or rings, see ``scanlines``), with the polygon's code.

    The polygons' stretches of each row are cut at every ``cell`` columns, and the join is on row and cut.
    """
    at = lambda c: F.floor(c / cell).cast("int")
    pieces = scanlines(polygons).where("x0 < x1").withColumn("cx", F.explode(F.sequence(at(F.col("x0")), at(F.col("x1")))))
    met = pixels.withColumn("cx", at(F.col("x"))).join(by_key(pieces), ["y", "cx"])
    return met.where("x >= x0 AND x < x1").select(*pixels.columns, "code")


def clipped_to_scenes(pixels: DataFrame, scenes: DataFrame, buffer: float, least: float = 0.01, cell: int = 1024) -> DataFrame:
    """Pixels within each scene's box (scene, x0, y0, x1, y1) grown by ``buffer``; scenes that share less than
    ``least`` of area with the pixels' extent are left out. A box is cut into squares of ``cell``, some dozens for a scene."""
    extent = pixels.agg(F.min("x").alias("ex0"), F.min("y").alias("ey0"), F.max("x").alias("ex1"), F.max("y").alias("ey1"))
    grown = scenes.select("scene", *[(F.col(c) + d * buffer).alias(c) for c, d in (("x0", -1), ("y0", -1), ("x1", 1), ("y1", 1))]).join(F.broadcast(extent))
    side = lambda a: F.greatest(F.lit(0.0), F.least(f"{a}1", f"e{a}1") - F.greatest(f"{a}0", f"e{a}0"))
    kept = grown.where(side("x") * side("y") >= least)
    at = lambda c: F.floor(c / cell).cast("int")
    pieces = kept.withColumn("cx", F.explode(F.sequence(at(F.greatest("x0", "ex0")), at(F.least("x1", "ex1"))))).withColumn("cy", F.explode(F.sequence(at(F.greatest("y0", "ey0")), at(F.least("y1", "ey1")))))
    placed = pixels.withColumns({"cx": at(F.col("x")), "cy": at(F.col("y"))})
    return placed.join(pieces, ["cx", "cy"]).where("x >= x0 AND x <= x1 AND y >= y0 AND y <= y1").select("scene", *pixels.columns)


def overview(df: DataFrame, levels: int, value: str = "value", how: str | list[str] = "mode", keys: list[str] = []) -> DataFrame:
    """The grid with cells of 2^levels: mode (ties: the least), median or mean of what isn't void; with a list, each as
    ``<how>_<value>`` from one aggregate."""
    of = {"mode": F.mode(value, True), "median": F.median(value), "mean": F.avg(value)}
    down = lambda c: F.floor(F.col(c) / (1 << levels)).cast("int").alias(c)
    wanted = [of[how].alias(value)] if isinstance(how, str) else [of[h].alias(f"{h}_{value}") for h in how]
    return df.groupBy(*keys, down("x"), down("y")).agg(*wanted)


#: Rows of the grid that a task takes for a pyramid, about; and the levels that a task can make of a tile of its own.
PYRAMID_ROWS, TILE_LEVELS = 1 << 18, 10


def pyramid(df: DataFrame, levels: list[int], value: str = "value", how: str | list[str] = "mode", keys: list[str] = []) -> DataFrame:
    """Overviews of several levels at once, with a column ``level``: values are counted by cell of the finest level,
    and the coarser ones are made from these counts, for several of mode (ties: the least), mean and median together.
    With a list, each is ``<how>_<value>``.

    The grid's rows are counted first and then shuffled once, by tile, into tasks of about PYRAMID_ROWS rows, which make
    all levels of a tile; so a task's memory doesn't grow with the grid. Levels beyond TILE_LEVELS, whose cells are larger
    than a tile, take the tiles' counts, which are few, through one more shuffle.
    """
    of = {"mode": F.max_by(value, F.struct(F.col("__n"), -F.col(value))), "mean": F.sum(F.col(value) * F.col("__n")) / F.sum("__n"), "median": F.percentile(value, F.lit(0.5), F.col("__n"))}
    wanted = [of[how].alias(value)] if isinstance(how, str) else [of[h].alias(f"{h}_{value}") for h in how]
    at = lambda c, by: F.floor(F.col(c) / by).cast("int")
    near, far = [[n for n in sorted(levels) if (n <= TILE_LEVELS) == small] for small in (True, False)]
    made = near or [TILE_LEVELS]
    tile = ["__tx", "__ty"]
    rows = df.where(F.col(value).isNotNull()).select(*keys, value, *[at(c, 1 << made[-1]).alias(t) for c, t in zip("xy", tile, strict=True)], *[at(c, 1 << made[0]).alias(c) for c in "xy"])
    tasks = -(-rows.count() // PYRAMID_ROWS)
    counts = rows.repartition(max(1, tasks), *keys, *tile).groupBy(*keys, *tile, "x", "y", value).agg(F.count("*").alias("__n"))

    def of_levels(counts: DataFrame, wide: list[str], base: int, levels: list[int]) -> DataFrame:
        step = F.explode(F.array(*[F.struct(F.lit(n).alias("level"), F.lit(1 << (n - base)).alias("by")) for n in levels]))
        level, x, y = F.col("__l.level").alias("level"), at("x", F.col("__l.by")).alias("x"), at("y", F.col("__l.by")).alias("y")
        summed = counts.withColumn("__l", step).groupBy(*keys, *wide, level, x, y, value).agg(F.sum("__n").alias("__n"))
        return summed.groupBy(*keys, *wide, "level", "x", "y").agg(*wanted).drop(*wide)

    if not far:
        return of_levels(counts, tile, made[0], near)
    coarse = counts.groupBy(*keys, *tile, value).agg(F.sum("__n").alias("__n")).withColumnsRenamed({"__tx": "x", "__ty": "y"})
    out = of_levels(coarse, [], made[-1], far)
    return of_levels(counts, tile, made[0], near).unionByName(out) if near else out
