"""Neighbourhoods on the grid: dilation, erosion, opening and closing, connected components.

Sets of cells are rows (x, y) with further ``keys`` (scene, year ...) that keep grids apart. Morphology works on them
as words of 64 cells and gives them as runs (y, x0, x1), which can be kept as such: ``words``, ``morphed``, ``cells_of``.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrocell.model import by_key
from pyrocell.sources.shared import Rounds, shared_folder

TILE = 1024


def kept(df: DataFrame) -> DataFrame:
    """Lineage cut in the shared checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


class Step(NamedTuple):
    """A step of morphology: the cells from p - high to p - low on each axis decide about p; any of them, or all."""

    every: bool
    low: int
    high: int

    @property
    def reach(self) -> int:
        return max(abs(self.low), abs(self.high))


def dilate(radius: int) -> list[Step]:
    return [Step(False, -radius, radius)]


def erode(radius: int) -> list[Step]:
    return [Step(True, -radius, radius)]


def open_by(size: int) -> list[Step]:
    """Windows that lie wholly in the set, then their cells; 1 changes nothing."""
    return [Step(True, 1 - size, 0), Step(False, 0, size - 1)]


def close_by(size: int) -> list[Step]:
    return [Step(False, 0, size - 1), Step(True, 1 - size, 0)]


def words(cells: DataFrame, keys: list[str] = []) -> DataFrame:
    """(keys, y, word, bits): the cells of a grid row by 64, united before they are shuffled. Cells without a place are dropped."""
    x = F.col("x").cast("int")
    placed = cells.where("x IS NOT NULL AND y IS NOT NULL")
    rows = placed.select(*keys, F.col("y").cast("int").alias("y"), F.shiftright(x, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63))).alias("bit"))
    return rows.groupBy(*keys, "y", "word").agg(F.bit_or("bit").alias("bits"))


def words_of_runs(runs: DataFrame, keys: list[str] = []) -> DataFrame:
    """The same of runs (keys, y, x0, x1), which may overlap; one with x1 < x0 is empty."""
    full = F.lit(-1).cast("long")
    cut = runs.where("x0 <= x1").select(*keys, "y", "x0", "x1", F.explode(F.sequence(F.shiftright("x0", 6), F.shiftright("x1", 6))).alias("word"))
    first = F.greatest(F.col("x0") - F.col("word") * 64, F.lit(0))
    last = F.least(F.col("x1") - F.col("word") * 64, F.lit(63))
    bits = F.call_function("shiftleft", full, first).bitwiseAND(F.call_function("shiftrightunsigned", full, F.lit(63) - last))
    return cut.select(*keys, "y", "word", bits.alias("bits")).groupBy(*keys, "y", "word").agg(F.bit_or("bits").alias("bits"))


def cells_of(runs: DataFrame, keys: list[str] = []) -> DataFrame:
    """The cells (x, y, keys) of runs that don't overlap."""
    return runs.select(F.explode(F.sequence("x0", "x1")).alias("x"), "y", *keys)


def _stepped(plane: np.ndarray, step: Step) -> np.ndarray:
    """One step on a plane of cells, axis after axis, by differences of running counts; beyond the plane all is empty."""
    for axis in (0, 1):
        n = plane.shape[axis]
        counts = np.zeros((plane.shape[0] + (axis == 0), plane.shape[1] + (axis == 1)), np.int32)
        np.cumsum(plane, axis=axis, out=counts[1:] if axis == 0 else counts[:, 1:])
        at = np.arange(n)
        inside = np.take(counts, np.clip(at - step.low + 1, 0, n), axis=axis) - np.take(counts, np.clip(at - step.high, 0, n), axis=axis)
        plane = inside == step.high - step.low + 1 if step.every else inside > 0
    return plane


def _tile_runs(y: np.ndarray, word: np.ndarray, bits: np.ndarray, steps: list[Step], core: tuple[int, int, int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (y, x0, x1) within the core (x0, y0, x1, y1) after the steps. The plane is no larger than what the words
    can reach, so a tile with few cells costs little."""
    reach = sum(s.reach for s in steps)
    wide = -(-reach // 64)
    top, left = int(y.min()) - reach, int(word.min()) - wide
    packed = np.zeros((int(y.max()) + reach - top + 1, int(word.max()) + wide - left + 1), "<i8")
    packed[y - top, word - left] = bits
    plane = np.unpackbits(packed.view(np.uint8), axis=1, bitorder="little")
    for step in steps:
        plane = _stepped(plane, step)
    ox, oy = max(core[0], left * 64), max(core[1], top)
    part = plane[oy - top : core[3] + 1 - top, ox - left * 64 : core[2] + 1 - left * 64]
    edges = np.diff(np.pad(part.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    (row, start), (_, stop) = np.nonzero(edges == 1), np.nonzero(edges == -1)
    return row + oy, start + ox, stop - 1 + ox


def _rounds(steps: list[Step], most: int) -> list[list[Step]]:
    """Steps by rounds that reach at most ``most`` cells together; a longer step is the same as shorter ones in a row."""
    out, used = [[]], 0
    for step in steps:
        low, high = step.low, step.high
        while True:
            part = Step(step.every, max(-most, min(low, most)), max(-most, min(high, most)))
            low, high = low - part.low, high - part.high
            if used + part.reach > most:
                out, used = [*out, []], 0
            out[-1].append(part)
            used += part.reach
            if low == high == 0:
                break
    return out


def _on_tiles(steps: list[Step], side: int, names: list[str]) -> Callable:
    """The function of one tile of one grid."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        ty, tx = key[-2].as_py(), key[-1].as_py()
        core = (tx * side, ty * side, (tx + 1) * side - 1, (ty + 1) * side - 1)
        y, word, bits = (rows[c].to_numpy() for c in ("y", "word", "bits"))
        runs = _tile_runs(y, word, bits, steps, core)
        return pa.table([*(pa.repeat(v, len(runs[0])) for v in key[:-2]), *(pa.array(r, pa.int32()) for r in runs)], names=[*names, "y", "x0", "x1"])

    return run


def morphed(words: DataFrame, steps: list[Step], keys: list[str] = [], tile: int = TILE) -> DataFrame:
    """Runs (keys, y, x0, x1) of a set, given by ``words``, after the steps in turn; runs end at tiles' edges.

    A tile and what lies within the steps' reach of it meet in one task, which does all steps at once: at most
    (3 tile)^2 cells as a plane, whatever the input. Only words near an edge go to more than one tile, no cell is
    multiplied by the width of a window. Steps that reach further than a tile take several rounds.
    """
    side = -(-tile // 64) * 64
    names = [f"k{i}" for i in range(len(keys))]
    kinds = "".join(f"{n} {words.schema[k].dataType.simpleString()}, " for k, n in zip(keys, names, strict=True))
    runs = None
    for part in _rounds(steps, side):
        reach = sum(s.reach for s in part)
        rows = words if runs is None else words_of_runs(runs, keys)
        tiles = lambda first, last, r=reach: F.explode(F.sequence(F.floor((first - r) / side).cast("int"), F.floor((last + r) / side).cast("int")))
        rows = rows.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], "y", "word", "bits")
        dealt = rows.withColumn("ty", tiles(F.col("y"), F.col("y"))).withColumn("tx", tiles(F.col("word") * 64, F.col("word") * 64 + 63))

        runs = dealt.groupBy(*names, "ty", "tx").applyInArrow(_on_tiles(part, side, names), f"{kinds}y int, x0 int, x1 int")
        runs = runs.select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)], "y", "x0", "x1")
    return runs


def changed(cells: DataFrame, steps: list[Step], keys: list[str] = [], tile: int = TILE) -> DataFrame:
    """The cells (x, y, keys) of a set after the steps; no steps only drop repeats."""
    return cells_of(morphed(words(cells, keys), steps, keys, tile), keys)


def dilated(cells: DataFrame, radius: int, keys: list[str] = []) -> DataFrame:
    """All cells within a square of ``radius`` about a cell."""
    return changed(cells, dilate(radius), keys)


def eroded(cells: DataFrame, radius: int, keys: list[str] = []) -> DataFrame:
    """Cells whose whole square of ``radius`` is in the set."""
    return changed(cells, erode(radius), keys)


def opened(cells: DataFrame, size: int, keys: list[str] = []) -> DataFrame:
    """The union of all size x size windows that lie wholly in the set; 1 changes nothing."""
    return changed(cells, open_by(size), keys)


def closed(cells: DataFrame, size: int, keys: list[str] = []) -> DataFrame:
    """Cells that no size x size window outside the set covers: dilation, then erosion by the same window.

    Cells outside the grid count as empty.
    """
    return changed(cells, close_by(size), keys)


def filtered(cells: DataFrame, opening: int = 4, closing: int = 8, keys: list[str] = []) -> DataFrame:
    """Opening, then closing; a size of 0 or 1 skips its step."""
    return changed(cells, [s for size, make in ((opening, open_by), (closing, close_by)) if size > 1 for s in make(size)], keys)


def _labels(key: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components of one tile's cells: each takes the least neighbour's label, pointers followed, until none moves."""
    order = np.argsort(key)
    x, y = x[order], y[order]
    code = x.astype(np.int64) * (1 << 32) + y
    by = np.argsort(code)
    label = np.arange(len(key))
    pairs = []
    for dx, dy in ((1, 0), (0, 1)):
        want = (x + dx).astype(np.int64) * (1 << 32) + y + dy
        at = np.minimum(np.searchsorted(code[by], want), len(by) - 1)
        hit = code[by][at] == want
        pairs.append((np.flatnonzero(hit), by[at[hit]]))
    a, b = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            break
        label = new[label]
    return key[order], key[order][label]


def connected(cells: DataFrame, keys: list[str] = [], tile: int = TILE) -> DataFrame:
    """4-connected components: (x, y, keys, component); a component is named by its least ``cell`` = y * 2^32 + x.

    Tiles of bounded size are labelled one by one (at most tile^2 cells in a task); labels that touch across a border
    are then joined by hooking to the least and contracting, written at each round, until none touch. Rounds grow
    with the logarithm of the longest chain of tiles.
    """
    cells = kept(cells.select("x", "y", *keys).distinct().withColumn("cell", F.col("y").cast("long") * (1 << 32) + F.col("x")))
    tiled = cells.withColumns({"tx": F.floor(F.col("x") / tile), "ty": F.floor(F.col("y") / tile)})
    kinds = ", ".join(f"`{k}` {cells.schema[k].dataType.simpleString()}" for k in keys)
    names = [f"k{i}" for i in range(len(keys))]
    flat = tiled.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], "tx", "ty", "x", "y", "cell")
    kinds = ", ".join(f"{n} {cells.schema[k].dataType.simpleString()}" for k, n in zip(keys, names, strict=True))

    def label(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        found = _labels(*(rows[c].to_numpy() for c in ("cell", "x", "y")))
        return pa.table([*(pa.repeat(v, len(rows)) for v in key[: len(names)]), *map(pa.array, found)], names=[*names, "cell", "label"])

    labelled = flat.groupBy(*names, "tx", "ty").applyInArrow(label, (kinds + ", " if kinds else "") + "cell long, label long")
    labelled = kept(labelled.select(*[F.col(n).alias(k) for k, n in zip(keys, names, strict=True)], "cell", "label"))
    on = [*keys, "cell"]
    border = tiled.where((F.pmod("x", F.lit(tile)) == tile - 1) | (F.pmod("y", F.lit(tile)) == tile - 1))
    step = F.explode(F.filter(F.array(F.when(F.pmod("x", F.lit(tile)) == tile - 1, F.lit(1)), F.when(F.pmod("y", F.lit(tile)) == tile - 1, F.lit(1 << 32))), lambda s: s.isNotNull()))
    touching = border.select(*keys, "cell", step.alias("step")).withColumn("other", F.col("cell") + F.col("step"))
    edges = touching.join(by_key(labelled), on).withColumnRenamed("label", "a").drop("cell").withColumnRenamed("other", "cell").join(by_key(labelled), on).select(*keys, "a", F.col("label").alias("b"))
    rounds = Rounds(cells.sparkSession)
    edges = rounds.put(edges.where("a <> b").distinct())
    roots = labelled.select(*keys, F.col("label").alias("node")).distinct().withColumn("component", F.col("node"))
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(*keys, F.col("b").alias("a"), F.col("a").alias("b")))
        up = rounds.put(both.groupBy(*keys, "a").agg(F.min("b").alias("b")).select(*keys, F.col("a").alias("node"), F.least("a", "b").alias("to")))
        while True:
            ends = up.select(*keys, F.col("node").alias("to"), F.col("to").alias("end"))
            jumped = rounds.put(up.join(by_key(ends), [*keys, "to"]).select(*keys, "node", F.col("end").alias("new"), (F.col("end") < F.col("to")).alias("moved")))
            up = jumped.select(*keys, "node", F.col("new").alias("to"))
            if jumped.where("moved").isEmpty():
                break
        roots = rounds.put(roots.join(by_key(up.select(*keys, F.col("node").alias("component"), "to")), [*keys, "component"], "left").select(*keys, "node", F.coalesce("to", "component").alias("component")))
        a, b = up.select(*keys, F.col("node").alias("a"), F.col("to").alias("ra")), up.select(*keys, F.col("node").alias("b"), F.col("to").alias("rb"))
        edges = rounds.put(edges.join(by_key(a), [*keys, "a"]).join(by_key(b), [*keys, "b"]).where("ra <> rb").select(*keys, F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
    roots = rounds.only(roots)
    found = labelled.join(by_key(roots.withColumnRenamed("node", "label")), [*keys, "label"]).select(*on, "component")
    return cells.join(by_key(found), on).select("x", "y", *keys, "component")


def without_solitary(cells: DataFrame, most: int = 6, keys: list[str] = [], cap: int = 100) -> DataFrame:
    """Cells of components with more than ``most`` cells, counted up to ``cap``."""
    labelled = connected(cells, keys)
    sizes = labelled.groupBy(*keys, "component").agg(F.least(F.count("*"), F.lit(cap)).alias("n"))
    return labelled.join(by_key(sizes.where(F.col("n") > most)), [*keys, "component"], "left_semi").select("x", "y", *keys)


def merged_pieces(pieces: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Classified pieces as one: of each cell the last value, by ``order``, that is neither 0 nor void."""
    return pieces.where("value IS NOT NULL AND value <> 0").groupBy(*keys).agg(F.max_by("value", F.struct(*order)).alias("value"))
