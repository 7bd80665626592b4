"""Exact Jaccard join on word n-grams by vertical partitioning.

1. A sketch of fixed size counts all n-grams and gives a global order, rare ones first; it also tells where to cut that
   order into fragments of equal mass.
2. Documents of one set form a class; classes, not copies, are joined. A class's rarest n-grams (its prefix) must meet
   those of every class it links with. Classes that share a prefix n-gram form a bucket.
3. In each bucket all classes are first compared with one of them. Where that leaves a bucket in several components,
   the classes outside its largest component are compared with those of other components and of about their size. Two
   classes of one component needn't be compared, so a group of near copies costs as many pairs as it has members.
4. A pair is compared by fragments: overlaps are counted in each on its own and summed. Prefixes are
   compared first, and most pairs that aren't linked go, as they share too little of these.

No candidate is dropped but by bounds that hold for every linked pair (prefix, sizes, positions, overlap of prefixes).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyrocell.llm import pieces as P
from pyrocell.llm.common import bit_filter, heavy, kept, salted
from pyrocell.llm.components import components
from pyrocell.llm.fingerprints import mixed, word_hashes

SLOT_BITS, SLICES, FRAGMENTS = 21, 64, 8
#: n-grams of this count's rank or above go through joins that split, so no window is larger.
HOT = 100_000
#: With more wanted ids than this their filter is a join.
FILTER_IDS = 1 << 23
LARGE_CLASSES = 1000
#: Rows of one key at least, before it is salted.
SALTED = 256
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MUL = np.uint64(0x9E3779B97F4A7C15)


def grams(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of words (fewer words: all of them as one), and the text of each.

    A-Z is lower-cased; words are parted by the six ASCII white-space characters.
    """
    data = _LOWER[np.frombuffer("\n".join(texts).encode() + b"\n", np.uint8)]
    ends = np.cumsum(np.fromiter((len(t.encode()) + 1 for t in texts), np.int64, len(texts)))
    start, _, h = word_hashes(data)
    owner = np.searchsorted(ends, start, side="right")
    if not len(h):
        return h, owner
    words = np.bincount(owner, minlength=len(texts))
    first = np.concatenate([[True], owner[1:] != owner[:-1]])
    run, left = h * np.uint64(3), words[owner] - (np.arange(len(h)) - (np.cumsum(words) - words)[owner])
    for k in range(1, n):
        shifted = np.zeros_like(h)
        shifted[:-k or None] = h[k:]
        run = np.where(left > k, mixed(run * _MUL + shifted), run)
    use = (left >= n) | first
    return mixed(run[use]), owner[use]


def sketch(df: DataFrame, n: int) -> np.ndarray:
    """How many n-grams of the corpus fall in each of 2^SLOT_BITS slots; of fixed size, summed in a tree."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, np.uint32)
        for batch in batches:
            for _, _, texts in P.text_blocks(batch.column(0)):
                h, _ = grams(texts, n)
                slots, n_times = np.unique(h >> np.uint64(64 - SLOT_BITS), return_counts=True)
                total[slots.astype(np.int64)] += n_times.astype(np.uint32)
        parts = [zlib.compress(p.tobytes(), 1) for p in np.split(total, SLICES)]
        yield pa.record_batch([pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], names=["slice", "counts"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(c), np.uint32).astype(np.uint64) for c in pdf["counts"])
        total = np.minimum(total, 0xFFFFFFFF).astype(np.uint32)
        return pd.DataFrame({"slice": pdf["slice"].iloc[:1], "task": pdf["task"].iloc[:1] // 64, "counts": [zlib.compress(total.tobytes(), 1)]})

    parts = df.mapInArrow(count, "slice int, counts binary").withColumn("task", F.spark_partition_id())
    tasks = df.rdd.getNumPartitions()
    while True:
        parts = parts.groupBy("slice", (F.col("task") / 64).cast("int").alias("group")).applyInPandas(merge, "slice int, task int, counts binary")
        tasks = -(-tasks // 64)
        if tasks <= 1:
            break
    rows = {r["slice"]: r["counts"] for r in parts.select("slice", "counts").collect()}
    empty = zlib.compress(bytes(4 << SLOT_BITS - SLICES.bit_length() + 1))
    return np.concatenate([np.frombuffer(zlib.decompress(rows.get(s, empty)), np.uint32) for s in range(SLICES)])


class Order:
    """The global order of n-grams: by the class of their slot's count, then by hash; and its fragments."""

    def __init__(self, counts: np.ndarray, fragments: int = FRAGMENTS):
        rank = lambda n: np.floor(2 * np.log2(np.maximum(n, 1))).astype(np.uint8)
        self.rank = rank(counts)
        by = np.argsort(self.rank, kind="stable")
        mass = np.cumsum(counts[by], dtype=np.float64)
        self.fragment = np.zeros(len(counts), np.uint8)
        self.fragment[by] = np.minimum(fragments * mass / max(1.0, mass[-1]), fragments - 1e-9).astype(np.uint8)
        # From a rank's edge, so that in every set the cold n-grams come before the hot ones.
        self.hot = self.rank >= rank(HOT)

    def sets(self, texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct n-grams of each text in the global order: hashes, texts, slots."""
        h, owner = grams(texts, n)
        slot = (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        by = np.lexsort((h, self.rank[slot], owner))
        h, owner, slot = h[by], owner[by], slot[by]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        return h[new], owner[new], slot[new]


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values.view(np.int64), pa.int64()))


def classes_of(df: DataFrame, order, n: int, percent: int) -> DataFrame:
    """For each row: id, size, a 64-bit key and a check of the set, and its prefix (n-grams too frequent for a window apart)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        of = order.value
        for batch in batches:
            for a, b, texts in P.text_blocks(batch.column(1)):
                h, owner, slot = of.sets(texts, n)
                size = np.bincount(owner, minlength=b - a)
                begin = np.cumsum(size) - size
                full = np.flatnonzero(size)
                key, check = np.zeros((2, b - a), np.uint64)
                if len(full):
                    key[full] = mixed(np.add.reduceat(mixed(h * np.uint64(3)), begin[full]))
                    check[full] = np.bitwise_xor.reduceat(mixed(h * np.uint64(5)), begin[full])
                near = np.arange(len(h)) - begin[owner] < (size + (-size * percent // 100) + 1)[owner]
                hot = of.hot[slot]
                cold_n, hot_n = (np.bincount(owner[near & x], minlength=b - a) for x in (~hot, hot))
                yield pa.record_batch(
                    [batch.column(0).slice(a, b - a), pa.array(size, pa.int64()), pa.array(key.view(np.int64)), pa.array(check.view(np.int64)), _lists(h[near & ~hot], cold_n), _lists(h[near & hot], hot_n)],
                    names=["id", "size", "key", "check", "cold", "hot"],
                )

    return df.mapInArrow(run, f"id {df.schema['id'].dataType.simpleString()}, size long, key long, check long, cold array<long>, hot array<long>")


def segments_of(df: DataFrame, order, n: int, wanted) -> DataFrame:
    """(key, fragment, grams) of the rows whose id's hash is in the filter ``wanted``; of all rows without a filter."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        of = order.value
        for batch in batches:
            column = batch.column(1)
            if wanted is not None:
                bits, at = wanted.value, batch.column(2).to_numpy()
                column = column.take(pa.array(np.flatnonzero(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1)))
            for a, b, texts in P.text_blocks(column):
                h, owner, slot = of.sets(texts, n)
                if not len(h):
                    continue
                size = np.bincount(owner, minlength=b - a)
                key = np.zeros(b - a, np.uint64)
                full = np.flatnonzero(size)
                key[full] = mixed(np.add.reduceat(mixed(h * np.uint64(3)), (np.cumsum(size) - size)[full]))
                part = owner * FRAGMENTS + of.fragment[slot]
                by = np.argsort(part, kind="stable")
                part, first, counts = np.unique(part[by], return_index=True, return_counts=True)
                yield pa.record_batch([pa.array(key[part // FRAGMENTS].view(np.int64)), pa.array(part % FRAGMENTS, pa.int32()), _lists(h[by], counts)], names=["key", "fragment", "grams"])

    rows = df.select("id", "text", F.pmod(F.xxhash64("id"), F.lit(1 if wanted is None else 8 * len(wanted.value))).alias("at"))
    return rows.mapInArrow(run, "key long, fragment int, grams array<long>")


def band(size: Column, percent: int) -> Column:
    """A number by size, such that sets that link have the same or neighbouring numbers.

    A link bounds the quotient of both sizes, so a step is that bound, and a little more for rounding.
    """
    return F.floor(F.log(size.cast("double")) / (max(math.log(100 / percent), 0.01) * 1.001)).cast("int")


def overlaps(pairs: DataFrame, of_a: DataFrame, of_b: DataFrame, fragments: int = FRAGMENTS) -> DataFrame:
    """``pairs`` (a, b, size_a, size_b) with the overlap of their sets: counted by fragment, summed by pair. ``of_a`` and
    ``of_b`` hold the segments of either side's classes; other classes' do no harm.

    Both joins are on (class, fragment); a class may come more than once. A class with very many pairs, such as the hub
    of a large group of copies, is salted on both sides.
    """
    total = pairs.count()
    heavy_a, heavy_b = heavy(pairs, "a", total, SALTED), heavy(pairs, "b", total, SALTED)
    dealt = salted(salted(pairs, "a", heavy_a, F.xxhash64("b"), "salt_a"), "b", heavy_b, F.xxhash64("a"), "salt_b")
    parted = dealt.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(fragments - 1))))
    left = salted(of_a.select(F.col("key").alias("a"), "fragment", F.col("grams").alias("grams_a")), "a", heavy_a, None, "salt_a")
    right = salted(of_b.select(F.col("key").alias("b"), "fragment", F.col("grams").alias("grams_b")), "b", heavy_b, None, "salt_b")
    partial = parted.join(left, ["a", "fragment", "salt_a"]).join(right, ["b", "fragment", "salt_b"]).select("a", "b", "size_a", "size_b", "fragment", F.size(F.array_intersect("grams_a", "grams_b")).cast("long").alias("n"))
    once = partial.groupBy("a", "b", "size_a", "size_b", "fragment").agg(F.max("n").alias("n"))
    return once.groupBy("a", "b", "size_a", "size_b").agg(F.sum("n").alias("overlap"))


def prefixes_of(classes: DataFrame, wanted) -> DataFrame:
    """(key, fragment, grams) with the prefix, as one fragment, of the classes whose key's hash is in the filter ``wanted``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            at = batch.column(3).to_numpy()
            yield batch.filter(pa.array((bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))).select([0, 1, 2])

    rows = classes.select("key", F.lit(0).alias("fragment"), F.concat("cold", "hot").alias("grams"), F.pmod(F.xxhash64("key"), F.lit(8 * len(wanted.value))).alias("at"))
    return rows.mapInArrow(run, "key long, fragment int, grams array<long>")


def reaching(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b, size_a, size_b) whose prefixes share enough for a link.

    Of the two prefixes take the one that ends first in the global order. What is common up to its end lies in both
    prefixes, and beyond it that set has no more than its other n-grams. So an overlap is at most what the prefixes
    share and the rest of the larger set. Prefixes are a sixth of the sets or so, which then needn't be moved.
    """

    def prefixes(side: str) -> DataFrame:
        hashes = pairs.select(F.xxhash64(side).alias("hash")).distinct()
        return prefixes_of(classes, pairs.sparkSession.sparkContext.broadcast(bit_filter(hashes)))

    shared = overlaps(pairs, prefixes("a"), prefixes("b"), 1)
    rest = F.floor((F.greatest("size_a", "size_b") * percent + 99) / 100) - 1
    return shared.where((F.col("overlap") + rest) * (100 + percent) >= (F.col("size_a") + F.col("size_b")) * percent).drop("overlap")


def linked(df: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Membership (id, size, key) of every row, and the links found between classes (a, b).

    The links hold every component together; pairs within a component that need no comparison aren't listed.
    """
    spark = df.sparkSession
    docs = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    order = spark.sparkContext.broadcast(Order(sketch(docs.select("text"), n)))
    rows = kept(classes_of(docs, order, n, percent))
    members = rows.select("id", "size", "key")
    classes = kept(rows.where("size > 0").groupBy("key", "check", "size").agg(F.first("cold").alias("cold"), F.first("hot").alias("hot")))

    def may_link(size_a, at_a, size_b, at_b):
        """What holds at the first common n-gram of a linked pair: the overlap can't be more than what is left of
        either set from there on, and must reach its share of both sizes."""
        return F.least(size_a - at_a, size_b - at_b) * (100 + percent) >= (size_a + size_b) * percent

    def ordered(key_a: str, size_a: str, key_b: str, size_b: str):
        """A pair's columns, the lesser key first."""
        lower = F.col(key_a) < F.col(key_b)
        pick = lambda x, y: F.when(lower, F.col(x)).otherwise(F.col(y))
        return [pick(key_a, key_b).alias("a"), pick(key_b, key_a).alias("b"), pick(size_a, size_b).alias("size_a"), pick(size_b, size_a).alias("size_b")]

    # The hub of a bucket is the class with the fewest rarer n-grams before the shared one: what the others vary.
    one = F.struct("at", "key", "size")
    window = Window.partitionBy("gram")
    cold = classes.select("key", "size", F.posexplode("cold").alias("at", "gram")).withColumns({"hub": F.min(one).over(window), "low": F.min("key").over(window), "top": F.max("key").over(window)})
    cold = cold.where("low <> top").drop("low", "top")
    hot = classes.select("key", "size", F.size("cold").alias("before"), F.posexplode("hot").alias("at", "gram")).withColumn("at", F.col("at") + F.col("before")).drop("before")
    hubs = hot.groupBy("gram").agg(F.min(one).alias("hub"), F.min("key").alias("low"), F.max("key").alias("top")).where("low <> top").drop("low", "top")
    buckets = kept(cold.unionByName(hot.join(hubs, "gram").select(*cold.columns)))

    def compare(pairs: DataFrame) -> DataFrame:
        """Which pairs (a, b, with sizes) are linked."""
        pairs = kept(reaching(pairs, classes, percent))
        firsts = members.groupBy("key").agg(F.min("id").alias("id"))

        def segments(side: str) -> DataFrame:
            ids = kept(firsts.join(pairs.select(F.col(side).alias("key")).distinct(), "key", "left_semi").select("id"))
            count = ids.count()
            if count > FILTER_IDS:
                return segments_of(docs.join(ids, "id", "left_semi"), order, n, None)
            return segments_of(docs, order, n, spark.sparkContext.broadcast(bit_filter(ids.select(F.xxhash64("id").alias("hash")), count)))

        found = overlaps(pairs, segments("a"), segments("b"))
        return kept(found.where(F.col("overlap") * 100 >= (F.col("size_a") + F.col("size_b") - F.col("overlap")) * percent).select("a", "b"))

    star = buckets.where((F.col("hub.key") != F.col("key")) & may_link(F.col("hub.size"), F.col("hub.at"), F.col("size"), F.col("at")))
    star = star.select(*ordered("hub.key", "hub.size", "key", "size"), F.col("hub.key").alias("hub"))
    star = kept(star.groupBy("a", "b", "size_a", "size_b").agg(F.min("hub").alias("hub")))
    # Hubs stand on one side and what is compared with them on the other, so either side's segments are moved once.
    turned = F.col("hub") == F.col("b")
    pick = lambda x, y: F.when(turned, F.col(x)).otherwise(F.col(y))
    links = compare(star.select(pick("b", "a").alias("a"), pick("a", "b").alias("b"), pick("size_b", "size_a").alias("size_a"), pick("size_a", "size_b").alias("size_b")))
    labelled = buckets.drop("hub").join(components(links), "key", "left").withColumn("component", F.coalesce("component", "key"))
    by = labelled.groupBy("gram", "component").agg(F.count("*").alias("n")).groupBy("gram").agg(F.max(F.struct("n", "component")).alias("most"), F.count("*").alias("parts"), F.sum("n").alias("held"))
    several = kept(labelled.join(by.where("parts > 1"), "gram").withColumn("aside", F.col("component") != F.col("most.component")).drop("most", "parts"))
    aside = several.where("aside")
    # In a bucket of many they meet by size band: a row its own band, the others also those beside theirs.
    banded, of_size = F.col("held") > SALTED, band(F.col("size"), percent)
    cell = lambda at: F.xxhash64("gram", at)
    aside = aside.withColumn("cell", cell(F.when(banded, of_size))).drop("held", "aside")
    near = several.withColumn("cell", F.explode(F.when(banded, F.transform(F.array(*[F.lit(d) for d in (-1, 0, 1)]), lambda d: cell(of_size + d))).otherwise(F.array(cell(F.lit(None).cast("int")))))).drop("held", "aside")
    many = heavy(aside, "cell", several.count(), SALTED)  # a cell's rows outside the largest component are dealt
    x, y = salted(aside, "cell", many, F.xxhash64("key"), "salt").alias("x"), salted(near, "cell", many, None, "salt").alias("y")
    across = x.join(y, (F.col("x.cell") == F.col("y.cell")) & (F.col("x.salt") == F.col("y.salt")) & (F.col("x.gram") == F.col("y.gram")) & (F.col("x.component") != F.col("y.component")) & may_link(F.col("x.size"), F.col("x.at"), F.col("y.size"), F.col("y.at")))
    across = across.select(*ordered("x.key", "x.size", "y.key", "y.size"))
    rest = kept(across.dropDuplicates(["a", "b"]).join(star.select("a", "b"), ["a", "b"], "left_anti"))
    return members, links.union(compare(rest))


def join(df: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row its id, ``n_shingles`` (size of its set), ``component_id`` (least id reachable by links).

    Two rows link when 100 * |intersection| >= percent * |union| of their sets of n-grams; rows of equal sets are one
    class. A text without words, or null, has an empty set and links with nothing: its component is its own id.
    Repeated rows get equal results. Null ids are kept; they are no least id unless all ids of a component are null.
    Other columns aren't read; an empty table gives an empty result. N-grams are told apart by 64-bit hashes.
    """
    members, links = linked(df, n, percent, id_col, text_col)
    of = components(links)
    classes = members.where("size > 0").groupBy("key").agg(F.min("id").alias("least"), F.count("*").alias("copies")).join(of, "key", "left").withColumn("component", F.coalesce("component", "key"))
    classes = kept(classes)
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    # What holds a thousandth of all classes, or of all rows, or more is at most a thousand: looked up, not shuffled.
    large = F.broadcast(least.where(F.col("n") * LARGE_CLASSES >= classes.count()).select("component", F.col("component_id").alias("of_large")))
    placed = classes.join(large, "component", "left")
    small = placed.where("of_large IS NULL").join(least.drop("n"), "component").select("key", "component_id", "copies")
    found = kept(small.unionByName(placed.where("of_large IS NOT NULL").select("key", F.col("of_large").alias("component_id"), "copies")))
    many = F.broadcast(found.where(F.col("copies") * LARGE_CLASSES >= members.count()).select("key", F.col("component_id").alias("of_many")))
    marked = members.where("size > 0").join(many.withColumn("large", F.lit(True)), "key", "left")
    few = marked.where("large IS NULL").drop("large", "of_many").join(found.drop("copies"), "key", "left")
    out = few.unionByName(marked.where("large").withColumnRenamed("of_many", "component_id").drop("large"))
    out = out.unionByName(members.where("size = 0").withColumn("component_id", F.col("id")))
    return out.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), "component_id")
