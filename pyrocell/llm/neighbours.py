"""Nearest neighbours by additive quantisation with measured errors, and exact reranking.

A vector is written as a sum of one codeword from each of several full-dimensional codebooks, found by beam search, and
what is left over as a byte for each component; the norm of the sum is stored, and how far the vector is from the sum
and from both together. A query's products with all codewords are one look-up table, so its distance to a coded vector
is a few table entries and that norm; by the stored errors it lies between two bounds. What can be among a block's
nearest by these bounds is bounded again with the bytes. Only codes meet the queries, block by block; what no bound
rules out is fetched, by one join, and measured exactly. So no near vector is missed, however badly the codebooks fit
the rows: then more is fetched.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors that the codebooks are fitted on, at most (those with the smallest hashes of their ids).
FIT_ROWS = 16384


@dataclass
class Codebooks:
    """``words[m, k]`` is codeword k of codebook m, for vectors less ``centre`` and divided by ``unit``."""

    words: np.ndarray
    centre: np.ndarray
    unit: float

    def placed(self, v: np.ndarray) -> np.ndarray:
        with np.errstate(all="ignore"):
            return (v.astype(np.float64) - self.centre) / self.unit

    def sums(self, codes: np.ndarray) -> np.ndarray:
        """The sums of codewords, always added in one order, so everyone has the same."""
        out = np.zeros((len(codes), self.words.shape[2]), np.float32)
        for m in range(self.words.shape[0]):
            out += self.words[m][codes[:, m]]
        return out

    def written(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, ...]:
        """Codes, what is left over as bytes and their step, squared norms of the sums, and how far ``x`` (placed) is from
        the sums and from sums and bytes, never too little; infinite where ``x`` is out of range."""
        fine = np.isfinite(x).all(axis=1) & (np.abs(np.nan_to_num(x)) < 1e15).all(axis=1)
        x = np.where(fine[:, None], x, 0.0)
        codes, _ = self.encode(x, beam)
        sums = self.sums(codes)
        rest = x - sums
        step = np.maximum(np.abs(rest).max(axis=1) / 127, 1e-30).astype(np.float32)
        left = np.clip(np.rint(rest / step[:, None]), -127, 127).astype(np.int8)
        far = lambda r: np.where(fine, np.sqrt((r * r).sum(axis=1)) * 1.000001, np.inf).astype(np.float32)
        return codes, left, step, (sums * sums).sum(axis=1), far(rest), far(x - closer(sums, left, step))

    def encode(self, x: np.ndarray, beam: int = 2) -> tuple[np.ndarray, np.ndarray]:
        """Codes (n, m) and squared norms of the sums, the best of ``beam`` partial sums kept at every codebook."""
        n, (books, size, _) = len(x), self.words.shape
        if not n:
            return np.zeros((0, books), np.uint8), np.zeros(0, np.float32)
        rest, codes, each = x[:, None, :].astype(np.float32), np.zeros((n, 1, 0), np.uint8), np.arange(n)
        for m in range(books):
            w = self.words[m]
            error = (rest.reshape(-1, w.shape[1]) @ (-2 * w.T)).reshape(n, -1, size)  # one product of two matrices
            error += (w * w).sum(axis=1)
            if rest.shape[1] > 1:
                error += np.einsum("nbd,nbd->nb", rest, rest)[:, :, None]
            flat = error.reshape(n, -1)
            keep = min(beam if m < books - 1 else 1, flat.shape[1])
            best = np.empty((n, keep), np.int64)
            for j in range(keep):  # the few least, one by one
                best[:, j] = flat.argmin(axis=1)
                flat[each, best[:, j]] = np.inf
            source, word = best // size, best % size
            rest = np.take_along_axis(rest, source[:, :, None], 1) - w[word]
            codes = np.concatenate([np.take_along_axis(codes, source[:, :, None], 1), word[:, :, None].astype(np.uint8)], axis=2)
        total = x.astype(np.float32) - rest[:, 0]
        return codes[:, 0], (total * total).sum(axis=1)

    def products(self, queries: np.ndarray) -> np.ndarray:
        """The look-up table (queries, m, k)."""
        return np.einsum("qd,mkd->qmk", queries.astype(np.float32), self.words, optimize=True)


def closer(sums: np.ndarray, left: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The sums with what the bytes say."""
    return sums + left * step[:, None]


def fit(x: np.ndarray, books: int = 32, size: int = 256, steps: int = 5, seed: int = 11) -> Codebooks:
    """k-means of what the codebooks before leave over, codebook by codebook."""
    bounds = np.abs(x).max(axis=0) < 1e150
    centre = np.where(bounds, np.where(bounds, x, 0.0).mean(axis=0), 0.0)
    with np.errstate(all="ignore"):
        length = np.sqrt(((x - centre) ** 2).sum(axis=1))
    unit = float(np.median(length[np.isfinite(length)])) if np.isfinite(length).any() else 1.0
    unit = unit if unit > 0 else float(length[np.isfinite(length)].max(initial=0.0)) or 1.0
    x = (x - centre) / unit
    x = x[(np.abs(x) < 1e15).all(axis=1)]
    x = x if len(x) else np.zeros((1, len(centre)))
    rng, rest, words = np.random.default_rng(seed), x.astype(np.float32), []
    size = min(size, max(1, len(x)))
    nearest = lambda w: ((w * w).sum(axis=1) - 2 * rest @ w.T).argmin(axis=1)
    for _ in range(books):
        w = rest[rng.permutation(len(rest))[:size]].copy()
        for _ in range(steps):
            near = nearest(w)
            order = np.argsort(near, kind="stable")
            used, first = np.unique(near[order], return_index=True)
            w[used] = np.add.reduceat(rest[order], first, axis=0) / np.diff(np.append(first, len(rest)))[:, None]
        rest = rest - w[nearest(w)]
        words.append(w)
    return Codebooks(np.stack(words).astype(np.float32), centre, unit)


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the vectors that take part: finite components, not all zero."""
    ok = F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("v", lambda c: c != 0)
    kind = df.schema[vector_col].dataType.simpleString()
    vector = df[vector_col] if kind == "array<float>" else df[vector_col].cast("array<double>")
    return df.select(df[id_col].cast("long").alias("id"), vector.alias("v")).where(F.col("id").isNotNull() & ok)


#: Queries that meet a block of candidates at once: as many as fit in so many bytes.
QUERY_BYTES = 16 << 20


def search(df: DataFrame, every: int = 100, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", books: int = 32, beam: int = 2, block: int = 1 << 16) -> DataFrame:
    """The ``k`` nearest of each vector whose id is divisible by ``every``, its own id left out.

    Columns query_id, rank (from 1), vec_id, score: Euclidean distance of the original vectors in double precision,
    nearest first, ties to the smaller id. Vectors that are null, zero or hold null or non-finite components take no
    part, nor do null ids; of vectors of unequal length only those of the commonest take part (ties: the longest).
    A query id that is there twice is asked once, with the least vector; repeated candidates count row by row.
    An empty table gives an empty result. The codebooks are fitted on at most FIT_ROWS vectors; every row is coded
    and scored by the table, and what its bounds don't rule out exactly. Of equal vectors, which no bound can tell apart,
    a block gives each query the ``k`` smallest ids.

    Codes are shuffled once for each QUERY_BYTES of queries (a byte a codebook and a component for each row), full vectors
    once. Work on codes grows with queries times candidates, in blocks of bounded size.
    """
    spark = df.sparkSession
    rows = usable(df, id_col, vector_col)
    sizes = {r["d"]: r["n"] for r in rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = max(sizes, key=lambda d: (sizes[d], d))
    rows = rows.where(F.size("v") == dim)
    n = sizes[dim]
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS).select("v").toPandas()
    books_at = spark.sparkContext.broadcast(fit(np.stack(sample["v"].to_numpy()).astype(np.float64), books))

    def code(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        of = books_at.value
        for pdf in batches:
            for a in range(0, len(pdf), 1024):
                part = pdf.iloc[a : a + 1024]
                codes, left, step, norms, rough, near = of.written(of.placed(np.stack(part["v"].to_numpy())), beam)
                yield pd.DataFrame({"id": part["id"].to_numpy(), "same": part["same"].to_numpy(), "codes": [c.tobytes() + r.tobytes() for c, r in zip(codes, left, strict=True)], "step": step, "norm": norms, "rough": rough, "near": near})

    coded = rows.withColumn("same", F.xxhash64("v")).mapInPandas(code, "id long, same long, codes binary, step float, norm float, rough float, near float")
    queries = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    spread = min(spark.sparkContext.defaultParallelism, -(-n // 4096))  # small tables use all cores too
    parts, groups = max(1, spread, -(-n // block)), max(1, -(-n // every * dim * 8 // QUERY_BYTES))
    left = coded.withColumn("part", F.pmod(F.xxhash64("id", "codes"), F.lit(parts)).cast("int")).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = queries.withColumn("group", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def best(candidates: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "low": np.zeros(0), "high": np.zeros(0)})
        if not len(candidates) or not len(asked):
            return none
        candidates = candidates.sort_values("id")
        ids, same, found, of = candidates["id"].to_numpy(), candidates["same"].to_numpy(), [none], books_at.value
        written = np.frombuffer(b"".join(candidates["codes"]), np.uint8).reshape(len(ids), -1)
        codes, left = written[:, : len(of.words)], written[:, len(of.words) :].view(np.int8)
        norms, rough, near = (candidates[c].to_numpy(np.float32) for c in ("norm", "rough", "near"))
        sums = closer(of.sums(codes), left, candidates["step"].to_numpy(np.float32))
        longest, codes = np.sqrt(norms), np.ascontiguousarray(codes.T)
        q_ids, q = asked["id"].to_numpy(), of.placed(np.stack(asked["v"].to_numpy()))
        short = np.where(np.isfinite(q), np.clip(q, -1e15, 1e15), 0.0).astype(np.float32)
        off = np.sqrt(((q - short) ** 2).sum(axis=1))
        for a in range(0, len(q), 64):
            table = -2 * of.products(short[a : a + 64])
            for i, t in enumerate(table, a):
                others = ids != q_ids[i]
                few = min(k, int(others.sum()))
                if not few:
                    continue
                size = float(np.sqrt((short[i].astype(float) ** 2).sum()))
                square = norms + np.float32(size * size)
                for m, c in enumerate(codes):
                    square += t[m][c]
                slack = np.float32(1e-5) * (longest + np.float32(size)) ** 2  # what single precision may have lost
                low = np.sqrt(np.maximum(square - slack, 0)) - rough
                high = np.sqrt(np.maximum(square + slack, 0)) + rough
                high[~others] = np.inf
                s = np.flatnonzero(others & ~(low - off[i] > np.partition(high, few - 1)[few - 1] + off[i]))
                away = sums[s] - short[i]
                d = np.sqrt(np.einsum("nd,nd->n", away, away).astype(np.float64))
                wide = near[s] + off[i] + 1e-5 * d
                low, high = d - wide, d + wide
                low, high = np.where(np.isfinite(low), low, -np.inf), np.where(np.isfinite(high), high, np.inf)
                kept = ~(low > np.partition(high, few - 1)[few - 1])
                s, low, high = s[kept], low[kept], high[kept]
                if len(s) > few:  # of equal vectors the smallest ids
                    order = np.lexsort((ids[s], same[s]))
                    first = np.flatnonzero(np.append(True, np.diff(same[s][order]) != 0))
                    place = np.arange(len(s)) - np.repeat(first, np.diff(np.append(first, len(s))))
                    few_same = order[place < k]
                    s, low, high = s[few_same], low[few_same], high[few_same]
                found.append(pd.DataFrame({"query_id": np.full(len(s), q_ids[i]), "vec_id": ids[s], "low": low, "high": high}))
        return pd.concat(found, ignore_index=True)

    near = left.groupBy("part", "group").cogroup(right.groupBy("part", "group")).applyInPandas(best, "query_id long, vec_id long, low double, high double")
    # A query's nearest are no farther than its k-th least upper bound of all blocks.
    of_query = Window.partitionBy("query_id")
    placed = near.withColumn("place", F.row_number().over(of_query.orderBy("high")))
    short = placed.withColumn("edge", F.max(F.when(F.col("place") == k, F.col("high"))).over(of_query)).where(F.col("edge").isNull() | (F.col("low") <= F.col("edge")))
    # An id that is there more than once came with each of its rows, and fetches them all: once is enough.
    pairs = short.select("query_id", "vec_id").distinct()
    fetched = pairs.join(rows.select(F.col("id").alias("vec_id"), F.col("v").alias("there")), "vec_id").join(queries.select(F.col("id").alias("query_id"), "v"), "query_id")
    square = F.aggregate(F.zip_with("there", "v", lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double"))), F.lit(0.0), lambda x, y: x + y)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    scored = fetched.select("query_id", "vec_id", F.sqrt(square).alias("score"))
    return scored.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
