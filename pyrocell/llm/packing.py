"""Packing documents into training sequences of a fixed number of tokens.

A document's ids are cut at multiples of the capacity; what remains is one piece. The pieces' lengths, in bins of
capacity/512 tokens rounded up, are a cutting-stock problem of at most 512 sizes, whatever the corpus: only its
histogram reaches the driver. Patterns claim ranges of ranks within a bin; a piece finds its sequence by its own rank.
Ranks come from counts by (bin, salt), so no bin is ever one task's work.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pyrocell.llm import bpe, cutting_stock
from pyrocell.llm import pieces as P
from pyrocell.llm.common import kept

BINS = 512
#: Pieces of words that a worker remembers at a time, about.
PIECES = 1 << 19
#: Rows of a bin that share a window, about.
ROWS_BY_SALT = 128


@functools.lru_cache(maxsize=2)
def codes(path: str) -> bpe.PieceCodes:
    """Ids of a byte-level vocabulary; single pieces are merged by the tokenizer library that takes ranks."""
    vocab = bpe.Vocabulary(path)
    if not vocab.byte_level:
        return bpe.piece_codes(path)
    to_byte = {c: b for b, c in enumerate(vocab.by_byte)}
    ranks = {bytes(to_byte[c] for c in t): i for t, i in vocab.id.items()}
    vocab.id = {}  # the library holds them from here on
    merge = tiktoken.Encoding("pieces", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    out = bpe.PieceCodes(vocab, lambda piece: merge.encode_ordinary(piece.decode("utf-8", "surrogateescape")))
    out.table.most = PIECES
    return out


def cut(df: DataFrame, path: str, capacity: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of each row's ids plus ``end_id``: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens`` (and ``ids``)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        of = codes(path)
        for batch in batches:
            for a, _, texts in P.text_blocks(batch.column(1)):
                rows, columns, ids = [], [[], [], [], []], []
                for i, x in enumerate(of.ids_of(texts), a):
                    x = np.append(x, end_id).astype("<u4")
                    for s in range(0, len(x), capacity):
                        part = x[s : s + capacity]
                        rows.append(i)
                        for c, v in zip(columns, (s, len(part), zlib.crc32(part.tobytes()), len(x)), strict=True):
                            c.append(v)
                        if with_ids:
                            ids.append(part.astype(np.int32))
                arrays = [batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, pa.int64()) for c in columns)]
                names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    arrays, names = [*arrays, pa.array(ids, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.record_batch(arrays, names=names)

    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    out = f"id {rows.schema['id'].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    return rows.mapInArrow(run, out).withColumnRenamed("id", id_col)


def pack(pieces: DataFrame, capacity: int = 2048, order: tuple[str, ...] = ("doc_id", "start")) -> DataFrame:
    """The rows with ``sequence_id`` (0, 1, ...) and ``offset``, gapless from 0; lengths must be 1..capacity.

    ``pieces`` should be written already (it is read more than once). Which of several pieces of one bin goes where follows
    ``order``; equal rows may stand for each other. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    unit = -(-capacity // BINS)
    room = capacity // unit
    binned = pieces.withColumn("__bin", F.ceil(F.col("length") / unit).cast("int"))
    if capacity % unit:  # the last bin then holds what is longer than room * unit
        binned = binned.withColumn("__bin", F.least(F.col("__bin"), F.lit(room)))
    demand = np.zeros(room + 1, np.int64)
    for r in binned.groupBy("__bin").agg(F.count("*").alias("n")).collect():
        demand[r["__bin"]] = r["n"]
    salts = F.element_at(F.lit([max(1, -(-int(n) // ROWS_BY_SALT)) for n in demand]), F.col("__bin") + 1)
    salted = binned.withColumn("__salt", F.pmod(F.xxhash64(*order), salts).cast("int"))
    counts = salted.groupBy("__bin", "__salt").agg(F.count("*").alias("n"))
    ranges, used, sequence = [], np.zeros(room + 1, np.int64), 0
    for pattern, times in cutting_stock.plan(demand, room):
        for size, n in pattern.items():
            ranges.append((int(size), int(used[size]), int(used[size]) + n * times, n, sequence))
            used[size] += n * times
        sequence += times
    table = spark.createDataFrame(ranges, "__bin int, __from long, __to long, __each int, __first long")
    before = counts.select("__bin", "__salt", F.coalesce(F.sum("n").over(Window.partitionBy("__bin").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    ranked = salted.withColumn("__rank", F.row_number().over(Window.partitionBy("__bin", "__salt").orderBy(*order)))
    ranked = ranked.join(before, ["__bin", "__salt"]).withColumn("__rank", F.col("__rank") - 1 + F.col("__before"))
    # The ranges are bounded by the bins (at most some thousands of rows), not by the corpus.
    t, r = F.broadcast(table).alias("t"), ranked.alias("r")
    placed = r.join(t, (F.col("r.__bin") == F.col("t.__bin")) & (F.col("r.__rank") >= F.col("t.__from")) & (F.col("r.__rank") < F.col("t.__to")))
    placed = placed.select(*[F.col(f"r.{c}") for c in pieces.columns], (F.col("__first") + F.floor((F.col("__rank") - F.col("__from")) / F.col("__each"))).cast("long").alias("sequence_id"))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), *order).rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)))


def pack_documents(df: DataFrame, path: str, capacity: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents packed; for each piece its id, start, length, checksum, document's tokens, sequence and offset.

    A null text counts as empty (one piece: the end id). Repeated rows are packed one by one; null ids are kept;
    other columns aren't read, and an empty table gives an empty result.
    """
    return pack(kept(cut(df, path, capacity, end_id, id_col, text_col)), capacity, (id_col, "start"))
