"""Small helpers that the operators share."""

from __future__ import annotations

import re
import tempfile

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus, read by Spark alone, so that any store will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> None:
    """Lineage is cut in the folder that the cluster names; one of our own is only made on a single machine."""
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() is not None:
        return
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))


def shared_path(spark: SparkSession) -> str:
    """The shared folder's path."""
    shared_folder(spark)
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


#: A key with more than this share of the rows is salted: there are at most so many such keys.
HEAVY = 1000


def heavy(rows: DataFrame, key: str, total: int, least: int) -> DataFrame:
    """(key, salts) of the keys with more than ``least`` rows and a thousandth of ``total``; few enough to be broadcast."""
    most = max(least, total // HEAVY)
    counts = rows.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") > most)
    return F.broadcast(counts.select(key, F.ceil(F.col("__n") / most).cast("int").alias("__salts")))


def salted(rows: DataFrame, key: str, salts: DataFrame, by: Column | None, name: str) -> DataFrame:
    """``rows`` with a salt ``name``: dealt by ``by``, or, where that is None, once for each of the key's salts."""
    n = F.coalesce("__salts", F.lit(1))
    salt = F.explode(F.sequence(F.lit(0), n - 1)) if by is None else F.pmod(by, n).cast("int")
    return rows.join(salts, key, "left").withColumn(name, salt).drop("__salts")


def kept(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder and read back: computed once, safe when executors go."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


#: Bits of a filter: sixteen for each hash, within these bounds; and bits that one group packs.
FILTER_BITS, SLICE_BITS = (16, 27), 16


def bit_filter(hashes: DataFrame, count: int | None = None) -> np.ndarray:
    """A bit for each hash of the column ``hash``; one in sixteen others passes too. Of bounded size whatever the input:
    with more than eight million hashes it lets more pass. Bits are packed by slice before they reach the driver."""
    n = hashes.count() if count is None else count
    width = min(FILTER_BITS[1], max(FILTER_BITS[0], (16 * n).bit_length()))
    at = hashes.select(F.pmod("hash", F.lit(1 << width)).alias("at")).distinct()

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << SLICE_BITS, np.uint8)
        bits[pdf["at"].to_numpy() & ((1 << SLICE_BITS) - 1)] = 1
        return pd.DataFrame({"slice": pdf["slice"].iloc[:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    slices = at.withColumn("slice", F.shiftright("at", SLICE_BITS)).groupBy("slice").applyInPandas(packed, "slice long, bits binary")
    out = np.zeros(1 << width - 3, np.uint8)
    for r in slices.collect():
        first = r["slice"] << SLICE_BITS - 3
        out[first : first + (1 << SLICE_BITS - 3)] = np.frombuffer(r["bits"], np.uint8)
    return out
