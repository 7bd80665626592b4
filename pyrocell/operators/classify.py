"""Per-pixel classification: statistics, training with MLlib, inference with stored weights (``networks`` trains those)."""

from __future__ import annotations

import json
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyrocell.operators.spatial import filtered, merged_pieces

INPUTS = ["red", "nir", "swir1", "swir2"]
LAYERS = [4, 7, 14, 7, 14, 7, 2]


def band_statistics(samples: DataFrame, bands: list[str] = INPUTS) -> tuple[list[float], list[float]]:
    """Means and population standard deviations."""
    row = samples.agg(*[F.avg(b) for b in bands], *[F.stddev_pop(b) for b in bands]).first()
    return list(row[: len(bands)]), list(row[len(bands) :])


def standardised(df: DataFrame, mean: list[float], std: list[float], bands: list[str] = INPUTS) -> DataFrame:
    return df.withColumns({b: F.try_divide(F.col(b) - m, F.lit(s)) for b, m, s in zip(bands, mean, std, strict=True)})


def _hashed(seed: int, *key: str) -> Column:
    """A hash, as text, that other engines have too."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))


def in_training(*key: str, share: int = 70, seed: int = 0) -> Column:
    """A fixed share of the rows, by a hash of their key: the same rows whatever the partitioning."""
    return _hashed(seed, *key) < f"{int(share / 100 * (1 << 32)):08x}"


def batch_sample(df: DataFrame, rows: int, seed: int, *key: str) -> DataFrame:
    """``rows`` rows without replacement: those with the smallest hashes."""
    return df.orderBy(_hashed(seed, *key), *key).limit(rows)


def train(samples: DataFrame, layers: list[int] = LAYERS, steps: int = 100, seed: int = 1) -> MultilayerPerceptronClassificationModel:
    """A perceptron on standardised samples. Its hidden units are sigmoid and its optimiser is L-BFGS, which differs
    from networks trained elsewhere; those are applied with ``infer``."""
    rows = VectorAssembler(inputCols=INPUTS, outputCol="features").transform(samples).select("features", F.col("label").cast("double").alias("label"))
    return MultilayerPerceptronClassifier(layers=layers, maxIter=steps, seed=seed, blockSize=128).fit(rows)


def train_by_region(samples: DataFrame, regions: list[str], **options) -> dict[str, MultilayerPerceptronClassificationModel]:
    """One model for each region; the list of regions is the model catalog's."""
    return {r: train(samples.where(F.col("region") == r), **options) for r in regions}


def predicted(model: MultilayerPerceptronClassificationModel, df: DataFrame) -> DataFrame:
    rows = VectorAssembler(inputCols=INPUTS, outputCol="features").transform(df)
    return model.transform(rows).drop("features", "rawPrediction", "probability").withColumn("prediction", F.col("prediction").cast("int"))


def accuracy(df: DataFrame, prediction: str = "prediction", label: str = "label", by: list[str] = []) -> DataFrame:
    return df.groupBy(*by).agg(F.avg((F.col(prediction) == F.col(label)).cast("double")).alias("accuracy"), F.count("*").alias("n"))


def weights_from_json(text: str) -> dict:
    """``data_mean``, ``data_std`` and ``layers`` of w and b."""
    spec = json.loads(text)
    return {"mean": np.array(spec["data_mean"]), "std": np.array(spec["data_std"]), "layers": [(np.array(x["w"]), np.array(x["b"])) for x in spec["layers"]]}


def infer(df: DataFrame, weights: dict, bands: list[str] = INPUTS) -> DataFrame:
    """Rows with ``prediction``: affine layers with ReLU between and the greatest output's class; void where a band is.

    The weights are a few kilobytes and go with the function; rows stream in Arrow batches.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for pdf in batches:
            x = pdf[bands].to_numpy(float)
            there = np.isfinite(x).all(axis=1)
            h = (x - weights["mean"]) / weights["std"]
            for k, (w, b) in enumerate(weights["layers"]):
                h = h @ w + b
                if k < len(weights["layers"]) - 1:
                    h = np.maximum(h, 0)
            yield pdf.assign(prediction=pd.array(np.where(there, np.nan_to_num(h).argmax(axis=1), -1), dtype="Int32").astype(object))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInPandas(run, f"{kinds}, prediction int").withColumn("prediction", F.nullif("prediction", F.lit(-1)))


def classification_job(composite: DataFrame, weights: dict, pending: DataFrame, opening: int = 2, closing: int = 4) -> DataFrame:
    """Burned cells (region, year, x, y) of the pending units (region, year): inference, spatial filter by scene,
    scenes merged, one distributed job for all units."""
    todo = composite.join(pending.select("region", "year"), ["region", "year"], "left_semi")
    burned = infer(todo, weights).where("prediction = 1")
    keys = ["region", "year", "scene_id"]
    clean = filtered(burned, opening, closing, keys).withColumn("value", F.lit(1))
    return merged_pieces(clean, ["region", "year", "x", "y"], ["scene_id"])
