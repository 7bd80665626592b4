"""Training of small per-region networks: ReLU layers, softmax cross-entropy, Adam, mini-batches.

All regions learn in the same jobs. A batch is too small to be worth spreading, so a region's next steps are one task:
its rows for these steps, ``every`` batches and no more whatever the size of its samples, meet there with its weights. A
job takes every region ``every`` steps further; at the end one job measures the weights of all these steps on the
hold-out. Weights, some kilobytes a region and job, are on the driver between jobs, and a task that is lost is run again to the same result: rows come in
an order of their own and batches are dealt by hashes.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyrocell.sources.shared import Rounds

RATE, DECAY_1, DECAY_2, TINY = 0.001, 0.9, 0.999, 1e-8


def initial(layers: list[int], seed: int, region: str) -> list[np.ndarray]:
    """Weights and biases layer by layer: normal with deviation 1 / sqrt(inputs), and zero."""
    rng = np.random.default_rng([seed, *hashlib.sha256(region.encode()).digest()[:8]])
    out = []
    for a, b in zip(layers, layers[1:], strict=False):
        out += [rng.normal(0, a**-0.5, (a, b)), np.zeros(b)]
    return out


def forward(weights: list[np.ndarray], x: np.ndarray) -> list[np.ndarray]:
    """The input of each layer, and last the outputs."""
    out = [x]
    for k in range(0, len(weights), 2):
        h = out[-1] @ weights[k] + weights[k + 1]
        out.append(np.maximum(h, 0) if k < len(weights) - 2 else h)
    return out


def log_shares(outputs: np.ndarray) -> np.ndarray:
    """Logarithms of the softmax."""
    top = outputs - outputs.max(axis=1, keepdims=True)
    return top - np.log(np.exp(top).sum(axis=1, keepdims=True))


def gradients(weights: list[np.ndarray], x: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross-entropy, by backpropagation."""
    values = forward(weights, x)
    back = np.exp(log_shares(values[-1]))
    back[np.arange(len(x)), label] -= 1
    back /= len(x)
    out: list[np.ndarray] = []
    for k in range(len(weights) - 2, -1, -2):
        out[:0] = [values[k // 2].T @ back, back.sum(axis=0)]
        if k:
            back = (back @ weights[k].T) * (values[k // 2] > 0)
    return out


class Adam:
    """Weights with their running means of gradients and of squared gradients."""

    def __init__(self, weights: list[np.ndarray], rate: float = RATE):
        self.weights, self.rate, self.step = weights, rate, 0
        self.first, self.second = ([np.zeros_like(w) for w in weights] for _ in range(2))

    def move(self, x: np.ndarray, label: np.ndarray) -> None:
        """One step down; a batch without rows counts as a step that changes nothing."""
        self.step += 1
        if not len(x):
            return
        size = self.rate * (1 - DECAY_2**self.step) ** 0.5 / (1 - DECAY_1**self.step)
        for w, m, v, g in zip(self.weights, self.first, self.second, gradients(self.weights, x, label), strict=True):
            m *= DECAY_1
            m += (1 - DECAY_1) * g
            v *= DECAY_2
            v += (1 - DECAY_2) * g * g
            w -= size * m / (np.sqrt(v) + TINY)

    def flat(self) -> list[float]:
        return np.concatenate([a.ravel() for part in (self.weights, self.first, self.second) for a in part]).tolist()

    def load(self, values: list[float], step: int) -> None:
        at, flat = 0, np.array(values)
        for part in (self.weights, self.first, self.second):
            for a in part:
                a[...] = flat[at : at + a.size].reshape(a.shape)
                at += a.size
        self.step = step


def slot(key: list[str], epoch: Column, batches: Column, seed: int) -> Column:
    """Which batch of an epoch a row belongs to, by a hash that other engines have too."""
    text = F.concat_ws("-", F.lit(str(seed)), epoch.cast("string"), *[F.col(k).cast("string") for k in key])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long") % batches


def train(samples: DataFrame, key: list[str], bands: list[str], layers: list[int], steps: int = 7000, batch: int = 1000, every: int = 100, seed: int = 1, rate: float = RATE) -> tuple[dict[str, str], DataFrame]:
    """Networks of all regions, as JSON that ``classify.weights_from_json`` reads, and the report.

    ``samples`` has ``region``, the ``key`` columns (a row's name), ``bands``, ``label`` (0, 1, ...) and ``training``
    (False: held out); it is read once for the moments, once for the hold-out, and once for each stretch of steps whose
    batches together are about as many rows as it has: these are dealt in one pass, to a table. It should be a table too. Rows with a void or non-finite
    band or label are left out. Bands are standardised by their region's training rows. An epoch deals a region's rows
    to batches of about ``batch`` rows; a region without training rows gets no network. The report has (region, step,
    accuracy, loss, n) of the hold-out after every ``every`` steps, and after the last.
    """
    spark = samples.sparkSession
    there = samples
    for c in (*bands, "label"):
        there = there.where(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c).cast("double")) < float("inf")))
    learn, test = there.where("training"), there.where("NOT training")
    moments = learn.groupBy("region").agg(F.count("*").alias("n"), *[f(b).alias(f"{n}_{b}") for n, f in (("mean", F.avg), ("std", F.stddev_pop)) for b in bands]).collect()
    scale = {r["region"]: (np.array([r[f"mean_{b}"] for b in bands]), np.array([r[f"std_{b}"] or 1.0 for b in bands])) for r in moments}
    dealt = spark.createDataFrame([(r["region"], max(1, round(r["n"] / batch))) for r in moments], "region string, batches long")
    states = {r: (Adam(initial(layers, seed, r), rate).flat(), 0) for r in scale}
    ahead = every * max(1, sum(r["n"] for r in moments) // max(1, batch * len(moments) * every))
    tables, after = Rounds(spark), []
    for begin in range(0, steps, every):
        end = min(begin + every, steps)
        if begin % ahead == 0:
            batches = tables.put(_batches(learn, dealt, key, bands, seed, begin, min(begin + ahead, steps)))
        now = spark.sparkContext.broadcast(states)
        rows = batches.where((F.col("step") >= begin) & (F.col("step") < end))
        moved = rows.groupBy("region").applyInPandas(_further(now, scale, key, bands, layers, rate, begin, end), "region string, state array<double>")
        states = states | {r["region"]: (list(r["state"]), end) for r in moved.collect()}
        states = {r: (state, end) for r, (state, _) in states.items()}
        after.append(states)
    report = [(r["region"], r["step"], r["accuracy"], r["loss"], r["n"]) for r in measured(test, after, scale, bands, layers).collect()]
    report.sort(key=lambda r: (r[1], r[0]))
    networks = {r: as_json(of_state(state, layers), *scale[r]) for r, (state, _) in states.items()}
    return networks, spark.createDataFrame(report, "region string, step int, accuracy double, loss double, n long")


def _batches(learn: DataFrame, dealt: DataFrame, key: list[str], bands: list[str], seed: int, begin: int, end: int) -> DataFrame:
    """The rows of all batches from step ``begin`` to ``end``, with their ``step``."""
    epochs = F.sequence(F.floor(F.lit(begin) / F.col("batches")), F.floor(F.lit(end - 1) / F.col("batches")))
    rows = learn.join(F.broadcast(dealt), "region").withColumn("epoch", F.explode(epochs))
    rows = rows.withColumn("step", F.col("epoch") * F.col("batches") + slot(key, F.col("epoch"), F.col("batches"), seed))
    return rows.where((F.col("step") >= begin) & (F.col("step") < end)).select("region", "step", *key, *bands, "label")


def _further(now, scale: dict, key: list[str], bands: list[str], layers: list[int], rate: float, begin: int, end: int):
    """Takes a region's broadcast state over its batches of the steps from ``begin`` to ``end``."""

    def further(pdf: pd.DataFrame) -> pd.DataFrame:
        region = pdf["region"].iloc[0]
        net = Adam(initial(layers, 0, region), rate)
        net.load(*now.value[region])
        pdf = pdf.sort_values(["step", *key])
        mean, std = scale[region]
        x, label, at = (pdf[bands].to_numpy(float) - mean) / std, pdf["label"].to_numpy(int), np.searchsorted(pdf["step"].to_numpy(), np.arange(begin, end + 1))
        for a, b in zip(at, at[1:], strict=False):
            net.move(x[a:b], label[a:b])
        return pd.DataFrame({"region": [region], "state": [net.flat()]})

    return further


def of_state(state: list[float], layers: list[int]) -> list[np.ndarray]:
    net = Adam(initial(layers, 0, ""))
    net.load(state, 0)
    return net.weights


def measured(test: DataFrame, after: list[dict[str, tuple[list[float], int]]], scale: dict, bands: list[str], layers: list[int]) -> DataFrame:
    """(region, step, accuracy, loss, n) of the rows by the states after some steps, all in one pass; each Arrow batch gives
    one row a region and step, and these are summed."""
    now = test.sparkSession.sparkContext.broadcast(after)

    def sums(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        nets = [{r: (step, of_state(state, layers)) for r, (state, step) in states.items()} for states in now.value]
        for pdf in batches:
            for region, part in pdf[pdf["region"].isin(list(scale))].groupby("region"):
                mean, std = scale[region]
                x, label = (part[bands].to_numpy(float) - mean) / std, part["label"].to_numpy(int)
                found = []
                for step, net in (n[region] for n in nets if region in n):
                    shares = log_shares(forward(net, x)[-1])
                    found.append((region, step, len(part), int((shares.argmax(axis=1) == label).sum()), -float(shares[np.arange(len(part)), label].sum())))
                yield pd.DataFrame(found, columns=["region", "step", "rows", "right", "lost"])

    parts = test.select("region", *bands, "label").mapInPandas(sums, "region string, step int, rows long, right long, lost double")
    total = parts.groupBy("region", "step").agg(F.sum("rows").alias("n"), F.sum("right").alias("right"), F.sum("lost").alias("lost"))
    return total.select("region", "step", (F.col("right") / F.col("n")).alias("accuracy"), (F.col("lost") / F.col("n")).alias("loss"), "n")


def as_json(weights: list[np.ndarray], mean: np.ndarray, std: np.ndarray) -> str:
    layers = [{"w": weights[k].tolist(), "b": weights[k + 1].tolist()} for k in range(0, len(weights), 2)]
    return json.dumps({"data_mean": mean.tolist(), "data_std": std.tolist(), "layers": layers})
