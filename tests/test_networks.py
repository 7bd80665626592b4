"""Training of networks against a plain version that holds all rows."""

import hashlib

import numpy as np

from pyrocell.operators import classify, networks

BANDS = ["a", "b"]
LAYERS = [2, 5, 4, 2]


def samples(rnd, n, regions):
    out = []
    for k in range(n):
        x = rnd.normal(size=2)
        out.append((regions[k % len(regions)], k, float(x[0]), float(x[1] * 3 + 1), int(x[0] * x[1] > 0), k % 10 < 7))
    return out


SCHEMA = "region string, id long, a double, b double, label int, training boolean"


def plain(rows, region, steps, batch, seed):
    """Adam by the textbook, with gradients by finite differences checked apart."""
    mine = [r for r in rows if r[0] == region and r[5]]
    x = np.array([[r[2], r[3]] for r in mine])
    mean, std = x.mean(axis=0), x.std(axis=0)
    w = networks.initial(LAYERS, seed, region)
    m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    batches = max(1, round(len(mine) / batch))
    for t in range(steps):
        epoch, at = divmod(t, batches)
        use = [r for r in mine if int(hashlib.md5(f"{seed}-{epoch}-{r[1]}".encode()).hexdigest()[:12], 16) % batches == at]
        if not use:
            continue
        bx = (np.array([[r[2], r[3]] for r in use]) - mean) / std
        gs = networks.gradients(w, bx, np.array([r[4] for r in use]))
        for k, g in enumerate(gs):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            w[k] = w[k] - 0.001 * (m[k] / (1 - 0.9 ** (t + 1))) / (np.sqrt(v[k] / (1 - 0.999 ** (t + 1))) + 1e-8 / (1 - 0.999 ** (t + 1)) ** 0.5)
    return w, mean, std


def test_gradients_by_differences():
    rng = np.random.default_rng(3)
    w = [a + 0.05 * rng.normal(size=a.shape) for a in networks.initial(LAYERS, 1, "x")]
    x, label = rng.normal(size=(30, 2)), rng.integers(0, 2, 30)
    loss = lambda: -networks.log_shares(networks.forward(w, x)[-1])[np.arange(30), label].mean()
    for a, g in zip(w, networks.gradients(w, x, label), strict=True):
        for at in list(np.ndindex(a.shape))[::3]:
            old = a[at]
            a[at] = old + 1e-6
            up = loss()
            a[at] = old - 1e-6
            down = loss()
            a[at] = old
            assert abs((up - down) / 2e-6 - g[at]) < 1e-5


def test_twenty_steps_equal_the_plain_version(spark):
    rows = samples(np.random.default_rng(1), 900, ["east", "west", "small"])
    rows = [r for r in rows if r[0] != "small" or r[1] < 30] + [("east", 5000, None, 1.0, 1, True), ("east", 5001, float("nan"), 1.0, 1, True), ("alone", 5002, 1.0, 2.0, 1, False)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    trained, report = networks.train(df, ["id"], BANDS, LAYERS, steps=20, batch=50, every=8, seed=4)
    rows = [r for r in rows if r[2] is not None and r[2] == r[2]]
    assert set(trained) == {"east", "west", "small"}
    got = {(r["region"], r["step"]): (r["accuracy"], r["loss"], r["n"]) for r in report.collect()}
    assert {k[1] for k in got} == {8, 16, 20} and len(got) == 9
    for region, text in trained.items():
        weights, mean, std = plain(rows, region, 20, 50, 4)
        spec = classify.weights_from_json(text)
        flat = [a for pair in spec["layers"] for a in pair]
        assert all(np.abs(a - b).max() < 1e-6 for a, b in zip(flat, weights, strict=True))
        assert np.allclose(spec["mean"], mean) and np.allclose(spec["std"], std)
        for step in (8, 16, 20):
            w, _, _ = plain(rows, region, step, 50, 4)
            held = [r for r in rows if r[0] == region and not r[5]]
            shares = networks.log_shares(networks.forward(w, (np.array([r[2:4] for r in held]) - mean) / std)[-1])
            label = np.array([r[4] for r in held])
            want = ((shares.argmax(axis=1) == label).mean(), -shares[np.arange(len(held)), label].mean(), len(held))
            assert np.allclose(got[region, step], want, atol=1e-6)
        predicted = classify.infer(df.where(f"region = '{region}' AND NOT training"), spec, BANDS)
        right = predicted.where("prediction = label").count()
        assert abs(right / got[region, 20][2] - got[region, 20][0]) < 1e-9


def test_learning_goes_on(spark):
    df = spark.createDataFrame(samples(np.random.default_rng(2), 2000, ["one"]), SCHEMA).repartition(4)
    _, report = networks.train(df, ["id"], BANDS, LAYERS, steps=600, batch=100, every=300, rate=0.01)
    last = {r["step"]: r for r in report.collect()}
    assert last[600]["accuracy"] > 0.9 and last[600]["loss"] < last[300]["loss"]
    assert networks.train(df.limit(0), ["id"], BANDS, LAYERS, steps=2, every=1)[0] == {}


def test_samples_are_read_three_times_however_many_rounds(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for pdf in batches:
            read.add(len(pdf))
            yield pdf

    rng = np.random.default_rng(6)
    rows = [(k, "ab"[k % 2], *map(float, rng.normal(size=len(BANDS))), k % 3 % 2, k % 5 > 0) for k in range(2000)]
    df = spark.createDataFrame(rows, "id long, region string, " + ", ".join(f"{b} double" for b in BANDS) + ", label int, training boolean")
    _, report = networks.train(df.mapInPandas(seen, df.schema), ["id"], BANDS, LAYERS, steps=20, batch=25, every=2)
    assert report.count() == 20 and read.value == 3 * 2000
