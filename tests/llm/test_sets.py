"""Neighbours, the Jaccard join, components and the pipeline against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F

from pyrocell.llm import jaccard_join, neighbours
from pyrocell.llm.components import components
from pyrocell.llm.secret_scan import find


def brute_join(rows, n, percent):
    low = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for i, s in sets.items():
        for g in s:
            where.setdefault(g, []).append(i)
    for i, s in sets.items():
        for j, both in Counter(j for g in s for j in where[g] if j < i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def edited(rnd, base, most):
    w = base.split(" ")
    for _ in range(rnd.randint(0, most)):
        w[rnd.randrange(len(w))] = rnd.choice(["A", "b", "Xy", "é"])
    return rnd.choice([" ", "\n", "\t "]).join(w)


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (2, 50)])
def test_join_by_brute_force(spark, n, percent):
    rnd = random.Random(n)
    bases = [" ".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 70))) for _ in range(25)]
    rows = [(i, edited(rnd, rnd.choice(bases), 4)) for i in range(300)] + [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, size int")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(df, n, percent).collect()}
    assert got == brute_join(rows, n, percent)


def test_hot_buckets_give_the_same_links(spark, monkeypatch):
    """All n-grams through the path for hot ones; one large group of near copies and a passage that many share."""
    monkeypatch.setattr(jaccard_join, "HOT", 1)
    rnd = random.Random(7)
    base, passage = " ".join(f"w{k}" for k in range(60)), " ".join(f"p{k}" for k in range(50))
    rows = [(i, edited(rnd, base, 1)) for i in range(150)] + [(1000 + i, passage + " " + " ".join(f"u{i}x{k}" for k in range(rnd.randint(5, 25)))) for i in range(60)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()}
    assert got == brute_join(rows, 4, 85)


def test_hot_inside_a_rank_keeps_positions_right(spark, monkeypatch):
    """Counts 4 and 5 are of one rank. The pair's only common prefix word has 5 (hot) and is the first of a's; the three
    after it have 4 (cold)."""
    monkeypatch.setattr(jaccard_join, "HOT", 5)
    g, *cold = sorted(["river", "stone", "cloud", "field"], key=lambda w: jaccard_join.grams([w], 1)[0][0])
    often = [f"often{k}" for k in range(12)]
    a, b = [g, *cold, *often], [g, *cold, *often, "rare1", "rare2", "rare3", "rare4"]
    texts = [" ".join(a), " ".join(b)] + [g] * 3 + cold * 2 + often * 6
    rows = list(enumerate(texts))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string"), 1, 80).collect()}
    assert got == brute_join(rows, 1, 80) and got[1] == (20, 0)


@pytest.mark.parametrize("hot", [5, 11])
def test_hot_inside_a_rank_by_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(jaccard_join, "HOT", hot)
    rnd = random.Random(hot)
    bases = [[f"w{rnd.randrange(60)}" for _ in range(18)] for _ in range(12)]
    rows = [(i, " ".join(w for w in rnd.choice(bases) if rnd.random() < 0.9) + f" u{i}") for i in range(100)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string"), 1, 80).collect()}
    assert got == brute_join(rows, 1, 80)


def test_salts_and_filters_change_nothing(spark, monkeypatch):
    """Hubs and buckets in many salts; wanted ids by a join instead of a filter."""
    rnd = random.Random(17)
    base, passage = " ".join(f"w{k}" for k in range(40)), " ".join(f"p{k}" for k in range(30))
    rows = [(i, edited(rnd, base, 2)) for i in range(120)] + [(1000 + i, passage + " " + " ".join(f"u{i % 20}x{k}" for k in range(rnd.randint(2, 9)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_join(rows, 3, 80)
    for least, ids in ((3, 1 << 23), (3, 1)):
        monkeypatch.setattr(jaccard_join, "SALTED", least)
        monkeypatch.setattr(jaccard_join, "FILTER_IDS", ids)
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(df, 3, 80).collect()} == want


@pytest.mark.parametrize("percent", [80, 85, 50, 100, 7])
def test_bands_hold_all_sizes_that_link(spark, percent):
    """Of all sizes whose quotient allows a link, exactly at its bound too, bands differ by one at most."""
    sizes = spark.range(1, 3000).select(F.col("id").alias("a"))
    pairs = sizes.select("a", F.explode(F.array(F.ceil(F.col("a") * percent / 100), F.col("a"), F.expr(f"(a * {percent} + 99) div 100"))).alias("b")).where(f"b * 100 >= a * {percent}")
    far = pairs.where(F.abs(jaccard_join.band(F.col("a"), percent) - jaccard_join.band(F.col("b"), percent)) > 1)
    assert pairs.count() > 2000 and not far.count()


def test_sets_at_the_edge_of_sizes_link_across_components(spark):
    """64, 80, 100 and 125 words, each in the next at exactly 80 percent, in one bucket with many that link with none."""
    words = [f"w{k}" for k in range(125)]
    rows = [(i, " ".join(words[:n])) for i, n in enumerate((125, 64, 100, 80))]
    rows += [(10 + i, " ".join([*words[:3], *(f"u{i}x{k}" for k in range(i % 9 + 1))])) for i in range(40)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string"), 1, 80).collect()}
    assert got == brute_join(rows, 1, 80) and {got[i][1] for i in range(4)} == {0}


def test_join_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(docs, 4, 85).collect()}
    assert got == brute_join([(r["doc_id"], r["text"]) for r in docs.collect()], 4, 85)


def test_large_and_small_classes_get_the_same_answer(spark, monkeypatch):
    rnd = random.Random(12)
    rows = [(i, "one text that very many rows share with each other") for i in range(80)] + [(100 + i, " ".join(rnd.choice("abcdef") for _ in range(9))) for i in range(60)] + [(300 + i, "") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for large in (1, 5, 1000):
        monkeypatch.setattr(jaccard_join, "LARGE_CLASSES", large)
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.join(df, 4, 85).collect()} == brute_join(rows, 4, 85)


def test_join_edges(spark):
    df = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (None, None)], "doc_id long, text string")
    assert sorted(map(tuple, jaccard_join.join(df, 4, 85).collect()), key=repr) == sorted([(1, 2, 1), (1, 2, 1), (None, 2, 1), (None, 0, None)], key=repr)
    assert jaccard_join.join(df.limit(0)).count() == 0


@pytest.mark.parametrize("percent", [60, 85, 100])
def test_prefixes_drop_pairs_that_cannot_link(spark, percent):
    """Words of three classes of frequency; pairs at all likenesses, with the prefixes that the global order gives."""
    rng = random.Random(percent)
    sets, rows = {}, []
    for k in range(60):
        base = rng.sample(range(400), rng.randint(3, 40)) if k % 6 == 0 else [w for w in base if rng.random() < 0.97] + rng.sample(range(400), rng.randint(0, 3))
        sets[k] = sorted(set(base))  # the least number is the rarest
        size = len(sets[k])
        prefix = sets[k][: size + (-size * percent // 100) + 1]
        rows.append((k, size, [w for w in prefix if w < 200], [w for w in prefix if w >= 200]))
    classes = spark.createDataFrame(rows, "key long, size long, cold array<long>, hot array<long>")
    like = {(a, b): len(set(sets[a]) & set(sets[b])) for a in sets for b in sets if a < b}
    pairs = spark.createDataFrame([(a, b, len(sets[a]), len(sets[b])) for (a, b), n in like.items() if n], "a long, b long, size_a long, size_b long")
    left = {(r["a"], r["b"]) for r in jaccard_join.reaching(pairs, classes, percent).collect()}
    links = {(a, b) for (a, b), n in like.items() if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)}
    assert links and links <= left and len(left) < pairs.count()


def test_components_of_chains(spark):
    rnd = random.Random(2)
    order = rnd.sample(range(1000), 300)
    links = [(a, b) for a, b in zip(order, order[1:], strict=False) if order.index(a) % 60 != 59]
    got = {r["key"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    for k in range(0, 300, 60):
        part = order[k : k + 60]
        assert {got[x] for x in part} == {min(part)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_nearest(ids, x, q, k):
    d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
    return [(int(ids[i]), d[i]) for i in np.lexsort((ids, d)) if ids[i] != q][:k]


def test_recall_and_exact_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.select("vec_id", "embedding").toPandas()
    ids, x = rows["vec_id"].to_numpy(), np.stack(rows["embedding"]).astype(float)
    found = {}
    for r in neighbours.search(df).collect():
        found.setdefault(r["query_id"], []).append(r)
    hit = 0
    for q in ids[ids % 100 == 0]:
        got = sorted(found[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == list(range(1, 11)) and [(r["score"], r["vec_id"]) for r in got] == sorted((r["score"], r["vec_id"]) for r in got)
        want = brute_nearest(ids, x, q, 10)
        assert all(abs(np.sqrt(((x[ids == r["vec_id"]][0] - x[ids == q][0]) ** 2).sum()) - r["score"]) < 1e-12 for r in got)
        hit += len({i for i, _ in want} & {r["vec_id"] for r in got})
    assert hit / (10 * len(found)) >= 0.9


def test_recall_on_many_vectors(spark):
    """50 000 unit vectors about ten centres: the nearest are hardly nearer than the next, so the table must be fine."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(50_000, 32)) + 1.5 * rng.normal(size=(10, 32))[rng.integers(0, 10, 50_000)]
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    x[777:1777:5] = x[777]  # and 200 copies of one
    table = pa.table({"vec_id": np.arange(len(x)), "embedding": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), 32).cast(pa.list_(pa.float32()))})
    df = spark.createDataFrame(table).repartition(8)
    found = {}
    for r in neighbours.search(df, every=500).collect():
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    assert len(found) == 100 and all(len(v) == 10 for v in found.values())
    x, hit = x.astype(float), 0
    for q, got in found.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        want = [i for i in np.lexsort((np.arange(len(x)), d)) if i != q][:10]
        hit += len(set(want) & set(got))
    assert hit >= 0.95 * 10 * len(found)


def shapes(rng):
    """Rows that codebooks fitted on the whole describe badly."""
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    yield "many dimensions", rng.normal(size=(6000, 96))
    yield "far from zero", 1000 + rng.normal(size=(6000, 16))
    yield "two scales", rng.normal(size=(6000, 24)) * np.where(np.arange(6000) % 2, 1.0, 1e-4)[:, None]
    yield "lengths of all sizes", unit(rng.normal(size=(6000, 24))) * np.exp(rng.normal(scale=4, size=(6000, 1)))
    yield "tight groups", unit(rng.normal(size=(40, 24)))[np.arange(6000) % 40] + 1e-5 * rng.normal(size=(6000, 24))
    yield "one far group", np.where(np.arange(6000)[:, None] % 300 == 0, 1e6 + rng.normal(size=(6000, 16)), rng.normal(size=(6000, 16)))
    yield "copies", rng.normal(size=(30, 16))[np.arange(6000) % 30]
    yield "a lattice", rng.integers(0, 3, (6000, 8)) + 1.0


def test_no_near_vector_is_missed_whatever_the_rows(spark):
    for name, x in shapes(np.random.default_rng(8)):
        x = x.astype(np.float32)
        table = pa.table({"vec_id": np.arange(len(x)), "embedding": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))})
        found = {}
        for r in neighbours.search(spark.createDataFrame(table).repartition(4), books=8).orderBy("rank").collect():
            found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert len(found) == 60
        ids, x = np.arange(len(x)), x.astype(float)
        for q, got in found.items():
            want = brute_nearest(ids, x, q, 10)
            assert np.allclose([d for _, d in got], [d for _, d in want], rtol=1e-9, atol=0), (name, q)
            if name in ("copies", "a lattice"):
                assert [i for i, _ in got] == [i for i, _ in want], (name, q)


def test_shuffled_columns_are_codes_not_vectors(spark):
    """What meets the queries holds a code of a byte for each codebook, never the vectors."""
    df = spark.createDataFrame([(i, [float(i % 7), float(i % 5), 1.0]) for i in range(600)], "vec_id long, embedding array<float>")
    plan = neighbours.search(df)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInPandas" in plan and not re.search(r"FlatMapCoGroupsInPandas[^\n]*v#\d+[^\n]*codes", plan)


def test_neighbour_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (100, [1.0, None]), (3, [1.0, 2.0]), (200, [nan, 1.0]), (300, [inf, 1.0]), (4, [1.0, 2.0]), (5, [1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    assert [tuple(r) for r in neighbours.search(df).orderBy("rank").collect()] == [(0, 1, 3, 2.0), (0, 2, 4, 2.0)]
    assert neighbours.search(df.limit(0)).count() == 0


def test_one_row_of_each_component_stays_where_ids_repeat(spark):
    import corpus_pipeline as p

    base, near = " ".join(f"w{k}" for k in range(60)), " ".join(f"w{k}" for k in range(59))
    more, like = " ".join(f"x{k}" for k in range(60)), " ".join(f"x{k}" for k in range(59))
    rows = [(1, base), (5, near), (5, "a text like no other of them all"), (7, more), (7, like), (7, like), (8, "A b c d e f"), (8, "a b c d e f"), (9, ""), (9, None), (None, near), (None, near)]
    df = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, lang string")
    out = p.keep_one_of_near_copies(spark, df, "")
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert out.columns == df.columns and set(got) <= set(rows)
    assert [sum(i == k for i, _ in got) for k in (1, 5, 7, 8, 9, None)] == [1, 1, 1, 1, 2, 2]
    assert (5, "a text like no other of them all") in got


def test_stages_on_edges(spark, tmp_path):
    """Null, empty and very long texts, null and repeated ids, repeated rows, columns named like those made inside."""
    import corpus_pipeline as p

    key = "q7ZxT2mKd9RwB4uYc1HsLfV8nJpE3aGgX6tQ0iWo"
    texts = [(1, "one two three four five six"), (1, "one two three four five six"), (2, None), (3, ""), (None, None), (4, f"AWS_KEY={key}"), (5, "word " * 40_000), (6, "x" * 300_000)]
    columns = "doc_id long, text string, lang string, n_chars long, commas double, score string, row int, size int, key string, __salt int"
    df = spark.createDataFrame([(*t, "en", 0, 0.5, "s", 1, 2, "k", 3) for t in texts], columns)
    (tmp_path / "labels.parquet").mkdir()
    spark.createDataFrame([(1, 1), (4, 1)], "doc_id long, quality int").write.mode("overwrite").parquet(str(tmp_path / "labels.parquet"))
    for k, (_, stage) in enumerate(p.STAGES):
        out, none = stage(spark, df, str(tmp_path)), stage(spark, df.limit(0), str(tmp_path))
        assert none.count() == 0
        rows = out.collect()
        if k < 3:
            assert out.columns == df.columns
        if k == 0:
            assert sorted(map(repr, rows)) == sorted(map(repr, df.collect()))  # labels of one kind teach nothing
        if k == 1:
            assert sorted(repr(r["doc_id"]) for r in rows) == sorted(map(repr, [1, 2, 3, None, 4, 5, 6]))
        if k == 2:
            got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in rows}
            assert len(rows) == 8 and got[4] == ("AWS_KEY=[SECRET]", 16) and got[2] == (None, None) and got[3] == ("", 0) and got[6][1] == 300_000
        if k == 3:
            by = {}
            for r in rows:
                by.setdefault(r["doc_id"], []).append(r["length"])
            assert sum(by[2]) == sum(by[3]) == 1 and len(by[1]) == 2 and sum(by[5]) > 40_000 and sum(by[None]) == 1


def test_pipeline_by_brute_force(spark, tmp_path):
    import corpus_pipeline as p

    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    kept = None
    for k, (name, stage) in enumerate(p.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        stage(spark, docs, d).write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        if k < len(p.STAGES) - 1:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            kept = {r["doc_id"]: r["text"] for r in out.collect()}
        if k == 0:
            labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
            assert sum(i in kept for i, q in labels.items() if q == 1) >= 0.98 * sum(q == 1 for q in labels.values())
            assert sum(i in kept for i, q in labels.items() if q == 0) <= 0.1 * sum(q == 0 for q in labels.values())
            assert all(before[i] == t for i, t in kept.items())
        if k == 1:
            groups = brute_join(before.items(), 5, 80)
            assert set(kept) == {i for i, (_, c) in groups.items() if i == c}
        if k == 2:
            assert set(kept) == set(before) and not any(s[0] != "random" for t in kept.values() for s in find(t))
            assert all((before[i] == t) == (not find(before[i])) for i, t in kept.items())
        docs = out
    assert {r["doc_id"] for r in docs.collect()} == set(kept)
