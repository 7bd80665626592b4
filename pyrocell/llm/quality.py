"""A sparse rule ensemble for quality: conjunctive rules from tree paths, lasso logistic weights, one expression.

Statistics of a text are columns; so are the rules made of them and the score, so scoring is one projection.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyrocell.llm.common import kept

#: Labelled rows that a fit takes at most, on average: above it, rows are drawn by a hash of their id.
FIT_ROWS = 200_000
THRESHOLD = 0.7
ROWS_BY_TASK = 10_000


def statistics(text: Column) -> dict[str, Column]:
    """Statistics by name, all finite for any text; null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    n = F.length(t)
    words, lines = F.filter(F.split(t, r"\s+"), lambda w: w != ""), F.filter(F.split(t, "\n"), lambda x: x != "")
    n_words, n_lines = F.size(words), F.size(lines)
    share = lambda removed: (n - F.length(removed)) / F.greatest(n, F.lit(1))
    distinct_words = F.array_distinct(words)
    return {
        "log_words": F.log1p(n_words.cast("double")),
        "word_length": n / F.greatest(n_words, F.lit(1)),
        "distinct_words": F.size(distinct_words) / F.sqrt(F.greatest(n_words, F.lit(1)).cast("double")),
        "repeated_words": 1 - F.size(distinct_words) / F.greatest(n_words, F.lit(1)),
        "repeated_lines": 1 - F.size(F.array_distinct(lines)) / F.greatest(n_lines, F.lit(1)),
        "words_by_line": n_words / F.greatest(n_lines, F.lit(1)),
        "upper": share(F.regexp_replace(t, r"\p{Lu}+", "")),
        "signs": share(F.regexp_replace(t, r"[#$%&*|!<>{}=+^~@\\]+", "")),
        "digits": share(F.regexp_replace(t, "[0-9]+", "")),
        "bars": share(F.replace(t, F.lit("|"), F.lit(""))),
        "shouts": share(F.replace(t, F.lit("!"), F.lit(""))),
        "stops": share(F.replace(t, F.lit("."), F.lit(""))),
        "commas": share(F.replace(t, F.lit(","), F.lit(""))),
    }


@dataclass(frozen=True)
class Rule:
    """Bounds by statistic: (name, above, up to), each end open where None."""

    bounds: tuple[tuple[str, float | None, float | None], ...]

    def column(self) -> Column:
        tests = [F.col(n) > a for n, a, _ in self.bounds if a is not None] + [F.col(n) <= b for n, _, b in self.bounds if b is not None]
        return reduce(lambda x, y: x & y, tests)


@dataclass
class RuleEnsemble:
    """``intercept`` plus weights of rules and of statistics; ``score`` is a column between 0 and 1."""

    intercept: float
    rules: list[tuple[Rule, float]] = field(default_factory=list)
    linear: list[tuple[str, float]] = field(default_factory=list)

    def score(self) -> Column:
        terms = [F.when(r.column(), F.lit(w)).otherwise(F.lit(0.0)) for r, w in self.rules] + [F.col(n) * F.lit(w) for n, w in self.linear]
        return 1 / (1 + F.exp(-reduce(lambda x, y: x + y, terms, F.lit(self.intercept))))


def paths(debug: str, names: list[str]) -> set[Rule]:
    """The conjunctions on the way to every node of a printed tree."""
    out, stack = set(), []
    for line in debug.splitlines():
        if m := re.match(r"( *)(If|Else) \(feature (\d+) (<=|>) ([-\d.Ee]+)\)", line):
            depth = len(m[1])
            stack = [s for s in stack if s[0] < depth] + [(depth, names[int(m[3])], m[4], float(m[5]))]
            bounds: dict[str, list[float | None]] = {}
            for _, name, op, value in stack:
                b = bounds.setdefault(name, [None, None])
                if op == ">":
                    b[0] = value if b[0] is None else max(b[0], value)
                else:
                    b[1] = value if b[1] is None else min(b[1], value)
            out.add(Rule(tuple(sorted((n, *b) for n, b in bounds.items()))))
    return out


def fit(rows: DataFrame, names: list[str], label: str, trees: int = 16, depth: int = 4, lasso: float = 0.001, seed: int = 7) -> RuleEnsemble:
    """Learns from rows with statistics ``names`` and a 0/1 ``label``; rows with other labels are left out.

    Without rows of both labels the score is constant: the only label's smoothed rate, or 0.5 without any.
    """
    rows = rows.where(F.col(label).isin(0, 1)).select(*names, F.col(label).cast("double").alias("label")).persist()
    try:
        n, ones = rows.agg(F.count("*"), F.sum("label")).first()
        if not ones or ones == n:
            rate = ((ones or 0) + 1) / (n + 2)
            return RuleEnsemble(float(_logit(rate)))
        features = VectorAssembler(inputCols=names, outputCol="features").transform(rows).select("label", "features")
        forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=64, minInstancesPerNode=5, featureSubsetStrategy="0.5", seed=seed).fit(features)
        rules = sorted({r for t in forest.trees for r in paths(t.toDebugString, names)}, key=repr)
        holds = rows.select("label", *[r.column().cast("double").alias(f"r{k}") for k, r in enumerate(rules)], *names)
        design = VectorAssembler(inputCols=[c for c in holds.columns if c != "label"], outputCol="features").transform(holds).select("label", "features").persist()
        model = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=60, standardization=True).fit(design)
        design.unpersist()
        weights = model.coefficients.toArray().tolist()
        k = len(rules)
        return RuleEnsemble(float(model.intercept), [(r, w) for r, w in zip(rules, weights[:k], strict=True) if w], [(x, w) for x, w in zip(names, weights[k:], strict=True) if w])
    finally:
        rows.unpersist()


def _logit(p: float) -> float:
    import math

    return math.log(p / (1 - p))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that a fit never learns from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def scored(df: DataFrame, ensemble: RuleEnsemble, text_col: str = "text") -> DataFrame:
    """(row, score): each row as one struct, so that no column's name can clash with a statistic's, and its score."""
    row = df.select(F.struct("*").alias("row"))
    stats = row.select("row", *[c.cast("double").alias(n) for n, c in statistics(F.col("row").getField(text_col)).items()])
    return stats.select("row", ensemble.score().alias("score"))


def learn(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_rows: int = FIT_ROWS) -> RuleEnsemble:
    """Fits on the labelled rows that aren't held out; statistics are made of these rows alone.

    An id with several labels counts with their rounded mean, one with several texts with one of them. At most
    ``fit_rows`` labels are taken on average, drawn by a hash of their id, so they are few enough to be broadcast.
    """
    known = labels.where(labels[id_col].isNotNull() & labels[label_col].isNotNull()).groupBy(id_col).agg(F.round(F.avg(label_col)).cast("int").alias("__label"))
    known = known.where(~held_out(id_col))
    n = known.count()
    if n > fit_rows:
        known = known.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) < int(fit_rows / n * (1 << 20)))
    stats = statistics(F.col("__text"))
    labelled = df.select(df[id_col].alias("__id"), df[text_col].alias("__text")).join(F.broadcast(known.withColumnRenamed(id_col, "__id")), "__id")
    rows, names = labelled.select("__id", "__label", *[c.cast("double").alias(x) for x, c in stats.items()]), list(stats)
    rows = kept(rows.groupBy("__id").agg(F.min(F.struct("__label", *names)).alias("row")).select("row.*"))
    return fit(rows.repartition(1 + min(n, fit_rows) // ROWS_BY_TASK), names, "__label")  # every round of a fit is a job


def score(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """For each row its id, ``held_out``, ``score`` and ``predicted`` (score >= threshold).

    Only the text is scored: ids, labels and other columns are never inputs. Null and empty texts get the score of
    their (finite) statistics; repeated rows and null ids are kept row by row, a null id being no held-out row; an
    empty table gives an empty result.
    """
    rows = df.select(df[id_col], df[text_col])
    out = scored(rows, learn(df, labels, id_col, text_col), text_col).select(F.col("row").getField(id_col).alias(id_col), "score")
    out = out.select(id_col, F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), "score")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
