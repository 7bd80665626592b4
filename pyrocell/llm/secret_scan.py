"""Secrets in texts: three fixed patterns, and strings that a battery of randomness tests takes for keys.

A candidate is a run of 20 or more characters of an encoding's alphabet. Three statistics of its letters' places in the
alphabet of its inferred encoding (hexadecimal, base 32, base 36, base 62, base 64) are tested: chi-squared over equal
groups of the alphabet, the number of runs of its two sorts of characters (lower case and the rest, or letters and
digits), and the first serial correlation.

* Each test asks how often written text of that length and alphabet would look as random as that or more; how usual the
  letters are is a fourth. Written text is a chain that keeps to a kind of character, and names joined of words in the
  styles of the alphabet (camel case, kebab case, snake case, paths ...), with letters by their frequency; each
  statistic's median and lower tail is tabulated by simulation for each style. The four p-values are combined by their
  Cauchy mean, which holds for tests that depend on each other, and the style that explains the string best counts.
* A Benjamini-Hochberg step over the candidates of a text, with weights in proportion to length, holds the rate of
  false discoveries. What it keeps are the method's spans.
* A discovery must also be likely as a uniform string: the same battery's p-values under uniformity, least of three and
  corrected for three tests and the text's candidates, must reach a level. Alphabets in order and patterns fail here.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrocell.llm.pieces import text_blocks

KINDS = ["assign", "access", "hex", "random"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
#: Which bytes can be part of a hexadecimal run, or of a candidate.
IN_HEX = bytes(1 if chr(b) in "0123456789abcdef" else 0 for b in range(256))
IN_KEY = bytes(1 if chr(b) in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-" else 0 for b in range(256))
FALSE_RATE, RANDOM_LEVEL = 3e-3, 1e-3

#: Letters of written English per 1000 (fixed values).
LETTER_RATE = {"e": 120, "t": 90, "a": 82, "o": 75, "i": 70, "n": 67, "s": 63, "h": 61, "r": 60, "d": 43, "l": 40, "c": 28, "u": 28, "m": 24, "w": 24, "f": 22, "g": 20, "y": 20, "p": 19, "b": 15, "v": 10, "k": 8, "j": 2, "x": 2, "q": 1, "z": 1}
STAY = 0.97  # written text keeps to a kind of character
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}


def encoding(s: str) -> tuple[str, str]:
    """The smallest alphabet that holds the string, and the string in it."""
    body = s.rstrip("=").replace("-", "+").replace("_", "/")
    for name in ("hex", "base32", "base36"):
        for form in ({body, body.lower()} if body in (body.lower(), body.upper()) else {body}):
            if set(form) <= set(ALPHABETS[name]):
                return name, form
    return ("base62" if set(body) <= set(ALPHABETS["base62"]) else "base64"), body


def statistics(xs: np.ndarray, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row of places in the alphabet ``name``: chi-squared over equal groups of the alphabet (two or more
    expected in each), the number of runs of its two sorts of characters, the serial correlation (1 for constant rows)."""
    (rows, n), size = xs.shape, len(ALPHABETS[name])
    groups = _groups(n, size)
    share = np.bincount(np.arange(size) * groups // size, minlength=groups) / size
    counts = np.bincount((np.arange(rows)[:, None] * groups + xs * groups // size).ravel(), minlength=rows * groups).reshape(rows, groups)
    chi = ((counts - n * share) ** 2 / (n * share)).sum(axis=1)
    sort = _sorts(name)[xs]
    runs = 1 + (sort[:, 1:] != sort[:, :-1]).sum(axis=1)
    d = xs - xs.mean(axis=1, keepdims=True)
    var = (d * d).sum(axis=1)
    serial = np.where(var > 0, (d[:, 1:] * d[:, :-1]).sum(axis=1) / np.where(var > 0, var, 1), 1.0)
    return chi, runs, serial


def _groups(n: int, size: int) -> int:
    return max(2, min(size, n // 2))


@functools.cache
def _sorts(name: str) -> np.ndarray:
    """An alphabet's two sorts: lower-case letters and the rest, or letters and digits where it has one case."""
    letters = ALPHABETS[name]
    return np.array([c.islower() if letters != letters.upper() and letters != letters.lower() else c.isalpha() for c in letters])


def _below(z: float) -> float:
    """The standard normal distribution."""
    return 0.5 * math.erfc(-z / math.sqrt(2))


def uniform_p(chi: float, runs: float, serial: float, xs: np.ndarray, name: str) -> float:
    """How likely a uniform string is to look as odd as this: the least of three p-values, corrected for three tests.

    Chi-squared by Wilson and Hilferty, runs given the counts of both sorts, serial correlation by its normal limit.
    """
    n = len(xs)
    d = _groups(n, len(ALPHABETS[name])) - 1
    by_chi = 1 - _below(((chi / d) ** (1 / 3) - (1 - 2 / (9 * d))) / math.sqrt(2 / (9 * d)))
    sort = _sorts(name)
    a = int(sort[xs].sum())
    if a in (0, n):
        by_runs = float(sort.mean() if a else 1 - sort.mean()) ** n
    else:
        mean = 2 * a * (n - a) / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        by_runs = _below((runs - mean) / math.sqrt(var)) if var > 0 else 1.0  # many runs are no sign of writing
    by_serial = 2 * _below(-abs(serial + 1 / n) * math.sqrt(n))
    return min(1.0, 3 * min(by_chi, by_runs, by_serial))


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


#: Lengths at which written text is simulated, and how often.
LENGTHS, SAMPLES = (20, 26, 34, 44, 57, 74, 96, 125, 162, 211), 4000
#: How names are joined of words, by alphabet: what stands between two words, and the kind of a word's first letter and of
#: its others (see ``_kind``). "chain" is text that keeps to a kind of character without regard to words.
STYLES = {
    "hex": {"chain": None},
    "base32": {"chain": None, "joined": ("", 1, 1)},
    "base36": {"chain": None, "joined": ("", 0, 0)},
    "base62": {"chain": None, "camel": ("", 1, 0), "lower": ("", 0, 0)},
    "base64": {"chain": None, "kebab": ("+", 0, 0), "snake or path": ("/", 0, 0), "title": ("/", 1, 0), "constant": ("/", 1, 1)},
}
#: How often a word of a name ends after so many letters (1, 2, ... of the hazard), and how often a number stands for it.
WORD_ENDS, NUMBER_SHARE = (0.02, 0.06, 0.12, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.8, 1.0), 0.06


def written(name: str, n: int, rows: int, rng: np.random.Generator, style: str = "chain") -> np.ndarray:
    """Rows of ``n`` places of written text, or of a name of some style, in the alphabet ``name``."""
    letters = ALPHABETS[name]
    rate = np.array([LETTER_RATE[c.lower()] / 1000 if c.isalpha() else 0.1 if c.isdigit() else 0.25 for c in letters])
    kind = np.array([_kind(c) for c in letters])
    kinds = _chain(n, rows, sorted(set(kind.tolist())), rng) if style == "chain" else _joined(n, rows, STYLES[name][style], rng)
    out = np.empty((rows, n), np.int64)
    for k in range(4):
        where = kinds == k
        of = np.flatnonzero(kind == k) if k < 3 or style == "chain" else np.array([letters.index(STYLES[name][style][0] or letters[0])])
        if where.any():
            out[where] = rng.choice(of, int(where.sum()), p=rate[of] / rate[of].sum())
    return out


def _chain(n: int, rows: int, present: list[int], rng: np.random.Generator) -> np.ndarray:
    # Signs stand alone and upper case begins words, so both are left sooner.
    stay = {0: STAY, 1: STAY / 2, 2: STAY, 3: 0.1}
    usual = {0: 0.8, 1: 0.1, 2: 0.07, 3: 0.03}
    share = np.array([usual[k] for k in present]) / sum(usual[k] for k in present)
    at = rng.choice(len(present), rows, p=share)
    kinds = np.empty((rows, n), np.int64)
    for j in range(n):
        kinds[:, j] = np.array(present)[at]
        move = rng.random(rows) >= np.array([stay[k] for k in present])[at]
        at = np.where(move, rng.choice(len(present), rows, p=share), at)
    return kinds


def _joined(n: int, rows: int, style: tuple[str, int, int], rng: np.random.Generator) -> np.ndarray:
    between, first, others = style
    kinds = np.empty((rows, n), np.int64)
    age, number = np.zeros(rows, np.int64), np.zeros(rows, bool)  # letters of the word so far; -1: a sign is due
    for j in range(n):
        kinds[:, j] = np.where(age < 0, 3, np.where(number, 2, np.where(age == 0, first if j else min(first, others), others)))
        ends = (age >= 0) & (rng.random(rows) < np.where(number, 0.5, np.array(WORD_ENDS)[np.minimum(np.maximum(age, 0), len(WORD_ENDS) - 1)]))
        starts = ends if not between else age < 0
        number = np.where(starts, rng.random(rows) < NUMBER_SHARE, number)
        age = np.where(ends, -1 if between else 0, np.where(age < 0, 0, age + 1))
    return kinds


@functools.cache
def _letter_score(name: str) -> np.ndarray:
    """How much likelier each letter is in writing than at random, as a logarithm; nothing for digits and signs."""
    return np.array([math.log(LETTER_RATE[c.lower()] / 1000 * 26) if c.isalpha() else 0.0 for c in ALPHABETS[name]])


@functools.cache
def _kinds(name: str) -> np.ndarray:
    return np.array([_kind(c) for c in ALPHABETS[name]])


@functools.cache
def _written_tables(name: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each style, medians and lower deviations, (lengths, tests), of the statistics' normal forms; the deviation is
    that of a normal distribution with the same median and lower half percent."""
    rng, out = np.random.default_rng(5), []
    for style in STYLES[name]:
        forms = [_forms(written(name, n, SAMPLES, rng, style), name) for n in LENGTHS]
        middle = np.array([[np.median(f) for f in fs] for fs in forms])
        out.append((middle, (middle - np.array([[np.quantile(f, 0.005) for f in fs] for fs in forms])) / 2.576))
    return out


def _forms(xs: np.ndarray, name: str):
    """Roots and shares that are nearly normal, each greater for written than for random strings: chi-squared, runs of the
    kinds of characters, serial correlation, and how usual the letters are."""
    chi, _, serial = statistics(xs, name)
    kind, n = _kinds(name)[xs], xs.shape[1]
    runs = 1 + (kind[:, 1:] != kind[:, :-1]).sum(axis=1)
    return np.sqrt(chi / n), -np.sqrt(runs / n), serial, _letter_score(name)[xs].mean(axis=1)


def written_p(xs: np.ndarray, name: str) -> list[float]:
    """How likely written text, or a name of whichever style looks most like it, is to look as random, by each test."""
    n = len(xs)
    forms = [float(f[0]) for f in _forms(xs[None], name)]
    at, scale = np.log(LENGTHS), math.sqrt(min(1.0, LENGTHS[-1] / n))
    by_style = []
    for mean, sd in _written_tables(name):
        ps = []
        for k, x in enumerate(forms):
            m, d = (float(np.interp(math.log(n), at, t[:, k])) for t in (mean, sd))
            ps.append(max(1e-300, _below((x - m) / max(d * scale, 1e-6))))
        by_style.append(ps)
    return max(by_style, key=cauchy)


def cauchy(ps: list[float]) -> float:
    """The Cauchy combination of p-values, valid whatever their dependence in the tail; cut at 0.99, so that one test
    that sees nothing doesn't outweigh the others."""
    t = sum(math.tan((0.5 - min(p, 0.99)) * math.pi) if p > 1e-15 else 1 / (p * math.pi) for p in ps) / len(ps)
    return 1 / (t * math.pi) if t > 1e15 else 0.5 - math.atan(t) / math.pi


@dataclass(frozen=True)
class Candidate:
    """A string that may be a key, with its tests: ``tests`` are the four p-values under written text, ``p`` their
    combination, ``fit`` the p-value under uniformity; ``key`` is the verdict."""

    start: int
    end: int
    encoding: str
    tests: tuple[float, float, float, float]
    p: float
    fit: float
    key: bool


def tested(s: str) -> tuple[str, tuple[float, float, float, float], float, float]:
    """Encoding, p-values under written text, their combination, and the p-value under uniformity."""
    name, form = encoding(s)
    place = {c: k for k, c in enumerate(ALPHABETS[name])}
    xs = np.array([place[c] for c in form])
    chi, runs, serial = (float(x[0]) for x in statistics(xs[None], name))
    tests = written_p(xs, name)
    return name, tuple(tests), cauchy(tests), uniform_p(chi, runs, serial, xs, name)


def discoveries(candidates: list[str], rate: float = FALSE_RATE, level: float = RANDOM_LEVEL) -> list[tuple[bool, tuple]]:
    """Which candidates of one text are keys, and each one's tests."""
    if not candidates:
        return []
    m, total = len(candidates), sum(map(len, candidates))
    tests = [tested(c) for c in candidates]
    weighted = sorted((t[2] * total / (m * len(c)), i) for i, (c, t) in enumerate(zip(candidates, tests, strict=True)))
    last = max((k for k, (p, _) in enumerate(weighted, 1) if p <= rate * k / m), default=0)
    found = {i for _, i in weighted[:last]}
    return [(i in found and t[3] >= level / m, t) for i, t in enumerate(tests)]


def candidates(text: str) -> list[Candidate]:
    """All candidates of a text with their tests and verdicts."""
    if b"\1" * 20 not in text.encode("utf-8", "surrogatepass").translate(IN_KEY):
        return []
    found = list(RANDOM.finditer(text))
    return [Candidate(m.start(), m.end(), t[0], t[1], t[2], t[3], key) for m, (key, t) in zip(found, discoveries([m.group() for m in found]), strict=True)]


def base(text: str) -> list[tuple[str, int, int]]:
    """The spans of the fixed patterns."""
    spans = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    if b"\1" * 32 in text.encode("utf-8", "surrogatepass").translate(IN_HEX):
        spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return spans


def find(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) in code points, by start, then kind as listed; base kinds don't depend on others,
    and what the battery finds is a span whether or not a pattern finds it too."""
    return _sorted(base(text) + [("random", c.start, c.end) for c in candidates(text) if c.key])


def _sorted(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0])))


SPANS = "array<struct<kind:string,start:int,end:int>>"
CANDIDATES = "array<struct<start:int,end:int,encoding:string,chi_p:double,runs_p:double,serial_p:double,letters_p:double,p:double,fit:double,key:boolean>>"


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row its id, ``spans`` in order of start, and ``candidates``: every string that was tested, with the
    p-values of its tests (see ``Candidate``).

    A null or empty text has none; repeated rows and null ids are kept row by row; an empty table gives an empty
    result; other columns aren't read. Whole texts are scanned, in one pass without a shuffle.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    tests = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("encoding", pa.string()), *((n, pa.float64()) for n in ("chi_p", "runs_p", "serial_p", "letters_p", "p", "fit")), ("key", pa.bool_())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for first, stop, texts in text_blocks(batch.column(1)):
                tried = [candidates(t) for t in texts]
                found = [_sorted(base(t) + [("random", c.start, c.end) for c in cs if c.key]) for t, cs in zip(texts, tried, strict=True)]
                spans = [[{"kind": k, "start": a, "end": b} for k, a, b in f] for f in found]
                rows = [[{"start": c.start, "end": c.end, "encoding": c.encoding, "chi_p": c.tests[0], "runs_p": c.tests[1], "serial_p": c.tests[2], "letters_p": c.tests[3], "p": c.p, "fit": c.fit, "key": c.key} for c in cs] for cs in tried]
                yield pa.record_batch([batch.column(0).slice(first, stop - first), pa.array(spans, kind), pa.array(rows, tests)], names=["id", "spans", "candidates"])

    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, spans {SPANS}, candidates {CANDIDATES}").withColumnRenamed("id", id_col)


def redact(df: DataFrame, mark: str = "[SECRET]", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, all columns kept, with every found span of the text replaced by ``mark``; null texts stay null."""
    names = df.columns
    at = names.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for first, stop, texts in text_blocks(batch.column(at)):
                part = batch.slice(first, stop - first)
                arrays = list(part.columns)
                empty = arrays[at].is_null().to_numpy(zero_copy_only=False)
                arrays[at] = pa.array([None if n else masked(t, mark) for t, n in zip(texts, empty, strict=True)], pa.string())
                yield pa.record_batch(arrays, names=names)

    return df.mapInArrow(run, df.schema)


def masked(text: str, mark: str) -> str:
    """The text with every found span replaced; overlapping ones by one mark."""
    out, at = [], 0
    for _, a, b in merged(find(text)):
        out += [text[at:a], mark]
        at = b
    return "".join([*out, text[at:]])


def merged(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Overlapping spans as one."""
    out: list[tuple[str, int, int]] = []
    for k, a, b in spans:
        if out and a < out[-1][2]:
            out[-1] = (out[-1][0], out[-1][1], max(b, out[-1][2]))
        else:
            out.append((k, a, b))
    return out


def digests(scanned: DataFrame) -> DataFrame:
    """Counts of the base kinds, the SHA-256 of their spans as text, and all spans as text; the method's own counts of
    spans and of strings tested, and the tests as text (start:end:encoding:p:fit)."""
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(text(F.filter("spans", lambda s: s["kind"] != "random")), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
        n("random").alias("n_random"), F.size("candidates").cast("long").alias("n_tested"),
        F.array_join(F.transform("candidates", lambda c: F.format_string("%d:%d:%s:%.3e:%.3e", c["start"], c["end"], c["encoding"], c["p"], c["fit"])), ",").alias("tests"),
    )
