"""Collocations: phrases of two to five words that occur together far more often than their parts let one expect.

A phrase of words is scored at its worst cut: 1000 * a * n / (l * r), with a its own count, l and r the counts of the two
parts and n all words of the language. Since a is never above l or r, no phrase scores above 1000 * n / f, where f is the
count of its first word, its last word, or any other beginning or end. That bound is known from words alone, before any
phrase is counted.

So the search is best first. Words are ordered by that bound (rare ones first); the frontier of a language are the words
of count F and below, and a phrase is scored once its first and last word are in it. A round counts only the phrases that
begin or end with a word that is new in the frontier: these are all beginnings and ends that its scores need. They grow
by prefix counts: pairs first, longer ones only over pairs that are frequent themselves. With the 2000th surviving score T
in hand, what is outside can reach it, ties included, only if 1000 * n / f >= T for a word's count f above F: so one
more round with F = 1000 * n / T settles the language. Where fewer survive the frontier is widened until it holds all words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pyrocell.llm.common import bit_filter
from pyrocell.llm.fingerprints import mixed
from pyrocell.llm.pieces import text_blocks
from pyrocell.sources.shared import Rounds

MOST_WORDS = 5
#: The first frontier, in times of the least count, and what it grows by while too few phrases survive.
FIRST, GROWTH = 10, 1000
#: Bytes of the texts that are counted together, about.
BLOCK = 1 << 22
#: Bytes as they are compared: A-Z lower-cased, a tab as a space, what parts pieces as a line feed.
FOLDED = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 10 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))
#: Levels of words: not frequent, and frequent but in no frontier yet; frontiers are numbered from 1.
RARE, OUTSIDE = 1 << 20, 1 << 10
_MUL = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(lang: str, words: list[str]) -> np.ndarray:
    """A hash of each word in its language; a pair's is made of its words' (see ``pair_hashes``)."""
    head = lang + "\n"
    return np.fromiter((xxhash.xxh64_intdigest(head + w) for w in words), np.uint64, len(words))


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * _MUL + second)


def hashed(table: DataFrame, words: int) -> DataFrame:
    """The hashes of (lang, phrase), phrases being single words (1) or pairs (2)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            langs, phrases = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            hashes = [np.concatenate([[np.uint64(0)], *(word_hashes(lang, [p.split(" ")[k]]) for lang, p in zip(langs, phrases, strict=True))])[1:] for k in range(words)]
            h = hashes[0] if words == 1 else pair_hashes(*hashes)
            yield pa.record_batch([pa.array(h.astype(np.uint64).view(np.int64))], names=["hash"])

    return table.select("lang", "phrase").mapInArrow(run, "hash long")


def held(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of the hashes are in a filter."""
    at = (h & np.uint64(8 * len(bits) - 1)).astype(np.int64)
    return bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1


class Words:
    """The words of some texts of one language: ``distinct`` ones, each one's number in these, and whether it is in the
    piece of the word before it."""

    def __init__(self, texts: list[str]):
        data = np.frombuffer("\n".join(texts).encode("utf-8", "surrogatepass").translate(FOLDED) + b"\n", np.uint8)
        gap = (data == 32) | (data == 10)
        edge = np.flatnonzero(np.diff(np.concatenate([[True], gap])))
        start, stop = edge[0::2], edge[1::2]
        offsets = np.concatenate([[0], np.cumsum(stop - start)]).astype(np.int32)
        encoded = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[~gap].tobytes())).dictionary_encode()
        self.distinct, self.ids = encoded.dictionary, encoded.indices.to_numpy().astype(np.int64)
        lines = np.cumsum(data == 10)[start]
        self.follows = np.concatenate([[False], lines[1:] == lines[:-1]])[: len(start)]

    def joined(self, columns: list[np.ndarray]) -> pa.Array:
        """Phrases of the words with these numbers."""
        return pc.binary_join_element_wise(*[self.distinct.take(pa.array(c)) for c in columns], " ")


def _counted(docs: DataFrame, count) -> DataFrame:
    """(lang, phrase, n) over all texts of ``docs`` (lang, text): ``count`` gives the phrases of a block of texts of one
    language and how often each occurs there; Spark sums them, first in each task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        of = count()
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                mine = batch.column(1).take(pa.array(np.flatnonzero(langs.indices.to_numpy() == k)))
                for _, _, texts in text_blocks(mine, BLOCK):
                    for phrases, n in of(lang, Words(texts)):
                        yield pa.record_batch([pa.array([lang] * len(n), pa.string()), phrases, pa.array(n, pa.int64())], names=["lang", "phrase", "n"])

    return docs.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _words():
    """All words, and under null how many there are."""

    def of(lang: str, words: Words) -> Iterator[tuple[pa.Array, np.ndarray]]:
        yield words.distinct, np.bincount(words.ids, minlength=len(words.distinct))
        yield pa.array([None], pa.string()), np.array([len(words.ids)])

    return of


def _distinct(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of columns of small numbers, and how often each occurs."""
    key = columns[0]
    for c in columns[1:]:
        key = np.unique(key, return_inverse=True)[1] * (int(c.max(initial=0)) + 1) + c
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return [c[first] for c in columns], n


def _phrases(frequent, frontiers, pairs=None):
    """Phrases that begin or end with a word of the last frontier, neither with one of an earlier: pairs where ``pairs``
    is None, else those of three words and more whose pairs may all be frequent. Filters are broadcast.

    A filter lets some other words pass, always the same ones: such a word is in a frontier earlier than its count asks,
    which costs phrases that nobody needed and loses none.
    """

    def count():
        of_frequent, of_frontiers, of_pairs, now = frequent.value, [f.value for f in frontiers], pairs and pairs.value, len(frontiers)

        def of(lang: str, words: Words) -> Iterator[tuple[pa.Array, np.ndarray]]:
            hashes = word_hashes(lang, words.distinct.to_pylist())
            levels = np.where(held(of_frequent, hashes), OUTSIDE, RARE)
            for k in range(now, 0, -1):
                levels[(levels < RARE) & held(of_frontiers[k - 1], hashes)] = k
            ids, level = words.ids, levels[words.ids]
            # Between each word and the next: whether both can stand in one frequent phrase.
            link = words.follows[1:] & (np.maximum(level[1:], level[:-1]) < RARE)
            if of_pairs is not None:
                known = np.flatnonzero(link & (np.minimum(level[1:], level[:-1]) <= now))
                link[known] = held(of_pairs, pair_hashes(hashes[ids[known]], hashes[ids[known + 1]]))
            chain = np.ones(len(ids), bool)
            for m in range(2, MOST_WORDS + 1):
                chain = chain[:-1] & link[m - 2 :]
                if of_pairs is None and m > 2 or not chain.any():
                    return
                if of_pairs is not None and m == 2:
                    continue
                at = np.flatnonzero(chain & (np.minimum(level[: len(chain)], level[m - 1 :]) == now))
                columns, n = _distinct([ids[at + k] for k in range(m)])
                if len(n):
                    yield words.joined(columns), n

        return of

    return count


def scored(phrases: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score, first, last) of each (lang, phrase, n) of two words and more whose parts are all
    among ``phrases`` or ``words``; first and last are its end words' counts. Decimals hold the products."""
    of = phrases.select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("ws"))
    cuts = of.select("lang", "phrase", "a", F.size("ws").alias("m"), F.explode(F.sequence(F.lit(1), F.size("ws") - 1)).alias("k"), "ws")
    part = lambda at, size: F.array_join(F.slice("ws", at, size), " ")
    cuts = cuts.select("lang", "phrase", "a", "m", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("m") - F.col("k")).alias("right"))
    parts = words.unionByName(phrases.select("lang", "phrase", "n"))
    both = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"]).join(parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    both = both.join(F.broadcast(totals), "lang").withColumn("score", F.expr("cast(1000 AS decimal(5,0)) * cast(a AS decimal(14,0)) * cast(n AS decimal(19,0)) div (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))"))
    worst = both.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("a").alias("a"), F.first("n").alias("n"), F.first("m").alias("m"), F.count("*").alias("cuts"),
        F.max(F.when(F.col("k") == 1, F.col("l"))).alias("first"), F.max(F.when(F.col("k") == F.col("m") - 1, F.col("r"))).alias("last"),
    )
    return worst.where("cuts = m - 1").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score", "first", "last")


def longest(phrases: DataFrame, percent: int = 100) -> DataFrame:
    """(lang, phrase) of those that a phrase one word longer holds in ``percent`` of their occurrences or more. Counts
    fall as phrases grow, so a phrase held by any longer one is held by one that is one word longer."""
    size = F.size(F.split("phrase", " "))
    inner = F.explode(F.array(F.expr("substring(phrase, instr(phrase, ' ') + 1)"), F.expr("substring(phrase, 1, length(phrase) - instr(reverse(phrase), ' '))")))
    held = phrases.where(size > 2).select("lang", inner.alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    return phrases.join(held, ["lang", "phrase"]).where(F.col("longer") * 100 >= F.col("n") * percent).select("lang", "phrase")


def collocations(df: DataFrame, least: int = 100, top: int = 2000, percent: int = 100, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each language's ``top`` phrases: (lang, rank, phrase, a, l, r, n, score), by score, then a, then the phrase's bytes.

    A-Z is lower-cased; pieces end at ``.,;:!?`` and line ends, words at spaces and tabs; a phrase keeps within a piece,
    its overlapping occurrences all count, and it occurs ``least`` times. Phrases that a longer one holds in ``percent``
    of their occurrences are dropped (whether or not that one is). Null texts count as empty and a null language as
    ``und``; repeated rows count again; other columns aren't read; an empty table gives an empty result.

    A language's count of words, its frontier and its lowest score are on the driver; nothing else of the corpus is.
    """
    spark = df.sparkSession
    share = spark.sparkContext.broadcast
    rounds = Rounds(spark)
    docs = df.select(F.coalesce(df[lang_col], F.lit("und")).alias("lang"), df[text_col].alias("text"))
    counts = rounds.put(_counted(docs, _words).where((F.col("n") >= least) | F.col("phrase").isNull()))
    words, totals = counts.where("phrase IS NOT NULL"), counts.where("phrase IS NULL").select("lang", "n")
    total = {r["lang"]: r["n"] for r in totals.collect()}
    most = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.max("n").alias("n")).collect()}
    frequent = share(bit_filter(hashed(words, 1)))
    frontier, open_, filters, found = dict.fromkeys(most, 0), {lang: FIRST * least for lang in most}, [], []
    phrases = survivors = None
    while open_:
        bounds = spark.createDataFrame([(lang, frontier[lang], to) for lang, to in open_.items()], "lang string, above long, upto long")
        frontier |= open_
        new = words.join(F.broadcast(bounds), "lang").where("n > above AND n <= upto")
        filters.append(share(bit_filter(hashed(new, 1))))
        mine = docs.where(F.col("lang").isin(list(open_)))
        found.append(rounds.put(_counted(mine, _phrases(frequent, filters)).where(F.col("n") >= least)))
        pairs = share(bit_filter(hashed(_all(found).where(F.size(F.split("phrase", " ")) == 2), 2)))
        found.append(rounds.put(_counted(mine, _phrases(frequent, filters, pairs)).where(F.col("n") >= least)))
        phrases = _all(found)
        reached = spark.createDataFrame(list(frontier.items()), "lang string, upto long")
        inside = scored(phrases, words, totals).join(F.broadcast(reached), "lang").where("first <= upto AND last <= upto")
        survivors = inside.join(longest(phrases, percent), ["lang", "phrase"], "left_anti")
        by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        survivors = rounds.put(survivors.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top))
        lowest = {r["lang"]: r["score"] for r in survivors.groupBy("lang").agg(F.count("*").alias("k"), F.min("score").alias("score")).where(F.col("k") >= top).collect()}
        open_ = _widened(lowest, frontier, total, most)
    if survivors is None:
        return spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    return rounds.only(survivors.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def _all(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _widened(lowest: dict[str, int], frontier: dict[str, int], total: dict[str, int], most: dict[str, int]) -> dict[str, int]:
    """The next frontier of each language whose last place isn't settled: words outside could still reach its score."""
    out = {}
    for lang, at in frontier.items():
        want = at * GROWTH if lang not in lowest else 1000 * total[lang] // lowest[lang] if lowest[lang] else most[lang]
        if at < min(want, most[lang]):
            out[lang] = min(want, most[lang])
    return out


#: All phrases counted and scored at once: the same result by another way.
ORACLE = """
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
split AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS ws FROM pieces),
windows AS (SELECT lang, m, unnest(list_transform(range(0, len(ws) - m + 1), lambda i: array_to_string(ws[i + 1:i + m], ' '))) AS phrase FROM split, range(1, 6) r(m) WHERE len(ws) >= m),
totals AS (SELECT lang, count(*) AS n FROM windows WHERE m = 1 GROUP BY 1),
counts AS (SELECT lang, m, phrase, count(*) AS f FROM windows GROUP BY 1, 2, 3 HAVING count(*) >= 100),
cuts AS (SELECT lang, phrase, m, f, k, array_to_string(string_split(phrase, ' ')[:k], ' ') AS lp, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rp FROM counts, range(1, 5) r(k) WHERE k < m),
scores AS (SELECT c.lang, c.phrase, c.f AS a, l.f AS l, r.f AS r, n, k, (1000::HUGEINT * c.f * n // (l.f::HUGEINT * r.f))::BIGINT AS score FROM cuts c JOIN totals USING (lang) JOIN counts l ON l.lang = c.lang AND l.phrase = lp JOIN counts r ON r.lang = c.lang AND r.phrase = rp),
worst AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scores),
inner_parts AS (SELECT lang, array_to_string(string_split(phrase, ' ')[i:i + s - 1], ' ') AS phrase, f FROM counts, range(2, 5) q(s), range(1, 5) p(i) WHERE s < m AND i + s - 1 <= m),
held AS (SELECT lang, phrase, max(f) AS longer FROM inner_parts GROUP BY 1, 2)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM worst LEFT JOIN held USING (lang, phrase) WHERE place = 1 AND (longer IS NULL OR longer < a) QUALIFY rank <= 2000
"""
