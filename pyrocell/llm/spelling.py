"""Spelling variants: words that differ by one inserted, deleted or replaced code point, by permuterm rotations.

A word with its terminator is rotated in every way, and all rotations of all words are sorted. Moving a word's edited
code point to its rotation's end makes what is left, the rest of the word around the terminator, a prefix:

* words that differ by a replaced code point have rotations with that prefix and one more code point each;
* a word that lacks the code point altogether has a rotation that is the prefix itself.

So every prefix range is a group of at most one code point each and one word, whatever the vocabulary: its size is
bounded by the alphabet. A scan of each group emits for each word how many neighbours it has there and the best of them;
no pair is made. Code points that repeat (``aab`` and ``ab``) would be met twice: only the first of a run counts as the
deleted one, so each pair of words meets in exactly one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyrocell.sources.shared import Rounds

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = r"[^A-Za-zÀ-ÿ]+"
#: Ends a word in its rotations; no word may hold it.
TERMINATOR = "\u0000"


def _lowered(word: Column) -> Column:
    """A-Z in lower case, other letters as they are; most words have none of either."""
    return F.when(F.lower(word) == word, word).otherwise(F.translate(word, UPPER, LOWER))


def vocabulary(df: DataFrame, every: int = 97, least_length: int = 5, least_count: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the runs of Latin letters, A-Z lower-cased, with ``least_length`` code points and ``least_count``
    occurrences at least.

    With h the CRC-32 of ``<id>:<run>``, a run for which ``every`` divides h lacks its code point h % length (None: no
    run is changed). Null texts have no words, a null id is written as nothing, repeated rows count again; other columns
    aren't read; an empty table gives an empty result. Counts are summed before they are shuffled.
    """
    rows = df.select(F.concat(F.coalesce(df[id_col].cast("string"), F.lit("")), F.lit(":")).alias("id"), F.explode(F.split(df[text_col], BREAKS)).alias("run"))
    runs = rows.where(F.length("run") >= least_length).select("id", _lowered(F.col("run")).alias("run"))
    if every:
        h, k = F.col("h"), (F.col("h") % F.length("run")).cast("int")
        shorter = F.concat(F.substring("run", F.lit(1), k), F.substring("run", k + 2, F.length("run")))
        runs = runs.withColumn("h", F.crc32(F.concat("id", "run").cast("binary"))).select(F.when(h % every == 0, shorter).otherwise(F.col("run")).alias("run")).where(F.length("run") >= least_length)
    return runs.groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, whole, first, word, n): every rotation of each word as a whole one, and as a prefix and its last code
    point; ``first`` says that this isn't the one before it in the word again. Sorted by prefix over all tasks."""
    at = words.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("i"))
    i, left, right = F.col("i"), F.substring("word", F.lit(1), F.col("i")), F.substring("word", F.col("i") + 1, F.length("word"))
    one = lambda k: F.substring("word", k, F.lit(1))
    whole = F.struct(F.concat(right, F.lit(TERMINATOR), left).alias("prefix"), F.lit(True).alias("whole"), F.lit(False).alias("first"))
    cut = F.struct(F.concat(right, F.lit(TERMINATOR), F.substring("word", F.lit(1), i - 1)).alias("prefix"), F.lit(False).alias("whole"), ((i == 1) | (one(i) != one(i - 1))).alias("first"))
    return at.select("word", "n", F.explode(F.when(i > 0, F.array(whole, cut)).otherwise(F.array(whole))).alias("r")).select("r.*", "word", "n").repartitionByRange("prefix")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n, n_near, best) for each (word, n): how many words are near, and the near one of largest n (ties: the
    smallest) as (n, word), null where none is.

    Words must be distinct and not null; one word alone, or no words, gives no neighbours. A group's best three are
    enough: a word's best is the first of these that is neither itself nor one that doesn't count for it.
    """
    group = Window.partitionBy("prefix")
    by = group.orderBy(F.desc("n"), "word").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    me = F.struct((-F.col("n")).alias("rank"), F.col("word").alias("word"))
    seen = rotations(words).select(
        "word", "n", "whole", "first",
        F.count("*").over(group).alias("size"), F.max("whole").over(group).alias("has_whole"), F.count(F.when(F.col("first"), 1)).over(group).alias("firsts"),
        F.min(F.when(F.col("first"), me)).over(group).alias("best_first"), *[F.nth_value(F.struct(me.alias("of"), "whole"), k).over(by).alias(f"best{k}") for k in (1, 2, 3)],
    ).where("size > 1")
    others = [F.when((F.col(f"best{k}.of.word") != F.col("word")) & (F.col("first") | ~F.col(f"best{k}.whole")), F.col(f"best{k}.of")) for k in (1, 2, 3)]
    near = F.when(F.col("whole"), F.col("firsts")).otherwise(F.col("size") - 1 - F.when(F.col("has_whole") & ~F.col("first"), 1).otherwise(0))
    found = seen.select("word", F.lit(None).cast("long").alias("n"), near.alias("near"), F.when(F.col("whole"), F.col("best_first")).otherwise(F.coalesce(*others)).alias("best")).where("near > 0")
    all_words = words.select("word", "n", F.lit(0).cast("long").alias("near"), F.lit(None).cast(found.schema["best"].dataType).alias("best"))
    out = all_words.unionByName(found).groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return out.select("word", "n", "n_near", F.when(F.col("best").isNotNull(), F.struct((-F.col("best.rank")).alias("n"), F.col("best.word").alias("word"))).alias("best"))


def groups(words: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each (word, n).

    The form is the best neighbour if it occurs ``ratio`` times as often or more (``ratio`` above 1); the root is where
    forms lead to. Pointers to forms are doubled, each round a written table: as n grows by the ratio with each step,
    a chain has at most 63 steps and 6 rounds follow it. Empty in, empty out.
    """
    rounds = Rounds(words.sparkSession)
    near = rounds.put(neighbours(rounds.put(words)))
    of = near.select("word", "n", "n_near", F.when(F.col("best.n") >= F.col("n") * ratio, F.col("best")).alias("best"))
    up = rounds.put(of.where("best IS NOT NULL").select("word", F.col("best.word").alias("root")))
    while True:
        next_up = up.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = rounds.put(up.join(next_up, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        up = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    out = of.join(up, "word", "left").select("word", F.col("best.word").alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near", F.col("best.n").alias("form_n"))
    return rounds.only(out)


#: CRC-32 table and bytes as lists, and neighbours by deleted positions: the same result by another way.
ORACLE = """
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS r FROM documents) WHERE length(r) >= 5 GROUP BY 1, 2),
hashed AS (SELECT run, c, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(concat(doc_id, ':', run), ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [(192 + (unicode(x) >> 6))::BIGINT, (128 + (unicode(x) & 63))::BIGINT] END))), lambda h, b: xor(t[(xor(h, b) & 255) + 1], h >> 8)), 4294967295) AS h FROM runs, crc),
words AS (SELECT word, sum(c)::BIGINT AS n FROM (SELECT CASE WHEN h % 97 = 0 THEN concat(substr(run, 1, h % length(run)), substr(run, h % length(run) + 2)) ELSE run END AS word, c FROM hashed) WHERE length(word) >= 5 GROUP BY 1 HAVING sum(c) >= 3),
cuts AS (SELECT word, n, i, concat(substr(word, 1, i), substr(word, i + 2)) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, min({'r': -other_n, 'w': other}) AS b FROM pairs GROUP BY 1),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.r >= 2 * w.n THEN b.w END AS form, CASE WHEN -b.r >= 2 * w.n THEN -b.r END AS form_n FROM words w LEFT JOIN best USING (word)),
ways AS (SELECT word, word AS at, form AS up FROM forms UNION ALL SELECT ways.word, forms.word, forms.form FROM ways JOIN forms ON ways.up = forms.word)
SELECT f.word, f.form, ways.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN ways ON f.word = ways.word AND ways.up IS NULL
"""
