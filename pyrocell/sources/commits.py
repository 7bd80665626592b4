"""Tables that many batches add to while they are read: parts, and a log of commits that says which parts count.

A part is a folder of its own, ``parts/<writer>-<n>``; a commit is one file that names it. A part counts once its commit
is there, which is one file's renaming, so a reader that takes the log's commits sees whole parts only, and what it took
doesn't change under it. Folding writes one part of all that count and commits it together with the last batch folded of
each writer: parts up to that no longer count, also if such a batch is replayed. Commits of different writers don't meet,
so batches and folding need no lock; folding itself is one job at a time. Folded parts stay until ``vacuum``, for readers
that still hold them; the log is small, one row for each batch since the last folding and ``vacuum``.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ``folded``: for each writer the last of its batches that the part holds; empty for a batch's own commit.
COMMIT = "writer string, n long, at timestamp, folded map<string, long>"


def writer_of(checkpoint: str) -> str:
    """A query's name in the log."""
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:16]


def _commit(spark: SparkSession, path: str, writer: str, n: int, folded: dict[str, int]) -> None:
    row = spark.range(1).select(F.lit(writer).alias("writer"), F.lit(n).cast("long").alias("n"), F.current_timestamp().alias("at"), F.lit(None).cast("map<string, long>").alias("folded"))
    if folded:
        row = row.withColumn("folded", F.create_map(*[F.lit(x) for w, k in folded.items() for x in (w, k)]).cast("map<string, long>"))
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/log/{writer}-{n}")


def _folder(spark: SparkSession, path: str):
    """A folder, and the file system that it is in, whichever store that is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    folder, system = _folder(spark, path)
    return system.exists(folder)


def log(spark: SparkSession, path: str) -> DataFrame:
    """All commits that are still in the log."""
    if not _exists(spark, f"{path}/log"):
        return spark.createDataFrame([], COMMIT)
    return spark.read.schema(COMMIT).option("recursiveFileLookup", True).parquet(f"{path}/log")


def _counting(spark: SparkSession, path: str) -> list:
    """The commits whose parts count: one for each batch since the last folding, and that of the folding."""
    rows = log(spark, path).collect()
    folded: dict[str, int] = {}
    for r in rows:
        for w, k in (r["folded"] or {}).items():
            folded[w] = max(folded.get(w, -1), k)
    return [r for r in rows if r["n"] > folded.get(r["writer"], -1)]


def add(df: DataFrame, path: str, writer: str, n: int, by: list[str]) -> None:
    """``df`` as batch ``n`` of a writer, in folders by ``by``. A batch that runs again replaces its own part, unless that
    has been committed: then it is whole, and nothing is written."""
    if _exists(df.sparkSession, f"{path}/log/{writer}-{n}/_SUCCESS"):
        return
    df.write.mode("overwrite").partitionBy(*by).parquet(f"{path}/parts/{writer}-{n}")
    _commit(df.sparkSession, path, writer, n, {})


def snapshot(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all parts that count now. A table without commits that count has none."""
    return _of_parts(spark, path, schema, _counting(spark, path))


def _of_parts(spark: SparkSession, path: str, schema: str, commits: list) -> DataFrame:
    out = spark.createDataFrame([], schema)
    read = [spark.read.schema(schema).parquet(f"{path}/parts/{r['writer']}-{r['n']}") for r in commits]
    for df in read:
        out = out.unionByName(df)
    return out


def fold(spark: SparkSession, path: str, schema: str, by: list[str], merge: Callable[[DataFrame], DataFrame]) -> None:
    """One part of all that count, merged; batches that come meanwhile stay beside it."""
    commits = _counting(spark, path)
    last: dict[str, int] = {}
    for r in commits:
        last[r["writer"]] = max(last.get(r["writer"], -1), r["n"])
    for r in commits:
        for w, k in (r["folded"] or {}).items():
            last[w] = max(last.get(w, -1), k)
    name = f"folded-{uuid.uuid4().hex}"
    merge(_of_parts(spark, path, schema, commits)).repartition(*by).write.partitionBy(*by).parquet(f"{path}/parts/{name}-0")
    _commit(spark, path, name, 0, last)


def vacuum(spark: SparkSession, path: str) -> int:
    """Deletes the parts, and their commits, that no longer count, for when no reader holds them: how many parts. What has
    been folded is in the folding's own commit, so a replay of such a batch still changes nothing."""
    live = {f"{r['writer']}-{r['n']}" for r in _counting(spark, path)}
    n = 0
    for kind in ("log", "parts"):
        folder, system = _folder(spark, f"{path}/{kind}")
        dead = [s.getPath() for s in system.listStatus(folder) if s.getPath().getName() not in live]
        for p in dead:
            system.delete(p, True)
        n = len(dead)
    return n
