"""Document fingerprints: a homomorphic hash of the multiset of paragraphs.

Each paragraph is hashed to a wide vector; a document's fingerprint is their sum, lane by lane modulo a power of two.
So paragraphs can be added or taken away without the others, and their order doesn't matter. A vector has two parts:

* 8 lanes modulo 2^64 from a cryptographic hash of the paragraph: equal fingerprints, equal multisets;
* 256 lanes modulo 2^16 in which every three words of the paragraph add +1 or -1 to one lane. The squared distance of
  two fingerprints there estimates how many such triples differ, which gives the likeness.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrocell.llm import pieces as P

EXACT, LIKE, WORDS = 8, 256, 3
_MUL = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


#: Bytes that are hashed at once; the tables of powers are as long.
SEGMENT = 1 << 18


@functools.cache
def _powers() -> list[np.ndarray]:
    """Powers of the base modulo 2^64, and of its inverse; one table for each worker."""
    out = []
    for factor in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(SEGMENT + 1, factor, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of UTF-8 bytes begin and end, and a 64-bit hash of each: a polynomial of its bytes, mixed.

    Words are hashed a segment at a time; one longer than a segment is summed over its parts.
    """
    edge = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[data], [True]])))
    start, stop = edge[0::2], edge[1::2]
    up, down = _powers()
    out, k = np.empty(len(start), np.uint64), 0
    while k < len(start):
        end = max(k + 1, int(np.searchsorted(stop, start[k] + SEGMENT, side="right")))
        if stop[k] - start[k] > SEGMENT:
            total, scale = 0, 1
            for a in range(start[k], stop[k], SEGMENT):
                part = data[a : min(a + SEGMENT, stop[k])].astype(np.uint64) + np.uint64(1)
                total += int((part * up[: len(part)]).sum(dtype=np.uint64)) * scale
                scale = scale * pow(_BASE, SEGMENT, 1 << 64) % (1 << 64)
            out[k] = total % (1 << 64)
        else:
            first = start[k]
            run = np.zeros(stop[end - 1] - first + 1, np.uint64)
            run[1:] = data[first : stop[end - 1]]
            run[1:] += np.uint64(1)
            run[1:] *= up[: len(run) - 1]
            np.cumsum(run[1:], out=run[1:])
            out[k:end] = (run[stop[k:end] - first] - run[start[k:end] - first]) * down[start[k:end] - first]
        k = end
    return start, stop, mixed(out)


def vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The two parts of every text's fingerprint, as unsigned lanes; empty texts have no paragraphs."""
    return paragraph_vectors([t.split("\n") if t else [] for t in texts])


def paragraph_vectors(split: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """The same of lists of paragraphs."""
    texts = split
    exact, like = np.zeros((len(texts), EXACT), np.uint64), np.zeros((len(texts), LIKE), np.uint16)
    counts = np.array([len(p) for p in split], np.int64)
    paragraphs = [p.encode() for ps in split for p in ps]
    if not paragraphs:
        return exact, like
    digests = b"".join([hashlib.blake2b(p).digest() for p in paragraphs])
    full = np.flatnonzero(counts)
    exact[full] = np.add.reduceat(np.frombuffer(digests, "<u8").reshape(-1, EXACT), (np.cumsum(counts) - counts)[full], axis=0)
    sizes = np.fromiter(map(len, paragraphs), np.int64, len(paragraphs)) + 1
    owner = np.repeat(np.arange(len(texts)), counts)
    start, _, h = word_hashes(np.frombuffer(b"\n".join(paragraphs) + b"\n", np.uint8))
    if not len(start):
        return exact, like
    ends = np.cumsum(sizes)
    paragraph = np.searchsorted(ends, start, side="right")
    n = len(h)
    run = h * np.uint64(3)
    same = np.ones(n, bool)
    for k in range(1, WORDS):  # shorter where the paragraph is shorter
        follows = np.zeros(n, bool)
        follows[: n - k] = paragraph[k:] == paragraph[:-k]
        shifted = np.zeros(n, np.uint64)
        shifted[: n - k] = h[k:]
        run = np.where(follows, mixed(run * _MUL + shifted), run)
        same &= follows
    first = np.concatenate([[True], paragraph[1:] != paragraph[:-1]])
    use = same | first
    g = mixed(run[use])
    lane = owner[paragraph[use]] * LIKE + (g & np.uint64(LIKE - 1)).astype(np.int64)
    sign = np.where(g >> np.uint64(63), 1.0, -1.0)
    sums = np.bincount(lane, sign, len(texts) * LIKE).astype(np.int64)
    return exact, (sums & 0xFFFF).astype(np.uint16).reshape(len(texts), LIKE)


def add(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], sign: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Paragraphs put in (sign 1) or taken out (-1): fingerprints are sums."""
    return (a[0] + b[0], a[1] + b[1]) if sign > 0 else (a[0] - b[0], a[1] - b[1])


def replaced(own: tuple[np.ndarray, np.ndarray], texts: list[str], changed: list[str], same: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the changed texts from those of the texts, which begin with the same so many characters: the
    paragraphs after these are taken out and those of the changed text put in, the others aren't touched."""
    out, put = [], []
    for t, c, n in zip(texts, changed, same, strict=True):
        at = t.rfind("\n", 0, n) + 1 if t and c else 0  # the paragraph in which they may part
        out.append(t[at:].split("\n") if t else [])
        put.append(c[at:].split("\n") if c else [])
    return add(add(own, paragraph_vectors(out), -1), paragraph_vectors(put))


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Row by row: 1 where the fingerprints are equal, else 1 - |a-b|^2 / (|a|^2 + |b|^2) of the second parts, 0 at least."""
    x, y, d = (v.astype(np.int16).astype(np.float64) for v in (a[1], b[1], a[1] - b[1]))
    size = (x * x).sum(axis=1) + (y * y).sum(axis=1)
    out = np.clip(1 - (d * d).sum(axis=1) / np.maximum(size, 1), 0, 1)
    out[size == 0] = 0
    return np.where((a[0] == b[0]).all(axis=1) & (a[1] == b[1]).all(axis=1), 1.0, out)


def as_text(v: tuple[np.ndarray, np.ndarray]) -> list[str]:
    return [e.tobytes().hex() + x.tobytes().hex() for e, x in zip(v[0].astype(">u8"), v[1].astype(">u2"), strict=True)]


def from_text(fingerprints: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(bytes.fromhex("".join(fingerprints)), np.uint8).reshape(len(fingerprints), EXACT * 8 + LIKE * 2)
    exact, like = data[:, : EXACT * 8].copy().view(">u8").astype(np.uint64), data[:, EXACT * 8 :].copy().view(">u2").astype(np.uint16)
    return exact, like


def fingerprint(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row its id and ``fingerprint``. Null texts count as empty; repeated rows and null ids are kept row by
    row; other columns aren't read; an empty table gives an empty result. No shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in P.text_blocks(batch.column(1)):
                yield pa.record_batch([batch.column(0).slice(a, b - a), pa.array(as_text(vectors(texts)), pa.string())], names=["id", "fingerprint"])

    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fingerprint string").withColumnRenamed("id", id_col)


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many (or all) of another text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


#: Rows of a bucket, which is one task: at most so many, however large the table. With larger ones there are fewer tasks.
ROWS_BY_BUCKET = 4000
_OUT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, times long"


def _sortable(k: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Pairs of numbers as strings of 16 bytes in the same order."""
    both = np.stack([np.asarray(k, np.int64), np.asarray(h, np.int64)], axis=1)
    return (both.view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").view("S16").ravel()


def _groups(rows: DataFrame, rows_by_bucket: int) -> pa.Table:
    """The order (k, h) cut into groups of at most ``rows_by_bucket`` rows, ascending: first and last (k, h) and n of
    each. A (k, h) with more rows is a group of its own, of several buckets. These few numbers for each bucket reach
    the driver, no text does."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        group: list[int] | None = None
        names = ["k", "h", "k1", "h1", "n"]
        for batch in batches:
            done = []
            for k, h, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and group[4] + n > rows_by_bucket:
                    done.append(group)
                    group = None
                group = [group[0], group[1], k, h, group[4] + n] if group else [k, h, k, h, n]
            yield pa.record_batch([pa.array([g[i] for g in done], pa.int64()) for i in range(5)], names=names)
        if group:
            yield pa.record_batch([pa.array([v], pa.int64()) for v in group], names=names)

    counts = rows.groupBy("k", "h").agg(F.count("*").alias("n"))
    found = counts.repartitionByRange("k", "h").sortWithinPartitions("k", "h").mapInArrow(cut, "k long, h long, k1 long, h1 long, n long").toArrow()
    return found.sort_by([("k", "ascending"), ("h", "ascending")])


def _bucketed(df: DataFrame, rows_by_bucket: int) -> tuple[DataFrame, int, bool]:
    """Rows (id, text, k, h, times, bucket, guest), how many buckets there are, and whether a row may stand for several.

    A bucket holds a range of (k, h), in falling order, and as guest what follows its last row: the head of the bucket
    below, after the lowest the highest. Rows of one id and text beyond a bucket's size are united first (map-side),
    and dealt as counts to buckets of their own; these have no guest but in the lowest, as each is followed by itself.
    """
    least = F.lit(-(1 << 63)).cast("long")
    rows = df.select("id", F.coalesce("text", F.lit("")).alias("text")).select("id", "text", F.coalesce(F.col("id").cast("long"), least).alias("k"), F.xxhash64("text").alias("h"))
    groups = _groups(rows, rows_by_bucket)
    if not len(groups):
        return rows.withColumns({"times": F.lit(1).cast("long"), "bucket": F.lit(0), "guest": F.lit(False)}), 1, False
    n = groups["n"].to_numpy()
    first, last = _sortable(groups["k"].to_numpy(), groups["h"].to_numpy()), _sortable(groups["k1"].to_numpy(), groups["h1"].to_numpy())
    buckets = np.where(n > rows_by_bucket, -(-n // rows_by_bucket), 1)
    base = np.cumsum(buckets) - buckets
    total, hot = int(buckets.sum()), bool((buckets > 1).any())

    @F.pandas_udf("base int, buckets int, above int")
    def place(k: pd.Series, h: pd.Series) -> pd.DataFrame:
        """The first bucket of a row and how many it has; the bucket above, if the row is the head of its own."""
        key = _sortable(k.to_numpy(), h.to_numpy())
        at = np.searchsorted(first, key, side="right") - 1
        above = pd.Series((base[at] + buckets[at]) % total).where(last[at] == key).astype("Int32")
        return pd.DataFrame({"base": base[at], "buckets": buckets[at], "above": above})

    rows = rows.withColumns({"p": place("k", "h"), "times": F.lit(1).cast("long")})
    spot = lambda bucket, guest: F.struct(bucket.cast("int").alias("bucket"), F.lit(guest).alias("guest"))
    guest = F.when(F.col("p.above").isNotNull(), spot(F.col("p.above"), True))
    columns = ["id", "text", "k", "h", "times", F.col("spot.bucket").alias("bucket"), F.col("spot.guest").alias("guest")]
    few = rows.where("p.buckets = 1") if hot else rows
    out = few.withColumn("spot", F.explode(F.array_compact(F.array(spot(F.col("p.base"), False), guest)))).select(*columns)
    if hot:
        united = rows.where("p.buckets > 1").groupBy("id", "text", "k", "h", "p").agg(F.count("*").alias("all"))
        spots = F.concat(F.transform(F.sequence(F.lit(0), F.col("p.buckets") - 1), lambda i: spot(F.col("p.base") + i, False)), F.array(spot(F.col("p.above"), True)))
        dealt = united.withColumn("spot", F.explode(spots))
        i = F.col("spot.bucket") - F.col("p.base")
        share = F.floor(F.col("all") * (i + 1) / F.col("p.buckets")) - F.floor(F.col("all") * i / F.col("p.buckets"))
        dealt = dealt.withColumn("times", F.when(F.col("spot.guest"), 1).otherwise(share).cast("long")).where("times > 0")
        out = out.unionByName(dealt.select(*columns))
    return out, total, hot


def edit_probe(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_by_bucket: int = ROWS_BY_BUCKET) -> DataFrame:
    """For each row: code points, fingerprint, and how like it is to its edited text and to the next document.

    The next document is that of the next smaller id (ties: by the text's hash; after the last: the first); ids are
    integers, null ids come last. A null text counts as empty. Repeated rows are kept, each followed by the next. A
    table of one row is followed by itself; an empty table gives an empty result; other columns aren't read. Texts are
    shuffled once, by ranges of (id, hash); a bucket has at most ``rows_by_bucket`` rows, whatever repeats (one more where
    null ids and the least number have one text).
    """
    rows, n, hot = _bucketed(df.select(df[id_col].alias("id"), df[text_col].alias("text")), rows_by_bucket)
    kind = df.schema[id_col].dataType.simpleString()
    dealt = rows.repartitionById(n, F.col("bucket")).sortWithinPartitions("bucket", "guest", F.desc("k"), F.desc("h"), "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        names = ["id", *(c.split()[0] for c in _OUT.split(", "))]
        waiting: list[tuple] = []

        def ready(rows: list[tuple], following: str) -> pa.RecordBatch:
            """The result for rows that follow each other, all of one bucket; ``following`` comes after the last."""
            texts = [t for _, t, _ in rows]
            after = [*texts[1:], following]
            changed = [edited(t, f) for t, f in zip(texts, after, strict=True)]
            own = vectors([*texts, following])
            mine, theirs = (own[0][:-1], own[1][:-1]), (own[0][1:], own[1][1:])
            new = replaced(mine, texts, changed, [len(t) - len(t) // 2 for t in texts])
            columns = [
                pa.array([i for i, _, _ in rows], id_type), pa.array(map(len, texts), pa.int64()), pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed], pa.string()),
                pa.array(as_text(mine), pa.string()), pa.array(as_text(new), pa.string()), pa.array(likeness(mine, new)), pa.array(likeness(mine, theirs)), pa.array([m for _, _, m in rows], pa.int64()),
            ]
            return pa.record_batch(columns, names=names)

        id_type, size, at = None, 0, None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for i, t, m, b, g in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if waiting and (b != at or g or size >= P.BLOCK_CHARS):  # the first guest closes its bucket; others are its ties
                    yield ready(waiting, t if b == at else waiting[-1][1])
                    waiting, size = [], 0
                if not g:
                    waiting += [(i, t, m - 1), (i, t, 1)] if m > 1 else [(i, t, 1)]  # each copy but the last is followed by itself
                    size += len(t)
                    at = b
        if waiting:
            yield ready(waiting, waiting[-1][1])

    out = dealt.select("id", "text", "times", "bucket", "guest").mapInArrow(run, f"id {kind}, {_OUT}")
    if hot:
        out = out.withColumn("times", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    return out.drop("times").withColumnRenamed("id", id_col)
