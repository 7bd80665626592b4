"""Token counts by a transducer compiled from the merges.

States are what the future of a word can depend on: its longest ending that some token still continues, and for each
position in it the last token there and the number of tokens so far. Every transition is annotated with the tokens it
adds (fewer than none where letters merge). States are made as texts need them. White space brings any state back to
the first one, so what a chunk of a text does to *every* state is told by three things: the letters before its first
white space, the count between, and the letters after its last. Such maps compose associatively; the chunks of a long
text are folded in a balanced tree, each level counted in one batch.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrocell.llm import bpe
from pyrocell.llm import pieces as P
from pyrocell.llm.common import heavy, kept

WHITE = re.compile("[" + "".join(map(chr, P.SPACES)) + "]")
#: Texts that are counted together, so many bytes or one text.
BLOCK_BYTES = 1 << 20
#: Longer texts are cut into chunks of so many code points; a text's maps are composed so many at a time.
CHUNK_CHARS, FAN = 1 << 16, 64
#: Long rows of one text, at least, before its count is broadcast to them (those of a thousandth of all, or more).
REPEATED = 1000


class Transducer:
    """letters -> number of tokens. ``most`` states at a time; then they are made anew."""

    def __init__(self, vocab: bpe.Vocabulary, most: int = 300_000):
        self.vocab, self.most = vocab, most
        self.open = {t[:k] for t in vocab.id for k in range(1, len(t))}
        self._clear()

    def _clear(self):
        self.number = {("", (None,), (0,)): 0}
        self.states = list(self.number)
        self.moves: list[dict[str, tuple[int, int]]] = [{}]

    def _move(self, state: int, letter: str) -> tuple[int, int]:
        ending, lasts, counts = self.states[state]
        ending += letter
        for k in range(len(ending)):
            token = ending[k:]
            if token in self.vocab.id and (lasts[k] is None or self.vocab.fits(lasts[k], token)):
                break
        else:
            raise ValueError(f"{letter!r} isn't in this vocabulary")
        added = counts[k] + 1
        lasts, counts = (*lasts, token), [*(c - added for c in counts), 0]
        cut = next((c for c in range(len(ending)) if ending[c:] in self.open), len(ending))
        new = (ending[cut:], lasts[cut:], tuple(counts[cut:]))
        to = self.number.get(new)
        if to is None:
            to = self.number[new] = len(self.states)
            self.states.append(new)
            self.moves.append({})
        self.moves[state][letter] = (to, added)
        return to, added

    def count(self, piece: bytes) -> int:
        if len(self.states) > self.most:
            self._clear()
        state = total = 0
        moves = self.moves
        for letter in self.vocab.word(piece):
            to = moves[state].get(letter)
            state, added = self._move(state, letter) if to is None else to
            total += added
        return total


class Counter:
    """Counts of many texts at once; each distinct piece goes through the transducer once while it is remembered."""

    def __init__(self, vocab: bpe.Vocabulary):
        self.transducer = Transducer(vocab)
        self.codes = bpe.PieceCodes(vocab, None)
        self.codes.table.add = self._add
        self.counts = np.zeros(1 << 12, np.int64)

    def _add(self, pieces, first):
        if pieces is None:
            return
        while first + len(pieces) > len(self.counts):
            self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
        self.counts[first : first + len(pieces)] = [self.transducer.count(p) for p in pieces]

    def totals(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        for a, b in P.blocks(texts):
            ready, cut = self.codes.prepared(texts[a:b])
            entry, until = self.codes.entries(ready)
            run = np.concatenate([[0], np.cumsum(self.counts[entry])])[until]
            part = np.diff(run, prepend=0).tolist()
            for i, parts in cut.items():
                part[i] = sum(1 if isinstance(x, int) else self.totals([x])[0] for x in parts)
            out += part
        return out


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(bpe.vocabulary(path))


@dataclass(frozen=True)
class ChunkMap:
    """What a chunk does to any state: ``head`` goes on from it; after white space ``count``; ``tail`` stays open.

    Without white space the whole chunk is ``head`` and ``tail`` is None.
    """

    head: str
    count: int = 0
    tail: str | None = None


def chunk_maps(chunks: list[str], totals) -> list[ChunkMap]:
    spans = []
    for c in chunks:
        first = WHITE.search(c)
        last = first and len(c) - 1 - WHITE.search(c[::-1]).start()
        spans.append((first.start(), last) if first else None)
    counts = iter(totals([c[s[0] : s[1]] for c, s in zip(chunks, spans, strict=True) if s]))
    return [ChunkMap(c[: s[0]], next(counts), c[s[1] + 1 :]) if s else ChunkMap(c) for c, s in zip(chunks, spans, strict=True)]


def compose(pairs: list[tuple[ChunkMap, ChunkMap]], totals) -> list[ChunkMap]:
    """Each pair as one map; what meets between two of them is counted in one batch."""
    between = iter(totals([a.tail + b.head for a, b in pairs if a.tail is not None and b.tail is not None]))
    out = []
    for a, b in pairs:
        if a.tail is None:
            out.append(ChunkMap(a.head + b.head, b.count, b.tail))
        elif b.tail is None:
            out.append(ChunkMap(a.head, a.count, a.tail + b.head))
        else:
            out.append(ChunkMap(a.head, a.count + next(between) + b.count, b.tail))
    return out


def folded(maps: list[list[ChunkMap]], totals) -> list[ChunkMap]:
    """The maps of each text folded in a balanced tree, all texts level by level."""
    while any(len(m) > 1 for m in maps):
        pairs = [(m[k], m[k + 1]) for m in maps for k in range(0, len(m) - 1, 2)]
        joined = iter(compose(pairs, totals))
        maps = [[next(joined) for _ in range(0, len(m) - 1, 2)] + m[len(m) - len(m) % 2 :] for m in maps]
    return [m[0] for m in maps]


def count_texts(texts: list[str], path: str, chunk_chars: int = CHUNK_CHARS) -> list[int]:
    """The number of tokens of each text, without special tokens of its own: chunked and composed as in the jobs."""
    of = counter(path).totals
    maps = folded([chunk_maps([t[k : k + chunk_chars] for k in range(0, len(t), chunk_chars) or (0,)], of) for t in texts], of)
    return closed(maps, of)


def closed(maps: list[ChunkMap], totals) -> list[int]:
    """The tokens of whole texts: what is open at their ends ends there."""
    ends = iter(totals([x for m in maps for x in (m.head, m.tail or "")]))
    return [m.count + next(ends) + next(ends) for m in maps]


def _maps(pdf: pd.DataFrame) -> list[ChunkMap]:
    return [ChunkMap(h, c, t) for h, c, t in zip(pdf["head"], pdf["count"].tolist(), pdf["tail"].where(pdf["tail"].notna(), None), strict=True)]


MAP = "head string, count long, tail string"


def long_maps(rows: DataFrame, path: str, chunk_chars: int) -> DataFrame:
    """(id, n_bytes, key, k, head, count, tail): the map of chunk ``k`` of each of ``rows`` (id, n_bytes, text).

    ``key`` tells texts apart. The task that reads a text only cuts it; its chunks are dealt to all tasks.
    """
    kind = rows.schema["id"].dataType.simpleString()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for a, _, texts in P.text_blocks(batch.column("text"), 1):  # one text at a time
                for first in range(0, len(texts[0]), FAN * chunk_chars):
                    at = range(first, min(len(texts[0]), first + FAN * chunk_chars), chunk_chars)
                    same = [batch.column(c).slice(a, 1).take(pa.array([0] * len(at))) for c in ("id", "n_bytes", "key")]
                    yield pa.record_batch([*same, pa.array([x // chunk_chars for x in at], pa.int64()), pa.array([texts[0][x : x + chunk_chars] for x in at])], names=["id", "n_bytes", "key", "k", "chunk"])

    def mapped(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for a, b, chunks in P.text_blocks(batch.column("chunk"), BLOCK_BYTES):
                maps = chunk_maps(chunks, counter(path).totals)
                parts = [pa.array([m.head for m in maps]), pa.array([m.count for m in maps], pa.int64()), pa.array([m.tail for m in maps], pa.string())]
                yield pa.record_batch([batch.column(c).slice(a, b - a) for c in ("id", "n_bytes", "key", "k")] + parts, names=["id", "n_bytes", "key", "k", "head", "count", "tail"])

    keyed = rows.select("id", "n_bytes", F.sha2("text", 256).alias("key"), "text")
    chunks = keyed.mapInArrow(cut, f"id {kind}, n_bytes long, key string, k long, chunk string").hint("rebalance")
    return chunks.mapInArrow(mapped, f"id {kind}, n_bytes long, key string, k long, {MAP}")


def scanned(maps: DataFrame, path: str) -> DataFrame:
    """(key, n_tokens) of whole texts from the maps of their chunks, composed FAN at a time in ever fewer rows.

    Chunks of repeated texts are made one before they meet, so no group has more than FAN rows.
    """
    last = maps.agg(F.max("k")).first()[0] or 0

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        m = folded([_maps(pdf.sort_values("k"))], counter(path).totals)[0]
        return pd.DataFrame({"key": pdf["key"].iloc[:1], "k": pdf["k"].iloc[:1] // FAN, "head": [m.head], "count": [m.count], "tail": [m.tail]})

    level = maps.groupBy("key", "k").agg(F.first(F.struct("head", "count", "tail")).alias("m")).select("key", "k", "m.*")
    while last:
        level = level.groupBy("key", F.expr(f"k div {FAN}")).applyInPandas(joined, f"key string, k long, {MAP}")
        last //= FAN

    def ended(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"key": pdf["key"], "n_tokens": closed(_maps(pdf), counter(path).totals)})

    return level.mapInPandas(ended, "key string, n_tokens long")


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """For each row its id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (n_tokens > limit).

    A null text counts as empty (no tokens); an empty table gives an empty result; repeated rows and null ids are kept
    row by row; other columns aren't read, whatever their names. Texts of one chunk take one pass of Arrow batches, cut
    into blocks of about a million bytes, and no shuffle. Longer ones are read in a second pass and shuffled once, chunk
    by chunk; then only maps move, whose size follows the words at the chunks' ends. So a task's memory follows the
    longest text where it is cut, and chunks (or the longest word) where it is counted.
    """
    if not counter(path).codes.vocab.suffix:
        raise ValueError("chunks need a vocabulary whose words end at white space")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in P.text_blocks(batch.column(2), BLOCK_BYTES):
                n = pa.array(counter(path).totals(texts), pa.int64())
                yield pa.record_batch([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), n], names=["id", "n_bytes", "n_tokens"])

    rows = df.select(df[id_col].alias("id"), F.coalesce(F.octet_length(df[text_col]), F.lit(0)).cast("long").alias("n_bytes"), df[text_col].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    is_long = F.coalesce(F.length("text"), F.lit(0)) > chunk_chars
    out = rows.where(~is_long).mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    maps = kept(long_maps(rows.where(is_long), path, chunk_chars))
    long = maps.where("k = 0").select("id", "n_bytes", "key")
    total = long.count()
    if total:
        counts = kept(scanned(maps, path))
        often = heavy(long, "key", total, REPEATED).select("key")  # a thousand texts at most
        known = F.broadcast(counts.join(often, "key", "left_semi"))
        found = long.join(known, "key").unionByName(long.join(often, "key", "left_anti").join(counts, "key"))
        out = out.unionByName(found.select("id", "n_bytes", "n_tokens"))
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
