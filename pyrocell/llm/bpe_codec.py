"""BPE encoding by backtracking over longest matches, and decoding by an offset table."""

from __future__ import annotations

import functools
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrocell.llm import bpe
from pyrocell.llm import pieces as P


class Decoder:
    """All tokens' bytes in one array, with the place where each begins."""

    def __init__(self, path: str):
        vocab = bpe.vocabulary(path)
        whole = bpe.read_spec(path)
        spec, of_id = whole["decoder"], {i: t for t, i in (whole["model"]["vocab"] | vocab.specials).items()}
        self.bytes_out = spec is not None and spec["type"] == "ByteLevel"
        to_byte = {c: b for b, c in enumerate(vocab.by_byte)}
        names = [of_id.get(i, "") for i in range(max(of_id) + 1)]
        special = set(vocab.specials.values())
        if self.bytes_out:
            rows = [n.encode() if i in special else bytes(to_byte[c] for c in n) for i, n in enumerate(names)]
        else:  # without a decoder, names stand apart by a space
            rows = [n.encode() + b" " for n in names]
        self.pool = P.Pool(np.uint8)
        self.pool.extend(rows)

    def texts(self, ids: np.ndarray, stop: np.ndarray) -> list[str]:
        """ids of many texts, one after another; where each text's ids end."""
        flat, ends = self.pool.gather(ids)
        ends = np.concatenate([[0], ends])[stop]
        data, out, a = flat.tobytes(), [], 0
        for b in ends.tolist():
            out.append(data[a : b if self.bytes_out or a == b else b - 1].decode("utf-8", "replace"))
            a = b
        return out


@functools.lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def _list_array(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """For each row its id and ``ids`` array<int>, exactly the merges' result; with ``decoded`` also those ids' text.

    Special strings inside a text become their ids. A null text counts as empty (no ids); repeated rows and null ids
    are kept row by row; an empty table gives an empty result; other columns aren't read. No shuffle; batches leave a
    worker in blocks of about a quarter of a million characters.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        codes = bpe.piece_codes(path)
        for batch in batches:
            for a, b, texts in P.text_blocks(batch.column(1)):
                parts = [np.asarray(x, np.int32) for x in codes.ids_of(texts)]
                arrays = [batch.column(0).slice(a, b - a), _list_array(parts)]
                if decoded:
                    flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
                    arrays.append(pa.array(decoder(path).texts(flat, np.cumsum([len(p) for p in parts])), pa.string()))
                yield pa.record_batch(arrays, names=["id", "ids", "decoded"][: len(arrays)])

    rows = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, ids array<int>" + ", decoded string" * decoded)
    return out.withColumnRenamed("id", id_col)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """For each row its id and ``text``: the tokens of its ids.

    Null or no ids give an empty text; repeated rows and null row ids are kept row by row; an empty table gives an
    empty result; other columns aren't read; ids that the vocabulary hasn't are an error. No shuffle.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        of = decoder(path)
        for batch in batches:
            parts = [np.array(x or [], np.int64) for x in batch.column(1).to_pylist()]
            flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.record_batch([batch.column(0), pa.array(of.texts(flat, np.cumsum([len(p) for p in parts], dtype=np.int64)), pa.string())], names=["id", "text"])

    rows = df.select(df[id_col].alias("id"), df[ids_col].alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def digests(encoded: DataFrame) -> DataFrame:
    """``n_tokens`` and the SHA-256 of the ids as text and of the decoded text."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
