"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyrocell.llm import bpe_codec, chat, fingerprints, jaccard_join, neighbours, packing, personal_data, phrases, quality, secret_scan, spelling, token_counts, url_filter
from pyrocell.llm.common import read


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_filter.SITE_RULES + [url_filter.Rule("block", word=w) for w in url_filter.BLOCKED_WORDS]
    return url_filter.judge(read(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(read(spark, sf_dir, "documents")))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=1)


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read(spark, sf_dir, "embeddings"), every=100, k=10)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.formatted(*chat.exchanges(read(spark, sf_dir, "conversations")), chat.REPLY)


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_probe(read(spark, sf_dir, "documents"))


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.digests(bpe_codec.encode(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), decoded=True))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(read(spark, sf_dir, "documents"), n=4, percent=85)


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digests(personal_data.scan(read(spark, sf_dir, "documents")))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.groups(spelling.vocabulary(read(spark, sf_dir, "documents"), every=97, least_length=5, least_count=3), ratio=2)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"), least=100, top=2000, percent=100)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ten = (op1_url_filter, op2_token_counts, op3_secret_scan, op4_packing, op5_neighbours, op6_quality, op7_chat, op8_fingerprints, op9_bpe_codec, op10_ngram_jaccard)
    return {f.__name__: f for f in (*ten, op11_personal_data, op12_spelling_variants, op13_collocations)}


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": url_filter.ORACLE, "op7_chat": chat.ORACLE, "op12_spelling_variants": spelling.ORACLE, "op13_collocations": phrases.ORACLE}
