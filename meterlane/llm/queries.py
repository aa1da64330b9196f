"""The registered queries of this subpackage, one for each operator, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from meterlane.llm import (
    crosstoken, frames, hosts, html, jaccard, lexical, licences, mixing, packing, pii, prepared, quality_rules, simhash, toxicity)

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_components(_table(spark, folder, "documents"), n=3, share=90)


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(_table(spark, folder, "documents"), licences.known_digests(spark))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op4_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return pii.replace_entities(docs, count_column="n_entities")


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, folder, "labels")))


def op6_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.main_text(_table(spark, folder, "pages"))


def op7_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.repetitions(_table(spark, folder, "documents"))


def op8_token_frames(spark: SparkSession, folder: str) -> DataFrame:
    return frames.read_rows(frames.write_files(_table(spark, folder, "documents"), VOCABULARY, end_id=2))


def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.report(_table(spark, folder, "documents"), radius=simhash.RADIUS)


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), VOCABULARY, end_id=0)


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return crosstoken.report(_table(spark, folder, "documents"), VOCABULARY, PIECES)


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op13_url_trust(spark: SparkSession, folder: str) -> DataFrame:
    return hosts.judge(_table(spark, folder, "pages"))


QUERIES = {f.__name__: f for f in (
    op1_jaccard_join, op2_license_scan, op3_quality_rules, op4_pii_surrogates,
    op5_toxicity, op6_main_text, op7_source_mix, op8_token_frames, op9_fingerprints, op10_packing,
    op11_token_alignment, op12_lexical_search, op13_url_trust)}
ORACLES = {"op2_license_scan": licences.SQL, "op7_source_mix": mixing.SQL, "op12_lexical_search": lexical.SQL, "op13_url_trust": hosts.SQL}
