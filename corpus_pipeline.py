"""The corpus pipeline: toxicity, near duplicates, personal data, source mix, packing.

``STAGES`` are (name, function); each function takes (spark, docs, sf_dir) and returns the
next stage's documents, the last one the packed pieces. ``run`` writes each stage's result
to the shared folder and reads it again, so a lost executor costs no more than its stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlane.llm import jaccard, mixing, packing, pii, prepared, toxicity
from meterlane.llm.queries import VOCABULARY
from meterlane.session import materialize


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic; null and empty texts stay."""
    labels = prepared(spark).read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels)
    return docs.filter(toxicity.score_column(model) < 0.5)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    prepared(spark)
    return jaccard.one_of_each(docs, n=5, share=80)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with surrogates for personal data; n_chars follows the text."""
    prepared(spark)
    replaced = pii.replace_entities(docs)
    if "n_chars" not in docs.columns:
        return replaced
    return replaced.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; whole ones, so no text is cut. Texts without
    words have nothing to take and go."""
    prepared(spark)
    rows = docs.select("doc_id", "text", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    taken = mixing.repetitions(rows, whole_documents=True, keep=("row",)).filter("size > 0")
    times = F.array_repeat(F.lit(0), (F.col("taken") / F.col("size")).cast("int"))
    return taken.select("row", F.explode(times)).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    prepared(spark)
    return packing.pack(docs, VOCABULARY, end_id=0)


STAGES = [("toxicity", reject_toxic), ("near_duplicates", one_per_group), ("personal_data", replace_personal_data),
          ("source_mix", mix_sources), ("packing", pack_sequences)]

#: The classifier, the tokenizer and the online packing have no form in SQL; tests compare
#: each stage with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepared(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
