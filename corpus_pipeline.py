"""Documents to token ids: toxicity, repeated lines, near duplicates, benchmark text, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes each result as
Parquet and reads it again as the next stage's documents. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm import decontaminate, lines, near, tokens, toxicity
from tallyward.session import materialise


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, by a model learned from the table ``labels``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score(docs, toxicity.learn(docs, labels))
    return scored.filter(F.col("score") < toxicity.THRESHOLD).select(*docs.columns)


def remove_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with lines left out that repeat an earlier one, equal or, from 20 characters on, one
    edit apart; ``n_chars`` follows the text."""
    cut = lines.dedup_lines(docs, lengths=lines.LENGTHS[:1])
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id. Documents are linked
    if 0.8 or more of their five-word shingles are the same."""
    return near.deduplicate(docs, percent=80).select(*docs.columns)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is in the table ``benchmark``."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.remove_documents(decontaminate.find_contamination(docs, benchmark)).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document's tokens, with digests of them and of the text that they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = docs.select("doc_id", "lang", "source", "text")
    coded = tokens.encode(rows, path, public_tokenizers.PATTERN).drop("text")
    return tokens.decode(coded, path).select(
        "doc_id",
        "lang",
        "source",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", remove_toxic),
    ("line dedup", remove_lines),
    ("near duplicates", remove_near_duplicates),
    ("decontamination", remove_contaminated),
    ("tokens", encode),
]

#: Toxicity scores come from a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over the whole table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
