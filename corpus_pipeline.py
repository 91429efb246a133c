"""Clean, deduplicate, decontaminate and pack the documents.

Each stage takes the documents that the one before it kept, whole, and returns
the columns of documents; the last returns the pieces of its sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litmill.llm.common import crc_of_id, table
from litmill.llm.decontaminate import decontaminate
from litmill.llm.line_dedup import line_dedup
from litmill.llm.near_duplicates import one_of_each
from litmill.llm.packing import packed_documents
from litmill.llm.toxicity import THRESHOLD, fit_model, toxicity_scores
from litmill.sources.scratch import Scratch


def aside(docs: DataFrame, *names: str) -> DataFrame:
    """Columns that an operator would write over, under another name."""
    return docs.withColumnsRenamed({c: f"__own_{c}" for c in names})


def back(out: DataFrame, docs: DataFrame) -> DataFrame:
    return out.select(*(F.col(f"__own_{c}").alias(c) if f"__own_{c}" in out.columns else F.col(c) for c in docs.columns))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score says toxic go; labels of held-out rows stay unseen."""
    labels = table(spark, sf_dir, "labels").where(~(crc_of_id() % 4 == 2))
    scored = toxicity_scores(aside(docs, "score"), fit_model(docs, labels))
    return back(scored.where(F.col("score") < THRESHOLD), docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that another document holds go, and documents that have no other;
    ``n_chars`` follows the text."""
    out = line_dedup(aside(docs, "n_lines", "n_dropped")).where("text <> '' or n_dropped = 0")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return back(out, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents that with the smallest id stays."""
    return one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, in sequences."""
    import public_tokenizers

    return packed_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("decontaminate", benchmark),
    ("best_fit_packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs


#: Trained scores, iterated joins and tokens are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None
