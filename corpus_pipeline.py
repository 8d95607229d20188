"""A training-data pipeline over documents: five operators in a row, each on what the one before it has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roamsight.llm import decontaminate, pieces, simhash, suffixdedup, toxicity
from roamsight.llm.common import table, with_results
from roamsight.sources.staging import stage

WINDOW = 10
PASSAGE_WORDS = 51
SHINGLE_WORDS = 3


def _measured(docs: DataFrame) -> DataFrame:
    """Texts that changed have another length."""
    return with_results(docs, {"n_chars": F.length("text").cast("long")}).select(*docs.columns)


def toxic_free(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Drops documents that the toxicity model, trained on labelled documents, scores at its threshold or more.

    Null and empty texts have a score too. Rows without id stay; they are scored like others, but never have a label.
    """
    model = toxicity.train(docs, table(spark, folder, "labels"))
    return toxicity.scored(docs, model).where(F.col("score") < toxicity.REJECTED).select(*docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps one document of each group of near copies: fingerprints of shingles of three words, three bits or fewer apart.

    Null, empty and blank texts share the fingerprint zero and are one group. The smallest id stays; no id comes last.
    """
    return simhash.deduplicate(docs, words=SHINGLE_WORDS)


def distinct_passages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Cuts passages of 51 words or more that stood in the corpus before; texts change, rows stay.

    Null stays null. Rows without id come first in the order of the corpus; of rows equal in id and text one keeps it.
    """
    return _measured(suffixdedup.deduplicate_words(docs, PASSAGE_WORDS))


def decontaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Cuts windows of benchmark items out of the texts; drops documents that hardly hold anything else.

    Null and empty texts hold no window and stay, as do all documents where the benchmark is empty.
    """
    return _measured(decontaminate.remove(docs, table(spark, folder, "benchmark"), WINDOW))


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Adds piece ids, their number, and whether they decode to the text; a null text has none."""
    return pieces.round_trip(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic_free),
    ("simhash_near_dedup", distinct_documents),
    ("suffix_array_dedup", distinct_passages),
    ("benchmark_decontamination", decontaminated),
    ("sentencepiece", encoded),
]

#: Models, fingerprints and byte-level cuts are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents; what a stage returns is written and read again."""
    docs = table(spark, folder, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
