"""From raw documents to packed training sequences: five stages, each one operator of tallyflow.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyflow.llm.line_dedup import drop_common_lines
from tallyflow.llm.mixing import mixed
from tallyflow.llm.packing import pack_documents
from tallyflow.llm.prob_minhash import one_of_each
from tallyflow.llm.quality import keep_good
from tallyflow.llm.tables import read_table, staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the perplexity band of their language reject go."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that at least five documents share stay in the last of them; ``n_chars`` follows the text."""
    kept = drop_common_lines(docs)
    lengths = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return kept.withColumn("n_chars", lengths).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source's documents as often as its target weight asks for."""
    return mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 ids."""
    return pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("pack", pack),
]

#: The language model of the first stage is beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows between two stages are written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
