"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame; all
but the last return the columns of ``documents``.  ``run`` writes what a stage
returns as Parquet in the shared folder and reads it again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from routeloom.llm.decontaminate import without_leaks
from routeloom.llm.line_dedup import dedup_lines
from routeloom.llm.ngram_join import keep_one
from routeloom.llm.packing import pack_documents
from routeloom.llm.quality import fit_quality, keep_good
from routeloom.llm.queries import read, tokenizer_path
from routeloom.session import dropped, ship, tables_written, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go."""
    ship(spark)
    return keep_good(docs, fit_quality(docs, read(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that came before go; a document of which nothing is left goes too."""
    return dedup_lines(docs, short_copies=True)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, 0.8) the one with the least id stays."""
    ship(spark)
    return keep_one(docs, width=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with passages of the benchmark go."""
    ship(spark)
    return without_leaks(docs, read(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 4096 tokens."""
    ship(spark)
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    before = tables_written()
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage{k}")
            dropped(spark, before, keep=1)  # tables of the stage and what the stage before left
    return docs


#: Tokenizing and compressing have no form in SQL; a test compares with plain code.
ORACLE_SQL = None
