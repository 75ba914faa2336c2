"""The corpus pipeline: five stages over ``documents``, each one operator of ``strata.llm``.

Quality classifier, exact dedup, SimHash near-dedup, mixing sources to target
weights, best-fit packing. ``STAGES`` lists (name, function); a function takes
(spark, docs, sf_dir) and returns what it keeps, with the columns of documents,
but for the last one, which returns the packed pieces. ``run`` writes each
stage's result to the shared checkpoint folder and reads it again as the next
one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm.common import DOCUMENT_COLUMNS, read_table, written
from strata.llm.exact_dedup import keep_exact
from strata.llm.mixing import mixed_documents
from strata.llm.packing import pack, word_tokenizer_path
from strata.llm.quality import keep_good
from strata.llm.simhash_dedup import keep_one


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_good(docs.select(*DOCUMENT_COLUMNS), read_table(spark, sf_dir, "labels"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return keep_exact(docs.select(*DOCUMENT_COLUMNS))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints one document stays."""
    return keep_one(docs.select(*DOCUMENT_COLUMNS))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix; one that is taken twice is two rows."""
    return mixed_documents(docs.select(*DOCUMENT_COLUMNS))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return pack(docs.select(*DOCUMENT_COLUMNS), word_tokenizer_path())


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_dedup", simhash_stage),
    ("mix_sources", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: Trained, hashed and tokenised stages have no SQL; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
