"""The corpus pipeline: documents through five of the operators, to token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from figpairs.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that the quality rules reject go."""
    from figpairs.llm.quality_rules import kept_documents

    return kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: of each group of near duplicates (five words, 80 %) the document of smallest id stays."""
    from figpairs.llm.near_dup import without_near_duplicates

    return without_near_duplicates(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that hold a benchmark item go."""
    from figpairs.llm.decontaminate import without_leaks

    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: the mix's documents, a row per copy, in training order."""
    from figpairs.llm.mixing import training_order

    return training_order(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: token files; a row per document copy, read back from the files."""
    from figpairs.llm.queries import tokenizer_path
    from figpairs.llm.token_files import token_files

    return token_files(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("token_files", tokens),
]

# Near-duplicate components, latent retrieval and the tokenizer are beyond SQL;
# tests/llm/test_registered.py compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
