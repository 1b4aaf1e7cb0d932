"""The corpus pipeline: five of the operators in a row over `documents`.

Each stage takes what its predecessor kept, is written as Parquet, and is read
again as the next one's input; all but the last return the columns of
`documents`.  SQL cannot express the trained rules or the tokenizer, so there
is no ORACLE_SQL; tests hold the rows against a brute-force version.

Every stage takes rows as they are: null ids, null texts, repeated rows and
extra columns each have the result that the stage's docstring names, and an
empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitrine.llm import decontaminate, packing, quality, secrets, simhash
from vitrine.llm.common import table, written

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the trees reject go.

    Null and empty texts have no words, so the base rules reject them; rows with
    null ids and repeated rows are judged by their text alone.
    """
    return quality.filter_quality(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays.

    It is the one with the smallest id; of repeated rows with that id one stays,
    and a row with a null id stays only where all near copies have none.
    """
    return simhash.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, whatever their id and however often they are there; null texts hold none."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; every document stays, each of repeated rows and rows with null ids too; null texts stay null."""
    return secrets.redacted(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as sequences of token pieces; a null or empty text is one end token, repeated rows are packed each."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, "pipeline-" + name.replace(" ", "-"))
    return docs
