"""A corpus pipeline of training-data operators over ``documents``.

Quality rules and toxicity drop documents, near-duplicates keep the smallest doc_id of each group,
personal data is masked, and what is left is packed into training sequences.  Each stage is written
as Parquet and read again by the next.

Defined results of the stages: null and empty texts have no words and fail the quality rules, as short texts
do; a null doc_id has no label, links with nothing and stays; repeated rows are judged alike and, of equal
texts, the smallest doc_id stays; very long texts are read whole; columns of other names pass through the first
four stages; an empty table gives an empty one of the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from curatrix.llm.common import stored, table
from curatrix.llm.packing import pack_documents
from curatrix.llm.partenum import distinct_documents
from curatrix.llm.pii import mask
from curatrix.llm.quality import quality_filter
from curatrix.llm.queries import BYTE_BPE
from curatrix.llm.toxicity import toxicity_filter


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs."""
    return quality_filter(docs, table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half."""
    return toxicity_filter(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.75 or more."""
    return distinct_documents(docs, width=5, num=3, den=4)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return mask(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens: a row for each piece of a document.

    Workers that other stages use as well keep a small memo of words.
    """
    return pack_documents(docs, BYTE_BPE, end_id=2, capacity=1024, memo_words=50_000)


STAGES = [
    ("quality rules", quality),
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_duplicates),
    ("personal data", personal_data),
    ("best-fit packing", packing),
]

#: No SQL can express the learned stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
