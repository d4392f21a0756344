"""A training-data pipeline over ``documents``: every stage works on all that the one before it kept.

Toxic documents go, one document of each group of near copies stays, documents that hold benchmark items go, sources
are mixed to target weights, and the mix is written as token ids. Stages are written as Parquet to the shared folder
and read again, so that a lost executor costs a stage's tasks and no more.

In every stage an empty table gives an empty one, texts of any length count whole, and columns besides ``doc_id``,
``text`` and ``source`` pass unread whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clinicweave.llm.common import documents, materialize
from clinicweave.llm.decontamination import drop_leaking
from clinicweave.llm.mixing import mix_documents
from clinicweave.llm.neardup import keep_one_of_each
from clinicweave.llm.queries import vocabulary
from clinicweave.llm.tokens import token_output
from clinicweave.llm.toxicity import drop_toxic


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels of documents still there, does not call toxic.

    Null texts are scored as empty ones; repeated rows go or stay together; without labels of both classes all stay.
    """
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by 80 % of common five-word shingles.

    Rows equal in every column stay once; null and empty texts and rows with a null id stay.
    """
    return keep_one_of_each(docs, shingle_words=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null texts and rows with a null id hold none; null items are in none."""
    return drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources; a document that is taken twice is two rows.

    A null source is a source of its own, the last; repeated rows are taken alike; ties go by a hash of the id.
    """
    return mix_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and per row what they hold: doc_id, start, n_tokens, ids_crc32.

    A null text is the end id alone; repeated rows follow each other, each with a start of its own.
    """
    return token_output(docs, vocabulary("word_bpe_49k.json"), end_id=2).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("toxicity", toxicity_stage),
    ("minhash_near_dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_output", token_stage),
]

#: Learned scores, sketches and tokenizers have no SQL; the tests compare run() with plain versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
