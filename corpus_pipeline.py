"""The corpus pipeline: language ID, near-duplicates, decontamination, mixing, sharding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents. A stage sees only what the one before it
kept: ``run`` writes each result to the shared folder and reads it again.

Further columns of the documents stay in every stage, whatever their names
(only a column ``shard`` is replaced by the last). Empty tables pass through
all stages. Texts are worked on whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cratedig.llm import decontaminate, langid, minhash, mixing, sharding
from cratedig.llm._util import save

#: Words of a shingle in the near-duplicate stage; two, as in op2, would link texts that share little wording.
NEAR_WORDS = 5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of no known language: null and empty texts and texts without a letter, all if no row has a language.

    Every repeated row stays or goes alike; a null id is an id like any other.
    """
    return langid.drop_unknown(docs).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates (0.8 of five-word shingles).

    That of the smallest (doc_id, text hash) stays, null ids last, of repeated
    rows one. Texts without words are near nothing and stay, one of each id.
    """
    return minhash.drop_near_duplicates(docs, words=NEAR_WORDS).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a window of a benchmark item occurs.

    Null and empty texts and items hold none; an empty benchmark drops nothing.
    Repeated rows stay or go alike.
    """
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that the sources meet their targets.

    A null source is a source. Documents without words have nothing to take or
    repeat beyond the epochs of their source. Ties go by doc_id; repeated rows,
    which no id tells apart, are taken alike.
    """
    return mixing.mixed_documents(docs).select(*docs.columns)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Names the shard of every document, a prefix of its hash over id and text (null as empty).

    Repeated rows that exceed a shard together fill numbered ones; a document
    larger than a shard is one alone.
    """
    return sharding.sharded_documents(docs).select(*(c for c in docs.columns if c != "shard"), "shard")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("sharding", sharding_stage),
]

#: SQL can't express the language model or the sampled sketches; tests compare every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
