"""The corpus pipeline: filters, near-duplicates, secrets, mixing, tokens."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.llm.bpe import encoded
from quirelake.llm.mixing import mixed_documents
from quirelake.llm.ngram_join import one_per_group
from quirelake.llm.quality import kept_documents
from quirelake.llm.secret_scan import redacted
from quirelake.llm.workspace import written

#: SQL can express neither the trained forest nor the tokens.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their hosts' boilerplate lines."""
    return kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_per_group(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced."""
    return redacted(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids and their number."""
    path = public_tokenizers.path("word_bpe_49k.json")
    ids = encoded(docs, path)
    return ids.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secrets),
    ("mixing", mixing),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; what each one returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
