"""One query per operator, over its whole table."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.llm.ann_forest import nearest
from quirelake.llm.bpe import round_trips
from quirelake.llm.compact_windows import repeated_passages
from quirelake.llm.filter_audit import AUDIT_SQL, audit, marked
from quirelake.llm.mixing import mix
from quirelake.llm.multiset_hash import compared_to_edits
from quirelake.llm.ngram_join import ngram_groups
from quirelake.llm.quality import quality_rules
from quirelake.llm.quotes import chat_text, linked
from quirelake.llm.registry import QUERIES, SQL, query, table
from quirelake.llm.secret_scan import secret_scan
from quirelake.llm.token_counts import token_counts
from quirelake.llm.toxicity import toxicity as toxicity_scores
from quirelake.llm.vantage_clusters import CLUSTERS_SQL, clustered

__all__ = ["QUERIES", "SQL"]


@query("op1_ngram_join")
def ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_groups(table(spark, sf_dir, "documents"))


@query("op6_quality_rules")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


@query("op7_mixing")
def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op5_bpe")
def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return round_trips(table(spark, sf_dir, "documents"), path)


@query("op9_token_counts")
def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts(table(spark, sf_dir, "documents"), path)


@query("op2_secret_scan")
def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "word_no", "part_no", F.md5("candidate").alias("candidate_md5"),
                        F.length("candidate").alias("n_chars"), "score", "is_secret")


@query("op3_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = "crc32(CAST(doc_id AS string)) % 5"
    scores = toxicity_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), f"{remainder} <> 0"
    )
    held_out = F.coalesce(F.expr(f"{remainder} = 0"), F.lit(False))
    return scores.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op4_prefix_forest")
def forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


@query("op8_compact_windows")
def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


@query("op10_quotation_links")
def quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_text(linked(table(spark, sf_dir, "conversations")))


@query("op13_filter_audit", AUDIT_SQL)
def filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(marked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


@query("op12_multiset_hash")
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared_to_edits(table(spark, sf_dir, "documents"))


@query("op11_vantage_clusters", CLUSTERS_SQL)
def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings"))
