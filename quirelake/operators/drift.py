"""How the documents that are kept as VARIANT change their fields over time."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quirelake.schemas import VARIANT_COLUMN


def merged_schemas(docs: DataFrame) -> DataFrame:
    """Per landing date, the number of documents and one schema that fits them all."""
    return docs.groupBy("landing_date").agg(
        F.count("*").alias("documents"),
        F.schema_of_variant_agg(VARIANT_COLUMN).alias("merged_schema"),
    )


def field_kinds(docs: DataFrame) -> DataFrame:
    """Per landing date, the top-level fields of the documents with the kinds of their
    values, and in how many documents each stands.

    A field that is null has the kind VOID. Documents that are no objects have no field.
    """
    objects = docs.where(F.schema_of_variant(VARIANT_COLUMN).startswith("OBJECT"))
    fields = objects.sparkSession.tvf.variant_explode(F.col(VARIANT_COLUMN).outer())
    each = objects.lateralJoin(fields)
    return each.groupBy("landing_date", F.col("key").alias("field"),
                        F.schema_of_variant("value").alias("kind")).agg(
        F.count("*").alias("documents")
    )


def schema_drift(docs: DataFrame) -> DataFrame:
    """Which fields and kinds a landing date brings (``new``) or no longer has (``gone``)
    against the landing date before it.

    The tables compared hold a row per date, field and kind, however many documents there are.
    """
    kinds = field_kinds(docs)
    dates = kinds.select("landing_date").distinct()
    before = F.lag("landing_date").over(Window.orderBy("landing_date"))
    pairs = dates.withColumn("before", before).where("before IS NOT NULL")
    now = kinds.join(pairs, "landing_date")
    past = kinds.select(F.col("landing_date").alias("before"), "field", "kind", "documents")
    past = past.join(pairs, "before")
    key = ["landing_date", "before", "field", "kind"]
    new = now.join(past.select(*key), key, "left_anti").withColumn("change", F.lit("new"))
    gone = past.join(now.select(*key), key, "left_anti").withColumn("change", F.lit("gone"))
    columns = ["landing_date", "field", "kind", "change", "documents"]
    return new.select(*columns).unionByName(gone.select(*columns))
