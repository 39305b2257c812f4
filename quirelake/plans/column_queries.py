"""Queries over the column functions."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.conventions import WEEKDAY_SPELLINGS
from quirelake.functions import (
    drop_prefix,
    epoch_ms_date,
    fill_template,
    iso_date,
    join_names,
    jsonp_body,
    landing_date,
    path_stem,
    path_title,
    release_day,
    short_date,
    weekday_key,
)
from quirelake.plans.registry import query
from quirelake.plans.star_docs import table


@query("""
    SELECT o_orderkey,
           CAST(isodow(o_orderdate) - 1 AS INTEGER) AS from_key,
           CAST(isodow(o_orderdate) - 1 AS INTEGER) AS from_korean,
           CAST(isodow(o_orderdate) - 1 AS INTEGER) AS from_short,
           7 AS from_other,
           7 AS from_null
    FROM orders
""")
def weekday_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7-F9, O4."""
    orders = table(spark, sf_dir, "orders")
    spelled = [
        F.get(
            F.array(*[F.lit(names[i]) for names in WEEKDAY_SPELLINGS.values()]),
            F.weekday("o_orderdate"),
        )
        for i in (1, 2)
    ]
    return orders.select(
        "o_orderkey",
        release_day(weekday_key("o_orderdate")).alias("from_key"),
        release_day(spelled[0]).alias("from_korean"),
        release_day(spelled[1]).alias("from_short"),
        release_day("o_orderpriority").alias("from_other"),
        release_day(F.lit(None).cast("string")).alias("from_null"),
    )


@query("""
    SELECT o_orderkey,
           CASE o_orderstatus
             WHEN 'P' THEN NULL
             WHEN 'F' THEN CAST(strptime('20' || strftime(o_orderdate, '%y.%m.%d'),
                                         '%Y.%m.%d') AS DATE)
           END AS updated_date
    FROM orders
""")
def short_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending orders have a NULL text, open ones a text that is no date."""
    text = (
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yy.MM.dd"))
        .when(F.col("o_orderstatus") == "O", F.col("o_orderpriority"))
        .otherwise(F.lit(None).cast("string"))
    )
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", short_date(text).alias("updated_date"))


@query("""
    SELECT event_id, epoch_us(ts) // 1000 AS millis, CAST(ts AS DATE) AS updated_date
    FROM events
""")
def epoch_ms_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9, C10."""
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    events = table(spark, sf_dir, "events").select("event_id", millis.alias("millis"))
    return events.withColumn("updated_date", epoch_ms_date("millis"))


@query("""
    SELECT o_orderkey,
           CAST(o_orderdate AS DATE) AS plain_date,
           CAST(o_orderdate - INTERVAL 9 HOUR AS DATE) AS zoned_date,
           CAST(NULL AS DATE) AS bad_date
    FROM orders
""")
def iso_text_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO text with and without a zone, and text that is no date."""
    plain = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        iso_date(plain).alias("plain_date"),
        iso_date(F.concat(plain, F.lit("+09:00"))).alias("zoned_date"),
        iso_date("o_orderpriority").alias("bad_date"),
    )


@query("""
    SELECT o_orderkey,
           CAST(o_custkey AS VARCHAR) AS title_folder,
           CAST(o_orderkey AS VARCHAR) AS episode_stem,
           CAST(o_orderdate AS DATE) AS landed_on
    FROM orders
""")
def path_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2-P4 over landing paths of every order."""
    path = F.concat_ws(
        "/",
        F.lit("s3a://lake/raw/kakao/comments"),
        F.date_format("o_orderdate", "yyyy/MM/dd"),
        "o_custkey",
        F.concat("o_orderkey", F.lit(".json")),
    )
    paths = table(spark, sf_dir, "orders").select("o_orderkey", path.alias("path"))
    return paths.select(
        "o_orderkey",
        path_title("path").alias("title_folder"),
        path_stem("path").alias("episode_stem"),
        landing_date("path").alias("landed_on"),
    )


@query("""
    SELECT c_custkey,
           CASE WHEN c_acctbal < 0 OR c_mktsegment = 'BUILDING' THEN ''
                ELSE c_name || ' / ' || c_mktsegment END AS author
    FROM customer
""")
def author_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names out of structs; NULL names, an empty and a NULL list."""
    listed = F.array(
        *[
            F.struct(name.alias("name"))
            for name in (
                F.col("c_name"),
                F.lit(None).cast("string"),
                F.col("c_mktsegment"),
            )
        ]
    )
    authors = (
        F.when(F.col("c_acctbal") < 0, F.array().cast("array<struct<name: string>>"))
        .when(F.col("c_mktsegment") != "BUILDING", listed)
        .alias("authors")
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", authors)
    return customers.select("c_custkey", join_names("authors.name").alias("author"))


@query("""
    SELECT doc_id, substring(text, 2) AS shorter, substring('', 2) AS still_empty
    FROM documents
""")
def prefix_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 on whole texts."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        drop_prefix("text").alias("shorter"),
        drop_prefix(F.lit("")).alias("still_empty"),
    )


@query("""
    SELECT event_id, props AS body, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
           CAST(NULL AS VARCHAR) AS no_call
    FROM events
""")
def jsonp_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON document out of a callback's text."""
    call = F.concat(F.lit("callback("), "props", F.lit(");"))
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", jsonp_body(call).alias("body")
    )
    return events.select(
        "event_id",
        "body",
        F.from_json("body", "k bigint")["k"].alias("k"),
        jsonp_body("event_type").alias("no_call"),
    )


@query("""
    SELECT o_orderkey,
           'https://example.org/likes/' || o_custkey || '_' || o_orderkey || '?q=1'
             AS url,
           CAST(NULL AS VARCHAR) AS keyless
    FROM orders
""")
def template_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request address per order."""
    template = "https://example.org/likes/{title_id}_{episode_id}?q=1"
    nothing = F.lit(None).cast("bigint")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        fill_template(template, title_id="o_custkey", episode_id="o_orderkey").alias(
            "url"
        ),
        fill_template(template, title_id="o_custkey", episode_id=nothing).alias(
            "keyless"
        ),
    )
