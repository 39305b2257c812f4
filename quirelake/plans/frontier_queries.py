"""Queries over the follow-up work tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.conventions import (
    KAKAO,
    KAKAO_LATEST_EPISODES,
    NAVER,
    NAVER_LATEST_EPISODES,
    TOP_COMMENTS,
)
from quirelake.operators import compacted, frontier, views
from quirelake.plans import star_docs as docs
from quirelake.plans.registry import query
from quirelake.plans.star_docs import table


@query("""
    SELECT DISTINCT p_partkey AS title_id, 'weekdays' AS listed_in FROM part
    UNION ALL
    SELECT DISTINCT p_partkey, 'sunday' FROM part WHERE p_size > 25
    UNION ALL
    SELECT DISTINCT s_suppkey, 'finished' FROM supplier
    UNION ALL
    SELECT DISTINCT c_custkey, 'pages' FROM customer
""")
def title_ids_harvested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All weekdays, one weekday, finished lists, first card group of pages."""
    lists = docs.naver_title_docs(table(spark, sf_dir, "part"))
    finished = docs.naver_finished_docs(table(spark, sf_dir, "supplier"))
    pages = docs.kakao_title_docs(table(spark, sf_dir, "customer"))
    found = {
        "weekdays": frontier.naver_title_ids(lists),
        "sunday": frontier.naver_title_ids(lists, F.lit("SUNDAY")),
        "finished": frontier.naver_finished_ids(finished),
        "pages": frontier.kakao_title_ids(pages),
    }
    tagged = [ids.withColumn("listed_in", F.lit(name)) for name, ids in found.items()]
    first, *rest = tagged
    for ids in rest:
        first = first.unionByName(ids)
    return first


@query("""
    SELECT title_id, 'https://example.org/titles/' || title_id AS url
    FROM (SELECT p_partkey AS title_id FROM part
          UNION ALL SELECT s_suppkey FROM supplier)
""")
def request_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per ongoing and per finished title."""
    lists = docs.naver_title_docs(table(spark, sf_dir, "part"))
    finished = docs.naver_finished_docs(table(spark, sf_dir, "supplier"))
    ids = frontier.all_title_ids(
        frontier.naver_title_ids(lists), frontier.naver_finished_ids(finished)
    )
    return frontier.requests(ids, "https://example.org/titles/{title_id}")


@query("""
    SELECT o_custkey AS title_id, unnest(generate_series(1, n)) AS episode_id
    FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
""")
def episode_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes 1..N per title, N being its number of orders."""
    counts = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("title_id"))
        .agg(F.count("*").alias("n"))
    )
    return frontier.numbered(counts, "n", "episode_id").drop("n")


@query("""
    SELECT p_partkey AS title_id, page_no,
           'https://example.org/titles/' || p_partkey || '/pages/' || page_no AS url
    FROM (SELECT p_partkey, unnest(generate_series(1, p_size)) AS page_no FROM part)
""")
def page_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per page, a part's size being its page count."""
    pages = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("title_id"), F.col("p_size").cast("bigint").alias("n")
    )
    keys = frontier.numbered(pages, "n", "page_no").drop("n")
    return frontier.requests(
        keys, "https://example.org/titles/{title_id}/pages/{page_no}"
    )


_LATEST_SQL = """
    SELECT title_id, id, title, "rank" FROM (
      SELECT o_custkey AS title_id, o_orderkey AS id, o_orderpriority AS title,
             CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC)
                  AS INTEGER) AS "rank"
      FROM orders)
    WHERE "rank" <= {rows}
"""


@query(_LATEST_SQL.format(rows=KAKAO_LATEST_EPISODES))
def latest_per_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten newest episodes per title."""
    lists = docs.kakao_episode_docs(table(spark, sf_dir, "orders"))
    episodes = views.kakao_episodes(compacted.listed_episodes(lists))
    latest = frontier.latest_episodes(episodes, KAKAO_LATEST_EPISODES)
    return latest.select("title_id", "id", "title", "rank")


@query(_LATEST_SQL.format(rows=NAVER_LATEST_EPISODES))
def newest_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest article per title."""
    lists = docs.naver_episode_docs(table(spark, sf_dir, "orders"))
    episodes = views.naver_episodes(compacted.articles(lists))
    latest = frontier.latest_episodes(episodes, NAVER_LATEST_EPISODES)
    return latest.select("title_id", "id", "title", "rank")


@query(f"""
    SELECT id, likes, part, supplier, line, price, "rank" FROM (
      SELECT l_orderkey AS id, CAST(l_quantity AS BIGINT) AS likes, l_partkey AS part,
             l_suppkey AS supplier, l_linenumber AS line, l_extendedprice AS price,
             CAST(row_number() OVER (PARTITION BY l_orderkey
               ORDER BY l_quantity DESC, l_partkey, l_suppkey, l_linenumber,
                        l_extendedprice) AS INTEGER) AS "rank"
      FROM lineitem)
    WHERE "rank" <= {TOP_COMMENTS}
""")
def top_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most liked comments per episode, line items as comments."""
    comments = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_quantity").cast("bigint").alias("likes"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_linenumber").alias("line"),
        F.col("l_extendedprice").alias("price"),
    )
    order = [F.desc("likes"), *map(F.col, ("part", "supplier", "line", "price"))]
    return frontier.top_rows(comments, ["id"], order, TOP_COMMENTS)


@query("""
    SELECT o_custkey AS title_id, o_orderkey AS id, 'FREE' AS use_type
    FROM orders WHERE o_orderstatus = 'F'
""")
def free_only_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R7."""
    lists = docs.kakao_episode_docs(table(spark, sf_dir, "orders"))
    listed = frontier.kakao_listed_episodes(compacted.listed_episodes(lists))
    return frontier.free_episodes(listed)


@query("""
    SELECT CAST(l_orderkey AS VARCHAR) AS key, 'no_comments' AS flag
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    GROUP BY l_orderkey HAVING count(*) FILTER (WHERE l_returnflag = 'R') = 0
    UNION ALL
    SELECT o_custkey || '_' || o_orderkey, 'no_likes'
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'A'
    UNION ALL
    SELECT CAST(o_custkey AS VARCHAR), 'no_articles' FROM orders
    WHERE o_orderstatus = 'P'
    UNION ALL
    SELECT p_name, 'odd_items' FROM part WHERE p_size > 25
""")
def quality_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four checks as one exceptions table."""
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    part = table(spark, sf_dir, "part")

    order_of = F.col("order")
    responses = (
        docs.naver_comments_docs(lineitem, orders, keep=["l_orderkey"])
        .withColumnRenamed("l_orderkey", "order")
    )
    silent = frontier.exceptions(frontier.comments_flags(responses), "no_comments", order_of)

    reactions = docs.naver_likes_docs(lineitem, orders).withColumn(
        "contents",
        F.transform(
            "contents",
            lambda c: c.withField("reactionMap", F.lit(None).cast("map<string,string>")),
        ),
    )
    key = F.get("contents", F.lit(0))["contentsId"]
    unliked = frontier.exceptions(frontier.likes_flags(reactions), "no_likes", key)

    lists = docs.naver_episode_docs(orders).withColumn(
        "articleList",
        F.filter("articleList", lambda a: a["serviceDateDescription"] != "soon"),
    )
    bare = frontier.exceptions(frontier.articles_flags(lists), "no_articles", F.col("titleId"))

    pages = docs.naver_title_docs(part).withColumn(
        "titleListMap",
        F.transform_values(
            "titleListMap",
            lambda day, listed: F.transform(
                listed,
                lambda t: F.when(day == "SUNDAY", t.withField("titleId", F.lit(None)))
                .otherwise(t),
            ),
        ),
    )
    name = F.get(F.element_at("titleListMap", "MONDAY"), F.lit(0))["titleName"]
    odd = frontier.exceptions(frontier.listing_flags(pages), "odd_items", name)
    return silent.unionByName(unliked).unionByName(bare).unionByName(odd)


@query("""
    SELECT p_partkey AS title_id FROM part
    WHERE p_partkey NOT IN (SELECT o_custkey FROM orders)
""")
def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed titles without episodes."""
    lists = docs.naver_title_docs(table(spark, sf_dir, "part"))
    counts = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("title_id"))
        .agg(F.count("*").alias("episodes"))
    )
    return frontier.uncovered(frontier.naver_title_ids(lists), counts)


@query("""
    SELECT 'naver' AS platform, p_partkey AS title_id FROM part
    UNION ALL
    SELECT 'kakao', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
""")
def coverage_by_platform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal title numbers of two platforms do not hide each other."""
    lists = docs.naver_title_docs(table(spark, sf_dir, "part"))
    pages = docs.kakao_title_docs(table(spark, sf_dir, "customer"))
    titles = frontier.of_platform(frontier.naver_title_ids(lists), NAVER).unionByName(
        frontier.of_platform(frontier.kakao_title_ids(pages), KAKAO)
    )
    counts = frontier.of_platform(
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("title_id"))
        .agg(F.count("*").alias("episodes")),
        KAKAO,
    )
    return frontier.uncovered(titles, counts)
