"""Queries over the curated tables."""

from pyspark.sql import DataFrame, SparkSession

from quirelake.operators import compacted, curation, views
from quirelake.plans import star_docs as docs
from quirelake.plans.registry import query
from quirelake.plans.star_docs import table
from quirelake.plans.view_queries import _CARD_SQL

# --- episodes -------------------------------------------------------------------


def _naver_parts(spark: SparkSession, sf_dir: str):
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return (
        views.naver_episodes(compacted.articles(docs.naver_episode_docs(orders))),
        views.naver_likes(docs.naver_likes_docs(lineitem, orders)),
        views.naver_comments(docs.naver_comments_docs(lineitem, orders)),
    )


_EPISODE_SQL = """
    WITH e AS (
      SELECT o_custkey AS title_id, o_orderkey AS id, o_orderpriority AS title,
             '/' || o_orderstatus AS image_url,
             CASE WHEN o_orderstatus <> 'P'
                  THEN CAST(strptime('20' || strftime(o_orderdate, '%y.%m.%d'),
                                     '%Y.%m.%d') AS DATE) END AS listed_date
      FROM orders
    ), l AS (
      SELECT o_custkey AS title_id, o_orderkey AS id,
             unnest([CAST(l_quantity AS BIGINT), CAST(l_linenumber AS BIGINT)]) AS likes,
             CAST(l_shipdate AS DATE) AS response_date
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      WHERE l_returnflag = 'A'
    ), c AS (
      SELECT o_custkey AS title_id, o_orderkey AS id, count(*) AS comments
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      WHERE l_returnflag = 'R' GROUP BY o_custkey, o_orderkey
    )
    SELECT DISTINCT 'naver' AS platform, e.title_id, e.id, e.title, l.likes,
           c.comments, e.image_url, {date} AS updated_date
    FROM e
    LEFT JOIN l ON e.title_id = l.title_id AND e.id = l.id
    LEFT JOIN c ON {side}.title_id = c.title_id AND {side}.id = c.id
    {where}
"""


@query(
    _EPISODE_SQL.format(
        date="e.listed_date", side="l", where="WHERE e.listed_date IS NOT NULL"
    )
)
def episodes_chained_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments are reached through likes."""
    episodes, likes, comments = _naver_parts(spark, sf_dir)
    return curation.curate_episodes(episodes, likes, comments)


@query(
    _EPISODE_SQL.format(
        date="e.listed_date", side="e", where="WHERE e.listed_date IS NOT NULL"
    )
)
def episodes_star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments are reached through the episode."""
    episodes, likes, comments = _naver_parts(spark, sf_dir)
    return curation.curate_episodes(episodes, likes, comments, join="star")


@query(_EPISODE_SQL.format(date="l.response_date", side="l", where=""))
def episodes_by_response_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated by the likes response, rows without a date kept."""
    episodes, likes, comments = _naver_parts(spark, sf_dir)
    dated = likes.withColumnRenamed("response_date", "updated_date")
    return curation.curate_episodes(episodes, dated, comments, require_date=False)


@query("""
    SELECT DISTINCT 'kakao' AS platform, o_custkey AS title_id, o_orderkey AS id,
           o_orderpriority AS title,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(trunc(o_totalprice) AS BIGINT) END
             AS likes,
           CASE WHEN o_orderstatus <> 'P'
                THEN CAST(length(o_orderpriority) AS BIGINT) END AS comments,
           '/' || o_orderstatus AS image_url, CAST(o_orderdate AS DATE) AS updated_date
    FROM orders
""")
def episodes_keyed_by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other platform; no title in the likes path, no comments."""
    orders = table(spark, sf_dir, "orders")
    listed = compacted.listed_episodes(docs.kakao_episode_docs(orders))
    keyed = compacted.with_path_keys(docs.kakao_comments_docs(orders))
    return curation.curate_episodes(
        views.kakao_episodes(listed),
        views.kakao_likes(docs.kakao_likes_docs(orders)),
        views.kakao_comments(keyed),
    )


# --- titles ---------------------------------------------------------------------


def _cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = docs.kakao_title_docs(table(spark, sf_dir, "customer"))
    return curation.with_keywords(views.kakao_cards(compacted.sections(pages)))


def _finished_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = docs.kakao_finished_docs(table(spark, sf_dir, "supplier"))
    cards = views.kakao_cards(compacted.sections(pages), completed=True)
    return curation.with_keywords(cards)


@query(f"""
    WITH {_CARD_SQL}
    SELECT DISTINCT 'kakao' AS platform, id, title, author,
           CAST(trunc(s_acctbal) AS BIGINT) AS views, image_url, release_day,
           FALSE AS is_completed
    FROM cards LEFT JOIN supplier ON id = s_suppkey
    WHERE balance >= 0
""")
def titles_left_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1, A1, O5."""
    infos = docs.kakao_view_docs(table(spark, sf_dir, "supplier"))
    return curation.curate_titles(_cards(spark, sf_dir), views.kakao_views(infos))


@query(f"""
    WITH {_CARD_SQL}, titles AS (
      SELECT id, title, author, image_url, release_day, FALSE AS is_completed
      FROM cards WHERE balance >= 0
      UNION ALL
      SELECT s_suppkey, s_name, s_name, '/' || s_nationkey, 7, TRUE FROM supplier
    )
    SELECT DISTINCT 'kakao' AS platform, id, title, author,
           CAST(trunc(s_acctbal) AS BIGINT) AS views, image_url, release_day, is_completed
    FROM titles LEFT JOIN supplier ON id = s_suppkey
""")
def titles_union_finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1, J1, A1, F2."""
    both = _cards(spark, sf_dir).unionByName(_finished_cards(spark, sf_dir))
    infos = docs.kakao_view_docs(table(spark, sf_dir, "supplier"))
    return curation.curate_titles(both, views.kakao_views(infos))


@query(f"""
    WITH {_CARD_SQL}, badges AS (
      SELECT c_custkey, CAST(trunc(c_acctbal) AS BIGINT) AS views,
             unnest(CASE WHEN c_mktsegment = 'BUILDING' THEN [0, 3] ELSE [6] END)
               AS badge_day
      FROM customer WHERE c_mktsegment <> 'MACHINERY'
    )
    SELECT DISTINCT 'kakao' AS platform, id, title, author, views, image_url,
           badge_day AS release_day, FALSE AS is_completed
    FROM cards LEFT JOIN badges ON id = c_custkey
    WHERE balance >= 0
""")
def titles_badge_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No weekday badge, no views and no day."""
    infos = docs.kakao_info_docs(table(spark, sf_dir, "customer"))
    return curation.curate_titles(
        _cards(spark, sf_dir), views.kakao_views_by_badge(infos)
    )


@query("""
    WITH days AS (
      SELECT p_partkey AS key,
             unnest(CASE WHEN p_size > 30 THEN [7] WHEN p_size > 20 THEN [0, 5]
                         ELSE [1] END) AS release_day
      FROM part WHERE p_size >= 5
    )
    SELECT DISTINCT 'naver' AS platform, p_partkey AS id, p_name AS title,
           p_brand AS author, CAST(trunc(p_retailprice) AS BIGINT) AS views,
           '/' || p_name AS image_url, release_day, FALSE AS is_completed
    FROM part LEFT JOIN days ON p_partkey = key
""")
def titles_weekday_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekdays from the title info; no tags, no day."""
    part = table(spark, sf_dir, "part")
    listed = compacted.titles_of_all_weekdays(docs.naver_title_docs(part))
    days = views.naver_title_days(docs.naver_info_docs(part))
    return curation.curate_titles(views.naver_titles(listed), days)


@query("""
    WITH listed AS (
      SELECT p_partkey AS id, p_name AS title, p_brand AS author,
             CAST(trunc(p_retailprice) AS BIGINT) AS views, '/' || p_name AS image_url,
             unnest(CASE WHEN p_size > 25 THEN [0, 3, 6] ELSE [0, 3] END) AS release_day,
             FALSE AS is_completed
      FROM part
      UNION ALL
      SELECT s_suppkey, s_name, 'staff', CAST(trunc(s_acctbal) AS BIGINT),
             '/' || s_name, 7, TRUE
      FROM supplier
    )
    SELECT DISTINCT 'naver' AS platform, * FROM listed
""")
def titles_on_all_weekdays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A title has one row per weekday it is listed on."""
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    ongoing = compacted.titles_of_all_weekdays(docs.naver_title_docs(part))
    finished = compacted.finished_list(docs.naver_finished_docs(supplier))
    both = views.naver_titles(ongoing).unionByName(
        views.naver_titles(finished, completed=True)
    )
    return curation.curate_titles(both)


# --- genres ---------------------------------------------------------------------


@query("""
    SELECT DISTINCT 'kakao' AS platform, c_custkey AS title_id,
           substring(unnest(['#' || c_mktsegment, '#all']), 2) AS genre_name
    FROM customer WHERE c_acctbal >= 0
""")
def genres_distinct_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords less their leading mark."""
    return curation.curate_genres(curation.genres_of_cards(_cards(spark, sf_dir)))


@query("""
    SELECT DISTINCT 'naver' AS platform, p_partkey AS title_id,
           unnest([p_brand, p_type]) AS genre_name
    FROM part WHERE p_size >= 5
""")
def genres_from_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X11, A2: tags as they are."""
    infos = docs.naver_info_docs(table(spark, sf_dir, "part"))
    return curation.curate_genres(views.naver_genres(infos))
