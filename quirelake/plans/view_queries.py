"""Queries over the extraction views."""

from pyspark.sql import DataFrame, SparkSession

from quirelake.operators import compacted, views
from quirelake.plans import star_docs as docs
from quirelake.plans.registry import query
from quirelake.plans.star_docs import table

# --- naver ----------------------------------------------------------------------


@query("""
    WITH days AS (
      SELECT *, unnest(['MONDAY', 'THURSDAY', 'THURSDAY', 'SUNDAY']) AS weekday,
             unnest([0, 3, 3, 6]) AS release_day
      FROM part
    )
    SELECT 'naver' AS platform, p_partkey AS id, p_name AS title, p_brand AS author,
           CAST(trunc(p_retailprice) AS BIGINT) AS views, '/' || p_name AS image_url,
           weekday, release_day, FALSE AS is_completed
    FROM days WHERE weekday <> 'SUNDAY' OR p_size > 25
""")
def weekday_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All weekday lists from one scan."""
    pages = docs.naver_title_docs(table(spark, sf_dir, "part"))
    return views.naver_titles(compacted.titles_of_all_weekdays(pages))


@query("""
    WITH days AS (
      SELECT o_custkey, o_orderpriority, o_orderstatus, o_orderkey, o_orderdate,
             isodow(o_orderdate) AS d,
             unnest(CASE WHEN isodow(o_orderdate) = 6 THEN [1, 2] ELSE [1] END) AS copy
      FROM orders
    )
    SELECT 'naver' AS platform, o_custkey AS id, o_orderpriority AS title,
           o_orderstatus AS author, o_orderkey AS views,
           '/' || o_orderpriority AS image_url,
           CASE d WHEN 2 THEN 'TUESDAY' WHEN 5 THEN 'FRIDAY' ELSE 'SATURDAY' END
             AS weekday,
           CAST(d - 1 AS INTEGER) AS release_day, FALSE AS is_completed,
           CAST(o_orderdate AS DATE) AS landing_date
    FROM days WHERE d IN (2, 5, 6)
""")
def weekday_of_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of the landing date's own weekday."""
    pages = docs.naver_day_docs(table(spark, sf_dir, "orders"))
    return views.naver_titles(compacted.titles_of_run_day(pages))


@query("""
    SELECT 'naver' AS platform, s_suppkey AS id, s_name AS title, 'staff' AS author,
           CAST(trunc(s_acctbal) AS BIGINT) AS views, '/' || s_name AS image_url,
           'FINISHED' AS weekday, 7 AS release_day, TRUE AS is_completed
    FROM supplier
""")
def finished_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X10."""
    pages = docs.naver_finished_docs(table(spark, sf_dir, "supplier"))
    return views.naver_titles(compacted.finished_list(pages), completed=True)


@query("""
    SELECT 'naver' AS platform, p_partkey AS title_id,
           unnest([p_brand, p_type]) AS genre_name
    FROM part WHERE p_size >= 5
""")
def tags_from_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X11, G1."""
    return views.naver_genres(docs.naver_info_docs(table(spark, sf_dir, "part")))


@query("""
    WITH tagged AS (
      SELECT p_partkey, p_size, unnest([p_brand, p_type]) AS genre_name
      FROM part WHERE p_size >= 5
    ), days AS (
      SELECT *, unnest(CASE WHEN p_size > 30 THEN ['day']
                            WHEN p_size > 20 THEN ['월', '토']
                            ELSE ['화'] END) AS weekday
      FROM tagged
    )
    SELECT 'naver' AS platform, p_partkey AS title_id, genre_name, weekday,
           CASE weekday WHEN '월' THEN 0 WHEN '화' THEN 1 WHEN '토' THEN 5 ELSE 7 END
             AS release_day
    FROM days
""")
def explode_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags x weekdays, a default for a missing weekday."""
    return views.naver_info_weekdays(docs.naver_info_docs(table(spark, sf_dir, "part")))


@query("""
    SELECT 'naver' AS platform, o_custkey AS title_id, o_orderkey AS id,
           o_orderpriority AS title, '/' || o_orderstatus AS image_url,
           CASE WHEN o_orderstatus <> 'P'
                THEN CAST(strptime('20' || strftime(o_orderdate, '%y.%m.%d'),
                                   '%Y.%m.%d') AS DATE) END AS updated_date
    FROM orders
""")
def articles_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X13, C8."""
    lists = docs.naver_episode_docs(table(spark, sf_dir, "orders"))
    return views.naver_episodes(compacted.articles(lists))


@query("""
    SELECT 'naver' AS platform, o_custkey AS title_id, o_orderkey AS id,
           unnest([CAST(l_quantity AS BIGINT), CAST(l_linenumber AS BIGINT)]) AS likes,
           CAST(l_shipdate AS DATE) AS response_date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_returnflag = 'A'
""")
def likes_from_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X14, G1, C2, C4, C9."""
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return views.naver_likes(docs.naver_likes_docs(lineitem, orders))


@query("""
    SELECT 'naver' AS platform,
           CASE WHEN n > 0 THEN o_custkey END AS title_id,
           CASE WHEN n > 0 THEN o_orderkey END AS id,
           n AS comments
    FROM (SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'R') AS n
          FROM lineitem GROUP BY l_orderkey)
    JOIN orders ON l_orderkey = o_orderkey
""")
def comments_first_item_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a comment there is no key."""
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return views.naver_comments(docs.naver_comments_docs(lineitem, orders))


# --- kakao ----------------------------------------------------------------------

_CARD_SQL = """
    cards AS (
      SELECT c_custkey AS id, c_name AS title, c_name || ' / ' || c_mktsegment AS author,
             '/' || c_nationkey AS image_url,
             CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '월' WHEN 'BUILDING' THEN '수'
               WHEN 'FURNITURE' THEN '금' WHEN 'HOUSEHOLD' THEN '일' ELSE '완결' END
               AS weekday,
             CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 2
               WHEN 'FURNITURE' THEN 4 WHEN 'HOUSEHOLD' THEN 6 ELSE 7 END AS release_day,
             c_mktsegment AS segment, c_acctbal AS balance
      FROM customer
    )
"""


@query(f"""
    WITH {_CARD_SQL}
    SELECT 'kakao' AS platform, id, title, author, image_url, weekday, release_day,
           FALSE AS is_completed, unnest(['#' || segment, '#all']) AS genre_name
    FROM cards WHERE balance >= 0
""")
def titles_nested_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per card and keyword; cards without keywords drop out."""
    pages = docs.kakao_title_docs(table(spark, sf_dir, "customer"))
    return views.kakao_titles(compacted.sections(pages))


@query(f"""
    WITH {_CARD_SQL}
    SELECT 'kakao' AS platform, id, title, author, image_url, weekday, release_day,
           FALSE AS is_completed,
           unnest(CASE WHEN balance < 0 THEN [NULL] ELSE ['#' || segment, '#all'] END)
             AS genre_name
    FROM cards
    UNION ALL
    SELECT 'kakao', -id - 1, title, author, image_url, weekday, release_day, FALSE, NULL
    FROM cards
""")
def titles_keep_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with cards without keywords kept."""
    pages = docs.kakao_title_docs(table(spark, sf_dir, "customer"))
    return views.kakao_titles(compacted.sections(pages), keep_empty=True)


@query("""
    SELECT 'kakao' AS platform, s_suppkey AS id, s_name AS title, s_name AS author,
           '/' || s_nationkey AS image_url, '완결' AS weekday, 7 AS release_day,
           TRUE AS is_completed, '#finished' AS genre_name
    FROM supplier
""")
def finished_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2."""
    pages = docs.kakao_finished_docs(table(spark, sf_dir, "supplier"))
    return views.kakao_titles(compacted.sections(pages), completed=True)


@query("""
    SELECT 'kakao' AS platform, s_suppkey AS id,
           CAST(trunc(s_acctbal) AS BIGINT) AS views
    FROM supplier
""")
def views_from_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3."""
    return views.kakao_views(docs.kakao_view_docs(table(spark, sf_dir, "supplier")))


@query("""
    WITH badges AS (
      SELECT c_custkey, c_acctbal,
             unnest(CASE WHEN c_mktsegment = 'BUILDING' THEN ['mon', 'thu']
                         ELSE ['sun'] END) AS weekday
      FROM customer WHERE c_mktsegment <> 'MACHINERY'
    )
    SELECT 'kakao' AS platform, c_custkey AS id,
           CAST(trunc(c_acctbal) AS BIGINT) AS views, weekday,
           CASE weekday WHEN 'mon' THEN 0 WHEN 'thu' THEN 3 ELSE 6 END AS release_day
    FROM badges
""")
def badge_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4, G3, F5."""
    infos = docs.kakao_info_docs(table(spark, sf_dir, "customer"))
    return views.kakao_views_by_badge(infos)


_LISTED_SQL = """
    SELECT 'kakao' AS platform, o_custkey AS title_id, o_orderkey AS id,
           o_orderpriority AS title, '/' || o_orderstatus AS image_url,
           {date} AS updated_date
    FROM orders
"""


@query(_LISTED_SQL.format(date="CAST(o_orderdate AS DATE)"))
def episodes_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5, C7, dated by the serial start."""
    lists = docs.kakao_episode_docs(table(spark, sf_dir, "orders"))
    return views.kakao_episodes(compacted.listed_episodes(lists))


@query(
    _LISTED_SQL.format(
        date="CASE WHEN o_orderstatus <> 'P'"
        " THEN CAST(o_orderdate + INTERVAL 12 HOUR AS DATE) END"
    )
)
def episodes_by_use_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5, C7, dated by the start of use; unreadable text gives NULL."""
    lists = docs.kakao_episode_docs(table(spark, sf_dir, "orders"))
    listed = compacted.listed_episodes(lists)
    return views.kakao_episodes(listed, date_field="useStartDateTime")


@query("""
    SELECT 'kakao' AS platform,
           CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS title_id,
           o_orderkey AS id, CAST(trunc(o_totalprice) AS BIGINT) AS likes
    FROM orders
""")
def likes_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder name that is no number gives no title."""
    return views.kakao_likes(docs.kakao_likes_docs(table(spark, sf_dir, "orders")))


@query("""
    SELECT 'kakao' AS platform, o_custkey AS title_id, o_orderkey AS id,
           CAST(length(o_orderpriority) AS BIGINT) AS comments
    FROM orders
""")
def comments_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X7, P2, P3."""
    responses = docs.kakao_comments_docs(table(spark, sf_dir, "orders"))
    return views.kakao_comments(compacted.with_path_keys(responses))
