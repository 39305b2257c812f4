"""Queries over the layers of a lake, written to the session's shared folder.

Landing files hold one document per line here: a star schema gives one small
document per row, and one file per row would be all file handling.
"""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.conventions import (
    JOB_PREVIEW_ROWS,
    NAVER,
    READER_PREVIEW_ROWS,
)
from quirelake.operators import compacted, curation, frontier, views
from quirelake.plans import runs
from quirelake.plans import star_docs as docs
from quirelake.plans.curation_queries import _EPISODE_SQL
from quirelake.plans.registry import query
from quirelake.plans.scratch import scratch
from quirelake.plans.star_docs import table
from quirelake.sources import (
    backup,
    inventory,
    of_titles,
    preview,
    read_curated,
    read_files,
    read_landing,
    read_optimized,
    register_views,
    write_curated,
    write_optimized,
)
from quirelake.sources.layout import backup_path, landing_folder
from quirelake.streaming import compact, read_merged

LANDED_ON = date(2025, 2, 27)  # a Thursday
_LANDED_SQL = "DATE '2025-02-27' AS landing_date"


def _land(frame: DataFrame, root: str, target: str, folder: str = "", mode="append"):
    path = f"{landing_folder(root, NAVER, target)}/{LANDED_ON:%Y/%m/%d}"
    frame.write.mode(mode).json(f"{path}/{folder}" if folder else path)


def _land_all(spark: SparkSession, sf_dir: str, root: str) -> None:
    part, orders = table(spark, sf_dir, "part"), table(spark, sf_dir, "orders")
    lineitem, supplier = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    _land(docs.naver_title_docs(part), root, "titles")
    _land(docs.naver_finished_docs(supplier), root, "finished_titles")
    _land(docs.naver_info_docs(part), root, "title_info")
    _land(docs.naver_episode_docs(orders), root, "episodes", "all")
    _land(docs.naver_likes_docs(lineitem, orders), root, "episode_likes", "all")
    _land(docs.naver_comments_docs(lineitem, orders), root, "comments", "all")


# --- landing --------------------------------------------------------------------


@query(f"""
    SELECT o_custkey AS title_id, o_orderkey AS id, o_orderpriority AS title,
           '/' || o_orderstatus AS image_url, {_LANDED_SQL}
    FROM orders
""")
def landing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed episode lists with a pinned schema."""
    root = scratch(spark)
    _land(docs.naver_episode_docs(table(spark, sf_dir, "orders")), root, "episodes", "all")
    landed = read_landing(spark, root, NAVER, "episodes", [LANDED_ON], multiline=False)
    episodes = views.naver_episodes(compacted.articles(landed))
    return episodes.select("title_id", "id", "title", "image_url", "landing_date")


@query("""
    SELECT p_partkey AS title_id, unnest(['MONDAY', 'THURSDAY', 'THURSDAY']) AS kind
    FROM part WHERE p_size > 5
    UNION ALL SELECT p_partkey, 'odd_items' FROM part WHERE p_size > 25
    UNION ALL SELECT NULL, 'unreadable' FROM part WHERE p_size <= 5
""")
def listing_by_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good titles beside items that are none, and listings cut in the middle."""
    path = f"{landing_folder(scratch(spark), NAVER, 'titles')}/{LANDED_ON:%Y/%m/%d}"
    title = F.to_json(F.struct(F.col("p_partkey").alias("titleId"), F.col("p_name").alias("titleName")))
    odd = F.when(F.col("p_size") > 25, '"oops", ').otherwise("")
    whole = F.format_string(
        '{"titleListMap": {"MONDAY": [%s], "FRIDAY": null, "THURSDAY": [%s, %s%s]}}',
        title, title, odd, title,
    )
    cut = F.when(F.col("p_size") > 5, whole).otherwise(F.expr("left(whole, length(whole) - 9)"))
    part = table(spark, sf_dir, "part").withColumn("whole", whole)
    part.select(cut.alias("value")).write.text(path)
    read = read_files(spark, path, NAVER, "titles", multiline=False, report=True, files="*.txt")
    flagged = frontier.listing_flags(read)
    titles = compacted.titles_of_all_weekdays(read)
    first = F.get(F.element_at("titleListMap", "MONDAY"), F.lit(0))["titleId"]
    return (
        titles.select(F.col("title.titleId").alias("title_id"), F.col("weekday_str").alias("kind"))
        .unionByName(flagged.where("odd_items").select(first.alias("title_id"), F.lit("odd_items").alias("kind")))
        .unionByName(flagged.where("unreadable").select(
            F.lit(None).cast("bigint").alias("title_id"), F.lit("unreadable").alias("kind")))
    )


@query("SELECT DISTINCT event_type AS folder, TRUE AS has_content FROM events")
def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folders of landed files, from the listing alone."""
    root = scratch(spark)
    events = table(spark, sf_dir, "events")
    path = f"{landing_folder(root, NAVER, 'episode_info')}/{LANDED_ON:%Y/%m/%d}"
    events.write.partitionBy("event_type").json(path)
    files = inventory(spark, root, NAVER, "episode_info")
    folder = F.substring_index(F.substring_index("path", "/", -2), "/", 1)
    return (
        files.groupBy(F.substring_index(folder, "=", -1).alias("folder"))
        .agg((F.sum("length") > 0).alias("has_content"))
    )


@query("""
    SELECT o_custkey AS title_id, o_orderkey AS id,
           unnest([CAST(l_quantity AS BIGINT), CAST(l_linenumber AS BIGINT)]) AS likes
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_returnflag = 'A'
""")
def resumed_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings, compacted in three runs, the second for nothing."""
    root = scratch(spark)
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    finished = F.col("l_linestatus") == "F"
    for run, rows in enumerate((lineitem.where(finished), lineitem.where(~finished))):
        _land(docs.naver_likes_docs(rows, orders), root, "episode_likes", f"part{run}")
        for _ in range(2 - run):
            compact(
                spark,
                root,
                NAVER,
                "episode_likes",
                multiline=False,
            )
    merged = read_merged(spark, root, NAVER, "episode_likes")
    return views.naver_likes(merged).select("title_id", "id", "likes")


# --- tables ----------------------------------------------------------------------


def _yearly_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of all orders, as if landed on the first day of their year."""
    orders = table(spark, sf_dir, "orders")
    year = F.trunc("o_orderdate", "year")
    return compacted.articles(
        orders.select("*", year.alias("landing_date")).transform(
            lambda o: docs.naver_episode_docs(o, keep=["landing_date"])
        )
    ).withColumn("filename", F.concat("article.subtitle", "article.no"))


@query("""
    SELECT o_custkey AS title_id, o_orderkey AS id,
           CAST(date_trunc('year', o_orderdate) AS DATE) AS landing_date,
           year(o_orderdate) = 1997 AS twice
    FROM orders
    UNION ALL
    SELECT o_custkey, o_orderkey, CAST(date_trunc('year', o_orderdate) AS DATE), TRUE
    FROM orders WHERE year(o_orderdate) = 1997
""")
def optimized_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice, read whole and once more for one date."""
    root = scratch(spark)
    frame = _yearly_episodes(spark, sf_dir)
    write_optimized(frame, root, NAVER, "episodes")
    write_optimized(frame, root, NAVER, "episodes")
    picked = date(1997, 1, 1)
    whole = read_optimized(spark, root, NAVER, "episodes")
    one = read_optimized(spark, root, NAVER, "episodes", [picked])
    again = whole.unionByName(one)
    return views.naver_episodes(again).select(
        "title_id", "id", "landing_date", (F.col("landing_date") == picked).alias("twice")
    )


_CURATED_SQL = """
    SELECT '{scope}' AS scope, o_custkey AS title_id, o_orderkey AS id,
           CAST(year(o_orderdate) AS INTEGER) AS "year"
    FROM orders WHERE {where}
"""


@query(
    " UNION ALL ".join(
        _CURATED_SQL.format(scope=scope, where=where)
        for scope, where in (
            ("all", "TRUE"),
            ("dates", "year(o_orderdate) IN (1996, 1998)"),
            ("platform", "year(o_orderdate) = 1999"),
        )
    )
)
def curated_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rerun leaves the table as it was; three scopes of reading it."""
    root = scratch(spark)
    episodes = views.naver_episodes(_yearly_episodes(spark, sf_dir))
    likes = episodes.select(
        "landing_date", "platform", "title_id", "id", F.col("id").alias("likes")
    )
    comments = likes.withColumnRenamed("likes", "comments")
    frame = curation.curate_episodes(episodes, likes, comments, require_date=False)
    for _ in range(2):
        write_curated(frame, root, "episodes")
    scopes = {
        "all": {},
        "dates": {"dates": [date(1996, 1, 1), date(1998, 1, 1)]},
        "platform": {"dates": [date(1999, 1, 1)], "platforms": [NAVER]},
    }
    read = [
        read_curated(spark, root, "episodes", **scope).select(
            F.lit(name).alias("scope"), "title_id", "id", "year"
        )
        for name, scope in scopes.items()
    ]
    return read[0].unionByName(read[1]).unionByName(read[2])


@query("SELECT c_custkey AS id, c_name AS title FROM customer")
def backup_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: the second backup replaces the first."""
    root = scratch(spark)
    customer = table(spark, sf_dir, "customer")
    frame = customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"))
    for _ in range(2):
        backup(frame, root, NAVER, "titles")
    return spark.read.parquet(backup_path(root, NAVER, "titles"))


@query(f"""
    (SELECT 'reader' AS used_by, o_orderkey AS id FROM orders
     ORDER BY o_orderkey LIMIT {READER_PREVIEW_ROWS})
    UNION ALL
    (SELECT 'job', o_orderkey FROM orders ORDER BY o_orderkey LIMIT {JOB_PREVIEW_ROWS})
""")
def table_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows by key, for the reader and for a job."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    reader = preview(orders, READER_PREVIEW_ROWS, ["id"])
    job = preview(orders, JOB_PREVIEW_ROWS, ["id"])
    return reader.select(F.lit("reader").alias("used_by"), "id").unionByName(
        job.select(F.lit("job").alias("used_by"), "id")
    )


# --- whole runs ------------------------------------------------------------------


@query(
    _EPISODE_SQL.format(
        date="e.listed_date", side="l", where="WHERE e.listed_date IS NOT NULL"
    )
)
def days_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed documents to the episodes view of SQL users."""
    root = scratch(spark)
    _land_all(spark, sf_dir, root)
    runs.run_days(spark, root, [LANDED_ON], [NAVER], multiline=False)
    register_views(spark, root)
    return spark.sql("""
        SELECT platform, title_id, id, title, likes, comments, image_url, updated_date
        FROM episodes WHERE year = 2025 AND month = 2 AND day = 27
    """)


_TITLE_SQL = """
    SELECT DISTINCT 'naver' AS platform, p_partkey AS id, p_name AS title,
           p_brand AS author, CAST(trunc(p_retailprice) AS BIGINT) AS views,
           '/' || p_name AS image_url, {day} AS release_day, FALSE AS is_completed
    FROM part {join}
    UNION ALL
    SELECT DISTINCT 'naver', s_suppkey, s_name, 'staff',
           CAST(trunc(s_acctbal) AS BIGINT), '/' || s_name, {finished_day}, TRUE
    FROM supplier {finished_join}
"""


@query(
    _TITLE_SQL.format(
        day="unnest(CASE WHEN p_size > 25 THEN [0, 3, 6] ELSE [0, 3] END)",
        join="",
        finished_day="7",
        finished_join="",
    )
)
def history_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The resumable backfill, its titles."""
    root = scratch(spark)
    _land_all(spark, sf_dir, root)
    runs.run_history(spark, root, [LANDED_ON], [NAVER], multiline=False)
    titles = read_curated(spark, root, "titles", [LANDED_ON], [NAVER])
    return titles.drop("year", "month", "day")


_INFO_SQL = """
    LEFT JOIN (SELECT p_partkey AS key,
                      unnest(CASE WHEN p_size > 30 THEN [7] WHEN p_size > 20 THEN [0, 5]
                                  ELSE [1] END) AS release_day
               FROM part WHERE p_size >= 5) ON {key} = key
"""


@query(
    _TITLE_SQL.format(
        day="release_day",
        join=_INFO_SQL.format(key="p_partkey"),
        finished_day="release_day",
        finished_join=_INFO_SQL.format(key="s_suppkey"),
    )
)
def direct_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The backfill straight from landed documents, its titles."""
    root = scratch(spark)
    _land_all(spark, sf_dir, root)
    runs.run_direct(spark, root, [LANDED_ON], [NAVER], multiline=False)
    titles = read_curated(spark, root, "titles", [LANDED_ON], [NAVER])
    return titles.drop("year", "month", "day")


@query("""
    SELECT o_custkey AS title_id, o_orderkey AS id FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def titles_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed episode lists in the folders of the titles of a frame."""
    root = scratch(spark)
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    segments = customer.select("c_custkey", "c_mktsegment")
    owned = orders.join(segments, F.col("o_custkey") == F.col("c_custkey"))
    lists = docs.naver_episode_docs(owned, keep=["c_mktsegment"])
    path = f"{landing_folder(root, NAVER, 'episodes')}/{LANDED_ON:%Y/%m/%d}"
    lists.write.partitionBy("c_mktsegment").json(path)
    # one folder per segment stands in for one folder per title
    wanted = customer.where(F.col("c_mktsegment") == "BUILDING").select(
        F.concat(F.lit("c_mktsegment="), "c_mktsegment").alias("title_id")
    )
    landed = read_landing(spark, root, NAVER, "episodes", [LANDED_ON], multiline=False)
    picked = compacted.articles(of_titles(landed, wanted))
    return picked.select("title_id", F.col("article.no").alias("id"))
