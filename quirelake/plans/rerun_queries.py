"""Queries over runs that are repeated, cover several dates, or meet odd documents."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.conventions import KAKAO, NAVER
from quirelake.operators import compacted, drift, views
from quirelake.plans import runs
from quirelake.plans import star_docs as docs
from quirelake.plans.registry import query
from quirelake.plans.scratch import scratch
from quirelake.plans.star_docs import table
from quirelake.plans.view_queries import _CARD_SQL
from quirelake.sources import (
    inventory,
    inventory_changes,
    read_curated,
    read_files,
    read_landing,
    read_optimized,
    read_quarantine,
    write_optimized,
)
from quirelake.sources.layout import landing_folder
from quirelake.streaming import compact, read_ledger, read_merged

THURSDAY = date(2025, 2, 27)
FRIDAY = date(2025, 2, 28)
MONDAY = date(2025, 3, 3)


def _land(frame: DataFrame, root: str, platform: str, target: str, day: date, folder: str = ""):
    path = f"{landing_folder(root, platform, target)}/{day:%Y/%m/%d}"
    frame.write.mode("append").json(f"{path}/{folder}" if folder else path)


@query("""
    SELECT DISTINCT CAST(3 AS INTEGER) AS "month", CAST(3 AS INTEGER) AS "day", p_partkey AS id,
           p_name AS title, CAST(0 AS INTEGER) AS release_day
    FROM part
""")
def empty_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: two dates are curated; a rerun of the first finds nothing any more and clears it."""
    root = scratch(spark)
    titles = docs.naver_title_docs(table(spark, sf_dir, "part"))
    for day in (THURSDAY, MONDAY):
        _land(titles, root, NAVER, "titles", day)
    runs.run_days(spark, root, [THURSDAY, MONDAY], [NAVER], multiline=False)
    nothing = read_optimized(spark, root, NAVER, "titles", [THURSDAY]).limit(0)
    write_optimized(nothing, root, NAVER, "titles", dates=[THURSDAY])
    runs.curate_days(spark, root, [THURSDAY], [NAVER])
    return read_curated(spark, root, "titles").select("month", "day", "id", "title", "release_day")


@query("""
    SELECT o_custkey AS title_id, o_orderkey AS id,
           unnest([CAST(l_quantity AS BIGINT), CAST(l_linenumber AS BIGINT)]) AS likes,
           CASE WHEN l_linenumber = 1 THEN DATE '2025-02-27' WHEN l_linenumber < 4
                THEN DATE '2025-02-28' ELSE DATE '2025-03-03' END AS landing_date,
           (SELECT count(*) FROM lineitem) AS documents
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_returnflag = 'A'
""")
def compaction_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three landing dates, compacted in three runs; the ledger knows all documents."""
    root = scratch(spark)
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    number = F.col("l_linenumber")
    of_date = {THURSDAY: number == 1, FRIDAY: (number > 1) & (number < 4), MONDAY: number > 3}
    for day, rows in of_date.items():
        _land(docs.naver_likes_docs(lineitem.where(rows), orders), root, NAVER, "episode_likes", day, "a")
    for dates in ([FRIDAY], None, None):
        compact(spark, root, NAVER, "episode_likes", dates, multiline=False)
    total = read_ledger(spark, root, NAVER, "episode_likes").agg(F.sum("documents")).first()[0]
    likes = views.naver_likes(read_merged(spark, root, NAVER, "episode_likes"))
    return likes.select("title_id", "id", "likes", "landing_date", F.lit(total).cast("bigint").alias("documents"))


_LISTED_SQL = """
    SELECT DISTINCT CASE WHEN p_size > 25 THEN DATE '2025-02-27' ELSE DATE '2025-02-28' END
             AS landing_date, 'titles' AS kept_in, p_partkey AS title_id, p_name AS name,
           unnest(CASE WHEN p_size > 25 THEN [0, 3, 6] ELSE [0, 3] END) AS release_day
    FROM part
    UNION ALL
    SELECT DISTINCT CASE WHEN p_size > 25 THEN DATE '2025-02-27' ELSE DATE '2025-02-28' END,
           'genres', p_partkey, unnest([p_brand, p_type]), NULL
    FROM part WHERE p_size >= 5
"""


@query(_LISTED_SQL)
def history_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: a second landing date is added to a history; the run takes only that date."""
    root = scratch(spark)
    part = table(spark, sf_dir, "part")
    large = F.col("p_size") > 25
    for day, rows in ((THURSDAY, part.where(large)), (FRIDAY, part.where(~large))):
        _land(docs.naver_title_docs(rows), root, NAVER, "titles", day)
        _land(docs.naver_info_docs(rows), root, NAVER, "title_info", day)
        runs.run_history(spark, root, platforms=[NAVER], multiline=False)
    on = F.make_date("year", "month", "day").alias("landing_date")
    titles = read_curated(spark, root, "titles").select(
        on, F.lit("titles").alias("kept_in"), F.col("id").alias("title_id"),
        F.col("title").alias("name"), "release_day",
    )
    genres = read_curated(spark, root, "genres").select(
        on, F.lit("genres").alias("kept_in"), "title_id", F.col("genre_name").alias("name"),
        F.lit(None).cast("int").alias("release_day"),
    )
    return titles.unionByName(genres)


@query(f"""
    WITH {_CARD_SQL}, dated AS (
      SELECT *, CAST(CASE WHEN segment IN ('AUTOMOBILE', 'BUILDING') THEN 27 ELSE 28 END
                     AS INTEGER) AS "day" FROM cards WHERE balance >= 0)
    SELECT DISTINCT 'titles' AS kept_in, "day", id AS title_id, CAST(NULL AS BIGINT) AS id,
           title || ' by ' || author AS name, CAST(trunc(balance) AS BIGINT) AS "first",
           CAST(release_day AS BIGINT) AS "second"
    FROM dated
    UNION ALL
    SELECT DISTINCT 'genres', "day", id, NULL, unnest([segment, 'all']), NULL, NULL FROM dated
    UNION ALL
    SELECT DISTINCT 'episodes', CAST(CASE WHEN o_orderstatus = 'F' THEN 27 ELSE 28 END AS INTEGER),
           o_custkey, o_orderkey, o_orderpriority || ' on ' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR),
           CASE WHEN o_orderstatus <> 'P' THEN CAST(trunc(o_totalprice) AS BIGINT) END,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(length(o_orderpriority) AS BIGINT) END
    FROM orders
""")
def kakao_range_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two dates of the other platform in one run; all three tables."""
    root = scratch(spark)
    customer, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    early = F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")
    closed = F.col("o_orderstatus") == "F"
    dates = [THURSDAY, FRIDAY]
    for day, who, what in ((THURSDAY, early, closed), (FRIDAY, ~early, ~closed)):
        _land(docs.kakao_title_docs(customer.where(who)), root, KAKAO, "titles", day)
        _land(docs.kakao_info_docs(customer.where(who)), root, KAKAO, "title_info", day)
        _land(docs.kakao_episode_docs(orders.where(what)), root, KAKAO, "episodes", day, "all")
    runs.optimize_days(spark, root, dates, [KAKAO], multiline=False)
    # keys of these two targets lie in their paths, one file per episode: as if compacted from those
    for target, made in (("episode_likes", docs.kakao_likes_docs), ("comments", docs.kakao_comments_docs)):
        responses = made(orders.where(closed)).withColumn("landing_date", F.lit(THURSDAY)).unionByName(
            made(orders.where(~closed)).withColumn("landing_date", F.lit(FRIDAY)))
        shaped = compacted.compact_shape(responses, KAKAO, target, all_weekdays=False)
        write_optimized(shaped, root, KAKAO, target, dates=dates)
    runs.curate_days(spark, root, dates, [KAKAO])
    none = F.lit(None).cast("bigint")
    titles = read_curated(spark, root, "titles").select(
        F.lit("titles").alias("kept_in"), "day", F.col("id").alias("title_id"), none.alias("id"),
        F.concat("title", F.lit(" by "), "author").alias("name"), F.col("views").alias("first"),
        F.col("release_day").cast("bigint").alias("second"),
    )
    genres = read_curated(spark, root, "genres").select(
        F.lit("genres").alias("kept_in"), "day", "title_id", none.alias("id"),
        F.col("genre_name").alias("name"), none.alias("first"), none.alias("second"),
    )
    episodes = read_curated(spark, root, "episodes").select(
        F.lit("episodes").alias("kept_in"), "day", "title_id", "id",
        F.concat("title", F.lit(" on "), F.col("updated_date").cast("string")).alias("name"),
        F.col("likes").alias("first"), F.col("comments").alias("second"),
    )
    return titles.unionByName(genres).unionByName(episodes)


@query("""
    SELECT 'title' AS kind, s_suppkey AS n FROM supplier WHERE s_nationkey <> 3
    UNION ALL
    SELECT 'odd_items', count(*) FROM supplier WHERE s_nationkey <> 3 AND s_acctbal < 0
    UNION ALL
    SELECT 'unreadable', count(*) FROM supplier WHERE s_nationkey = 3
""")
def quarantined_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section lists, a file each, some odd at every level and some no list at all."""
    root = scratch(spark)
    supplier = table(spark, sf_dir, "supplier")
    card = F.to_json(F.struct(F.struct(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("title"),
        F.array(F.lit("#all")).alias("seoKeywords"),
    ).alias("content")))
    whole = F.format_string('[{"title": "완결", "cardGroups": [{"cards": [%s]}]}]', card)
    odd = F.format_string(
        '["oops", {"title": "완결", "cardGroups": [7, {"cards": [%s, null, {"content": "text"}]},'
        ' {"cards": "none"}]}]', card,
    )
    data = (
        F.when(F.col("s_nationkey") == 3, F.lit("5")).when(F.col("s_acctbal") < 0, odd)
        .otherwise(whole)
    )
    # a file costs milliseconds, so they are made and committed by many tasks
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    listings = supplier.repartition(tasks).select(F.parse_json(data).alias("data"))
    path = f"{landing_folder(root, KAKAO, 'finished_titles')}/{THURSDAY:%Y/%m/%d}"
    writer = listings.write.option("mapreduce.fileoutputcommitter.algorithm.version", 2)
    writer.option("maxRecordsPerFile", 1).json(path)
    runs.run_history(spark, root, platforms=[KAKAO], quarantine=True)
    titles = read_curated(spark, root, "titles").select(F.lit("title").alias("kind"), F.col("id").alias("n"))
    held = read_quarantine(spark, root, [THURSDAY], [KAKAO])
    counts = [held.where(F.col("problem") == kind).agg(F.count("*").alias("n"))
              .select(F.lit(kind).alias("kind"), "n") for kind in ("odd_items", "unreadable")]
    return titles.unionByName(counts[0]).unionByName(counts[1])


@query("""
    SELECT DISTINCT event_type AS folder,
           unnest(CASE event_type WHEN 'click' THEN ['added']
                                  WHEN 'error' THEN ['added', 'gone'] END) AS change
    FROM events
""")
def inventory_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder is added and one is written anew between two inventories."""
    root = scratch(spark)
    events = table(spark, sf_dir, "events")
    path = f"{landing_folder(root, NAVER, 'episode_info')}/{THURSDAY:%Y/%m/%d}"
    is_click, is_error = F.col("event_type") == "click", F.col("event_type") == "error"
    events.where(~is_click).write.partitionBy("event_type").json(path)
    inventory(spark, root, NAVER, "episode_info").write.parquet(f"{root}/before")
    events.where(is_click).write.mode("append").partitionBy("event_type").json(path)
    events.where(is_error).drop("event_type").write.mode("overwrite").json(f"{path}/event_type=error")
    before = spark.read.parquet(f"{root}/before")
    changes = inventory_changes(before, inventory(spark, root, NAVER, "episode_info"))
    folder = F.substring_index(F.substring_index(F.substring_index("path", "/", -2), "/", 1), "=", -1)
    return changes.select(folder.alias("folder"), "change").distinct()


@query("""
    WITH n AS (SELECT count(*) FILTER (event_type = 'click' OR event_type = 'error') AS early,
                      count(*) AS whole FROM events)
    SELECT unnest(['id', 'user', 'id', 'known']) AS field,
           unnest(['STRING', 'BIGINT', 'BIGINT', 'BOOLEAN']) AS kind,
           unnest(['new', 'new', 'gone', 'gone']) AS change,
           unnest([whole - early, whole - early, early, early]) AS documents
    FROM n
""")
def episode_info_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents kept as VARIANT through the compaction, and how their fields change."""
    root = scratch(spark)
    events = table(spark, sf_dir, "events")
    early = F.col("event_type").isin("click", "error")
    kind = F.col("event_type").alias("type")
    first = events.where(early).select(F.col("event_id").alias("id"), kind, F.lit(True).alias("known"))
    second = events.where(~early).select(
        F.col("event_id").cast("string").alias("id"), kind, F.col("user_id").alias("user")
    )
    _land(first, root, NAVER, "episode_info", THURSDAY, "all")
    _land(second, root, NAVER, "episode_info", FRIDAY, "all")
    compact(spark, root, NAVER, "episode_info", multiline=False)
    changes = drift.schema_drift(read_merged(spark, root, NAVER, "episode_info"))
    return changes.select("field", "kind", "change", "documents")


@query("""
    SELECT p_partkey AS id,
           unnest(CASE WHEN p_size > 25 THEN ['MONDAY', 'THURSDAY', 'THURSDAY', 'SUNDAY']
                       ELSE ['MONDAY', 'THURSDAY', 'THURSDAY'] END) AS weekday_str
    FROM part
""")
def weekday_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekday lists read as a struct instead of a map."""
    listed = docs.naver_title_docs(table(spark, sf_dir, "part"))
    days = ("MONDAY", "TUESDAY", "THURSDAY", "SUNDAY")
    struct = F.struct(*[F.try_element_at("titleListMap", F.lit(d)).alias(d) for d in days])
    titles = compacted.titles_of_all_weekdays(listed.select(struct.alias("titleListMap")))
    return titles.select(F.col("title.titleId").alias("id"), "weekday_str")


@query("""
    SELECT unnest(['folders', 'files']) AS picked_by, o_custkey AS title_id, o_orderkey AS id
    FROM orders WHERE o_orderstatus IN ('F', 'P')
""")
def selected_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of named folders, and of files picked from the inventory."""
    root = scratch(spark)
    lists = docs.naver_episode_docs(table(spark, sf_dir, "orders"), keep=["o_orderstatus"])
    path = f"{landing_folder(root, NAVER, 'episodes')}/{THURSDAY:%Y/%m/%d}"
    lists.write.partitionBy("o_orderstatus").json(path)
    folders = ["o_orderstatus=F", "o_orderstatus=P"]
    by_folder = read_landing(spark, root, NAVER, "episodes", [THURSDAY], folders, multiline=False)
    files = inventory(spark, root, NAVER, "episodes", [THURSDAY]).select("path")
    wanted = files.where(F.col("path").rlike("/o_orderstatus=[FP]/")).collect()
    by_file = read_files(spark, [r.path for r in wanted], NAVER, "episodes", multiline=False)
    found = [
        compacted.articles(read).select(
            F.lit(name).alias("picked_by"), "title_id", F.col("article.no").alias("id")
        )
        for name, read in (("folders", by_folder), ("files", by_file))
    ]
    return found[0].unionByName(found[1])
