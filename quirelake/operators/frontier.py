"""Follow-up work tables: which documents to ask for next.

The decisions a crawler takes per title are taken here over landed documents,
for all titles at once.  No request is made.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirelake.conventions import FREE_USE_TYPE
from quirelake.functions import fill_template, first_item
from quirelake.operators.compacted import titles_of_all_weekdays, titles_of_weekday


def of_platform(ids: DataFrame, platform: str) -> DataFrame:
    """Ids with the platform that gave them; equal numbers of two platforms are two titles."""
    return ids.withColumn("platform", F.lit(platform))


def naver_title_ids(docs: DataFrame, weekday: Column | None = None) -> DataFrame:
    """Listed title ids, of all weekdays or of one."""
    listed = (
        titles_of_all_weekdays(docs)
        if weekday is None
        else titles_of_weekday(docs, weekday)
    )
    return listed.select(F.col("title.titleId").alias("title_id")).distinct()


def naver_finished_ids(docs: DataFrame) -> DataFrame:
    """Title ids of the finished list."""
    titles = docs.select(F.explode("titleList").alias("title"))
    return titles.select(F.col("title.titleId").alias("title_id")).distinct()


def kakao_title_ids(docs: DataFrame) -> DataFrame:
    """Title ids in the first card group of the first section of each page."""
    first_group = first_item(first_item("data")["cardGroups"])
    cards = docs.select(F.explode(first_group["cards"]).alias("card"))
    return cards.select(F.col("card.content.id").alias("title_id")).distinct()


def all_title_ids(ongoing: DataFrame, finished: DataFrame) -> DataFrame:
    """R2: ongoing and finished ids one after the other; an id may come twice."""
    return ongoing.unionByName(finished)


def requests(keys: DataFrame, template: str) -> DataFrame:
    """The address of each key row; template places are column names."""
    places = {c: F.col(c) for c in keys.columns}
    return keys.withColumn("url", fill_template(template, **places))


def numbered(
    df: DataFrame,
    count: str,
    name: str,
    spark: SparkSession | None = None,
    block: int = 100_000,
) -> DataFrame:
    """Each row once per number 1..count.

    Numbers come in blocks that are spread over the cluster before they are
    written out, so a row with a very large count is neither one huge array
    nor the work of one task.
    """
    spark = spark or df.sparkSession
    pieces = int(spark.conf.get("spark.sql.shuffle.partitions"))
    positive = df.where(F.col(count) > 0)
    last_block = F.floor((F.col(count) - 1) / block)
    blocks = positive.select(
        "*", F.explode(F.sequence(F.lit(0), last_block)).alias("__block")
    ).repartition(pieces)
    first = F.col("__block") * block + 1
    last = F.least((F.col("__block") + 1) * block, F.col(count))
    return blocks.select(
        *df.columns, F.explode(F.sequence(first, last)).alias(name)
    )


def top_rows(
    df: DataFrame, by: list[str], order: list[Column], rows: int
) -> DataFrame:
    """The first rows per group, ranks included.

    Spark cuts each map task's share of a group to ``rows`` before the
    shuffle (window group limit), so a heavy group stays small.
    """
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= rows)


def latest_episodes(episodes: DataFrame, rows: int) -> DataFrame:
    """The newest episodes per title, by number.

    Titles are told apart by platform, and landings by date, where the columns are
    there; an episode that landed twice counts once: of its copies the one from the last
    file counts, or else the greatest row, so that a task run again picks the same.
    """
    by = [c for c in ("platform", "landing_date", "title_id") if c in episodes.columns]
    others = sorted((c for c in episodes.columns if c not in (*by, "id")), key=lambda c: c != "filename")
    if others:
        last = F.max(F.struct(*others)).alias("__last")
        once = episodes.groupBy(*by, "id").agg(last).select(*by, "id", "__last.*")
    else:
        once = episodes.distinct()
    return top_rows(once.select(*episodes.columns), by, [F.desc("id")], rows)


def kakao_listed_episodes(df: DataFrame) -> DataFrame:
    """Listed episodes with what they cost now."""
    return df.select(
        F.col("episodes.contentId").alias("title_id"),
        F.col("episodes.id").alias("id"),
        F.col("episodes.useType").alias("use_type"),
    )


def free_episodes(episodes: DataFrame) -> DataFrame:
    """Only episodes that cost nothing now."""
    return episodes.where(F.col("use_type") == FREE_USE_TYPE)


def uncovered(titles: DataFrame, episode_counts: DataFrame) -> DataFrame:
    """Titles whose episode count is missing or 0."""
    both = [c for c in ("platform", "title_id")
            if c in titles.columns and c in episode_counts.columns]
    counted = episode_counts.where(F.col("episodes") > 0).select(*both).distinct()
    return titles.join(counted, both, "left_anti")


# --- quality flags (R10) ---------------------------------------------------------


def comments_flags(docs: DataFrame) -> DataFrame:
    """Responses that count no comments."""
    return docs.withColumn("no_comments", F.col("result.count.total").eqNullSafe(0))


def likes_flags(docs: DataFrame) -> DataFrame:
    """Responses whose first content has neither reactions nor a reaction map."""
    content = first_item("contents")
    no_reactions = F.coalesce(F.size(content["reactions"]) == 0, F.lit(True))
    no_map = F.coalesce(F.size(content["reactionMap"]) == 0, F.lit(True))
    return docs.withColumn("no_likes", no_reactions & no_map)


def articles_flags(docs: DataFrame) -> DataFrame:
    """Episode lists without a single article."""
    empty = F.coalesce(F.size("articleList") == 0, F.lit(True))
    return docs.withColumn("no_articles", empty)


def listing_flags(docs: DataFrame) -> DataFrame:
    """Title lists with an item that is no title.

    Items that are no objects are seen where documents are read, with ``report``.
    """
    odd = F.exists(
        F.map_values("titleListMap"),
        lambda listed: F.coalesce(F.exists(listed, lambda t: t["titleId"].isNull()), F.lit(False)),
    )
    odd = F.coalesce(odd, F.lit(False))
    return docs.withColumn("odd_items", odd | F.col("odd_items") if "odd_items" in docs.columns else odd)


def exceptions(flagged: DataFrame, flag: str, key: Column) -> DataFrame:
    """The keys of flagged documents, in one shape for all flags."""
    return flagged.where(flag).select(key.cast("string").alias("key"), F.lit(flag).alias("flag"))
