"""Compacted shape -> flat views, one function per platform and target.

The views of both platforms agree on their columns, so a caller can union
them and curate all platforms in one job.  Explodes drop rows with an empty
or NULL array, as the curated contract expects; ``keep_empty`` keeps them.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirelake.conventions import KAKAO, MISSING_WEEKDAY, NAVER, WEEKDAY_BADGE
from quirelake.functions import (
    epoch_ms_date,
    explode_or,
    first_item,
    iso_date,
    items_where,
    join_names,
    key_part,
    path_stem,
    path_title,
    release_day,
    short_date,
)


def _dated(df: DataFrame) -> list[str]:
    return ["landing_date"] if "landing_date" in df.columns else []


def _platform(name: str) -> Column:
    return F.lit(name).alias("platform")


# --- naver -------------------------------------------------------------------


def naver_titles(df: DataFrame, completed: bool = False) -> DataFrame:
    """One row per listed title."""
    return df.select(
        *_dated(df),
        _platform(NAVER),
        F.col("title.titleId").alias("id"),
        F.col("title.titleName").alias("title"),
        F.col("title.author").alias("author"),
        F.col("title.viewCount").alias("views"),
        F.col("title.thumbnailUrl").alias("image_url"),
        F.col("weekday_str").alias("weekday"),
        release_day("weekday_str").alias("release_day"),
        F.lit(completed).alias("is_completed"),
    )


def naver_genres(df: DataFrame) -> DataFrame:
    """X11: one row per tag."""
    return df.select(
        *_dated(df),
        _platform(NAVER),
        F.col("gfpAdCustomParam.titleId").alias("title_id"),
        F.explode("gfpAdCustomParam.tags").alias("genre_name"),
    )


def naver_info_weekdays(df: DataFrame) -> DataFrame:
    """Tags x weekdays of a title; a title without tags has no row."""
    info = F.col("gfpAdCustomParam")
    tagged = df.select(
        *_dated(df),
        info["titleId"].alias("title_id"),
        info["weekdays"].alias("weekdays"),
        F.explode(info["tags"]).alias("genre_name"),
    )
    return tagged.select(
        *_dated(df),
        _platform(NAVER),
        "title_id",
        "genre_name",
        explode_or("weekdays", F.lit(MISSING_WEEKDAY)).alias("weekday"),
    ).withColumn("release_day", release_day("weekday"))


def naver_title_days(df: DataFrame, keep_empty: bool = False) -> DataFrame:
    """X12 less the tags: the weekdays of titles that have at least one tag, or of all.

    What a DISTINCT over (title, weekday) needs, without first multiplying
    every weekday by every tag.
    """
    info = F.col("gfpAdCustomParam")
    return (
        df.where(F.lit(keep_empty) | (F.size(info["tags"]) > 0))
        .select(
            *_dated(df),
            _platform(NAVER),
            info["titleId"].alias("id"),
            explode_or(info["weekdays"], F.lit(MISSING_WEEKDAY)).alias("weekday"),
        )
        .select(
            *_dated(df), "platform", "id", release_day("weekday").alias("release_day")
        )
    )


def naver_episodes(df: DataFrame) -> DataFrame:
    """One row per article."""
    return df.select(
        *_dated(df),
        _platform(NAVER),
        "title_id",
        F.col("article.no").alias("id"),
        F.col("article.subtitle").alias("title"),
        F.col("article.thumbnailUrl").alias("image_url"),
        short_date("article.serviceDateDescription").alias("updated_date"),
    )


def naver_likes(df: DataFrame) -> DataFrame:
    """One row per reaction of the first content; the response date beside it."""
    response = df.select(
        *_dated(df), first_item("contents").alias("content"), "timestamp"
    )
    reactions = response.select(
        *_dated(df),
        F.col("content.contentsId").alias("key"),
        F.explode("content.reactions").alias("reaction"),
        "timestamp",
    )
    return reactions.select(
        *_dated(df),
        _platform(NAVER),
        key_part("key", 0).alias("title_id"),
        key_part("key", 1).alias("id"),
        F.col("reaction.count").alias("likes"),
        epoch_ms_date("timestamp").alias("response_date"),
    )


def naver_comments(df: DataFrame) -> DataFrame:
    """Total with the key of the first comment; no comment, no key."""
    key = first_item("result.commentList")["objectId"]
    return df.select(
        *_dated(df),
        _platform(NAVER),
        key_part(key, 0).alias("title_id"),
        key_part(key, 1).alias("id"),
        F.col("result.count.total").alias("comments"),
    )


# --- kakao -------------------------------------------------------------------


def kakao_cards(df: DataFrame, completed: bool = False) -> DataFrame:
    """One row per card, its keywords still an array."""
    groups = df.select(
        *_dated(df),
        F.col("data.title").alias("weekday"),
        F.explode("data.cardGroups").alias("card_group"),
    )
    cards = groups.select(
        *_dated(df), "weekday", F.explode("card_group.cards").alias("card")
    )
    content = F.col("card.content")
    return cards.select(
        *_dated(df),
        _platform(KAKAO),
        content["id"].alias("id"),
        content["title"].alias("title"),
        join_names(content["authors"]["name"]).alias("author"),
        content["featuredCharacterImageA"].alias("image_url"),
        "weekday",
        release_day("weekday").alias("release_day"),
        F.lit(completed).alias("is_completed"),
        content["seoKeywords"].alias("keywords"),
    )


def kakao_titles(
    df: DataFrame, completed: bool = False, keep_empty: bool = False
) -> DataFrame:
    """One row per card and keyword (G7: or one with a NULL genre)."""
    generator = F.explode_outer if keep_empty else F.explode
    cards = kakao_cards(df, completed)
    kept = [c for c in cards.columns if c != "keywords"]
    return cards.select(*kept, generator("keywords").alias("genre_name"))


def kakao_views(df: DataFrame) -> DataFrame:
    """View count per title."""
    return df.select(
        *_dated(df),
        _platform(KAKAO),
        F.col("data.id").alias("id"),
        F.col("data.statistics.viewCount").alias("views"),
    )


def kakao_views_by_badge(df: DataFrame) -> DataFrame:
    """View count and weekday per weekday badge; no badge, no row."""
    badges = df.select(
        *_dated(df),
        F.col("data.id").alias("id"),
        F.col("data.statistics.viewCount").alias("views"),
        F.explode(items_where("data.badges", "type", WEEKDAY_BADGE)).alias("badge"),
    )
    return badges.select(
        *_dated(df),
        _platform(KAKAO),
        "id",
        "views",
        F.col("badge.title").alias("weekday"),
        release_day("badge.title").alias("release_day"),
    )


def kakao_episodes(df: DataFrame, date_field: str = "serialStartDateTime") -> DataFrame:
    """One row per episode, dated by the given field."""
    return df.select(
        *_dated(df),
        _platform(KAKAO),
        F.col("episodes.contentId").alias("title_id"),
        F.col("episodes.id").alias("id"),
        F.col("episodes.title").alias("title"),
        F.col("episodes.asset.thumbnailImage").alias("image_url"),
        iso_date(F.col("episodes")[date_field]).alias("updated_date"),
    )


def kakao_likes(df: DataFrame) -> DataFrame:
    """Like count per episode; the title comes from the path."""
    return df.select(
        *_dated(df),
        _platform(KAKAO),
        path_title("filename").try_cast("bigint").alias("title_id"),
        F.col("data.episodeId").alias("id"),
        F.col("data.likeCount").alias("likes"),
    )


def kakao_comments(df: DataFrame) -> DataFrame:
    """Comment total per episode; both keys come from the path."""
    return df.select(
        *_dated(df),
        _platform(KAKAO),
        F.col("title_id").try_cast("bigint").alias("title_id"),
        path_stem("episode_id").try_cast("bigint").alias("id"),
        F.col("meta.pagination.totalCount").alias("comments"),
    )
