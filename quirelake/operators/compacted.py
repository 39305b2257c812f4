"""Landing document -> compacted shape (the outermost list flattened).

Each function takes landing documents with ``filename`` and
``landing_date`` and keeps those two columns beside its own.  All of it is
narrow: no function here shuffles.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirelake.conventions import FINISHED_WEEKDAY, KAKAO, NAVER
from quirelake.functions import path_stem, path_title, weekday_key


def provenance(df: DataFrame) -> list[str]:
    """The bookkeeping columns present in a frame; they travel with every row."""
    return [c for c in ("filename", "landing_date") if c in df.columns]


def weekday_lists(docs: DataFrame) -> Column:
    """The weekday lists as a map, also where the object was read as a struct."""
    kind = docs.schema["titleListMap"].dataType
    lists = F.col("titleListMap")
    if not isinstance(kind, T.StructType):
        return lists
    pairs = [part for day in kind.names for part in (F.lit(day), lists[day])]
    return F.create_map(*pairs)


def titles_of_weekday(docs: DataFrame, weekday) -> DataFrame:
    """The list stored under one weekday key, here given per row."""
    listed = F.try_element_at(weekday_lists(docs), weekday)
    return docs.select(
        F.explode(listed).alias("title"),
        weekday.alias("weekday_str"),
        *provenance(docs),
    )


def titles_of_run_day(docs: DataFrame) -> DataFrame:
    """Only the list of the landing date's own weekday."""
    return titles_of_weekday(docs, weekday_key("landing_date"))


def titles_of_all_weekdays(docs: DataFrame) -> DataFrame:
    """Every weekday's list, from one scan of the documents."""
    kept = provenance(docs)
    lists = docs.select(F.explode(weekday_lists(docs)).alias("weekday_str", "listed"), *kept)
    return lists.select(F.explode("listed").alias("title"), "weekday_str", *kept)


def finished_list(docs: DataFrame) -> DataFrame:
    """The finished list, under a weekday name of its own."""
    return docs.select(
        F.explode("titleList").alias("title"),
        F.lit(FINISHED_WEEKDAY).alias("weekday_str"),
        *provenance(docs),
    )


def articles(docs: DataFrame) -> DataFrame:
    """X13, first half: one row per listed article."""
    return docs.select(
        F.explode("articleList").alias("article"),
        F.col("titleId").alias("title_id"),
        *provenance(docs),
    )


def sections(docs: DataFrame) -> DataFrame:
    """X1, X2, first half: one row per section of a title page."""
    return docs.select(F.explode("data").alias("data"), *provenance(docs))


def listed_episodes(docs: DataFrame) -> DataFrame:
    """X5, first half: one row per listed episode."""
    return docs.select(
        F.explode("data.episodes").alias("episodes"), *provenance(docs)
    )


def with_path_keys(docs: DataFrame) -> DataFrame:
    """Title and episode keys, which only the file path carries."""
    return docs.withColumns(
        {
            "title_id": path_title("filename"),
            "episode_id": path_stem("filename"),
        }
    )


def unchanged(docs: DataFrame) -> DataFrame:
    """Pass-through compaction."""
    return docs


_SHAPES = {
    (NAVER, "finished_titles"): finished_list,
    (NAVER, "episodes"): articles,
    (KAKAO, "titles"): sections,
    (KAKAO, "finished_titles"): sections,
    (KAKAO, "episodes"): listed_episodes,
    (KAKAO, "comments"): with_path_keys,
}


def passes_through(platform: str, target: str) -> bool:
    """Whether a document is one row of the compacted shape."""
    return (platform, target) != (NAVER, "titles") and _SHAPES.get(
        (platform, target), unchanged
    ) in (unchanged, with_path_keys)


def compact_shape(
    docs: DataFrame, platform: str, target: str, all_weekdays: bool
) -> DataFrame:
    """The compacted shape of one platform's target."""
    if (platform, target) == (NAVER, "titles"):
        return titles_of_all_weekdays(docs) if all_weekdays else titles_of_run_day(docs)
    return _SHAPES.get((platform, target), unchanged)(docs)
