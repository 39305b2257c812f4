"""Flat views -> the three curated tables.

DISTINCT is taken on the inputs of a join, not on its output.  A join of
distinct inputs that keeps all their columns is distinct already, copies are
combined before they are shuffled, and the join sees no repeated rows.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelake.conventions import EPISODE_COLUMNS, GENRE_COLUMNS, TITLE_COLUMNS
from quirelake.functions import drop_prefix
from quirelake.operators.skew import (
    DEFAULT_POLICY,
    SkewPolicy,
    chained_left_join,
    left_join,
    star_left_join,
)


def _dated(df: DataFrame) -> list[str]:
    return ["landing_date"] if "landing_date" in df.columns else []


def _with_columns(df: DataFrame, contract: tuple[str, ...]) -> DataFrame:
    return df.select(*_dated(df), *contract)


def with_keywords(cards: DataFrame) -> DataFrame:
    """Cards that have at least one keyword: those a keyword explode would keep."""
    return cards.where(F.size("keywords") > 0)


def curate_titles(
    titles: DataFrame,
    info: DataFrame | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Distinct titles.

    ``info`` brings the columns the listing lacks or gets wrong: ``views`` (J1),
    ``views`` and ``release_day`` (J2), or ``release_day`` (J3).  Its columns
    take the place of the listing's.
    """
    if info is None:
        return _with_columns(titles, TITLE_COLUMNS).distinct()
    keys = [*_dated(titles), "platform", "id"]
    brought = [c for c in ("views", "release_day") if c in info.columns]
    own = [c for c in TITLE_COLUMNS if c not in keys and c not in brought]
    left = titles.select(*keys, *own).distinct()
    right = info.select(*keys, *brought).distinct()
    return _with_columns(left_join(left, right, keys, policy), TITLE_COLUMNS)


def genres_of_cards(cards: DataFrame, prefix_length: int = 1) -> DataFrame:
    """Keywords of cards as genre rows, less their leading mark."""
    words = cards.select(
        *_dated(cards),
        "platform",
        F.col("id").alias("title_id"),
        F.explode("keywords").alias("word"),
    )
    name = drop_prefix("word", prefix_length)
    return words.select(
        *_dated(cards), "platform", "title_id", name.alias("genre_name")
    )


def curate_genres(genres: DataFrame) -> DataFrame:
    """A2: distinct title and genre pairs."""
    return _with_columns(genres, GENRE_COLUMNS).distinct()


def curate_episodes(
    episodes: DataFrame,
    likes: DataFrame,
    comments: DataFrame,
    join: str = "chained",
    require_date: bool = True,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Distinct episodes with likes and comments.

    chained: comments are found through the likes row, so an episode without
             likes has NULL comments (the contract)
    star:    comments are found through the episode

    An ``updated_date`` on the likes side takes the place of the episode's.
    """
    keys = [*_dated(episodes), "platform", "title_id", "id"]
    dated_by_likes = "updated_date" in likes.columns
    own = ["title", "image_url"] + ([] if dated_by_likes else ["updated_date"])
    brought = ["likes"] + (["updated_date"] if dated_by_likes else [])

    left = episodes.select(*keys, *own).distinct()
    if require_date and not dated_by_likes:
        left = left.where(F.col("updated_date").isNotNull())
    liked = likes.select(*keys, *brought).distinct()
    commented = comments.select(*keys, "comments").distinct()

    if join == "chained":
        joined = chained_left_join(left, liked, commented, keys, policy)
    elif join == "star":
        joined = star_left_join(left, liked, commented, keys, policy)
    else:
        raise ValueError(f"join is 'chained' or 'star', not {join!r}")
    if require_date and dated_by_likes:
        joined = joined.where(F.col("updated_date").isNotNull())
    return _with_columns(joined, EPISODE_COLUMNS)
