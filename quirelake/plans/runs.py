"""Whole runs over a lake.

    optimize_days      landed documents -> compacted days
    compact_history    landed documents -> merged -> compacted history
    curate_tables      compacted frames -> the three curated tables, not written
    run_days           one date or many: compact, curate and write, one job each
    run_history        backfill: ongoing and finished titles
    run_direct         backfill straight from landed documents

The variants differ in a few rules only, which :class:`Variant` names.
"""

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.conventions import KAKAO, NAVER, PLATFORMS, TARGETS
from quirelake.operators import curation, views
from quirelake.operators.compacted import compact_shape, passes_through
from quirelake.operators.skew import DEFAULT_POLICY, SkewPolicy
from quirelake.sources.landing import of_titles, read_landing, read_packed
from quirelake.sources.layout import staged_path
from quirelake.sources.tables import (
    Pair,
    backup,
    read_curated,
    read_history,
    read_optimized,
    write_curated,
    write_history,
    write_optimized,
    write_quarantine,
)
from quirelake.streaming.compaction import compact, read_merged
from quirelake.streaming.ledger import cover, finished_batches, read_ledger, uncovered

Source = Callable[[str, str], DataFrame]


@dataclass(frozen=True)
class Variant:
    """The rules in which the runs differ.

    finished:       take finished titles too
    all_weekdays:   all weekday lists, or only that of the landing date
    day_from_info:  release day from the title info instead of the listing
    date_field:     the kakao episode field that dates an episode
    date_by_likes:  naver episodes are dated by their likes response
    require_date:   leave out episodes without a readable date
    """

    finished: bool = False
    all_weekdays: bool = False
    day_from_info: bool = False
    date_field: str = "serialStartDateTime"
    date_by_likes: bool = False
    require_date: bool = True

    def targets(self, platform: str) -> list[str]:
        listed = TARGETS[platform]
        return [t for t in listed if self.finished or t != "finished_titles"]


DAILY = Variant()
HISTORY = Variant(finished=True, all_weekdays=True)
DIRECT = Variant(
    finished=True,
    all_weekdays=True,
    day_from_info=True,
    date_field="useStartDateTime",
    date_by_likes=True,
    require_date=False,
)


def days(first: date, end: date) -> list[date]:
    """O2: the dates from ``first`` up to, not including, ``end``."""
    return [first + timedelta(days=i) for i in range((end - first).days)]


# --- landed documents -> compacted layers ---------------------------------------


def optimize_days(
    spark: SparkSession,
    root: str,
    dates: Iterable[date],
    platforms: Iterable[str] = PLATFORMS,
    variant: Variant = DAILY,
    mode: str = "overwrite",
    max_files: int | None = None,
    multiline: bool = True,
    quarantine: bool = False,
) -> None:
    """Compact the landed documents of all given dates.

    One job per target covers every date; the landing date is a column.
    ``multiline=False`` takes files of one document per line. ``quarantine`` also writes
    which documents were not taken whole (R10); for that the parsed documents of a target
    are kept on the executors' disks, so each is parsed once.
    """
    dates = list(dates)
    for platform in platforms:
        for target in variant.targets(platform):
            packed = max_files is None and passes_through(platform, target)
            read = read_packed if packed else read_landing
            docs = read(
                spark, root, platform, target, dates, multiline=multiline, report=quarantine
            )
            flags = [c for c in ("odd_items", "unreadable") if c in docs.columns]
            if quarantine:
                docs = docs.persist(StorageLevel.DISK_ONLY)
            shaped = compact_shape(docs.drop(*flags), platform, target, variant.all_weekdays)
            write_optimized(shaped, root, platform, target, mode, max_files, dates, packed)
            if quarantine:
                write_quarantine(docs, root, platform, target, dates)
                docs.unpersist()


def compact_history(
    spark: SparkSession,
    root: str,
    dates: Iterable[date] | None = None,
    platforms: Iterable[str] = PLATFORMS,
    files_per_batch: int = 100_000,
    max_files: int | None = None,
    multiline: bool = True,
    quarantine: bool = False,
) -> None:
    """Resume the compaction of all targets, then shape what is new.

    Targets are compacted side by side; one that fails stops none of the others, and is
    raised in the end. Only landing dates with batches that were not shaped yet are read and
    written again, also those that an interrupted run left. ``quarantine`` also writes which
    documents of these dates were not taken whole (R10); the compaction has flagged them.
    """
    dates = None if dates is None else list(dates)
    todo = [(p, t) for p in platforms for t in HISTORY.targets(p)]
    with ThreadPoolExecutor(len(todo)) as pool:
        running = [
            pool.submit(compact, spark, root, p, t, dates, files_per_batch, multiline=multiline)
            for p, t in todo
        ]
    for done in running:
        done.result()
    for platform in platforms:
        new = uncovered(spark, root, "shaped", platform, HISTORY.targets(platform)).collect()
        for target in HISTORY.targets(platform):
            fresh = [r for r in new if r.target == target]
            dirty = sorted({r.landing_date for r in fresh})
            if dirty:
                docs = read_merged(spark, root, platform, target, dirty)
                shaped = compact_shape(docs, platform, target, all_weekdays=True)
                # batches of dates without earlier ones lie in files of a fitting size already
                ledger = read_ledger(spark, root, platform, target, dirty)
                held = ledger.select("landing_date", "batch").distinct().count()
                packed = max_files is None and held == len(fresh)
                write_history(shaped, root, platform, target, "overwrite", max_files, dirty, packed)
                if quarantine:
                    flagged = read_merged(spark, root, platform, target, dirty, report=True)
                    write_quarantine(flagged, root, platform, target, dirty)
        cover(new, spark, root, "shaped", platform)


# --- compacted frames -> curated tables ------------------------------------------


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _kakao(
    read: Source, variant: Variant, keep_empty: bool, join: str, policy: SkewPolicy
):
    cards = views.kakao_cards(read(KAKAO, "titles"))
    if variant.finished:
        finished = views.kakao_cards(read(KAKAO, "finished_titles"), completed=True)
        cards = cards.unionByName(finished)
    listed = cards if keep_empty else curation.with_keywords(cards)
    by_badge = variant.day_from_info
    info_view = views.kakao_views_by_badge if by_badge else views.kakao_views
    info = info_view(read(KAKAO, "title_info"))
    titles = curation.curate_titles(listed, info, policy)
    genres = curation.curate_genres(curation.genres_of_cards(cards))
    episodes = curation.curate_episodes(
        views.kakao_episodes(read(KAKAO, "episodes"), variant.date_field),
        views.kakao_likes(read(KAKAO, "episode_likes")),
        views.kakao_comments(read(KAKAO, "comments")),
        join=join,
        require_date=variant.require_date,
        policy=policy,
    )
    return titles, genres, episodes


def _naver(
    read: Source, variant: Variant, keep_empty: bool, join: str, policy: SkewPolicy
):
    listed = views.naver_titles(read(NAVER, "titles"))
    if variant.finished:
        finished = views.naver_titles(read(NAVER, "finished_titles"), completed=True)
        listed = listed.unionByName(finished)
    info = read(NAVER, "title_info")
    weekdays = views.naver_title_days(info, keep_empty) if variant.day_from_info else None
    titles = curation.curate_titles(listed, weekdays, policy)
    genres = curation.curate_genres(views.naver_genres(info))
    likes = views.naver_likes(read(NAVER, "episode_likes"))
    if variant.date_by_likes:
        likes = likes.withColumnRenamed("response_date", "updated_date")
    episodes = curation.curate_episodes(
        views.naver_episodes(read(NAVER, "episodes")),
        likes,
        views.naver_comments(read(NAVER, "comments")),
        join=join,
        require_date=variant.require_date,
        policy=policy,
    )
    return titles, genres, episodes


_PLATFORM_RULES = {NAVER: _naver, KAKAO: _kakao}


def curate_tables(
    read: Source,
    platforms: Iterable[str] = PLATFORMS,
    variant: Variant = DAILY,
    keep_empty: bool = False,
    policy: SkewPolicy = DEFAULT_POLICY,
    join: str = "chained",
) -> dict[str, DataFrame]:
    """The curated tables of all platforms.

    ``read(platform, target)`` gives the compacted frame of a target, with a
    ``landing_date`` that every DISTINCT and every join is kept within.
    ``keep_empty`` keeps titles without keywords or tags (G7), ``join`` is how comments
    are reached, "chained" or "star" (J4, J5).
    """
    made = [_PLATFORM_RULES[p](read, variant, keep_empty, join, policy) for p in platforms]
    titles, genres, episodes = (_union(list(frames)) for frames in zip(*made))
    return {"titles": titles, "genres": genres, "episodes": episodes}


def write_tables(
    tables: dict[str, DataFrame],
    root: str,
    mode: str = "overwrite",
    max_files: int | None = None,
    scope: Iterable[Pair] | None = None,
) -> None:
    """K3: write the curated tables, one job each, replacing exactly the partitions of the scope."""
    scope = None if scope is None else list(scope)
    for table, frame in tables.items():
        write_curated(frame, root, table, mode, max_files, scope)


# --- whole runs ---------------------------------------------------------------------


def curate_days(
    spark: SparkSession,
    root: str,
    dates: Iterable[date],
    platforms: Iterable[str] = PLATFORMS,
    mode: str = "overwrite",
    keep_empty: bool = False,
    policy: SkewPolicy = DEFAULT_POLICY,
    join: str = "chained",
) -> None:
    """O1, O2: curate compacted days and write them.

    A date and platform for which nothing is left is emptied.
    """
    dates, platforms = list(dates), list(platforms)

    def read(platform: str, target: str) -> DataFrame:
        return read_optimized(spark, root, platform, target, dates)

    tables = curate_tables(read, platforms, DAILY, keep_empty, policy, join)
    write_tables(tables, root, mode, scope=[(d, p) for d in dates for p in platforms])


def run_days(
    spark: SparkSession,
    root: str,
    dates: Iterable[date],
    platforms: Iterable[str] = PLATFORMS,
    mode: str = "overwrite",
    policy: SkewPolicy = DEFAULT_POLICY,
    multiline: bool = True,
    keep_empty: bool = False,
    join: str = "chained",
    quarantine: bool = False,
) -> None:
    """O1, O2: landed documents of one or many dates to curated tables."""
    dates, platforms = list(dates), list(platforms)
    optimize_days(spark, root, dates, platforms, DAILY, mode, None, multiline, quarantine)
    curate_days(spark, root, dates, platforms, mode, keep_empty, policy, join)


def curate_history(
    spark: SparkSession,
    root: str,
    platforms: Iterable[str] = PLATFORMS,
    as_of: date | None = None,
    mode: str = "overwrite",
    policy: SkewPolicy = DEFAULT_POLICY,
    keep_empty: bool = False,
    join: str = "chained",
    everything: bool = False,
) -> None:
    """O3: curate the compacted history, under its landing dates or one date.

    Under its landing dates, only those with batches that no run has curated yet are read
    and replaced, unless ``everything`` is asked for (say, after a change of the options).
    Under one date all history makes one partition, and is read whole.
    """
    platforms, dirty, new = list(platforms), {}, {}
    for platform in platforms:
        targets = HISTORY.targets(platform)
        batches = finished_batches if everything else uncovered
        new[platform] = batches(spark, root, "curated", platform, targets).collect()
        dirty[platform] = sorted({r.landing_date for r in new[platform]})

    def read(platform: str, target: str) -> DataFrame:
        if as_of is None:
            return read_history(spark, root, platform, target, dirty[platform])
        rows = read_history(spark, root, platform, target)
        return rows.withColumn("landing_date", F.lit(as_of))

    if as_of is None:
        platforms = [p for p in platforms if dirty[p]]
        scope = [(day, p) for p in platforms for day in dirty[p]]
    else:
        scope = [(as_of, p) for p in platforms]
    if not scope:
        return
    tables = curate_tables(read, platforms, HISTORY, keep_empty, policy, join)
    write_tables(tables, root, mode, scope=scope)
    if as_of is None:
        for platform in platforms:
            cover(new[platform], spark, root, "curated", platform)


def run_history(
    spark: SparkSession,
    root: str,
    dates: Iterable[date] | None = None,
    platforms: Iterable[str] = PLATFORMS,
    as_of: date | None = None,
    mode: str = "overwrite",
    policy: SkewPolicy = DEFAULT_POLICY,
    multiline: bool = True,
    keep_empty: bool = False,
    join: str = "chained",
    quarantine: bool = False,
) -> None:
    """O3: resumable backfill of ongoing and finished titles."""
    platforms = list(platforms)
    compact_history(spark, root, dates, platforms, multiline=multiline, quarantine=quarantine)
    curate_history(spark, root, platforms, as_of, mode, policy, keep_empty, join)


def direct_source(
    spark: SparkSession,
    root: str,
    dates: Iterable[date],
    folders: Iterable[str] | None = None,
    titles: DataFrame | None = None,
    multiline: bool = True,
    all_weekdays: bool = True,
) -> Source:
    """Compacted frames straight from landed documents.

    Episodes, likes and comments may be limited to some titles: by folder
    names, or by a frame with a ``title_id`` column.
    """
    dates = list(dates)

    def read(platform: str, target: str) -> DataFrame:
        docs = read_landing(
            spark, root, platform, target, dates, folders, multiline=multiline
        )
        if titles is not None and target in ("episodes", "episode_likes", "comments"):
            docs = of_titles(docs, titles)
        return compact_shape(docs, platform, target, all_weekdays)

    return read


#: Targets that more than one curated table is made from.
FANNED_OUT = {(NAVER, "title_info"), (KAKAO, "titles"), (KAKAO, "finished_titles")}


def staged(read: Source, root: str) -> Source:
    """The same frames, those of targets that several tables need written once and read back,
    so that every landed document is parsed once."""
    held: dict[tuple[str, str], DataFrame] = {}

    def read_staged(platform: str, target: str) -> DataFrame:
        if (platform, target) not in FANNED_OUT:
            return read(platform, target)
        if (platform, target) not in held:
            frame, path = read(platform, target), staged_path(root, platform, target)
            frame.write.mode("overwrite").parquet(path)
            held[platform, target] = frame.sparkSession.read.schema(frame.schema).parquet(path)
        return held[platform, target]

    return read_staged


def run_direct(
    spark: SparkSession,
    root: str,
    dates: Iterable[date],
    platforms: Iterable[str] = PLATFORMS,
    folders: Iterable[str] | None = None,
    titles: DataFrame | None = None,
    mode: str = "overwrite",
    policy: SkewPolicy = DEFAULT_POLICY,
    multiline: bool = True,
    keep_empty: bool = False,
    join: str = "chained",
) -> None:
    """O3: backfill without a compacted layer."""
    dates, platforms = list(dates), list(platforms)
    read = staged(direct_source(spark, root, dates, folders, titles, multiline), root)
    tables = curate_tables(read, platforms, DIRECT, keep_empty, policy, join)
    write_tables(tables, root, mode, scope=[(d, p) for d in dates for p in platforms])


def direct_views(read: Source, platform: str) -> dict[str, DataFrame]:
    """The flat views a direct run takes of one platform, by the names of their backups."""
    if platform == KAKAO:
        return {
            "finished_titles": views.kakao_titles(read(KAKAO, "finished_titles"), True),
            "finished_title_info": views.kakao_views_by_badge(read(KAKAO, "title_info")),
            "finished_episodes": views.kakao_episodes(
                read(KAKAO, "episodes"), DIRECT.date_field
            ),
            "finished_episode_likes": views.kakao_likes(read(KAKAO, "episode_likes")),
            "finished_comments": views.kakao_comments(read(KAKAO, "comments")),
        }
    return {
        "finished_titles": views.naver_titles(read(NAVER, "finished_titles"), True),
        "finished_title_info": views.naver_info_weekdays(read(NAVER, "title_info")),
        "finished_episodes": views.naver_episodes(read(NAVER, "episodes")),
        "finished_episode_likes": views.naver_likes(read(NAVER, "episode_likes")),
        "finished_comments": views.naver_comments(read(NAVER, "comments")),
    }


def backup_direct(
    read: Source,
    root: str,
    platforms: Iterable[str] = PLATFORMS,
    max_files: int | None = None,
) -> None:
    """K4: back up the flat views of a direct run, replacing the last backup."""
    for platform in platforms:
        for name, frame in direct_views(read, platform).items():
            backup(frame, root, platform, name, max_files)


def read_scope(
    spark: SparkSession,
    root: str,
    dates: Iterable[date] | None = None,
    platform: str | None = None,
) -> dict[str, DataFrame]:
    """The curated tables, all of them, of some dates, or of some dates and a platform."""
    dates = None if dates is None else list(dates)
    platforms = None if platform is None else [platform]
    return {
        table: read_curated(spark, root, table, dates, platforms)
        for table in ("titles", "genres", "episodes")
    }
