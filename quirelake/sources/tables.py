"""Reading and writing the Parquet layers."""

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from datetime import date
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake import schemas
from quirelake.conventions import PARTITION_COLUMNS, READER_PREVIEW_ROWS
from quirelake.sources.layout import (
    backup_path,
    braces,
    curated_root,
    day_partition,
    history_root,
    optimized_root,
    quarantine_root,
)


def read_or_empty(spark: SparkSession, root: str, glob: str, ddl: str) -> DataFrame:
    """Read below a table root, keeping the partition columns; nothing there is an empty frame.

    The glob limits the listing to the partitions it names; ``basePath`` makes
    Spark read partition values from the whole path.
    """
    reader = spark.read.schema(ddl).option("basePath", root)
    try:
        return reader.parquet(f"{root}/{glob}" if glob else root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl)


def _days_glob(dates: Iterable[date] | None, platforms: list[str] | None) -> str:
    """The partitions of the given dates; without dates the root is pruned instead."""
    if dates is None:
        return ""
    days = braces(map(day_partition, dates))
    return days if platforms is None else f"{days}/platform={braces(platforms)}"


def _scoped(
    spark: SparkSession,
    root: str,
    ddl: str,
    dates: Iterable[date] | None,
    platforms: list[str] | None,
) -> DataFrame:
    frame = read_or_empty(spark, root, _days_glob(dates, platforms), ddl)
    if platforms is None:
        return frame
    return frame.where(F.col("platform").isin(*platforms))


def read_optimized(
    spark: SparkSession,
    root: str,
    platform: str,
    target: str,
    dates: Iterable[date] | None = None,
) -> DataFrame:
    """One platform's compacted target for all or the given dates."""
    ddl = schemas.OPTIMIZED[platform, target]
    frame = _scoped(spark, optimized_root(root, target), ddl, dates, [platform])
    dated = frame.withColumn("landing_date", F.make_date("year", "month", "day"))
    return dated.drop(*PARTITION_COLUMNS)


def read_history(
    spark: SparkSession,
    root: str,
    platform: str,
    target: str,
    dates: Iterable[date] | None = None,
) -> DataFrame:
    """One platform's compacted history of a target, of all or the given landing dates."""
    ddl = schemas.OPTIMIZED[platform, target].replace(
        ", year int, month int, day int", ", landing_date date"
    )
    glob = f"platform={platform}"
    if dates is not None:
        glob += "/" + braces(f"landing_date={d}" for d in dates)
    return read_or_empty(spark, history_root(root, target), glob, ddl).drop("platform")


def read_curated(
    spark: SparkSession,
    root: str,
    table: str,
    dates: Iterable[date] | None = None,
    platforms: Iterable[str] | None = None,
) -> DataFrame:
    """A curated table: all of it, some dates, or some dates and platforms."""
    platforms = None if platforms is None else list(platforms)
    return _scoped(
        spark, curated_root(root, table), schemas.CURATED[table], dates, platforms
    )


def preview(
    df: DataFrame, rows: int = READER_PREVIEW_ROWS, order_by: list[str] | None = None
) -> DataFrame:
    """Some rows; with ``order_by`` always the same ones.

    Only the asked rows leave the executors.
    """
    return (df.orderBy(*order_by) if order_by else df).limit(rows)


def register_views(spark: SparkSession, root: str) -> None:
    """V1, V2: the curated tables as temporary views for SQL users."""
    for table in schemas.CURATED:
        read_curated(spark, root, table).createOrReplaceTempView(table)


# --- writing -------------------------------------------------------------------


#: Partitions that a task writes side by side; a task that meets more sorts the rest.
OPEN_FILES = 8

_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_LISTERS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_lock, _held = Lock(), {}


@contextmanager
def _setting(spark: SparkSession, key: str, value: int) -> Iterator[None]:
    """A setting of the session, which lasts while any of several threads needs it."""
    with _lock:
        users, before = _held.get(key) or (0, spark.conf.get(key))
        spark.conf.set(key, value)
        _held[key] = users + 1, before
    try:
        yield
    finally:
        with _lock:
            users, before = _held.pop(key)
            if users > 1:
                _held[key] = users - 1, before
            else:
                spark.conf.set(key, before)


def unsorted_writes(spark: SparkSession):
    """Partitions are written as their rows come: a task does not hold and sort its rows by
    partition, so its memory does not grow with what it writes."""
    return _setting(spark, _WRITERS, OPEN_FILES)


#: Tasks that look up the files of a list of paths; Spark takes one for each of up to 10,000.
LISTING_TASKS = 128


def few_listing_tasks(spark: SparkSession):
    """Many paths are looked up by a bounded number of tasks, many in each."""
    return _setting(spark, _LISTERS, LISTING_TASKS)


def in_files(df: DataFrame, by: list[str], max_files: int | None = None) -> DataFrame:
    """Bring rows together for writing.

    Without ``max_files`` Spark rebalances by size: small partitions of the
    output are merged and large ones split.  With it, each output partition is
    written in at most that many files, its rows spread over them by hash, so
    that a large partition never ends in one task.
    """
    if max_files is None:
        return df.hint("rebalance", *by) if by else df.hint("rebalance")
    piece = F.pmod(F.xxhash64(*_hashable(df)), F.lit(max_files))
    return df.repartition(*by, piece)


def _hashable(df: DataFrame) -> list[Column | str]:
    """Columns a hash can take: maps and variants cannot be hashed."""
    if "filename" in df.columns:
        return ["filename"]
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return [c for c in plain if df.schema[c].dataType.simpleString() != "variant"]


def partitioned(df: DataFrame) -> DataFrame:
    """K5: the landing date as zero-padded year, month and day columns."""
    return df.withColumns(
        {
            "year": F.date_format("landing_date", "yyyy"),
            "month": F.date_format("landing_date", "MM"),
            "day": F.date_format("landing_date", "dd"),
        }
    ).drop("landing_date")


def _listed(spark: SparkSession, path: str, parts: list[str]) -> DataFrame:
    """The data files of the partition folders ``parts``, from the listing alone."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        files = reader.option("pathGlobFilter", "*.parquet").load(f"{path}/{braces(parts)}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, part string")
    depth = parts[0].count("/") + 1
    folder = F.substring_index(F.substring_index("path", "/", -1 - depth), "/", depth)
    return files.select("path", folder.alias("part"))


def _save(
    df: DataFrame,
    path: str,
    by: list[str],
    mode: str,
    max_files: int | None,
    parts: Iterable[str] | None = None,
    packed: bool = False,
) -> None:
    """``overwrite`` replaces exactly the partitions written; ``append`` adds.

    ``parts`` are the partitions that an overwriting run answers for, as folders: it
    also empties those for which it has no rows. What was there before is known by one file
    of each partition: a partition that still holds it was not written. An interrupted
    commit is completed by running it again.
    """
    spark = df.sparkSession
    parts = sorted(set(parts or ())) if mode == "overwrite" else []
    old = _listed(spark, path, parts).groupBy("part").agg(F.min("path").alias("path")) if parts else None
    old = [] if old is None else old.collect()  # one row per partition
    writer = (df if packed else in_files(df, by, max_files)).write.mode(mode).partitionBy(*by)
    with unsorted_writes(spark):
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    if not old:
        return
    kept = spark.createDataFrame(old).select("path").hint("broadcast")
    stale = _listed(spark, path, [r.part for r in old]).join(kept, "path", "left_semi")
    empty = df.drop(*by).limit(0)
    for row in stale.select("part").collect():
        empty.write.mode("overwrite").parquet(f"{path}/{row.part}")


#: (landing date, platform)
Pair = tuple[date, str]
_PAIR = ["landing_date", "platform"]


def _pairs(spark: SparkSession, scope: Iterable[Pair]) -> DataFrame:
    """One row per partition of a table."""
    return spark.createDataFrame(list(scope), "landing_date date, platform string").distinct()


def in_scope(df: DataFrame, scope: Iterable[Pair] | None) -> DataFrame:
    """Rows of the asked dates and platforms."""
    if scope is None:
        return df
    return df.join(F.broadcast(_pairs(df.sparkSession, scope)), _PAIR, "left_semi")


def scope_partitioned(df: DataFrame, scope: Iterable[Pair] | None) -> DataFrame:
    """``partitioned(in_scope(df, scope))``, the texts of a date made once a partition."""
    if scope is None:
        return partitioned(df)
    pairs = _pairs(df.sparkSession, scope).withColumn("__day", F.col("landing_date"))
    texts = partitioned(pairs).withColumnRenamed("__day", "landing_date")
    kept = [c for c in df.columns if c != "landing_date"]
    return df.join(F.broadcast(texts), _PAIR).select(*kept, "year", "month", "day")


def _parts(scope: Iterable[Pair] | None) -> list[str] | None:
    if scope is None:
        return None
    return [f"{day_partition(day)}/platform={platform}" for day, platform in scope]


def write_optimized(
    df: DataFrame,
    root: str,
    platform: str,
    target: str,
    mode: str = "overwrite",
    max_files: int | None = None,
    dates: Iterable[date] | None = None,
    packed: bool = False,
) -> None:
    """K1: a compacted target of one platform, for every landing date it holds.

    With ``dates`` exactly these dates are replaced, also by nothing. ``packed`` rows lie in
    tasks as they shall lie in files, and are written without a shuffle.
    """
    scope = None if dates is None else [(day, platform) for day in dates]
    rows = scope_partitioned(df.withColumn("platform", F.lit(platform)), scope)
    path = optimized_root(root, target)
    _save(rows, path, list(PARTITION_COLUMNS), mode, max_files, _parts(scope), packed)


def write_history(
    df: DataFrame,
    root: str,
    platform: str,
    target: str,
    mode: str = "overwrite",
    max_files: int | None = None,
    dates: Iterable[date] | None = None,
    packed: bool = False,
) -> None:
    """K1: the compacted history of one platform's target, by landing date.

    With ``dates`` exactly these dates are replaced, also by nothing. ``packed`` rows are
    written as they lie in tasks, without a shuffle.
    """
    scope = None if dates is None else [(day, platform) for day in dates]
    rows = in_scope(df.withColumn("platform", F.lit(platform)), scope)
    parts = None if scope is None else [f"platform={p}/landing_date={day}" for day, p in scope]
    by = ["platform", "landing_date"]
    _save(rows, history_root(root, target), by, mode, max_files, parts, packed)


def write_curated(
    df: DataFrame,
    root: str,
    table: str,
    mode: str = "overwrite",
    max_files: int | None = None,
    scope: Iterable[Pair] | None = None,
) -> None:
    """K3: a curated table, partitioned by landing date and platform.

    ``scope`` names the dates and platforms that the rows answer for: exactly these
    partitions are replaced, those without rows by nothing. Without it the partitions that
    have rows are.
    """
    scope = None if scope is None else list(scope)
    path = curated_root(root, table)
    rows = scope_partitioned(df, scope)
    _save(rows, path, list(PARTITION_COLUMNS), mode, max_files, _parts(scope))


def write_quarantine(
    flagged: DataFrame, root: str, platform: str, target: str, dates: Iterable[date]
) -> None:
    """The flagged documents of one target, replacing those of the given dates.

    ``flagged`` has filename, landing_date and the flags ``odd_items`` and ``unreadable``.
    """
    dates = list(dates)
    problem = F.expr("CASE WHEN unreadable THEN 'unreadable' WHEN odd_items THEN 'odd_items' END")
    rows = flagged.select("filename", problem.alias("problem"), "landing_date").where(
        "problem IS NOT NULL"
    )
    rows = rows.withColumns({"platform": F.lit(platform), "target": F.lit(target)})
    scope = [(day, platform) for day in dates]
    parts = [f"{part}/target={target}" for part in _parts(scope)]
    by = [*PARTITION_COLUMNS, "target"]
    _save(scope_partitioned(rows, scope), quarantine_root(root), by, "overwrite", None, parts)


def read_quarantine(
    spark: SparkSession,
    root: str,
    dates: Iterable[date] | None = None,
    platforms: Iterable[str] | None = None,
) -> DataFrame:
    """Documents that runs could not take as a whole, by date, platform and target."""
    platforms = None if platforms is None else list(platforms)
    return _scoped(spark, quarantine_root(root), schemas.QUARANTINE, dates, platforms)


def backup(
    df: DataFrame,
    root: str,
    platform: str,
    target: str,
    max_files: int | None = None,
) -> None:
    """K4: replace the backup of a frame."""
    path = backup_path(root, platform, target)
    in_files(df, [], max_files).write.mode("overwrite").parquet(path)
