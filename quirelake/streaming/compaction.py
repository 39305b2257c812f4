"""Resumable compaction of many small files in bounded batches.

A ledger of finished files, a Parquet table by landing date, is compared with the listing
of what has landed: an interrupted run goes on where it stopped, a rerun adds nothing, and
files landed since are added whatever their time stamps say.  What a run holds on the
driver is the paths of one round (``files_per_batch``) and a number per date.
"""

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.conventions import MERGED_FILES_PER_BATCH
from quirelake.schemas import LANDING
from quirelake.sources.landing import at_depth, no_documents, read_files
from quirelake.sources.layout import merged_path
from quirelake.sources.tables import few_listing_tasks, read_or_empty, unsorted_writes
from quirelake.streaming.ledger import (
    date_glob,
    ledger_path,
    pending,
    plan_path,
    read_ledger,
)

_BY = ["landing_date", "batch"]


@dataclass(frozen=True)
class Piece:
    """Some files of one landing date that become one batch."""

    landing_date: date
    piece: int
    files: int
    batch: int


def _rounds(pieces: list[Piece], files_per_batch: int) -> list[tuple[int, Piece]]:
    """Pieces in rounds of about ``files_per_batch`` files."""
    out, number, held = [], 0, 0
    for piece in sorted(pieces, key=lambda p: (p.landing_date, p.piece)):
        if held and held + piece.files > files_per_batch:
            number, held = number + 1, 0
        out.append((number, piece))
        held += piece.files
    return out


def _planned(
    spark: SparkSession,
    root: str,
    platform: str,
    target: str,
    dates: list[date] | None,
    files_per_batch: int,
) -> list[tuple[int, Piece]]:
    """Write the plan of a run: every pending file with its batch and round.

    A date with more files than a batch may hold is cut into pieces by the hash of the
    file name, so no task sees all files of a date.
    """
    path = plan_path(root, platform, target)
    landed = pending(spark, root, platform, target, dates)
    landed.write.mode("overwrite").parquet(f"{path}/pending")
    todo = spark.read.schema(landed.schema).parquet(f"{path}/pending")
    sizes = todo.groupBy("landing_date").agg(F.ceil(F.count("*") / files_per_batch).alias("pieces"))
    cut = F.pmod(F.xxhash64("filename"), F.col("pieces")).cast("int").alias("piece")
    todo = todo.join(F.broadcast(sizes), "landing_date").select(*todo.columns, cut)  # one row a date
    counts = todo.groupBy("landing_date", "piece").agg(F.count("*").alias("files")).collect()
    if not counts:
        return []
    ledger = read_ledger(spark, root, platform, target, dates)
    last = dict(ledger.groupBy("landing_date").agg(F.max("batch")).collect())
    pieces = [Piece(r.landing_date, r.piece, r.files, last.get(r.landing_date, -1) + 1 + r.piece)
              for r in counts]
    rounds = _rounds(pieces, files_per_batch)
    numbers = spark.createDataFrame(
        [(p.landing_date, p.piece, p.batch, number) for number, p in rounds],
        "landing_date date, piece int, batch int, round int",
    )
    # about one row per files_per_batch files and date
    plan = todo.join(F.broadcast(numbers), ["landing_date", "piece"]).drop("piece")
    plan.hint("rebalance", "round").write.mode("overwrite").partitionBy("round").parquet(f"{path}/files")
    return rounds


def _compact_round(
    spark: SparkSession,
    root: str,
    platform: str,
    target: str,
    number: int,
    batches: int,
    output_files: int | None,
    schema: str | None,
    multiline: bool,
) -> None:
    """One round: its documents, then its ledger rows."""
    files = spark.read.parquet(f"{plan_path(root, platform, target)}/files").where(
        F.col("round") == number
    )
    # a path is read as a pattern
    paths = files.select(F.regexp_replace("path", r"([{}\[\]*?\\])", r"\\$1")).collect()
    paths = [r[0] for r in paths]
    with few_listing_tasks(spark):
        docs = read_files(spark, paths, platform, target, schema, multiline, report=True)
    docs = at_depth(docs, target)
    # the round's own file names: bounded by files_per_batch
    docs = docs.join(F.broadcast(files.select("filename", "batch")), "filename")
    if output_files is not None:
        docs = docs.repartition(output_files)
    elif batches > 1:
        docs = docs.hint("rebalance", *_BY)
    # files of one batch are packed by the scan already
    _replace(docs, merged_path(root, platform, target))
    found = read_or_empty(
        spark, merged_path(root, platform, target), "", "filename string, landing_date date, batch int"
    ).join(F.broadcast(files.select(*_BY).distinct()), _BY, "left_semi")
    documents = found.groupBy("filename").agg(F.count("*").alias("documents"))
    rows = files.select("filename", "length", "modified", *_BY).join(documents, "filename", "left")
    entered = rows.withColumn("documents", F.coalesce("documents", F.lit(0)))
    _replace(entered.hint("rebalance", *_BY), ledger_path(root, platform, target))


def _replace(df: DataFrame, path: str) -> None:
    writer = df.write.mode("overwrite").partitionBy(*_BY)
    with unsorted_writes(df.sparkSession):
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def compact(
    spark: SparkSession,
    root: str,
    platform: str,
    target: str,
    dates: Iterable[date] | None = None,
    files_per_batch: int = 100_000,
    output_files: int | None = None,
    schema: str | None = None,
    multiline: bool = True,
) -> int:
    """Compact the landed files not compacted yet; the number of documents added.

    files_per_batch bounds (about) what one round reads, and with it the work lost when a
    run is interrupted.  ``output_files`` fixes the files per round
    (``MERGED_FILES_PER_BATCH`` gives the classic number); by default they follow the size
    of what is read.
    """
    dates = None if dates is None else list(dates)
    rounds = _planned(spark, root, platform, target, dates, files_per_batch)
    for number in sorted({n for n, _ in rounds}):
        batches = sum(n == number for n, _ in rounds)
        _compact_round(spark, root, platform, target, number, batches, output_files, schema, multiline)
    if not rounds:
        return 0
    new = spark.createDataFrame(
        [(p.landing_date, p.batch) for _, p in rounds], "landing_date date, batch int"
    )
    added = read_ledger(spark, root, platform, target, sorted({p.landing_date for _, p in rounds}))
    return added.join(F.broadcast(new), _BY, "left_semi").agg(F.sum("documents")).first()[0]


def read_merged(
    spark: SparkSession,
    root: str,
    platform: str,
    target: str,
    dates: Iterable[date] | None = None,
    report: bool = False,
) -> DataFrame:
    """The compacted documents of a target, of all or the given landing dates.

    A batch that is written but not yet in the ledger is not seen. ``report`` adds the flags
    ``odd_items`` and ``unreadable``, which were written in the same pass.
    """
    dates = None if dates is None else list(dates)
    finished = read_ledger(spark, root, platform, target, dates).select(*_BY).distinct()
    ddl = f"{LANDING[platform, target]}, filename string, landing_date date, batch int"
    ddl += ", odd_items boolean, unreadable boolean"
    docs = read_or_empty(spark, merged_path(root, platform, target), date_glob(dates), ddl)
    seen = docs.join(F.broadcast(finished), _BY, "left_semi")  # one row per batch
    return seen.select(*no_documents(spark, platform, target, report).columns)


__all__ = ["MERGED_FILES_PER_BATCH", "compact", "read_merged"]
