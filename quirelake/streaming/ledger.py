"""Which landed files and batches are done: Parquet ledgers instead of driver state.

    checkpoints/{platform}/{target}/ledger/landing_date=/batch=   files of finished batches
    checkpoints/{platform}/{target}/plan/round=                   files a run has yet to take
    checkpoints/{platform}/covered/{stage}                        batches a later stage has used

A batch belongs to one landing date.  Its documents are written before its ledger rows,
and both writes replace what an interrupted run left of the same batch: a batch is taken
from the number after the date's last finished one, so what was written but not entered
is written anew, and readers only see what is entered.
"""

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelake.sources.landing import inventory
from quirelake.sources.layout import braces, checkpoint_path, covered_path
from quirelake.sources.tables import read_or_empty

LEDGER = (
    "filename string, length bigint, modified timestamp, documents bigint,"
    " landing_date date, batch int"
)
COVERED = "target string, landing_date date, batch int"


def ledger_path(root: str, platform: str, target: str) -> str:
    return f"{checkpoint_path(root, platform, target)}/ledger"


def plan_path(root: str, platform: str, target: str) -> str:
    return f"{checkpoint_path(root, platform, target)}/plan"


def date_glob(dates: Iterable[date] | None) -> str:
    return "" if dates is None else braces(f"landing_date={d}" for d in dates)


def read_ledger(
    spark: SparkSession,
    root: str,
    platform: str,
    target: str,
    dates: Iterable[date] | None = None,
) -> DataFrame:
    """The files of a target that are compacted, of all or the given landing dates."""
    return read_or_empty(spark, ledger_path(root, platform, target), date_glob(dates), LEDGER)


def pending(
    spark: SparkSession,
    root: str,
    platform: str,
    target: str,
    dates: Iterable[date] | None = None,
) -> DataFrame:
    """Landed files of a target that no finished batch holds.

    Listing and ledger are both limited to the given dates, and compared by a join.
    """
    dates = None if dates is None else list(dates)
    landed = inventory(spark, root, platform, target, dates).where("landing_date IS NOT NULL")
    done = read_ledger(spark, root, platform, target, dates).select("filename")
    return landed.join(done, "filename", "left_anti")


def finished_batches(
    spark: SparkSession, root: str, stage: str, platform: str, targets: Iterable[str]
) -> DataFrame:
    """One row per finished batch: target, landing_date, batch; the same for every stage."""
    frames = [
        read_ledger(spark, root, platform, target)
        .select(F.lit(target).alias("target"), "landing_date", "batch")
        .distinct()
        for target in targets
    ]
    return reduce(DataFrame.unionByName, frames)


def uncovered(
    spark: SparkSession, root: str, stage: str, platform: str, targets: Iterable[str]
) -> DataFrame:
    """Finished batches that ``stage`` has not used yet, also those of earlier, interrupted runs."""
    finished = finished_batches(spark, root, stage, platform, targets)
    covered = read_or_empty(spark, covered_path(root, platform, stage), "", COVERED)
    return finished.join(covered, ["target", "landing_date", "batch"], "left_anti")


def cover(batches: list, spark: SparkSession, root: str, stage: str, platform: str) -> None:
    """Enter batches as used by ``stage``, after what it made of them is written."""
    if batches:
        rows = spark.createDataFrame(batches, COVERED).coalesce(1)
        rows.write.mode("append").parquet(covered_path(root, platform, stage))


__all__ = ["cover", "finished_batches", "pending", "read_ledger", "uncovered"]
