"""Tables written to the folder that driver and executors share."""

import atexit
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_ROOTS: dict[str, str] = {}
#: Shuffle files go with the query that made them.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Texts that a Python worker gets at a time where it keeps a set for each.
TEXTS = 2_000


def shared_root(spark: SparkSession) -> str:
    """This application's folder below spark.checkpoint.dir, or else below the warehouse.

    It is removed when the application ends in the ordinary way.
    """
    application = spark.sparkContext.applicationId
    if application not in _ROOTS:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
            "spark.sql.warehouse.dir"
        )
        root = f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"
        _ROOTS[application] = root
        atexit.register(_remove, spark, root)
    return _ROOTS[application]


def _remove(spark: SparkSession, root: str) -> None:
    if spark.sparkContext._jsc is None:
        return
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """The session with other settings, put back afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def short_lived(spark: SparkSession, batch: int | None = None):
    """Settings for a query that is run once: its shuffle files go with it, and its Python
    workers get at most ``batch`` rows at a time."""
    return settings(spark, {_CLEANUP: "true"} | ({_BATCH: str(batch)} if batch else {}))


def written(df: DataFrame, batch: int | None = None) -> DataFrame:
    """The frame as a table in the shared folder: computed once, cut from its lineage,
    and still there when an executor is lost. What was shuffled for it goes at once."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/{uuid.uuid4().hex}"
    with short_lived(spark, batch):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def dropped(*tables: DataFrame | None) -> None:
    """Remove tables that ``written`` gave and that no frame still to be computed reads."""
    for table in tables:
        if table is not None:
            path = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(table._written_to)
            hadoop = table.sparkSession.sparkContext._jsc.hadoopConfiguration()
            path.getFileSystem(hadoop).delete(path, True)
