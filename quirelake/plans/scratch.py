"""A folder for the tables that some queries write and read back."""

import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, or else below the warehouse.

    Both are places that all executors share.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"
