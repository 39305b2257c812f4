"""Skew-safe joins against Spark's own joins, on random rows with heavy keys."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirelake.operators.skew import (
    SkewPolicy,
    chained_left_join,
    heavy_keys,
    left_join,
    star_left_join,
)
from tests.conftest import rows

KEYS = ["k", "j"]
POLICY = SkewPolicy(min_rows=3)

key = st.one_of(st.none(), st.integers(0, 3))
side = st.lists(st.tuples(key, st.sampled_from([0, 0, 0, None]), st.integers(0, 9)), max_size=25)
relaxed = settings(
    max_examples=6, deadline=None, suppress_health_check=list(HealthCheck)
)


def frame(spark, data, name):
    return spark.createDataFrame(data, f"k int, j int, {name} int").distinct()


def plain(left, right):
    return left.join(right, KEYS, "left")


@relaxed
@given(side, side)
def test_left_join(spark, a, b):
    left, right = frame(spark, a, "a"), frame(spark, b, "b")
    columns = ["k", "j", "a", "b"]
    assert rows(left_join(left, right, KEYS, POLICY), *columns) == rows(
        plain(left, right), *columns
    )


@relaxed
@given(side, side, side)
def test_three_way_joins(spark, a, b, c):
    first, second, third = frame(spark, a, "a"), frame(spark, b, "b"), frame(spark, c, "c")
    columns = ["k", "j", "a", "b", "c"]
    star = plain(plain(first, second), third)
    assert rows(star_left_join(first, second, third, KEYS, POLICY), *columns) == rows(
        star, *columns
    )
    chained = first.join(plain(second, third), KEYS, "left")
    got = chained_left_join(first, second, third, KEYS, POLICY)
    assert rows(got, *columns) == rows(chained, *columns)
    # chained is star without the third column where the second found nothing
    has_second = second.select(*KEYS, F.lit(True).alias("hit")).distinct()
    masked = star.join(has_second, KEYS, "left").select(
        "k", "j", "a", "b", F.when(F.col("hit"), F.col("c")).alias("c")
    )
    assert rows(chained.distinct(), *columns) == rows(masked.distinct(), *columns)


def test_each_side_can_own_a_heavy_key(spark):
    """One key heavy on each side in turn, and one heavy third side without a second."""
    a = [(1, 0, i) for i in range(20)] + [(2, 0, 1), (3, 0, 1), (4, 0, 1), (None, 0, 1)]
    b = [(1, 0, 1), (3, 0, 1)] + [(2, 0, i) for i in range(20)]
    c = [(1, 0, 1), (2, 0, 1)] + [(k, 0, i) for k in (3, 4) for i in range(20)]
    first, second, third = frame(spark, a, "a"), frame(spark, b, "b"), frame(spark, c, "c")
    policy = SkewPolicy(min_rows=5)
    owners = heavy_keys(
        {"first": first, "second": second, "third": third},
        KEYS,
        policy,
        needs={"third": "second"},
    )
    assert rows(owners, "k", "__owner", "__salts") == [
        (1, "first", 4),
        (2, "second", 4),
        (3, "third", 4),
    ]
    columns = ["k", "j", "a", "b", "c"]
    expected = first.join(plain(second, third), KEYS, "left")
    got = chained_left_join(first, second, third, KEYS, policy)
    assert rows(got, *columns) == rows(expected, *columns)
    star = plain(plain(first, second), third)
    assert rows(star_left_join(first, second, third, KEYS, policy), *columns) == rows(
        star, *columns
    )


def test_a_heavy_key_is_spread(spark):
    """A key with a third of all rows ends in many partitions, not in one."""
    right = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"),
    )
    left = spark.range(100).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = left_join(left, right, ["k"], SkewPolicy(min_rows=100))
        sizes = got.where("k = 0").groupBy(F.spark_partition_id()).count()
        sizes = [r["count"] for r in sizes.collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 3_000
    assert len(sizes) > 8 and max(sizes) < 1_000
