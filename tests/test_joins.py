import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_text
from turnstile.operators.joins import left_join_hot


@pytest.mark.parametrize("hot_rows", [0, 5, 1000])
def test_left_join_with_hot_keys(spark, rows, hot_rows):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "k string, n int")
    right = spark.createDataFrame([("a", i) for i in range(40)] + [("b", 7), ("b", 7), ("z", 1), (None, 9)], "k string, v int")
    assert rows(left_join_hot(left, right, "k", hot_rows, 4), "k", "n", "v") == rows(left.join(right, "k", "left"), "k", "n", "v")


def test_a_third_of_the_dimension_is_one_key(spark):
    """No partition of the join gets more than its part of the hot key."""
    left = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    right = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "0").otherwise((F.col("id") % 3000).cast("string")).alias("k"), F.col("id").alias("v"))
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    for name, value in zip(before, ("-1", "false", "16")):
        spark.conf.set(name, value)
    try:
        largest = lambda df: df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        split = left_join_hot(left, right, "k", 1000, 64)
        assert split.count() == left.join(right, "k", "left").count()
        assert largest(left.join(right, "k", "left")) > 3000 > 3 * largest(split)
        assert "_part" in plan_text(split)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
