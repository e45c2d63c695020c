"""R-10: a left join to a table in which one key can hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one key from which it is split, and into how many parts.
HOT_ROWS = 1_000_000
PARTS = 64


def left_join_hot(
    left: DataFrame, right: DataFrame, key: str, hot_rows: int = HOT_ROWS, parts: int = PARTS, part: Column | None = None
) -> DataFrame:
    """``left`` join ``right`` on ``key`` for a ``left`` with one row per key and a ``right`` with hot keys.

    Spark splits a hot partition of the left side of a left join, never of the right one. Here keys with more than
    ``hot_rows`` rows on the right are counted first (there are at most rows / ``hot_rows`` of them). Their rows are
    dealt over ``parts`` parts, and the one row of the left side goes to each; a row of the right meets it once. Such a
    key has rows on the right, so that an inner join loses none. All other keys are joined as they are.

    ``part`` says which part a row of the right belongs to; by default it follows from all its columns, so that only
    rows equal in every column stay together.
    """
    hot = right.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows).select(key)
    others = [c for c in right.columns if c != key]
    dealt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in right.columns]) if part is None else part, F.lit(parts)).cast("int")
    spread_right = right.join(hot, key, "left_semi").withColumn("_part", dealt)
    spread_left = left.join(hot, key, "left_semi").withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    split = spread_left.join(spread_right, [key, "_part"]).drop("_part")
    plain = left.join(hot, key, "left_anti").join(right.join(hot, key, "left_anti"), key, "left")
    columns = [*left.columns, *others]
    return split.select(*columns).unionByName(plain.select(*columns))
