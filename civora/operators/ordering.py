"""Order statistics over all rows without a task that holds them all.

Two tools. ``global_position`` numbers the rows of a total order: one
range-partitioned sort, and a table with one count per partition.
``range_bucket`` deals values to buckets whose bounds are taken from the data
by a mergeable quantile sketch, so that an outlier cannot empty the buckets the
way equal-width ones are; what is computed per bucket and across buckets stays
exact whatever the bounds are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civora.operators.joins import staged


def global_position(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """``df`` with ``out``: each row's place in ``order``, from 1.

    Rows are sorted by range partitions and written once; a place is the place
    inside the partition plus the rows of the partitions before. ``order``
    should be total: rows that are equal in all of it share a partition.
    """
    at = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    rows = staged(df.orderBy(*order).select("*", F.spark_partition_id().alias("_part"), at.alias("_at")))
    first, before = [], 0
    for r in rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect():
        first.append((r["_part"], before))  # one row per partition
        before += r["n"]
    starts = df.sparkSession.createDataFrame(first, "_part int, _first long")
    return (rows.join(F.broadcast(starts), "_part").withColumn(out, F.col("_first") + F.col("_at") + 1)
            .select(*df.columns, out))


def cut_points(value: Column, buckets: int, accuracy: int) -> Column:
    """Aggregate: ``buckets`` - 1 ascending values that cut ``value`` into even parts, as an array."""
    return F.percentile_approx(value.cast("double"), [k / buckets for k in range(1, buckets)], accuracy)


def bucket_of(value: Column, cuts: Column, n: int) -> Column:
    """How many of the first ``n`` ascending ``cuts`` are at most ``value`` (null: 0).

    About sqrt(n) comparisons with coarse cuts, then as many with the fine ones between.
    """
    step = max(1, math.isqrt(n))
    x = value.cast("double")
    hits = lambda at: F.when(x >= F.get(cuts, at), F.lit(1)).otherwise(F.lit(0))
    coarse = sum((hits(F.lit(k)) for k in range(step - 1, n, step)), F.lit(0))
    fine = sum((hits(coarse * step + k) for k in range(step - 1)), F.lit(0))
    return (coarse * step + fine).cast("int")


def range_bucket(df: DataFrame, col: str, out: str = "_b", buckets: int = 256, accuracy: int = 20_000) -> DataFrame:
    """``df`` with ``out``: the bucket of ``col``, in the order of its values; the bounds are a bounded list."""
    cuts = [x for x in df.agg(cut_points(F.col(col), buckets, accuracy)).first()[0] or [] if x == x]
    return df.withColumn(out, bucket_of(F.col(col), F.array(*[F.lit(float(c)) for c in cuts]), len(cuts)))
