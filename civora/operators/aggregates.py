"""Aggregation operators.

All of these are hash aggregations with a partial (map-side) phase, so a hot
key is pre-combined on every mapper before the shuffle: a supporter holding a
third of all donations still sends one partial row per map task.

Distinct counts over small-domain columns use ``size(collect_set(...))``
instead of ``COUNT(DISTINCT)``: the latter plans an Expand that multiplies the
input rows by the number of distinct aggregates before the shuffle, while the
set is combined map-side and stays bounded by the per-key domain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civora.functions.columns import coalesce_amount, flag01


def n_distinct(col) -> Column:
    """COUNT(DISTINCT col) for a small per-group domain (NULLs ignored)."""
    return F.size(F.collect_set(col)).cast("bigint")


def epoch_days(col) -> Column:
    """Days since 1970-01-01 for a DATE or TIMESTAMP (slope x-axis)."""
    return F.unix_date(F.to_date(col)).cast("double")


# A1 + A2 + A5 + A6 (one aggregate, one shuffle on supporter_id)
def donor_rfm(donations: DataFrame, key: str = "supporter_id") -> DataFrame:
    v = coalesce_amount("amount", "estimated_value")
    return (donations
            .withColumn("_v", v)
            .groupBy(key)
            .agg(F.count("donation_id").alias("frequency"),
                 F.sum("_v").alias("total_value"),
                 F.avg("_v").alias("avg_value"),
                 F.max("_v").alias("max_value"),
                 F.min("_v").alias("min_value"),
                 F.max("donation_date").alias("last_donation_date"),
                 F.min("donation_date").alias("first_donation_date_tx"),
                 F.max(flag01("is_recurring")).alias("ever_recurring"),
                 n_distinct("campaign_name").alias("num_campaigns"),
                 n_distinct("channel_source").alias("num_channels"),
                 # Per-day slope (the reference regresses on epoch seconds;
                 # x86400 scaling only, same sign and ranking)
                 F.regr_slope("_v", epoch_days("donation_date")).alias("donation_trend")))


# A6 alone: slope of y on time per key
def trend_slope(df: DataFrame, key: str, y: str, t: str, name: str = "trend") -> DataFrame:
    return df.groupBy(key).agg(F.regr_slope(F.col(y), epoch_days(t)).alias(name))


# Churn label from recency and ever_recurring
def churn_label(recency_days="recency_days", ever_recurring="ever_recurring",
                recurring_window: int = 120, window: int = 90) -> Column:
    r, e = F.col(recency_days), F.col(ever_recurring)
    return F.when((e == 1) & (r > recurring_window), 1).when((e == 0) & (r > window), 1) \
            .otherwise(0)


# Group describe
def group_describe(df: DataFrame, by: list[str], value: str) -> DataFrame:
    v = F.col(value)
    base = df.groupBy(*by).agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"))
    q = exact_quantiles(df, by, value, [0.25, 0.5, 0.75], ["q25", "q50", "q75"])
    if by:
        return base.join(q, by, "left")
    from civora.operators.joins import with_scalars
    return with_scalars(base, q)


# Most frequent value per group, ties -> smallest value
def mode_per_group(df: DataFrame, by: list[str], col: str, out: str) -> DataFrame:
    """value_counts().index[0] per group with a deterministic tie-break.

    Two aggregations, no window: (group, value) counts are combined map-side,
    then ``min_by(value, (-count, value))`` picks the winner per group.
    """
    counts = (df.where(F.col(col).isNotNull()).groupBy(*by, col)
              .agg(F.count(F.lit(1)).alias("_n")))
    return counts.groupBy(*by).agg(
        F.min_by(F.col(col), F.struct(-F.col("_n"), F.col(col))).alias(out))


# Argmax of a group mean, ties -> smallest key
def argmax_mean(df: DataFrame, by: list[str], key: str, value: str, out: str,
                with_value: str | None = None) -> DataFrame:
    means = (df.where(F.col(key).isNotNull() & F.col(value).isNotNull())
             .groupBy(*by, key).agg(F.avg(value).alias("_m")))
    aggs = [F.min_by(F.col(key), F.struct(-F.col("_m"), F.col(key))).alias(out)]
    if with_value:
        aggs.append(F.max("_m").alias(with_value))
    return means.groupBy(*by).agg(*aggs)


# Normalised value counts
def value_counts(df: DataFrame, col: str, by: list[str] | None = None) -> DataFrame:
    """Counts and shares; the total comes from the (small) count table itself."""
    by = by or []
    counts = df.groupBy(*by, col).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(w))


# Weighted composite over the non-null parts, weights re-normalised
def weighted_composite(parts: list[tuple[str, float]]) -> Column:
    num = sum((F.coalesce(F.col(c) * w, F.lit(0.0)) for c, w in parts), F.lit(0.0))
    den = sum((F.when(F.col(c).isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for c, w in parts),
              F.lit(0.0))
    return F.when(den > 0, num / den)


# Pivot counts with zero fill
def pivot_counts(df: DataFrame, row: str, col: str, values: list) -> DataFrame:
    return df.groupBy(row).pivot(col, values).count().fillna(0)


# Rate of a condition per group with an alert threshold
def group_rate_alert(df: DataFrame, by: str, cond: Column, threshold: float) -> DataFrame:
    return (df.groupBy(by)
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(cond).alias("n_flagged"))
            .withColumn("rate", F.col("n_flagged") / F.col("n"))
            .withColumn("alert", F.col("rate") > threshold))


# Exact quantiles without one task per group ------------------------

def exact_quantiles(df: DataFrame, by: list[str], col: str, qs: list[float],
                    names: list[str] | None = None, buckets: int = 64, interpolate: bool = True) -> DataFrame:
    """Exact (linearly interpolated) quantiles per group, same values as
    ``percentile(col, q)``, without gathering a group's distinct values in one task.
    ``interpolate=False`` returns the value at the lower of the two ranks, always one of the data.

    1. (group, value) counts -- a hot group is spread over tasks by value;
    2. per-group N and bounds of ``buckets`` even parts of its values (a mergeable sketch), and
       the value's bucket among them: outliers do not empty the other buckets;
    3. running counts by (group, bucket) via ``bucketed_prefix_sum``;
    4. the values at 0-based ranks floor((N-1)q) and ceil((N-1)q) are picked by
       a conditional max, then interpolated as Spark's ``percentile`` does.
    """
    from civora.operators.joins import with_scalars
    from civora.operators.ordering import bucket_of, cut_points
    from civora.operators.temporal import bucketed_prefix_sum
    names = names or [f"q{int(round(q * 100))}" for q in qs]
    x = F.col(col).cast("double")
    vc = df.where(x.isNotNull()).groupBy(*by, x.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    mm = vc.groupBy(*by).agg(cut_points(F.col("_v"), buckets, 1000).alias("_cuts"), F.sum("_n").alias("_tot"))
    j = vc.join(mm, by) if by else with_scalars(vc, mm)
    b = bucket_of(F.col("_v"), F.col("_cuts"), buckets - 1)
    cum = bucketed_prefix_sum(j.withColumn("_b", b).drop("_cuts"), by, "_b", ["_v"], ["_n"])
    before = F.col("_n_cum") - F.col("_n")            # rows strictly below this value
    aggs = []
    for q, nm in zip(qs, names):
        pos = (F.col("_tot") - 1) * q
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs += [F.max(F.when((before <= lo) & (lo < F.col("_n_cum")), F.col("_v"))).alias(f"_l_{nm}"),
                 F.max(F.when((before <= hi) & (hi < F.col("_n_cum")), F.col("_v"))).alias(f"_h_{nm}"),
                 F.first(pos).alias(f"_p_{nm}")]
    g = cum.groupBy(*by).agg(*aggs)
    out = []
    for nm in names:
        p, lo_v, hi_v = F.col(f"_p_{nm}"), F.col(f"_l_{nm}"), F.col(f"_h_{nm}")
        lo, hi = F.floor(p), F.ceil(p)
        between = F.when(lo == hi, lo_v).otherwise((hi - p) * lo_v + (p - lo) * hi_v)
        out.append((between if interpolate else lo_v).alias(nm))
    return g.select(*by, *out)


def stacked_quantiles(df: DataFrame, cols: list[str], qs: list[float], names: list[str],
                      label: str = "column", interpolate: bool = True) -> DataFrame:
    """``exact_quantiles`` for several columns at once: (column, value) pairs stacked long."""
    pairs = ", ".join(f"'{c}', CAST({c} AS DOUBLE)" for c in cols)
    long = df.select(F.expr(f"stack({len(cols)}, {pairs}) AS ({label}, _x)"))
    return exact_quantiles(long, [label], "_x", qs, names, interpolate=interpolate)
