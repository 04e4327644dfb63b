"""Temporal joins and sequence operators.

Skew rule used throughout: no window is partitioned by the entity key alone
over raw rows, because one entity may hold a third of all rows and a window
partition is processed by one task. Instead rows are split by
(entity, bucket) -- a day, or a hash/range bucket -- and state that crosses
buckets (a running count, the last non-null value) is carried through a
small table with one row per (entity, bucket). Results are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNB = Window.unboundedPreceding


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


# ----------------------------------------------------------------------------
# Exact row numbers and carried values without an entity-wide window
# ----------------------------------------------------------------------------

def bucketed_row_number(df: DataFrame, keys: list[str], bucket: str, order: list,
                        out: str = "rn") -> DataFrame:
    """Exact ``row_number() over (partition by keys order by bucket, order...)``.

    ``bucket`` must be the leading sort key (a day, a hash prefix, a range
    bucket). Rows are numbered inside (keys, bucket); each bucket's offset is a
    prefix sum over the per-bucket counts, whose size is bounded by the number
    of buckets per key, not by the rows.
    """
    counts = df.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("_bn"))
    wk = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))) \
        .orderBy(bucket).rowsBetween(UNB, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_bn").over(wk), F.lit(0))).drop("_bn")
    wi = Window.partitionBy(*keys, bucket).orderBy(*_cols(order))
    return (df.withColumn("_rn_in", F.row_number().over(wi))
              .join(offsets, [*keys, bucket])
              .withColumn(out, (F.col("_off") + F.col("_rn_in")).cast("bigint"))
              .drop("_off", "_rn_in"))


def carry_forward(df: DataFrame, keys: list[str], bucket: str, order: list, value: str,
                  out: str) -> DataFrame:
    """Last non-null ``value`` at or before each row, ordered by (bucket, order...).

    Same result as ``last(value, ignorenulls) over (partition by keys order by
    bucket, order rows unbounded preceding)``, computed per (keys, bucket) plus
    a carry-in from a per-(keys, bucket) table.
    """
    wi = Window.partitionBy(*keys, bucket).orderBy(*_cols(order)).rowsBetween(UNB, 0)
    inner = df.withColumn("_in", F.last(value, ignorenulls=True).over(wi))
    tails = (df.where(F.col(value).isNotNull()).groupBy(*keys, bucket)
             .agg(F.max_by(F.col(value), F.struct(*_cols(order))).alias("_tail")))
    buckets = df.select(*keys, bucket).distinct().join(tails, [*keys, bucket], "left")
    wk = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(UNB, -1)
    carry = buckets.withColumn("_carry", F.last("_tail", ignorenulls=True).over(wk)).drop("_tail")
    return (inner.join(carry, [*keys, bucket])
                 .withColumn(out, F.coalesce(F.col("_in"), F.col("_carry")))
                 .drop("_in", "_carry"))


# ----------------------------------------------------------------------------
# As-of baseline and follow-up window around anchor dates
# ----------------------------------------------------------------------------

def asof_value(anchors: DataFrame, records: DataFrame, key: str, anchor_date: str,
               rec_date: str, rec_id: str, value: str, out: str) -> DataFrame:
    """Value of the last record with ``rec_date <= anchor_date`` (ties: highest id).

    Union-and-carry form (one pass over both sides, no join fan-out): records
    sort before anchors on the same day so that "at or before" holds. Anchors
    must be unique on (key, anchor_date); output has one row per anchor.
    """
    a = anchors.select(key, anchor_date).distinct().select(
                       F.col(key), F.col(anchor_date).alias("_d"), F.lit(1).alias("_k"),
                       F.lit(None).cast("long").alias("_id"),
                       F.lit(None).cast("double").alias("_v"))
    r = records.select(F.col(key), F.col(rec_date).alias("_d"), F.lit(0).alias("_k"),
                       F.col(rec_id).cast("long").alias("_id"),
                       F.col(value).cast("double").alias("_v"))
    u = carry_forward(a.unionByName(r), [key], "_d", ["_k", "_id"], "_v", out)
    return u.where("_k = 1").select(F.col(key), F.col("_d").alias(anchor_date), F.col(out))


def daily_rollup(records: DataFrame, key: str, rec_date: str, value: str | None) -> DataFrame:
    """Per (key, day) count and sum: the unit the window operators work on."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    if value:
        aggs += [F.sum(value).alias("_s"), F.count(value).alias("_nv")]
    return records.groupBy(F.col(key), F.to_date(rec_date).alias("_day")).agg(*aggs)


def followup_stats(anchors: DataFrame, records: DataFrame, key: str, anchor_date: str,
                   rec_date: str, value: str | None, days: int, prefix: str,
                   sum_decimals: int | None = None) -> DataFrame:
    """Count / mean of records with anchor < rec_date <= anchor + days.

    ``sum_decimals``: when the values carry at most that many decimals, the
    sum is rounded to them before dividing, which makes the mean independent
    of summation order (identical across partitionings and engines).

    Records are first rolled up per (key, day); each anchor is expanded to its
    ``days`` follow-up days and equi-joined to that rollup, so the work is
    anchors x days (a constant), never anchors x records, and the plan is a
    hash/sort-merge equi-join, not a nested loop.
    """
    daily = daily_rollup(records, key, rec_date, value)
    exp = (anchors.select(key, anchor_date).distinct()
           .withColumn("_off", F.explode(F.sequence(F.lit(1), F.lit(days))))
           .withColumn("_day", F.date_add(F.col(anchor_date), F.col("_off"))))
    j = exp.join(daily, [key, "_day"], "left")
    aggs = [F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias(f"{prefix}_n")]
    if value:
        tot = F.sum("_s") if sum_decimals is None else F.round(F.sum("_s"), sum_decimals)
        aggs.append(F.try_divide(tot, F.sum("_nv")).alias(f"{prefix}_mean"))
    return j.groupBy(key, anchor_date).agg(*aggs)


def count_at_or_before(anchors: DataFrame, records: DataFrame, key: str, anchor_date: str,
                       rec_date: str, out: str) -> DataFrame:
    """Number of records with rec_date <= anchor (running count, carried as-of)."""
    daily = daily_rollup(records, key, rec_date, None)
    w = Window.partitionBy(key).orderBy("_day").rowsBetween(UNB, 0)
    cum = daily.withColumn("_cum", F.sum("_n").over(w).cast("double")) \
               .withColumn("_rid", F.lit(0))
    got = asof_value(anchors, cum, key, anchor_date, "_day", "_rid", "_cum", out)
    return got.withColumn(out, F.coalesce(F.col(out), F.lit(0.0)).cast("bigint"))


# ----------------------------------------------------------------------------
# Chunk each entity's ordered sequence into windows of max(1, n // 3)
# ----------------------------------------------------------------------------

def chunk_sequences(df: DataFrame, key: str, date: str, tiebreak: str, parts: int = 3,
                    out: str = "chunk") -> DataFrame:
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_seq_n"))
    ranked = bucketed_row_number(df, [key], date, [tiebreak], "_pos")
    step = F.greatest(F.lit(1), F.floor(F.col("_seq_n") / parts))
    return (ranked.join(sizes, key)
                  .withColumn(out, F.floor((F.col("_pos") - 1) / step).cast("int"))
                  .drop("_seq_n"))


# ----------------------------------------------------------------------------
# Lagged panel (fact at month m joined to metrics at m, m+3, m+6)
# ----------------------------------------------------------------------------

def lagged_panel(facts: DataFrame, metrics: DataFrame, key: str, fact_month: str,
                 metric_month: str, value_cols: dict[str, str], lags: dict[str, int]) -> DataFrame:
    """Left-join ``metrics`` at fact_month + k months for each suffix -> k.

    The metrics side is shifted (``month - k``) instead of the fact side, so
    every join uses the same fact key (key, fact_month): the fact side is
    shuffled once and the joins chain on that partitioning.
    """
    out = facts
    for suffix, k in lags.items():
        m = metrics.select(F.col(key).alias(key),
                           F.add_months(F.col(metric_month), -k).alias(fact_month),
                           *[F.col(src).alias(f"{dst}_{suffix}") for dst, src in value_cols.items()])
        out = out.join(m, [key, fact_month], "left")
    return out


# ----------------------------------------------------------------------------
# Per-entity recency features
# ----------------------------------------------------------------------------

def latest_value(df: DataFrame, key: str, date: str, rec_id: str, value: str, out: str) -> Column:
    """A8 / W1 aggregate form: value of the latest record per key (ties: highest id)."""
    return F.max_by(F.col(value), F.struct(F.col(date), F.col(rec_id))).alias(out)


def rolling_mean(df: DataFrame, key: str, date: str, value: str, days: int, out: str) -> DataFrame:
    """Trailing ``days``-day mean per key (window on the per-day rollup)."""
    daily = daily_rollup(df, key, date, value)
    w = Window.partitionBy(key).orderBy(F.unix_date("_day")).rangeBetween(-(days - 1), 0)
    return daily.select(key, F.col("_day").alias(date),
                        F.try_divide(F.sum("_s").over(w), F.sum("_nv").over(w)).alias(out))


# ----------------------------------------------------------------------------
# Anchor statistics over a per-(key, day) rollup (used by the intervention job)
# ----------------------------------------------------------------------------

def daily_child_rollup(children: dict[str, tuple[DataFrame, str, str | None, str | None]],
                       key: str) -> DataFrame:
    """Union several child tables into one (key, day) table in one shuffle.

    ``children``: name -> (df, date_col, id_col, value_col). For each name the
    rollup carries ``{name}_n`` (rows), ``{name}_s`` / ``{name}_nv`` (sum and
    count of value) and ``{name}_last`` (value of the highest id that day).
    Its size is bounded by keys x days, independent of rows per key.
    """
    parts = []
    names = list(children)
    for name, (df, date_col, id_col, value_col) in children.items():
        cols = [F.col(key), F.to_date(date_col).alias("_day")]
        for other in names:
            mine = other == name
            cols += [
                (F.lit(1) if mine else F.lit(None)).cast("long").alias(f"{other}_one"),
                (F.col(value_col) if mine and value_col else F.lit(None)).cast("double")
                .alias(f"{other}_v"),
                (F.col(id_col) if mine and id_col else F.lit(None)).cast("long").alias(f"{other}_id"),
            ]
        parts.append(df.select(*cols))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    aggs = []
    for n in names:
        aggs += [F.count(f"{n}_one").alias(f"{n}_n"), F.sum(f"{n}_v").alias(f"{n}_s"),
                 F.count(f"{n}_v").alias(f"{n}_nv"),
                 F.max_by(F.col(f"{n}_v"), F.when(F.col(f"{n}_v").isNotNull(), F.col(f"{n}_id")))
                 .alias(f"{n}_last")]
    return u.groupBy(key, "_day").agg(*aggs)


def anchor_asof(anchors: DataFrame, daily: DataFrame, key: str, anchor: str,
                last_cols: list[str], cum_cols: list[str]) -> DataFrame:
    """J5 on a daily rollup: last non-null value and running count at/before each anchor.

    One window over (rollup rows + anchor rows) partitioned by key; its
    partition size is bounded by the days per key, not by the records.
    """
    a = anchors.select(key, anchor).distinct().select(
        F.col(key), F.col(anchor).alias("_day"), F.lit(1).alias("_k"),
        *[F.lit(None).cast("double").alias(c) for c in last_cols],
        *[F.lit(0).cast("long").alias(c) for c in cum_cols])
    d = daily.select(F.col(key), F.col("_day"), F.lit(0).alias("_k"),
                     *[F.col(c).cast("double") for c in last_cols],
                     *[F.col(c).cast("long") for c in cum_cols])
    w = Window.partitionBy(key).orderBy("_day", "_k").rowsBetween(UNB, 0)
    u = a.unionByName(d)
    sel = [F.col(key), F.col("_day").alias(anchor), F.col("_k")]
    sel += [F.last(c, ignorenulls=True).over(w).alias(f"{c}_asof") for c in last_cols]
    sel += [F.sum(c).over(w).alias(f"{c}_upto") for c in cum_cols]
    return u.select(*sel).where("_k = 1").drop("_k")


def anchor_followup(anchors: DataFrame, daily: DataFrame, key: str, anchor: str, days: int,
                    sum_cols: list[str]) -> DataFrame:
    """J6 on a daily rollup: sums over anchor < day <= anchor + days (equi-join on day)."""
    exp = (anchors.select(key, anchor).distinct()
           .withColumn("_day", F.explode(F.sequence(F.date_add(F.col(anchor), 1),
                                                    F.date_add(F.col(anchor), days)))))
    j = exp.join(daily.select(key, "_day", *sum_cols), [key, "_day"], "left")
    return j.groupBy(key, anchor).agg(*[F.sum(c).alias(f"{c}_fu") for c in sum_cols])


def bucketed_prefix_sum(df: DataFrame, keys: list[str], bucket: str, order: list,
                        values: list[str], suffix: str = "_cum") -> DataFrame:
    """Exact running sums of ``values`` ordered by (bucket, order...), per keys.

    Same bucket decomposition as ``bucketed_row_number``: per-bucket totals are
    prefix-summed over buckets (bounded table), rows are summed inside their
    bucket, the two are added. Used for ROC curves, AUC ranks and splits.
    """
    tot = df.groupBy(*keys, bucket).agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    wk = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))) \
        .orderBy(bucket).rowsBetween(UNB, -1)
    off = tot.select(*keys, bucket, *[F.coalesce(F.sum(f"_t_{v}").over(wk), F.lit(0))
                                      .alias(f"_o_{v}") for v in values])
    wi = Window.partitionBy(*keys, bucket).orderBy(*_cols(order)).rowsBetween(UNB, 0)
    inner = df.select("*", *[F.sum(v).over(wi).alias(f"_i_{v}") for v in values])
    out = inner.join(off, [*keys, bucket])
    for v in values:
        out = out.withColumn(f"{v}{suffix}", F.col(f"_o_{v}") + F.col(f"_i_{v}"))
    return out.drop(*[f"_o_{v}" for v in values], *[f"_i_{v}" for v in values])
