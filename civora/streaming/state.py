"""Kept state per key for incremental jobs: mergeable accumulators in append-only files.

A micro-batch is folded into one accumulator row per key, merged with the
state these keys had, and appended as a delta of exactly the touched keys.
Nothing that is live is ever overwritten; for a key the last write wins:

    <path>/delta/batch=<epoch>/       merged state of the batch's keys
    <path>/base/upto=<epoch>/_bucket=<b>/   all keys as of an epoch, by hash bucket
    <path>/bases/                     one row per finished base: a base counts once its row is there

A batch reads the base buckets its keys fall into (pruned as partitions) and
the deltas since that base, so what it reads follows the number of its keys:
choose ``n_buckets`` so that a bucket holds some thousand keys. Compaction
writes a new base apart from the stream. An epoch that runs again after a
failure replaces its own delta and does not see it, so it counts once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civora.operators.aggregates import epoch_days
from civora.sources.tables import read_if_exists


@dataclass(frozen=True)
class Accumulator:
    """``first``: aggregate of a batch's raw rows; ``merge``: aggregate of two states' values."""
    first: Column
    merge: Callable[[str], Column]


def gift_accumulators(value: Column, date: str = "donation_date", recurring: Column | None = None) -> dict[str, Accumulator]:
    """Count, sum, extremes, first and last date, ever-recurring and the moments of the trend line."""
    t, v = epoch_days(date), value.cast("double")
    both = F.col(date).isNotNull() & value.isNotNull()
    moment = lambda x: Accumulator(F.sum(F.when(both, x)), F.sum)
    return {"frequency": Accumulator(F.count(F.lit(1)), F.sum), "total_value": Accumulator(F.sum(v), F.sum),
            "max_value": Accumulator(F.max(v), F.max), "min_value": Accumulator(F.min(v), F.min),
            "first_date": Accumulator(F.min(date), F.min), "last_date": Accumulator(F.max(date), F.max),
            "ever_recurring": Accumulator(F.max((recurring if recurring is not None else F.lit(False)).cast("int")), F.max),
            "m_n": moment(F.lit(1.0)), "m_t": moment(t), "m_v": moment(v), "m_tv": moment(t * v), "m_tt": moment(t * t)}


def trend() -> Column:
    """Slope of value on days from the kept moments (null for a single day)."""
    spread = F.col("m_n") * F.col("m_tt") - F.col("m_t") * F.col("m_t")
    return F.when(spread > 0, (F.col("m_n") * F.col("m_tv") - F.col("m_t") * F.col("m_v")) / spread)


class KeyedState:
    """State of ``key`` under ``path`` (a shared folder)."""

    def __init__(self, spark: SparkSession, path: str, key: str, accumulators: dict[str, Accumulator], n_buckets: int = 64):
        self.spark, self.path, self.key, self.accumulators, self.n_buckets = spark, path.rstrip("/"), key, accumulators, n_buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.n_buckets)).cast("int")

    def _base(self) -> tuple[int, DataFrame | None]:
        """(last epoch in the newest finished base, its rows with _bucket), (-1, None) before the first."""
        bases = read_if_exists(self.spark, f"{self.path}/bases", "upto long")
        upto = bases.agg(F.max("upto")).first()[0] if bases is not None else None
        return (-1, None) if upto is None else (upto, self.spark.read.parquet(f"{self.path}/base/upto={upto}"))

    def _deltas(self, after: int, before: int | None = None) -> DataFrame | None:
        """Newest delta row per key among the epochs in (after, before), None if there is none."""
        deltas = read_if_exists(self.spark, f"{self.path}/delta")
        if deltas is None:
            return None
        deltas = deltas.where(F.col("batch") > after)
        if before is not None:
            deltas = deltas.where(F.col("batch") < before)
        names = [c for c in deltas.columns if c not in (self.key, "batch")]
        latest = deltas.groupBy(self.key).agg(F.max_by(F.struct(*names), "batch").alias("s"))
        return latest.select(self.key, *[F.col("s")[c].alias(c) for c in names])

    def touched_base(self, keys: DataFrame) -> DataFrame | None:
        """The base buckets that ``keys`` fall into: all that a batch reads of the base."""
        _, base = self._base()
        if base is None:
            return None
        buckets = [r[0] for r in keys.select(self._bucket().alias("b")).distinct().collect()]  # at most n_buckets
        return base.where(F.col("_bucket").isin(buckets))

    def apply(self, rows: DataFrame, epoch: int) -> DataFrame:
        """Fold a batch in; returns the state of the keys it touched."""
        names = list(self.accumulators)
        new = rows.groupBy(self.key).agg(*[a.first.alias(n) for n, a in self.accumulators.items()])
        keys = new.select(self.key)
        upto, _ = self._base()
        base, deltas = self.touched_base(keys), self._deltas(upto, epoch)
        both = new
        if deltas is not None:
            deltas = deltas.join(keys, self.key, "left_semi").select(self.key, *names)
            both = both.unionByName(deltas)
        if base is not None:
            base = base.join(keys, self.key, "left_semi").select(self.key, *names)
            if deltas is not None:  # a delta replaces what the base says of its key
                base = base.join(deltas.select(self.key), self.key, "left_anti")
            both = both.unionByName(base)
        out = f"{self.path}/delta/batch={epoch}"
        (both.groupBy(self.key).agg(*[a.merge(n).alias(n) for n, a in self.accumulators.items()])
         .write.mode("overwrite").parquet(out))
        return self.spark.read.parquet(out)

    def current(self) -> DataFrame:
        """The state of every key."""
        upto, base = self._base()
        deltas = self._deltas(upto)
        if base is None:
            return deltas
        base = base.drop("_bucket")
        return base if deltas is None else base.join(deltas.select(self.key), self.key, "left_anti").unionByName(deltas)

    def compact(self, upto: int) -> None:
        """Write the state as of epoch ``upto``, the last finished one, as a new base."""
        (self.current().withColumn("_bucket", self._bucket()).repartition("_bucket").sortWithinPartitions("_bucket", self.key)
         .write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.path}/base/upto={upto}"))
        self.spark.createDataFrame([(upto,)], "upto long").write.mode("append").parquet(f"{self.path}/bases")


def append_scores(scores: DataFrame, path: str, epoch: int) -> None:
    """Scores of one batch's keys, beside those of earlier batches."""
    scores.write.mode("overwrite").parquet(f"{path}/batch={epoch}")


def latest_scores(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Last score row per key over all batches."""
    rows = spark.read.parquet(path)
    names = [c for c in rows.columns if c not in (key, "batch")]
    return (rows.groupBy(key).agg(F.max_by(F.struct(*names), "batch").alias("s"))
            .select(key, *[F.col("s")[c].alias(c) for c in names]))
