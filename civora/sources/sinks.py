"""Sinks.

No table format with MERGE is available, so keyed upserts write a new
snapshot directory under the shared checkpoint root and record it in a small
pointer table; readers take the latest committed snapshot. Everything is a
set-based DataFrame write: no per-row statements, nothing passes the driver.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civora.sources.tables import read_if_exists
from civora.session import scratch_path


# IO3 / IO2
def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)


def read_csv(spark: SparkSession, path: str, schema: str, date_format: str = "yyyy-MM-dd",
             encoding: str = "UTF-8", null_value: str = "") -> DataFrame:
    return (spark.read.schema(schema).option("header", True).option("dateFormat", date_format)
            .option("encoding", encoding).option("nullValue", null_value).csv(path))


# IO4: keyed upsert (insert or overwrite every non-key column)
def upsert(old: DataFrame | None, new: DataFrame, key: list[str]) -> DataFrame:
    """Full outer join on the key; new values win for every non-key column.

    One shuffle on the key (none for a side already bucketed / partitioned on
    it); no window, so a key repeated in ``new`` is an input error the caller
    dedups first.
    """
    if old is None:
        return new
    cols = [c for c in new.columns if c not in key]
    has_new = F.col("n._present").isNotNull()
    j = old.withColumn("_present", F.lit(True)).alias("o").join(
        new.withColumn("_present", F.lit(True)).alias("n"), key, "full_outer")
    return j.select(*key, *[F.when(has_new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
                            for c in cols])


def commit_snapshot(spark: SparkSession, table: str, df: DataFrame,
                    root: str | None = None) -> str:
    """Write a new snapshot of ``table`` and append its path to the pointer table."""
    root = root or scratch_path(spark, "tables")
    version = time.strftime("%Y%m%d%H%M%S") + f"{int(time.time() * 1e6) % 1_000_000:06d}"
    path = f"{root}/{table}/v={version}"
    df.write.mode("errorifexists").parquet(path)
    spark.createDataFrame([(table, version, path)], "table string, version string, path string") \
        .write.mode("append").parquet(f"{root}/_pointers")
    return path


def read_latest(spark: SparkSession, table: str, root: str | None = None) -> DataFrame | None:
    root = root or scratch_path(spark, "tables")
    ptr = read_if_exists(spark, f"{root}/_pointers")
    if ptr is None:  # no pointer table yet
        return None
    row = ptr.where(F.col("table") == table).orderBy(F.col("version").desc()).select("path").first()
    return spark.read.parquet(row["path"]) if row else None


# IO5: replace-by-version (dynamic partition overwrite)
def write_version(df: DataFrame, path: str, version: str) -> None:
    (df.withColumn("model_version", F.lit(version)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
       .partitionBy("model_version").parquet(path))


# IO7: append predictions for rows not yet scored
def unscored(candidates: DataFrame, scored: DataFrame, key: list[str]) -> DataFrame:
    return candidates.join(scored.select(*key), key, "left_anti")


# IO10: input validation against a stored baseline
def validation_report(df: DataFrame, num_cols: list[str], cat_col: str | None = None,
                      known_levels: DataFrame | None = None) -> DataFrame:
    """Null rate, min, max per column in one aggregation (+ unseen levels count)."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in num_cols:
        aggs += [F.count(c).alias(f"{c}__nn"), F.min(c).cast("double").alias(f"{c}__min"),
                 F.max(c).cast("double").alias(f"{c}__max")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__nn`, `{c}__min`, `{c}__max`" for c in num_cols)
    out = wide.select(F.col("_n").alias("rows"), F.expr(
        f"stack({len(num_cols)}, {stack}) AS (column, non_null, min, max)"))
    out = out.withColumn("null_rate", 1 - F.col("non_null") / F.col("rows"))
    if cat_col and known_levels is not None:
        unseen = df.join(known_levels, cat_col, "left_anti").agg(F.count(F.lit(1)).alias("unseen_rows"))
        from civora.operators.joins import with_scalars
        out = with_scalars(out, unseen)
    return out


# IO6: full refresh (replace the whole output)
def full_refresh(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


# IO4 at scale: bucketed table, only the buckets touched by a batch are rewritten -------------------

def upsert_buckets(spark: SparkSession, path: str, new: DataFrame, key: list[str],
                   n_buckets: int = 64) -> None:
    """Keyed upsert into a Parquet table partitioned by ``pmod(xxhash64(key), n)``.

    Only the buckets that contain keys of ``new`` are read (partition pruning
    through the semi-join on the bucket column) and rewritten (dynamic partition
    overwrite), so the cost of a batch follows the batch, not the table. The
    merged buckets are checkpointed first, so the job never overwrites files it
    is still reading.
    """
    from civora.operators.joins import materialize
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in key]), F.lit(n_buckets)).cast("int")
    nb = new.withColumn("_bucket", bucket)
    touched = nb.select("_bucket").distinct()
    old = read_if_exists(spark, path, nb.schema)  # None: first batch, no table yet
    if old is not None:
        old = old.join(touched, "_bucket", "left_semi")
    merged = materialize(upsert(old, nb, key + ["_bucket"]) if old is not None else nb)
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("_bucket").parquet(path))


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("_bucket")
