"""Helpers shared by the operators: content keys, shared tables, text chunks."""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civora.session import scratch_path

ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
         "binary": pa.binary(), "boolean": pa.bool_()}


def read(spark: SparkSession, sf_dir: str, table: str, *cols: str) -> DataFrame:
    """Scan one table, projected to ``cols`` (all columns if none are named)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
    return df.select(*cols) if cols else df


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names."""
    return scratch_path(spark, f"civora-{name}-{uuid.uuid4().hex}")


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: later stages reread files that every executor reaches,
    so a lost executor never forces the work above to run again, and rows that
    are used several times are computed once.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` in ``order`` with ``_pos``, each row's place counted from 0.

    A range-partitioned sort, written once: a row's place is its place inside
    its partition plus the rows of the partitions before. Only one count per
    partition reaches the driver, and equal keys may lie in one partition only
    as far as all of ``order`` is equal.
    """
    rows = shared_table(df.orderBy(*order).select(
        "*", F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_at")), name)
    first, before = [], 0
    for r in rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect():
        first.append((r["_part"], before))
        before += r["n"]
    starts = df.sparkSession.createDataFrame(first, "_part int, _first long")
    return (rows.join(F.broadcast(starts), "_part").withColumn("_pos", F.col("_first") + F.col("_at"))
            .drop("_part", "_at", "_first"))


def text_key(text: str | Column = "text") -> Column:
    """16-byte content key of a text (null: as empty)."""
    return F.unhex(F.md5(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))))


def tidy(run):
    """``run`` as an Arrow task that hands freed memory back to the system at its end.

    Python workers are reused: without this a worker keeps the peak of one
    stage while it runs the next.
    """

    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
                trim(0)

    return task


def unused(name: str, *tables: DataFrame) -> str:
    """``name``, lengthened until no column of ``tables`` is called so (in any case)."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(sizes, limit: int):
    """Ranges (i, j) of consecutive rows whose sizes add up to about ``limit``."""
    i, total = 0, 0
    for j, n in enumerate(sizes):
        if total and total + n > limit:
            yield i, j
            i, total = j, 0
        total += n
    if len(sizes) > i:
        yield i, len(sizes)


def portions(batch: pa.RecordBatch, column: int, rows: int = 256, size: int = 1 << 20):
    """Slices of ``batch`` of at most ``rows`` rows whose texts in ``column`` add up to about ``size`` bytes.

    A task that takes a batch apart slice by slice never holds all of its texts as Python objects.
    """
    sizes = [n or 0 for n in pc.binary_length(batch.column(column)).to_pylist()]
    for i, j in slices(sizes, size):
        for k in range(i, j, rows):
            yield batch.slice(k, min(rows, j - k))


def record_batch(rows: list, ddl: str) -> pa.RecordBatch:
    """Row tuples as an Arrow batch whose fields ``ddl`` names ("a long, b string, ...")."""
    fields = [x.split() for x in ddl.split(",")]
    cols = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, ARROW[t]) for c, (_, t) in zip(cols, fields)],
                                      names=[n for n, _ in fields])
