"""Join helpers.

Broadcast policy: a side is broadcast only when its size is proven -- either
a fixed-size dimension (region, nation, a platform list) or a fitted table whose
row count was checked against ``max_rows``. Beyond the bound the join falls back
to a shuffle join (sort-merge; AQE may still convert it at runtime when the
measured size is under ``spark.sql.autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Broadcast-hint ``df`` only if it has at most ``max_rows`` rows.

    Intended for small fitted tables (category shares, cluster sizes, effects).
    The table is checkpointed first (reliable checkpoint in the shared
    ``spark.checkpoint.dir``), so the size check and the join read the same
    materialised rows and the lineage is cut.
    """
    fixed = materialize(df)
    n = fixed.limit(max_rows + 1).count()
    return F.broadcast(fixed) if n <= max_rows else fixed


def materialize(df: DataFrame) -> DataFrame:
    """Eager reliable checkpoint: survives executor loss, cuts lineage."""
    from civora.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint root and read back.

    For tables as long as the input that several jobs read: columns are compressed and read one by
    one, where ``materialize`` keeps whole uncompressed rows.
    """
    import uuid

    from civora.session import scratch_path
    path = scratch_path(df.sparkSession, "staged", uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# J1 / J3
def enrich(facts: DataFrame, dim: DataFrame, on, how: str = "left",
           dim_max_rows: int | None = None) -> DataFrame:
    """Lookup enrichment; the dimension is broadcast only behind a size check."""
    side = bounded_broadcast(dim, dim_max_rows) if dim_max_rows else dim
    return facts.join(side, on, how)


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate as scalar-subquery columns.

    Replaces ``df.crossJoin(one_row)``: the plan is a scalar subquery computed
    once (and reused), not a nested-loop join.
    """
    s = one_row.select(F.struct(*[F.col(c) for c in one_row.columns]).alias("_s")).scalar()
    return df.select("*", *[s[c].alias(c) for c in one_row.columns])


# J7 / J8
def semi(facts: DataFrame, keys: DataFrame, on) -> DataFrame:
    return facts.join(keys, on, "left_semi")


def anti(facts: DataFrame, keys: DataFrame, on) -> DataFrame:
    return facts.join(keys, on, "left_anti")


# Cartesian product of two fixed small lists
def grid(spark, **axes) -> DataFrame:
    """Cartesian grid of fixed value lists, e.g. platform x is_boosted."""
    from itertools import product
    names = list(axes)
    return spark.createDataFrame(list(product(*axes.values())), names)
