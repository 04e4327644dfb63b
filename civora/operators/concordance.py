"""Kendall's tau-b by a distributed count of concordant and discordant pairs.

No pair is formed and no number of levels is assumed. Rows become cells
(a, b, n) with dense ranks. The ranks of b are compared bit by bit: two cells
whose b ranks agree above bit l and differ in it are ordered by that bit, so
every pair of different b ranks meets at exactly one level. Inside a level and
a common prefix, cells are taken in the order of a; running counts of the
cells with bit 0 and bit 1 give the concordant and discordant partners below.
That is the merge step of an inversion count, done for all merges of a level
at once: cells x log2(levels of b) rows, and the running counts are prefix sums
over (level, prefix, range of a), added up from range totals, so not even the
top level, which holds all cells, is one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civora.operators.joins import materialize, with_scalars
from civora.operators.ordering import global_position
from civora.operators.temporal import bucketed_prefix_sum

_RANGES = 256


def _dense_rank(cells: DataFrame, col: str, out: str) -> tuple[DataFrame, int]:
    """(col, out from 0) for every distinct value, and how many there are."""
    ranks = global_position(cells.select(col).distinct(), [F.col(col)], out)
    return ranks.withColumn(out, F.col(out) - 1), ranks.count()


def concordance(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: rows, concordant, discordant, tied_a, tied_b (pairs; exact decimals). Nulls are left out."""
    pairs = F.col("n").cast("decimal(19,0)") * (F.col("n") - 1).cast("decimal(19,0)")
    cells = materialize(df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
                        .groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("n")))
    (rank_a, n_a), (rank_b, n_b) = _dense_rank(cells, "a", "ra"), _dense_rank(cells, "b", "rb")
    levels = max(1, (n_b - 1).bit_length()) if n_b else 1
    ranked = cells.join(rank_a, "a").join(rank_b, "b").select(
        "ra", "rb", "n", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level"))
    bit = F.call_function("shiftright", F.col("rb"), F.col("level")).bitwiseAND(1)
    merged = ranked.groupBy("level", F.call_function("shiftright", F.col("rb"), F.col("level") + 1).alias("prefix"), "ra").agg(
        F.sum(F.when(bit == 0, F.col("n")).otherwise(0)).alias("n0"),
        F.sum(F.when(bit == 1, F.col("n")).otherwise(0)).alias("n1"))
    span = max(1, -(-n_a // _RANGES))
    run = bucketed_prefix_sum(merged.withColumn("_b", F.floor(F.col("ra") / span)), ["level", "prefix"], "_b", ["ra"],
                              ["n0", "n1"])
    exact = lambda x, y: F.sum(F.col(x).cast("decimal(19,0)") * (F.col(f"{y}_cum") - F.col(y)).cast("decimal(19,0)"))
    total = run.agg(F.coalesce(exact("n1", "n0"), F.lit(0)).alias("concordant"),
                    F.coalesce(exact("n0", "n1"), F.lit(0)).alias("discordant"))

    def tied(col: str, out: str) -> DataFrame:
        return cells.groupBy(col).agg(F.sum("n").alias("n")).agg(F.coalesce(F.sum(pairs) / 2, F.lit(0)).alias(out))

    rows = cells.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    return with_scalars(with_scalars(with_scalars(total, tied("a", "tied_a")), tied("b", "tied_b")), rows)


def kendall_tau_b(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: N, tau_b (null if a column is constant)."""
    c = concordance(df, a, b)
    all_ = F.col("rows").cast("double") * (F.col("rows") - 1) / 2
    root = F.sqrt((all_ - F.col("tied_a").cast("double")) * (all_ - F.col("tied_b").cast("double")))
    return c.select(F.col("rows").alias("N"),
                    F.try_divide((F.col("concordant") - F.col("discordant")).cast("double"), root).alias("tau_b"))
