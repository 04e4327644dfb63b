"""Density-based outlier removal: DBSCAN noise, at most a share of the rows removed.

A row is a core row if at least ``min_pts`` rows (itself included) lie within
``eps`` of it in standardised units; it is noise if it is neither core nor
within ``eps`` of a core row. Distances are tested between points, exactly;
what a grid does is bound how many are tested:

* Cells have the side eps / sqrt(d), so rows of one cell are neighbours. A cell
  of at least ``min_pts`` rows is dense and all its rows are core, untested.
* Only rows of the other cells ask. Such a cell holds fewer than ``min_pts``
  rows, so a cell is asked by a bounded number of rows, whatever it holds. A
  dense cell that lies wholly inside a row's eps-ball answers with its count.
* Equal rows are one weighted point, and a large cell's points are dealt to
  chunks of ``_CHUNK``: a cell with a third of all rows is many small joins.

Work is linear in the rows, times (cells in reach) x ``min_pts``.
"""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civora.operators.joins import materialize, with_scalars
from civora.operators.ordering import global_position

_CHUNK = 4096


def standardise(df: DataFrame, cols: list[str]) -> DataFrame:
    """``df`` plus z0, z1, ...: (x - mean) / population deviation (0 if the column is constant)."""
    stats = df.agg(*[F.avg(c).alias(f"_mu{i}") for i, c in enumerate(cols)],
                   *[F.stddev_pop(c).alias(f"_sd{i}") for i, c in enumerate(cols)])
    z = [F.when(F.col(f"_sd{i}") > 0, (F.col(c) - F.col(f"_mu{i}")) / F.col(f"_sd{i}")).otherwise(F.lit(0.0)).alias(f"z{i}")
         for i, c in enumerate(cols)]
    wide = with_scalars(df, stats)
    return wide.select(*df.columns, *z)


def _squares(d: int, a: str, b: str) -> Column:
    return sum(((F.col(f"{a}{i}") - F.col(f"{b}{i}")) ** 2 for i in range(d)), F.lit(0.0))


def dbscan_noise(df: DataFrame, key: str, cols: list[str], eps: float, min_pts: int) -> DataFrame:
    """One row per row of ``df`` that is noise: key, n_near (rows within eps, itself included), spread.

    ``spread`` is the squared standardised distance from the mean. Rows with a
    null or NaN coordinate are never noise. ``key`` names one row each.
    """
    d, side = len(cols), eps / math.sqrt(len(cols))
    whole = df.where(" AND ".join(f"{c} IS NOT NULL AND NOT isnan(CAST({c} AS DOUBLE))" for c in cols))
    z, c, t, q = ([f"{p}{i}" for i in range(d)] for p in "zctq")
    rows = materialize(standardise(whole.select(key, *[F.col(x).cast("double").alias(x) for x in cols]), cols).select(key, *z))
    cell = [F.floor(F.col(x) / side).alias(y) for x, y in zip(z, c)]
    points = materialize(rows.groupBy(*z).agg(F.count(F.lit(1)).alias("w")).select(*z, "w", *cell))
    cells = points.groupBy(*c).agg(F.sum("w").alias("cell_n"), F.ceil(F.count(F.lit(1)) / _CHUNK).cast("int").alias("chunks"))
    cells = materialize(cells.withColumn("dense", F.col("cell_n") >= min_pts))
    sparse = points.join(cells.where(~F.col("dense")).select(*c), c)
    reach = math.ceil(math.sqrt(d))
    offsets = [o for o in product(range(-reach, reach + 1), repeat=d)
               if sum(max(abs(k) - 1, 0) ** 2 for k in o) * side ** 2 <= eps ** 2]
    offset = F.array(*[F.struct(*[F.lit(k).alias(f"o{i}") for i, k in enumerate(o)]) for o in offsets])

    def probes(of: DataFrame) -> DataFrame:
        """Asking points with each cell in reach that holds any point: z.., t.. (the cell), cell_n, chunks, dense."""
        asked = of.select(*z, *c, F.explode(offset).alias("o")).select(
            *z, *[(F.col(x) + F.col("o")[f"o{i}"]).alias(t[i]) for i, x in enumerate(c)])
        return asked.join(cells.select(*[F.col(x).alias(y) for x, y in zip(c, t)], "cell_n", "chunks", "dense"), t)

    chunk = F.pmod(F.xxhash64(*z), F.col("chunks")).cast("int")
    answers = (points.join(cells.select(*c, "chunks", "dense"), c)
               .select(*[F.col(x).alias(y) for x, y in zip(z, q)], *[F.col(x).alias(y) for x, y in zip(c, t)], "w", chunk.alias("chunk")))
    asked = probes(sparse)
    corner = sum((F.greatest(F.abs(F.col(t[i]) * side - F.col(z[i])), F.abs((F.col(t[i]) + 1) * side - F.col(z[i]))) ** 2
                  for i in range(d)), F.lit(0.0))
    inside = F.col("dense") & (corner <= eps ** 2)
    tested = (asked.where(~inside).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
              .drop("cell_n", "chunks").join(answers, [*t, "chunk"]).where(_squares(d, "z", "q") <= eps ** 2)
              .select(*z, "w", "dense"))
    near = materialize(asked.where(inside).select(*z, F.col("cell_n").alias("w"), "dense").unionByName(tested)
                       .groupBy(*z).agg(F.sum("w").alias("n_near"), F.max("dense").alias("touches_dense")))
    core = sparse.join(near.where(F.col("n_near") >= min_pts).select(*z), z)
    open_ = sparse.join(near.where((F.col("n_near") < min_pts) & ~F.col("touches_dense")).select(*z), z)
    cores = core.select(*[F.col(x).alias(y) for x, y in zip(z, q)], *[F.col(x).alias(y) for x, y in zip(c, t)])
    border = (probes(open_).select(*z, *t).join(cores, t).where(_squares(d, "z", "q") <= eps ** 2).select(*z).distinct())
    noise = open_.select(*z).join(border, z, "left_anti").join(near, z)
    spread = sum((F.col(x) ** 2 for x in z), F.lit(0.0))
    return rows.join(noise, z).select(key, "n_near", spread.alias("spread"))


def _marked(rows: DataFrame, key: str, cols: list[str], eps: float, min_pts: int, drop_percent: float) -> DataFrame:
    """Noise of ``rows`` (which have ``_row``) with place and removed."""
    noise = dbscan_noise(rows, "_row", cols, eps, min_pts).join(rows.select("_row", key), "_row")
    order = [F.col("n_near"), F.round("spread", 6).desc(), F.col(key), F.col("_row")]
    cap = rows.agg(F.floor(F.count(F.lit(1)) * drop_percent).alias("_cap"))
    placed = with_scalars(global_position(noise, order, "place"), cap)
    return placed.select("_row", key, "n_near", "place", (F.col("place") <= F.col("_cap")).alias("removed"))


def _numbered(df: DataFrame) -> DataFrame:
    return materialize(df.withColumn("_row", F.monotonically_increasing_id()))


def mark_outliers(df: DataFrame, key: str, cols: list[str], eps: float, min_pts: int,
                  drop_percent: float = 0.02) -> DataFrame:
    """The noise rows with their place in the order of removal and whether the cap lets them go.

    Loneliest first (n_near, then the farthest from the mean, then the key);
    at most floor(drop_percent x rows) are removed. Rows may share a key.
    """
    rows = _numbered(df.select(key, *cols))
    return _marked(rows, key, cols, eps, min_pts, drop_percent).drop("_row")


def drop_outliers(df: DataFrame, key: str, cols: list[str], eps: float, min_pts: int,
                  drop_percent: float = 0.02) -> DataFrame:
    """``df`` without the rows that :func:`mark_outliers` removes."""
    rows = _numbered(df)
    gone = _marked(rows, key, cols, eps, min_pts, drop_percent).where("removed").select("_row")
    return rows.join(gone, "_row", "left_anti").drop("_row")
