"""Chained imputation of numeric columns as a fit / apply pair, and gaps treated by their kind.

Every incomplete column is regressed on all the others, over the rows in which
it is filled; the other columns' gaps hold their current fill, and each column
sees the fills made before it in the same round. A fitted column is a step, an
affine form of the other values; the fill of a row is the sequence of all
steps, applied to the row by itself, so a ``Chain`` also fills rows it never saw.

Fitting needs sums of products only, and a step moves all rows with the same
gaps by the same affine map. So the sums are taken once per pattern of gaps,
in one aggregation, and all rounds work on these small matrices: a step turns
a pattern's matrix M into T M T'. Patterns are at most 2^(incomplete columns);
above ``PATTERNS`` of them the sums of each step are aggregated from the rows
with gaps instead, with the same result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civora.operators.joins import materialize


#: Patterns of gaps whose sums are kept on the driver, (k + 1)^2 numbers each.
PATTERNS = 4_096

#: Movements are read off sums of squares, which do not resolve smaller ones.
FINEST = 1e-7


@dataclass
class Chain:
    """Centres, scales and the steps (column, constant, weights) in scaled units, in the order to apply them."""

    cols: list[str]
    centre: list[float]
    scale: list[float]
    steps: list[tuple[int, float, list[float]]] = field(default_factory=list)
    rounds: int = 0
    converged: bool = False


def _number(col: str) -> Column:
    """The value as double; NaN counts as missing."""
    x = F.col(col).cast("double")
    return F.when(~F.isnan(x), x)


def _raw(chain: Chain) -> Column:
    return F.array(*[(_number(c) - F.lit(m)) / F.lit(s) for c, m, s in zip(chain.cols, chain.centre, chain.scale)])


def _run(raw: Column, start: Column, steps: list) -> Column:
    """``start`` after ``steps``; each sets one column where ``raw`` is null, from the values as they are then."""
    if not steps:
        return start
    listed = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(float(b)).alias("b"),
                                F.array(*[F.lit(float(v)) for v in w]).alias("w")) for j, b, w in steps])

    def step(values, s):
        fitted = F.aggregate(F.zip_with(values, s["w"], lambda x, w: x * w), s["b"], lambda a, b: a + b)
        return F.transform(values, lambda x, i: F.when((i == s["j"]) & raw[i].isNull(), fitted).otherwise(x))

    return F.aggregate(listed, start, step)


def _start(raw: Column) -> Column:
    """Gaps hold the mean, 0 in scaled units."""
    return F.transform(raw, lambda x: F.coalesce(x, F.lit(0.0)))


def _products(x: list[Column]) -> list[Column]:
    return [F.sum(x[a] * x[b]).alias(f"m{a}_{b}") for a in range(len(x)) for b in range(a, len(x))]


def _matrix(row, k: int) -> np.ndarray:
    """Sums of x_a x_b; the last one is the constant 1."""
    m = np.zeros((k + 1, k + 1))
    for a in range(k + 1):
        for b in range(a, k + 1):
            m[a, b] = m[b, a] = row[f"m{a}_{b}"] or 0.0
    return m


class _PatternSums:
    """Sums of products per pattern of gaps; a step changes the matrices of the patterns that lack its column."""

    def __init__(self, filled: list[str], sums: list[np.ndarray]):
        self.filled = np.array([[c == "1" for c in f] for f in filled])
        self.sums = np.array(sums)

    def matrix(self, j: int) -> np.ndarray:
        return self.sums[self.filled[:, j]].sum(0)

    def step(self, j: int, b: float, w: list[float]) -> float:
        """Root of the mean square by which the fills of column j move."""
        gap, row = ~self.filled[:, j], np.append(w, b)
        m = self.sums[gap]
        v, change = m @ row, row - np.eye(len(row))[j]
        moved, n = (m @ change @ change).sum(), m[:, -1, -1].sum()
        m[:, j, :], m[:, :, j] = v, v
        m[:, j, j] = v @ row
        self.sums[gap] = m
        return float(np.sqrt(max(0.0, moved) / n))


class _RowSums:
    """The same from the rows with gaps, aggregated at every step; complete rows never change and are summed once."""

    def __init__(self, rows: DataFrame, k: int):
        gap, self.k, self.steps = F.exists("raw", F.isnull), k, []
        self.rows = materialize(rows.where(gap))
        self.whole = self._sums(rows.where(~gap), F.col("raw"))

    def _sums(self, rows: DataFrame, values: Column) -> np.ndarray:
        rows = rows.select(values.alias("x"))
        return _matrix(rows.agg(*_products([F.col("x")[i] for i in range(self.k)] + [F.lit(1.0)])).first(), self.k)

    def matrix(self, j: int) -> np.ndarray:
        raw = F.col("raw")
        return self.whole + self._sums(self.rows.where(raw[j].isNotNull()), _run(raw, _start(raw), self.steps))

    def step(self, j: int, b: float, w: list[float]) -> float:
        raw = F.col("raw")
        old = self.rows.where(raw[j].isNull()).select("raw", _run(raw, _start(raw), self.steps).alias("old"))
        self.steps.append((j, b, w))
        off = _run(raw, F.col("old"), self.steps[-1:])[j] - F.col("old")[j]
        return float(old.agg(F.sqrt(F.avg(off * off)).alias("moved")).first()["moved"])


def _solve(m: np.ndarray, j: int) -> tuple[float, list[float]]:
    """Constant and weights of column j on the others; collinear columns share theirs (least norm)."""
    others = [i for i in range(len(m)) if i != j]
    got = np.linalg.pinv(m[np.ix_(others, others)], rcond=1e-10, hermitian=True) @ m[others, j]
    weights = np.zeros(len(m))
    weights[others] = got
    return float(weights[-1]), [float(v) for v in weights[:-1]]


def fit_chain(df: DataFrame, cols: list[str], rounds: int = 10, tol: float = 1e-3, patterns: int = PATTERNS) -> Chain:
    """Fit at most ``rounds`` rounds, until no column's fills move by ``tol`` of the largest absolute value (root mean square).

    Incomplete columns take their turn by number of gaps, fewest first, ties
    in the order of ``cols``. A column without any value is left out (and
    stays null); a constant one helps no other. With no gap, no row or one
    column nothing is regressed: a lone column's gaps get its mean. A ``tol``
    of 0 runs all rounds; others count as ``FINEST`` at least.
    """
    stats = df.select(*[_number(c).alias(c) for c in cols]).agg(
        F.count(F.lit(1)).alias("_n"),
        *[f(c).alias(f"{c}__{name}") for c in cols
          for name, f in (("n", F.count), ("mu", F.avg), ("sd", F.stddev_pop), ("top", lambda c: F.max(F.abs(c))))]).first()
    cols = [c for c in cols if stats[f"{c}__n"]]
    chain = Chain(cols, [stats[f"{c}__mu"] for c in cols], [stats[f"{c}__sd"] or 1.0 for c in cols])
    gaps = {i: stats["_n"] - stats[f"{c}__n"] for i, c in enumerate(cols)}
    targets = sorted((i for i in gaps if gaps[i]), key=lambda i: (gaps[i], i))
    k = len(cols)
    if not targets or k < 2:
        chain.converged = True
        return chain
    limit = tol and max(tol, FINEST) * max(stats[f"{c}__top"] for c in cols)

    rows = df.select(_raw(chain).alias("raw"))
    filled = F.concat(*[F.when(F.col("raw")[i].isNull(), "0").otherwise("1") for i in range(k)])
    found = (rows.groupBy(filled.alias("filled"))
             .agg(*_products([F.coalesce(F.col("raw")[i], F.lit(0.0)) for i in range(k)] + [F.lit(1.0)]))
             .limit(patterns + 1).collect())
    if len(found) <= patterns:
        found.sort()
        sums = _PatternSums([r["filled"] for r in found], [_matrix(r, k) for r in found])
    else:
        sums = _RowSums(rows, k)
    while chain.rounds < rounds and not chain.converged:
        moved = 0.0
        for j in targets:
            b, w = _solve(sums.matrix(j), j)
            chain.steps.append((j, b, w))
            moved = max(moved, sums.step(j, b, w) * chain.scale[j])
        chain.rounds += 1
        chain.converged = moved < limit
    return chain


def apply_chain(df: DataFrame, chain: Chain) -> DataFrame:
    """``df`` with every gap of the fitted columns filled, row by row; filled values keep their exact value.

    The columns become double; all other columns stay as they are.
    """
    if not chain.cols:
        return df
    raw, at = (_unused(n, df) for n in ("_raw", "_filled"))
    rows = df.withColumn(raw, _raw(chain))
    rows = rows.withColumn(at, _run(F.col(raw), _start(F.col(raw)), chain.steps))
    filled = {c: F.coalesce(_number(c), F.col(at)[i] * F.lit(s) + F.lit(m)).alias(c)
              for i, (c, m, s) in enumerate(zip(chain.cols, chain.centre, chain.scale))}
    return rows.select(*[filled.get(c, F.col(c)) for c in df.columns])


def _unused(name: str, df: DataFrame) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def chained_impute(df: DataFrame, cols: list[str], rounds: int = 10, tol: float = 1e-3) -> DataFrame:
    """F13 whole: ``df`` with the gaps of ``cols`` filled by a chain fitted on it."""
    return apply_chain(df, fit_chain(df, cols, rounds, tol))


# gaps that depend on the label are not filled ------------------------------------

#: From this many rows on the normal distribution stands for Student's.
NORMAL_FROM = 200_000


def missingness(df: DataFrame, cols: list[str], label: str, acceptable: float = 0.10) -> DataFrame:
    """Per column with gaps: (column, n_missing, n_present, statistic, p, biased), from one aggregation.

    Welch's statistic compares the label's mean where the column is missing
    with the mean where it is filled, over the rows that have a label; p is
    two-sided. A side with fewer than two rows, or no variance on both, tells
    nothing: p is null and the gaps do not count as biased.
    """
    from civora.operators.stats import norm_sf2, t_sf2
    y, aggs = _number(label), []
    for c in cols:
        for side, here in (("m", _number(c).isNull()), ("p", _number(c).isNotNull())):
            v = F.when(here, y)
            aggs += [F.count_if(here).alias(f"{c}__{side}_rows"), F.count(v).alias(f"{c}__{side}_n"),
                     F.avg(v).alias(f"{c}__{side}_mean"), F.var_samp(v).alias(f"{c}__{side}_var")]
    row, out = df.agg(*aggs).first(), []
    for c in cols:
        (rm, n1, mean1, v1), (rp, n0, mean0, v0) = (
            [row[f"{c}__{side}_{x}"] for x in ("rows", "n", "mean", "var")] for side in "mp")
        if not rm:
            continue
        stat = p = None
        if n1 > 1 and n0 > 1 and v1 + v0 > 0:
            a, b = v1 / n1, v0 / n0
            stat = (mean1 - mean0) / (a + b) ** 0.5
            degrees = (a + b) ** 2 / (a * a / (n1 - 1) + b * b / (n0 - 1))
            p = float(norm_sf2(stat) if n1 + n0 >= NORMAL_FROM else t_sf2(stat, degrees))
        out.append((c, rm, rp, stat, p, p is not None and p <= acceptable))
    return df.sparkSession.createDataFrame(
        out, "column string, n_missing long, n_present long, statistic double, p double, biased boolean")


def missing_fill(df: DataFrame, cols: list[str], label: str, acceptable: float = 0.10, biased: str = "drop",
                 rounds: int = 10, tol: float = 1e-3) -> DataFrame:
    """F12 and F13 together: the treated rows.

    Rows with a gap in a column whose gaps depend on the label are dropped, or
    filled as well with ``biased="impute"``; all other gaps of ``cols`` are
    filled by a chain fitted on the rows that stay.
    """
    if biased not in ("drop", "impute"):
        raise ValueError(f"biased: {biased}")
    dropped = [r["column"] for r in missingness(df, cols, label, acceptable).where("biased").collect()] if biased == "drop" else []
    for c in dropped:
        df = df.where(_number(c).isNotNull())
    return chained_impute(df, cols, rounds, tol)
