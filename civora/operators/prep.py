"""Feature preparation as fit / transform pairs.

``fit_*`` returns a small fitted table (levels, medians, bounds) computed by
one aggregation; ``apply_*`` joins or folds it into the data. Fitted tables
are bounded by the number of columns or category levels, so they are either
folded into literal expressions (per-column statistics) or broadcast behind a
row-count check (category tables). Fitting on the training frame and reusing
the table when scoring fixes the reference's refit-at-scoring issue.
"""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civora.functions import constants as K
from civora.operators.joins import bounded_broadcast


# rare-category collapse ---------------------------------------------------

def fit_rare_levels(df: DataFrame, col: str, cutoff: float = K.RARE_CUTOFF) -> DataFrame:
    """(level, share, keep) for every level; keep = share >= cutoff. NULL is not a level."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("share", share).withColumn("keep", F.col("share") >= cutoff)


def apply_rare_levels(df: DataFrame, col: str, levels: DataFrame,
                      other: str = K.OTHER, max_levels: int = 1_000_000) -> DataFrame:
    """Replace levels whose fitted share is below the cutoff by ``other``.

    Unseen levels (absent at fit time) are kept as they are, like the
    reference's ``replace(rare, 'Other')``.
    """
    lv = bounded_broadcast(levels.select(F.col(col).alias("_lvl"), F.col("keep").alias("_keep")),
                           max_levels)
    j = df.join(lv, F.col(col) == F.col("_lvl"), "left")
    return j.withColumn(col, F.when(F.col("_keep") == F.lit(False), F.lit(other))
                        .otherwise(F.col(col))).drop("_lvl", "_keep")


# dummy coding, first level (alphabetical) dropped ---------------------------

def dummy_columns(df: DataFrame, col: str, drop_first: bool = True,
                  max_levels: int = 1000) -> tuple[DataFrame, list[str]]:
    """0/1 columns per level; the level list is a bounded distinct (checked)."""
    levels = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct()
              .orderBy(col).limit(max_levels + 1).collect()]
    if len(levels) > max_levels:
        raise ValueError(f"{col}: more than {max_levels} levels; use one_hot_vector instead")
    keep = levels[1:] if drop_first else levels
    names = []
    for lv in keep:
        name = f"{col}_{lv}"
        df = df.withColumn(name, (F.col(col) == F.lit(lv)).cast("int"))
        names.append(name)
    return df, names


# Imputation and scaling ---------------------------------------------

def fit_numeric_stats(df: DataFrame, cols: list[str],
                      with_median: bool = True) -> dict[str, dict[str, float]]:
    """Exact medians (distributed ``stacked_quantiles``), population mean / std."""
    from civora.operators.aggregates import stacked_quantiles
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    row = df.agg(*aggs).first()
    med = ({r["column"]: r["median"] for r in stacked_quantiles(df, cols, [0.5], ["median"]).collect()}
           if with_median else {})
    return {c: {"median": med.get(c), "mean": row[f"{c}__mean"], "std": row[f"{c}__std"]}
            for c in cols}


def impute_median_scale(df: DataFrame, stats: dict, scale: bool = True) -> DataFrame:
    """F2 then F4 (sklearn-style population std; zero std -> divide by 1)."""
    for c, s in stats.items():
        filled = F.coalesce(F.col(c).cast("double"), F.lit(s["median"]))
        if scale:
            # sklearn scales with the mean/std of the *imputed* column; callers
            # wanting exact parity fit stats on the imputed frame (two passes).
            std = s["std"] if s["std"] else 1.0
            filled = (filled - F.lit(s["mean"])) / F.lit(std)
        df = df.withColumn(c, filled)
    return df


def fit_modes(df: DataFrame, cols: list[str]) -> dict[str, str]:
    """most frequent value per column (ties -> smallest), one stacked aggregation."""
    parts = ", ".join(f"'{c}', CAST({c} AS STRING)" for c in cols)
    long = df.select(F.expr(f"stack({len(cols)}, {parts}) AS (_c, _v)")).where("_v IS NOT NULL")
    counts = long.groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy("_c").agg(F.min_by("_v", F.struct(-F.col("_n"), F.col("_v"))).alias("_m"))
    return {r["_c"]: r["_m"] for r in best.collect()}


def impute_modes(df: DataFrame, modes: dict[str, str]) -> DataFrame:
    for c, m in modes.items():
        df = df.withColumn(c, F.coalesce(F.col(c), F.lit(m).cast(df.schema[c].dataType)))
    return df


class MedianImputer(Estimator):
    """Pipeline stage for F2: nulls and NaN become the column's exact (lower) median of the fitted rows.

    Same values as MLlib's ``Imputer(strategy="median", relativeError=0.0)``, whose sketch then holds
    every value and is merged on the driver; here the medians come from the distributed quantiles.
    The fitted stage is an MLlib ``SQLTransformer``, saved with its pipeline.
    """

    def __init__(self, cols: list[str], outs: list[str]):
        super().__init__()
        self.cols, self.outs = list(cols), list(outs)

    def _fit(self, df: DataFrame):
        from pyspark.ml.feature import SQLTransformer

        from civora.operators.aggregates import stacked_quantiles
        x = {c: F.col(c).cast("double") for c in self.cols}
        filled = df.select(*[F.when(~F.isnan(v), v).alias(c) for c, v in x.items()])
        med = {r["column"]: r["m"] for r in
               stacked_quantiles(filled, self.cols, [0.5], ["m"], interpolate=False).collect()}
        empty = [c for c in self.cols if c not in med]
        if empty:
            raise ValueError(f"no median: {', '.join(empty)} has no value")
        types = {c: df.schema[c].dataType.simpleString() for c in self.cols}
        fills = [f"CAST(CASE WHEN `{c}` IS NULL OR isnan(CAST(`{c}` AS DOUBLE)) THEN CAST('{med[c]!r}' AS DOUBLE) "
                 f"ELSE `{c}` END AS {types[c]}) AS `{o}`" for c, o in zip(self.cols, self.outs)]
        return SQLTransformer(statement=f"SELECT *, {', '.join(fills)} FROM __THIS__")


# one-hot with unknown -> all zeros (MLlib) ---------------------------------------

def one_hot_stages(cat_cols: list[str]):
    """StringIndexer(keep) + OneHotEncoder(dropLast): the dropped slot is the
    unknown bucket, so unseen or NULL levels encode as all zeros."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep",
                         stringOrderType="alphabetAsc") for c in cat_cols]
    ohe = OneHotEncoder(inputCols=[f"{c}__idx" for c in cat_cols],
                        outputCols=[f"{c}__ohe" for c in cat_cols], dropLast=True,
                        handleInvalid="keep")
    return idx + [ohe]


def one_hot_wide(df: DataFrame, col: str, levels: list[str]) -> DataFrame:
    """Wide 0/1 form of F5 for a fitted level list (unknown -> all zeros)."""
    for lv in levels:
        df = df.withColumn(f"{col}_{lv}", F.coalesce((F.col(col) == F.lit(lv)).cast("int"), F.lit(0)))
    return df


# F8: drop near-empty, id-like and constant columns ------------------------------------

def basic_wrangling_report(df: DataFrame, cols: list[str], max_null: float = 0.95) -> DataFrame:
    """Null share and distinct count per column -> drop decision.

    Non-null counts come from one aggregation; distinct counts from the stacked
    (column, value) pairs de-duplicated map-side (no COUNT(DISTINCT) Expand).
    """
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(f"{c}__nn") for c in cols])
    stack = ", ".join(f"'{c}', CAST(`{c}__nn` AS BIGINT)" for c in cols)
    long = wide.select("_n", F.expr(f"stack({len(cols)}, {stack}) AS (column, non_null)"))
    pairs = ", ".join(f"'{c}', CAST({c} AS STRING)" for c in cols)
    nd = (df.select(F.expr(f"stack({len(cols)}, {pairs}) AS (column, v)"))
            .where(F.col("v").isNotNull()).distinct()
            .groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct")))
    long = long.join(nd, "column", "left").fillna(0, ["n_distinct"])
    null_share = 1 - F.col("non_null") / F.col("_n")
    return (long.withColumn("null_share", null_share)
                .withColumn("drop_reason",
                            F.when(null_share > max_null, F.lit("mostly_null"))
                             .when(F.col("n_distinct") <= 1, F.lit("constant"))
                             .when(F.col("n_distinct") == F.col("_n"), F.lit("id_like")))
                .withColumnRenamed("_n", "rows"))


# drop columns > col_threshold null and rows < row_threshold filled ----------------

def row_fill_share(cols: list[str]) -> Column:
    return sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0)) / len(cols)


def drop_missing(df: DataFrame, cols: list[str], row_threshold: float = 0.9, col_threshold: float = 0.5) -> DataFrame:
    """``df`` without the ``cols`` that are null in more than ``col_threshold`` of the rows, and then
    without the rows that have less than ``row_threshold`` of the remaining ``cols`` filled.

    Null shares come from one aggregate; rows are decided one by one. With no
    rows or no column left nothing more is dropped.
    """
    shares = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in cols]).first()
    kept = [c for c in cols if not shares["_n"] or 1 - shares[c] / shares["_n"] <= col_threshold]
    out = df.drop(*[c for c in cols if c not in kept])
    return out.where(row_fill_share(kept) >= row_threshold) if kept else out


# outlier clamp: Tukey fences if skewed else mean +/- 3 std ---------------------------

def fit_outlier_bounds(df: DataFrame, cols: list[str], skew_limit: float = 1.0) -> DataFrame:
    from civora.operators.aggregates import stacked_quantiles
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mu"), F.stddev_samp(c).alias(f"{c}__sd"),
                 # sample-adjusted skewness (pandas convention)
                 (F.skewness(c) * F.sqrt(F.count(c) * (F.count(c) - 1)) / (F.count(c) - 2))
                 .alias(f"{c}__sk")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__mu`, `{c}__sd`, `{c}__sk`" for c in cols)
    long = wide.select(F.expr(f"stack({len(cols)}, {stack}) AS (column, mu, sd, skew)")).join(
        stacked_quantiles(df, cols, [0.25, 0.75], ["q1", "q3"]), "column")
    iqr = F.col("q3") - F.col("q1")
    skewed = F.abs(F.col("skew")) > skew_limit
    return (long.withColumn("method", F.when(skewed, F.lit("tukey")).otherwise(F.lit("sigma3")))
                .withColumn("lower", F.when(skewed, F.col("q1") - 1.5 * iqr)
                            .otherwise(F.col("mu") - 3 * F.col("sd")))
                .withColumn("upper", F.when(skewed, F.col("q3") + 1.5 * iqr)
                            .otherwise(F.col("mu") + 3 * F.col("sd"))))


def clamp(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Values outside their column's bounds become the bound; nulls stay null."""
    return df.withColumns({c: F.when(F.col(c).isNotNull(), F.least(F.greatest(F.col(c), F.lit(lo)), F.lit(hi)))
                           for c, (lo, hi) in bounds.items()})


def replace_outliers(df: DataFrame, cols: list[str], skew_limit: float = 1.0) -> DataFrame:
    """F14 whole: bounds fitted on ``df`` (one row per column), then its values clamped."""
    fitted = fit_outlier_bounds(df, cols, skew_limit).collect()
    return clamp(df, {r["column"]: (r["lower"], r["upper"]) for r in fitted if r["lower"] is not None})


# F16: variance threshold -----------------------------------------------------------

def variance_report(df: DataFrame, cols: list[str], threshold: float = 0.01) -> DataFrame:
    wide = df.agg(*[F.var_pop(c).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = wide.select(F.expr(f"stack({len(cols)}, {stack}) AS (column, variance)"))
    return long.withColumn("keep", F.col("variance") > threshold)


# column sets by type ----------------------------------------------------------

def split_by_type(df: DataFrame, drop: list[str] = ()) -> dict[str, list[str]]:
    from pyspark.sql.types import BooleanType, NumericType, StringType
    out = {"numeric": [], "categorical": [], "boolean": [], "other": []}
    for f in df.schema.fields:
        if f.name in drop:
            continue
        t = f.dataType
        key = ("boolean" if isinstance(t, BooleanType) else "numeric" if isinstance(t, NumericType)
               else "categorical" if isinstance(t, StringType) else "other")
        out[key].append(f.name)
    return out


# skew correction candidates in one aggregation -----------------------------------

def skew_candidates(df: DataFrame, col: str) -> DataFrame:
    """Sample-adjusted skewness of the raw column and of cbrt / sqrt / log1p."""
    x = F.col(col).cast("double")
    forms = {"raw": x, "cbrt": F.cbrt(x), "sqrt": F.sqrt(F.when(x >= 0, x)),
             "log1p": F.log1p(F.when(x > -1, x))}
    aggs = [F.count(v).alias(f"{k}__n") for k, v in forms.items()] + \
           [F.skewness(v).alias(f"{k}__g1") for k, v in forms.items()]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{k}', `{k}__n`, `{k}__g1`" for k in forms)
    long = wide.select(F.expr(f"stack({len(forms)}, {stack}) AS (method, n, g1)"))
    adj = F.col("g1") * F.sqrt(F.col("n") * (F.col("n") - 1)) / (F.col("n") - 2)
    return long.withColumn("skew", adj).drop("g1")


# Yeo-Johnson lambda by profile log-likelihood over a grid (one aggregation) --------------

def _yj(x: Column, lam: float) -> Column:
    pos = x >= 0
    if abs(lam) < 1e-12:
        a = F.log1p(x)
    else:
        a = (F.pow(x + 1, F.lit(lam)) - 1) / lam
    if abs(lam - 2) < 1e-12:
        b = -F.log1p(-x)
    else:
        b = -(F.pow(1 - x, F.lit(2 - lam)) - 1) / (2 - lam)
    return F.when(pos, a).otherwise(b)


def yeo_johnson_lambda(df: DataFrame, col: str, grid=None) -> tuple[float, DataFrame]:
    """Pick lambda maximising the Yeo-Johnson log-likelihood.

    For every grid value the transformed mean / variance and the Jacobian term
    sum(sign(x) log(|x| + 1)) are computed in ONE aggregation over the data
    (the grid is small and fixed), then the best lambda is refined once on a
    finer grid around it.
    """
    grid = list(grid) if grid is not None else [i / 4 for i in range(-8, 9)]

    def table(lams):
        x = F.col(col).cast("double")
        aggs = [F.count(x).alias("n"), F.sum(F.signum(x) * F.log1p(F.abs(x))).alias("jac")]
        # columns of their own: an aggregate refers to its input several times, and would transform it each time
        forms = df.select(col, *[_yj(x, lam).alias(f"y{i}") for i, lam in enumerate(lams)])
        aggs += [F.var_pop(f"y{i}").alias(f"v{i}") for i in range(len(lams))]
        row = forms.agg(*aggs).first()
        import math
        out = []
        for i, lam in enumerate(lams):
            v = row[f"v{i}"]
            ll = (-row["n"] / 2 * math.log(v) + (lam - 1) * row["jac"]) if v and v > 0 else float("-inf")
            out.append((float(lam), float(ll)))
        return out

    coarse = table(grid)
    best = max(coarse, key=lambda t: t[1])[0]
    step = (grid[1] - grid[0]) if len(grid) > 1 else 0.25
    evaluated = list(coarse)
    for _ in range(2):                      # two refinements: step / 10, then step / 100
        fine = table([best + step * (k / 10) for k in range(-10, 11)])
        evaluated += fine
        best = max(fine, key=lambda t: t[1])[0]
        step /= 10
    spark = df.sparkSession
    return best, spark.createDataFrame(evaluated, "lambda double, loglik double")


def apply_yeo_johnson(df: DataFrame, col: str, lam: float, out: str | None = None) -> DataFrame:
    return df.withColumn(out or f"{col}_skewfix", _yj(F.col(col).cast("double"), lam))


# iterative imputation (chained linear regressions, checkpointed rounds) ----------------------

def iterative_impute(df: DataFrame, cols: list[str], rounds: int = 3) -> DataFrame:
    """Each round regresses every incomplete column on the others (MLlib
    LinearRegression, distributed) and refills its missing cells; the frame is
    checkpointed between rounds to cut the growing lineage."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from civora.operators.joins import materialize
    miss = {c: F.col(c).isNull() for c in cols}
    med = fit_numeric_stats(df, cols)
    cur = df
    for c in cols:
        cur = cur.withColumn(f"_{c}_missing", miss[c]).withColumn(
            c, F.coalesce(F.col(c).cast("double"), F.lit(med[c]["median"])))
    cur = materialize(cur)
    for _ in range(rounds):
        for c in cols:
            others = [o for o in cols if o != c]
            va = VectorAssembler(inputCols=others, outputCol="_x", handleInvalid="keep")
            train = va.transform(cur.where(~F.col(f"_{c}_missing")))
            model = LinearRegression(featuresCol="_x", labelCol=c, predictionCol="_pred").fit(train)
            pred = model.transform(va.transform(cur))
            cur = pred.withColumn(c, F.when(F.col(f"_{c}_missing"), F.col("_pred")).otherwise(F.col(c))) \
                      .drop("_x", "_pred")
        cur = materialize(cur)
    return cur.drop(*[f"_{c}_missing" for c in cols])
