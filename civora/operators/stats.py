"""Statistics.

Pattern: Spark reduces the data to small moment tables in one or two
aggregation passes (sums of products, group moments, contingency counts);
only those k x k / per-group tables reach the driver, where numpy turns them
into coefficients, statistics and p-values. scipy / statsmodels are not
available, so the t, F, chi-square and normal CDFs are implemented below
(regularised incomplete beta / gamma).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Distribution functions
# ---------------------------------------------------------------------------


def _betacf(a, b, x, itmax=300, eps=3e-16):
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, itmax + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < eps:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1 - x) / b


def gammainc(a: float, x: float) -> float:
    """Regularised lower incomplete gamma P(a, x)."""
    if x <= 0:
        return 0.0
    if x < a + 1:
        s, term, n = 1.0 / a, 1.0 / a, a
        for _ in range(500):
            n += 1
            term *= x / n
            s += term
            if abs(term) < abs(s) * 1e-16:
                break
        return s * math.exp(-x + a * math.log(x) - math.lgamma(a))
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 500):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1) < 1e-16:
            break
    return 1.0 - math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def t_sf2(t: float, df: float) -> float:
    """Two-sided p-value of a t statistic."""
    if df <= 0 or not math.isfinite(t):
        return float("nan") if not math.isfinite(t) else 1.0
    return betainc(df / 2, 0.5, df / (df + t * t))


def t_ppf(q: float, df: float) -> float:
    """Quantile of Student's t (bisection on the CDF)."""
    lo, hi = 0.0, 1e3
    target = 2 * (1 - q)
    for _ in range(200):
        mid = (lo + hi) / 2
        if t_sf2(mid, df) > target:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2


def chi2_sf(x: float, k: float) -> float:
    return 1.0 - gammainc(k / 2, x / 2) if x > 0 else 1.0


def f_sf(f: float, d1: float, d2: float) -> float:
    if f <= 0:
        return 1.0
    return betainc(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


def norm_sf2(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


# ---------------------------------------------------------------------------
# OLS from one aggregation pass (+ one for HC3 / BP)
# ---------------------------------------------------------------------------


def _batch_sums(df: DataFrame, cols: list[str], size: int, sums) -> np.ndarray:
    """Sum over all rows of ``sums(x)``, ``size`` numbers from a batch's matrix x (rows by ``cols``).

    Each task adds up its Arrow batches and gives one vector; Spark adds the vectors.
    """
    import pyarrow as pa

    def run(batches):
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += sums(np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns]))
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["s"])

    parts = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]) \
        .mapInArrow(run, "s array<double>").select(F.posexplode("s").alias("at", "v"))
    out = np.zeros(size)
    for r in parts.groupBy("at").agg(F.sum("v").alias("v")).collect():      # ``size`` rows
        out[r["at"]] = r["v"]
    return out


def _moments(df: DataFrame, cols: list[str]) -> tuple[int, np.ndarray]:
    """Number of rows and the matrix of the sums of products of ``cols``, which hold no nulls."""
    k = len(cols)
    v = _batch_sums(df, cols, k * k + 1, lambda x: np.append((x.T @ x).ravel(), len(x)))
    return int(round(v[-1])), v[:-1].reshape(k, k)


def demean_within(df: DataFrame, group: str, cols: list[str]) -> DataFrame:
    """Frisch-Waugh-Lovell: subtract group means (absorbs group fixed effects).

    Group means are a per-group table (one row per site), computed once and
    joined back by key; it is broadcast behind a row-count check, otherwise it
    is a shuffle join on the group key.
    """
    from civora.operators.joins import bounded_broadcast
    means = df.groupBy(group).agg(*[F.avg(c).alias(f"_mu_{c}") for c in cols],
                                  F.count(F.lit(1)).alias("_g_n"))
    out = df.join(bounded_broadcast(means), group)
    for c in cols:
        out = out.withColumn(c, F.col(c) - F.col(f"_mu_{c}"))
    return out.drop(*[f"_mu_{c}" for c in cols])


def ols(df: DataFrame, y: str, xs: list[str], absorb: str | None = None,
        intercept: bool = True, robust: str = "auto", alpha: float = 0.05) -> dict:
    """OLS with classical or HC3 covariance, Breusch-Pagan, Durbin-Watson-free summary.

    Returns a dict with a coefficient table (list of dicts) and fit statistics.
    With ``absorb``, leverage, R^2, Breusch-Pagan and VIF are those of the design
    with one dummy per group; ``cond_no`` is that of the demeaned columns.
    ``robust='auto'`` switches to HC3 when the Breusch-Pagan p-value < .05
    (the reference's rule); 'hc3' / 'classical' force one.
    """
    data = df.select(y, *xs, *([absorb] if absorb else [])).dropna()
    # spread of the raw columns: total sum of squares and variance inflation use it
    spread = data.agg(*[F.var_pop(c).alias(f"v_{i}") for i, c in enumerate([y, *xs])]).first()
    if absorb:
        data = demean_within(data, absorb, [y, *xs])
        intercept = False
    names = (["const"] if intercept else []) + list(xs)
    if intercept:
        data = data.withColumn("const", F.lit(1.0))
    cols = names + [y]
    n, M = _moments(data, cols)
    k = len(names)
    XtX, Xty, yty = M[:k, :k], M[:k, k], M[k, k]
    keep = np.diag(XtX) > 1e-12          # drop all-zero columns (absent dummy levels)
    idx = np.where(keep)[0]
    XtXr = XtX[np.ix_(idx, idx)]
    inv = np.linalg.pinv(XtXr)
    beta = inv @ Xty[idx]
    sse = float(yty - 2 * beta @ Xty[idx] + beta @ XtXr @ beta)
    # second pass: residuals, leverage -> HC3 meat and Breusch-Pagan auxiliary sums
    bc = {names[i]: float(b) for i, b in zip(idx, beta)}
    resid = F.col(y) - sum((F.col(c) * F.lit(b) for c, b in bc.items()), F.lit(0.0))
    m, used = len(idx), [names[i] for i in idx]

    def second(x):
        x, e, h = x[:, :m], x[:, m], x[:, m + 1]
        e2 = e ** 2
        lev = ((x @ inv) * x).sum(1) + h
        w = e2 / (1 - np.minimum(lev, 0.999999)) ** 2
        return np.concatenate([[e2.sum(), (e2 ** 2).sum()], x.T @ e2, (x.T @ (x * w[:, None])).ravel()])

    d2 = data.withColumn("_e", resid).withColumn("_h", 1 / F.col("_g_n") if absorb else F.lit(0.0))
    v = _batch_sums(d2, [*used, "_e", "_h"], 2 + m + m * m, second)
    se2, se4, xe, meat = v[0], v[1], v[2:2 + m], v[2 + m:].reshape(m, m)
    if absorb:  # per-site sums first: the site dummies explain what lies between the sites
        parts = d2.groupBy(absorb).agg(F.sum(F.col("_e") ** 2).alias("se2"), F.count(F.lit(1)).alias("_size"))
        sites = parts.agg(F.count(F.lit(1)).alias("groups"),
                          F.sum(F.col("se2") ** 2 / F.col("_size")).alias("between")).first()
    n_groups = sites["groups"] if absorb else 0
    dof = n - len(idx) - n_groups
    sigma2 = sse / dof if dof > 0 else float("nan")
    sst = n * (spread["v_0"] or 0.0) if intercept or absorb else yty
    r2 = 1 - sse / sst if sst else float("nan")
    p_eff = len(idx) - (1 if intercept else 0) + max(n_groups - 1, 0)
    adj = 1 - (1 - r2) * (n - 1) / (n - p_eff - 1) if n - p_eff - 1 > 0 else float("nan")
    # Breusch-Pagan: regress e^2 on X and the site dummies, LM = n R^2_aux
    g = inv @ xe
    ss_tot_aux = se4 - se2 ** 2 / n
    ss_res_aux = se4 - (sites["between"] if absorb else 0.0) - g @ xe
    bp_lm = n * (1 - ss_res_aux / ss_tot_aux) if ss_tot_aux > 0 else float("nan")
    bp_df = p_eff
    bp_p = chi2_sf(bp_lm, bp_df) if bp_df > 0 and math.isfinite(bp_lm) else float("nan")
    use_hc3 = robust == "hc3" or (robust == "auto" and math.isfinite(bp_p) and bp_p < 0.05)
    cov = inv @ meat @ inv if use_hc3 else sigma2 * inv
    tcrit = t_ppf(1 - alpha / 2, dof) if dof > 0 else float("nan")
    rows = []
    for ia, a in enumerate(idx):
        se = math.sqrt(max(cov[ia, ia], 0.0))
        t = beta[ia] / se if se > 0 else float("nan")
        rows.append({"term": names[a], "coef": float(beta[ia]), "se": se, "t": t,
                     "p": t_sf2(t, dof) if math.isfinite(t) else float("nan"),
                     "ci_low": float(beta[ia] - tcrit * se), "ci_high": float(beta[ia] + tcrit * se)})
    eig = np.linalg.eigvalsh(XtXr)
    return {"coefs": rows, "n": n, "dof": dof, "r2": r2, "adj_r2": adj, "sse": sse,
            "mae_rmse": None, "bp_lm": bp_lm, "bp_p": bp_p, "cov_type": "HC3" if use_hc3 else "nonrobust",
            "vif": {names[a]: float(n * (spread[f"v_{1 + list(xs).index(names[a])}"] or 0.0) * inv[ia, ia])
                    for ia, a in enumerate(idx) if names[a] != "const"},
            "cond_no": float(math.sqrt(eig.max() / eig.min())) if eig.min() > 0 else float("inf"),
            "cohens_f2": r2 / (1 - r2) if r2 < 1 else float("inf")}


def vif(df: DataFrame, xs: list[str]) -> dict[str, float]:
    """VIF_j = diag of the inverse correlation matrix (one aggregation)."""
    aggs = [F.corr(a, b).alias(f"{i}_{j}") for i, a in enumerate(xs) for j, b in enumerate(xs) if j > i]
    row = df.agg(*aggs).first()
    R = np.eye(len(xs))
    for i in range(len(xs)):
        for j in range(i + 1, len(xs)):
            R[i, j] = R[j, i] = row[f"{i}_{j}"] or 0.0
    inv = np.linalg.pinv(R)
    return {x: float(inv[i, i]) for i, x in enumerate(xs)}


def normaltest(skew_g1: float, kurt_g2: float, n: int) -> tuple[float, float]:
    """D'Agostino-Pearson K^2 from population skewness / excess kurtosis."""
    b2 = kurt_g2 + 3
    y = skew_g1 * math.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta2 = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1 + math.sqrt(2 * (beta2 - 1))
    delta = 1 / math.sqrt(0.5 * math.log(w2))
    alpha = math.sqrt(2.0 / (w2 - 1))
    y = y if y != 0 else 1e-300
    z1 = delta * math.log(y / alpha + math.sqrt((y / alpha) ** 2 + 1))
    e = 3.0 * (n - 1) / (n + 1)
    varb2 = 24.0 * n * (n - 2) * (n - 3) / ((n + 1.0) ** 2 * (n + 3) * (n + 5))
    x = (b2 - e) / math.sqrt(varb2)
    sqrtbeta1 = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * math.sqrt(
        (6.0 * (n + 3) * (n + 5)) / (n * (n - 2) * (n - 3)))
    a = 6.0 + 8.0 / sqrtbeta1 * (2.0 / sqrtbeta1 + math.sqrt(1 + 4.0 / sqrtbeta1 ** 2))
    term1 = 1 - 2 / (9.0 * a)
    denom = 1 + x * math.sqrt(2 / (a - 4.0))
    term2 = np.sign(denom) * ((1 - 2.0 / a) / abs(denom)) ** (1 / 3.0) if denom != 0 else float("nan")
    z2 = (term1 - term2) / math.sqrt(2 / (9.0 * a))
    k2 = z1 * z1 + z2 * z2
    return k2, chi2_sf(k2, 2)


def durbin_watson_from_sums(sum_diff_sq: float, sum_sq: float) -> float:
    """sum((e_t - e_{t-1})^2) / sum(e_t^2)."""
    return sum_diff_sq / sum_sq if sum_sq else float("nan")


def cohens_f2_label(f2: float) -> str:
    """S8 size label (0.02 small, 0.15 medium, 0.35 large)."""
    return "large" if f2 >= 0.35 else "medium" if f2 >= 0.15 else "small" if f2 >= 0.02 else "negligible"
