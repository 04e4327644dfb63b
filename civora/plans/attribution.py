"""Attribution job: lagged panel, effects, statements, coverage.

* J4: allocations joined to site metrics at month m, m+3, m+6. The metrics
  side is shifted instead of the fact side, so all three joins use the fact
  key (site_id, alloc_month): the allocation rows are shuffled once.
* S1-S3 / S9: OLS of pct change on log amount + program dummies with site
  fixed effects absorbed by within-site demeaning (k stays small however
  many sites exist); moments in Spark, k x k algebra on the driver.
* J9: statement expansion = allocations joined to the (small, size-checked)
  effects table; skip counters come from one aggregate, not a loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civora.functions import constants as K
from civora.functions.columns import month_start, pct_change, round_half_up, sql_r
from civora.operators.joins import bounded_broadcast, staged
from civora.sources.standins import duck_cte, standin

OUTCOMES = {"education": "edu", "health": "health"}
WINDOWS = {"3m": 3, "6m": 6}
PCT_CHANGES = [f"{a}_pct_change_{w}" for a in OUTCOMES.values() for w in WINDOWS]
VALUE_COLS = {"edu": "avg_education_progress", "health": "avg_health_score",
              "sessions": "process_recording_count", "incidents": "incident_count"}


def allocation_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 + P14 + P25 + P26: one row per allocation with baseline / 3m / 6m outcomes."""
    from civora.operators.temporal import lagged_panel
    alloc = (standin(spark, sf_dir, "allocations").where(F.col("amount_allocated") > 0)
             .withColumn("alloc_month", month_start("allocation_date")))
    metrics = standin(spark, sf_dir, "site_monthly_metrics")
    df = lagged_panel(alloc, metrics, "site_id", "alloc_month", "month_start", VALUE_COLS,
                      {"baseline": 0, "3m": 3, "6m": 6})
    df = df.withColumn("log_amount", F.log1p("amount_allocated"))
    for o in ("edu", "health"):
        for w in WINDOWS:
            df = df.withColumn(f"{o}_pct_change_{w}", pct_change(f"{o}_{w}", f"{o}_baseline"))
            df = df.withColumn(f"{o}_delta_{w}", F.col(f"{o}_{w}") - F.col(f"{o}_baseline"))
    return df


def q_lagged_panel_join(spark, sf_dir):
    df = allocation_outcomes(spark, sf_dir)
    r = lambda c: round_half_up(c, 6).alias(c)
    return df.select("donation_id", "allocation_line", "supporter_id", "site_id", "program_area",
                     "amount_allocated", "alloc_month", "edu_baseline", "edu_3m", "edu_6m",
                     r("health_baseline"), r("health_3m"), "sessions_baseline", "incidents_6m",
                     r("edu_pct_change_3m"), r("health_pct_change_3m"), r("edu_pct_change_6m"),
                     r("health_pct_change_6m"), r("edu_delta_3m"))


LAGGED_PANEL_SQL = duck_cte("allocations", "site_monthly_metrics") + f"""
, am AS (SELECT *, CAST(date_trunc('month', allocation_date) AS DATE) AS alloc_month
         FROM allocations WHERE amount_allocated > 0)
, j AS (
  SELECT am.*, b.avg_education_progress AS edu_baseline, b.avg_health_score AS health_baseline,
         b.process_recording_count AS sessions_baseline,
         m3.avg_education_progress AS edu_3m, m3.avg_health_score AS health_3m,
         m6.avg_education_progress AS edu_6m, m6.avg_health_score AS health_6m,
         m6.incident_count AS incidents_6m
  FROM am
  LEFT JOIN site_monthly_metrics b ON am.site_id = b.site_id AND am.alloc_month = b.month_start
  LEFT JOIN site_monthly_metrics m3 ON am.site_id = m3.site_id
       AND CAST(am.alloc_month + INTERVAL 3 MONTH AS DATE) = m3.month_start
  LEFT JOIN site_monthly_metrics m6 ON am.site_id = m6.site_id
       AND CAST(am.alloc_month + INTERVAL 6 MONTH AS DATE) = m6.month_start
)
SELECT donation_id, allocation_line, supporter_id, site_id, program_area, amount_allocated,
       alloc_month, edu_baseline, edu_3m, edu_6m, {sql_r('health_baseline')} AS health_baseline,
       {sql_r('health_3m')} AS health_3m, sessions_baseline, incidents_6m,
       {sql_r('(edu_3m - edu_baseline) / NULLIF(edu_baseline, 0) * 100')} AS edu_pct_change_3m,
       {sql_r('(health_3m - health_baseline) / NULLIF(health_baseline, 0) * 100')} AS health_pct_change_3m,
       {sql_r('(edu_6m - edu_baseline) / NULLIF(edu_baseline, 0) * 100')} AS edu_pct_change_6m,
       {sql_r('(health_6m - health_baseline) / NULLIF(health_baseline, 0) * 100')} AS health_pct_change_6m,
       {sql_r('edu_3m - edu_baseline')} AS edu_delta_3m
FROM j
"""


# ---------------------------------------------------------------------------
# Effects: per-area slope (SQL-checkable) and full OLS with fixed effects
# ---------------------------------------------------------------------------

def _long_outcomes(df: DataFrame) -> DataFrame:
    """(allocation row) x (outcome, window) in long form, null labels dropped."""
    parts = [f"'{o}', '{w}', {WINDOWS[w]}, {a}_pct_change_{w}"
             for o, a in OUTCOMES.items() for w in WINDOWS]
    long = df.select("program_area", "log_amount", "site_id", F.expr(
        f"stack({len(parts)}, {', '.join(parts)}) AS (outcome, win, window_months, y)"))
    return long.where(F.col("y").isNotNull())


def area_slope_effects(df: DataFrame, z: float = 1.96) -> DataFrame:
    """Per (program area, outcome, window): slope of pct change on log amount.

    One aggregate over all eight (outcome, window) label columns at once
    (stacked long), using regr_* sums, so the test is exact in SQL.
    """
    long = _long_outcomes(df)
    g = long.groupBy("program_area", "outcome", "window_months").agg(
        F.regr_count("y", "log_amount").alias("n"), F.regr_slope("y", "log_amount").alias("coef"),
        F.regr_sxx("y", "log_amount").alias("sxx"), F.regr_syy("y", "log_amount").alias("syy"),
        F.regr_sxy("y", "log_amount").alias("sxy"))
    se = F.sqrt(F.try_divide((F.col("syy") - F.col("coef") * F.col("sxy")) / (F.col("n") - 2),
                             F.col("sxx")))
    return (g.where(F.col("n") > 2).withColumn("se", se)
             .withColumn("ci_low", F.col("coef") - z * F.col("se"))
             .withColumn("ci_high", F.col("coef") + z * F.col("se"))
             .withColumn("significant", F.abs(F.col("coef")) > z * F.col("se")))


def q_area_effects(spark, sf_dir):
    e = area_slope_effects(allocation_outcomes(spark, sf_dir))
    r = lambda c: round_half_up(c, 4).alias(c)
    return e.select("program_area", "outcome", "window_months", "n", r("coef"), r("se"),
                    r("ci_low"), r("ci_high"), "significant")


_EFFECT_CTE = LAGGED_PANEL_SQL.split("\nSELECT donation_id")[0] + """
, lg AS (
  SELECT program_area, site_id, ln(1 + amount_allocated) AS x, o.outcome, o.window_months, o.y
  FROM j, LATERAL (VALUES
     ('education', 3, (edu_3m - edu_baseline) / NULLIF(edu_baseline, 0) * 100),
     ('education', 6, (edu_6m - edu_baseline) / NULLIF(edu_baseline, 0) * 100),
     ('health', 3, (health_3m - health_baseline) / NULLIF(health_baseline, 0) * 100),
     ('health', 6, (health_6m - health_baseline) / NULLIF(health_baseline, 0) * 100))
     AS o(outcome, window_months, y)
  WHERE o.y IS NOT NULL
)
, ef AS (
  SELECT program_area, outcome, window_months, regr_count(y, x) AS n, regr_slope(y, x) AS coef,
         sqrt((regr_syy(y, x) - regr_slope(y, x) * regr_sxy(y, x)) / (regr_count(y, x) - 2)
              / regr_sxx(y, x)) AS se
  FROM lg GROUP BY ALL HAVING regr_count(y, x) > 2
)
"""

AREA_EFFECTS_SQL = _EFFECT_CTE + f"""
SELECT program_area, outcome, CAST(window_months AS INTEGER) AS window_months, n,
       {sql_r('coef', 4)} AS coef, {sql_r('se', 4)} AS se,
       {sql_r('coef - 1.96 * se', 4)} AS ci_low, {sql_r('coef + 1.96 * se', 4)} AS ci_high,
       abs(coef) > 1.96 * se AS significant
FROM ef
"""


def effect_inputs(spark, sf_dir) -> DataFrame:
    """What the regressions need of the allocation outcomes, computed once."""
    return staged(allocation_outcomes(spark, sf_dir).select("site_id", "program_area", "log_amount", *PCT_CHANGES))


def ols_effects(spark: SparkSession, sf_dir: str, p_threshold: float = 0.05,
                rare_cutoff: float = K.RARE_CUTOFF) -> DataFrame:
    """S1-S3 + F1 + F6 + S9: OLS per (outcome, window) with site fixed effects.

    Returns the coefficient table of the program-area dummies, one row per
    (outcome, window, area), with p-values and whether it passes ``p_threshold``.
    """
    from civora.operators.prep import dummy_columns, fit_rare_levels, apply_rare_levels
    from civora.operators.stats import ols
    df = effect_inputs(spark, sf_dir)
    levels = fit_rare_levels(df, "program_area", rare_cutoff)
    df = apply_rare_levels(df, "program_area", levels)
    df, dummies = dummy_columns(df, "program_area", drop_first=True)
    rows = []
    for o, a in OUTCOMES.items():
        for w, wm in WINDOWS.items():
            y = f"{a}_pct_change_{w}"
            fit = ols(df.where(F.col(y).isNotNull()), y, ["log_amount", *dummies], absorb="site_id")
            for c in fit["coefs"]:
                if c["term"].startswith("program_area_"):
                    rows.append((c["term"][len("program_area_"):], o, wm, float(c["coef"]),
                                 float(c["se"]), float(c["p"]), float(c["ci_low"]),
                                 float(c["ci_high"]), bool(c["p"] < p_threshold), float(fit["r2"]),
                                 fit["cov_type"], int(fit["n"])))
    schema = ("program_area string, outcome string, window_months int, coef double, se double, "
              "p double, ci_low double, ci_high double, significant boolean, r2 double, "
              "cov_type string, n long")
    return spark.createDataFrame(rows, schema)


# ---------------------------------------------------------------------------
# J9 + P32 + A23: statements from significant effects
# ---------------------------------------------------------------------------

def impact_statements(alloc: DataFrame, effects: DataFrame, sites: DataFrame) -> DataFrame:
    """Allocation x matching significant effect -> statement row.

    ``effects`` holds at most (areas x outcomes x windows) rows and is
    broadcast behind a size check, and so is ``sites``, a per-site lookup.
    """
    eff = bounded_broadcast(effects.where("significant").select(
        "program_area", "outcome", "window_months", "coef", "ci_low", "ci_high"), 100_000)
    base_col = F.when(F.col("outcome") == "education", F.col("edu_baseline")) \
                .otherwise(F.col("health_baseline"))
    j = (alloc.join(eff, "program_area").where(base_col.isNotNull())
              .join(bounded_broadcast(sites.select("site_id", F.col("name").alias("site_name"))), "site_id", "left"))
    la = F.log1p("amount_allocated")
    est = F.col("coef") * la
    lo = F.least(F.abs(F.col("ci_low") * la), F.abs(F.col("ci_high") * la))
    hi = F.greatest(F.abs(F.col("ci_low") * la), F.abs(F.col("ci_high") * la))
    label = F.when(F.col("outcome") == "education", F.lit(K.OUTCOME_LABELS["education"])) \
             .otherwise(F.lit(K.OUTCOME_LABELS["health"]))
    direction = F.when(est >= 0, F.lit(K.DIRECTION_WORDS[True])).otherwise(F.lit(K.DIRECTION_WORDS[False]))
    text = F.concat(
        F.lit("Your $"), F.format_number(round_half_up("amount_allocated", 0), 0),
        F.lit(" allocated to "), F.col("program_area"), F.lit(" at "),
        F.coalesce(F.col("site_name"), F.col("site_id").cast("string")),
        F.lit(" was associated with a "), F.format_string("%.1f", round_half_up(F.abs(est), 1)),
        F.lit("% "), direction, F.lit(" "), label, F.lit(" over the following "),
        F.col("window_months").cast("string"), F.lit(" months (estimated range: "),
        F.format_string("%.1f", round_half_up(lo, 1)), F.lit("%–"),
        F.format_string("%.1f", round_half_up(hi, 1)), F.lit("%)."))
    return j.select("supporter_id", "site_id", "program_area", "amount_allocated", "outcome",
                    "window_months", round_half_up("coef", 4).alias("estimated_pct_change"),
                    round_half_up(est, 4).alias("estimated_effect"),
                    text.alias("statement_text"))


def statement_outcomes(spark, sf_dir) -> DataFrame:
    """What effects and statements need of the allocation outcomes, computed once."""
    return staged(allocation_outcomes(spark, sf_dir).select(
        "supporter_id", "site_id", "program_area", "amount_allocated", "log_amount", "edu_baseline",
        "health_baseline", *PCT_CHANGES))


def q_impact_statements(spark, sf_dir):
    return outcome_statements(statement_outcomes(spark, sf_dir), standin(spark, sf_dir, "sites"))


def outcome_statements(alloc: DataFrame, sites: DataFrame) -> DataFrame:
    """Statements of ``alloc`` from its own significant effects, rounded to 2 decimals."""
    eff = area_slope_effects(alloc).withColumn("coef", round_half_up("coef", 2)) \
        .withColumn("ci_low", round_half_up("ci_low", 2)).withColumn("ci_high", round_half_up("ci_high", 2))
    return impact_statements(alloc, eff, sites)


IMPACT_STATEMENTS_SQL = duck_cte("sites") + "," + _EFFECT_CTE.split("WITH ", 1)[1] + f"""
, sig AS (SELECT program_area, outcome, window_months, {sql_r('coef', 2)} AS coef,
                 {sql_r('coef - 1.96 * se', 2)} AS ci_low, {sql_r('coef + 1.96 * se', 2)} AS ci_high
          FROM ef WHERE abs(coef) > 1.96 * se)
, x AS (
  SELECT j.supporter_id, j.site_id, j.program_area, j.amount_allocated, sig.outcome,
         sig.window_months, sig.coef, sig.ci_low, sig.ci_high, s.name AS site_name,
         ln(1 + j.amount_allocated) AS la
  FROM j JOIN sig ON j.program_area = sig.program_area
  LEFT JOIN sites s ON s.site_id = j.site_id
  WHERE (CASE WHEN sig.outcome = 'education' THEN j.edu_baseline ELSE j.health_baseline END) IS NOT NULL
)
SELECT supporter_id, site_id, program_area, amount_allocated, outcome,
       CAST(window_months AS INTEGER) AS window_months,
       {sql_r('coef', 4)} AS estimated_pct_change, {sql_r('coef * la', 4)} AS estimated_effect,
       'Your $' || format('{{:,.0f}}', floor(amount_allocated + 0.5)) || ' allocated to ' || program_area
       || ' at ' || COALESCE(site_name, CAST(site_id AS VARCHAR)) || ' was associated with a '
       || printf('%.1f', {sql_r('abs(coef * la)', 1)}) || '% '
       || CASE WHEN coef * la >= 0 THEN 'improvement in' ELSE 'decline in' END || ' '
       || CASE WHEN outcome = 'education' THEN 'average education progress'
               ELSE 'average health and wellbeing scores' END
       || ' over the following ' || CAST(window_months AS VARCHAR) || ' months (estimated range: '
       || printf('%.1f', {sql_r('least(abs(ci_low * la), abs(ci_high * la))', 1)}) || '%–'
       || printf('%.1f', {sql_r('greatest(abs(ci_low * la), abs(ci_high * la))', 1)}) || '%).'
         AS statement_text
FROM x
"""


def statement_coverage(statements: DataFrame, alloc: DataFrame,
                       threshold: float = K.STATEMENT_COVERAGE_MIN) -> DataFrame:
    """Share of supporters with at least one statement, with an alert flag."""
    have = statements.select("supporter_id").distinct().count()
    total = alloc.select("supporter_id").distinct().count()
    cov = have / total if total else 0.0
    return alloc.sparkSession.createDataFrame(
        [(have, total, cov, cov < threshold)],
        "with_statement long, supporters long, coverage double, below_target boolean")
