"""Profiling and bivariate statistics.

Every profile is one aggregation over all requested columns, reshaped with
``stack``; statistics are closed forms over group moments / contingency
counts (tiny tables), with p-values computed on the driver from those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civora.functions.columns import round_half_up, sql_r
from civora.operators.prep import apply_rare_levels, fit_rare_levels
from civora.operators.stats import chi2_sf, f_sf, t_sf2
from civora.plans.content import _CLEAN, clean_posts
from civora.sources.standins import duck_cte, standin

PROFILE_COLS = ["donation_referrals", "num_hashtags", "caption_length", "post_hour"]


def univariate_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, nulls, unique, min, q1, median, q3, max, mean, std, skew, kurt per column.

    Moments in one aggregation; exact quartiles and distinct counts from the
    stacked (column, value) pairs (``stacked_quantiles``; distinct values
    de-duplicated map-side), never one task per column. Skewness / kurtosis are
    sample-adjusted (pandas convention) from Spark's population moments:
    G1 = g1 sqrt(n(n-1))/(n-2), G2 = (n-1)/((n-2)(n-3))((n+1)g2+6).
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.skewness(x).alias(f"{c}__g1"),
                 F.kurtosis(x).alias(f"{c}__g2")]
    wide = df.agg(*aggs)
    fields = ["n", "min", "max", "mean", "std", "g1", "g2"]
    stack = ", ".join(f"'{c}', " + ", ".join(f"CAST(`{c}__{f}` AS DOUBLE)" for f in fields)
                      for c in cols)
    long = wide.select("_rows", F.expr(
        f"stack({len(cols)}, {stack}) AS (column, {', '.join(fields)})"))
    from civora.operators.aggregates import stacked_quantiles
    long = long.join(stacked_quantiles(df, cols, [0.25, 0.5, 0.75], ["_q1", "_q2", "_q3"]), "column", "left")
    pairs = ", ".join(f"'{c}', CAST({c} AS DOUBLE)" for c in cols)
    uniq = (df.select(F.expr(f"stack({len(cols)}, {pairs}) AS (column, v)"))
              .where(F.col("v").isNotNull()).distinct()
              .groupBy("column").agg(F.count(F.lit(1)).alias("unique")))
    n = F.col("n")
    g1 = F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2)
    g2 = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6)
    r = lambda e, a: round_half_up(e, 6).alias(a)
    return long.join(uniq, "column", "left").select(
        "column", n.cast("bigint").alias("count"),
        (F.col("_rows") - n).cast("bigint").alias("nulls"),
        F.coalesce(F.col("unique"), F.lit(0)).cast("bigint").alias("unique"), "min",
        F.col("_q1").alias("q1"), F.col("_q2").alias("median"), F.col("_q3").alias("q3"), "max",
        r(F.col("mean"), "mean"), r(F.col("std"), "std"), r(g1, "skew"), r(g2, "kurt"))


def q_univariate_profile(spark, sf_dir):
    return univariate_profile(clean_posts(standin(spark, sf_dir, "posts")), PROFILE_COLS)


UNIVARIATE_SQL = _CLEAN + "\n" + "UNION ALL\n".join(
    f"""SELECT '{c}' AS column, count({c}) AS count, count(*) - count({c}) AS nulls,
       count(DISTINCT {c}) AS unique, CAST(min({c}) AS DOUBLE) AS min,
       quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
       quantile_cont({c}, 0.75) AS q3, CAST(max({c}) AS DOUBLE) AS max,
       {sql_r(f'avg({c})')} AS mean, {sql_r(f'stddev_samp({c})')} AS std,
       {sql_r(f'skewness({c})')} AS skew, {sql_r(f'kurtosis({c})')} AS kurt FROM p
""" for c in PROFILE_COLS)


# F1 on the case categories (two levels fall under the 5 % share)
def q_rare_collapse(spark, sf_dir):
    cases = standin(spark, sf_dir, "cases")
    levels = fit_rare_levels(cases, "case_category")
    out = apply_rare_levels(cases.select("case_id", "case_category"), "case_category", levels)
    return out.withColumnRenamed("case_category", "case_category_binned")


RARE_COLLAPSE_SQL = duck_cte("cases") + """
, s AS (SELECT case_category, count(*) / sum(count(*)) OVER () AS share FROM cases
        WHERE case_category IS NOT NULL GROUP BY case_category)
SELECT c.case_id, CASE WHEN s.share < 0.05 THEN 'Other' ELSE c.case_category END AS case_category_binned
FROM cases c LEFT JOIN s ON c.case_category = s.case_category
"""


# A18 value counts + A27 group describe
def q_value_counts(spark, sf_dir):
    from civora.operators.aggregates import value_counts
    v = value_counts(clean_posts(standin(spark, sf_dir, "posts")), "post_type", ["platform"])
    return v.select("platform", "post_type", "n", round_half_up("share", 9).alias("share"))


VALUE_COUNTS_SQL = _CLEAN + f"""
SELECT platform, post_type, n, {sql_r('n / sum(n) OVER (PARTITION BY platform)', 9)} AS share
FROM (SELECT platform, post_type, count(*) AS n FROM p GROUP BY ALL)
"""


def q_group_describe(spark, sf_dir):
    from civora.operators.aggregates import group_describe
    g = group_describe(clean_posts(standin(spark, sf_dir, "posts")), ["platform"], "donation_referrals")
    return g.select("platform", "count", round_half_up("mean", 6).alias("mean"),
                    round_half_up("std", 6).alias("std"), "min", "q25", "q50", "q75", "max")


GROUP_DESCRIBE_SQL = _CLEAN + f"""
SELECT platform, count(donation_referrals) AS count, {sql_r('avg(donation_referrals)')} AS mean,
       {sql_r('stddev_samp(donation_referrals)')} AS std, min(donation_referrals) AS min,
       quantile_cont(donation_referrals, 0.25) AS q25, quantile_cont(donation_referrals, 0.5) AS q50,
       quantile_cont(donation_referrals, 0.75) AS q75, max(donation_referrals) AS max
FROM p GROUP BY platform
"""


# S11 / S14 / S16 (statistics; p-values are added by ``bivariate``)
def bivariate_stats(df: DataFrame, label: str, numeric: list[str], categorical: list[str],
                    pairs: list[tuple[str, str]]) -> DataFrame:
    spark = df.sparkSession
    n_all = F.count(F.lit(1))
    outs = []
    if numeric:
        row = df.agg(*[F.corr(label, c).alias(c) for c in numeric], n_all.alias("_n"))
        stack = ", ".join(f"'{c}', `{c}`" for c in numeric)
        outs.append(row.select(F.expr(f"stack({len(numeric)}, {stack}) AS (feature, statistic)"),
                               F.col("_n").cast("double").alias("df2"))
                    .select(F.lit("pearson").alias("test"), "feature", "statistic",
                            F.lit(None).cast("double").alias("df1"), (F.col("df2") - 2).alias("df2"),
                            F.abs("statistic").alias("effect")))
    for c in categorical:   # S14 one-way ANOVA from group moments
        g = df.groupBy(c).agg(F.count(label).alias("n"), F.avg(label).alias("m"),
                              F.var_pop(label).alias("v"))
        tot = df.agg(F.count(label).alias("_tn"), F.avg(label).alias("_tm"))
        from civora.operators.joins import with_scalars
        s = with_scalars(g, tot).agg(
            F.sum(F.col("n") * (F.col("m") - F.col("_tm")) ** 2).alias("ssb"),
            F.sum(F.col("n") * F.col("v")).alias("ssw"), F.count(F.lit(1)).alias("k"),
            F.first("_tn").alias("N"))
        eta2 = F.col("ssb") / (F.col("ssb") + F.col("ssw"))
        outs.append(s.select(F.lit("anova").alias("test"), F.lit(c).alias("feature"),
                             ((F.col("ssb") / (F.col("k") - 1)) / (F.col("ssw") / (F.col("N") - F.col("k"))))
                             .alias("statistic"), (F.col("k") - 1).cast("double").alias("df1"),
                             (F.col("N") - F.col("k")).cast("double").alias("df2"),
                             F.sqrt(eta2 / (1 - eta2)).alias("effect")))
    for a, b in pairs:      # S16 chi-square + Cramer's V from the contingency table
        ct = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("o"))
        ra = ct.groupBy(a).agg(F.sum("o").alias("ra"))
        cb = ct.groupBy(b).agg(F.sum("o").alias("cb"))
        from civora.operators.joins import with_scalars
        # sum (O - E)^2 / E = sum O^2 / E - N: empty cells add nothing, so only
        # observed cells are needed (no dense level x level grid)
        cells = with_scalars(ct.join(ra, a).join(cb, b),
                             ct.agg(F.sum("o").alias("N"), F.count_distinct(a).alias("r"),
                                    F.count_distinct(b).alias("c")))
        e = F.col("ra") * F.col("cb") / F.col("N")
        s = cells.agg((F.sum(F.col("o") ** 2 / e) - F.first("N")).alias("chi2"),
                      F.first("r").alias("r"), F.first("c").alias("c"), F.first("N").alias("N"))
        outs.append(s.select(F.lit("chi2").alias("test"), F.lit(f"{a}|{b}").alias("feature"),
                             F.col("chi2").alias("statistic"),
                             ((F.col("r") - 1) * (F.col("c") - 1)).cast("double").alias("df1"),
                             F.lit(None).cast("double").alias("df2"),
                             F.sqrt(F.col("chi2") / (F.col("N") * (F.least("r", "c") - 1))).alias("effect")))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


def bivariate(df: DataFrame, label: str, numeric, categorical, pairs):
    """Statistics with p-values, sorted by p (driver side on a tiny table)."""
    rows = []
    for r in bivariate_stats(df, label, numeric, categorical, pairs).collect():
        if r["test"] == "pearson":
            rr, d = r["statistic"], r["df2"]
            p = t_sf2(rr * (d / max(1e-300, 1 - rr * rr)) ** 0.5, d)
        elif r["test"] == "anova":
            p = f_sf(r["statistic"], r["df1"], r["df2"])
        else:
            p = chi2_sf(r["statistic"], r["df1"])
        rows.append({**r.asDict(), "p_value": p})
    return sorted(rows, key=lambda x: x["p_value"])


def q_bivariate_tests(spark, sf_dir):
    posts = clean_posts(standin(spark, sf_dir, "posts"))
    b = bivariate_stats(posts, "donation_referrals", ["caption_length", "num_hashtags", "post_hour"],
                        ["platform", "media_type"], [("platform", "media_type")])
    return b.select("test", "feature", round_half_up("statistic", 6).alias("statistic"), "df1", "df2",
                    round_half_up("effect", 6).alias("effect"))


def _anova_sql(c):
    return f"""SELECT 'anova' AS test, '{c}' AS feature,
  {sql_r('(ssb / (k - 1)) / (ssw / (n - k))')} AS statistic, CAST(k - 1 AS DOUBLE) AS df1,
  CAST(n - k AS DOUBLE) AS df2, {sql_r('sqrt((ssb / (ssb + ssw)) / (1 - ssb / (ssb + ssw)))')} AS effect
FROM (SELECT sum(g.n * (g.m - t.M) * (g.m - t.M)) AS ssb, sum(g.n * g.v) AS ssw, count(*) AS k,
             any_value(t.N) AS n
      FROM (SELECT {c}, count(donation_referrals) AS n, avg(donation_referrals) AS m,
                   var_pop(donation_referrals) AS v FROM p GROUP BY {c}) g,
           (SELECT count(donation_referrals) AS N, avg(donation_referrals) AS M FROM p) t)"""


BIVARIATE_SQL = _CLEAN + "\n" + "\nUNION ALL\n".join(
    [f"""SELECT 'pearson' AS test, '{c}' AS feature, {sql_r(f'corr(donation_referrals, {c})')} AS statistic,
  CAST(NULL AS DOUBLE) AS df1, CAST(count(*) - 2 AS DOUBLE) AS df2,
  {sql_r(f'abs(corr(donation_referrals, {c}))')} AS effect FROM p"""
     for c in ["caption_length", "num_hashtags", "post_hour"]]
    + [_anova_sql("platform"), _anova_sql("media_type")]
    + [f"""SELECT 'chi2' AS test, 'platform|media_type' AS feature, {sql_r('chi2')} AS statistic,
  CAST((r - 1) * (c - 1) AS DOUBLE) AS df1, CAST(NULL AS DOUBLE) AS df2,
  {sql_r('sqrt(chi2 / (n * (least(r, c) - 1)))')} AS effect
FROM (SELECT sum((COALESCE(ct.o, 0) - ra.ra * cb.cb / t.n) * (COALESCE(ct.o, 0) - ra.ra * cb.cb / t.n)
                 / (ra.ra * cb.cb / t.n)) AS chi2,
             count(DISTINCT ra.platform) AS r, count(DISTINCT cb.media_type) AS c, any_value(t.n) AS n
      FROM (SELECT platform, count(*) AS ra FROM p GROUP BY platform) ra
      CROSS JOIN (SELECT media_type, count(*) AS cb FROM p GROUP BY media_type) cb
      CROSS JOIN (SELECT count(*) AS n FROM p) t
      LEFT JOIN (SELECT platform, media_type, count(*) AS o FROM p GROUP BY ALL) ct
        ON ct.platform = ra.platform AND ct.media_type = cb.media_type)"""])
