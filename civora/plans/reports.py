"""Feature-prep reports, rank statistics and row-level explanations.

SURVEY F2-F4, F8, F9, F11, F12, F14, F16, P13, P28, P29, P38, P39, W10/S12,
W11/S4, W12, S15, S19. Each query reads the driver tables through the
stand-ins; each statistic is one or two aggregations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civora.functions import constants as K
from civora.functions.columns import (date_parts, det_avg, ratio_features, round_half_up,
                                      rule_factors, sql_det_avg, sql_r)
from civora.operators import prep
from civora.operators.joins import materialize, staged
from civora.operators.ordering import global_position, range_bucket
from civora.operators.temporal import bucketed_prefix_sum, daily_rollup
from civora.plans.churn import _GAP_RAW, CHURN_FEATURES_SQL, churn_features, churn_sql_with
from civora.sources.standins import EVENT_AS_OF, duck_cte, standin

NUMS = ["engagement_rate", "donation_referrals", "caption_length"]


def _raw_posts(spark, sf_dir):
    return standin(spark, sf_dir, "posts")


_RAW = duck_cte("posts")


# F2 + F3 + F4 ---------------------------------------------------------------------
def q_impute_scale(spark, sf_dir):
    posts = staged(_raw_posts(spark, sf_dir).select("platform", "is_boosted", *NUMS))
    med = prep.fit_numeric_stats(posts, NUMS)
    filled = prep.impute_median_scale(posts, med, scale=False)
    stats = prep.fit_numeric_stats(filled, NUMS, with_median=False)   # scaler on the imputed data
    z = prep.impute_median_scale(filled, stats, scale=True)
    modes = prep.fit_modes(posts, ["is_boosted"])
    z = z.withColumn("is_boosted", F.coalesce(F.col("is_boosted"),
                                              F.lit(modes["is_boosted"] == "true")))
    return z.select("platform", "is_boosted", *[round_half_up(c, 6).alias(f"{c}_z") for c in NUMS])


def _z_sql(c):
    filled = f"COALESCE({c}, (SELECT quantile_cont({c}, 0.5) FROM posts))"
    return (f"{sql_r(f'({filled} - (SELECT avg(f) FROM (SELECT {filled} AS f FROM posts))) '
            f'/ (SELECT stddev_pop(f) FROM (SELECT {filled} AS f FROM posts))')} AS {c}_z")


IMPUTE_SCALE_SQL = _RAW + f"""
, m AS (SELECT is_boosted AS mb FROM posts WHERE is_boosted IS NOT NULL GROUP BY is_boosted
        ORDER BY count(*) DESC, CAST(is_boosted AS VARCHAR) LIMIT 1)
SELECT platform, COALESCE(is_boosted, (SELECT mb FROM m)) AS is_boosted,
       {', '.join(_z_sql(c) for c in NUMS)}
FROM posts
"""


# F8 --------------------------------------------------------------------------------
WRANGLE_COLS = ["post_id", "platform", "call_to_action_type", "is_boosted", "engagement_rate",
                "num_hashtags", "caption_length"]


def q_basic_wrangling(spark, sf_dir):
    r = prep.basic_wrangling_report(_raw_posts(spark, sf_dir), WRANGLE_COLS)
    return r.select("column", "rows", "non_null", "n_distinct",
                    round_half_up("null_share", 9).alias("null_share"), "drop_reason")


BASIC_WRANGLING_SQL = _RAW + "\n" + "UNION ALL\n".join(
    f"""SELECT '{c}' AS column, count(*) AS rows, count({c}) AS non_null, count(DISTINCT {c}) AS n_distinct,
       {sql_r(f'1 - count({c}) / count(*)', 9)} AS null_share,
       CASE WHEN 1 - count({c}) / count(*) > 0.95 THEN 'mostly_null'
            WHEN count(DISTINCT {c}) <= 1 THEN 'constant'
            WHEN count(DISTINCT {c}) = count(*) THEN 'id_like' END AS drop_reason FROM posts
""" for c in WRANGLE_COLS)


# F9 --------------------------------------------------------------------------------
def q_skew_candidates(spark, sf_dir):
    s = prep.skew_candidates(_raw_posts(spark, sf_dir), "estimated_donation_value")
    return s.select("method", "n", round_half_up("skew", 6).alias("skew"))


SKEW_SQL = _RAW + "\n" + "UNION ALL\n".join(
    f"SELECT '{m}' AS method, count({e}) AS n, {sql_r(f'skewness({e})')} AS skew FROM posts\n"
    for m, e in [("raw", "estimated_donation_value"), ("cbrt", "cbrt(estimated_donation_value)"),
                 ("sqrt", "sqrt(estimated_donation_value)"),
                 ("log1p", "ln(1 + estimated_donation_value)")])


# F14 -------------------------------------------------------------------------------
OUTLIER_COLS = ["estimated_donation_value", "donation_referrals", "caption_length"]


def q_outlier_bounds(spark, sf_dir):
    b = prep.fit_outlier_bounds(_raw_posts(spark, sf_dir), OUTLIER_COLS)
    return b.select("column", "method", round_half_up("lower", 6).alias("lower"),
                    round_half_up("upper", 6).alias("upper"))


OUTLIER_SQL = _RAW + "\n" + "UNION ALL\n".join(
    f"""SELECT '{c}' AS column,
       CASE WHEN abs(skewness({c})) > 1 THEN 'tukey' ELSE 'sigma3' END AS method,
       {sql_r(f"CASE WHEN abs(skewness({c})) > 1 THEN quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) ELSE avg({c}) - 3 * stddev_samp({c}) END")} AS lower,
       {sql_r(f"CASE WHEN abs(skewness({c})) > 1 THEN quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) ELSE avg({c}) + 3 * stddev_samp({c}) END")} AS upper
FROM posts
""" for c in OUTLIER_COLS)


# F14 and F11 with the treated rows as result -------------------------------------------
def q_outliers_replaced(spark, sf_dir):
    out = prep.replace_outliers(_raw_posts(spark, sf_dir).select("post_id", *OUTLIER_COLS), OUTLIER_COLS)
    return out.select("post_id", *[round_half_up(c, 6).alias(c) for c in OUTLIER_COLS])


def _bounds_sql(c: str) -> str:
    q1, q3 = f"quantile_cont({c}, 0.25)", f"quantile_cont({c}, 0.75)"
    skewed = f"abs(skewness({c})) > 1"
    return (f"CASE WHEN {skewed} THEN {q1} - 1.5 * ({q3} - {q1}) ELSE avg({c}) - 3 * stddev_samp({c}) END AS {c}_lo, "
            f"CASE WHEN {skewed} THEN {q3} + 1.5 * ({q3} - {q1}) ELSE avg({c}) + 3 * stddev_samp({c}) END AS {c}_hi")


OUTLIERS_REPLACED_SQL = _RAW + f"""
, b AS (SELECT {", ".join(map(_bounds_sql, OUTLIER_COLS))} FROM posts)
SELECT post_id, {", ".join(
    f"CASE WHEN {c} IS NOT NULL THEN {sql_r(f'least(greatest({c}, {c}_lo), {c}_hi)')} END AS {c}" for c in OUTLIER_COLS)}
FROM posts, b
"""

MISSING_COLS = ["call_to_action_type", "is_boosted", "engagement_rate", "donation_referrals", "caption_length"]


def q_missing_dropped(spark, sf_dir):
    """Posts with at least 90 % of the columns filled that are not null in most rows (no call-to-action type)."""
    return prep.drop_missing(_raw_posts(spark, sf_dir).select("post_id", *MISSING_COLS), MISSING_COLS)


MISSING_DROPPED_SQL = _RAW + f"""
, s AS (SELECT {", ".join(f"1 - count({c}) / count(*) <= 0.5 AS keep_{c}" for c in MISSING_COLS)} FROM posts)
SELECT post_id, {", ".join(MISSING_COLS[1:])} FROM posts, s
WHERE ({" + ".join(f"(keep_{c} AND {c} IS NOT NULL)::INT" for c in MISSING_COLS)})
      / ({" + ".join(f"keep_{c}::INT" for c in MISSING_COLS)}) >= 0.9 AND NOT keep_call_to_action_type
"""


# rows with their gaps filled ----------------------------------------------
CHAIN_COLS = ["engagement_rate", "donation_referrals", "caption_length"]


def q_chained_impute(spark, sf_dir):
    """Every post; the one incomplete column is regressed on the two others."""
    from civora.operators.imputation import chained_impute
    out = chained_impute(_raw_posts(spark, sf_dir).select("post_id", *CHAIN_COLS), CHAIN_COLS)
    return out.select("post_id", *[round_half_up(c, 6).alias(c) for c in CHAIN_COLS])


def _chain_sql(posts: str) -> str:
    return f"""
, m AS (SELECT avg(engagement_rate) AS my, avg(donation_referrals) FILTER (WHERE engagement_rate IS NOT NULL) AS ma,
               avg(caption_length) FILTER (WHERE engagement_rate IS NOT NULL) AS mb,
               var_pop(donation_referrals) FILTER (WHERE engagement_rate IS NOT NULL) AS saa,
               var_pop(caption_length) FILTER (WHERE engagement_rate IS NOT NULL) AS sbb,
               covar_pop(donation_referrals, caption_length) FILTER (WHERE engagement_rate IS NOT NULL) AS sab,
               covar_pop(engagement_rate, donation_referrals) AS say, covar_pop(engagement_rate, caption_length) AS sby FROM {posts})
, w AS (SELECT *, (say * sbb - sby * sab) / (saa * sbb - sab * sab) AS wa, (sby * saa - say * sab) / (saa * sbb - sab * sab) AS wb FROM m)
SELECT post_id, {sql_r("coalesce(engagement_rate, my + wa * (donation_referrals - ma) + wb * (caption_length - mb))")} AS engagement_rate,
       {sql_r("donation_referrals")} AS donation_referrals, {sql_r("caption_length")} AS caption_length
FROM {posts}, w
"""


CHAINED_IMPUTE_SQL = _RAW + _chain_sql("posts")


def q_missing_filled(spark, sf_dir):
    """Posts after the test of the gaps against the donation value: biased gaps dropped, the others filled."""
    from civora.operators.imputation import missing_fill
    posts = staged(_raw_posts(spark, sf_dir).select("post_id", "estimated_donation_value", *CHAIN_COLS))
    out = missing_fill(posts, CHAIN_COLS, "estimated_donation_value")
    return out.select("post_id", *[round_half_up(c, 6).alias(c) for c in CHAIN_COLS])


# The 95 % point of Student's distribution by its expansion around the normal one (degrees of freedom are in the hundreds).
MISSING_FILLED_SQL = _RAW + """
, g AS (SELECT engagement_rate IS NULL AS gap, count(estimated_donation_value) AS n, avg(estimated_donation_value) AS mean,
               var_samp(estimated_donation_value) AS v FROM posts GROUP BY 1)
, t AS (SELECT abs(a.mean - b.mean) / sqrt(a.v / a.n + b.v / b.n) AS stat, a.n + b.n AS n,
               (a.v / a.n + b.v / b.n) ** 2 / ((a.v / a.n) ** 2 / (a.n - 1) + (b.v / b.n) ** 2 / (b.n - 1)) AS df
        FROM g a, g b WHERE a.gap AND NOT b.gap)
, z AS (SELECT 1.6448536269514722 AS z)
, d AS (SELECT coalesce((SELECT stat >= CASE WHEN n >= 200000 THEN z ELSE z + (z ** 3 + z) / (4 * df)
                                             + (5 * z ** 5 + 16 * z ** 3 + 3 * z) / (96 * df ** 2) END FROM t, z), false) AS biased)
, kept AS (SELECT posts.* FROM posts, d WHERE NOT (biased AND engagement_rate IS NULL))
""" + _chain_sql("kept")


# F16 -------------------------------------------------------------------------------
VAR_COLS = ["engagement_rate", "donation_referrals", "num_hashtags", "caption_length"]


def q_variance_threshold(spark, sf_dir):
    v = prep.variance_report(_raw_posts(spark, sf_dir), VAR_COLS)
    return v.select("column", round_half_up("variance", 6).alias("variance"), "keep")


VARIANCE_SQL = _RAW + "\n" + "UNION ALL\n".join(
    f"SELECT '{c}' AS column, {sql_r(f'var_pop({c})')} AS variance, var_pop({c}) > 0.01 AS keep FROM posts\n"
    for c in VAR_COLS)


# F11 + F12: missingness report and label-mean test -------------------------------------
MISS_COLS = ["engagement_rate", "is_boosted", "call_to_action_type"]


def q_missingness_test(spark, sf_dir, label: str = "donation_referrals"):
    posts = _raw_posts(spark, sf_dir)
    parts = []
    for c in MISS_COLS:
        miss = F.col(c).isNull()
        parts.append(posts.agg(
            F.lit(c).alias("column"), F.count_if(miss).alias("n_missing"),
            F.count_if(~miss).alias("n_present"),
            F.avg(F.when(miss, F.col(label))).alias("m1"), F.avg(F.when(~miss, F.col(label))).alias("m0"),
            F.var_samp(F.when(miss, F.col(label))).alias("v1"),
            F.var_samp(F.when(~miss, F.col(label))).alias("v0")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    t = (F.col("m1") - F.col("m0")) / F.sqrt(F.col("v1") / F.col("n_missing") + F.col("v0") / F.col("n_present"))
    return u.select("column", "n_missing", "n_present",
                    round_half_up(F.col("n_missing") / (F.col("n_missing") + F.col("n_present")), 9)
                    .alias("missing_share"),
                    round_half_up(F.col("m1"), 6).alias("mean_missing"),
                    round_half_up(F.col("m0"), 6).alias("mean_present"),
                    round_half_up(t, 6).alias("welch_t"))


MISSINGNESS_SQL = _RAW + "\n" + "UNION ALL\n".join(
    f"""SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS n_missing,
       count(*) FILTER (WHERE {c} IS NOT NULL) AS n_present,
       {sql_r(f'count(*) FILTER (WHERE {c} IS NULL) / count(*)', 9)} AS missing_share,
       {sql_r(f'avg(donation_referrals) FILTER (WHERE {c} IS NULL)')} AS mean_missing,
       {sql_r(f'avg(donation_referrals) FILTER (WHERE {c} IS NOT NULL)')} AS mean_present,
       {sql_r(f'(avg(donation_referrals) FILTER (WHERE {c} IS NULL) - avg(donation_referrals) FILTER (WHERE {c} IS NOT NULL)) / sqrt(var_samp(donation_referrals) FILTER (WHERE {c} IS NULL) / count(*) FILTER (WHERE {c} IS NULL) + var_samp(donation_referrals) FILTER (WHERE {c} IS NOT NULL) / count(*) FILTER (WHERE {c} IS NOT NULL))')} AS welch_t
FROM posts
""" for c in MISS_COLS)


# P13 -------------------------------------------------------------------------------
def q_date_parts(spark, sf_dir):
    d = standin(spark, sf_dir, "donations").select("donation_id", "donation_date")
    return date_parts(d, "donation_date", drop=True)


DATE_PARTS_SQL = duck_cte("donations") + """
SELECT donation_id, year(donation_date) AS donation_date_year, month(donation_date) AS donation_date_month,
       day(donation_date) AS donation_date_day, isodow(donation_date) - 1 AS donation_date_weekday
FROM donations
"""


# Event times written with an offset; the clock time is kept, the zone dropped
def q_zone_stripped(spark, sf_dir):
    from civora.functions.columns import strip_zone
    from civora.sources.tables import read_table
    events = read_table(spark, sf_dir, "events", ["event_id", "ts"])
    zone = F.element_at(F.array(F.lit("+02:00"), F.lit("-05:30"), F.lit("Z")), (F.col("event_id") % 3 + 1).cast("int"))
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), zone)
    wall = strip_zone(text)
    return events.select("event_id", wall.alias("wall_time"),
                         F.timestamp_diff("MINUTE", text.cast("timestamp").cast("timestamp_ntz"), wall).alias("offset_minutes"))


ZONE_STRIPPED_SQL = """
SELECT event_id, ts AS wall_time, CASE event_id % 3 WHEN 0 THEN 120 WHEN 1 THEN -330 ELSE 0 END::BIGINT AS offset_minutes
FROM events
"""


# P28 + P38: ratio features and row-specific churn factors ------------------------------
ROW_FACTOR_ORDER = ["recency_days", "recency_frequency_ratio", "frequency", "ever_recurring",
                    "overdue_flag"]


def churn_row_factors(df: DataFrame, order=ROW_FACTOR_ORDER) -> F.Column:
    """Rules applied in importance order, first three that hold, else fallback."""
    t = K.ROW_FACTOR_TEXT
    rules = {
        "recency_days": (F.col("recency_days") > K.ROW_FACTOR_RECENCY_DAYS,
                         F.concat(F.lit("Last donation was "), F.col("recency_days").cast("string"),
                                  F.lit(" days ago"))),
        "recency_frequency_ratio": (F.col("recency_per_gift") > K.ROW_FACTOR_RATIO,
                                    F.lit(t["recency_frequency_ratio"])),
        "frequency": (F.col("frequency") <= 2, F.lit(t["frequency"])),
        "ever_recurring": (F.col("ever_recurring") == 0, F.lit(t["ever_recurring"])),
        "overdue_flag": (F.col("is_overdue"), F.lit(t["overdue_flag"])),
    }
    return rule_factors([rules[f] for f in order], 3, K.ROW_FACTOR_FALLBACK)


def q_churn_row_factors(spark, sf_dir):
    df = ratio_features(churn_features(spark, sf_dir))
    return df.select("supporter_id",
                     round_half_up("recency_per_gift", 6).alias("recency_per_gift"),
                     round_half_up("value_per_tenure", 9).alias("value_per_tenure"),
                     F.col("is_overdue").cast("int").alias("overdue_flag"),
                     F.array_join(churn_row_factors(df), " | ").alias("top_risk_factors"))


CHURN_ROW_FACTORS_SQL = churn_sql_with(
    f"ln(1 + a.total_value) AS total_value_log_raw, {_GAP_RAW} AS avg_gap_raw").replace(
    "\nSELECT a.supporter_id, s.supporter_type", "\n, f AS (SELECT a.supporter_id, s.supporter_type", 1) \
    + f""")
, g AS (SELECT supporter_id, recency_days, frequency, ever_recurring,
               recency_days / (frequency + 1) AS rpg, total_value_log_raw / (tenure_days + 1) AS vpt,
               recency_days > avg_gap_raw * 1.5 AS od FROM f)
, l AS (SELECT *, list_filter([
          CASE WHEN recency_days > {K.ROW_FACTOR_RECENCY_DAYS} THEN 'Last donation was ' || CAST(recency_days AS VARCHAR) || ' days ago' END,
          CASE WHEN rpg > {K.ROW_FACTOR_RATIO} THEN '{K.ROW_FACTOR_TEXT["recency_frequency_ratio"]}' END,
          CASE WHEN frequency <= 2 THEN '{K.ROW_FACTOR_TEXT["frequency"]}' END,
          CASE WHEN ever_recurring = 0 THEN '{K.ROW_FACTOR_TEXT["ever_recurring"]}' END,
          CASE WHEN od THEN '{K.ROW_FACTOR_TEXT["overdue_flag"]}' END], lambda x: x IS NOT NULL) AS arr FROM g)
SELECT supporter_id, {sql_r('rpg')} AS recency_per_gift, {sql_r('vpt', 9)} AS value_per_tenure,
       CAST(od AS INTEGER) AS overdue_flag,
       CASE WHEN len(arr) = 0 THEN '{K.ROW_FACTOR_FALLBACK}' ELSE array_to_string(arr[1:3], ' | ') END
         AS top_risk_factors
FROM l
"""


# P29 -------------------------------------------------------------------------------
def q_centered_square(spark, sf_dir):
    from civora.operators.joins import with_scalars
    posts = _raw_posts(spark, sf_dir).select("post_id", "caption_length")
    d = with_scalars(posts, posts.agg(F.avg("caption_length").alias("_mu")))
    return d.select("post_id", "caption_length",
                    round_half_up((F.col("caption_length") - F.col("_mu")) ** 2, 6).alias("caption_sq"))


CENTERED_SQL = _RAW + f"""
, m AS (SELECT avg(caption_length) AS mu FROM posts)
SELECT post_id, caption_length, {sql_r('(caption_length - mu) * (caption_length - mu)')} AS caption_sq FROM posts, m
"""


# Spearman with average ranks ---------------------------------------------
def average_ranks(df: DataFrame, col: str, out: str) -> DataFrame:
    """rank_avg(v) = #(< v) + (#(= v) + 1) / 2 via counts per distinct value + bucketed prefix."""
    c = materialize(df.groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_n")))
    cum = bucketed_prefix_sum(range_bucket(c, "_v"), [], "_b", ["_v"], ["_n"])
    ranks = cum.select(F.col("_v").alias(col), (F.col("_n_cum") - F.col("_n") + (F.col("_n") + 1) / 2)
                       .alias(out))
    return df.join(ranks, col)


def q_spearman_corr(spark, sf_dir):
    posts = _raw_posts(spark, sf_dir).select("donation_referrals", "estimated_donation_value")
    r = average_ranks(average_ranks(posts, "donation_referrals", "_ra"), "estimated_donation_value", "_rb")
    return r.agg(F.count(F.lit(1)).alias("n"), round_half_up(F.corr("_ra", "_rb"), 6).alias("spearman_rho"))


SPEARMAN_SQL = _RAW + f"""
, r AS (SELECT rank() OVER (ORDER BY donation_referrals)
               + (count(*) OVER (PARTITION BY donation_referrals) - 1) / 2.0 AS ra,
               rank() OVER (ORDER BY estimated_donation_value)
               + (count(*) OVER (PARTITION BY estimated_donation_value) - 1) / 2.0 AS rb FROM posts)
SELECT count(*) AS n, {sql_r('corr(ra, rb)')} AS spearman_rho FROM r
"""


# Durbin-Watson of residuals in time order -------------------------------------
def q_durbin_watson(spark, sf_dir):
    posts = _raw_posts(spark, sf_dir).select("platform", "created_at", "post_id", "donation_referrals")
    m = posts.groupBy("platform").agg(F.avg("donation_referrals").alias("_m"))
    e = posts.join(m, "platform").withColumn("e", F.col("donation_referrals") - F.col("_m"))
    ranked = global_position(e, [F.col(c) for c in ("created_at", "post_id", "donation_referrals", "platform")],
                             "_pos").select("_pos", "e")
    prev = ranked.select((F.col("_pos") + 1).alias("_pos"), F.col("e").alias("e_prev"))
    j = ranked.join(prev, "_pos", "left")
    s = j.agg(F.sum((F.col("e") - F.col("e_prev")) ** 2).alias("num"), F.sum(F.col("e") ** 2).alias("den"),
              F.count(F.lit(1)).alias("n"))
    return s.select("n", round_half_up(F.col("num") / F.col("den"), 6).alias("durbin_watson"))


DURBIN_WATSON_SQL = _RAW + f"""
, m AS (SELECT platform, avg(donation_referrals) AS mu FROM posts GROUP BY platform)
, e AS (SELECT donation_referrals - mu AS e,
               row_number() OVER (ORDER BY created_at, post_id, donation_referrals, platform) AS pos
        FROM posts JOIN m USING (platform))
, d AS (SELECT e, e - lag(e) OVER (ORDER BY pos) AS de FROM e)
SELECT count(*) AS n, {sql_r('sum(de * de) / sum(e * e)')} AS durbin_watson FROM d
"""


# Trailing 7-day mean and lag per case (on the per-day rollup) -------------------------
def q_rolling_health(spark, sf_dir, days: int = 7):
    h = standin(spark, sf_dir, "health_records")
    daily = daily_rollup(h, "case_id", "record_date", "general_health_score")
    w = Window.partitionBy("case_id").orderBy(F.unix_date("_day")).rangeBetween(-(days - 1), 0)
    wl = Window.partitionBy("case_id").orderBy("_day")
    s = round_half_up(F.sum("_s").over(w), 6)
    return daily.select("case_id", F.col("_day").alias("record_date"),
                        round_half_up(s / F.sum("_nv").over(w), 6).alias("rolling_mean_7d"),
                        F.lag("_day").over(wl).alias("previous_record_date"))


ROLLING_SQL = duck_cte("health_records") + f"""
, d AS (SELECT case_id, record_date, sum(general_health_score) AS s, count(general_health_score) AS n
        FROM health_records GROUP BY ALL)
SELECT case_id, record_date,
       {sql_r(sql_r('sum(s) OVER w') + ' / sum(n) OVER w')} AS rolling_mean_7d,
       lag(record_date) OVER (PARTITION BY case_id ORDER BY record_date) AS previous_record_date
FROM d WINDOW w AS (PARTITION BY case_id ORDER BY record_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)
"""


# Pairwise Welch t statistics between groups (Bonferroni-ready) ---------------------------
def q_pairwise_ttests(spark, sf_dir):
    from civora.plans.content import clean_posts
    posts = clean_posts(_raw_posts(spark, sf_dir))
    g = posts.groupBy("platform").agg(F.count(F.lit(1)).alias("n"), F.avg("donation_referrals").alias("m"),
                                      F.var_samp("donation_referrals").alias("v"))
    # pairs of groups (k(k-1)/2 rows, k = number of groups) from one array of the
    # k group summaries: explode + filter, no join
    arr = g.agg(F.collect_list(F.struct("platform", "n", "m", "v")).alias("gs"))
    a = arr.select("gs", F.explode("gs").alias("a"))
    p = a.select("a", F.explode(F.filter("gs", lambda x: x["platform"] > F.col("a")["platform"])).alias("b"))
    A = lambda f: F.col("a")[f]
    B = lambda f: F.col("b")[f]
    se2 = A("v") / A("n") + B("v") / B("n")
    t = (A("m") - B("m")) / F.sqrt(se2)
    dfw = se2 ** 2 / ((A("v") / A("n")) ** 2 / (A("n") - 1) + (B("v") / B("n")) ** 2 / (B("n") - 1))
    n_pairs = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))
    return p.select(A("platform").alias("group_a"), B("platform").alias("group_b"),
                    round_half_up(t, 6).alias("t"), round_half_up(dfw, 4).alias("welch_df"),
                    n_pairs.alias("bonferroni_m"))


PAIRWISE_SQL = duck_cte("posts") + f"""
, p AS (SELECT * FROM posts WHERE engagement_rate IS NOT NULL AND donation_referrals IS NOT NULL)
, g AS (SELECT platform, count(*) AS n, avg(donation_referrals) AS m, var_samp(donation_referrals) AS v
        FROM p GROUP BY platform)
SELECT a.platform AS group_a, b.platform AS group_b,
       {sql_r('(a.m - b.m) / sqrt(a.v / a.n + b.v / b.n)')} AS t,
       {sql_r('(a.v / a.n + b.v / b.n) * (a.v / a.n + b.v / b.n) / ((a.v / a.n) * (a.v / a.n) / (a.n - 1) + (b.v / b.n) * (b.v / b.n) / (b.n - 1))', 4)} AS welch_df,
       count(*) OVER () AS bonferroni_m
FROM g a JOIN g b ON a.platform < b.platform
"""


# Effect-direction report per area (from the per-area effects) -----------------------------
def q_effect_direction(spark, sf_dir):
    from civora.plans.attribution import allocation_outcomes, area_slope_effects
    e = area_slope_effects(allocation_outcomes(spark, sf_dir))
    return e.groupBy("program_area").agg(
        F.count_if(F.col("coef") > 0).alias("n_positive"), F.count_if(F.col("coef") < 0).alias("n_negative"),
        F.count_if(F.col("significant")).alias("n_significant"))


def _effect_direction_sql():
    from civora.plans.attribution import _EFFECT_CTE
    return _EFFECT_CTE + """
SELECT program_area, count(*) FILTER (WHERE coef > 0) AS n_positive, count(*) FILTER (WHERE coef < 0) AS n_negative,
       count(*) FILTER (WHERE abs(coef) > 1.96 * se) AS n_significant
FROM ef GROUP BY program_area
"""


EFFECT_DIRECTION_SQL = _effect_direction_sql()
