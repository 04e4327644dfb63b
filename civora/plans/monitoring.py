"""Monitoring and selection reports.

Drift checks compare two score / label distributions computed from the same
tables at two reference dates (the earlier one stands for the stored
baseline); every check is one or two aggregations plus a tiny join.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civora.functions.columns import round_half_up, sql_r
from civora.operators.concordance import kendall_tau_b
from civora.plans.churn import churn_features
from civora.plans.content import _CLEAN, clean_posts
from civora.plans.io_queries import OLD_AS_OF, _rule_scores, _rule_sql
from civora.sources.standins import duck_cte, standin

NEW_AS_OF = "DATE '2001-08-02'"
PSI_BINS = 10


# Label-rate drift (>10 points) ---------------------------------------------------
def q_label_drift(spark, sf_dir, max_shift: float = 0.10):
    old = churn_features(spark, sf_dir, as_of=OLD_AS_OF, point_in_time=True) \
        .agg(F.avg("churned").alias("base_rate"))
    new = churn_features(spark, sf_dir, as_of=NEW_AS_OF, point_in_time=True) \
        .agg(F.avg("churned").alias("rate"))
    from civora.operators.joins import with_scalars
    j = with_scalars(old, new)
    return j.select(round_half_up("base_rate", 9).alias("base_rate"), round_half_up("rate", 9).alias("rate"),
                    (F.abs(F.col("rate") - F.col("base_rate")) > max_shift).alias("drift_alert"))


def _churn_label_sql(as_of):
    return f"""SELECT avg(CASE WHEN (ever_recurring = 1 AND date_diff('day', last_d, {as_of}) > 120)
                        OR (ever_recurring = 0 AND date_diff('day', last_d, {as_of}) > 90) THEN 1 ELSE 0 END) AS r
    FROM (SELECT d.supporter_id, max(donation_date) AS last_d,
                 max(CASE WHEN is_recurring THEN 1 ELSE 0 END) AS ever_recurring
          FROM donations d WHERE donation_date < {as_of}
          GROUP BY d.supporter_id HAVING count(donation_id) >= 2) a
    JOIN supporters s ON a.supporter_id = s.supporter_id WHERE s.status IN ('Active', 'Inactive')"""


LABEL_DRIFT_SQL = duck_cte("supporters", "donations") + f"""
, o AS ({_churn_label_sql(OLD_AS_OF)}), n AS ({_churn_label_sql(NEW_AS_OF)})
SELECT {sql_r('o.r', 9)} AS base_rate, {sql_r('n.r', 9)} AS rate, abs(n.r - o.r) > 0.1 AS drift_alert FROM o, n
"""


# Population stability index of the score distribution -------------------------------
def psi(base: DataFrame, cur: DataFrame, score: str, bins: int = PSI_BINS, eps: float = 1e-4) -> DataFrame:
    """Fixed-width bins on [0, 1]; PSI = sum (p - q) ln(p / q) with an epsilon floor."""
    b = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    hb = base.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("nb"))
    hc = cur.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("nc"))
    w = Window.partitionBy(F.lit(0))
    j = (hb.join(hc, "bin", "full_outer").fillna(0, ["nb", "nc"])
           .withColumn("p", F.greatest(F.col("nb") / F.sum("nb").over(w), F.lit(eps)))
           .withColumn("q", F.greatest(F.col("nc") / F.sum("nc").over(w), F.lit(eps))))
    return j.agg(F.sum((F.col("q") - F.col("p")) * F.log(F.col("q") / F.col("p"))).alias("psi"))


def q_score_psi(spark, sf_dir):
    out = psi(_rule_scores(spark, sf_dir, OLD_AS_OF), _rule_scores(spark, sf_dir, NEW_AS_OF), "rule_score")
    return out.select(round_half_up("psi", 6).alias("psi"), (F.col("psi") > 0.25).alias("drift_alert"))


SCORE_PSI_SQL = duck_cte("supporters", "donations") + f"""
, o AS ({_rule_sql(OLD_AS_OF)}), n AS ({_rule_sql(NEW_AS_OF)})
, hb AS (SELECT CAST(least(floor(rule_score * 10), 9) AS INTEGER) AS bin, count(*) AS nb FROM o GROUP BY 1)
, hc AS (SELECT CAST(least(floor(rule_score * 10), 9) AS INTEGER) AS bin, count(*) AS nc FROM n GROUP BY 1)
, j AS (SELECT COALESCE(nb, 0) AS nb, COALESCE(nc, 0) AS nc FROM hb FULL OUTER JOIN hc USING (bin))
, pq AS (SELECT greatest(nb / sum(nb) OVER (), 1e-4) AS p, greatest(nc / sum(nc) OVER (), 1e-4) AS q FROM j)
SELECT {sql_r('sum((q - p) * ln(q / p))')} AS psi, sum((q - p) * ln(q / p)) > 0.25 AS drift_alert FROM pq
"""


# High-risk share gate and top-10 list (top-k is the feature) --------------------------
def q_high_risk_top10(spark, sf_dir, max_share: float = 0.60):
    s = _rule_scores(spark, sf_dir, NEW_AS_OF)
    share = s.agg(F.avg((F.col("risk_tier") == "high").cast("double")).alias("high_share"))
    top = s.orderBy(F.col("rule_score").desc(), F.col("supporter_id")).limit(10)
    from civora.operators.joins import with_scalars
    return with_scalars(top, share).select("supporter_id", "rule_score",
                                       round_half_up("high_share", 9).alias("high_share"),
                                       (F.col("high_share") < max_share).alias("gate_passed"))


HIGH_RISK_SQL = duck_cte("supporters", "donations") + f"""
, n AS ({_rule_sql(NEW_AS_OF)})
, sh AS (SELECT avg(CASE WHEN rule_score >= 0.7 THEN 1.0 ELSE 0.0 END) AS h FROM n)
SELECT supporter_id, rule_score, {sql_r('h', 9)} AS high_share, h < 0.6 AS gate_passed
FROM (SELECT * FROM n ORDER BY rule_score DESC, supporter_id LIMIT 10), sh
"""


# Conversion consistency (converts >= 1.5 x platform median; converts mean > noise mean) ---
def q_conversion_consistency(spark, sf_dir):
    from civora.plans.content import platform_medians
    posts = clean_posts(standin(spark, sf_dir, "posts"))
    med = platform_medians(posts)
    lab = (F.when(F.col("donation_referrals") >= 1.5 * F.col("platform_median"), F.lit("converts"))
            .when((F.col("engagement_rate") >= 0.12)
                  & (F.col("donation_referrals") < 0.8 * F.col("platform_median")), F.lit("noise"))
            .otherwise(F.lit("balanced")))
    j = posts.join(med, "platform").withColumn("signal", lab)
    g = j.groupBy("platform").agg(
        F.avg(F.when(F.col("signal") == "converts", F.col("donation_referrals"))).alias("m_conv"),
        F.avg(F.when(F.col("signal") == "noise", F.col("donation_referrals"))).alias("m_noise"),
        F.count_if(F.col("signal") == "converts").alias("n_converts"),
        F.count_if(F.col("signal") == "noise").alias("n_noise"))
    return g.select("platform", "n_converts", "n_noise",
                    F.coalesce(F.col("m_conv") > F.col("m_noise"), F.lit(True)).alias("consistent"))


CONVERSION_CONSISTENCY_SQL = _CLEAN + """
, med AS (SELECT platform, quantile_cont(donation_referrals, 0.5) AS pm FROM p GROUP BY platform)
, s AS (SELECT p.platform, donation_referrals,
               CASE WHEN donation_referrals >= 1.5 * pm THEN 'converts'
                    WHEN engagement_rate >= 0.12 AND donation_referrals < 0.8 * pm THEN 'noise'
                    ELSE 'balanced' END AS signal
        FROM p JOIN med USING (platform))
SELECT platform, count(*) FILTER (WHERE signal = 'converts') AS n_converts,
       count(*) FILTER (WHERE signal = 'noise') AS n_noise,
       COALESCE(avg(donation_referrals) FILTER (WHERE signal = 'converts')
                > avg(donation_referrals) FILTER (WHERE signal = 'noise'), true) AS consistent
FROM s GROUP BY platform
"""


# Kendall tau-b, any number of levels -------------------------------------------------
def q_kendall_tau(spark, sf_dir):
    t = kendall_tau_b(clean_posts(standin(spark, sf_dir, "posts")), "num_hashtags", "post_hour")
    return t.select(F.col("N").alias("n"), round_half_up("tau_b", 9).alias("tau_b"))


def q_kendall_tau_continuous(spark, sf_dir):
    """Two columns with about one level per row: a supporter's largest against the smallest gift."""
    v = F.coalesce("amount", "estimated_value")
    gifts = standin(spark, sf_dir, "donations").groupBy("supporter_id").agg(F.max(v).alias("a"), F.min(v).alias("b"))
    return kendall_tau_b(gifts, "a", "b").select(F.col("N").alias("n"), round_half_up("tau_b", 9).alias("tau_b"))


_TAU_OF_CELLS = f"""
, cd AS (SELECT sum(CASE WHEN x.b < y.b THEN x.n * y.n ELSE 0 END) AS c,
                sum(CASE WHEN x.b > y.b THEN x.n * y.n ELSE 0 END) AS d FROM g x JOIN g y ON x.a < y.a)
, ta AS (SELECT sum(m * (m - 1) / 2) AS n1 FROM (SELECT a, sum(n) AS m FROM g GROUP BY a))
, tb AS (SELECT sum(m * (m - 1) / 2) AS n2 FROM (SELECT b, sum(n) AS m FROM g GROUP BY b))
, t AS (SELECT sum(n) AS nn FROM g)
SELECT nn AS n, {sql_r('(c - d) / sqrt((nn * (nn - 1) / 2 - n1) * (nn * (nn - 1) / 2 - n2))', 9)} AS tau_b
FROM cd, ta, tb, t
"""
KENDALL_SQL = _CLEAN + """
, g AS (SELECT num_hashtags AS a, post_hour AS b, count(*) AS n FROM p GROUP BY ALL)""" + _TAU_OF_CELLS
KENDALL_CONTINUOUS_SQL = duck_cte("donations") + """
, s AS (SELECT max(COALESCE(amount, estimated_value)) AS a, min(COALESCE(amount, estimated_value)) AS b
        FROM donations GROUP BY supporter_id)
, g AS (SELECT a, b, count(*) AS n FROM s GROUP BY ALL)""" + _TAU_OF_CELLS


# SelectKBest by one-way ANOVA F (features x binary label) -------------------------------
KBEST_FEATURES = ["recency_days", "frequency", "tenure_days", "active_span_days", "num_campaigns",
                  "num_channels", "ever_recurring"]


def anova_f_scores(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    """F statistic of each feature across label groups; one stacked aggregation."""
    pairs = ", ".join(f"'{c}', CAST({c} AS DOUBLE)" for c in features)
    long = df.select(F.col(label).alias("_y"), F.expr(f"stack({len(features)}, {pairs}) AS (feature, x)"))
    g = long.groupBy("feature", "_y").agg(F.count("x").alias("n"), F.avg("x").alias("m"),
                                          F.var_pop("x").alias("v"))
    w = Window.partitionBy("feature")
    tot_n = F.sum("n").over(w)
    grand = F.sum(F.col("n") * F.col("m")).over(w) / tot_n
    g = g.withColumn("_N", tot_n).withColumn("_M", grand).withColumn("_k", F.count(F.lit(1)).over(w))
    s = g.groupBy("feature").agg(
        F.sum(F.col("n") * (F.col("m") - F.col("_M")) ** 2).alias("ssb"),
        F.sum(F.col("n") * F.col("v")).alias("ssw"), F.first("_N").alias("N"), F.first("_k").alias("k"))
    return s.select("feature", ((F.col("ssb") / (F.col("k") - 1)) / (F.col("ssw") / (F.col("N") - F.col("k"))))
                    .alias("f_score"))


def q_select_k_best(spark, sf_dir, k: int = 4):
    f = anova_f_scores(churn_features(spark, sf_dir), "churned", KBEST_FEATURES)
    rk = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("f_score").desc(), "feature"))
    return (f.withColumn("rank", rk).withColumn("selected", F.col("rank") <= k)
             .select("feature", round_half_up("f_score", 4).alias("f_score"), "rank", "selected"))


def _kbest_sql():
    from civora.plans.churn import CHURN_FEATURES_SQL
    body = CHURN_FEATURES_SQL.replace("\nSELECT a.supporter_id, s.supporter_type",
                                      "\n, cf AS (SELECT a.supporter_id, s.supporter_type", 1) + ")\n"
    unions = "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, churned AS y, CAST({c} AS DOUBLE) AS x FROM cf"
                                  for c in KBEST_FEATURES)
    return body + f""", lg AS ({unions})
, g AS (SELECT feature, y, count(x) AS n, avg(x) AS m, var_pop(x) AS v FROM lg GROUP BY ALL)
, t AS (SELECT feature, sum(n) AS nn, sum(n * m) / sum(n) AS mm, count(*) AS k FROM g GROUP BY feature)
, s AS (SELECT g.feature, sum(g.n * (g.m - t.mm) * (g.m - t.mm)) AS ssb, sum(g.n * g.v) AS ssw,
               any_value(t.nn) AS nn, any_value(t.k) AS k FROM g JOIN t USING (feature) GROUP BY g.feature)
, f AS (SELECT feature, (ssb / (k - 1)) / (ssw / (nn - k)) AS fs FROM s)
SELECT feature, {sql_r('fs', 4)} AS f_score, row_number() OVER (ORDER BY fs DESC, feature) AS rank,
       row_number() OVER (ORDER BY fs DESC, feature) <= 4 AS selected FROM f
"""


KBEST_SQL = _kbest_sql()


# Mutual information of the same features with the churn label ------------------------------
def q_mutual_information(spark, sf_dir):
    from civora.operators.selection import mutual_information
    mi = mutual_information(churn_features(spark, sf_dir), "churned", KBEST_FEATURES)
    return mi.select("feature", round_half_up("mi", 9).alias("mi"))


def _mi_sql():
    head = KBEST_SQL.split("\n, g AS (SELECT feature, y, count(x)")[0]
    cuts = ", ".join(f"round(quantile_cont(x, {k / 10}), 6)" for k in range(1, 10))
    return head + f"""
, cuts AS (SELECT feature, [{cuts}] AS cs FROM lg GROUP BY feature)
, cells AS (SELECT lg.feature, CASE WHEN x IS NULL THEN -1 ELSE len(list_filter(cs, lambda c: c <= x)) END AS bin, y,
                   count(*) AS n FROM lg JOIN cuts ON cuts.feature = lg.feature WHERE y IS NOT NULL GROUP BY ALL)
, m AS (SELECT feature, n, sum(n) OVER (PARTITION BY feature) AS tot, sum(n) OVER (PARTITION BY feature, bin) AS nb,
               sum(n) OVER (PARTITION BY feature, y) AS ny FROM cells)
SELECT feature, {sql_r('sum(n / tot * ln(n * tot / (nb * ny)))', 9)} AS mi FROM m GROUP BY feature
"""


MUTUAL_INFORMATION_SQL = _mi_sql()


# Cluster stability (training windows vs scored cases), total-variation distance ------------
def q_cluster_stability(spark, sf_dir):
    from civora.plans import interventions as iv
    tf = iv.clustered_training_frame(spark, sf_dir)
    recs = iv.cluster_recommendations(tf)
    sizes = recs.select(F.col("profile_cluster").alias("label"), F.col("cluster_size").alias("n"))
    scored = iv.assign_clusters(iv.active_cases(spark, sf_dir), sizes)
    w = Window.partitionBy(F.lit(0))
    a = tf.where(F.col("profile_cluster").isNotNull()).groupBy("profile_cluster").agg(F.count(F.lit(1)).alias("na"))
    b = scored.where(F.col("profile_cluster").isNotNull()).groupBy("profile_cluster").agg(
        F.count(F.lit(1)).alias("nb"))
    j = (a.join(b, "profile_cluster", "full_outer").fillna(0, ["na", "nb"])
          .withColumn("pa", F.col("na") / F.sum("na").over(w)).withColumn("pb", F.col("nb") / F.sum("nb").over(w)))
    return j.agg(F.count(F.lit(1)).alias("n_clusters"),
                 round_half_up(F.sum(F.abs(F.col("pa") - F.col("pb"))) / 2, 9).alias("tv_distance"))


def _stability_sql():
    from civora.plans.interventions import INTERVENTION_RECS_SQL
    head = INTERVENTION_RECS_SQL.split("), j AS (")[0] + ")"
    return head + f"""
, a AS (SELECT profile_cluster, count(*) AS na FROM ctf WHERE profile_cluster IS NOT NULL GROUP BY 1)
, b AS (SELECT profile_cluster, count(*) AS nb FROM sc WHERE profile_cluster IS NOT NULL GROUP BY 1)
, j AS (SELECT COALESCE(na, 0) AS na, COALESCE(nb, 0) AS nb FROM a FULL OUTER JOIN b USING (profile_cluster))
SELECT count(*) AS n_clusters,
       {sql_r('sum(abs(na / (SELECT sum(na) FROM j) - nb / (SELECT sum(nb) FROM j))) / 2', 9)} AS tv_distance
FROM j
"""


CLUSTER_STABILITY_SQL = _stability_sql()


# IO10: input validation (null rate, range, unseen categories vs the training split) -------------
def q_input_validation(spark, sf_dir):
    from civora.operators.evaluate import time_split
    from civora.sources.sinks import validation_report
    posts = standin(spark, sf_dir, "posts")
    split = time_split(posts, "created_at", ["post_id", "donation_referrals", "engagement_rate"])
    known = split.where("split = 'train'").select("platform").distinct()
    test = split.where("split = 'test'")
    r = validation_report(test, ["engagement_rate", "donation_referrals", "caption_length"], "platform", known)
    return r.select("column", "rows", "non_null", "min", "max",
                    round_half_up("null_rate", 9).alias("null_rate"), "unseen_rows")


INPUT_VALIDATION_SQL = duck_cte("posts") + """
, r AS (SELECT *, row_number() OVER (ORDER BY created_at, post_id, donation_referrals, engagement_rate) AS pos,
               count(*) OVER () AS n FROM posts)
, tr AS (SELECT DISTINCT platform FROM r WHERE pos <= floor(n * 0.8))
, te AS (SELECT * FROM r WHERE pos > floor(n * 0.8))
, u AS (SELECT count(*) AS unseen_rows FROM te WHERE platform NOT IN (SELECT platform FROM tr))
""" + "UNION ALL\n".join(
    f"""SELECT '{c}' AS column, count(*) AS rows, count({c}) AS non_null, CAST(min({c}) AS DOUBLE) AS min,
       CAST(max({c}) AS DOUBLE) AS max, {sql_r(f'1 - count({c}) / count(*)', 9)} AS null_rate,
       (SELECT unseen_rows FROM u) AS unseen_rows FROM te
""" for c in ["engagement_rate", "donation_referrals", "caption_length"])


# Dashboard read -- supporters joined to their live score, high tier only -------------------
def q_dashboard_high_risk(spark, sf_dir):
    from civora.plans.io_queries import q_score_upsert
    live = q_score_upsert(spark, sf_dir).where(F.col("risk_tier") == "high")
    sup = standin(spark, sf_dir, "supporters").select("supporter_id", "region", "acquisition_channel")
    return sup.join(live, "supporter_id").select("supporter_id", "region", "acquisition_channel", "rule_score")


def _dashboard_sql():
    from civora.plans.io_queries import SCORE_UPSERT_SQL
    head, tail = SCORE_UPSERT_SQL.split("\nSELECT supporter_id, rule_score,\n", 1)
    return head + """
SELECT s.supporter_id, s.region, s.acquisition_channel, u.rule_score
FROM u JOIN supporters s ON s.supporter_id = u.supporter_id WHERE u.rule_score >= 0.7
"""


DASHBOARD_SQL = _dashboard_sql()


# Privacy rule -- log aggregates only ---------------------------------------------------
_log = logging.getLogger("civora")


def log_counts(df: DataFrame, by: list[str], label: str, min_group: int = 5) -> None:
    """Log group counts only; groups smaller than ``min_group`` are suppressed."""
    rows = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_group).collect()
    _log.info("%s: %s", label, [(tuple(r[c] for c in by), r["n"]) for r in rows])
