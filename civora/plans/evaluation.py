"""Registered evaluation queries (M1-M4, M19-M23, W9) on the churn and post tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from civora.functions.columns import round_half_up, sql_r
from civora.operators import evaluate as ev
from civora.plans.churn import _GAP_RAW, churn_features, churn_sql_with
from civora.plans.content import _CLEAN, clean_posts
from civora.sources.standins import standin


def _scored(spark, sf_dir):
    """Training population with a transparent rule score (ties included)."""
    df = churn_features(spark, sf_dir)
    score = F.least(F.lit(1.0), F.col("recency_days") / (F.col("avg_gap_days") * 4 + 1))
    return df.select("supporter_id", "churned", round_half_up(score, 3).alias("score"))


_SCORED_SQL = churn_sql_with(f"{_GAP_RAW} AS avg_gap_days_raw").replace(
    "\nSELECT a.supporter_id, s.supporter_type", """
, feat AS (SELECT a.supporter_id, s.supporter_type""", 1) + f""")
, sc AS (SELECT supporter_id, churned,
                {sql_r('least(1.0, recency_days / (avg_gap_days_raw * 4 + 1))', 3)} AS score
         FROM feat)
"""


def q_stratified_split(spark, sf_dir):
    s = ev.stratified_split(_scored(spark, sf_dir), "churned", "supporter_id", val_size=0.2)
    return s.select("supporter_id", "churned", "pos", "split", "fold")


STRATIFIED_SPLIT_SQL = _SCORED_SQL + """
, r AS (SELECT supporter_id, churned,
               row_number() OVER (PARTITION BY churned ORDER BY md5(concat('42', CAST(supporter_id AS VARCHAR))),
                                  supporter_id) AS pos,
               count(*) OVER (PARTITION BY churned) AS nc FROM sc)
SELECT supporter_id, churned, pos,
       CASE WHEN pos <= floor(nc * (1 - 0.2 - 0.2)) THEN 'train' WHEN pos <= floor(nc * 0.8) THEN 'val'
            ELSE 'test' END AS split,
       CAST((pos - 1) % 5 AS INTEGER) AS fold
FROM r
"""


def q_balanced_class_weights(spark, sf_dir):
    w = ev.balanced_weights(_scored(spark, sf_dir), "churned")
    return w.select("churned", "n_c", round_half_up("weight", 6).alias("weight"))


BALANCED_WEIGHTS_SQL = _SCORED_SQL + f"""
, c AS (SELECT churned, count(*) AS n_c FROM sc GROUP BY churned)
SELECT churned, n_c, {sql_r('(SELECT sum(n_c) FROM c) / ((SELECT count(*) FROM c) * n_c)')} AS weight FROM c
"""


def q_auc_rank_sum(spark, sf_dir):
    a = ev.auc(_scored(spark, sf_dir), "churned", "score")
    return a.select(round_half_up("auc", 9).alias("auc"), "n_pos", "n_neg")


AUC_SQL = _SCORED_SQL + f"""
, r AS (SELECT churned, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM sc)
SELECT {sql_r('(sum(rk) FILTER (WHERE churned = 1) - count(*) FILTER (WHERE churned = 1) * (count(*) FILTER (WHERE churned = 1) + 1) / 2.0) / (count(*) FILTER (WHERE churned = 1) * count(*) FILTER (WHERE churned <> 1))', 9)} AS auc,
       count(*) FILTER (WHERE churned = 1) AS n_pos, count(*) FILTER (WHERE churned <> 1) AS n_neg
FROM r
"""


def q_roc_points(spark, sf_dir):
    r = ev.roc_points(_scored(spark, sf_dir), "churned", "score")
    return r.select("threshold", *[round_half_up(c, 9).alias(c) for c in ["tpr", "fpr", "precision"]])


ROC_SQL = _SCORED_SQL + f"""
, c AS (SELECT score, count(*) FILTER (WHERE churned = 1) AS p, count(*) FILTER (WHERE churned <> 1) AS n
        FROM sc GROUP BY score)
, cu AS (SELECT score, sum(p) OVER (ORDER BY score DESC) AS cp, sum(n) OVER (ORDER BY score DESC) AS cn,
                sum(p) OVER () AS tp, sum(n) OVER () AS tn FROM c)
SELECT score AS threshold, {sql_r('cp / tp', 9)} AS tpr, {sql_r('cn / tn', 9)} AS fpr,
       {sql_r('cp / (cp + cn)', 9)} AS precision FROM cu
"""


def q_classification_report(spark, sf_dir):
    d = _scored(spark, sf_dir).withColumn("pred", (F.col("score") >= 0.5).cast("int"))
    r = ev.classification_report(d, "churned", "pred")
    return r.select("cls", *[round_half_up(c, 9).alias(c) for c in ["precision", "recall", "f1", "accuracy"]],
                    "support")


CLASSIFICATION_REPORT_SQL = _SCORED_SQL + f"""
, d AS (SELECT churned, CAST(score >= 0.5 AS INTEGER) AS pred FROM sc)
, cls AS (SELECT churned AS cls FROM d UNION SELECT pred FROM d)
, s AS (SELECT cls.cls, count(*) FILTER (WHERE d.churned = cls.cls AND d.pred = cls.cls) AS tp,
               count(*) FILTER (WHERE d.churned = cls.cls) AS support,
               count(*) FILTER (WHERE d.pred = cls.cls) AS pn FROM cls, d GROUP BY cls.cls)
, m AS (SELECT *, CASE WHEN pn = 0 THEN 0.0 ELSE tp / pn END AS pr,
               CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS rc FROM s)
SELECT cls, {sql_r('pr', 9)} AS precision, {sql_r('rc', 9)} AS recall,
       {sql_r('CASE WHEN pr + rc = 0 THEN 0.0 ELSE 2 * pr * rc / (pr + rc) END', 9)} AS f1,
       {sql_r('(SELECT count(*) FILTER (WHERE churned = pred) FROM d) / (SELECT count(*) FROM d)', 9)} AS accuracy,
       support
FROM m
"""


def q_confusion_matrix(spark, sf_dir):
    d = _scored(spark, sf_dir).withColumn("pred", (F.col("score") >= 0.4).cast("int"))
    return ev.confusion(d, "churned", "pred")


CONFUSION_SQL = _SCORED_SQL + """
SELECT churned AS actual, CAST(score >= 0.4 AS INTEGER) AS predicted, count(*) AS n FROM sc GROUP BY ALL
"""


def q_regression_metrics(spark, sf_dir):
    posts = clean_posts(standin(spark, sf_dir, "posts"))
    m = posts.groupBy("platform").agg(F.avg("donation_referrals").alias("yhat"))
    d = posts.join(m, "platform")
    r = ev.regression_metrics(d, "donation_referrals", "yhat")
    return r.select("n", *[round_half_up(c, 6).alias(c) for c in ["mae", "rmse", "r2"]])


REGRESSION_METRICS_SQL = _CLEAN + f"""
, m AS (SELECT platform, avg(donation_referrals) AS yhat FROM p GROUP BY platform)
, d AS (SELECT donation_referrals AS y, yhat FROM p JOIN m USING (platform))
SELECT count(*) AS n, {sql_r('avg(abs(y - yhat))')} AS mae, {sql_r('sqrt(avg((y - yhat) * (y - yhat)))')} AS rmse,
       {sql_r('1 - sum((y - yhat) * (y - yhat)) / (sum(y * y) - sum(y) * sum(y) / count(*))')} AS r2
FROM d
"""


def q_time_split(spark, sf_dir):
    posts = clean_posts(standin(spark, sf_dir, "posts"))
    s = ev.time_split(posts, "created_at", ["post_id", "donation_referrals", "engagement_rate"])
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                  F.sum("donation_referrals").alias("sum_referrals"),
                                  F.min("created_at").alias("first_ts"), F.max("created_at").alias("last_ts"))


TIME_SPLIT_SQL = _CLEAN + """
, r AS (SELECT *, row_number() OVER (ORDER BY created_at, post_id, donation_referrals, engagement_rate) AS pos,
               count(*) OVER () AS n FROM p)
SELECT CASE WHEN pos <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS split, count(*) AS n,
       sum(donation_referrals) AS sum_referrals, min(created_at) AS first_ts, max(created_at) AS last_ts
FROM r GROUP BY 1
"""
