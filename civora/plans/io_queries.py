"""Registered sink / source queries (IO2, IO3, IO4, IO7)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from civora.functions.columns import round_half_up, sql_r, tier
from civora.plans.churn import churn_features
from civora.session import scratch_path
from civora.sources.sinks import read_csv, unscored, upsert, write_csv
from civora.sources.standins import duck_cte, standin

OLD_AS_OF = "DATE '2001-01-01'"


def _rule_scores(spark, sf_dir, as_of):
    df = churn_features(spark, sf_dir, as_of=as_of, training=False, point_in_time=True)
    s = round_half_up(F.least(F.lit(1.0), F.col("recency_days") / (F.col("avg_gap_days") * 4 + 1)), 6)
    return df.select("supporter_id", s.alias("rule_score"), tier(s).alias("risk_tier"),
                     F.lit(as_of).alias("scored_as_of"))


def q_score_upsert(spark, sf_dir):
    """IO4: earlier snapshot upserted with fresh scores of recently active supporters."""
    old = _rule_scores(spark, sf_dir, OLD_AS_OF)
    recent = standin(spark, sf_dir, "donations").where(
        F.col("donation_date") >= F.expr("DATE '2001-08-02' - 180")).select("supporter_id").distinct()
    new = _rule_scores(spark, sf_dir, "DATE '2001-08-02'").join(recent, "supporter_id", "left_semi")
    return upsert(old, new, ["supporter_id"])


def _rule_sql(as_of):
    return f"""SELECT a.supporter_id,
      {sql_r(f"least(1.0, date_diff('day', a.last_d, {as_of}) / (greatest(date_diff('day', a.first_d, a.last_d), 0) / greatest(a.frequency - 1, 1) * 4 + 1))")} AS rule_score,
      '{as_of.replace("'", "''")}' AS scored_as_of
    FROM (SELECT supporter_id, count(donation_id) AS frequency, max(donation_date) AS last_d,
                 min(donation_date) AS first_d FROM donations WHERE donation_date < {as_of}
          GROUP BY supporter_id HAVING count(donation_id) >= 2) a
    JOIN supporters s ON a.supporter_id = s.supporter_id WHERE s.status = 'Active'"""


SCORE_UPSERT_SQL = duck_cte("supporters", "donations") + f"""
, o AS ({_rule_sql(OLD_AS_OF)})
, n AS ({_rule_sql("DATE '2001-08-02'")}
        AND a.supporter_id IN (SELECT supporter_id FROM donations
                               WHERE donation_date >= DATE '2001-08-02' - 180))
, u AS (SELECT COALESCE(n.supporter_id, o.supporter_id) AS supporter_id,
               CASE WHEN n.supporter_id IS NOT NULL THEN n.rule_score ELSE o.rule_score END AS rule_score,
               CASE WHEN n.supporter_id IS NOT NULL THEN n.scored_as_of ELSE o.scored_as_of END AS scored_as_of
        FROM o FULL OUTER JOIN n ON o.supporter_id = n.supporter_id)
SELECT supporter_id, rule_score,
       CASE WHEN rule_score >= 0.7 THEN 'high' WHEN rule_score >= 0.4 THEN 'medium' ELSE 'low' END AS risk_tier,
       scored_as_of
FROM u
"""


def q_unscored_append(spark, sf_dir):
    """IO7: supporters active now that the earlier snapshot did not score."""
    old = _rule_scores(spark, sf_dir, OLD_AS_OF)
    cand = _rule_scores(spark, sf_dir, "DATE '2001-08-02'")
    return unscored(cand, old, ["supporter_id"]).select("supporter_id", "rule_score")


UNSCORED_SQL = duck_cte("supporters", "donations") + f"""
, o AS ({_rule_sql(OLD_AS_OF)}), n AS ({_rule_sql("DATE '2001-08-02'")})
SELECT supporter_id, rule_score FROM n WHERE supporter_id NOT IN (SELECT supporter_id FROM o)
"""

DONATION_SCHEMA = ("donation_id BIGINT, supporter_id BIGINT, donation_type STRING, donation_date DATE, "
                   "is_recurring BOOLEAN, campaign_name STRING, channel_source STRING, amount DOUBLE, "
                   "estimated_value DOUBLE")


def q_csv_roundtrip(spark, sf_dir):
    """IO3 then IO2: write the donations as CSV to the shared scratch root, read back typed."""
    path = scratch_path(spark, "csv", uuid.uuid4().hex[:12], "donations")
    write_csv(standin(spark, sf_dir, "donations"), path)
    return read_csv(spark, path, DONATION_SCHEMA)


CSV_ROUNDTRIP_SQL = duck_cte("donations") + "SELECT * FROM donations"
