"""Stand-in mapping: the driver's tables re-shaped into the reference's schema.

The reference reads supporter / donation / allocation / case / post tables
that the test data does not have. Each stand-in below maps driver columns
onto those logical schemas (FIXTURES.md section A). The column expressions are
SQL text valid in both Spark and DuckDB, so the Spark plan and the DuckDB
oracle read identical inputs. Spark builds each stand-in as a lazy
DataFrame: projection + expression, no action, no collect.

Joins inside stand-ins:
* customer -> nation -> region: nation (25 rows) and region (5 rows) are
  fixed-size dimension tables, so they are broadcast.
* lineitem -> orders -> part: both sides grow with the data, so Spark is left
  to choose (sort-merge by default, AQE converts to broadcast only when the
  runtime size is under ``autoBroadcastJoinThreshold``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civora.sources.tables import read_table

# The integer carried in events.props ('{"k": n}').
K = "CAST(regexp_extract(props, '[0-9]+', 0) AS INT)"

ORDER_AS_OF = "DATE '2001-08-02'"     # day after the last order date
EVENT_AS_OF = "DATE '2024-01-31'"     # day after the last event


@dataclass(frozen=True)
class StandIn:
    name: str
    from_sql: str                      # DuckDB FROM/JOIN clause
    exprs: list[tuple[str, str]]       # (alias, expression)
    where: str | None = None
    group_by: list[str] = field(default_factory=list)


def _cols(pairs):
    return [(a, e) for a, e in pairs]


SUPPORTERS = StandIn(
    "supporters",
    "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
    _cols([
        ("supporter_id", "c_custkey"),
        ("supporter_type", "CASE WHEN c_acctbal >= 5000 THEN 'MajorDonor' "
                           "WHEN c_acctbal >= 0 THEN 'Individual' ELSE 'Organization' END"),
        ("relationship_type", "CASE WHEN c_custkey % 29 = 0 THEN 'PartnerOrganization' "
                              "WHEN n_regionkey = 1 THEN 'Local' ELSE 'International' END"),
        ("region", "r_name"),
        ("country", "n_name"),
        ("acquisition_channel", "c_mktsegment"),
        ("status", "CASE WHEN c_custkey % 97 = 0 THEN 'Deceased' "
                   "WHEN c_custkey % 11 = 0 THEN 'Inactive' ELSE 'Active' END"),
        ("created_at", "DATE '1994-06-01' + CAST(c_custkey % 300 AS INT)"),
    ]),
)

DONATIONS = StandIn(
    "donations",
    "orders",
    _cols([
        ("donation_id", "o_orderkey"),
        ("supporter_id", "o_custkey"),
        ("donation_type", "CASE WHEN o_orderstatus = 'P' THEN 'InKind' ELSE 'Monetary' END"),
        ("donation_date", "CAST(o_orderdate AS DATE)"),
        ("is_recurring", "o_orderpriority = '1-URGENT'"),
        ("campaign_name", "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL "
                          "ELSE o_orderpriority END"),
        ("channel_source", "o_orderstatus"),
        ("amount", "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END"),
        ("estimated_value", "o_totalprice / 2"),
    ]),
)

ALLOCATIONS = StandIn(
    "allocations",
    "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey",
    _cols([
        ("donation_id", "l_orderkey"),
        ("allocation_line", "l_linenumber"),
        ("supporter_id", "o_custkey"),
        ("site_id", "l_suppkey"),
        ("program_area", "CASE WHEN p_size <= 1 THEN 'LEGAL' ELSE p_type END"),
        ("amount_allocated", "l_extendedprice"),
        ("allocation_date", "CAST(l_shipdate AS DATE)"),
    ]),
)

SITE_MONTHLY_METRICS = StandIn(
    "site_monthly_metrics",
    "lineitem",
    _cols([
        ("site_id", "l_suppkey"),
        ("month_start", "CAST(date_trunc('month', l_shipdate) AS DATE)"),
        ("avg_education_progress", "avg(l_quantity)"),
        # order-independent mean: 2-dp inputs, sum rounded to 6 dp
        ("avg_health_score", "floor(sum(l_discount) * 1e6 + 0.5) / 1e6 / count(l_discount) * 100"),
        ("process_recording_count", "count(*)"),
        ("active_residents", "count(DISTINCT l_orderkey)"),
        ("incident_count", "CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT)"),
    ]),
    group_by=["l_suppkey", "CAST(date_trunc('month', l_shipdate) AS DATE)"],
)

SITES = StandIn("sites", "supplier", _cols([("site_id", "s_suppkey"), ("name", "s_name")]))

_RISK = ("CASE {x} WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'High' "
         "ELSE 'Critical' END")

CASES = StandIn(
    "cases",
    "customer WHERE c_custkey IN (SELECT user_id FROM events)",
    _cols([
        ("case_id", "c_custkey"),
        ("site_id", "c_nationkey"),
        ("case_status", "CASE WHEN c_custkey % 10 = 0 THEN 'Closed' ELSE 'Active' END"),
        ("case_category", "CASE WHEN c_custkey % 25 = 0 THEN 'Surrendered' "
                          "WHEN c_custkey % 23 = 0 THEN 'Abandoned' ELSE c_mktsegment END"),
        ("initial_risk_level", _RISK.format(x="c_nationkey % 4")),
        ("current_risk_level", "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE "
                               + _RISK.format(x="(c_custkey * 7 + c_nationkey) % 4") + " END"),
        ("reintegration_status", "CASE (c_custkey * 3 + 1) % 5 WHEN 0 THEN 'Not Started' "
                                 "WHEN 1 THEN 'In Progress' WHEN 2 THEN 'On Hold' "
                                 "WHEN 3 THEN 'Completed' ELSE 'In Progress' END"),
        ("reintegration_type", "CASE WHEN c_custkey % 2 = 0 THEN 'Family Reunification' "
                               "ELSE 'Independent Living' END"),
        ("date_of_admission", "DATE '2022-01-01' + CAST(c_custkey % 600 AS INT)"),
        ("present_age", "CASE WHEN c_custkey % 17 = 0 THEN 'unknown' ELSE "
                        "concat(CAST(6 + c_custkey % 14 AS STRING), ' Years ', "
                        "CAST(c_custkey % 12 AS STRING), ' months') END"),
        ("age_upon_admission", "concat(CAST(5 + c_custkey % 12 AS STRING), ' Years')"),
        ("length_of_stay", "CASE WHEN c_custkey % 19 = 0 THEN NULL "
                           "WHEN c_custkey % 7 = 0 THEN concat(CAST(c_custkey % 4 AS STRING), ' Year') "
                           "WHEN c_custkey % 5 = 0 THEN concat(CAST(c_custkey % 12 AS STRING), ' months') "
                           "WHEN c_custkey % 31 = 0 THEN 'n/a' "
                           "ELSE concat(CAST(c_custkey % 4 AS STRING), ' Years ', "
                           "CAST(c_custkey % 12 AS STRING), ' months') END"),
        ("assigned_worker", "concat('SW-', CAST(c_custkey % 9 AS STRING))"),
        ("is_pwd", "c_custkey % 31 = 0"),
        ("has_special_needs", "c_custkey % 9 = 2"),
        ("family_is_4ps", "c_custkey % 3 = 1"),
        ("family_solo_parent", "c_custkey % 5 = 2"),
        ("family_indigenous", "c_custkey % 10 = 7"),
        ("sub_cat_physical_abuse", "c_custkey % 2 = 1"),
        ("sub_cat_sexual_abuse", "c_custkey % 3 = 0"),
        ("sub_cat_trafficked", "c_custkey % 5 = 0"),
        ("sub_cat_osaec", "c_custkey % 7 = 0"),
        ("sub_cat_child_labor", "c_custkey % 11 = 0"),
        ("sub_cat_cicl", "c_custkey % 13 = 1"),
        ("sub_cat_at_risk", "c_custkey % 4 = 1"),
        ("sub_cat_orphaned", "c_custkey % 6 = 5"),
        ("sub_cat_street_child", "c_custkey % 8 = 3"),
        ("sub_cat_child_with_hiv", "c_custkey % 29 = 0"),
    ]),
)

HEALTH = StandIn(
    "health_records", "events",
    _cols([
        ("record_id", "event_id"),
        ("case_id", "user_id"),
        ("record_date", "CAST(ts AS DATE)"),
        ("general_health_score", "value"),
        ("nutrition_score", "value / 2"),
        ("sleep_quality_score", f"CAST({K} AS DOUBLE) / 10"),
        ("psychological_checkup_done", "event_id % 2 = 0"),
    ]),
    where="event_type = 'view'",
)

EDUCATION = StandIn(
    "education_records", "events",
    _cols([
        ("record_id", "event_id"),
        ("case_id", "user_id"),
        ("record_date", "CAST(ts AS DATE)"),
        ("progress_percent", "least(value, 100.0)"),
        ("attendance_rate", f"CAST({K} AS DOUBLE) / 100"),
        ("enrollment_status", f"CASE WHEN {K} % 3 = 1 THEN 'Dropped' ELSE 'Enrolled' END"),
        ("completion_status", f"CASE WHEN {K} % 10 = 0 THEN 'Completed' ELSE 'Ongoing' END"),
    ]),
    where="event_type = 'click'",
)

INCIDENTS = StandIn(
    "incidents", "events",
    _cols([
        ("incident_id", "event_id"),
        ("case_id", "user_id"),
        ("incident_date", "CAST(ts AS DATE)"),
        ("severity", "CASE WHEN value > 100 THEN 'High' WHEN value > 40 THEN 'Medium' ELSE 'Low' END"),
        ("resolved", "event_id % 2 = 0"),
    ]),
    where="event_type = 'error'",
)

SESSIONS = StandIn(
    "sessions", "events",
    _cols([
        ("recording_id", "event_id"),
        ("case_id", "user_id"),
        ("session_date", "CAST(ts AS DATE)"),
        ("worker", f"concat('SW-', CAST({K} % 9 AS STRING))"),
        ("session_type", f"CASE {K} % 3 WHEN 0 THEN 'Individual' WHEN 1 THEN 'Group' ELSE 'Mixed' END"),
        ("session_duration_minutes", f"30 + {K} % 60"),
        ("interventions_applied", f"CASE {K} % 5 WHEN 0 THEN 'Caring' WHEN 1 THEN 'Healing' "
                                  "WHEN 2 THEN 'Teaching' WHEN 3 THEN 'Legal Services' "
                                  "ELSE 'Counseling' END"),
        ("progress_noted", "event_id % 3 = 0"),
        ("concerns_flagged", "value > 100"),
        ("referral_made", f"{K} % 10 = 0"),
    ]),
    where="event_type = 'purchase'",
)

VISITS = StandIn(
    "visits", "events",
    _cols([
        ("visit_id", "event_id"),
        ("case_id", "user_id"),
        ("visit_date", "CAST(ts AS DATE)"),
        ("family_cooperation_level", f"CASE {K} % 5 WHEN 0 THEN 'Highly Cooperative' "
                                     "WHEN 1 THEN 'Cooperative' WHEN 2 THEN 'Neutral' "
                                     "WHEN 3 THEN 'Uncooperative' ELSE NULL END"),
        ("safety_concerns_noted", f"{K} % 7 = 0"),
        ("visit_outcome", "CASE WHEN value > 30 THEN 'Favorable' ELSE 'Unfavorable' END"),
    ]),
    where="event_type = 'signup'",
)

PLANS = StandIn(
    "plans", "events",
    _cols([
        ("plan_id", "event_id"),
        ("case_id", "user_id"),
        ("status", f"CASE {K} % 4 WHEN 0 THEN 'Achieved' WHEN 1 THEN 'Closed' "
                   "WHEN 2 THEN 'In Progress' ELSE 'Open' END"),
        ("target_date", f"CAST(ts AS DATE) + CAST({K} % 10 AS INT)"),
        ("updated_at", "ts"),
    ]),
    where="event_type = 'signup'",
)

_DAYS = ("CASE l_orderkey % 7 WHEN 0 THEN 'Monday' WHEN 1 THEN 'Tuesday' WHEN 2 THEN 'Wednesday' "
         "WHEN 3 THEN 'Thursday' WHEN 4 THEN 'Friday' WHEN 5 THEN 'Saturday' ELSE 'Sunday' END")

POSTS = StandIn(
    "posts",
    "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey",
    _cols([
        ("post_id", "l_orderkey * 10 + l_linenumber"),
        ("platform", "CASE p_type WHEN 'STANDARD' THEN 'Facebook' WHEN 'ECONOMY' THEN 'Instagram' "
                     "WHEN 'LARGE' THEN 'TikTok' WHEN 'PROMO' THEN 'WhatsApp' "
                     "WHEN 'SMALL' THEN 'LinkedIn' ELSE 'YouTube' END"),
        ("day_of_week", _DAYS),
        ("post_hour", "CAST(l_partkey % 24 AS INT)"),
        ("post_type", "CASE l_returnflag WHEN 'A' THEN 'ImpactStory' WHEN 'N' THEN 'Campaign' "
                      "ELSE 'EventPromotion' END"),
        ("media_type", "CASE p_size % 3 WHEN 0 THEN 'Photo' WHEN 1 THEN 'Video' ELSE 'Reel' END"),
        ("content_topic", "CASE o_orderstatus WHEN 'F' THEN 'Education' WHEN 'O' THEN 'Health' "
                          "ELSE 'Reintegration' END"),
        ("sentiment_tone", "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Urgent' "
                           "ELSE 'Hopeful' END"),
        ("has_call_to_action", "l_linenumber % 2 = 0"),
        ("call_to_action_type", "CASE WHEN l_linenumber % 2 = 0 THEN (CASE l_partkey % 3 "
                                "WHEN 0 THEN 'DonateNow' WHEN 1 THEN 'LearnMore' ELSE 'Share' END) "
                                "ELSE NULL END"),
        ("features_resident_story", "l_tax >= 0.04"),
        ("num_hashtags", "l_linenumber"),
        ("caption_length", "p_size * 10"),
        ("is_boosted", "CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_linestatus = 'F' END"),
        ("engagement_rate", "CASE WHEN l_suppkey % 97 = 0 THEN NULL ELSE l_discount END"),
        ("donation_referrals", "l_quantity"),
        ("estimated_donation_value", "l_extendedprice"),
        ("created_at", "l_shipdate"),
    ]),
)

STANDINS = {s.name: s for s in [SUPPORTERS, DONATIONS, ALLOCATIONS, SITE_MONTHLY_METRICS, SITES,
                                CASES, HEALTH, EDUCATION, INCIDENTS, SESSIONS, VISITS, PLANS,
                                POSTS]}


def _scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def standin(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy DataFrame of one stand-in table (logical schema of the reference)."""
    s = STANDINS[name]
    exprs = [f"{e} AS {a}" for a, e in s.exprs]
    if name == "supporters":
        base = (_scan(spark, sf_dir, "customer")
                .join(F.broadcast(_scan(spark, sf_dir, "nation")),
                      F.col("c_nationkey") == F.col("n_nationkey"))
                .join(F.broadcast(_scan(spark, sf_dir, "region")),
                      F.col("n_regionkey") == F.col("r_regionkey")))
        return base.selectExpr(*exprs)
    if name in ("allocations", "posts"):
        base = (_scan(spark, sf_dir, "lineitem")
                .join(_scan(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
                .join(_scan(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")))
        return base.selectExpr(*exprs)
    if name == "cases":
        users = _scan(spark, sf_dir, "events").select(F.col("user_id")).distinct()
        base = _scan(spark, sf_dir, "customer").join(
            users, F.col("c_custkey") == F.col("user_id"), "left_semi")
        return base.selectExpr(*exprs)
    if name == "site_monthly_metrics":
        li = _scan(spark, sf_dir, "lineitem")
        keyed = li.withColumn("_m", F.expr("CAST(date_trunc('month', l_shipdate) AS DATE)"))
        return (keyed.groupBy(F.col("l_suppkey").alias("site_id"), F.col("_m").alias("month_start"))
                .agg(F.avg("l_quantity").alias("avg_education_progress"),
                     (F.floor(F.sum("l_discount") * 1e6 + 0.5) / 1e6 / F.count("l_discount") * 100)
                     .alias("avg_health_score"),
                     F.count(F.lit(1)).alias("process_recording_count"),
                     F.count_distinct("l_orderkey").alias("active_residents"),
                     F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
                     .cast("bigint").alias("incident_count")))
    base = _scan(spark, sf_dir, s.from_sql.split()[0])
    if s.where:
        base = base.where(s.where)
    return base.selectExpr(*exprs)


def duck_cte(*names: str) -> str:
    """DuckDB ``WITH`` prefix defining the named stand-ins (for oracle SQL)."""
    parts = []
    for n in names:
        s = STANDINS[n]
        sel = ",\n    ".join(f"{e} AS {a}" for a, e in s.exprs)
        sql = f"{n} AS (\n  SELECT\n    {sel}\n  FROM {s.from_sql}"
        if s.where:
            sql += f"\n  WHERE {s.where}"
        if s.group_by:
            sql += "\n  GROUP BY " + ", ".join(s.group_by)
        parts.append(sql + "\n)")
    return "WITH " + ",\n".join(parts) + "\n"
