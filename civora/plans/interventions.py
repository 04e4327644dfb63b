"""Intervention job: windows, outcome deltas, clusters, recommendations.

The reference loops entity x chunk in Python and rescans three child tables
per chunk (O(entities x chunks x rows)). Here the whole job is one DAG:

* W2 chunking: exact per-case row numbers via (case, day) buckets.
* W3 summaries: one (case, chunk, field, value) count table -> min_by per field.
* J5 baselines: union-and-carry as-of; J6 follow-ups: per-(case, day) rollup
  equi-joined to anchor + 1..days. No range join, no nested loop.
* F18 clusters: level counts by aggregation, fall-back chosen with CASE.
* W4 / A17 / W5: group means, ``min_by`` / sorted arrays; no per-cluster loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civora.functions import constants as K
from civora.functions.columns import (det_avg, round_half_up, sql_det_avg, age_band, band_to_int, confidence_tier, partial_profile_label,
                                      profile_label, right_closed_bin)
from civora.operators.aggregates import argmax_mean, weighted_composite
from civora.operators.temporal import (anchor_asof, anchor_followup, chunk_sequences,
                                       daily_child_rollup)
from civora.sources.standins import EVENT_AS_OF, duck_cte, standin

# Events span 30 days, so the reference's 90-day follow-up is a parameter;
# queries use 7 days on the test tables.
FOLLOWUP_DAYS = 7
ROSTER_MONTHS = 12


def _sessions(spark, sf_dir):
    s = standin(spark, sf_dir, "sessions")
    sites = standin(spark, sf_dir, "cases").select("case_id", "site_id")
    return s.join(sites, "case_id")


def window_summaries(sessions: DataFrame) -> DataFrame:
    """W2 + W3: one row per (case, chunk)."""
    ch = chunk_sequences(sessions, "case_id", "session_date", "recording_id")
    base = ch.groupBy("case_id", "chunk").agg(
        F.count(F.lit(1)).alias("session_count"),
        F.min("session_date").alias("window_start"))
    # the three modes share one count table (one shuffle instead of three)
    long = ch.select("case_id", "chunk", F.expr(
        "stack(3, 'svc', interventions_applied, 'type', session_type, 'sw', worker) AS (_f, _v)"))
    counts = (long.where(F.col("_v").isNotNull()).groupBy("case_id", "chunk", "_f", "_v")
              .agg(F.count(F.lit(1)).alias("_n")))
    modes = (counts.groupBy("case_id", "chunk")
             .agg(*[F.min_by(F.when(F.col("_f") == f, F.col("_v")),
                             F.when(F.col("_f") == f, F.struct(-F.col("_n"), F.col("_v")))).alias(o)
                    for f, o in [("svc", "primary_service"), ("type", "dominant_session_type"),
                                 ("sw", "primary_sw")]]))
    return (base.join(modes, ["case_id", "chunk"], "left")
                .withColumn("sessions_per_month", F.col("session_count") / 3))


def outcome_deltas(spark: SparkSession, sf_dir: str, anchors: DataFrame,
                   days: int = FOLLOWUP_DAYS, anchor: str = "window_start") -> DataFrame:
    """J5 + J6 + A19 for each distinct (case_id, anchor date).

    The three child tables are rolled up into one (case, day) table (one
    shuffle); baselines and prior incident counts come from one window over
    that rollup, follow-up sums from one equi-join on (case, day).
    """
    keys = anchors.select("case_id", anchor).distinct()
    daily = daily_child_rollup({
        "h": (standin(spark, sf_dir, "health_records"), "record_date", "record_id",
              "general_health_score"),
        "e": (standin(spark, sf_dir, "education_records"), "record_date", "record_id",
              "progress_percent"),
        "i": (standin(spark, sf_dir, "incidents"), "incident_date", None, None),
    }, "case_id")
    base = anchor_asof(keys, daily, "case_id", anchor, ["h_last", "e_last"], ["i_n"])
    fu = anchor_followup(keys, daily, "case_id", anchor, days,
                         ["h_s", "h_nv", "e_s", "e_nv", "i_n"])
    on = ["case_id", anchor]
    # inputs carry <= 2 decimals: rounding the sums to 6 dp removes
    # summation-order noise, so results do not depend on partitioning
    h_mean = F.try_divide(F.round("h_s_fu", 6), F.col("h_nv_fu"))
    e_mean = F.try_divide(F.round("e_s_fu", 6), F.col("e_nv_fu"))
    d = keys.join(base, on, "left").join(fu, on, "left")
    return (d.withColumn("delta_health", h_mean - F.col("h_last_asof"))
             .withColumn("delta_edu", e_mean - F.col("e_last_asof"))
             .withColumn("delta_incidents",
                         (F.coalesce("i_n_fu", F.lit(0)) - F.coalesce("i_n_upto", F.lit(0)))
                         .cast("bigint"))
             .withColumn("_inc_component", -F.col("delta_incidents").cast("double"))
             .withColumn("composite_score_delta", weighted_composite(
                 [("delta_health", K.W_HEALTH), ("delta_edu", K.W_EDU),
                  ("_inc_component", K.W_INCIDENTS)]))
             .select(*on, "delta_health", "delta_edu", "delta_incidents", "composite_score_delta"))


def active_cases(spark, sf_dir) -> DataFrame:
    c = standin(spark, sf_dir, "cases").where(F.col("case_status") == "Active")
    return (c.withColumn("age_band", age_band("present_age"))
             .withColumn("full_label", profile_label())
             .withColumn("partial_label", partial_profile_label()))


def training_frame(spark: SparkSession, sf_dir: str, days: int = FOLLOWUP_DAYS) -> DataFrame:
    """One row per active case x session window with its composite outcome delta."""
    w = window_summaries(_sessions(spark, sf_dir))
    cases = active_cases(spark, sf_dir)
    w = w.join(cases.select("case_id", "site_id", "case_category", "current_risk_level",
                            "present_age", "age_band", "full_label", "partial_label"), "case_id")
    deltas = outcome_deltas(spark, sf_dir, w.select("case_id", "window_start"), days)
    return w.join(deltas, ["case_id", "window_start"], "left")


def assign_clusters(frame: DataFrame, sizes: DataFrame, min_size: int = K.MIN_CLUSTER_SIZE) -> DataFrame:
    """full label if its level count >= min_size, else partial, else risk level.

    ``sizes`` is (label, n). Its row count is bounded by construction: labels
    are built from fixed vocabularies -- 5 risk values (incl. None) x 2^6 flag
    subsets x 5 age bands full labels plus 5 x 2^6 partial labels, at most
    1,920 rows whatever the data size -- so it is broadcast directly.
    """
    s = F.broadcast(sizes.select(F.col("label"), F.col("n")))
    full = s.select(F.col("label").alias("full_label"), F.col("n").alias("_nf"))
    part = s.select(F.col("label").alias("partial_label"), F.col("n").alias("_np"))
    return (frame.join(full, "full_label", "left").join(part, "partial_label", "left")
                 .withColumn("profile_cluster",
                             F.when(F.coalesce("_nf", F.lit(0)) >= min_size, F.col("full_label"))
                              .when(F.coalesce("_np", F.lit(0)) >= min_size, F.col("partial_label"))
                              .otherwise(F.col("current_risk_level")))
                 .drop("_nf", "_np"))


def level_counts(frame: DataFrame) -> DataFrame:
    """Window counts per full label and per partial label (proper F18 counts)."""
    return (frame.select(F.explode(F.array("full_label", "partial_label")).alias("label"))
                 .groupBy("label").agg(F.count(F.lit(1)).alias("n")))


def clustered_training_frame(spark, sf_dir, days: int = FOLLOWUP_DAYS) -> DataFrame:
    from civora.operators.joins import materialize
    tf = materialize(training_frame(spark, sf_dir, days))
    return assign_clusters(tf, level_counts(tf))


def cluster_recommendations(tf: DataFrame) -> DataFrame:
    """W4 + A17 + P21 + Q24: one row per cluster (the fitted 'model')."""
    tf = tf.where(F.col("profile_cluster").isNotNull())
    valid = tf.where(F.col("composite_score_delta").isNotNull())
    size = tf.groupBy("profile_cluster").agg(
        F.count(F.lit(1)).alias("cluster_size"),
        F.count_distinct("case_id").alias("similar_case_count"))
    svc = (valid.groupBy("profile_cluster", "primary_service")
           .agg(F.avg("composite_score_delta").alias("_m"))
           .where(F.col("primary_service").isNotNull())
           .groupBy("profile_cluster")
           .agg(F.sort_array(F.collect_list(F.struct(-F.col("_m"), F.col("primary_service"))))
                .alias("_ranked"))
           .select("profile_cluster",
                   F.transform("_ranked", lambda s: s["primary_service"]).alias("recommended_services")))
    stype = argmax_mean(valid, ["profile_cluster"], "dominant_session_type",
                        "composite_score_delta", "recommended_session_type")
    band = argmax_mean(valid.withColumn("_band", right_closed_bin("sessions_per_month")),
                       ["profile_cluster"], "_band", "composite_score_delta", "sessions_per_month_band")
    means = valid.groupBy("profile_cluster").agg(
        det_avg("delta_health").alias("predicted_health_improvement"),
        det_avg("delta_edu").alias("predicted_education_improvement"))
    return (size.join(svc, "profile_cluster", "left").join(stype, "profile_cluster", "left")
                .join(band, "profile_cluster", "left").join(means, "profile_cluster", "left")
                .withColumn("recommended_services",
                            F.coalesce("recommended_services", F.array().cast("array<string>")))
                .withColumn("sessions_per_month_band",
                            F.coalesce("sessions_per_month_band", F.lit(K.FREQ_BAND_DEFAULT))))


def worker_roster(spark, sf_dir, as_of: str = EVENT_AS_OF, months: int = ROSTER_MONTHS,
                  min_sessions: int = K.ROSTER_MIN_SESSIONS) -> DataFrame:
    """(site, worker) with >= min_sessions sessions in the last ``months``."""
    s = _sessions(spark, sf_dir)
    cutoff = F.add_months(F.expr(as_of), -months)
    return (s.where(F.col("session_date") >= cutoff).groupBy("site_id", "worker")
             .agg(F.count(F.lit(1)).alias("session_count"))
             .where(F.col("session_count") >= min_sessions))


def best_workers(tf: DataFrame, roster: DataFrame) -> DataFrame:
    """W5 (ranked form): per (cluster, site) the roster worker with the best mean outcome."""
    valid = tf.where(F.col("composite_score_delta").isNotNull())
    j = valid.join(roster.select("site_id", F.col("worker").alias("primary_sw")),
                   ["site_id", "primary_sw"], "left_semi")
    m = j.groupBy("profile_cluster", "site_id", "primary_sw").agg(
        det_avg("composite_score_delta").alias("_m"))        # order-independent mean
    return m.groupBy("profile_cluster", "site_id").agg(
        F.min_by(F.col("primary_sw"), F.struct(-F.col("_m"), F.col("primary_sw")))
         .alias("recommended_worker"),
        round_half_up(F.max("_m"), 3).alias("worker_outcome_score"))


def outcome_factors(cluster, services, stype, band, worker, score, size):
    """Up to three sentences, fallback sentence when none apply."""
    s1 = F.when(F.size(services) > 0, F.concat(
        services[0], F.lit(" sessions show the strongest composite improvements "
                           "for residents in the '"), cluster, F.lit("' profile")))
    s2 = F.when(stype.isNotNull() & band.isNotNull(), F.concat(
        stype, F.lit(" sessions at ~"), band, F.lit(" per month outperform other formats "
                                                    "for this profile")))
    s3 = F.when(worker.isNotNull() & score.isNotNull(), F.concat(
        worker, F.lit(" has the highest average composite outcome improvement for similar "
                      "profiles at this safehouse (score: "),
        F.format_string("%.2f", round_half_up(score, 2)), F.lit(")")))
    arr = F.filter(F.array(s1, s2, s3), lambda x: x.isNotNull())
    fallback = F.array(F.concat(F.lit("Based on "), size.cast("string"),
                                F.lit(" similar residents in the '"),
                                F.coalesce(cluster, F.lit("None")), F.lit("' cluster")))
    return F.when(F.size(arr) == 0, fallback).otherwise(F.slice(arr, 1, 3))


def recommendations(spark: SparkSession, sf_dir: str, days: int = FOLLOWUP_DAYS) -> DataFrame:
    """Scoring half of X10: every active case gets its cluster's recommendation."""
    tf = clustered_training_frame(spark, sf_dir, days)
    recs = cluster_recommendations(tf)          # one row per cluster (bounded as above)
    sizes = recs.select(F.col("profile_cluster").alias("label"), F.col("cluster_size").alias("n"))
    cases = assign_clusters(active_cases(spark, sf_dir), sizes)
    workers = best_workers(tf, worker_roster(spark, sf_dir))
    out = (cases.select("case_id", "site_id", "profile_cluster")
           .join(recs, "profile_cluster", "left")
           .join(workers, ["profile_cluster", "site_id"], "left")
           .withColumn("similar_resident_count", F.coalesce("cluster_size", F.lit(0)).cast("bigint"))
           .withColumn("recommended_services",
                       F.coalesce("recommended_services", F.array().cast("array<string>")))
           .withColumn("sessions_per_month_band",
                       F.coalesce("sessions_per_month_band", F.lit(K.FREQ_BAND_DEFAULT))))
    return out.select(
        "case_id", "profile_cluster",
        F.array_join("recommended_services", "|").alias("recommended_services"),
        "recommended_session_type",
        band_to_int("sessions_per_month_band").alias("recommended_sessions_per_month"),
        "recommended_worker", "worker_outcome_score",
        round_half_up("predicted_health_improvement", 6).alias("predicted_health_improvement"),
        round_half_up("predicted_education_improvement", 6).alias("predicted_education_improvement"),
        "similar_resident_count",
        confidence_tier("similar_resident_count").alias("confidence_tier"),
        F.array_join(outcome_factors(F.col("profile_cluster"), F.col("recommended_services"),
                                     F.col("recommended_session_type"),
                                     F.col("sessions_per_month_band"), F.col("recommended_worker"),
                                     F.col("worker_outcome_score"),
                                     F.col("similar_resident_count")), " || ")
        .alias("top_outcome_factors"))


# ---------------------------------------------------------------------------
# Registered query shapes (rounded for cross-engine comparison)
# ---------------------------------------------------------------------------

def q_session_windows(spark, sf_dir):
    w = window_summaries(_sessions(spark, sf_dir))
    return w.select("case_id", "chunk", "session_count", "window_start", "primary_service",
                    "dominant_session_type", "primary_sw",
                    round_half_up("sessions_per_month", 4).alias("sessions_per_month"))


def q_asof_followup_delta(spark, sf_dir):
    tf = training_frame(spark, sf_dir)
    return tf.select("case_id", "chunk", "window_start",
                     round_half_up("delta_health", 6).alias("delta_health"),
                     round_half_up("delta_edu", 6).alias("delta_edu"), "delta_incidents",
                     round_half_up("composite_score_delta", 6).alias("composite_score_delta"))


def q_cluster_assignment(spark, sf_dir):
    tf = clustered_training_frame(spark, sf_dir)
    return tf.select("case_id", "chunk", "age_band", "full_label", "partial_label",
                     "profile_cluster")


def q_cluster_recommendations(spark, sf_dir):
    r = cluster_recommendations(clustered_training_frame(spark, sf_dir))
    return r.select("profile_cluster", "cluster_size", "similar_case_count",
                    F.array_join("recommended_services", "|").alias("recommended_services"),
                    "recommended_session_type", "sessions_per_month_band",
                    round_half_up("predicted_health_improvement", 6).alias("predicted_health_improvement"),
                    round_half_up("predicted_education_improvement", 6)
                    .alias("predicted_education_improvement"))


def q_worker_roster(spark, sf_dir):
    return worker_roster(spark, sf_dir)


def q_intervention_recommendations(spark, sf_dir):
    return recommendations(spark, sf_dir)


def q_session_outcome_deltas(spark, sf_dir):
    """X11: deltas anchored at every session (not per window)."""
    s = _sessions(spark, sf_dir)
    d = outcome_deltas(spark, sf_dir, s.select("case_id", F.col("session_date")), anchor="session_date")
    return (s.select("recording_id", "case_id", "session_date", "interventions_applied")
             .join(d, ["case_id", "session_date"], "left")
             .select("recording_id", "case_id", "session_date", "interventions_applied",
                     round_half_up("composite_score_delta", 6).alias("composite_score_delta"),
                     "delta_incidents"))


# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------

_FLAG_SQL = ("CASE WHEN concat_ws(' · ', "
             + ", ".join(f"CASE WHEN {c} THEN '{lbl}' END" for c, lbl in K.ABUSE_FLAG_LABELS)
             + ") = '' THEN 'No Sub-type' ELSE concat_ws(' · ', "
             + ", ".join(f"CASE WHEN {c} THEN '{lbl}' END" for c, lbl in K.ABUSE_FLAG_LABELS)
             + ") END")
_AGE_TOKEN = "split_part(trim(COALESCE(present_age, '')), ' ', 1)"
_AGE_SQL = (f"CASE WHEN NOT regexp_matches({_AGE_TOKEN}, '^[+-]?[0-9]{{1,9}}$') THEN 'Unknown' "
            f"WHEN CAST({_AGE_TOKEN} AS INTEGER) < 10 THEN 'Under 10' "
            f"WHEN CAST({_AGE_TOKEN} AS INTEGER) <= 13 THEN '10–13' "
            f"WHEN CAST({_AGE_TOKEN} AS INTEGER) <= 17 THEN '14–17' ELSE '18+' END")

_TRAIN_SQL = duck_cte("cases", "sessions", "health_records", "education_records", "incidents") + f"""
, s AS (
  SELECT x.*, c.site_id,
         row_number() OVER (PARTITION BY x.case_id ORDER BY session_date, recording_id) AS pos,
         count(*) OVER (PARTITION BY x.case_id) AS n
  FROM sessions x JOIN cases c ON x.case_id = c.case_id
), ch AS (
  SELECT *, CAST(floor((pos - 1) / greatest(1, floor(n / 3))) AS INTEGER) AS chunk FROM s
), m AS (
  SELECT case_id, chunk, f, v FROM (
    SELECT case_id, chunk, f, v, row_number() OVER (PARTITION BY case_id, chunk, f
                                                    ORDER BY cnt DESC, v) AS r
    FROM (SELECT case_id, chunk, f, v, count(*) AS cnt FROM (
            SELECT case_id, chunk, 'svc' AS f, interventions_applied AS v FROM ch
            UNION ALL SELECT case_id, chunk, 'type', session_type FROM ch
            UNION ALL SELECT case_id, chunk, 'sw', worker FROM ch) WHERE v IS NOT NULL
          GROUP BY ALL)) WHERE r = 1
), w AS (
  SELECT case_id, chunk, count(*) AS session_count, min(session_date) AS window_start,
         count(*) / 3 AS sessions_per_month
  FROM ch GROUP BY case_id, chunk
), ws AS (
  SELECT w.*,
    (SELECT v FROM m WHERE m.case_id = w.case_id AND m.chunk = w.chunk AND f = 'svc') AS primary_service,
    (SELECT v FROM m WHERE m.case_id = w.case_id AND m.chunk = w.chunk AND f = 'type') AS dominant_session_type,
    (SELECT v FROM m WHERE m.case_id = w.case_id AND m.chunk = w.chunk AND f = 'sw') AS primary_sw
  FROM w
), ac AS (
  SELECT *, {_AGE_SQL} AS age_band,
         concat(COALESCE(current_risk_level, 'None'), ' · ', {_FLAG_SQL}, ' · Age ', {_AGE_SQL}) AS full_label,
         concat(COALESCE(current_risk_level, 'None'), ' · ', {_FLAG_SQL}) AS partial_label
  FROM cases WHERE case_status = 'Active'
), tf0 AS (
  SELECT ws.*, ac.site_id, ac.current_risk_level, ac.age_band, ac.full_label, ac.partial_label
  FROM ws JOIN ac ON ws.case_id = ac.case_id
), an AS (SELECT DISTINCT case_id, window_start AS d FROM tf0
), hb AS (
  SELECT an.case_id, an.d, arg_max(h.general_health_score, (h.record_date, h.record_id)) AS h_base
  FROM an JOIN health_records h ON h.case_id = an.case_id AND h.record_date <= an.d GROUP BY ALL
), hf AS (
  SELECT an.case_id, an.d, round(sum(h.general_health_score), 6) / count(h.general_health_score) AS h_fu
  FROM an JOIN health_records h ON h.case_id = an.case_id AND h.record_date > an.d
       AND h.record_date <= an.d + {FOLLOWUP_DAYS} GROUP BY ALL
), eb AS (
  SELECT an.case_id, an.d, arg_max(e.progress_percent, (e.record_date, e.record_id)) AS e_base
  FROM an JOIN education_records e ON e.case_id = an.case_id AND e.record_date <= an.d GROUP BY ALL
), ef AS (
  SELECT an.case_id, an.d, round(sum(e.progress_percent), 6) / count(e.progress_percent) AS e_fu
  FROM an JOIN education_records e ON e.case_id = an.case_id AND e.record_date > an.d
       AND e.record_date <= an.d + {FOLLOWUP_DAYS} GROUP BY ALL
), ic AS (
  SELECT an.case_id, an.d,
         count(CASE WHEN i.incident_date > an.d AND i.incident_date <= an.d + {FOLLOWUP_DAYS} THEN 1 END)
       - count(CASE WHEN i.incident_date <= an.d THEN 1 END) AS delta_incidents
  FROM an LEFT JOIN incidents i ON i.case_id = an.case_id GROUP BY ALL
), dl AS (
  SELECT an.case_id, an.d, hf.h_fu - hb.h_base AS delta_health, ef.e_fu - eb.e_base AS delta_edu,
         CAST(ic.delta_incidents AS BIGINT) AS delta_incidents
  FROM an LEFT JOIN hb USING (case_id, d) LEFT JOIN hf USING (case_id, d)
          LEFT JOIN eb USING (case_id, d) LEFT JOIN ef USING (case_id, d)
          LEFT JOIN ic USING (case_id, d)
), tf AS (
  SELECT tf0.*, dl.delta_health, dl.delta_edu, dl.delta_incidents,
         (COALESCE(dl.delta_health * 0.4, 0) + COALESCE(dl.delta_edu * 0.35, 0)
          + COALESCE(-dl.delta_incidents * 0.25, 0))
         / (CASE WHEN dl.delta_health IS NOT NULL THEN 0.4 ELSE 0 END
            + CASE WHEN dl.delta_edu IS NOT NULL THEN 0.35 ELSE 0 END + 0.25) AS composite_score_delta
  FROM tf0 LEFT JOIN dl ON tf0.case_id = dl.case_id AND tf0.window_start = dl.d
), lc AS (
  SELECT label, count(*) AS n FROM (SELECT full_label AS label FROM tf UNION ALL
                                    SELECT partial_label FROM tf) GROUP BY label
), ctf AS (
  SELECT tf.*, CASE WHEN COALESCE(f.n, 0) >= 5 THEN tf.full_label
                    WHEN COALESCE(p.n, 0) >= 5 THEN tf.partial_label
                    ELSE tf.current_risk_level END AS profile_cluster
  FROM tf LEFT JOIN lc f ON f.label = tf.full_label LEFT JOIN lc p ON p.label = tf.partial_label
)
"""

SESSION_WINDOWS_SQL = _TRAIN_SQL + """
SELECT case_id, chunk, session_count, window_start, primary_service, dominant_session_type,
       primary_sw, floor(sessions_per_month * 1e4 + 0.5) / 1e4 AS sessions_per_month FROM ws
"""

ASOF_FOLLOWUP_SQL = _TRAIN_SQL + """
SELECT case_id, chunk, window_start, floor(delta_health * 1e6 + 0.5) / 1e6 AS delta_health,
       floor(delta_edu * 1e6 + 0.5) / 1e6 AS delta_edu, delta_incidents,
       floor(composite_score_delta * 1e6 + 0.5) / 1e6 AS composite_score_delta FROM tf
"""

CLUSTER_ASSIGNMENT_SQL = _TRAIN_SQL + """
SELECT case_id, chunk, age_band, full_label, partial_label, profile_cluster FROM ctf
"""

_RECS_SQL = _TRAIN_SQL + f"""
, v AS (SELECT * FROM ctf WHERE composite_score_delta IS NOT NULL AND profile_cluster IS NOT NULL)
, sz AS (SELECT profile_cluster, count(*) AS cluster_size, count(DISTINCT case_id) AS similar_case_count
         FROM ctf WHERE profile_cluster IS NOT NULL GROUP BY profile_cluster)
, svc AS (SELECT profile_cluster, string_agg(primary_service, '|' ORDER BY m DESC, primary_service) AS recommended_services
          FROM (SELECT profile_cluster, primary_service, avg(composite_score_delta) AS m FROM v
                WHERE primary_service IS NOT NULL GROUP BY ALL) GROUP BY profile_cluster)
, st AS (SELECT profile_cluster, arg_min(dominant_session_type, (-m, dominant_session_type)) AS recommended_session_type
         FROM (SELECT profile_cluster, dominant_session_type, avg(composite_score_delta) AS m FROM v
               WHERE dominant_session_type IS NOT NULL GROUP BY ALL) GROUP BY profile_cluster)
, bd AS (SELECT profile_cluster, arg_min(band, (-m, band)) AS sessions_per_month_band
         FROM (SELECT profile_cluster, band, avg(composite_score_delta) AS m FROM (
                 SELECT *, CASE WHEN sessions_per_month > 0 AND sessions_per_month <= 3 THEN '1–3'
                                WHEN sessions_per_month > 3 AND sessions_per_month <= 6 THEN '4–6'
                                WHEN sessions_per_month > 6 AND sessions_per_month <= 99 THEN '7+' END AS band
                 FROM v) WHERE band IS NOT NULL GROUP BY ALL) GROUP BY profile_cluster)
, mn AS (SELECT profile_cluster, {sql_det_avg('delta_health')} AS ph, {sql_det_avg('delta_edu')} AS pe FROM v GROUP BY profile_cluster)
, recs AS (
  SELECT sz.*, COALESCE(svc.recommended_services, '') AS recommended_services,
         st.recommended_session_type, COALESCE(bd.sessions_per_month_band, '4–6') AS sessions_per_month_band,
         mn.ph AS predicted_health_improvement, mn.pe AS predicted_education_improvement
  FROM sz LEFT JOIN svc USING (profile_cluster) LEFT JOIN st USING (profile_cluster)
          LEFT JOIN bd USING (profile_cluster) LEFT JOIN mn USING (profile_cluster)
)
"""

CLUSTER_RECS_SQL = _RECS_SQL + """
SELECT profile_cluster, cluster_size, similar_case_count, recommended_services,
       recommended_session_type, sessions_per_month_band,
       floor(predicted_health_improvement * 1e6 + 0.5) / 1e6 AS predicted_health_improvement,
       floor(predicted_education_improvement * 1e6 + 0.5) / 1e6 AS predicted_education_improvement
FROM recs
"""

WORKER_ROSTER_SQL = duck_cte("cases", "sessions") + f"""
SELECT c.site_id, s.worker, count(*) AS session_count
FROM sessions s JOIN cases c ON s.case_id = c.case_id
WHERE s.session_date >= CAST({EVENT_AS_OF} - INTERVAL 12 MONTH AS DATE)
GROUP BY ALL HAVING count(*) >= 3
"""

INTERVENTION_RECS_SQL = _RECS_SQL + f"""
, roster AS (
  SELECT c.site_id, s.worker FROM sessions s JOIN cases c ON s.case_id = c.case_id
  WHERE s.session_date >= CAST({EVENT_AS_OF} - INTERVAL 12 MONTH AS DATE)
  GROUP BY ALL HAVING count(*) >= 3
), wk AS (
  SELECT profile_cluster, site_id, arg_min(primary_sw, (-m, primary_sw)) AS recommended_worker,
         floor(max(m) * 1e3 + 0.5) / 1e3 AS worker_outcome_score
  FROM (SELECT v.profile_cluster, v.site_id, v.primary_sw, {sql_det_avg('v.composite_score_delta')} AS m
        FROM v WHERE EXISTS (SELECT 1 FROM roster r WHERE r.site_id = v.site_id AND r.worker = v.primary_sw)
        GROUP BY ALL) GROUP BY ALL
), sc AS (
  SELECT ac.case_id, ac.site_id,
         CASE WHEN COALESCE(f.cluster_size, 0) >= 5 THEN ac.full_label
              WHEN COALESCE(p.cluster_size, 0) >= 5 THEN ac.partial_label
              ELSE ac.current_risk_level END AS profile_cluster
  FROM ac LEFT JOIN recs f ON f.profile_cluster = ac.full_label
          LEFT JOIN recs p ON p.profile_cluster = ac.partial_label
), j AS (
  SELECT sc.case_id, sc.profile_cluster, COALESCE(r.recommended_services, '') AS recommended_services,
         r.recommended_session_type, COALESCE(r.sessions_per_month_band, '4–6') AS band,
         wk.recommended_worker, wk.worker_outcome_score,
         r.predicted_health_improvement, r.predicted_education_improvement,
         CAST(COALESCE(r.cluster_size, 0) AS BIGINT) AS n
  FROM sc LEFT JOIN recs r ON r.profile_cluster = sc.profile_cluster
          LEFT JOIN wk ON wk.profile_cluster = sc.profile_cluster AND wk.site_id = sc.site_id
), fs AS (
  SELECT *, list_filter([
      CASE WHEN recommended_services <> '' THEN split_part(recommended_services, '|', 1)
        || ' sessions show the strongest composite improvements for residents in the '''
        || profile_cluster || ''' profile' END,
      CASE WHEN recommended_session_type IS NOT NULL THEN recommended_session_type || ' sessions at ~'
        || band || ' per month outperform other formats for this profile' END,
      CASE WHEN recommended_worker IS NOT NULL AND worker_outcome_score IS NOT NULL THEN recommended_worker
        || ' has the highest average composite outcome improvement for similar profiles at this safehouse (score: '
        || printf('%.2f', floor(worker_outcome_score * 100 + 0.5) / 100) || ')' END], lambda x: x IS NOT NULL) AS arr
  FROM j
)
SELECT case_id, profile_cluster, recommended_services, recommended_session_type,
       CASE band WHEN '1–3' THEN 2 WHEN '4–6' THEN 5 WHEN '7+' THEN 8 ELSE 5 END AS recommended_sessions_per_month,
       recommended_worker, worker_outcome_score,
       floor(predicted_health_improvement * 1e6 + 0.5) / 1e6 AS predicted_health_improvement,
       floor(predicted_education_improvement * 1e6 + 0.5) / 1e6 AS predicted_education_improvement,
       n AS similar_resident_count,
       CASE WHEN n >= 15 THEN 'high' WHEN n >= 5 THEN 'medium' ELSE 'low' END AS confidence_tier,
       CASE WHEN len(arr) = 0 THEN 'Based on ' || CAST(n AS VARCHAR) || ' similar residents in the '''
              || COALESCE(profile_cluster, 'None') || ''' cluster'
            ELSE array_to_string(arr[1:3], ' || ') END AS top_outcome_factors
FROM fs
"""

SESSION_OUTCOME_SQL = duck_cte("cases", "sessions", "health_records", "education_records",
                               "incidents") + f"""
, s AS (SELECT x.* FROM sessions x JOIN cases c ON x.case_id = c.case_id)
, an AS (SELECT DISTINCT case_id, session_date AS d FROM s)
, hb AS (SELECT an.case_id, an.d, arg_max(h.general_health_score, (h.record_date, h.record_id)) AS hb
         FROM an JOIN health_records h ON h.case_id = an.case_id AND h.record_date <= an.d GROUP BY ALL)
, hf AS (SELECT an.case_id, an.d, round(sum(h.general_health_score), 6) / count(h.general_health_score) AS hf FROM an JOIN health_records h
         ON h.case_id = an.case_id AND h.record_date > an.d AND h.record_date <= an.d + {FOLLOWUP_DAYS} GROUP BY ALL)
, eb AS (SELECT an.case_id, an.d, arg_max(e.progress_percent, (e.record_date, e.record_id)) AS eb
         FROM an JOIN education_records e ON e.case_id = an.case_id AND e.record_date <= an.d GROUP BY ALL)
, ef AS (SELECT an.case_id, an.d, round(sum(e.progress_percent), 6) / count(e.progress_percent) AS ef FROM an JOIN education_records e
         ON e.case_id = an.case_id AND e.record_date > an.d AND e.record_date <= an.d + {FOLLOWUP_DAYS} GROUP BY ALL)
, ic AS (SELECT an.case_id, an.d,
           count(CASE WHEN i.incident_date > an.d AND i.incident_date <= an.d + {FOLLOWUP_DAYS} THEN 1 END)
         - count(CASE WHEN i.incident_date <= an.d THEN 1 END) AS di
         FROM an LEFT JOIN incidents i ON i.case_id = an.case_id GROUP BY ALL)
, dl AS (SELECT an.case_id, an.d, hf.hf - hb.hb AS dh, ef.ef - eb.eb AS de, CAST(ic.di AS BIGINT) AS di
         FROM an LEFT JOIN hb USING (case_id, d) LEFT JOIN hf USING (case_id, d)
         LEFT JOIN eb USING (case_id, d) LEFT JOIN ef USING (case_id, d) LEFT JOIN ic USING (case_id, d))
SELECT s.recording_id, s.case_id, s.session_date, s.interventions_applied,
       floor((COALESCE(dh * 0.4, 0) + COALESCE(de * 0.35, 0) + COALESCE(-di * 0.25, 0))
             / (CASE WHEN dh IS NOT NULL THEN 0.4 ELSE 0 END + CASE WHEN de IS NOT NULL THEN 0.35 ELSE 0 END
                + 0.25) * 1e6 + 0.5) / 1e6 AS composite_score_delta,
       di AS delta_incidents
FROM s LEFT JOIN dl ON s.case_id = dl.case_id AND s.session_date = dl.d
"""
