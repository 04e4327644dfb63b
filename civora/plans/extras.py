"""More job reports: coverage (A23), recommendation lift (A24), row concerns (P39),
OLS diagnostics (S4-S10, S18), model gap flags (X3), versioned output (IO5/IO6), k-means (M32)."""

from __future__ import annotations

from pyspark.sql import functions as F

from civora.functions import constants as K
from civora.functions.columns import round_half_up, rule_factors, sql_r
from civora.plans import case_risk as cr
from civora.plans import interventions as iv
from civora.plans.attribution import IMPACT_STATEMENTS_SQL, q_impact_statements
from civora.sources.standins import EVENT_AS_OF, standin


# Statement coverage -------------------------------------------------------------
def q_statement_coverage(spark, sf_dir, threshold: float = K.STATEMENT_COVERAGE_MIN):
    from civora.plans.attribution import outcome_statements, statement_outcomes
    alloc = statement_outcomes(spark, sf_dir)
    st = outcome_statements(alloc, standin(spark, sf_dir, "sites")).select("supporter_id").distinct()
    allsup = alloc.select("supporter_id").distinct()
    cov = allsup.join(st.withColumn("_has", F.lit(1)), "supporter_id", "left").agg(
        F.count(F.lit(1)).alias("supporters"), F.count("_has").alias("with_statement"))
    r = F.col("with_statement") / F.col("supporters")
    return cov.select("supporters", "with_statement", round_half_up(r, 9).alias("coverage"),
                      (r < threshold).alias("below_target"))


STATEMENT_COVERAGE_SQL = IMPACT_STATEMENTS_SQL.split("\nSELECT supporter_id, site_id, program_area")[0] + f"""
, t AS (SELECT count(DISTINCT supporter_id) AS supporters FROM j)
, w AS (SELECT count(DISTINCT supporter_id) AS with_statement FROM x)
SELECT supporters, with_statement, {sql_r('with_statement / supporters', 9)} AS coverage,
       with_statement / supporters < {K.STATEMENT_COVERAGE_MIN} AS below_target FROM t, w
"""


# Recommendation lift (top service vs the rest, per cluster) -----------------------------
def q_recommendation_lift(spark, sf_dir):
    tf = iv.clustered_training_frame(spark, sf_dir)
    recs = iv.cluster_recommendations(tf).select(
        "profile_cluster", F.element_at("recommended_services", 1).alias("top_service"))
    v = tf.where(F.col("composite_score_delta").isNotNull() & F.col("profile_cluster").isNotNull())
    j = v.join(recs, "profile_cluster")
    top = F.col("primary_service") == F.col("top_service")
    g = j.groupBy("profile_cluster").agg(
        F.avg(F.when(top, F.col("composite_score_delta"))).alias("top_mean"),
        F.avg(F.when(~top, F.col("composite_score_delta"))).alias("other_mean"))
    lift = (F.col("top_mean") - F.col("other_mean")) / F.greatest(F.abs("other_mean"), F.lit(0.001)) * 100
    return g.where(F.col("other_mean").isNotNull()).select(
        "profile_cluster", round_half_up("top_mean", 6).alias("top_mean"),
        round_half_up("other_mean", 6).alias("other_mean"), round_half_up(lift, 4).alias("lift_pct"))


def _lift_sql():
    from civora.plans.interventions import _RECS_SQL
    return _RECS_SQL + f"""
, tops AS (SELECT profile_cluster, split_part(recommended_services, '|', 1) AS top_service FROM recs)
, g AS (SELECT v.profile_cluster,
               avg(composite_score_delta) FILTER (WHERE primary_service = top_service) AS tm,
               avg(composite_score_delta) FILTER (WHERE primary_service <> top_service OR primary_service IS NULL) AS om
        FROM v JOIN tops USING (profile_cluster) GROUP BY v.profile_cluster)
SELECT profile_cluster, {sql_r('tm')} AS top_mean, {sql_r('om')} AS other_mean,
       {sql_r('(tm - om) / greatest(abs(om), 0.001) * 100', 4)} AS lift_pct
FROM g WHERE om IS NOT NULL
"""


RECOMMENDATION_LIFT_SQL = _lift_sql()


# Row-specific concern factors (importance order given) ------------------------------------
CONCERN_ORDER = ["high_sev_last_30d", "incidents_last_30d", "health_trend_slope", "days_since_session",
                 "edu_trend_slope", "unresolved_incidents"]


def q_case_row_concerns(spark, sf_dir, order=CONCERN_ORDER):
    df = cr.star_features(spark, sf_dir)
    gap = F.datediff(F.expr(EVENT_AS_OF), F.col("latest_session_date"))
    t = K.ROW_CONCERN_TEXT
    rules = {
        "high_sev_last_30d": F.coalesce(F.col("high_incidents_last_90d"), F.lit(0)) > 0,
        "incidents_last_30d": F.coalesce(F.col("incidents_last_30d"), F.lit(0)) > 0,
        "health_trend_slope": F.col("health_trend") < 0,
        "days_since_session": gap > K.ROW_CONCERN_SESSION_GAP,
        "edu_trend_slope": F.col("edu_trend") < 0,
        "unresolved_incidents": F.coalesce(F.col("open_incidents"), F.lit(0)) > 0,
    }
    arr = rule_factors([(F.coalesce(rules[f], F.lit(False)), F.lit(t[f])) for f in order], 3)
    return df.select("case_id", F.array_join(arr, " | ").alias("top_concern_factors"))


def _concern_sql():
    star = cr._STAR_SQL.replace(
        "          count(*) FILTER (WHERE session_date >= {0} - {1}) AS sessions_last_30d".format(
            EVENT_AS_OF, cr.RECENT_DAYS),
        "          count(*) FILTER (WHERE session_date >= {0} - {1}) AS sessions_last_30d,\n"
        "          max(session_date) AS latest_session_date".format(EVENT_AS_OF, cr.RECENT_DAYS))
    t = K.ROW_CONCERN_TEXT
    conds = {
        "high_sev_last_30d": "COALESCE(high_incidents_last_90d, 0) > 0",
        "incidents_last_30d": "COALESCE(incidents_last_30d, 0) > 0",
        "health_trend_slope": "COALESCE(health_trend < 0, false)",
        "days_since_session": f"COALESCE(date_diff('day', latest_session_date, {EVENT_AS_OF}) > {K.ROW_CONCERN_SESSION_GAP}, false)",
        "edu_trend_slope": "COALESCE(edu_trend < 0, false)",
        "unresolved_incidents": "COALESCE(open_incidents, 0) > 0",
    }
    items = ", ".join(f"CASE WHEN {conds[f]} THEN '{t[f]}' END" for f in CONCERN_ORDER)
    return star + f"""
SELECT case_id, array_to_string(list_filter([{items}], lambda x: x IS NOT NULL)[1:3], ' | ') AS top_concern_factors
FROM lb
"""


CASE_ROW_CONCERNS_SQL = _concern_sql()


# OLS diagnostics per (outcome, window) ----------------------------------------
def q_ols_diagnostics(spark, sf_dir, min_significant: int = 3):
    from civora.operators.joins import bounded_broadcast
    from civora.operators.prep import apply_rare_levels, dummy_columns, fit_rare_levels
    from civora.operators.stats import cohens_f2_label, normaltest, ols
    from civora.plans.attribution import OUTCOMES, WINDOWS, effect_inputs
    df = effect_inputs(spark, sf_dir)
    df = apply_rare_levels(df, "program_area", fit_rare_levels(df, "program_area"))
    df, dummies = dummy_columns(df, "program_area", drop_first=True)
    rows, areas = [], set()
    for o, a in OUTCOMES.items():
        for w, wm in WINDOWS.items():
            y = f"{a}_pct_change_{w}"
            d = df.where(F.col(y).isNotNull())
            fit = ols(d, y, ["log_amount", *dummies], absorb="site_id")
            bc = {c["term"]: c["coef"] for c in fit["coefs"]}
            means = d.groupBy("site_id").agg(F.avg(y).alias("_my"), *[F.avg(c).alias(f"_m{c}") for c in bc])
            dm = d.join(bounded_broadcast(means), "site_id")
            e = F.col(y) - F.col("_my") - sum((( F.col(t) - F.col(f"_m{t}")) * F.lit(b) for t, b in bc.items()),
                                              F.lit(0.0))
            mom = dm.select(e.alias("e")).agg(F.avg(F.abs("e")).alias("mae"), F.sqrt(F.avg(F.col("e") ** 2)).alias("rmse"),
                                              F.skewness("e").alias("g1"), F.kurtosis("e").alias("g2"),
                                              F.count(F.lit(1)).alias("n")).first()
            k2, k2p = normaltest(mom["g1"], mom["g2"], mom["n"])
            sig = {c["term"] for c in fit["coefs"] if c["term"].startswith("program_area_") and c["p"] < 0.05}
            areas |= sig
            rows.append((o, wm, int(fit["n"]), float(fit["r2"]), float(fit["adj_r2"]), float(fit["bp_lm"]),
                         float(fit["bp_p"]), fit["cov_type"], float(fit["cond_no"]), float(fit["cohens_f2"]),
                         cohens_f2_label(fit["cohens_f2"]), float(mom["mae"]), float(mom["rmse"]),
                         float(k2), float(k2p), float(max(fit["vif"].values())), len(sig)))
    # One gate over the distinct areas of all models
    gate = "fail" if not areas else "warn" if len(areas) < min_significant else "pass"
    rows = [(*r, len(areas), gate) for r in rows]
    schema = ("outcome string, window_months int, n int, r2 double, adj_r2 double, bp_lm double, "
              "bp_p double, cov_type string, cond_no double, cohens_f2 double, f2_size string, "
              "mae double, rmse double, normaltest_k2 double, normaltest_p double, max_vif double, "
              "n_significant int, n_significant_areas int, gate string")
    return spark.createDataFrame(rows, schema)


# Model train / test gap and AUC alert ------------------------------------------------------------
def q_model_gap_flags(spark, sf_dir, max_gap: float = 0.10, min_auc: float = 0.72):
    from civora.operators.evaluate import auc
    from civora.plans.models import positive_prob, train_churn
    fitted, meta = train_churn(spark, sf_dir)
    from civora.plans.churn import churn_features
    from civora.operators.evaluate import stratified_split
    from civora.operators.prep import apply_rare_levels
    df = churn_features(spark, sf_dir).withColumn("label", F.col("churned").cast("double"))
    for c, lv in meta["rare_levels"].items():
        df = apply_rare_levels(df, c, lv)
    sp = stratified_split(df, "churned", "supporter_id")
    tr = auc(fitted.transform(sp.where("split = 'train'")).withColumn("p", positive_prob()), "churned", "p")
    te = auc(fitted.transform(sp.where("split = 'test'")).withColumn("p", positive_prob()), "churned", "p")
    from civora.operators.joins import with_scalars
    j = with_scalars(tr.select(F.col("auc").alias("train_auc")), te.select(F.col("auc").alias("test_auc")))
    return j.select("train_auc", "test_auc",
                    ((F.col("train_auc") - F.col("test_auc")) > max_gap).alias("overfit_flag"),
                    (F.col("test_auc") < min_auc).alias("auc_alert"))


# IO5 / IO6: versioned statements, replace-by-version, read back the live version -------------------------
def q_versioned_statements(spark, sf_dir):
    import uuid

    from civora.session import scratch_path
    from civora.sources.sinks import write_version
    path = scratch_path(spark, "outputs", uuid.uuid4().hex[:12], "impact_statements")
    st = q_impact_statements(spark, sf_dir)
    write_version(st, path, "v1")
    write_version(st, path, "v2")          # a second version
    write_version(st, path, "v2")          # re-scoring the same version replaces it (no duplicates)
    # explicit schema: a version with no statements writes no data files
    schema = st.schema.add("model_version", "string")
    return (spark.read.schema(schema).parquet(path)
            .where(F.col("model_version") == "v2").drop("model_version"))


VERSIONED_STATEMENTS_SQL = IMPACT_STATEMENTS_SQL


# K-means on case profiles + silhouette --------------------------------------------------------
def q_kmeans_profiles(spark, sf_dir):
    from civora.plans.models import kmeans_profiles
    cases = iv.active_cases(spark, sf_dir).select("case_category", "current_risk_level", "age_band") \
        .fillna({"current_risk_level": "Unknown"})
    rows = kmeans_profiles(cases, ["case_category", "current_risk_level", "age_band"], ks=(2, 3, 4))
    return spark.createDataFrame([(r["k"], float(r["silhouette"])) for r in rows], "k int, silhouette double")



# Yeo-Johnson lambda search on allocation amounts --------------------------------------------------
def q_yeo_johnson_fit(spark, sf_dir):
    from civora.operators.joins import staged
    from civora.operators.prep import yeo_johnson_lambda
    posts = staged(standin(spark, sf_dir, "posts").select("estimated_donation_value"))
    lam, table = yeo_johnson_lambda(posts, "estimated_donation_value")
    return table.withColumn("chosen", F.abs(F.col("lambda") - F.lit(lam)) < 1e-12)


# F13 + F17: the numeric post columns chosen by type, gaps filled by the chain -------------------------------
def q_iterative_impute(spark, sf_dir):
    """Every post with its numeric columns, gaps filled by the chain over all of them."""
    from civora.operators.imputation import chained_impute
    from civora.operators.prep import split_by_type
    posts = standin(spark, sf_dir, "posts")
    types = split_by_type(posts, drop=["post_id"])
    nums = [c for c in ["engagement_rate", "donation_referrals", "caption_length"] if c in types["numeric"]]
    return chained_impute(posts.select("post_id", *nums), nums)


# Model selection on the churn task -------------------------------------------------
def q_model_selection(spark, sf_dir):
    from civora.operators.evaluate import auc, balanced_weights, stratified_split
    from civora.operators.joins import materialize
    from civora.plans.churn import CAT_COLS, NUM_COLS, churn_features
    from civora.plans.models import (build_pipeline, cross_validated, feature_names, positive_prob,
                                     select_from_importances, select_model)
    from pyspark.ml.tuning import ParamGridBuilder
    df = churn_features(spark, sf_dir).withColumn("label", F.col("churned").cast("double"))
    sp = stratified_split(df, "churned", "supporter_id", k_folds=3)
    w = balanced_weights(sp.where("split = 'train'"), "churned").select("churned", "weight")
    data = materialize(sp.join(F.broadcast(w), "churned"))
    train, test = data.where("split = 'train'"), data.where("split = 'test'")
    results, rows = {}, []
    for kind, params in [("rf", {"numTrees": 30, "maxDepth": 5}), ("gbt", {"maxIter": 20, "maxDepth": 3}),
                         ("lr", {"maxIter": 100})]:
        pipe = build_pipeline(NUM_COLS, CAT_COLS, kind, **params)
        if kind == "lr":                       # M16: grid search over the regularisation
            est = pipe.getStages()[-1]
            grid = ParamGridBuilder().addGrid(est.regParam, [0.0, 0.1]).build()
            model = cross_validated(pipe, train, grid).bestModel
        else:
            model = pipe.fit(train)
        a = auc(model.transform(test).withColumn("p", positive_prob()), "churned", "p").first()["auc"]
        results[kind] = a
        kept = ""
        if kind != "lr":
            imps = list(model.stages[-1].featureImportances.toArray())
            kept = ",".join(select_from_importances(imps, feature_names(model, NUM_COLS, CAT_COLS)))
        rows.append((kind, float(a), kept))
    chosen = select_model(results, prefer="rf", margin=0.02)
    return spark.createDataFrame([(k, a, k == chosen, kept) for k, a, kept in rows],
                                 "model string, test_auc double, selected boolean, kept_features string")


# IO8 / IO9 / P37: register two versions, fail a gate, roll back --------------------------------------------
def q_registry_roundtrip(spark, sf_dir):
    import uuid

    from civora.functions.columns import stamp_run
    from civora.plans.models import score_churn, train_churn
    from civora.session import scratch_path
    from civora.sources import registry as R
    root = scratch_path(spark, "registry", uuid.uuid4().hex[:12])
    fitted, meta = train_churn(spark, sf_dir, model="lr", maxIter=50)
    R.register(spark, "churn", fitted, 0, meta["features"], {"auc": meta["auc"]}, True, root, version="v1")
    R.register(spark, "churn", fitted, 0, meta["features"], {"auc": meta["auc"]}, True, root, version="v2")
    R.register(spark, "churn", fitted, 0, meta["features"], {"auc": 0.0}, False, root, version="v3")
    R.set_live(spark, "churn", "v1", "rollback", root)
    live = R.live_version(spark, "churn", root)
    scored = stamp_run(score_churn(spark, sf_dir, R.load_live(spark, "churn", root), meta), live)
    hist = R.history(spark, "churn", root).select("version", "passed")
    n = scored.agg(F.count(F.lit(1)).alias("n_scored"), F.first("model_version").alias("scored_with"))
    from civora.operators.joins import with_scalars
    return with_scalars(hist, n).withColumn("live", F.col("version") == F.lit(live))


# One label trained again, the other label's model and the shared version stay ----------------------------
READINESS_GATES = {"auc": 0.70, "recall": 0.65}


def q_label_retrain(spark, sf_dir):
    """Registry after: both labels under v1, readiness trained again, then a retrain that misses its gates."""
    import uuid

    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    from civora.operators.joins import staged
    from civora.plans.churn import churn_features
    from civora.session import scratch_path
    from civora.sources import registry as R
    root = scratch_path(spark, "registry", uuid.uuid4().hex[:12])
    inputs = ["recency_days", "frequency", "tenure_days"]
    df = staged(churn_features(spark, sf_dir).select(*inputs, "churned", F.col("ever_recurring").cast("int").alias("recurs")))

    def fit(label, steps):
        stages = [VectorAssembler(inputCols=inputs, outputCol="features"),
                  LogisticRegression(labelCol=label, maxIter=steps)]
        return Pipeline(stages=stages).fit(df)

    R.register_label(spark, "cases", "risk", fit("churned", 5), {"auc": 0.8, "recall": 0.8}, {}, "v1", root)
    R.register_label(spark, "cases", "readiness", fit("recurs", 5), {"auc": 0.71, "recall": 0.66}, READINESS_GATES, "v1", root)
    R.register_label(spark, "cases", "readiness", fit("recurs", 10), {"auc": 0.75, "recall": 0.7}, READINESS_GATES, root=root)
    try:
        R.register_label(spark, "cases", "readiness", fit("recurs", 1), {"auc": 0.9, "recall": 0.6}, READINESS_GATES, root=root)
        stopped = False
    except R.GateFailed:
        stopped = True
    now = R.current_labels(spark, "cases", root).select("label", F.col("revision").alias("in_force"))
    return (R.label_table(spark, "cases", root).join(now, "label")
            .select("version", "label", "revision", (F.col("revision") == F.col("in_force")).alias("in_force"),
                    F.get_json_object("metrics", "$.auc").cast("double").alias("auc"), F.lit(stopped).alias("gate_held")))


LABEL_RETRAIN_SQL = """
SELECT * FROM (VALUES ('v1', 'risk', 0::INTEGER, true, 0.8::DOUBLE, true), ('v1', 'readiness', 0::INTEGER, false, 0.71::DOUBLE, true),
                      ('v1', 'readiness', 1::INTEGER, true, 0.75::DOUBLE, true))
  t(version, label, revision, in_force, auc, gate_held)
"""


# ST1: incremental rescore over a stream of donation files equals the batch scores -----------------------------
RESCORE_AS_OF = "DATE '2001-08-02'"


def rule_scores_of(state, supporters):
    """Rule score and tier of active supporters with two gifts or more, from their kept accumulators."""
    from civora.functions.columns import tier
    gap = F.greatest(F.date_diff("last_date", "first_date"), F.lit(0)) / F.greatest(F.col("frequency") - 1, F.lit(1))
    recency = F.date_diff(F.expr(RESCORE_AS_OF), F.col("last_date"))
    s = round_half_up(F.least(F.lit(1.0), recency / (gap * 4 + 1)), 6)
    active = supporters.where(F.col("status") == "Active").select("supporter_id")
    return (state.where("frequency >= 2").join(active, "supporter_id", "left_semi")
            .select("supporter_id", s.alias("rule_score"), tier(s).alias("risk_tier")))


def q_incremental_rescore(spark, sf_dir, files: int = 4):
    """Donations land as several files, one micro-batch each; the state is compacted in between."""
    import uuid

    from civora.functions.columns import coalesce_amount
    from civora.session import scratch_path
    from civora.streaming.rescore import rescore_from_state
    from civora.streaming.state import KeyedState, gift_accumulators, latest_scores
    root = scratch_path(spark, "rescore", uuid.uuid4().hex[:12])
    gifts = standin(spark, sf_dir, "donations").where(F.col("donation_date") < F.expr(RESCORE_AS_OF)).select(
        "supporter_id", "donation_date", "is_recurring", coalesce_amount("amount", "estimated_value").alias("value"))
    gifts.repartition(files).write.parquet(f"{root}/landing")
    stream = (spark.readStream.schema(spark.read.parquet(f"{root}/landing").schema).option("maxFilesPerTrigger", 1)
              .parquet(f"{root}/landing"))
    state = KeyedState(spark, f"{root}/state", "supporter_id",
                       gift_accumulators(F.col("value"), recurring=F.col("is_recurring")), n_buckets=16)
    q = rescore_from_state(stream, state, lambda s: rule_scores_of(s, standin(spark, sf_dir, "supporters")),
                           f"{root}/scores", f"{root}/checkpoint", compact_every=2)
    q.awaitTermination()
    return latest_scores(spark, f"{root}/scores", "supporter_id")


def _incremental_sql():
    from civora.plans.io_queries import SCORE_UPSERT_SQL, _rule_sql
    head = SCORE_UPSERT_SQL.split(", o AS (")[0]
    return head + f""", n AS ({_rule_sql("DATE '2001-08-02'")})
SELECT supporter_id, rule_score,
       CASE WHEN rule_score >= 0.7 THEN 'high' WHEN rule_score >= 0.4 THEN 'medium' ELSE 'low' END AS risk_tier
FROM n
"""


INCREMENTAL_RESCORE_SQL = _incremental_sql()


# DBSCAN noise on post value x referrals, removed under the 2 % cap ------------------------------
DBSCAN_COLS = ["estimated_donation_value", "donation_referrals"]
DBSCAN_EPS, DBSCAN_MIN_PTS = 0.03, 20


def q_multivariate_outliers(spark, sf_dir):
    from civora.operators.dbscan import mark_outliers
    return mark_outliers(standin(spark, sf_dir, "posts"), "post_id", DBSCAN_COLS, DBSCAN_EPS, DBSCAN_MIN_PTS)


def _dbscan_sql():
    from civora.sources.standins import duck_cte
    a, b = DBSCAN_COLS
    near = f"(p.x - q.x) ** 2 + (p.y - q.y) ** 2 <= {DBSCAN_EPS} ** 2 AND q.y BETWEEN p.y - {DBSCAN_EPS} AND p.y + {DBSCAN_EPS}"
    return duck_cte("posts") + f"""
, d AS (SELECT row_number() OVER () AS i, post_id, {a} AS a, {b} AS b FROM posts WHERE {a} IS NOT NULL AND {b} IS NOT NULL)
, s AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, stddev_pop(b) AS sb FROM d)
, z AS (SELECT i, post_id, (a - ma) / sa AS x, (b - mb) / sb AS y FROM d, s)
, pairs AS (SELECT p.i, count(*) AS n_near FROM z p JOIN z q ON {near} GROUP BY p.i)
, core AS (SELECT z.* FROM z JOIN pairs USING (i) WHERE n_near >= {DBSCAN_MIN_PTS})
, open_ AS (SELECT z.*, n_near FROM z JOIN pairs USING (i) WHERE n_near < {DBSCAN_MIN_PTS})
, noise AS (SELECT * FROM open_ WHERE i NOT IN (SELECT p.i FROM open_ p JOIN core q ON {near}))
, placed AS (SELECT post_id, n_near,
                    row_number() OVER (ORDER BY n_near, round(x * x + y * y, 6) DESC, post_id) AS place FROM noise)
SELECT post_id, n_near, place, place <= floor((SELECT count(*) FROM posts) * 0.02) AS removed FROM placed
"""


MULTIVARIATE_OUTLIERS_SQL = _dbscan_sql()


# M8 + M11: depth sweep and regularised linear models on the content value target --------------------------
def q_regression_model_sweep(spark, sf_dir):
    from pyspark.ml.feature import VectorAssembler

    from civora.operators.evaluate import time_split
    from civora.plans.content import clean_posts
    from civora.plans.models import depth_sweep, regularised_path
    from civora.operators.joins import staged
    inputs = ["num_hashtags", "caption_length", "post_hour", "engagement_rate"]
    posts = staged(clean_posts(standin(spark, sf_dir, "posts")).select("created_at", "post_id", "donation_referrals", *inputs))
    va = VectorAssembler(inputCols=inputs, outputCol="features")
    sp = time_split(posts, "created_at", ["post_id", "donation_referrals", "engagement_rate"])
    sp = staged(va.transform(sp).select("features", "donation_referrals", "split"))
    tr, te = sp.where("split = 'train'"), sp.where("split = 'test'")
    rows = [("tree", float(r["depth"]), None, float(r["train_rmse"]), float(r["test_rmse"]), None)
            for r in depth_sweep(tr, te, "donation_referrals", depths=(2, 4, 6))]
    rows += [("linear", float(r["alpha"]), float(r["l1_ratio"]), None, None, float(r["r2"]))
             for r in regularised_path(tr, "donation_referrals", alphas=(0.01, 1.0), l1_ratios=(0.0, 0.5, 1.0))]
    return spark.createDataFrame(rows, "family string, param double, l1_ratio double, train_rmse double, "
                                       "test_rmse double, train_r2 double")


# Permutation importance of the churn model (hash-ordered permutations, no collect) ----------------------
def q_permutation_importance(spark, sf_dir):
    from civora.operators.evaluate import stratified_split
    from civora.operators.prep import apply_rare_levels
    from civora.plans.churn import churn_features
    from civora.plans.models import permutation_importance, train_churn
    fitted, meta = train_churn(spark, sf_dir, numTrees=20, maxDepth=4)
    df = churn_features(spark, sf_dir).withColumn("label", F.col("churned").cast("double"))
    for c, lv in meta["rare_levels"].items():
        df = apply_rare_levels(df, c, lv)
    test = stratified_split(df, "churned", "supporter_id").where("split = 'test'").drop("split", "fold", "pos")
    rows = permutation_importance(fitted, test, ["recency_days", "frequency", "avg_gap_days"], label="churned",
                                  repeats=2)
    return spark.createDataFrame([(r["feature"], float(r["importance_mean"]), float(r["importance_std"]))
                                  for r in rows], "feature string, importance_mean double, importance_std double")
