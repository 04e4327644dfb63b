"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None)."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from civora.plans import evaluation as evq, io_queries as ioq, models as ml, profiling as pf
from civora.plans import extras as ex, monitoring as mon, reports as rp
from civora.streaming import rescore as st
from civora.plans import attribution as at, case_risk as cr, churn, content as ct, interventions as iv


@dataclass(frozen=True)
class Query:
    fn: Callable
    sql: str | None
    ids: str


REGISTRY: dict[str, Query] = {
    "churn_features": Query(churn.churn_features_report, churn.CHURN_FEATURES_SQL,
                            "IO1 P1 J1 A1 A2 A5 A6 A11 P9 P11 P12 P30 P35"),
    "churn_rule_tiers": Query(churn.churn_rule_tiers, churn.CHURN_RULE_TIERS_SQL, "P4 P20"),
    "session_windows": Query(iv.q_session_windows, iv.SESSION_WINDOWS_SQL, "W2 W3 A16"),
    "asof_followup_delta": Query(iv.q_asof_followup_delta, iv.ASOF_FOLLOWUP_SQL,
                                 "J5 J6 A19 W2 X10 SO1"),
    "cluster_assignment": Query(iv.q_cluster_assignment, iv.CLUSTER_ASSIGNMENT_SQL,
                                "P17 P18 P19 F18"),
    "cluster_recommendations": Query(iv.q_cluster_recommendations, iv.CLUSTER_RECS_SQL,
                                     "W4 A17 P21 F18"),
    "worker_roster": Query(iv.q_worker_roster, iv.WORKER_ROSTER_SQL, "A14"),
    "intervention_recommendations": Query(iv.q_intervention_recommendations,
                                          iv.INTERVENTION_RECS_SQL,
                                          "X10 W5 J7 P22 P23 P33 F18"),
    "session_outcome_deltas": Query(iv.q_session_outcome_deltas, iv.SESSION_OUTCOME_SQL,
                                    "X11 J5 J6 A19"),
    "star_entity_features": Query(cr.q_star_entity_features, cr.STAR_FEATURES_SQL,
                                  "J2 A3 A4 A5 A6 P2 P3 P6 P7 P8 P9 P10 P16 A12 X8"),
    "site_alerts": Query(cr.q_site_alerts, cr.SITE_ALERTS_SQL, "A22"),
    "recency_features": Query(cr.q_recency_features, cr.RECENCY_SQL, "A7 A8 A9 A10 W1"),
    "lagged_panel_join": Query(at.q_lagged_panel_join, at.LAGGED_PANEL_SQL, "J4 P14 P25 P26"),
    "area_effects": Query(at.q_area_effects, at.AREA_EFFECTS_SQL, "S1(1 regressor) S9"),
    "impact_statements": Query(at.q_impact_statements, at.IMPACT_STATEMENTS_SQL, "J9 P32 J3 X7"),
    "ols_effects": Query(at.ols_effects, None, "S1 S2 S3 S9 F1 F6 X7"),
    "best_content_combo": Query(ct.q_best_content_combo, ct.BEST_COMBO_SQL,
                                "F19 A14 A15 A17 W6 J10 P23 P24 P30 P31 P36"),
    "conversion_noise_signal": Query(ct.q_conversion_noise_signal, ct.CONVERSION_SIGNAL_SQL,
                                     "P27 A21"),
    "platform_baseline": Query(ct.q_platform_baseline, ct.PLATFORM_BASELINE_SQL, "A20 A25 A15"),
    "stratified_split": Query(evq.q_stratified_split, evq.STRATIFIED_SPLIT_SQL, "M1 M2 M3"),
    "balanced_class_weights": Query(evq.q_balanced_class_weights, evq.BALANCED_WEIGHTS_SQL, "M4"),
    "auc_rank_sum": Query(evq.q_auc_rank_sum, evq.AUC_SQL, "M19 W10"),
    "roc_points": Query(evq.q_roc_points, evq.ROC_SQL, "M22"),
    "classification_report": Query(evq.q_classification_report, evq.CLASSIFICATION_REPORT_SQL,
                                   "M21"),
    "confusion_matrix": Query(evq.q_confusion_matrix, evq.CONFUSION_SQL, "M20"),
    "regression_metrics": Query(evq.q_regression_metrics, evq.REGRESSION_METRICS_SQL, "M23"),
    "time_split": Query(evq.q_time_split, evq.TIME_SPLIT_SQL, "W9"),
    "univariate_profile": Query(pf.q_univariate_profile, pf.UNIVARIATE_SQL, "A26"),
    "rare_collapse": Query(pf.q_rare_collapse, pf.RARE_COLLAPSE_SQL, "F1"),
    "value_counts": Query(pf.q_value_counts, pf.VALUE_COUNTS_SQL, "A18"),
    "group_describe": Query(pf.q_group_describe, pf.GROUP_DESCRIBE_SQL, "A13 A27"),
    "bivariate_tests": Query(pf.q_bivariate_tests, pf.BIVARIATE_SQL, "S11 S14 S16 S17"),
    "score_upsert": Query(ioq.q_score_upsert, ioq.SCORE_UPSERT_SQL, "IO4 X14"),
    "unscored_append": Query(ioq.q_unscored_append, ioq.UNSCORED_SQL, "IO7 J8"),
    "csv_roundtrip": Query(ioq.q_csv_roundtrip, ioq.CSV_ROUNDTRIP_SQL, "IO2 IO3"),
    "trailing_incident_counts": Query(st.q_trailing_incident_counts, st.ST2_SQL, "ST2 A3"),
    "churn_model_scores": Query(ml.q_churn_model_scores, None,
                                "X6 M1 M4 M5 M13 M19 M24 M26 M27 F1 F2 F4 F5 F7 P20 P34"),
    "impute_scale": Query(rp.q_impute_scale, rp.IMPUTE_SCALE_SQL, "F2 F3 F4"),
    "basic_wrangling": Query(rp.q_basic_wrangling, rp.BASIC_WRANGLING_SQL, "F8"),
    "skew_candidates": Query(rp.q_skew_candidates, rp.SKEW_SQL, "F9"),
    "outlier_bounds": Query(rp.q_outlier_bounds, rp.OUTLIER_SQL, "F14"),
    "outliers_replaced": Query(rp.q_outliers_replaced, rp.OUTLIERS_REPLACED_SQL, "F14"),
    "missing_dropped": Query(rp.q_missing_dropped, rp.MISSING_DROPPED_SQL, "F11"),
    "chained_impute": Query(rp.q_chained_impute, rp.CHAINED_IMPUTE_SQL, "F13"),
    "missing_filled": Query(rp.q_missing_filled, rp.MISSING_FILLED_SQL, "F12 F13"),
    "variance_threshold": Query(rp.q_variance_threshold, rp.VARIANCE_SQL, "F16"),
    "missingness_test": Query(rp.q_missingness_test, rp.MISSINGNESS_SQL, "F11 F12"),
    "date_parts": Query(rp.q_date_parts, rp.DATE_PARTS_SQL, "P13"),
    "zone_stripped": Query(rp.q_zone_stripped, rp.ZONE_STRIPPED_SQL, "P15"),
    "churn_row_factors": Query(rp.q_churn_row_factors, rp.CHURN_ROW_FACTORS_SQL, "P28 P38"),
    "centered_square": Query(rp.q_centered_square, rp.CENTERED_SQL, "P29"),
    "spearman_corr": Query(rp.q_spearman_corr, rp.SPEARMAN_SQL, "W10 S12"),
    "durbin_watson": Query(rp.q_durbin_watson, rp.DURBIN_WATSON_SQL, "W11 S4"),
    "rolling_health": Query(rp.q_rolling_health, rp.ROLLING_SQL, "W12"),
    "pairwise_ttests": Query(rp.q_pairwise_ttests, rp.PAIRWISE_SQL, "S15"),
    "effect_direction": Query(rp.q_effect_direction, rp.EFFECT_DIRECTION_SQL, "S19"),
    "label_drift": Query(mon.q_label_drift, mon.LABEL_DRIFT_SQL, "X1 A28"),
    "score_psi": Query(mon.q_score_psi, mon.SCORE_PSI_SQL, "X2"),
    "high_risk_top10": Query(mon.q_high_risk_top10, mon.HIGH_RISK_SQL, "X4 W8 W7"),
    "conversion_consistency": Query(mon.q_conversion_consistency, mon.CONVERSION_CONSISTENCY_SQL, "X5"),
    "kendall_tau": Query(mon.q_kendall_tau, mon.KENDALL_SQL, "S13"),
    "kendall_tau_continuous": Query(mon.q_kendall_tau_continuous, mon.KENDALL_CONTINUOUS_SQL, "S13"),
    "select_k_best": Query(mon.q_select_k_best, mon.KBEST_SQL, "M29 S14"),
    "mutual_information": Query(mon.q_mutual_information, mon.MUTUAL_INFORMATION_SQL, "M29"),
    "cluster_stability": Query(mon.q_cluster_stability, mon.CLUSTER_STABILITY_SQL, "M33"),
    "input_validation": Query(mon.q_input_validation, mon.INPUT_VALIDATION_SQL, "IO10 J8"),
    "dashboard_high_risk": Query(mon.q_dashboard_high_risk, mon.DASHBOARD_SQL, "X14 IO4"),
    "cross_validation_table": Query(ml.q_cross_validation_table, None, "M15 X3"),
    "label_retrain": Query(ex.q_label_retrain, ex.LABEL_RETRAIN_SQL, "X9 IO8"),
    "case_model_scores": Query(ml.q_case_model_scores, None,
                               "X8 M3 M5 M13 M17 M18 M26 M27 P20 P34"),
    "content_model_recommendations": Query(ml.q_content_model_recommendations, None,
                                           "X12 W9 M9 M10 M14 W6 P24"),
    "statement_coverage": Query(ex.q_statement_coverage, ex.STATEMENT_COVERAGE_SQL, "A23"),
    "recommendation_lift": Query(ex.q_recommendation_lift, ex.RECOMMENDATION_LIFT_SQL, "A24"),
    "case_row_concerns": Query(ex.q_case_row_concerns, ex.CASE_ROW_CONCERNS_SQL, "P39 P5"),
    "versioned_statements": Query(ex.q_versioned_statements, ex.VERSIONED_STATEMENTS_SQL, "IO5 IO6"),
    "ols_diagnostics": Query(ex.q_ols_diagnostics, None, "S4 S5 S6 S7 S8 S10 S18 S2 S3"),
    "model_gap_flags": Query(ex.q_model_gap_flags, None, "X3 M19"),
    "kmeans_profiles": Query(ex.q_kmeans_profiles, None, "M32"),
    "yeo_johnson_fit": Query(ex.q_yeo_johnson_fit, None, "F10 F9"),
    "iterative_impute": Query(ex.q_iterative_impute, None, "F13 F17"),
    "model_selection": Query(ex.q_model_selection, None, "M5 M6 M7 M16 M24 M31 M26"),
    "registry_roundtrip": Query(ex.q_registry_roundtrip, None, "IO8 IO9 P37 X6"),
    "incremental_rescore": Query(ex.q_incremental_rescore, ex.INCREMENTAL_RESCORE_SQL, "ST1 IO4"),
    "multivariate_outliers": Query(ex.q_multivariate_outliers, ex.MULTIVARIATE_OUTLIERS_SQL, "F15"),
    "regression_model_sweep": Query(ex.q_regression_model_sweep, None, "M8 M11 M23"),
    "permutation_importance": Query(ex.q_permutation_importance, None, "M28"),
}
