"""Scalar column expressions.

Every function returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civora.functions import constants as K

__all__ = [
    "coalesce_amount", "flag01", "ordinal", "log1p0", "safe_div", "days_between",
    "mean_gap", "date_parts", "month_start", "duration_months", "age_band",
    "flag_label", "profile_label", "partial_profile_label", "tier", "right_closed_bin",
    "band_to_int", "confidence_tier", "conversion_signal", "pct_change",
    "overdue_flag", "ratio_features", "fill_defaults", "json_list", "cta_type_or_null",
    "stamp_run", "rule_factors", "first_n_nonnull",
]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# P1
def coalesce_amount(amount="amount", estimated="estimated_value") -> Column:
    return F.coalesce(_c(amount), _c(estimated))


# P2 / P3 / P8
def flag01(cond) -> Column:
    return F.when(_c(cond), F.lit(1)).otherwise(F.lit(0))


# Ordinal lookup, NULL when the level is unknown
def ordinal(col, mapping: dict) -> Column:
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return m[_c(col)]


# P9
def log1p0(col) -> Column:
    return F.log1p(F.coalesce(_c(col).cast("double"), F.lit(0.0)))


# P10 (ANSI is on: x/0 raises, so ratios go through try_divide)
def safe_div(a, b) -> Column:
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


# P11
def days_between(later, earlier) -> Column:
    return F.datediff(_c(later), _c(earlier))


# Span / max(n - 1, 1)
def mean_gap(span, n) -> Column:
    return _c(span) / F.greatest(_c(n) - 1, F.lit(1))


# Year / month / day / weekday (Mon=0), optionally drop the source column
def date_parts(df: DataFrame, col: str, drop: bool = True) -> DataFrame:
    out = (df.withColumn(f"{col}_year", F.year(col))
             .withColumn(f"{col}_month", F.month(col))
             .withColumn(f"{col}_day", F.dayofmonth(col))
             .withColumn(f"{col}_weekday", F.weekday(col)))
    return out.drop(col) if drop else out


# P15: '2024-05-01 10:00:00+02:00' -> 2024-05-01 10:00:00, the wall clock time without its zone
def strip_zone(col) -> Column:
    """Text with or without an offset, or a timestamp, as TIMESTAMP_NTZ; the clock time stays as written."""
    return _c(col).cast("timestamp_ntz")


# P14
def month_start(col) -> Column:
    return F.trunc(_c(col), "MM")


# P16: '2 Years 9 months' -> 33.0; NULL when neither part is present
def duration_months(col) -> Column:
    s = F.lower(_c(col).cast("string"))
    y = F.regexp_extract(s, r"(\d+)\s*year", 1)
    m = F.regexp_extract(s, r"(\d+)\s*month", 1)
    yn = F.when(y != "", y.cast("int")).otherwise(F.lit(0))
    mn = F.when(m != "", m.cast("int")).otherwise(F.lit(0))
    return F.when(s.isNull() | ((y == "") & (m == "")), F.lit(None).cast("double")) \
            .otherwise((yn * 12 + mn).cast("double"))


# Band from the leading integer token
def age_band(col) -> Column:
    tok = F.element_at(F.split(F.trim(F.coalesce(_c(col).cast("string"), F.lit(""))), r"\s+"), 1)
    years = F.when(tok.rlike(r"^[+-]?[0-9]{1,9}$"), tok.cast("int"))
    under10, b10, b14, b18, unknown = K.AGE_BANDS
    return (F.when(years.isNull(), F.lit(unknown))
             .when(years < 10, F.lit(under10))
             .when(years <= 13, F.lit(b10))
             .when(years <= 17, F.lit(b14))
             .otherwise(F.lit(b18)))


# Ordered labels of the true flags, joined; default text when none
def flag_label(flags=None) -> Column:
    flags = flags or K.ABUSE_FLAG_LABELS
    joined = F.concat_ws(K.LABEL_SEP, *[F.when(F.col(c) == F.lit(True), F.lit(lbl))
                                        for c, lbl in flags])
    return F.when(joined == "", F.lit(K.NO_SUBTYPE)).otherwise(joined)


def _text(col) -> Column:
    # Python's f"{None}" renders the text 'None'; keep that behaviour.
    return F.coalesce(_c(col).cast("string"), F.lit("None"))


# P19
def profile_label(risk="current_risk_level", age="present_age", flags=None) -> Column:
    return F.concat(_text(risk), F.lit(K.LABEL_SEP), flag_label(flags),
                    F.lit(K.LABEL_SEP + "Age "), age_band(age))


def partial_profile_label(risk="current_risk_level", flags=None) -> Column:
    return F.concat(_text(risk), F.lit(K.LABEL_SEP), flag_label(flags))


# P20: left-closed thresholds on the unrounded probability
def tier(p, labels=K.RISK_TIER_LABELS, high=K.TIER_HIGH, medium=K.TIER_MEDIUM) -> Column:
    return (F.when(_c(p) >= high, F.lit(labels[0]))
             .when(_c(p) >= medium, F.lit(labels[1]))
             .otherwise(F.lit(labels[2])))


# Right-closed bins (a, b]; out of range -> NULL
def right_closed_bin(col, edges=K.FREQ_EDGES, labels=K.FREQ_BANDS) -> Column:
    expr = None
    for lo, hi, lbl in zip(edges[:-1], edges[1:], labels):
        cond = (_c(col) > lo) & (_c(col) <= hi)
        expr = F.when(cond, F.lit(lbl)) if expr is None else expr.when(cond, F.lit(lbl))
    return expr


# P22
def band_to_int(col, mapping=K.FREQ_BAND_TO_INT, default=K.FREQ_INT_DEFAULT) -> Column:
    return F.coalesce(ordinal(col, mapping), F.lit(default))


# P23
def confidence_tier(n, thresholds=K.CONFIDENCE_CASES) -> Column:
    hi, mid = thresholds
    return (F.when(_c(n) >= hi, F.lit("high")).when(_c(n) >= mid, F.lit("medium"))
             .otherwise(F.lit("low")))


# P24
def conversion_signal(pred_eng, pred_ref, platform_median) -> Column:
    return (F.when(_c(pred_ref) >= K.CONVERTS_FACTOR * _c(platform_median), F.lit("converts"))
             .when((_c(pred_eng) >= K.NOISE_ENGAGEMENT)
                   & (_c(pred_ref) < K.NOISE_FACTOR * _c(platform_median)), F.lit("noise"))
             .otherwise(F.lit("balanced")))


# P25: percent change, zero base -> NULL
def pct_change(new, base) -> Column:
    return F.try_divide(_c(new) - _c(base), F.nullif(_c(base), F.lit(0))) * 100


# P28 helper: silent for longer than factor x the usual gap
def overdue_flag(days_since, gap, factor: float = 1.5) -> Column:
    return _c(days_since) > _c(gap) * factor


# Recency / (frequency + 1), log value / (tenure + 1)
def ratio_features(df: DataFrame) -> DataFrame:
    return (df.withColumn("recency_per_gift", F.col("recency_days") / (F.col("frequency") + 1))
              .withColumn("value_per_tenure", F.col("total_value_log") / (F.col("tenure_days") + 1))
              .withColumn("is_overdue", overdue_flag("recency_days", "avg_gap_days")))


# P30
def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    return df.fillna(defaults)


# P34
def json_list(col) -> Column:
    return F.to_json(_c(col))


# P36
def cta_type_or_null(has_cta="has_call_to_action", cta="call_to_action_type") -> Column:
    return F.when(_c(has_cta), _c(cta))


# Run stamp columns (kept out of oracles)
def stamp_run(df: DataFrame, model_version: str, ts_col: str = "scored_at",
              with_uuid: str | None = None) -> DataFrame:
    out = (df.withColumn(ts_col, F.current_timestamp())
             .withColumn("model_version", F.lit(model_version)))
    return out.withColumn(with_uuid, F.expr("uuid()")) if with_uuid else out


# Ordered rule list -> first n labels whose condition holds
def rule_factors(rules: list[tuple[Column, Column]], n: int = 3,
                 fallback: str | None = None) -> Column:
    arr = F.filter(F.array(*[F.when(cond, lbl) for cond, lbl in rules]), lambda x: x.isNotNull())
    top = F.slice(arr, 1, n)
    if fallback is None:
        return top
    return F.when(F.size(top) == 0, F.array(F.lit(fallback))).otherwise(top)


def first_n_nonnull(cols: list[Column], n: int = 3) -> Column:
    return F.slice(F.filter(F.array(*cols), lambda x: x.isNotNull()), 1, n)


# Deterministic rounding for reports: the same IEEE operations in every engine
# (Spark's ``round`` rounds the decimal text of a double, other engines the
# binary value; exact halves such as 2.7284375 then differ).
def round_half_up(col, d: int) -> Column:
    s = float(10 ** d)
    return F.floor(_c(col) * s + 0.5) / s


def det_sum(col, d: int = 6) -> Column:
    """Sum that does not depend on summation order: terms and total at d decimals."""
    return round_half_up(F.sum(round_half_up(col, d)), d)


def det_avg(col, d: int = 6) -> Column:
    return F.try_divide(det_sum(col, d), F.count(_c(col)))


def sql_r(x: str, d: int = 6) -> str:
    """SQL text of ``round_half_up`` for oracles."""
    return f"(floor(({x}) * 1e{d} + 0.5) / 1e{d})"


def sql_det_avg(x: str, d: int = 6) -> str:
    return f"({sql_r('sum(' + sql_r(x, d) + ')', d)} / count({x}))"
