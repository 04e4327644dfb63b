"""Splits, folds, weights and exact metrics.

Deterministic sampling: rows are ordered by ``md5(concat(seed, id))`` (same
hex in every engine), never ``randomSplit``. Exact per-class positions come
from ``bucketed_row_number`` with the first 16 bits of the hash as bucket, so
no window ever holds a whole class in one task.

Ranking metrics (AUC with ties, ROC points) run on the per-distinct-score
count table with bucketed prefix sums; the buckets' bounds are quantiles of
the scores (``ordering.range_bucket``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civora.operators.joins import materialize, with_scalars
from civora.operators.ordering import global_position, range_bucket
from civora.operators.temporal import bucketed_prefix_sum, bucketed_row_number

HASH_BUCKET_BITS = 16


def hash_key(seed: str, id_col: str) -> Column:
    return F.md5(F.concat(F.lit(seed), F.col(id_col).cast("string")))


def class_positions(df: DataFrame, label: str, id_col: str, seed: str = "42",
                    out: str = "pos") -> DataFrame:
    """Exact 1-based position within each class, ordered by (md5, id)."""
    h = hash_key(seed, id_col)
    d = df.withColumn("_h", h).withColumn(
        "_hb", F.conv(F.substring("_h", 1, HASH_BUCKET_BITS // 4), 16, 10).cast("int"))
    return bucketed_row_number(d, [label], "_hb", ["_h", id_col], out).drop("_hb")


# M1 / M2 / M3
def stratified_split(df: DataFrame, label: str, id_col: str, test_size: float = 0.20,
                     val_size: float | None = None, k_folds: int = 5, seed: str = "42") -> DataFrame:
    """Adds ``split`` (train / val / test) and ``fold`` (0..k-1, train rows) columns.

    Train takes the first floor((1 - test) * n_c) positions of each class,
    like a stratified shuffle split with a fixed order.
    """
    pos = class_positions(df, label, id_col, seed)
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    d = pos.join(F.broadcast(n), label)        # one row per class: proven bound
    cut_train = F.floor(F.col("_nc") * (1 - test_size))
    split = F.when(F.col("pos") <= cut_train, F.lit("train")).otherwise(F.lit("test"))
    if val_size:
        cut_fit = F.floor(F.col("_nc") * (1 - test_size - val_size))
        split = (F.when(F.col("pos") <= cut_fit, F.lit("train"))
                  .when(F.col("pos") <= cut_train, F.lit("val")).otherwise(F.lit("test")))
    return (d.withColumn("split", split)
             .withColumn("fold", F.pmod(F.col("pos") - 1, F.lit(k_folds)).cast("int"))
             .drop("_nc", "_h"))


# M4
def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Class weight n / (n_classes * n_c) per label value (one small table)."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    tot = c.agg(F.sum("n_c").alias("n"), F.count(F.lit(1)).alias("k"))
    return with_scalars(c, tot).withColumn("weight", F.col("n") / (F.col("k") * F.col("n_c")))


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """(score, n_pos, n_neg, bucket) per distinct score, bucketed by bounds taken from the scores."""
    c = df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("n_pos"), F.count_if(F.col(label) != 1).alias("n_neg"))
    return range_bucket(materialize(c), "score")


# Exact ROC-AUC with ties (Mann-Whitney)
def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    c = score_counts(df, label, score)
    cum = bucketed_prefix_sum(c, [], "_b", ["score"], ["n_neg"])
    below = F.col("n_neg_cum") - F.col("n_neg")
    part = cum.agg(F.sum(F.col("n_pos") * (below + 0.5 * F.col("n_neg"))).alias("_s"),
                   F.sum("n_pos").alias("P"), F.sum("n_neg").alias("N"))
    return part.select(F.try_divide(F.col("_s"), F.col("P") * F.col("N")).alias("auc"),
                       F.col("P").alias("n_pos"), F.col("N").alias("n_neg"))


# ROC points (one per distinct score, descending thresholds)
def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    c = score_counts(df, label, score).withColumn("_b", -F.col("_b"))
    cum = bucketed_prefix_sum(c, [], "_b", [F.col("score").desc()], ["n_pos", "n_neg"])
    tot = c.agg(F.sum("n_pos").alias("P"), F.sum("n_neg").alias("N"))
    j = with_scalars(cum, tot)
    return j.select(F.col("score").alias("threshold"),
                    F.try_divide(F.col("n_pos_cum"), F.col("P")).alias("tpr"),
                    F.try_divide(F.col("n_neg_cum"), F.col("N")).alias("fpr"),
                    F.try_divide(F.col("n_pos_cum"), F.col("n_pos_cum") + F.col("n_neg_cum"))
                    .alias("precision"))


# M20 / M21
def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("actual"), F.col(pred).alias("predicted")) \
             .agg(F.count(F.lit(1)).alias("n"))


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Per class precision / recall / F1 / support plus accuracy; 0 on zero division."""
    classes = df.select(F.col(label).alias("cls")).union(df.select(F.col(pred).alias("cls"))).distinct()
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 F.count_if(F.col(label) == F.col(pred)).alias("_ok"))
    per = with_scalars(classes, agg)
    tp = df.groupBy(F.col(label).alias("cls")).agg(
        F.count_if(F.col(label) == F.col(pred)).alias("tp"), F.count(F.lit(1)).alias("support"))
    pp = df.groupBy(F.col(pred).alias("cls")).agg(F.count(F.lit(1)).alias("pred_n"))
    r = per.join(tp, "cls", "left").join(pp, "cls", "left").fillna(0, ["tp", "support", "pred_n"])
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("pred_n")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
    return r.select("cls", prec.alias("precision"), rec.alias("recall"), f1.alias("f1"),
                    "support", (F.col("_ok") / F.col("_n")).alias("accuracy"))


# M23
def regression_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    e = F.col(y) - F.col(yhat)
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"),
                  F.sqrt(F.avg(e * e)).alias("rmse"),
                  (1 - F.sum(e * e) / (F.sum(F.col(y) * F.col(y))
                                       - F.sum(y) * F.sum(y) / F.count(F.lit(1)))).alias("r2"))


# Time-ordered split by position (first floor(frac * n) rows by ts, id)
def time_split(df: DataFrame, ts: str, tiebreak: list[str], frac: float = 0.8) -> DataFrame:
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    ranked = global_position(df, [F.col(ts), *[F.col(c) for c in tiebreak]], "_pos")
    return (with_scalars(ranked, n)
            .withColumn("split", F.when(F.col("_pos") <= F.floor(F.col("_n") * frac), F.lit("train"))
                        .otherwise(F.lit("test"))).drop("_n"))
