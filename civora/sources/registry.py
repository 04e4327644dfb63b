"""Model registry.

Artifacts are MLlib ``PipelineModel`` directories under
``<root>/models/<pipeline>/<version>``; metadata rows (pipeline, version,
trained_at, n, features, metrics JSON, passed) are appended to a Parquet
table, and a pointer table records which version is live. Rollback appends a
pointer row naming an older version -- nothing is copied or overwritten.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from civora.sources.tables import read_if_exists
from civora.session import scratch_path

META_SCHEMA = ("pipeline string, version string, trained_at timestamp, n long, features string, "
               "metrics string, passed boolean, path string")
POINTER_SCHEMA = "pipeline string, version string, set_at timestamp, reason string"


def _root(spark, root):
    return root or scratch_path(spark, "models")


def register(spark: SparkSession, pipeline: str, model, n: int, features: list[str],
             metrics: dict, passed: bool, root: str | None = None, version: str | None = None) -> str:
    """Save the model, append its metadata; move the pointer only if the gate passed."""
    import datetime as dt
    root = _root(spark, root)
    version = version or time.strftime("%Y%m%d_%H%M%S")
    path = f"{root}/{pipeline}/{version}"
    model.write().overwrite().save(path)
    now = dt.datetime.now()
    spark.createDataFrame([(pipeline, version, now, int(n), json.dumps(features),
                            json.dumps(metrics, default=float), bool(passed), path)], META_SCHEMA) \
        .write.mode("append").parquet(f"{root}/_metadata")
    if passed:
        set_live(spark, pipeline, version, "trained", root)
    return version


def set_live(spark: SparkSession, pipeline: str, version: str, reason: str = "rollback",
             root: str | None = None) -> None:
    """IO9: point the pipeline at ``version`` (append-only pointer history)."""
    import datetime as dt
    root = _root(spark, root)
    spark.createDataFrame([(pipeline, version, dt.datetime.now(), reason)], POINTER_SCHEMA) \
        .write.mode("append").parquet(f"{root}/_pointers")


def live_version(spark: SparkSession, pipeline: str, root: str | None = None) -> str | None:
    root = _root(spark, root)
    p = read_if_exists(spark, f"{root}/_pointers")
    if p is None:  # no pointer yet
        return None
    row = p.where(F.col("pipeline") == pipeline).orderBy(F.col("set_at").desc(), F.col("version").desc()).select("version").first()
    return row["version"] if row else None


def load_live(spark: SparkSession, pipeline: str, root: str | None = None):
    from pyspark.ml import PipelineModel
    v = live_version(spark, pipeline, root)
    return PipelineModel.load(f"{_root(spark, root)}/{pipeline}/{v}") if v else None


def history(spark: SparkSession, pipeline: str, root: str | None = None):
    return spark.read.parquet(f"{_root(spark, root)}/_metadata").where(F.col("pipeline") == pipeline)


# Several labels under one shared version ---------------------------------------------------

LABEL_SCHEMA = "pipeline string, version string, label string, revision int, metrics string, path string"


class GateFailed(Exception):
    """A model missed its gates: nothing was registered."""


def check_gates(metrics: dict, gates: dict) -> None:
    """Raise :class:`GateFailed` unless every gated metric reaches its minimum."""
    missed = [f"{k} {metrics.get(k)} < {v}" for k, v in gates.items() if metrics.get(k) is None or metrics[k] < v]
    if missed:
        raise GateFailed("; ".join(missed))


def label_table(spark: SparkSession, pipeline: str, root: str | None = None):
    """All registered label models, every revision (None before the first)."""
    rows = read_if_exists(spark, f"{_root(spark, root)}/_labels")
    return None if rows is None else rows.where(F.col("pipeline") == pipeline)


def current_labels(spark: SparkSession, pipeline: str, root: str | None = None):
    """The model in force per label of the pipeline's newest version: its latest revision."""
    rows = label_table(spark, pipeline, root)
    if rows is None:
        return None
    newest = rows.agg(F.max("version")).first()[0]
    return (rows.where(F.col("version") == newest).groupBy("version", "label")
            .agg(F.max_by(F.struct("revision", "metrics", "path"), "revision").alias("r")).select("version", "label", "r.*"))


def register_label(spark: SparkSession, pipeline: str, label: str, model, metrics: dict, gates: dict,
                   version: str | None = None, root: str | None = None) -> tuple[str, int]:
    """Save one label's model. Without ``version`` it joins the newest one, beside the other labels' models.

    The gates are checked first (a miss raises and writes nothing). A new
    revision is appended; models and rows of other labels are not touched.
    """
    check_gates(metrics, gates)
    root = _root(spark, root)
    rows = label_table(spark, pipeline, root)
    if version is None:
        version = (rows.agg(F.max("version")).first()[0] if rows is not None else None) or time.strftime("%Y%m%d_%H%M%S")
    mine = rows.where((F.col("version") == version) & (F.col("label") == label)).agg(F.max("revision")).first()[0] if rows is not None else None
    revision = 0 if mine is None else mine + 1
    path = f"{root}/{pipeline}/{version}/{label}-{revision}"
    model.write().overwrite().save(path)
    spark.createDataFrame([(pipeline, version, label, revision, json.dumps(metrics, default=float), path)], LABEL_SCHEMA) \
        .write.mode("append").parquet(f"{root}/_labels")
    return version, revision
