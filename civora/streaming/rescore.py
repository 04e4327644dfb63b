"""Streaming.

ST2: trailing incident counts as a watermarked sliding-window aggregation.
ST1: incremental rescore -- each micro-batch of new donations is merged into
per-supporter accumulators (``streaming.state``) and only the supporters it
touched are scored again; the result after the last batch equals a full batch
run, and history is never read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civora.session import scratch_path
from civora.sources.tables import table_path
from civora.streaming.state import KeyedState, append_scores


def incident_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events as an incident stream (file source over the events table)."""
    schema = spark.read.parquet(table_path(sf_dir, "events")).schema
    # the file source watches a directory; the glob keeps it to the events file(s)
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
           .option("pathGlobFilter", "events*.parquet").parquet(sf_dir))
    return (src.where(F.col("event_type") == "error")
               .select(F.col("event_id").alias("incident_id"), F.col("user_id").alias("case_id"),
                       F.col("ts").cast("timestamp").alias("ts"),   # watermark needs TIMESTAMP
                       F.when(F.col("value") > 100, "High").otherwise("Other").alias("severity")))


def trailing_incident_counts(stream: DataFrame, window: str = "30 days", slide: str = "1 day",
                             watermark: str = "2 days") -> DataFrame:
    """ST2: per case and sliding window, incident and high-severity counts.

    An incident that arrives again (same ``incident_id``) within the watermark
    counts once. That step sees every row by itself, so the rows it drops as
    older than the watermark are the late incidents, each once (:func:`late_rows`);
    the windows behind it then drop none.
    """
    return (stream.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["incident_id"])
                  .groupBy("case_id", F.window("ts", window, slide).alias("w"))
                  .agg(F.count(F.lit(1)).alias("incidents"),
                       F.count_if(F.col("severity") == "High").alias("high_incidents")))


def write_finished_windows(counts: DataFrame, path: str, checkpoint: str):
    """Start the query that appends every window to files once the watermark has passed its end."""
    return (counts.select("case_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                          "incidents", "high_incidents")
            .writeStream.outputMode("append").format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def late_rows(query) -> int:
    """Incidents the query dropped for being older than the watermark (that of the batch before theirs).

    Taken from the progress reports that the session keeps
    (``spark.sql.streaming.numRecentProgressUpdates`` batches).
    """
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress
               for op in p["stateOperators"] if op["operatorName"] == "dedupeWithinWatermark")


def q_trailing_incident_counts(spark, sf_dir):
    """Run ST2 to completion on the file source; return the windows the watermark has closed."""
    import uuid
    tag = uuid.uuid4().hex[:12]
    out = scratch_path(spark, "stream", f"st2-{tag}-windows")
    q = write_finished_windows(trailing_incident_counts(incident_stream(spark, sf_dir)), out,
                               scratch_path(spark, "stream", f"st2-{tag}"))
    q.awaitTermination()
    res = spark.read.schema("case_id long, window_start timestamp, window_end timestamp, incidents long, "
                            "high_incidents long").parquet(out)
    return res.select("case_id", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), "incidents", "high_incidents")


def rescore_from_state(stream: DataFrame, state: KeyedState, score_fn, scores_path: str, checkpoint: str,
                       compact_every: int = 16):
    """ST1: fold each micro-batch into the kept state and score the keys it touched.

    Work per batch follows the batch: its rows, the base buckets and recent
    deltas of its keys, and one score row per key. Every ``compact_every``
    batches the state is compacted.
    """
    def handle(batch: DataFrame, epoch: int):
        append_scores(score_fn(state.apply(batch, epoch)), scores_path, epoch)
        if epoch % compact_every == compact_every - 1:
            state.compact(epoch)

    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def incremental_rescore(spark: SparkSession, donations_stream: DataFrame, history: DataFrame,
                        feature_fn, score_fn, table: str = "churn_scores", n_buckets: int = 64):
    """ST1: foreachBatch -> affected keys -> semi-join history -> features -> bucketed upsert.

    For scores that need the whole history of a supporter rather than
    accumulators (:func:`rescore_from_state`): every batch reads ``history`` and
    rewrites the hash buckets of the supporters it touched.
    """
    from civora.sources.sinks import upsert_buckets
    path = scratch_path(spark, "tables", table)

    def handle(batch: DataFrame, epoch: int):
        keys = batch.select("supporter_id").distinct()
        affected = history.join(keys, "supporter_id", "left_semi")
        upsert_buckets(spark, path, score_fn(feature_fn(affected)), ["supporter_id"], n_buckets)

    return (donations_stream.writeStream.foreachBatch(handle)
            .option("checkpointLocation", scratch_path(spark, "stream", table)).start())


def rescored_table(spark: SparkSession, table: str) -> DataFrame:
    from civora.sources.sinks import read_buckets
    return read_buckets(spark, scratch_path(spark, "tables", table))


ST2_SQL = """
WITH e AS (SELECT user_id AS case_id, ts, value FROM events WHERE event_type = 'error'),
w AS (SELECT case_id, value, date_trunc('day', ts) - to_days(CAST(i AS INTEGER)) AS window_start
      FROM e, range(0, 30) r(i)),
mark AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 2 DAY AS watermark FROM e)
SELECT case_id, window_start, window_start + INTERVAL 30 DAY AS window_end, count(*) AS incidents,
       count(*) FILTER (WHERE value > 100) AS high_incidents
FROM w, mark WHERE window_start + INTERVAL 30 DAY <= watermark GROUP BY ALL
"""
