"""ST2: finished windows and late incidents, with rows planted behind the watermark."""

import collections
import datetime as dt
import os
import random
import time

import pyarrow as pa
import pyarrow.parquet as pq

from pyspark.sql import functions as F

from civora.streaming import rescore
from civora.streaming.state import KeyedState, gift_accumulators, trend

DAY0 = dt.datetime(2024, 1, 1)


def write(path, rows):
    cols = list(zip(*rows))
    pq.write_table(pa.table({"incident_id": pa.array(cols[0], pa.int64()), "case_id": pa.array(cols[1], pa.int64()),
                             "ts": pa.array(cols[2], pa.timestamp("us", tz="UTC")), "severity": pa.array(cols[3])}), path)


def test_late_rows_and_finished_windows(spark, tmp_path):
    hour = dt.timedelta(hours=1)
    first = [(i, i % 3, DAY0 + hour * i * 7, "High" if i % 5 == 0 else "Other") for i in range(60)]   # up to day 17
    mark = first[-1][2] - dt.timedelta(days=2)
    second = [(100 + i, 1, mark - hour * (i + 1), "High") for i in range(11)]                          # late: dropped
    second += [(200 + i, 2, mark + hour * (i + 1), "Other") for i in range(5)]                         # within the watermark
    second += [first[-1], (300, 0, DAY0 + dt.timedelta(days=40), "Other")]                             # a repeat, a jump ahead
    src = tmp_path / "in"
    src.mkdir()
    between = [(400, 1, mark + hour, "High")]
    for k, rows in enumerate((first, between, second)):
        write(str(src / f"part{k}.parquet"), rows)
        os.utime(src / f"part{k}.parquet", (time.time() - 100 + k * 10,) * 2)
    stream = (spark.readStream.schema("incident_id long, case_id long, ts timestamp, severity string")
              .option("maxFilesPerTrigger", 1).parquet(str(src)))
    counts = rescore.trailing_incident_counts(stream, window="3 days")
    q = rescore.write_finished_windows(counts, str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    assert rescore.late_rows(q) == 11
    want = collections.Counter()
    closed = DAY0 + dt.timedelta(days=38)
    for _, case, ts, severity in first + between + second[11:16] + second[-1:]:
        day = ts.replace(hour=0, minute=0)
        for back in range(3):
            start = day - dt.timedelta(days=back)
            if start + dt.timedelta(days=3) <= closed:
                want[case, start, "all"] += 1
                want[case, start, "high"] += severity == "High"
    got = collections.Counter()
    for r in spark.read.parquet(str(tmp_path / "out")).collect():
        got[r.case_id, r.window_start, "all"] += r.incidents
        got[r.case_id, r.window_start, "high"] += r.high_incidents
    assert +got == +want


def gifts(rng, keys, n):
    return [(rng.choice(keys), DAY0.date() + dt.timedelta(days=rng.randrange(900)), round(rng.uniform(1, 500), 2),
             rng.random() < 0.3) for _ in range(n)]


GIFT = "supporter_id long, donation_date date, value double, is_recurring boolean"


def test_kept_state_follows_the_batch(spark, tmp_path):
    """Any order of batches gives the state of one run; a batch reads and writes in proportion to its keys."""
    rng = random.Random(8)
    batches = [gifts(rng, range(4000), 6000), gifts(rng, range(4000), 3000),
               [(k, DAY0.date(), 5.0, True) for k in range(4000, 4010)] + gifts(rng, range(100, 110), 15),
               gifts(rng, range(95, 115), 60)]
    acc = gift_accumulators(F.col("value"), recurring=F.col("is_recurring"))
    state = KeyedState(spark, str(tmp_path / "state"), "supporter_id", acc, n_buckets=128)
    moved = []
    for epoch, rows in enumerate(batches):
        df = spark.createDataFrame(rows, GIFT)
        base = state.touched_base(df)
        moved.append(base.count() if base is not None else 0)
        state.apply(df, epoch)
        assert state.apply(df, epoch).count() == len({r[0] for r in rows})  # an epoch that runs again counts once
        if epoch == 1:
            state.compact(1)
    assert all(0 < n <= 20 * 4000 / 128 * 2 for n in moved[2:])
    everything = spark.createDataFrame([r for b in batches for r in b], GIFT)
    want = {r.supporter_id: r for r in everything.groupBy("supporter_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("s"), F.max("value").alias("hi"), F.min("donation_date").alias("d0"),
        F.max("donation_date").alias("d1"), F.max(F.col("is_recurring").cast("int")).alias("rec"),
        F.regr_slope("value", F.unix_date("donation_date").cast("double")).alias("slope")).collect()}
    got = {r.supporter_id: r for r in state.current().withColumn("slope", trend()).collect()}
    assert got.keys() == want.keys()
    for k, r in got.items():
        w = want[k]
        assert (r.frequency, r.max_value, r.first_date, r.last_date, r.ever_recurring) == (w.n, w.hi, w.d0, w.d1, w.rec)
        assert abs(r.total_value - w.s) < 1e-6
        assert (r.slope is None) == (w.slope is None) and (w.slope is None or abs(r.slope - w.slope) < 1e-5 * max(1, abs(w.slope)))
