"""DBSCAN noise and global order against brute force."""

import numpy as np

from civora.operators import dbscan, ordering
from pyspark.sql import functions as F


def brute(z, eps, min_pts):
    near = ((z[:, None, :] - z[None, :, :]) ** 2).sum(2) <= eps ** 2
    core = near.sum(1) >= min_pts
    return ~core & ~(near & core[None, :]).any(1), near.sum(1)


def cloud(d, seed=1):
    rng = np.random.default_rng(seed)
    parts = [rng.normal(0, 0.25, (1200, d)), rng.normal(3, 0.5, (500, d)), rng.uniform(-4, 7, (150, d)),
             np.repeat(rng.uniform(-4, 7, (3, d)), 40, 0), np.repeat(rng.uniform(6, 9, (15, d)), 2, 0)]
    return np.concatenate(parts)


def frame(spark, x):
    cols = [f"x{i}" for i in range(x.shape[1])]
    rows = [(i, *map(float, r)) for i, r in enumerate(x)]
    schema = "id long, " + ", ".join(f"{c} double" for c in cols)
    return spark.createDataFrame([*rows, (-1, *[None] * len(cols)), (-2, *[float("nan")] * len(cols))], schema), cols


def test_noise_equals_brute_force(spark):
    for d, eps, min_pts in ((2, 0.15, 8), (2, 0.4, 60), (3, 0.3, 6), (1, 0.01, 5)):
        x = cloud(d)
        z = (x - x.mean(0)) / x.std(0)
        noise, near = brute(z, eps, min_pts)
        df, cols = frame(spark, x)
        got = {r.id: r.n_near for r in dbscan.dbscan_noise(df, "id", cols, eps, min_pts).collect()}
        assert got == {i: near[i] for i in np.flatnonzero(noise)}, (d, eps)
        assert noise.any() and not noise.all()


def test_large_cells_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(dbscan, "_CHUNK", 20)
    x = cloud(2)
    noise, _ = brute((x - x.mean(0)) / x.std(0), 0.15, 8)
    df, cols = frame(spark, x)
    assert {r.id for r in dbscan.dbscan_noise(df, "id", cols, 0.15, 8).collect()} == set(np.flatnonzero(noise))


def test_cap_and_rows_kept(spark):
    df, cols = frame(spark, cloud(2))
    n = df.count()
    marked = dbscan.mark_outliers(df, "id", cols, 0.1, 12).collect()
    cap = int(n * 0.02)
    assert len(marked) > cap and sum(r.removed for r in marked) == cap
    assert max(r.n_near for r in marked if r.removed) <= min(r.n_near for r in marked if not r.removed)
    kept = dbscan.drop_outliers(df, "id", cols, 0.1, 12)
    assert kept.count() == n - cap and {-1, -2} <= {r.id for r in kept.collect()}
    flat = spark.createDataFrame([(i, 1.0) for i in range(10)], "id long, x double")
    assert dbscan.dbscan_noise(flat, "id", ["x"], 0.1, 5).count() == 0


def test_global_position(spark):
    rows = [(i % 7, i) for i in range(500)]
    df = spark.createDataFrame(rows, "a long, b long").repartition(6)
    got = {(r.a, r.b): r.p for r in ordering.global_position(df, [F.col("a").desc(), F.col("b")], "p").collect()}
    assert got == {k: i for i, k in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])), 1)}
    assert ordering.global_position(df.limit(0), [F.col("a")], "p").count() == 0


def test_buckets_follow_the_data(spark):
    """An outlier leaves no bucket above 3 % of the rows, and buckets keep the order of the values."""
    rows = [(float(i % 9973),) for i in range(20_000)] + [(1e15,), (-1e15,), (None,)]
    df = ordering.range_bucket(spark.createDataFrame(rows, "x double"), "x")
    sizes = [r["count"] for r in df.where("x is not null").groupBy("_b").count().collect()]
    assert max(sizes) <= 0.03 * len(rows) and len(sizes) > 200
    got = df.where("x is not null").groupBy("_b").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("_b").collect()
    assert all(p.hi < q.lo for p, q in zip(got, got[1:]))
    for n in (0, 1, 2, 15, 16, 17, 40, 255):  # every number of cuts
        cuts = [float(2 * k) for k in range(n)]
        vals = spark.range(0, 2 * n + 2).select(F.col("id").alias("v"), ordering.bucket_of(F.col("id"), F.array(*map(F.lit, cuts)), n).alias("b"))
        assert all(r.b == sum(c <= r.v for c in cuts) for r in vals.collect()), n
