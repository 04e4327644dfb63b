"""Preparation steps that return treated rows."""

from civora.operators import prep


def test_drop_missing(spark):
    rows = [(i, None if i % 3 else 1, i if i % 5 else None, "x" if i != 7 else None) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, mostly int, some int, text string")
    got = prep.drop_missing(df, ["mostly", "some", "text"], row_threshold=0.9)
    assert got.columns == ["id", "some", "text"]
    assert sorted(r.id for r in got.collect()) == [i for i in range(20) if i % 5 and i != 7]
    assert len(prep.drop_missing(df, ["mostly", "some", "text"], row_threshold=0.5).collect()) == 20
    assert prep.drop_missing(df.limit(0), ["mostly", "some"]).columns == df.columns


def test_replace_outliers(spark):
    xs = [float(i % 10) for i in range(200)] + [500.0, None]
    out = [r.x for r in prep.replace_outliers(spark.createDataFrame([(x,) for x in xs], "x double"), ["x"]).collect()]
    assert sorted(x for x in out if x is not None)[-1] < 30 and out.count(None) == 1 and len(out) == 202
    assert sorted(x for x in out if x is not None)[:200] == sorted(xs[:200])
