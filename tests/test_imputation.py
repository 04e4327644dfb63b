"""Chained imputation against a plain numpy chain, closed forms and edge tables."""

import numpy as np
import pandas as pd

from civora.operators import imputation as I


def _plain(x, rounds=50):
    """The same rounds by lstsq over the whole matrix, one column after the other."""
    gap = np.isnan(x)
    cur = np.where(gap, np.nanmean(x, 0), x)
    for _ in range(rounds):
        for j in np.argsort(gap.sum(0), kind="stable"):
            if gap[:, j].any():
                a = np.column_stack([np.delete(cur, j, 1), np.ones(len(x))])
                w = np.linalg.lstsq(a[~gap[:, j]], x[~gap[:, j], j], rcond=None)[0]
                cur[gap[:, j], j] = a[gap[:, j]] @ w
    return cur


def _table(n=600, seed=1):
    rng = np.random.default_rng(seed)
    z = rng.normal(size=(n, 2))
    e = rng.normal(size=(n, 4)) * [1, .5, 40, .6]  # no column is an exact mix of the others
    x = np.column_stack([z[:, 0] * 3 + 10, z[:, 0] + z[:, 1] + 5, z[:, 1] * 100, z @ [1, -2]]) + e
    x[rng.random(x.shape) < [0, .1, .2, .15]] = np.nan
    return x


def _frame(spark, x, names="abcd"):
    df = pd.DataFrame(x, columns=list(names))
    df.insert(0, "id", range(len(df)))
    return spark.createDataFrame(df).replace(float("nan"), None)


def test_equals_plain_chain(spark):
    x = _table()
    for rounds in (1, 2, 12):
        out = I.chained_impute(_frame(spark, x), list("abcd"), rounds=rounds, tol=0)
        got = out.orderBy("id").toPandas()[list("abcd")].to_numpy()
        assert np.allclose(got, _plain(x, rounds), atol=1e-6, rtol=0)
        assert np.array_equal(got[~np.isnan(x)], x[~np.isnan(x)])  # filled values stay exactly


def test_sums_of_rows_equal_sums_of_patterns(spark):
    df = _frame(spark, _table(200))
    one, two = (I.fit_chain(df, list("abcd"), rounds=3, tol=1e-12, patterns=p) for p in (I.PATTERNS, 2))
    assert len(one.steps) == len(two.steps) == 9 and [s[0] for s in one.steps] == [s[0] for s in two.steps]
    assert all(np.allclose([s[1], *s[2]], [t[1], *t[2]], atol=1e-9) for s, t in zip(one.steps, two.steps))


def test_stops_when_fills_settle(spark):
    df = _frame(spark, _table())
    loose, tight = (I.fit_chain(df, list("abcd"), rounds=60, tol=t) for t in (1e-2, 1e-5))
    assert loose.converged and tight.converged and loose.rounds < tight.rounds < 60
    short = I.fit_chain(df, list("abcd"), rounds=2, tol=1e-12)
    assert (short.rounds, short.converged, len(short.steps)) == (2, False, 6)


def test_one_incomplete_column_is_a_regression(spark):
    x = _table()[:, [0, 3]]
    got = I.chained_impute(_frame(spark, x, "ad"), ["a", "d"]).orderBy("id").toPandas()["d"].to_numpy()
    gap = np.isnan(x[:, 1])
    w, c = np.polyfit(x[~gap, 0], x[~gap, 1], 1)
    assert np.allclose(got[gap], x[gap, 0] * w + c)


def test_fitted_chain_fills_new_rows(spark):
    df = _frame(spark, _table())
    chain = I.fit_chain(df, list("abcd"), rounds=20, tol=1e-6)
    all_rows = {r.id: r for r in I.apply_chain(df, chain).collect()}
    assert all(all_rows[r.id] == r for r in I.apply_chain(df.where("id % 7 = 0"), chain).collect())


def test_edge_tables(spark):
    schema = "id int, a double, b int, empty double, same double, _raw string, _FILLED string"
    rows = [(1, 1.0, 2, None, 5.0, "x", "y"), (2, 2.0, 4, None, None, None, "y"), (3, None, None, None, 5.0, "x", "y"),
            (3, None, None, None, 5.0, "x", "y"), (None, 4.0, 8, None, 5.0, "x", None), (5, float("nan"), 6, None, 5.0, "x", "y")]
    df = spark.createDataFrame(rows, schema)
    cols = ["a", "b", "empty", "same"]
    out = I.chained_impute(df, cols, rounds=30, tol=1e-9)
    assert out.columns == df.columns and out.count() == 6
    got = out.collect()
    assert all(r.empty is None and r.a is not None and r.b is not None and abs(r.same - 5) < 1e-9 for r in got)
    assert abs([r.a for r in got if r.id == 5][0] - 3) < 1e-6 and {r["_raw"] for r in got} == {"x", None}
    assert I.chained_impute(df.limit(0), cols).count() == 0
    lone = I.chained_impute(df.select("id", "b"), ["b"]).where("id = 3").collect()
    assert [r.b for r in lone] == [5.0, 5.0]  # the mean


def test_missing_fill_drops_biased_gaps_and_fills_the_others(spark):
    rng = np.random.default_rng(5)
    n = 4000
    y = rng.normal(size=n)
    a, b = y + rng.normal(size=n), y * 2 + rng.normal(size=n)
    a[(y > .5) & (rng.random(n) < .5)] = np.nan  # depends on the label
    b[np.arange(n) % 11 == 3] = np.nan  # does not
    df = spark.createDataFrame(pd.DataFrame({"id": range(n), "y": y, "a": a, "b": b})).replace(float("nan"), None)
    kinds = {r["column"]: r["biased"] for r in I.missingness(df, ["a", "b"], "y").collect()}
    assert kinds == {"a": True, "b": False}
    out = I.missing_fill(df, ["a", "b"], "y").toPandas()
    assert sorted(out.id) == list(np.flatnonzero(~np.isnan(a))) and not out[["a", "b"]].isna().any().any()
    kept = I.missing_fill(df, ["a", "b"], "y", biased="impute").toPandas()
    assert len(kept) == n and not kept[["a", "b"]].isna().any().any()
    assert I.missing_fill(df.limit(0), ["a", "b"], "y").count() == 0
