"""Queries that read a join several times compute it once; exact medians and regression sums against plain ones."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.ml.feature import Imputer

from civora.operators.prep import MedianImputer
from civora.operators.stats import ols


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root, rng = str(tmp_path_factory.mktemp("tables")), random.Random(3)
    day = lambda i: dt.date(1995, 1 + i % 12, 5)
    types = ["STANDARD", "ECONOMY"]

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")

    put("supplier", [(i, f"S{i}", 0, 1.0) for i in range(4)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")
    put("part", [(i, f"P{i}", "b", types[i % 2], 2 + i % 9, 1.0) for i in range(20)],
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    put("orders", [(i, i % 7, "OFP"[i % 3], 10.0 * i, day(i), "1-URGENT") for i in range(80)],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string")
    put("lineitem", [(i % 80, rng.randrange(20), rng.randrange(4), i // 80, float(rng.randrange(1, 50)), rng.uniform(1, 9),
                      rng.randrange(11) / 100, 0.04, "A", "F", day(rng.randrange(12))) for i in range(400)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate date")
    return root


@pytest.mark.parametrize("name", ["impute_scale", "missing_filled", "best_content_combo", "impact_statements", "statement_coverage"])
def test_join_is_read_once(spark, tables, name):
    """the result reads the kept rows, not the join of the tables again."""
    from civora.plans.registry import REGISTRY
    df = REGISTRY[name].fn(spark, tables)
    assert not [f for f in df.inputFiles() if "lineitem" in f]
    df.collect()


def test_median_imputer(spark):
    """the values of MLlib's imputer without a sketch of all values."""
    rng = random.Random(4)
    rows = [(rng.choice([None, float("nan"), rng.random()]), rng.choice([None, rng.randrange(9)])) for _ in range(101)]
    d = spark.createDataFrame(rows, "a double, b int")
    want = Imputer(inputCols=["a", "b"], outputCols=["x", "y"], strategy="median", relativeError=0.0).fit(d).transform(d)
    got = MedianImputer(["a", "b"], ["x", "y"]).fit(d).transform(d)
    assert got.schema["y"].dataType == want.schema["y"].dataType
    assert sorted(map(tuple, got.select("x", "y").collect())) == sorted(map(tuple, want.select("x", "y").collect()))


def test_ols_with_absorbed_groups(spark):
    """Slopes equal those with one dummy per group."""
    rng = random.Random(6)
    rows = [(i % 5, rng.random(), i % 2, 0.0) for i in range(60)]
    rows = [(g, x, z, 2 * x - z + g + rng.gauss(0, 0.1)) for g, x, z, _ in rows]
    fit = ols(spark.createDataFrame(rows, "g int, x double, z int, y double"), "y", ["x", "z"], absorb="g")
    design = np.array([[x, z, *[float(g == k) for k in range(5)]] for g, x, z, _ in rows])
    beta, *_ = np.linalg.lstsq(design, np.array([r[3] for r in rows]), rcond=None)
    assert fit["n"] == 60 and fit["dof"] == 53
    assert np.allclose([c["coef"] for c in fit["coefs"]], beta[:2])
