"""Kendall's tau-b against counting all pairs."""

import itertools
import random

from civora.operators.concordance import concordance, kendall_tau_b


def test_pairs(spark):
    rng = random.Random(4)
    for n, la, lb in ((400, 5, 300), (300, 1000, 1000), (200, 3, 2), (50, 1, 9)):
        rows = [(rng.randrange(la) / 2, rng.randrange(lb) - lb // 2) for _ in range(n)]
        c = d = ta = tb = 0
        for (a, b), (x, y) in itertools.combinations(rows, 2):
            c += (a - x) * (b - y) > 0
            d += (a - x) * (b - y) < 0
            ta += a == x
            tb += b == y
        df = spark.createDataFrame([*rows, (None, 1), (2.0, None)], "a double, b long")
        r = concordance(df, "a", "b").first()
        assert (r.concordant, r.discordant, r.tied_a, r.tied_b, r.rows) == (c, d, ta, tb, n)
        all_ = n * (n - 1) / 2
        tau = kendall_tau_b(df, "a", "b").first().tau_b
        assert tau is None if la == 1 else abs(tau - (c - d) / ((all_ - ta) * (all_ - tb)) ** 0.5) < 1e-12
    assert kendall_tau_b(df.limit(0), "a", "b").first().N == 0
