import random

import numpy as np
from pyspark.sql import functions as F

from cohortlens.functions import quantiles
from cohortlens.functions.quantiles import exact_quantiles, quantile_wide


def test_matches_linear_interpolation(spark):
    rnd = random.Random(7)
    rows = []
    for g in range(12):
        n = g + 1 if g < 8 else rnd.randint(50, 400)
        for _ in range(n):
            rows.append((g, float(rnd.choice([rnd.randint(0, 20), rnd.random() * 1000]))))
    df = spark.createDataFrame(rows, "g int, v double")
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r["g"]: [r[f"q{i}"] for i in range(len(qs))] for r in quantile_wide(df, "v", qs, ["g"], accuracy=100).collect()}
    for g in range(12):
        vals = np.array([v for gg, v in rows if gg == g])
        want = np.percentile(vals, [q * 100 for q in qs])
        assert np.allclose(got[g], want, rtol=0, atol=1e-9), (g, got[g], want)


def test_hot_value_skew(spark):
    rows = [(1, 7.0)] * 5000 + [(1, float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(8)
    r = exact_quantiles(df, "v", [0.5, 0.99]).orderBy("qi").collect()
    want = np.percentile([v for _, v in rows], [50, 99])
    assert [x["quantile"] for x in r] == list(want)
    assert df.select(F.median("v")).first()[0] == want[0]


def test_more_groups_than_are_broadcast(spark, monkeypatch):
    """Beyond GROUPS the brackets are joined with a salt; the result is the same."""
    rnd = random.Random(9)
    rows = [(rnd.choice([0, 0, 0, *range(1, 25)]), rnd.choice([1.5, rnd.random() * 100])) for _ in range(900)]
    df = spark.createDataFrame(rows, "g int, v double")
    monkeypatch.setattr(quantiles, "GROUPS", 3)
    got = {r["g"]: (r["q0"], r["q1"]) for r in quantile_wide(df, "v", [0.25, 0.9], ["g"]).collect()}
    assert set(got) == {g for g, _ in rows}
    for g, q in got.items():
        assert np.allclose(q, np.percentile([v for h, v in rows if h == g], [25, 90]), rtol=0, atol=1e-9)
