"""Prefix sums, Lloyd rounds, drawn starts, the search and the saved models."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.config import DEFAULT, SEARCH_GRID, SEARCH_SEED
from cohortlens.operators import lloyd, rfm, rfm_ml
from cohortlens.plans import q_ml
from cohortlens.plans.registry import raw, rfm_models, treated

SF = "/root/testdata/sf0.001"


def histogram(spark, rows):
    return spark.createDataFrame(rows, "component string, value long, weight long")


def random_rows(n=400, seed=1):
    rng = random.Random(seed)
    return [(c, v, rng.randrange(1, 9)) for c in "xy" for v in sorted(rng.sample(range(-5000, 5000), n))]


def plain_rounds(rows, component, centers, rounds):
    """Lloyd over all values, one by one."""
    for _ in range(rounds):
        mids = [(a + b) / 2 for a, b in zip(centers, centers[1:])]
        sums = [[0, 0] for _ in centers]
        for c, v, w in rows:
            if c == component:
                i = sum(v > m for m in mids)
                sums[i][0] += v * w
                sums[i][1] += w
        centers = [s / w if w else c for (s, w), c in zip(sums, centers)]
    return centers


def plain_cost(rows, component, centers):
    mids = [(a + b) / 2 for a, b in zip(centers, centers[1:])]
    return sum(w * (v - Fraction(centers[sum(v > m for m in mids)])) ** 2 for c, v, w in rows if c == component)


@pytest.fixture(params=["few", "many", "no neighbours"])
def reading(request, monkeypatch):
    """Boundaries by filter or in tasks, and with jobs for every round."""
    monkeypatch.setattr(lloyd, "FEW", 0 if request.param == "many" else 32)
    monkeypatch.setattr(lloyd, "AHEAD", 0 if request.param == "no neighbours" else 64)


def test_prefix_sums_at_any_bound(spark, reading):
    rows = random_rows()
    sums = lloyd.PrefixSums.build(histogram(spark, rows).repartition(5))
    asked = {(c, b) for c in "xy" for b in [*range(-5100, 5100, 517), rows[0][1], rows[399][1], rows[0][1] - 1]}
    sums.read(asked)
    for c, b in asked:
        under = [(v, w) for x, v, w in rows if x == c and v <= b]
        assert sums.upto(c, b) == (sum(w for _, w in under), sum(v * w for v, w in under), sum(v * v * w for v, w in under))
    table = sums.table.where("component = 'x'").orderBy("value").collect()
    assert [r.pos for r in table] == list(range(1, 401))
    assert [r.next_value for r in table] == [r.value for r in table[1:]] + [lloyd.LAST]


def test_rounds_equal_plain_lloyd(spark, reading, monkeypatch):
    monkeypatch.setattr(lloyd, "REMEMBER", 100)
    rows = random_rows()
    sums = lloyd.PrefixSums.build(histogram(spark, rows))
    fits = [lloyd.Fit("x", [-5000.0, -4990.0, -4980.0, -4970.0], 3), lloyd.Fit("y", [-4000.0, 0.0, 0.5, 4000.0], 100_000, {2: None}),
            lloyd.Fit("x", [9000.0, 9001.0], 5)]
    begun = [list(f.centers) for f in fits]
    lloyd.run(sums, fits)
    for f, c in zip(fits, begun):
        assert f.centers == plain_rounds(rows, f.component, c, f.rounds)
    assert fits[0].rounds == 3 and fits[1].settled and fits[1].rounds > 3 and fits[1].stops[2] == plain_rounds(rows, "y", begun[1], 2)
    assert plain_rounds(rows, "y", fits[1].centers, 1) == fits[1].centers
    sums.read({(f.component, b) for f in fits for b in lloyd.boundaries(f.centers)})
    assert [sums.cost(f.component, f.centers) for f in fits] == [plain_cost(rows, f.component, f.centers) for f in fits]


def test_large_values_do_not_overflow(spark):
    rows = [("x", v * 10**9, 10**6) for v in range(-50, 50)]
    sums = lloyd.PrefixSums.build(histogram(spark, rows))
    fit = lloyd.Fit("x", lloyd.even_start(sums, "x", 3), 1000)
    lloyd.run(sums, [fit])
    assert fit.settled and sums.total["x"] == (10**8, sum(v * 10**15 for v in range(-50, 50)), sum(v * v * 10**24 for v in range(-50, 50)))


def plain_start(rows, component, k, init, seed):
    """The draws one by one."""
    values = [(v, w) for c, v, w in rows if c == component]
    chosen = []
    for step in range(min(k, len(values))):
        best = None
        for v, w in values:
            if v in chosen:
                continue
            mass = w * min((v - c) ** 2 for c in chosen) if chosen and init == "k-means++" else w
            u = float(lloyd.uniforms(np.array([seed]), step, np.array([v]))[0, 0])
            best = min(best, (-math.log(u) / mass, v)) if best else (-math.log(u) / mass, v)
        chosen.append(best[1])
    return [float(x) for x in sorted(chosen + chosen[-1:] * (k - len(chosen)))]


def test_drawn_starts_equal_plain_draws(spark):
    rows = random_rows(60) + [("one", 7, 3)]
    sums = lloyd.PrefixSums.build(histogram(spark, rows).repartition(6))
    asked = [(c, k, init, s) for c in ("x", "y", "one") for k in (2, 4) for init in ("k-means++", "random") for s in range(5)]
    assert lloyd.drawn_starts(sums, asked) == [plain_start(rows, *a) for a in asked]
    assert lloyd.drawn_starts(sums, [("absent", 3, "random", 1)]) == [[]]


def test_draws_follow_their_masses(spark):
    """First centres by weight; second ones of k-means++ by weight x squared distance."""
    rows = [("x", 0, 70), ("x", 10, 20), ("x", 40, 10)]
    sums = lloyd.PrefixSums.build(histogram(spark, rows))
    n = 4000
    one = [c[0] for c in lloyd.drawn_starts(sums, [("x", 1, "random", s) for s in range(n)])]
    for v, p in ((0, 0.7), (10, 0.2), (40, 0.1)):
        assert abs(one.count(v) / n - p) < 4 * math.sqrt(p * (1 - p) / n)
    two = [tuple(c) for c in lloyd.drawn_starts(sums, [("x", 2, "k-means++", s) for s in range(n)])]
    p = 0.7 * 2000 / 18000 + 0.2 * 7000 / 16000  # {0, 10}: 0 first, then 10, or the other way round
    assert abs(two.count((0.0, 10.0)) / n - p) < 4 * math.sqrt(p * (1 - p) / n)


def small_customers(spark, n=240):
    rng = random.Random(6)
    data = [(i, rng.choice([3, 4, 5, 20, 21, 60]) + rng.randrange(3), rng.randrange(2000), rng.choice([None, *range(80)])) for i in range(n)]
    return spark.createDataFrame(data, "ID long, Total_Purchases long, Total_Spent long, Recency long")


def test_search_scores_brute_force(spark):
    """Every fold score from plain draws, plain rounds and plain distances."""
    df = small_customers(spark)
    points = [(2, "k-means++", 3, 300), (4, "random", 4, 2), (4, "random", 4, 300), (4, "random", 1, 300), (3, "k-means++", 2, 1)]
    got = {(r.component, r.k, r.init, r.n_init, r.max_iter): r for r in rfm_ml.parameter_search(df, points=points, folds=3).collect()}
    rows = df.select("*", F.pmod(F.xxhash64("ID"), F.lit(3)).alias("fold")).collect()
    expected = {}
    for vc, _, _ in DEFAULT.rfm_components:
        for k, init, n_init, max_iter in points:
            scores = []
            for f in range(3):
                train = [(vc, r[vc], 1) for r in rows if r.fold != f and r[vc] is not None]
                test = [(vc, r[vc], 1) for r in rows if r.fold == f and r[vc] is not None]
                hist = {}
                for _, v, w in train:
                    hist[v] = hist.get(v, 0) + w
                train = [(vc, v, w) for v, w in hist.items()]
                best = None
                for i in range(n_init):
                    c, last = plain_start(train, vc, k, init, SEARCH_SEED + 7919 * i), None
                    for _ in range(max_iter):
                        c, last = plain_rounds(train, vc, c, 1), c
                        if c == last:
                            break
                    cost = plain_cost(train, vc, c)
                    best = (cost, c) if best is None or cost < best[0] else best
                scores.append(-float(plain_cost(test, vc, best[1])))
            expected[vc, k, init, n_init, max_iter] = sum(scores) / 3
    assert {key: r.mean_test_score for key, r in got.items()} == pytest.approx(expected, rel=1e-12)
    for (vc, *p), r in got.items():
        assert r.rank_test_score == 1 + sum(x > expected[vc, *p] for (o, *_), x in expected.items() if o == vc)
    by = lambda *p: [got[vc, *p].mean_test_score for vc, _, _ in DEFAULT.rfm_components]
    assert by(4, "random", 4, 2) != by(4, "random", 4, 300) != by(4, "random", 1, 300)  # max_iter and n_init count


def test_found_parameters_feed_the_fit(spark):
    df = small_customers(spark)
    search = rfm_ml.parameter_search(df, n_points=4, folds=2)
    params = rfm_ml.best_parameters(search)
    assert set(params) == {vc for vc, _, _ in DEFAULT.rfm_components}
    assert all(p["k"] in SEARCH_GRID["n_clusters"] and p["init"] in SEARCH_GRID["init"] for p in params.values())
    models = rfm.fit_rfm(df, params=params)
    for vc, m in models.items():
        rows = [(vc, r[vc], r["count"]) for r in df.where(F.col(vc).isNotNull()).groupBy(vc).count().collect()]
        p = params[vc]
        costs = []
        for i in range(p["n_init"]):
            c = plain_start(rows, vc, p["k"], p["init"], SEARCH_SEED + 7919 * i)
            for _ in range(p["max_iter"]):
                c = plain_rounds(rows, vc, c, 1)
            costs.append(plain_cost(rows, vc, c))
        assert plain_cost(rows, vc, m.centers) == min(costs) and len(m.centers) == p["k"]


def test_fit_raises_at_its_limit(spark):
    from dataclasses import replace
    with pytest.raises(RuntimeError):
        rfm.fit_rfm(small_customers(spark), replace(DEFAULT, rfm_max_rounds=1))


def test_component_without_values_has_no_model(spark):
    none = small_customers(spark).withColumn("Recency", F.lit(None).cast("long"))
    assert set(rfm.fit_rfm(none)) == {"Total_Purchases", "Total_Spent"}
    assert {r.component for r in rfm_ml.parameter_search(none, n_points=2, folds=2).collect()} == {"Total_Purchases", "Total_Spent"}


def test_mllib_models_against_the_deterministic_ones(spark):
    """Neither estimator's cost is far from the other's, and reloaded models label as the saved ones do."""
    t = treated(spark, SF)
    hist, models = rfm_ml.mllib_kmeans(t)
    own = rfm_models(spark, SF)
    for vc, m in models.items():
        rows = [(vc, r["value"], r["weight"]) for r in hist.where(F.col("component") == vc).collect()]
        a = float(plain_cost(rows, vc, sorted(float(c[0]) for c in m.clusterCenters())))
        b = float(plain_cost(rows, vc, own[vc].centers))
        assert a <= 1.5 * b and b <= 1.5 * a, vc
        assert a == pytest.approx(m.summary.trainingCost, rel=1e-6)
    first = [tuple(r) for r in q_ml.rfm_kmeans_ml(spark, SF).orderBy("component", "cluster").collect()]
    again = [tuple(r) for r in q_ml.model_roundtrip(spark, SF).orderBy("component", "cluster").collect()]
    assert first == again and sum(r[3] for r in first if r[0] == "Total_Spent") == t.count()


def test_saved_centres_label_as_the_fitted_ones(spark, tmp_path):
    own = rfm_models(spark, SF)
    back = rfm_ml.load_centers(spark, rfm_ml.save_centers(spark, own, str(tmp_path / "centres")))
    assert {vc: (m.centers, m.nonempty, m.higher_is_better) for vc, m in back.items()} == {vc: (m.centers, m.nonempty, m.higher_is_better) for vc, m in own.items()}
    r = raw(spark, SF)
    assert rfm_ml.score_new(r, back).exceptAll(rfm_ml.score_new(r, own)).count() == 0
