import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortlens.config import GROUP_COLUMNS
from cohortlens.functions.permutation import Permutation
from cohortlens.operators import allocation, stats, synth
from cohortlens.plans.registry import raw, treated

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def md(spark):
    t = treated(spark, SF)
    return synth.prepare_generation_metadata(t, stats.group_means(t), stats.group_stds(t), raw(spark, SF))


def plain_allocation(counts, n):
    """Largest remainders of a dict, ties in key order."""
    total = sum(counts.values())
    base = {k: n * c // total for k, c in counts.items()}
    for k in sorted(counts, key=lambda k: (-(n * counts[k] % total), k))[:n - sum(base.values())]:
        base[k] += 1
    return base


def test_allocation_equals_plain_largest_remainders(spark, md):
    counts = {tuple(r[c] for c in GROUP_COLUMNS): r.cnt for r in md.groups.collect()}
    for n in (1, 7, 1000, 123457, 10**14 + 3):
        out = synth.allocate_group_rows(md.groups.select(*GROUP_COLUMNS, "cnt"), n, md.total).collect()
        assert {tuple(r[c] for c in GROUP_COLUMNS): r.alloc for r in out} == plain_allocation(counts, n)


def test_allocation_with_many_ties(spark):
    """Equal counts: every remainder is the same, so keys decide."""
    df = spark.createDataFrame([(f"g{i:03}", 3 if i % 2 else 5) for i in range(300)], "k string, cnt long")
    counts = {r.k: r.cnt for r in df.collect()}
    for n in (1, 100, 150, 151, 299, 1199, 1200, 1201):
        out = allocation.allocate(df.repartition(5), ["k"], "cnt", n, 1200).collect()
        assert {r.k: r.alloc for r in out} == plain_allocation(counts, n)


@pytest.mark.parametrize("upper", [2, 1000, 1025, 10**6, 10**15])
def test_kth_largest(spark, upper):
    rng = random.Random(upper)
    xs = [rng.randrange(upper) for _ in range(60)] + [0, upper - 1, upper // 2, upper // 2]
    df = spark.createDataFrame([(x,) for x in xs], "x long")
    order = sorted(xs, reverse=True)
    for k in (1, 2, 30, 64):
        assert allocation.kth_largest(df, "x", k, upper) == (order[k - 1], sum(x > order[k - 1] for x in xs))


def test_starts_are_running_sums(spark):
    rows = [(i * 37 % 101, i) for i in range(101)]
    out = allocation.with_starts(spark.createDataFrame(rows, "k long, n long").repartition(7), ["k"], "n").orderBy("k").collect()
    at = 0
    for r in out:
        assert r.start == at
        at += r.n


def test_search_in_cumulative_shares(spark):
    for width in (1, 2, 3, 16, 17, 100):
        cum = [(i + 1) / width for i in range(width)]
        us = [0.0, 1e-9, *cum, *[c - 1e-9 for c in cum], 2.0]
        df = spark.createDataFrame([(u, cum) for u in us], "u double, cum array<double>")
        for r in df.select("u", allocation.found_in(F.col("cum"), F.col("u"), width).alias("i")).collect():
            assert r.i == sum(c <= r.u for c in cum)


def plain_permutation(n, seed):
    p = Permutation(n, seed)
    a, _ = p.sides
    out = []
    for x in range(n):
        x = p.once(x % a, x // a)
        while x >= n:
            x = p.once(x % a, x // a)
        out.append(x)
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 17, 97, 1000, 10007])
def test_permutation_is_a_bijection(spark, n):
    for seed in (0, 42):
        got = [r.y for r in Permutation(n, seed).add(spark.range(n), "id", "y").orderBy("id").collect()]
        assert sorted(got) == list(range(n)) and got == plain_permutation(n, seed)


def test_seeds_give_unrelated_orders():
    """Rank correlations and common places as of random orders (4 standard errors)."""
    n = 20_000
    orders = [np.arange(n)] + [np.array(plain_permutation(n, s)) for s in (1, 2, 3, 42)]
    for i, a in enumerate(orders):
        for b in orders[:i]:
            assert abs(np.corrcoef(a, b)[0, 1]) < 4 / np.sqrt(n)
            assert (a == b).sum() < 10
            step = (a - b) % n  # rotations of one order would differ by a constant
            assert len(np.unique(step)) > n / 2
    for a in orders[1:]:
        assert abs(np.corrcoef(a[:-1], a[1:])[0, 1]) < 4 / np.sqrt(n)


def test_large_permutations_stay_in_64_bits(spark):
    n = 10**15 + 37
    ids = [0, 1, 2, n // 2, n - 2, n - 1]
    p = Permutation(n, 7)
    a, _ = p.sides
    df = p.add(spark.createDataFrame([(i,) for i in ids], "id long"), "id", "y")
    for r in df.collect():
        x = p.once(r.id % a, r.id // a)
        while x >= n:
            x = p.once(x % a, x // a)
        assert r.y == x and 0 <= x < n


def test_seed_changes_the_groups_of_ids(spark, md):
    one, two = ({r.ID: r.Education + r.Marital_Status for r in synth.generate_synthetic(spark, md, n_rows=2000, random_state=s).collect()} for s in (1, 2))
    assert one.keys() == two.keys() and Counter(one.values()) == Counter(two.values())
    assert one != two and all(one != {(i + d) % 2000 + 1: g for i, g in two.items()} for d in range(0, 2000, 97))


def test_wide_distributions(spark, md):
    """10,000 distinct values in a group: no collect, and the draws follow the shares."""
    t = treated(spark, SF)
    many = spark.range(40_000).select(F.col("id").alias("__n")).withColumn("__j", F.pmod("__n", F.lit(t.count())).cast("int"))
    base = t.withColumn("__j", F.row_number().over(Window.orderBy("ID")) - 1)
    wide = (many.join(base.drop("Kidhome"), "__j").withColumn("Kidhome", F.col("__n") % 10_000).drop("__n", "__j")
            .withColumn("Education", F.lit("PhD")).withColumn("Marital_Status", F.lit("Single")))
    m = synth.prepare_generation_metadata(wide, stats.group_means(wide), stats.group_stds(wide), raw(spark, SF))
    assert m.widths["Kidhome"] == 10_000
    out = synth.generate_synthetic(spark, m, n_rows=5000).agg(
        F.min("Kidhome"), F.max("Kidhome"), F.count_distinct("Kidhome"), F.avg("Kidhome")).first()
    assert out[0] >= 0 and out[1] <= 9999 and 3800 < out[2] < 4100 and abs(out[3] - 4999.5) < 4 * 2887 / 5000 ** 0.5


def test_written_index_follows_the_ids(spark, md, tmp_path):
    from cohortlens import api
    path = api.write_synthetic_dataset(synth.generate_synthetic(spark, md, n_rows=500), str(tmp_path / "out"), index=True)
    back = spark.read.parquet(path)
    assert back.columns[0] == "index" and back.where("index <> ID - 1").count() == 0 and back.count() == 500
    with pytest.raises(ValueError):
        api.write_synthetic_dataset(spark.range(3), str(tmp_path / "none"), index=True)


def test_generation_independent_of_partitioning(spark, md):
    a = synth.generate_synthetic(spark, md, n_rows=3000, num_partitions=1)
    b = synth.generate_synthetic(spark, md, n_rows=3000, num_partitions=7)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.count() == 3000 and a.select("ID").distinct().count() == 3000
    assert a.columns == synth.get_synthetic_output_columns(raw(spark, SF).columns)


def test_values_within_bounds_and_valid(spark, md):
    syn = synth.generate_synthetic(spark, md, n_rows=2000)
    for c in ("Recency", "MntWines", "Income"):
        lo, hi = md.bounds[c]
        r = syn.agg(F.min(c), F.max(c)).first()
        assert lo <= r[0] and r[1] <= hi
    checks = {r["check"]: r["passed"] for r in synth.validate_synthetic(syn, raw(spark, SF), expected_rows=2000).collect()}
    assert all(checks.values()) and len(checks) == 8


def test_argument_errors(spark, md, tmp_path):
    with pytest.raises(ValueError):
        synth.generate_synthetic(spark, md, n_rows=0)
    with pytest.raises(ValueError):
        synth.generate_synthetic(spark, md, n_rows=10, noise_scale=-1)
    with pytest.raises(ValueError):
        synth.write_synthetic_dataset(spark.range(1), str(tmp_path / "x"), file_format="json")
    t = treated(spark, SF).drop("Recency")
    with pytest.raises(ValueError, match="not available"):
        synth.prepare_generation_metadata(t, stats.group_means(treated(spark, SF)), stats.group_stds(treated(spark, SF)), raw(spark, SF))


def test_proportions_close(spark, md):
    syn = synth.generate_synthetic(spark, md, n_rows=5000)
    comp = synth.proportion_comparison(treated(spark, SF), syn).collect()
    assert all(abs(r["difference"]) < 1 / 5000 + 1e-12 for r in comp)


def test_uniforms_are_the_slices_of_the_md5(spark):
    """The four uniforms of an md5 are its 32-bit slices, whatever the top bits."""
    import hashlib
    texts = [hashlib.md5(str(i).encode()).hexdigest() for i in range(300)] + ["0" * 32, "f" * 32, "80000000" * 4, "7fffffff" * 4, "8" + "0" * 31]
    df = spark.createDataFrame([(h,) for h in texts], "h string")
    out = df.select("h", *[synth.uniform(synth.hex_half(F.col("h"), k // 2), k % 2).alias(f"u{k}") for k in range(4)]).collect()
    for r in out:
        assert [r[f"u{k}"] for k in range(4)] == [(int(r["h"][8 * k:8 * k + 8], 16) + 0.5) / 2**32 for k in range(4)]


def test_generator_converts_each_md5_twice(spark, md):
    """Two conversions from hex per md5, and one per discrete column's draw."""
    out = synth.generate_synthetic(spark, md, n_rows=1000)
    names = {nm for nm, _ in [*synth.NORMAL_DRAWS.values(), *synth.UNIFORM_DRAWS.values()]}
    lines = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    halves = [x for x in lines if "Project [" in x and "__l_" in x and "conv(" in x]
    assert len(halves) == 1 and halves[0].count("conv(") <= 2 * len(names)
    assert sum(x.count("conv(") for x in lines if x not in halves and "__u_" in x) == 0


def test_only_the_generator_is_written_without_whole_stages(spark, monkeypatch):
    """The mart, the treated table and the metadata keep whole-stage code."""
    from cohortlens.plans import q_synth, registry
    seen, whole = {}, "spark.sql.codegen.wholeStage"
    at_start = spark.conf.get(whole)

    def metadata(s, d):
        seen["metadata"] = spark.conf.get(whole)
        return type("M", (), {"total": 1})

    class Out:
        write = property(lambda self: self)

        def parquet(self, path):
            seen["write"] = spark.conf.get(whole)
            spark.range(1).write.parquet(path)
    monkeypatch.setattr(q_synth, "metadata", metadata)
    monkeypatch.setattr(registry, "_MEMO", {})
    monkeypatch.setattr(synth, "generate_synthetic", lambda *a, **b: Out())
    assert q_synth.synthetic(spark, SF).count() == 1
    assert seen == {"metadata": at_start, "write": "false"} and spark.conf.get(whole) == at_start
