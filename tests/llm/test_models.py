import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cohortlens.llm import mixing, packing, toxicity, url_filter
from llm_rows import rows


# ---- mixing

def brute_targets(sizes, weights=(3, 1, 2), share=1.5):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        free = total - sum(2 * sizes[s] for s in full)
        target = {s: 2 * sizes[s] if s in full else free * w[s] / sum(w[x] for x in order if x not in full) for s in order}
        over = {s for s in order if target[s] > 2 * sizes[s] + 1e-9} - full
        if not over:
            return target
        full |= over


def words(t):
    return len(re.findall("[^\x20\x09-\x0D]+", t or ""))


def make_docs(spark, n=400, seed=1):
    rng = random.Random(seed)
    data = [(i, "w " * rng.choice([0, 1, 5, 30, 200, rng.randrange(1, 900)]), rng.choice(["a", "b", "é", "z", "Z", None, "a"])) for i in range(n)]
    data += [(n + i, "copy of a text " * 20, "hot") for i in range(300)]
    return spark.createDataFrame(data, "doc_id long, text string, source string")


def test_mix_targets_bounds_and_reruns(spark):
    df = make_docs(spark)
    out = mixing.mix(df)
    got = {(r.doc_id): r for r in out.collect()}
    data = df.collect()
    sizes = Counter()
    for r in data:
        sizes[r.source] += words(r.text)
    target, taken = brute_targets(sizes), Counter()
    for r in data:
        g = got[r.doc_id]
        assert g.size == words(r.text) and g.source_size == sizes[r.source] and 0 <= g.taken <= 2 * g.size
        assert g.taken == g.copies * g.size
        assert math.isclose(g.target, target[r.source], rel_tol=1e-9)
        taken[r.source] += g.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(0.01 * target[s], 60), s
    assert rows(mixing.mix(df.repartition(11))) == rows(out)
    mixed = Counter(r.doc_id for r in mixing.mix_documents(df).collect())
    assert mixed == Counter({i: g.copies for i, g in got.items() if g.copies})


def test_dual_solution_is_the_balanced_one(spark):
    """The rates are min(2, exp(lambda x size)) and meet the target."""
    cells = spark.createDataFrame([("s", s, n) for s, n in [(10, 50), (100, 20), (1000, 7), (5000, 2)]], "key string, size long, n long")
    total = 10 * 50 + 2000 + 7000 + 10000
    for share in (0.2, 0.9, 1.0, 1.3, 1.9, 1.999):
        goal = spark.createDataFrame([("s", total, total * share)], "key string, source_size long, target double")
        lam = mixing.solve(cells, goal).first().lam
        met = sum(n * s * min(2, math.exp(lam * s / 1000)) for s, n in [(10, 50), (100, 20), (1000, 7), (5000, 2)])
        assert abs(met - total * share) <= 1


def test_mix_edges(spark, edge_docs, clashing_docs, no_docs):
    assert mixing.mix(no_docs).count() == 0 and mixing.mix_documents(no_docs).count() == 0
    out = mixing.mix(clashing_docs)
    assert out.count() == clashing_docs.count()
    assert rows(out) == rows(mixing.mix(edge_docs))
    total = sum(r.copies for r in out.collect())
    assert mixing.mix_documents(clashing_docs).columns == clashing_docs.columns
    assert mixing.mix_documents(clashing_docs).count() == total
    empty = edge_docs.where("doc_id IN (4, 5, 6)")
    assert all(r.taken == 0 for r in mixing.mix(empty).collect())


def plain_copies(cells):
    """One source's cells (size, n, rate): ranges of sizes from 0 carry, the last one with what the others are short of."""
    def round_down(part, carry):
        out = {}
        for size, n, r in sorted(part, reverse=True):
            want = carry + n * r * size
            out[size] = 0 if size == 0 else max(0, min(2 * n, math.floor(want / size + 0.5)))
            carry = want - out[size] * size
        return out, carry
    ranges = sorted({s // mixing.RANGE for s, _, _ in cells})
    copies, short = {}, 0.0
    for x in ranges[:0:-1]:
        got, carry = round_down([c for c in cells if c[0] // mixing.RANGE == x], 0.0)
        copies |= got
        short += round(carry, 6)
    return copies | round_down([c for c in cells if c[0] // mixing.RANGE == ranges[0]], short)[0]


def sized_cells(spark, n):
    rng = random.Random(n)
    cells = [("a", s, rng.randrange(1, 4)) for s in rng.sample(range(3 * n), n)]
    words = sum(s * k for _, s, k in cells)
    solved = spark.createDataFrame([("a", words, 0.8 * words, False, -0.3 / (3 * n) * 1000)], "key string, source_size long, target double, full boolean, lam double")
    return cells, spark.createDataFrame(cells, "key string, size long, n long"), solved


def test_rounding_in_ranges(spark):
    cells, df, solved = sized_cells(spark, 1500)
    lam = solved.first().lam
    rated = [(s, k, min(2.0, math.exp(lam * s / mixing.UNIT))) for _, s, k in cells]
    got = {r["size"]: (r.copies, r.extra) for r in mixing._rounded(df, solved).collect()}
    n_of = {s: k for _, s, k in cells}
    assert {s: c * n_of[s] + e for s, (c, e) in got.items()} == plain_copies(rated)
    words = sum(s * k * r for s, k, r in rated)
    assert abs(sum(s * (c * n_of[s] + e) for s, (c, e) in got.items()) - words) <= 20  # of 5.5 million


def test_rounding_takes_linear_time(spark):
    import time
    took = []
    for n in (20_000, 40_000):
        _, df, solved = sized_cells(spark, n)
        mixing._rounded(df, solved).count()
        t = time.perf_counter()
        mixing._rounded(df, solved).agg({"copies": "sum"}).collect()
        took.append(time.perf_counter() - t)
    assert took[1] < 2 * took[0] + 1


# ---- packing

def test_best_fit_takes_the_least_room():
    rng = random.Random(1)
    for _ in range(300):
        size = rng.choice([1, 2, 7, 16, 33, 64])
        items = sorted((rng.randint(1, size) for _ in range(rng.randint(0, 80))), reverse=True)
        fill = {}
        for n, row in zip(items, packing.best_fit(items, size)):
            rooms = [size - f for f in fill.values() if size - f >= n]
            if row in fill:
                assert size - fill[row] == min(rooms)
            else:
                assert not rooms
            fill[row] = fill.get(row, 0) + n
        assert all(f <= size for f in fill.values())


def test_packing_round_trip(spark, edge_docs, clashing_docs, no_docs, tmp_path):
    enc = packing._encoding(packing.default_ranks())
    docs = edge_docs.union(edge_docs.limit(3))  # all edges: null ids, repeated ids, repeated rows
    expected = sorted(((r.doc_id, enc.encode_ordinary(r.text or "") + [packing.END_ID]) for r in docs.collect()), key=repr)
    for wide, row in ((False, 64), (True, 2048)):
        packed = packing.write_packed(docs, str(tmp_path / f"p{row}"), row=row, wide=wide, shard_bytes=1 << 16)
        kind = "<u4" if wide else "<u2"
        for r in packed.collect():
            cu = r.cu_seqlens
            ids, place = np.frombuffer(r.ids, kind), np.frombuffer(r.positions, kind)
            assert len(ids) == len(place) == row and cu[0] == 0 and cu[-1] == r.n_tokens and (ids[cu[-1]:] == packing.END_ID).all()
            assert all((place[s:e] == np.arange(e - s)).all() for s, e in zip(cu, cu[1:])) and (place[cu[-1]:] == 0).all()
        assert rows(packing.unpack(packed, wide), "doc_id", "ids") == expected
    days = spark.createDataFrame([(1, "a b"), (2, "c")], "d int, text string").selectExpr("date'2020-01-01' + d AS doc_id", "text")
    assert packing.unpack(packing.pack(days)).select("doc_id").exceptAll(days.select("doc_id")).count() == 0
    assert rows(packing.pack(clashing_docs, row=64)) == rows(packing.pack(edge_docs, row=64))
    assert packing.pack(no_docs).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, row=0)


# ---- urls

def brute_urls(urls, order=4):
    def parts(u):
        if not u or "://" not in u:
            return "", ""
        rest = u.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):])[0]

    def rule(host, path):
        fits = [(h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits, key=lambda x: len(x[0]), default=(None, None))

    judged = [(*parts(u), *rule(*parts(u))) for u in urls]
    count = {c: Counter() for c in ("allow", "block")}
    for host, path, _r, v in judged:
        if v:
            t = "\x02" * order + re.sub("[0-9]", "0", host + path) + "\x03"
            for j in range(order, len(t)):
                for k in range(order + 1):
                    count[v][t[j - k:j + 1]] += 1
    seen = {c: defaultdict(lambda: [0, 0]) for c in count}
    for c in count:
        for g, n in count[c].items():
            seen[c][g[:-1], len(g)][0] += n
            seen[c][g[:-1], len(g)][1] += 1

    def p(c, g):
        out = 1 / 256
        for k in range(order + 1):
            x = g[order - k:]
            n, t = seen[c].get((x[:-1], len(x)), (0, 0))
            if n:
                out = (count[c][x] + t * out) / (n + t)
        return out

    def score(host, path):
        t = "\x02" * order + re.sub("[0-9]", "0", host + path) + "\x03"
        return sum(math.log(p("allow", t[j - order:j + 1]) / p("block", t[j - order:j + 1])) for j in range(order, len(t))) / (len(t) - order)

    return [(host, path, r, v, score(host, path)) for host, path, r, v in judged]


def test_url_filter_brute_force(spark):
    rng = random.Random(4)
    urls = [f"http{rng.choice(['', 's'])}://{rng.choice(['', 'www.', 'M.'])}{rng.choice(['exAmple.net', 'example.com', 'a.org', 'net', 'xnet', 'é.org'])}"
            f"{rng.choice(['', '/', '/en/', '/de/', '/fr/'])}{rng.choice(['', '12', 'abc.html', 'x/y?q=http://z.net/en/', '#top', 'a b'])}" for _ in range(150)]
    urls += [None, "", "no scheme", "://", "://net/x", "a://b://net/", "http://net", "http://x.net/\nline", "http://net/" + "a1b2" * 2000]
    df = spark.createDataFrame([(i, u, "c", "c") for i, u in enumerate(urls)], "page_id long, url string, host string, score string")
    got = {r.page_id: r for r in url_filter.judge(df).collect()}
    expected = brute_urls(urls)
    for i, (host, path, r, v, s) in enumerate(expected):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, r) and abs(got[i].score - s) < 1e-6
        assert got[i].verdict == v if v else got[i].verdict in ("allow", "block")
    # the method's verdicts follow one threshold, which separates the labelled urls at least as well as any other bin edge
    free = [(got[i].score, got[i].verdict) for i, x in enumerate(expected) if not x[3]]
    allowed = [s for s, v in free if v == "allow"]
    assert all(s < min(allowed, default=math.inf) for s, v in free if v == "block")
    again = {r.page_id: r for r in url_filter.judge(df.repartition(9)).collect()}
    assert again == got


def test_url_filter_edges(spark):
    df = spark.createDataFrame([(1, "http://a.de/x"), (None, None), (1, "http://a.de/x")], "page_id long, url string")
    out = url_filter.judge(df).collect()  # no class has a url: threshold 0, equal likelihoods
    assert len(out) == 3 and all(r.verdict == "allow" and r.score == 0 for r in out)
    assert url_filter.judge(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        url_filter.judge(df, rules=tuple((f"h{i}", "/", "allow") for i in range(501)))


# ---- toxicity

def test_chain_held_out(spark):
    """Rows that were not labelled are told apart; the second category needs the first."""
    rng = random.Random(8)
    plain = [f"word{i}" for i in range(300)]
    data, labels = [], []
    for i in range(900):
        rude, worse = rng.random() < 0.3, False
        w = rng.choices(plain, k=60)
        if rude:
            w[rng.randrange(60)] = rng.choice(["scumbag", "scummy", "idiots"])
            worse = rng.random() < 0.5
            if worse:
                w[rng.randrange(60)] = "threaten"
        data.append((i, " ".join(w)))
        labels.append((i, int(rude), int(worse)))
    df = spark.createDataFrame(data, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, rude int, threat int")
    chain = toxicity.train(df, lab.where("doc_id < 600"), ["rude", "threat"])
    out = {r.doc_id: r for r in toxicity.score(df, chain).collect()}
    held = [x for x in labels if x[0] >= 600]
    assert np.mean([(out[i].p_rude > 0.5) == bool(r) for i, r, _ in held]) > 0.97
    assert np.mean([out[i].threat == bool(t) for i, _, t in held]) > 0.97
    assert len(chain.link[0]) == 0 and len(chain.link[1]) == 1 and chain.link[1][0] != 0


def test_threshold_is_that_of_all_labelled_rows(spark, monkeypatch):
    """The cut keeps to the true share of the category when the bounds of the sample bind."""
    monkeypatch.setattr(toxicity, "POSITIVE_ROWS", 100)
    monkeypatch.setattr(toxicity, "OTHER_ROWS", 200)
    rng = random.Random(3)
    cues = ["scumbag", "idiots", "morons", "filthy", "vermin", "trash", "losers", "stupid", "hateful", "garbage"]
    data, labels = [], []
    for i in range(5000):
        toxic = rng.random() < 0.04
        data.append((i, " ".join([f"plain{rng.randrange(50)}", *(c for c in cues if rng.random() < (0.6 if toxic else 0.3))])))
        labels.append((i, int(toxic)))
    df = spark.createDataFrame(data, "doc_id long, text string")
    chain = toxicity.train(df, spark.createDataFrame(labels, "doc_id long, toxic int"), ["toxic"])
    out = {r.doc_id: r for r in toxicity.score(df, chain).collect()}
    p, y = np.array([out[i].p_toxic for i, _ in labels]), np.array([t for _, t in labels])

    def f1(flag):
        return 2 * (flag & (y == 1)).sum() / (flag.sum() + y.sum())

    assert f1(np.array([out[i].toxic for i, _ in labels])) >= 0.9 * max(f1(p >= c) for c in np.unique(p))


def plain_chain(texts, y, fold, features, least):
    """Out-of-fold and final probabilities by dense matrices: features chosen and weights fitted without the fold."""
    sets = [toxicity.text_features(t) for t in texts]
    names = sorted(set().union(*sets))
    x = np.array([[f in s for f in names] for s in sets], dtype=float)

    def choose(inside):
        xs, ys = x[inside], y[inside]
        n, picked = xs.sum(0), set()
        for j in range(y.shape[1]):
            share = (ys[:, j].sum() + 0.5) / (len(ys) + 1)
            with np.errstate(divide="ignore", invalid="ignore"):
                z = np.abs(xs.T @ ys[:, j] - n * share) / np.sqrt(n * share * (1 - share))
            usable = [i for i in range(len(names)) if n[i] >= least and x[:, i].sum() >= least]
            picked |= set(sorted(usable, key=lambda i: (-z[i], names[i]))[:features])
        return sorted(picked)

    def fit(m, t):
        share = t.mean()
        weight = np.where(t == 1, 0.5 / share, 0.5 / (1 - share)) / len(t)
        m = np.column_stack([m, np.ones(len(t))])
        theta, a, b = np.zeros(m.shape[1]), np.zeros(m.shape[1]), np.zeros(m.shape[1])
        for step in range(1, toxicity.STEPS + 1):
            g = m.T @ (weight * (1 / (1 + np.exp(-(m @ theta))) - t))
            g[:-1] += toxicity.RIDGE * theta[:-1]
            a, b = 0.9 * a + 0.1 * g, 0.999 * b + 0.001 * g * g
            theta = theta - toxicity.RATE * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
        return lambda m: 1 / (1 + np.exp(-(np.column_stack([m, np.ones(len(m))]) @ theta)))

    everyone = np.ones(len(y), bool)
    earlier, final, held = np.zeros((len(y), 0)), np.zeros((len(y), 0)), np.zeros((len(y), y.shape[1]))
    chosen = {f: choose(fold != f) for f in range(toxicity.FOLDS)} | {"all": choose(everyone)}
    chains = {f: np.zeros((len(y), 0)) for f in range(toxicity.FOLDS)}
    for j in range(y.shape[1]):
        whole = fit(np.column_stack([x[:, chosen["all"]], earlier]), y[:, j])
        out = np.zeros(len(y))
        for f in range(toxicity.FOLDS):
            inside = fold != f
            model = fit(np.column_stack([x[:, chosen[f]], earlier])[inside], y[inside, j])
            out[~inside] = model(np.column_stack([x[:, chosen[f]], earlier]))[~inside]
            chains[f] = np.column_stack([chains[f], model(np.column_stack([x[:, chosen[f]], chains[f]]))])
            held[~inside, j] = chains[f][~inside, j]
        final = np.column_stack([final, whole(np.column_stack([x[:, chosen["all"]], final]))])
        earlier = np.column_stack([earlier, out])
    return final, held


def test_chain_brute_force(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "FEATURES", 6)
    rng = random.Random(21)
    cues = ["scum", "moron", "vermin", "trash"]
    data = []
    for i in range(160):
        low = rng.random() < 0.4
        toxic = rng.random() < (0.6 if low else 0.1)
        w = [f"w{rng.randrange(40)}" for _ in range(8)] + (["lorem"] if low and rng.random() < 0.8 else []) + ([rng.choice(cues)] if toxic and rng.random() < 0.9 else [])
        data.append((i, " ".join(w), int(low), int(toxic)))
    df = spark.createDataFrame(data, "doc_id long, text string, low int, toxic int")
    chain = toxicity.train(df, df.select("doc_id", "low", "toxic"), ["low", "toxic"])
    fold = np.array([r.f for r in df.select("doc_id", toxicity._fold("doc_id").alias("f")).orderBy("doc_id").collect()])
    y = np.array([d[2:] for d in data], dtype=float)
    final, held = plain_chain([d[1] for d in data], y, fold, 6, toxicity.LEAST_TEXTS)
    got = toxicity._scored(df, chain, "doc_id", "text").orderBy("doc_id").collect()
    assert np.allclose([[r.p_low, r.p_toxic] for r in got], final, atol=1e-6)
    bins = np.floor(np.clip(np.log(held[:, 1] / (1 - held[:, 1])), -toxicity.FARTHEST, toxicity.FARTHEST) / toxicity.BIN)
    assert np.mean(np.array([r.bin for r in got]) == bins) > 0.98 and max(abs(r.bin - b) for r, b in zip(got, bins)) <= 1

    def f1(cut):
        flag = bins >= cut
        return 2 * (flag & (y[:, 1] == 1)).sum() / (flag.sum() + y[:, 1].sum())

    cut = np.log(chain.threshold / (1 - chain.threshold)) / toxicity.BIN
    assert f1(np.ceil(cut)) >= max(f1(c) for c in bins) - 0.01


def test_out_of_fold_scores_have_not_seen_the_fold(spark):
    """On random labels they are no better than chance. 4,000 rows: the area's own deviation is then 0.01, at 1,500 rows it is 0.016."""
    rng = random.Random(5)
    data = [(i, " ".join(rng.choices([f"word{k}" for k in range(3000)], k=60)), int(rng.random() < 0.3)) for i in range(4000)]
    df = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    chain = toxicity.fit_sample(df, df.select("doc_id", "toxic"), ["toxic"])
    bins = {r.doc_id: r.bin for r in toxicity._scored(df, chain, "doc_id", "text").collect()}
    score, y = np.array([bins[d[0]] for d in data], dtype=float), np.array([d[2] for d in data])
    ranks = np.unique(score, return_inverse=True)[1]
    order = np.array([(ranks < r).sum() + ((ranks == r).sum() + 1) / 2 for r in ranks])
    auc = (order[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))
    assert 0.45 < auc < 0.55, auc


def test_repeated_ids_do_not_grow_the_sample(spark):
    df = spark.createDataFrame([(i % 10, f"text {i}") for i in range(200)] + [(3, None)], "doc_id long, text string")
    lab = spark.createDataFrame([(i, i % 2) for i in range(10)], "doc_id long, toxic int")
    rows = toxicity.sample_labelled(df, lab, ["toxic"], "doc_id", "text").collect()
    assert sorted(r.doc_id for r in rows) == list(range(10)) and {r.doc_id: r.text for r in rows}[3] == ""


def test_toxicity_edges(spark, edge_docs, clashing_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = toxicity.judge(edge_docs, none)
    assert out.count() == edge_docs.count() and out.where("toxic").count() == 0
    one = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, None, 1), (None, 1, 1), (7, 0, 0), (99999, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.judge(clashing_docs, one).where("toxic").count() == 0  # one class only
    assert toxicity.judge(no_docs, one).count() == 0
