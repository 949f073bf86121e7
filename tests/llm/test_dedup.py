import hashlib
import re
import random
from collections import Counter

import numpy as np
import pytest

from cohortlens.llm import common, exact_dedup, simhash
from llm_rows import rows


def norm(t):
    return re.sub("[\x20\x09-\x0D]+", " ", t or "")


def test_exact_copies_brute_force(edge_docs, clashing_docs):
    data = [(r.doc_id, norm(r.text)) for r in edge_docs.collect()]
    least, size = {}, Counter(t for _, t in data)
    for i, t in data:
        if i is not None and (t not in least or least[t] is None or i < least[t]):
            least[t] = i
        least.setdefault(t, None)
    expected = sorted(((i, least[t], size[t], hashlib.sha256(t.encode()).hexdigest()) for i, t in data), key=repr)
    for docs in (edge_docs, clashing_docs, edge_docs.repartition(7)):
        out = exact_dedup.group_copies(docs)
        assert rows(out, "doc_id", "keep_id", "group_size", "text_sha256") == expected
        kept = out.where("kept").collect()
        assert Counter(r.text_sha256 for r in kept) == Counter({hashlib.sha256(t.encode()).hexdigest(): 1 for t in size})
        assert all(r.doc_id == r.keep_id for r in kept)


def test_exact_dedup_keeps_columns_and_one_row(edge_docs, clashing_docs, no_docs):
    out = exact_dedup.deduplicate(clashing_docs)
    assert out.columns == clashing_docs.columns
    kept = out.collect()
    assert len(kept) == len({norm(r.text) for r in edge_docs.collect()})
    assert len({norm(r.text) for r in kept}) == len(kept)
    assert exact_dedup.group_copies(no_docs).count() == 0 and exact_dedup.deduplicate(no_docs).count() == 0


def test_exact_dedup_hot_group(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot', concat('t', id)) AS text")
    out = exact_dedup.group_copies(df)
    assert out.where("kept").count() == 2001
    assert out.where("group_size = 1000 AND keep_id = 0").count() == 1000


def test_runs_are_merged_in_digest_order(spark):
    """A round sorts the entries of its runs and passes over neighbours; no hash aggregate."""
    rng = random.Random(3)
    data = [(f"{rng.randrange(40):02}", 1, 1, rng.randrange(4), rng.choice([None, *range(100)]), rng.randrange(1, 5)) for _ in range(500)]
    out = exact_dedup._merged(spark.createDataFrame(data, "sha string, chk long, len int, run long, keep long, size long"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Sort [run" in plan and "Window" in plan and "HashAggregate" not in plan
    expected = {}
    for sha, _, _, run, keep, size in data:
        k, n = expected.get((run, sha), (None, 0))
        expected[run, sha] = (min(x for x in (k, keep) if x is not None) if (k, keep) != (None, None) else None, n + size)
    assert {(r.run, r.sha): (r.keep, r["size"]) for r in out.collect()} == expected


def brute_components(fps, ids):
    """Smallest id reachable, by comparing all pairs."""
    f = np.array(fps, dtype=np.uint64)
    near = np.bitwise_count(f[:, None] ^ f[None, :]) <= 3
    label = np.arange(len(f))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            break
        label = new
    least = {}
    for g, i in zip(label, ids):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return [least.get(g) for g in label]


def plain_fingerprint(text, k=3):
    import xxhash
    words = [w for w in re.split("[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text)) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprint_matches_spark_hash_and_plain_form(spark, edge_docs):
    for t in ("", " ", "a", "a b", "a b c", "A B C d e f g ä Ö  x", "w " * 100):
        assert simhash.fingerprint(t) == plain_fingerprint(t)
    one = spark.createDataFrame([("a b c",)], "t string").selectExpr("xxhash64(t) AS h").first().h
    assert simhash.fingerprint("A b C") == one & (2**64 - 1)  # one shingle: its hash


def test_simhash_components_brute_force(spark, edge_docs, clashing_docs):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefghijklmnop") * 3 + str(rng.randrange(99)) for _ in range(400)) for _ in range(6)]
    docs = []
    for i in range(150):
        w = rng.choice(base).split()
        for _ in range(rng.randrange(0, 12)):
            w[rng.randrange(len(w))] = "edit"
        docs.append((i, " ".join(w)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for d in (df, edge_docs, clashing_docs):
        data = [(r.doc_id, r.text or "") for r in d.select("doc_id", "text").collect()]
        fps = [plain_fingerprint(t) for _, t in data]
        expected = sorted(zip([i for i, _ in data], [f"{f:016x}" for f in fps], brute_components(fps, [i for i, _ in data])), key=repr)
        assert rows(simhash.near_duplicates(d), "doc_id", "fingerprint", "component_id") == expected


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_links_lose_none_in_crowded_buckets(spark, bits):
    rng = np.random.default_rng(bits)
    values = set()
    for base in rng.integers(-2**62, 2**62, 3).tolist():
        for _ in range(120):  # far over BUCKET per variant
            x = base & (2**64 - 1)
            for b in rng.integers(0, 64, rng.integers(0, 4)).tolist():
                x ^= 1 << b
            values.add(x - 2**64 if x >= 2**63 else x)
    values = sorted(values)
    u = np.array(values, dtype=np.int64).view(np.uint64)
    near = np.bitwise_count(u[:, None] ^ u[None, :]) <= bits
    expected = {(values[i], values[j]) for i, j in zip(*np.where(near)) if i < j}
    got = [(r.a, r.b) for r in simhash.links(spark.createDataFrame([(v,) for v in values], "fp long"), bits).collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    out = {r.node: r.root for r in simhash.components(edges).collect()}
    assert all(out[i] == 0 for i in range(1, 201)) and out[501] == 500


def plain_roots(pairs):
    """Smallest node reachable, by relabelling until nothing changes."""
    root = {x: x for p in pairs for x in p}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


@pytest.mark.parametrize("broadcast_rows", [20_000, 0])
def test_components_with_hot_nodes(spark, monkeypatch, broadcast_rows):
    """Stars around the smallest, a middle and the largest node, chains and random pairs, with the limits set low."""
    monkeypatch.setattr(simhash, "HOT", 5)
    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast_rows)
    rng = random.Random(11)
    pairs = [(0, i) for i in range(1, 40)] + [(150, i) for i in range(100, 200) if i != 150] + [(i, 399) for i in range(300, 399)]
    pairs += [(i, i + 1) for i in range(500, 512)] + [(rng.randrange(600, 700), rng.randrange(700, 800)) for _ in range(60)] + [(39, 150)]
    expected = plain_roots(pairs)
    shuffled = [p if rng.random() < 0.5 else p[::-1] for p in pairs]
    out = simhash.components(spark.createDataFrame(shuffled + shuffled[:9], "a long, b long")).collect()
    assert len(out) == len({r.node for r in out})
    assert {r.node: r.root for r in out} == {x: m for x, m in expected.items() if x != m}


def test_components_of_no_pairs(spark):
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("broadcast_rows", [20_000, 0])
def test_near_duplicates_with_hot_fingerprints(spark, monkeypatch, edge_docs, broadcast_rows):
    """A third of all rows has one fingerprint; null and repeated ids among them."""
    crowd = spark.createDataFrame([(i if i % 7 else None, None if i % 2 else " ") for i in range(5000, 5040)], "doc_id long, text string")
    docs = edge_docs.select("doc_id", "text").unionByName(crowd)
    whole = rows(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id")
    monkeypatch.setattr(simhash, "HOT", 5)
    monkeypatch.setattr(common, "BROADCAST_ROWS", broadcast_rows)
    data = [(r.doc_id, simhash.fingerprint(r.text or "")) for r in docs.collect()]
    expected = sorted(((i, f"{f:016x}", c) for (i, f), c in zip(data, brute_components([f for _, f in data], [i for i, _ in data]))), key=repr)
    assert rows(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == expected == whole


def test_near_dedup_keeps_one_per_group(clashing_docs, no_docs):
    out = simhash.deduplicate(clashing_docs)
    assert out.columns == clashing_docs.columns
    fps = [plain_fingerprint(r.text or "") for r in out.collect()]
    assert len(fps) == len(set(brute_components(fps, list(range(len(fps))))))
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.deduplicate(no_docs).count() == 0
    with pytest.raises(ValueError):
        simhash.links(no_docs, 4)
