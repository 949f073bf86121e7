import hashlib
import random

import numpy as np
import pytest

from cohortlens.llm import multiset_hash as mh
from llm_rows import rows

ZERO = "0" * (16 * mh.WIDE + 4 * mh.SIGNS)


def plain_lanes(text):
    """The definition with Python integers, lane by lane."""
    wide, signs = [0] * mh.WIDE, [0] * mh.SIGNS
    for p in text.split("\n"):
        if not p.strip():
            continue
        d = hashlib.blake2b(p.encode(), digest_size=64).digest()
        for i in range(mh.WIDE):
            wide[i] = (wide[i] + int.from_bytes(d[8 * i:8 * i + 8], "little")) % 2**64
        phrase = []
        words = p.split()
        for j, w in enumerate(words):
            phrase.append(w)
            if w[-1] in ".,;:!?" or len(phrase) == 16 or j == len(words) - 1:
                bits = int.from_bytes(hashlib.blake2b(" ".join(phrase).encode(), digest_size=32).digest(), "big")
                for i in range(256):
                    signs[i] = (signs[i] + (1 if bits >> (255 - i) & 1 else -1)) % 2**16
                phrase = []
    return "".join(x.to_bytes(8, "little").hex() for x in wide) + "".join(x.to_bytes(2, "little").hex() for x in signs)


def brute(data, rank=lambda t: t):
    """All rows in one list; ``rank`` orders the texts of one id."""
    data = sorted(((i, t or "") for i, t in data), key=lambda r: (r[0] is not None, r[0], rank(r[1])))
    out = []
    for (i, t), (_, nxt) in zip(data, data[1:] + data[:1]):
        half = len(t) // 2
        new = t[:len(t) - half] + nxt[:half]
        a, e, b = plain_lanes(t), plain_lanes(new), plain_lanes(nxt)
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), a, e, round(plain_likeness(a, e), 9), round(plain_likeness(a, b), 9)))
    return sorted(out, key=repr)


def plain_likeness(a, b):
    if a == b:
        return 1.0

    def lanes(f):
        v = [int.from_bytes(bytes.fromhex(f[16 * mh.WIDE + 4 * i:][:4]), "little") for i in range(mh.SIGNS)]
        return [x - 2**16 if x >= 2**15 else x for x in v]
    x, y = lanes(a), lanes(b)
    common = sum(p * q for p, q in zip(x, y))
    either = sum(p * p for p in x) + sum(q * q for q in y) - common
    return min(max(common / either, 0), 1) if either else 0.0


def got(df):
    return sorted([(*r[:5], round(r[5], 9), round(r[6], 9)) for r in rows(df)], key=repr)


def texts(n, seed=2):
    rng = random.Random(seed)
    return [(i * 3 % n, "\n".join(" ".join(rng.choice("abcdefgh") * 2 + str(rng.randrange(50)) for _ in range(6)) + "."
                                  for _ in range(rng.randrange(0, 9)))) for i in range(n)]


def test_compare_brute_force(spark, edge_docs, clashing_docs):
    many = texts(100)
    assert got(mh.compare(spark.createDataFrame(many, "doc_id long, text string").repartition(5))) == brute(many)
    hashed = {r.text or "": r.h for r in edge_docs.selectExpr("text", "xxhash64(coalesce(text, '')) AS h").collect()}
    expected = brute([(r.doc_id, r.text) for r in edge_docs.collect()], hashed.__getitem__)
    for docs in (edge_docs, clashing_docs, edge_docs.repartition(7)):
        assert got(mh.compare(docs)) == expected


def test_repeated_rows_are_followed_by_their_copies(spark):
    data = [(1, "one. two")] * 1500 + [(2, "three. four")] + [(None, None)] * 700
    assert got(mh.compare(spark.createDataFrame(data, "doc_id long, text string"))) == brute(data)


def test_one_row_and_none(spark, no_docs):
    one = mh.compare(spark.createDataFrame([("a", "abcdef")], "doc_id string, text string")).collect()
    assert [(r.near_next, r.edited_sha256) for r in one] == [(1.0, hashlib.sha256(b"abcabc").hexdigest())]
    assert mh.compare(no_docs).count() == 0 and mh.fingerprints(no_docs).count() == 0


def test_homomorphism():
    parts = [p for _, t in texts(40) for p in t.split("\n") if p]
    whole = str(mh.Fingerprint.of("\n".join(parts)))
    random.Random(1).shuffle(parts)
    assert str(mh.Fingerprint.of("\n".join(parts))) == whole == plain_lanes("\n".join(parts))
    built = ZERO
    for p in parts:
        built = mh.insert(built, p)
    assert built == whole and mh.insert(mh.delete(whole, parts[3]), parts[3]) == whole
    assert mh.delete(whole, "\n".join(parts)) == ZERO == str(mh.Fingerprint.of(" \n\t")) and mh.delete(whole, parts[0]) != whole
    twice = mh.insert(whole, parts[0])
    assert twice != whole and str(mh.Fingerprint.parse(twice)) == twice


def test_groups_add_up(spark, monkeypatch):
    monkeypatch.setattr(mh, "GROUPS_HELD", 1)
    data = [(i, t, i % 3 if i % 4 else None) for i, t in texts(91)]
    df = spark.createDataFrame(data, "doc_id long, text string, g long")
    fp = mh.fingerprints(df).join(df.select("doc_id", "g"), "doc_id").repartition(40)
    expected = {g: plain_lanes("\n".join(t for _, t, x in data if x == g)) for g in (None, 0, 1, 2)}
    assert {r.g: r.fingerprint for r in mh.merged(fp, "g").collect()} == expected


@pytest.mark.parametrize("share", [0.0, 0.25, 0.5, 0.9])
def test_likeness_estimates_the_shared_part(share):
    """Phrases in common over phrases of either, within four standard errors."""
    errors = []
    for seed in range(30):
        rng = random.Random(seed)
        common = [f"c{seed} {rng.random()}." for _ in range(int(200 * share))]
        a, b = ([f"{x}{seed} {rng.random()}." for _ in range(200 - len(common))] for x in "ab")
        true = len(common) / (len(common) + len(a) + len(b))
        errors.append(mh.Fingerprint.of("\n".join(common + a)).likeness(mh.Fingerprint.of("\n".join(b + common))) - true)
    assert np.abs(errors).max() < 4 / 16 and abs(np.mean(errors)) < 0.05
