import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from cohortlens.llm import conversation_repair as cr
from cohortlens.llm.common import table
from llm_rows import rows

SCHEMA = "conv_id long, turn long, role string, text string"


def enumerated(kinds):
    """Every choice of edits for a few rows, with up to two inserts in each gap."""
    best = None
    gaps = ["", "u", "a", "ua", "au"]
    choices = [["D", "K", "Ru", "Ra"] if k != "x" else ["D"] for k in kinds]
    for edits in itertools.product(*choices):
        kept = [(k.lower() if e == "K" else e[1:]) for k, e in zip(kinds, edits)]
        cost = sum({"D": 2, "K": 0}.get(e, 1) + (5 if k.isupper() and e != "D" else 0) for k, e in zip(kinds, edits))
        for added in itertools.product(gaps, repeat=len(kinds) + 1):
            out = "".join(g + x for g, x in zip(added, ["" if e == "D" else x for e, x in zip(edits, kept)])) + added[-1]
            if re.fullmatch("(s?(ua)+)?", out):
                total = cost + 5 * sum(map(len, added))
                audit = "".join("I" * len(g) + e[0] for g, e in zip(added, edits)) + "I" * len(added[-1])
                best = min(best, (total, audit)) if best else (total, audit)
    return best


def recursive(kinds):
    """Least (cost, audit) by recursion over rows and states, for longer ones."""
    need = {"": "u", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def go(i, q, inserts):
        out = []
        if i == len(kinds):
            if q in ("", "a"):
                out.append((0, ""))
        else:
            k = kinds[i]
            c, a = go(i + 1, q, 0)
            out.append((c + 2, "D" + a))
            if k != "x":
                extra = 5 if k.isupper() else 0
                for label, price, to in [("K", 0, k.lower()), ("R", 1, "u"), ("R", 1, "a")]:
                    if to == need[q] or (to == "s" and q == "" and label == "K"):
                        c, a = go(i + 1, to, 0)
                        out.append((c + price + extra, label + a))
        if inserts < 3:
            c, a = go(i, need[q], inserts + 1)
            out.append((c + 5, "I" + a))
        return min(out) if out else (10**9, "")
    return go(0, "", 0)


def test_all_short_conversations():
    for n in (0, 1, 2):
        for kinds in itertools.product("suaoSUAOx", repeat=n):
            assert cr.least_repair("".join(kinds)) == enumerated("".join(kinds))
    rng = random.Random(4)
    for _ in range(12):
        kinds = "".join(rng.choice("suaoSUAOx") for _ in range(3))
        assert cr.least_repair(kinds) == enumerated(kinds)


@pytest.mark.parametrize("letters", ["suaoSUAOx", "ua", "uaUA", "sx", "U", "uuuua", "aaao"])
def test_longer_ones_and_blocks(letters, monkeypatch):
    rng = random.Random(letters)
    for n in (4, 9, 20, 63, 64, 65, 200):
        kinds = "".join(rng.choice(letters) for _ in range(n))
        assert cr.least_repair(kinds) == recursive(kinds)
    monkeypatch.setattr(cr, "BLOCK", 3)  # many blocks
    for _ in range(40):
        kinds = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 30)))
        assert cr.least_repair(kinds) == recursive(kinds)


def test_prices_are_a_dual():
    """No price exceeds an arc's cost and the price of its end."""
    b = cr.Block("uUxsaAo$", (0, 0, 0, 0))
    assert b.price(0) == recursive("uUxsaAo")[0]
    assert all(b.prices[i] <= cost + b.prices[to] for i, out in enumerate(b.arcs) for _, cost, to in out)


def test_work_grows_with_the_rows():
    cost, audit = cr.least_repair("uUaxs" * 40_000)  # a second or two; blocks are remembered
    assert len(audit) >= 200_000 and cost > 0


def damaged(data):
    out = {}
    for c, t, r, x in data:
        out.setdefault(c, [])
        key = f"{' ' if c is None else c}:{' ' if t is None else t}"
        code = zlib.crc32(key.encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if code == 0:
            continue
        x = "" if code == 1 else re.sub("[.!?]", "", x) if code == 2 else x
        r = "user" if code == 4 else r
        out[c] += [(t, r, x)] * (2 if code == 3 else 1)
    return out


def brute(data):
    result = []
    for c, rs in damaged(data).items():
        rs.sort(key=lambda r: (r[0] is not None, r[0], r[1], hashlib.md5(r[2].encode()).hexdigest()))
        kinds, seen, count = "", set(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, r, x in rs:
            text = re.sub("[\x20\x09-\x0D]+$", "", x)
            k = r[:1] if r[:1] in ("s", "u", "a") else "o"
            fault = "blank" if not text else "duplicate" if (r, x) in seen else "truncated" if text[-1] not in ".!?" else None
            seen.add((r, x))
            if fault:
                count[fault] += 1
            kinds += "x" if fault in ("blank", "duplicate") else k.upper() if fault else k
        cost, audit = recursive(kinds)
        turns = [t for t, _, _ in rs if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rs, rs[1:]))
        text, state, it = [], "", iter(rs)
        for label in audit:
            if label == "D":
                next(it)
                continue
            if label == "I":
                r, x = {"u": "assistant"}.get(state, "user"), ""
            else:
                _, r, x = next(it)
                r = {"u": "assistant"}.get(state, "user") if label == "R" else r
            state = r[:1]
            text.append(f"{r}:{x}")
        result.append((c, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count["blank"], count["duplicate"],
                       count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest()))
    return sorted(result, key=repr)


def conversations():
    rng, data = random.Random(9), []
    for c in range(120):
        for t in range(rng.randrange(1, 14)):
            if rng.random() < 0.9:
                role = ["user", "assistant"][t % 2] if rng.random() < 0.8 else rng.choice(["system", "user", "assistant", "tool", None, "", "User"])
                data.append((c, t if rng.random() < 0.97 else None, role, rng.choice([None, "", " \n", "Yes.", "No", "Well! \t", f"text {rng.random()}?", "é…", f"a. b {t}"])))
    data += [(None, t, "user" if t % 2 else "assistant", f"row {t}.") for t in range(9)] + [(500, None, None, None), (501, 3, "user", "x. " * 30_000)]
    return data + data[:20] + [(502, 0, "user", "the same.")] * 300


def test_brute_force(spark):
    data = conversations()
    df = spark.createDataFrame(data, SCHEMA)
    expected = brute(data)
    extra = df.selectExpr("*", "'x' AS kind", "'x' AS live", "'x' AS h", "'x' AS seen", "'x' AS full", "'x' AS copy", "'x' AS fault")
    for d in (df, df.repartition(7), extra):
        assert rows(cr.audits(cr.damage(d))) == expected


def test_dropped_conversations_and_none(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    out = cr.audits(cr.damage(spark.createDataFrame([(1, gone, "user", "a.")], SCHEMA))).collect()
    assert [tuple(r) for r in out] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    none = spark.createDataFrame([], SCHEMA)
    assert cr.audits(cr.damage(none)).count() == 0 and cr.repaired(cr.plain(none)).count() == 0


def test_repaired_rows(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "tool", "Yes!"), (1, 3, "user", "And"), (2, 0, "assistant", "Hm.")], SCHEMA)
    out = [tuple(r) for r in cr.repaired(cr.plain(df)).orderBy("conv_id", "position").collect()]
    assert out == [(1, 0, "K", "user", "Hi."), (1, 1, "R", "assistant", "Yes!")]
    legal = table(spark, "/root/testdata/sf0.001", "conversations")
    letters = {}
    for r in cr.repaired(cr.plain(legal)).orderBy("conv_id", "position").collect():
        letters[r.conv_id] = letters.get(r.conv_id, "") + r.role[0]
    assert letters and all(re.fullmatch("s?(ua)+", x) for x in letters.values())


def test_registered_query(spark):
    from cohortlens.llm import entries
    sf = "/root/testdata/sf0.001"
    data = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert rows(entries.queries()["op13_conversation_repair"](spark, sf)) == brute(data)
