"""Secret scan: three patterns, and a randomness test battery.

Long runs of letters, digits and + / _ - that no pattern covers are tested for
randomness. The encoding is inferred from the characters present. The null
hypothesis is an ordinary, structured name of that encoding; three tests look
for departures from it:

* uniformity: the chi-squared statistic over the encoding's alphabet is lower
  than symbols with the collision rate of ordinary names give;
* runs: there are more changes between lower case, upper case, digits and
  signs than in ordinary names;
* serial correlation of neighbouring symbols is lower than in ordinary names.

The three are combined as a weighted sum of their normal deviates (Stouffer).
A test weighs by what it expects of uniform strings of the same encoding and
length, so one with little to tell does not hold the others back, and unlike
with Fisher's or Cauchy's combination a string that one test finds ordered
(abc...xyz has no collisions) is not reported for the other's sake. The rates
of ordinary names are constants, not counts over the candidates: where most
candidates are secrets, those would be the rates of secrets.

Benjamini-Hochberg runs over all candidates of the corpus, separately by
encoding and length, as a long string gives far more evidence than a short
one. Its thresholds come from a histogram of p-values of bounded size. All in
DataFrame functions; positions of matches are prefix sums inside the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import cut, text_of

#: The patterns.
ASSIGN = (r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
          r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{16,}"  # as AKIA[A-Z0-9]+ of 20 characters: a shorter run holds no longer match
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"  # runs are maximal
KINDS = ("assign", "access", "hex", "random")
MIN_ASSIGN = 6
#: Candidates of the battery.
MIN_LENGTH = 20
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings, the first that has all characters is inferred; collision rate and share of class changes of ordinary names in it.
#: base62 and base64 are means over 5,202 names of 20 characters or more with a letter and a digit in Python sources; the
#: one-case encodings had too few (175, many of them random) and are set by their medians and by hand.
ENCODINGS = (("hex", "^[0-9a-f]+$", _DIGITS + "abcdef", 0.11, 0.17), ("upper hex", "^[0-9A-F]+$", _DIGITS + "ABCDEF", 0.11, 0.17),
             ("base32", "^[A-Z2-7]+$", _UPPER + "234567", 0.08, 0.1), ("base36", "^[0-9a-z]+$", _DIGITS + _LOWER, 0.08, 0.1),
             ("upper base36", "^[0-9A-Z]+$", _DIGITS + _UPPER, 0.08, 0.1), ("base62", "^[0-9A-Za-z]+$", _DIGITS + _UPPER + _LOWER, 0.045, 0.35),
             ("base64", "", _UPPER + _LOWER + _DIGITS + "+/-_", 0.061, 0.3))
#: Serial correlation of ordinary names (mean of the same names), and its weight: uniform strings differ little from them.
CORRELATION, SERIAL_WEIGHT = 0.24, 1.0
#: False discovery rate, bins per power of ten of p, powers of ten told apart.
FDR, BINS, DEEPEST = 0.01, 20, 30
#: Lengths are told apart up to these.
BANDS = (24, 32, 48, 64, 96, 128, 256)
_BLOCK = 128


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _ends(lengths: Column) -> Column:
    """Prefix sums of a non-empty array, block by block: the work grows with
    the length of the array, not its square."""
    zero = F.lit(0).cast("long")

    def total(a: Column) -> Column:
        return F.aggregate(a, zero, lambda s, x: s + x)

    def of(n: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(n) - 1) / _BLOCK).cast("int"))
        blocks = F.transform(numbers, lambda b: total(F.slice(n, b * _BLOCK + 1, _BLOCK)))
        before = _let(blocks, lambda k: F.transform(numbers, lambda b: total(F.slice(k, F.lit(1), b))))
        return _let(before, lambda k: F.transform(n, lambda x, i: F.element_at(k, (F.floor(i / _BLOCK) + 1).cast("int"))
                    + total(F.slice(n, (F.floor(i / _BLOCK) * _BLOCK + 1).cast("int"), i % _BLOCK + 1))))

    return _let(lengths, of)


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _places(text: Column, m: Column, pattern: str) -> Column:
    """The matches ``m`` of the pattern as (start, end, match), in code points,
    end exclusive. The text is split between matches only if it has any."""
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long"))
    sizes = F.transform(m, lambda x: F.length(x).cast("long"))
    ends = _ends(F.zip_with(F.slice(gaps, F.lit(1), F.size(m)), sizes, lambda g, s: g + s))
    places = F.zip_with(m, ends, lambda x, e: F.struct((e - F.length(x)).alias("start"), e.alias("end"), x.alias("m")))
    return F.when(F.size(m) > 0, places).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,m:string>>"))


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution (polynomial times density, error below 1e-7, no less than 1e-30)."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) * 0.3989422804014327 * poly
    return F.greatest(F.lit(1e-30), F.when(z >= 0, tail).otherwise(1 - tail))


def _alphabet(m: Column, of) -> Column:
    """``of`` the inferred encoding."""
    out = None
    for e in ENCODINGS:
        out = (F.when(m.rlike(e[1]), F.lit(of(e))) if out is None else out.when(m.rlike(e[1]), F.lit(of(e))))
    return out


def _uniform_changes(encoding: tuple) -> float:
    """Share of class changes of uniform strings."""
    shares = [sum(c in kind for c in encoding[2]) / len(encoding[2]) for kind in (_DIGITS, _LOWER, _UPPER, "+/-_")]
    return 1 - sum(x * x for x in shares)


def _battery(m: Column) -> Column:
    """The p-value of a candidate."""
    n = F.length(m).cast("double")
    plus = lambda a, x: a + x

    def uniform(e: Column) -> Column:
        """Deviate, and what uniform strings give on average."""
        k = F.length(e["alphabet"]).cast("double")
        excess = k * e["collisions"] - 1
        squares = F.aggregate(F.transform(F.split(e["alphabet"], ""), lambda s: (F.length(m) - F.length(F.replace(m, s, F.lit("")))).cast("double")),
                              F.lit(0.0), lambda a, c: a + c * c)
        sd = F.sqrt(2 * (k - 1) + 4 * (n - 1) * excess)
        return F.struct(((k - 1 + (n - 1) * excess - (k / n * squares - n)) / sd).alias("z"), ((n - 1) * excess / sd).alias("weight"))

    def runs(e: Column) -> Column:
        changes = F.regexp_count(m, F.lit("(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]|(?<=[+/_-])[A-Za-z0-9]")).cast("double")
        sd = F.sqrt((n - 1) * e["changes"] * (1 - e["changes"]))
        return F.struct(((changes - 0.5 - (n - 1) * e["changes"]) / sd).alias("z"),
                        ((n - 1) * (e["uniform_changes"] - e["changes"]) / sd).alias("weight"))

    def serial(v: Column) -> Column:
        mean = F.aggregate(v, F.lit(0.0), plus) / n
        var = F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x) / n - mean * mean
        lagged = F.aggregate(F.zip_with(F.slice(v, F.lit(1), F.size(v) - 1), F.slice(v, F.lit(2), F.size(v) - 1), lambda x, y: x * y), F.lit(0.0), plus)
        r = F.when(var > 0, F.abs(F.try_divide(lagged / (n - 1) - mean * mean, var))).otherwise(F.lit(1.0))
        return F.struct(((CORRELATION - r) * F.sqrt(n)).alias("z"), F.lit(SERIAL_WEIGHT).alias("weight"))

    def tests(e: Column) -> Column:
        values = F.transform(F.split(m, ""), lambda c: F.instr(e["alphabet"], c).cast("double"))
        return F.array(uniform(e), runs(e), _let(values, serial))

    def combined(t: Column) -> Column:
        weight = F.sqrt(F.aggregate(t, F.lit(0.0), lambda a, x: a + x["weight"] * x["weight"]))
        return F.aggregate(t, F.lit(0.0), lambda a, x: a + x["weight"] * x["z"]) / weight

    encoding = F.struct(_alphabet(m, lambda e: e[2]).alias("alphabet"), _alphabet(m, lambda e: e[3]).alias("collisions"),
                        _alphabet(m, lambda e: e[4]).alias("changes"), _alphabet(m, _uniform_changes).alias("uniform_changes"))
    return _let(_let(_let(encoding, tests), combined), _upper_tail)


def _stratum(m: Column) -> Column:
    band = F.lit(len(BANDS))
    for i, most in reversed(list(enumerate(BANDS))):
        band = F.when(F.length(m) < most, F.lit(i)).otherwise(band)
    return F.concat(_alphabet(m, lambda e: e[0]), F.lit(":"), band)


def thresholds(found: DataFrame) -> dict[str, int]:
    """Per stratum the lowest bin of -log10 p that Benjamini-Hochberg rejects.
    ``found`` has ``stratum`` and ``bin``; both are of bounded number."""
    bins = found.groupBy("stratum", "bin").agg(F.count("*").alias("n"))
    down = Window.partitionBy("stratum").orderBy(F.desc("bin"))
    bins = bins.select("stratum", "bin", F.sum("n").over(down).alias("rejected"), F.sum("n").over(Window.partitionBy("stratum")).alias("all"))
    # all p-values of a bin are at most its upper edge
    ok = F.pow(F.lit(10.0), -F.col("bin") / BINS) <= FDR * F.col("rejected") / F.col("all")
    return {r["stratum"]: r["bin"] for r in bins.where(ok).groupBy("stratum").agg(F.min("bin").alias("bin")).collect()}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256,
    spans, n_random.

    Spans are kind:start:end in code points, end exclusive, by start and then
    kind. A null text is empty; a text without secrets has empty spans. Ids
    may be null or repeat, other columns are ignored. An empty table gives an
    empty result. Runs that touch a span of a pattern, or that have letters
    or digits only, are not tested."""
    text = F.col("text")

    def spans(col: Column, kind: int) -> Column:
        return F.transform(col, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))

    value = lambda x: F.regexp_extract(x["m"], "^" + ASSIGN, 2)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    patterns = dict(zip((*KINDS[:3], "runs"), (ASSIGN, ACCESS, HEX, RUN)))
    rows = rows.select("doc_id", "text", *[_matches(text, p).alias(f"m_{k}") for k, p in patterns.items()])
    rows = rows.select("doc_id", *[_places(text, F.col(f"m_{k}"), p).alias(k) for k, p in patterns.items()])
    rows = rows.withColumn("assign", F.filter("assign", lambda x: F.length(value(x)) >= MIN_ASSIGN))
    rows = rows.withColumn("runs", F.filter("runs", lambda x: x["m"].rlike("[0-9]") & x["m"].rlike("[A-Za-z]")))
    base = F.array_sort(F.concat(*[spans(F.col(k), i) for i, k in enumerate(KINDS[:3])]))
    rows = rows.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]], base.alias("base"), "runs")
    free = F.filter("runs", lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (b["end"] > x["start"])))
    tested = F.transform(free, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), _stratum(x["m"]).alias("stratum"),
                                                  F.floor(F.least(F.lit(float(DEEPEST)), -F.log10(_battery(x["m"]))) * BINS).cast("int").alias("bin")))
    rows = cut(rows.select("doc_id", *[f"n_{k}" for k in KINDS[:3]], "base", tested.alias("tested")))
    limits = thresholds(rows.select(F.explode("tested").alias("t")).select("t.stratum", "t.bin"))
    if limits:
        limit = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv])
        random = F.filter("tested", lambda t: t["bin"] >= F.try_element_at(limit, t["stratum"]))
    else:
        random = F.filter("tested", lambda t: F.lit(False))
    rows = rows.withColumn("random", spans(random, 3))
    names = F.array(*[F.lit(k) for k in KINDS])
    joined = lambda a: F.array_join(F.transform(a, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"])), ",")
    return rows.select("doc_id", *[f"n_{k}" for k in KINDS[:3]], F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                       joined(F.array_sort(F.concat("base", "random"))).alias("spans"), F.size("random").cast("long").alias("n_random"))
