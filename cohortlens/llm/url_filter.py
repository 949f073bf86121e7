"""URL filter by a character language-model ratio.

Rules decide the urls they fit. The others are judged by two variable-order
Markov models over characters, one of the urls that rules allow and one of
those they block: log-likelihood difference per character, against a threshold
calibrated on the labelled urls.

Urls are scored as shapes (host and path, digits as 0), counted before
anything is shuffled per character. Model tables hold one row per distinct
string of ORDER + 1 characters; orders are interpolated by Witten-Bell
smoothing, so an unseen context falls back to a shorter one. Sums are
decimals, so reruns agree. All in DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import cut, join_small

#: Fixed values: (host, path prefix, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Characters of context of the longest order.
ORDER = 4
#: Symbols that the shortest order spreads its smoothing over.
ALPHABET = 256
#: Width of a score bin when the threshold is set.
BIN = 0.01
#: A rule list is an expression over the url; longer lists belong in a table.
MOST_RULES = 500
START, END = "\u0002", "\u0003"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _rule(rules: tuple, host: Column, path: Column, pick: int) -> Column:
    """The longest rule that fits: its text (pick 0) or its verdict (1); else null."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    out = None
    for h, p, verdict in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        value = F.lit((h + p, verdict)[pick])
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return F.lit(None).cast("string") if out is None else out


def _grams(shape: Column, order: int) -> Column:
    """Every character and the end mark, each with ``order`` characters before it."""
    chars = F.split(F.concat(F.lit(START * order), shape, F.lit(END)), "")
    last = F.length(shape) + 1
    return F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(chars, i, order + 1), ""))


def char_model(shapes: DataFrame, order: int = ORDER) -> DataFrame:
    """gram, ratio: ln P(accepted) - ln P(rejected) of the last character after
    the ones before, for each string of ``order`` + 1 characters that occurs
    in ``shapes`` (shape, accepted, rejected)."""
    top = (shapes.select(F.explode(_grams(F.col("shape"), order)).alias("gram"), "accepted", "rejected")
           .groupBy("gram").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")))
    top = cut(top)
    below = None
    for k in range(order + 1):
        grams = top if k == order else (top.groupBy(F.substring("gram", order + 1 - k, k + 1).alias("gram"))
                                        .agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")))
        w = Window.partitionBy(F.substring("gram", 1, k))  # at most a row per character
        for c in ("accepted", "rejected"):
            grams = (grams.withColumn(f"n_{c}", F.sum(c).over(w))
                     .withColumn(f"t_{c}", F.sum((F.col(c) > 0).cast("long")).over(w)))
        if below is None:
            grams = grams.withColumn("p_accepted", F.lit(1.0 / ALPHABET)).withColumn("p_rejected", F.lit(1.0 / ALPHABET))
        else:
            grams = grams.join(below, F.substring("gram", 2, k) == F.col("suffix"))
        smooth = [F.when(F.col(f"n_{c}") == 0, F.col(f"p_{c}"))
                  .otherwise(F.try_divide(F.col(c) + F.col(f"t_{c}") * F.col(f"p_{c}"), F.col(f"n_{c}") + F.col(f"t_{c}"))).alias(f"p_{c}")
                  for c in ("accepted", "rejected")]
        below = grams.select(F.col("gram").alias("suffix"), *smooth)
    return cut(below.select(F.col("suffix").alias("gram"), (F.log("p_accepted") - F.log("p_rejected")).alias("ratio")))


def score(shapes: DataFrame, model: DataFrame, order: int = ORDER) -> DataFrame:
    """``shapes`` with ``score``, the mean ratio per character."""
    grams = shapes.select("shape", F.explode(_grams(F.col("shape"), order)).alias("gram"))
    hit = join_small(grams, model, ["gram"], F.col("shape"), "inner")
    sums = hit.groupBy("shape").agg((F.sum(F.round("ratio", 9).cast("decimal(20,9)")).cast("double") / F.count("*")).alias("score"))
    return shapes.join(sums.withColumnRenamed("shape", "s"), F.col("shape") == F.col("s")).drop("s")


def threshold(scored: DataFrame) -> float:
    """The bin edge that best separates the labelled urls (greatest share of
    accepted kept less share of rejected kept; of equals the one nearest 0).
    0 if a class has no url."""
    bins = scored.groupBy(F.floor(F.col("score") / BIN).alias("bin")).agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r"))
    bins = cut(bins)  # the scores are bounded, so are the bins
    up = Window.orderBy(F.desc("bin"))
    every = Window.partitionBy()
    best = bins.select("bin", F.sum("a").over(up).alias("ca"), F.sum("r").over(up).alias("cr"),
                       F.sum("a").over(every).alias("ta"), F.sum("r").over(every).alias("tr"))
    best = best.where("ta > 0 AND tr > 0").orderBy((F.try_divide("ca", "ta") - F.try_divide("cr", "tr")).desc(), F.abs("bin"), "bin").first()
    return 0.0 if best is None else best["bin"] * BIN


def judge(pages: DataFrame, rules: tuple = RULES, order: int = ORDER, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict, score.

    A null url, or one without ``://``, has an empty host and path; it fits no
    rule and is judged as the empty shape. Ids may be null, urls may repeat.
    Without an allowed or a blocked url the threshold is 0 and ties are
    allowed. Other columns are ignored. An empty table gives an empty result."""
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.select("*", _rule(rules, F.col("host"), F.col("path"), 0).alias("rule"),
                       _rule(rules, F.col("host"), F.col("path"), 1).alias("by_rule"),
                       F.regexp_replace(F.concat("host", "path"), "[0-9]", "0").alias("shape"))
    shapes = cut(rows.groupBy("shape").agg(F.count_if(F.col("by_rule") == "allow").alias("accepted"),
                                           F.count_if(F.col("by_rule") == "block").alias("rejected")))
    scored = cut(score(shapes, char_model(shapes, order), order))
    limit = threshold(scored)
    out = join_small(rows, scored.select("shape", "score"), ["shape"], F.struct("page_id", "path"))
    method = F.when(F.col("score") >= limit, F.lit("allow")).otherwise(F.lit("block"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"), "score")
