"""Host-level quality rules.

Every text gets its counts and four rule failures. They are added up per host
(the document's source), and each of a host's four rates is shrunk towards the
corpus with a beta prior of its own, whose two parameters come from all hosts
by the method of moments, so that a host with few documents is not judged on
chance. A host that is surely much worse than the corpus in one failure loses
all its documents; the verdict is joined back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import cut, join_small, numbered, text_of

MIN_WORDS = 20
MAX_REPEAT_PCT = 30
WINDOW = 8
#: Failures beside the base rules: symbols in a hundred words, repeated lines in a hundred lines.
MAX_SYMBOL_PCT, MAX_DUP_LINE_PCT = 10, 30
#: A host goes if a failure's odds are WORSE times those of the corpus and its
#: rate is at least LEAST_RATE, by SURE standard deviations of its posterior.
WORSE, LEAST_RATE, SURE = 4.0, 0.2, 2.0
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
#: The symbols counted.
SYMBOLS = "#*$%&|<>"


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by a ``window``-word window that occurs at least twice.
    Windows are named exactly: ids of windows of 2, 4, 8 words are ranks of
    pairs of ids of half that size."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)
    if len(seen) == len(words):
        return 0
    size = 1
    while size < window:
        step = min(size, window - size)
        pairs = ids[:-step] * np.int64(len(words) + 1) + ids[step:]
        names, ids = np.unique(pairs, return_inverse=True)
        if len(names) == len(ids):
            return 0
        size += step
    again = (np.bincount(ids)[ids] > 1).astype(np.int64)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    edge[:n] += again
    edge[window:] -= again
    return int((np.cumsum(edge) > 0).sum())


def measure(text: str) -> tuple[int, int, int, int, int, int]:
    """The six counts of a text. Words are runs of other than ASCII white space."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    # the code points outside the six white-space characters are those of the words
    chars = len(text) - sum(text.count(c) for c in " \t\n\v\f\r")
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeat_words(words), len(lines)


def _measured(docs: DataFrame, text_col: str, keep_text: bool = False) -> DataFrame:
    """``docs`` with the counts, without or with the text."""
    at = docs.columns.index(text_col)
    keys = [c for c in docs.columns if keep_text or c != text_col]
    places = [docs.columns.index(c) for c in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = np.array([measure(t.as_py() or "") for t in b.column(at)], dtype=np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in places), *(pa.array(rows[:, j]) for j in range(len(COUNTS)))],
                                             names=[*keys, *COUNTS])

    schema = ", ".join([*(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keys), *(f"{c} long" for c in COUNTS)])
    return docs.mapInArrow(run, schema)


def failures() -> dict[str, Column]:
    """The rules that judge hosts, from the counts. Mean word length is none:
    it would fail every text of a language written without spaces."""
    words = F.col("n_words")
    return {"short": words < MIN_WORDS, "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * words,
            "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PCT * words,
            "lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PCT * F.col("n_lines")}


def base_failed() -> Column:
    rules = failures()
    return rules["short"] | rules["repeats"]


def _prior(k: str) -> Column:
    """weight and mean of the beta prior of the failure counted in ``k``, over
    all hosts. The variance of the raw rates less that of chance is the
    variance between hosts. Where none is left, hosts don't differ: the prior
    is the corpus rate with the weight of a mean host."""
    r, n = F.col(k) / F.col("n_docs"), F.col("n_docs")
    mean, chance = F.avg(r), F.avg(1 / n)
    free = mean * (1 - mean)
    between = F.try_divide(F.var_samp(r) - free * chance, 1 - chance)
    fits = (between > 0) & (between < free)
    return F.struct(F.when(fits, F.try_divide(free, between) - 1).otherwise(F.avg(n)).alias("weight"),
                    F.when(fits, mean).otherwise(F.try_divide(F.sum(k), F.sum(n))).alias("mean")).alias(k)


def host_rates(rows: DataFrame) -> DataFrame:
    """host, n_docs, per failure its shrunk rate (``short``, ...), ``host_rate``
    (the largest) and ``host_failed``, from rows with ``host`` and the counts.
    The posterior is taken as normal around its mean."""
    rules = failures()
    hosts = cut(rows.groupBy("host").agg(F.count("*").alias("n_docs"), *[F.sum(c.cast("long")).alias(k) for k, c in rules.items()]))
    prior = hosts.agg(*[_prior(k) for k in rules]).select(F.struct(*rules).alias("prior"))
    rates, bad = {}, F.lit(False)
    for k in rules:
        weight, mean = F.col(f"prior.{k}.weight"), F.col(f"prior.{k}.mean")
        rate = (F.col(k) + weight * mean) / (F.col("n_docs") + weight)
        deviation = F.sqrt(rate * (1 - rate) / (F.col("n_docs") + weight + 1))
        limit = F.greatest(WORSE * mean / (1 + (WORSE - 1) * mean), F.lit(LEAST_RATE))
        rates[k], bad = rate, bad | (rate - SURE * deviation > limit)
    return (hosts.withColumn("prior", prior.scalar())
            .select("host", "n_docs", *[r.alias(k) for k, r in rates.items()], F.greatest(*rates.values()).alias("host_rate"), bad.alias("host_failed")))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per input row: doc_id, the counts, base_failed, host_rate, host_failed, kept.

    A null text has no words (and fails); null is a host like any other; ids
    may be null or repeat. Other columns are ignored. Equal rows get equal
    verdicts. A corpus of one host is its own measure and loses no host. An
    empty table gives an empty result."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), text_of(text_col).alias("text"))
    rows = cut(_measured(src, "text"))
    rates = cut(host_rates(rows).select("host", "host_rate", "host_failed"))
    out = join_small(rows, rates, ["host"], F.struct("doc_id", "n_words")).withColumn("base_failed", base_failed())
    return out.select("doc_id", *COUNTS, "base_failed", "host_rate", "host_failed", (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"))


def filter_documents(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, all columns. Texts are measured once
    and not shuffled: those that pass the base rules are written beside the
    counts, and the hosts' verdicts are joined to them."""
    rows, names = numbered(docs)
    host, text = names[host_col], names[text_col]
    rows = _measured(rows, text, keep_text=True)
    rows = cut(rows.withColumn(text, F.when(~base_failed(), F.col(text))))
    rates = host_rates(rows.select(F.col(host).alias("host"), *COUNTS))
    bad = cut(rates.where("host_failed").select(F.col("host").alias(host), F.lit(True).alias("bad")))
    good = join_small(rows.where(~base_failed()), bad, [host], F.col(text)).where(F.col("bad").isNull())
    return good.select(*[F.col(k).alias(c) for c, k in names.items()])


SQL = r"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, string_split(text, chr(10)) AS ls FROM t),
numbered AS (SELECT row_number() OVER () AS r, * FROM w),
win AS (SELECT r, unnest(range(1, len(ws) - 6)) AS i,
               unnest(list_transform(range(1, len(ws) - 6), lambda i: array_to_string(ws[i:i + 7], ' '))) AS g
        FROM numbered WHERE len(ws) >= 8),
twice AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
cover AS (SELECT r, count(DISTINCT i + d) AS n_repeat_words FROM twice, range(8) AS x(d) GROUP BY r),
c AS (
  SELECT doc_id, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
          - len(list_distinct(list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))::BIGINT AS n_lines
  FROM numbered LEFT JOIN cover USING (r)),
f AS (SELECT *, n_words < 20 AS short, 100 * n_repeat_words > 30 * n_words AS repeats,
             100 * n_symbols > 10 * n_words AS symbols, 100 * n_dup_lines > 30 * n_lines AS dup FROM c),
hosts AS (SELECT source, x.rule.name AS rule, count(*) AS n, count(*) FILTER (x.rule.failed) AS k
          FROM f, unnest([{'name': 'short', 'failed': short}, {'name': 'repeats', 'failed': repeats},
                          {'name': 'symbols', 'failed': symbols}, {'name': 'lines', 'failed': dup}]) AS x(rule)
          GROUP BY ALL),
m AS (SELECT rule, avg(k / n) AS mean, var_samp(k / n) AS v, avg(1 / n) AS chance, avg(n) AS size, sum(k) / sum(n) AS al FROM hosts GROUP BY rule),
b AS (SELECT *, (v - mean * (1 - mean) * chance) / nullif(1 - chance, 0) AS between_hosts FROM m),
p AS (SELECT rule, CASE WHEN between_hosts > 0 AND between_hosts < mean * (1 - mean) THEN mean * (1 - mean) / between_hosts - 1 ELSE size END AS weight,
             CASE WHEN between_hosts > 0 AND between_hosts < mean * (1 - mean) THEN mean ELSE al END AS mean FROM b),
rates AS (SELECT source, n + weight AS total, (k + weight * mean) / (n + weight) AS rate, greatest(4 * mean / (1 + 3 * mean), 0.2) AS lim
          FROM hosts JOIN p USING (rule)),
verdicts AS (SELECT source, bool_or(rate - 2 * sqrt(rate * (1 - rate) / (total + 1)) > lim) AS host_failed FROM rates GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, short OR repeats AS base_failed,
       host_failed, NOT (short OR repeats) AND NOT host_failed AS kept
FROM f JOIN verdicts ON f.source IS NOT DISTINCT FROM verdicts.source
"""
