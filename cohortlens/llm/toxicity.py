"""Toxicity by a classifier chain of linear models.

The categories come in a fixed order. Each has a logistic regression over the
words and word beginnings present in a text, and the probabilities of the
categories before it. For training, those are out-of-fold: the rows of a fold
get them from a model whose features were chosen, and whose weights were
fitted, without the fold. When scoring, the models run one after the other.

The models are fitted on a bounded sample of the labelled rows (documented
parameters below); features are counted in Spark by fold, and only the chosen
features of the sampled rows come to the driver. The threshold is set over all
labelled rows, each scored by the chain of its fold: its features and weights
come from the other folds, only the earlier category's probabilities in their
training rows come from models that saw the fold. The best F1 is taken from a
histogram of these scores. All documents are scored, once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import cut, text_of

#: Bounds of the sample: rows with the last category, and rows without.
POSITIVE_ROWS, OTHER_ROWS = 2000, 4000
#: Features kept per category; texts of the sample a feature must occur in.
FEATURES, LEAST_TEXTS = 800, 5
FOLDS = 4
#: Beginnings of words that are features of their own.
BEGINNINGS = (4, 5, 6)
STEPS, RATE, RIDGE = 120, 0.15, 1e-3
WORDS_KEPT = 200_000
#: Width of a bin of log-odds in the histogram for the threshold, and its bounds.
BIN, FARTHEST = 0.01, 30.0
_WORD = re.compile(r"\w+")


def word_features(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


def text_features(text: str) -> set[str]:
    """Words in lower case and their beginnings, present or not."""
    return {f for w in set(_WORD.findall(text.lower())) for f in word_features(w)}


@dataclass
class Chain:
    """labels in order; feature -> place; per label: weights, intercept,
    weights of the probabilities before it; threshold of the last label; the
    chains fitted without the rows of each fold, on the same places."""
    labels: list[str]
    place: dict[str, int]
    weights: list[np.ndarray] = field(default_factory=list)
    bias: list[float] = field(default_factory=list)
    link: list[np.ndarray] = field(default_factory=list)
    threshold: float = 0.5
    folds: list[Chain] = field(default_factory=list)

    def add(self, weights: np.ndarray, bias: float, link: np.ndarray) -> None:
        """The model of the next label."""
        self.weights.append(weights)
        self.bias.append(bias)
        self.link.append(link)

    def log_odds(self, rows: np.ndarray, cols: np.ndarray, n: int) -> np.ndarray:
        """n rows by labels, from the presence pairs (rows, cols)."""
        z, before = np.zeros((n, len(self.labels))), np.zeros((n, 0))
        for j, (w, b, v) in enumerate(zip(self.weights, self.bias, self.link)):
            z[:, j] = b + np.bincount(rows, weights=w[cols], minlength=n) + before @ v
            before = np.column_stack([before, _probability(z[:, j])])
        return z


def _probability(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _fit(rows: np.ndarray, cols: np.ndarray, extra: np.ndarray, y: np.ndarray, n_features: int) -> tuple[np.ndarray, float, np.ndarray]:
    """Logistic regression on presence features (pairs row, column) and dense
    ``extra`` columns; balanced classes, ridge penalty, Adam steps."""
    n, k = len(y), extra.shape[1]
    if y.min() == y.max():
        return np.zeros(n_features), -50.0 if y.max() == 0 else 50.0, np.zeros(k)
    share = y.mean()
    importance = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / n
    theta = np.zeros(n_features + k + 1)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, STEPS + 1):
        z = np.bincount(rows, weights=theta[cols], minlength=n) + extra @ theta[n_features:-1] + theta[-1]
        g = importance * (_probability(z) - y)
        grad = np.concatenate([np.bincount(cols, weights=g[rows], minlength=n_features), extra.T @ g, [g.sum()]])
        grad[:-1] += RIDGE * theta[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return theta[:n_features], float(theta[-1]), theta[n_features:-1]


def fit_chain(labels: list[str], place: dict[str, int], rows: np.ndarray, cols: np.ndarray, y: np.ndarray, fold: np.ndarray,
              allowed: np.ndarray) -> Chain:
    """Fit the chain on the sample: presence pairs (rows, cols), 0/1 matrix y
    by label, fold of each row, and the features (matrix FOLDS + 1 by places)
    that the chain of each fold, and last the whole chain, may use."""
    chain, n, k = Chain(labels, place), len(y), len(place)
    chain.folds = [Chain(labels, place) for _ in range(FOLDS)]
    before = np.zeros((n, 0))
    for j in range(len(labels)):
        out = np.zeros(n)
        mine = allowed[FOLDS][cols]
        whole = _fit(rows[mine], cols[mine], before, y[:, j], k)
        for f in range(FOLDS):
            inside = fold != f
            if inside.all():  # none of the fold's rows is in the sample
                model = whole
            elif not inside.any():
                model = np.zeros(k), -50.0, np.zeros(j)
            else:
                number = np.cumsum(inside) - 1
                keep = inside[rows] & allowed[f][cols]
                model = w, b, v = _fit(number[rows[keep]], cols[keep], before[inside], y[inside, j], k)
                z = np.bincount(rows, weights=w[cols], minlength=n) + before @ v + b
                out[~inside] = _probability(z[~inside])
            chain.folds[f].add(*model)
        chain.add(*whole)
        before = np.column_stack([before, out])
    return chain


def _threshold(bins: np.ndarray, n: np.ndarray, hits: np.ndarray) -> float:
    """The cut with the best F1, as a probability, half way between the two
    occupied bins around it; rows and rows with the label by bin."""
    if not hits.sum() or hits.sum() == n.sum():
        return 0.5
    order = np.argsort(-bins)
    bins, n, hits = bins[order], n[order], hits[order]
    best = int(np.argmax(2 * np.cumsum(hits) / (np.cumsum(n) + hits.sum())))
    low = bins[best + 1] + 1 if best + 1 < len(bins) else bins[best]
    return float(1 / (1 + np.exp(-(bins[best] + low) / 2 * BIN)))


def _labelled(labels: DataFrame, names: list[str]) -> DataFrame:
    """doc_id, y (array in the order of ``names``). Rows with a null label are
    left out; of a repeated id one row counts."""
    y = labels.select(F.col("doc_id"), F.array(*[F.col(c).cast("int") for c in names]).alias("y"))
    return y.where(F.col("doc_id").isNotNull() & ~F.exists("y", lambda v: v.isNull())).groupBy("doc_id").agg(F.max("y").alias("y"))


def sample_labelled(docs: DataFrame, labels: DataFrame, names: list[str], id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, y (array in the order of ``names``) of a bounded sample:
    the first ids by a hash, POSITIVE_ROWS with the last category and
    OTHER_ROWS without. Of documents that repeat an id, the least text counts."""
    y = _labelled(labels, names)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = (y.where(F.element_at("y", -1) == 1).orderBy(*order).limit(POSITIVE_ROWS)
            .unionByName(y.where(F.element_at("y", -1) != 1).orderBy(*order).limit(OTHER_ROWS)))
    some = some.withColumnsRenamed({"doc_id": "label_id"})
    text = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    both = text.join(F.broadcast(some), F.col("doc_id") == F.col("label_id"))  # 6,000 rows at most on the right
    return both.groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("doc_id", "text", "y")


def fit_sample(docs: DataFrame, labels: DataFrame, names: list[str], id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """The chain without its threshold."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([list(text_features(t)) for t in b.column(1).to_pylist()], pa.list_(pa.string())),
                                              b.column(2)], names=["doc_id", "features", "y"])

    sample = sample_labelled(docs, labels, names, id_col, text_col)
    kind = sample.schema["doc_id"].dataType.simpleString()
    sample = cut(sample.mapInArrow(sets, f"doc_id {kind}, features array<string>, y array<int>").withColumn("fold", _fold("doc_id")))
    if sample.isEmpty():
        return fit_chain(names, {}, np.zeros(0, int), np.zeros(0, int), np.zeros((1, len(names))), np.zeros(1, int), np.ones((FOLDS + 1, 0), bool))
    parts = range(FOLDS + 1)  # the rows outside each fold, and last all rows

    def sums() -> list[Column]:
        """Rows, and rows with each category, outside each fold and in all."""
        outside = [F.when(F.col("fold") != f, 1).otherwise(0) for f in range(FOLDS)] + [F.lit(1)]
        return [F.sum(o * c).alias(f"{x}{f}") for f, o in enumerate(outside)
                for x, c in [("n", F.lit(1)), *((f"p{j}_", F.get("y", F.lit(j))) for j in range(len(names)))]]

    total = sample.agg(*sums()).first()
    counts = cut(sample.select(F.explode("features").alias("f"), "y", "fold").groupBy("f").agg(*sums()).where(F.col(f"n{FOLDS}") >= LEAST_TEXTS))
    picked: list[set[str]] = []
    for f in parts:
        picked.append(set())
        for j in range(len(names)):
            # how far the share of the category among texts with the feature is from the share among all
            share, n = (total[f"p{j}_{f}"] + 0.5) / (total[f"n{f}"] + 1), F.col(f"n{f}")
            z = F.abs(F.col(f"p{j}_{f}") - n * share) / F.sqrt(n * share * (1 - share))
            picked[f] |= {r["f"] for r in counts.where(n >= LEAST_TEXTS).orderBy(z.desc(), "f").limit(FEATURES).collect()}
    chosen = set().union(*picked)
    names_of = sorted(chosen)
    place = {f: i for i, f in enumerate(names_of)}

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [sorted(place[f] for f in fs if f in place) for fs in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.list_(pa.int32())), b.column(2)], names=["doc_id", "places", "y"])

    allowed = np.array([[f in picked[i] for f in names_of] for i in parts], dtype=bool).reshape(FOLDS + 1, len(names_of))
    got = sample.select("doc_id", "features", "y").mapInArrow(places, f"doc_id {kind}, places array<int>, y array<int>")
    got = got.withColumn("fold", _fold("doc_id")).orderBy("doc_id").collect()
    rows = np.repeat(np.arange(len(got)), [len(r["places"]) for r in got])
    cols = np.array([p for r in got for p in r["places"]], dtype=np.int64)
    y = np.array([r["y"] for r in got], dtype=float).reshape(len(got), len(names))
    return fit_chain(names, place, rows, cols, y, np.array([r["fold"] for r in got]), allowed)


def train(docs: DataFrame, labels: DataFrame, names: list[str], id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """The chain for the 0/1 columns ``names`` of ``labels`` (doc_id, ...),
    with its threshold."""
    chain = fit_sample(docs, labels, names, id_col, text_col)
    chain.threshold = best_threshold(_scored(docs, chain, id_col, text_col), labels, chain)
    return chain


def _fold(id_col: str) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(FOLDS))


class _Reader:
    """The places of a text's features, in order; words looked up before are kept."""

    def __init__(self, place: dict[str, int]):
        self.place, self.known = place, {}

    def __call__(self, text: str) -> list[int]:
        hits: set[int] = set()
        for w in set(_WORD.findall(text.lower())):
            got = self.known.get(w)
            if got is None:
                if len(self.known) >= WORDS_KEPT:
                    self.known.clear()
                got = tuple(self.place[f] for f in word_features(w) if f in self.place)
                if len(w) <= 64:
                    self.known[w] = got
            if got:
                hits.update(got)
        return sorted(hits)


def _scored(docs: DataFrame, chain: Chain, id_col: str, text_col: str) -> DataFrame:
    """doc_id, p_<category> by the chain, and bin: the log-odds of the last
    category by the chain of the row's fold. A batch is one sparse product."""
    fields = [f"p_{c}" for c in chain.labels]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = _Reader(chain.place)
        for b in batches:
            n, found = b.num_rows, [places(t.as_py()) for t in b.column(1)]
            rows = np.repeat(np.arange(n), np.array([len(x) for x in found], dtype=np.int64))
            cols = np.array([x for xs in found for x in xs], dtype=np.int64)
            p = _probability(chain.log_odds(rows, cols, n))
            fold, last = b.column(2).to_numpy(), np.zeros(n)
            for f, part in enumerate(chain.folds):
                here = fold == f
                mine = here[rows]
                last[here] = part.log_odds((np.cumsum(here) - 1)[rows[mine]], cols[mine], int(here.sum()))[:, -1]
            bins = np.floor(np.clip(last, -FARTHEST, FARTHEST) / BIN).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(p[:, j]) for j in range(len(fields))), pa.array(bins)],
                                             names=["doc_id", *fields, "bin"])

    src = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).withColumn("fold", _fold("doc_id"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, ", ".join([f"doc_id {kind}", *(f"{c} double" for c in fields), "bin int"]))


def best_threshold(scored: DataFrame, labels: DataFrame, chain: Chain) -> float:
    """The cut with the best F1 over all labelled documents, each by the chain
    of its fold. Only ids and bins are joined with the labels."""
    y = _labelled(labels, chain.labels).withColumnsRenamed({"doc_id": "label_id"})
    hist = (scored.select("doc_id", "bin").join(y, F.col("doc_id") == F.col("label_id")).groupBy("bin")
            .agg(F.count("*").alias("n"), F.sum(F.when(F.element_at("y", -1) == 1, 1).otherwise(0)).alias("hits")).collect())  # 6,001 bins at most
    return _threshold(*(np.array([r[c] for r in hist], dtype=float) for c in ("bin", "n", "hits")))


def _decided(scored: DataFrame, chain: Chain) -> DataFrame:
    last = chain.labels[-1]
    return scored.drop("bin").withColumn(last, F.col(f"p_{last}") >= chain.threshold)


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, p_<category> for each, and a boolean with
    the name of the last category.

    A null text is empty; ids may be null or repeat; other columns are
    ignored. Without labelled rows all probabilities are those of an absent
    category. An empty table gives an empty result."""
    return _decided(_scored(docs, chain, id_col, text_col), chain)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Chain of low quality, then toxicity, from ``labels`` (doc_id, quality,
    toxic). The scores are written, so that the threshold and the verdicts
    come from one reading of the texts."""
    y = labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    chain = fit_sample(docs, y, ["low_quality", "toxic"])
    scored = cut(_scored(docs, chain, "doc_id", "text"))
    chain.threshold = best_threshold(scored, y, chain)
    return _decided(scored, chain)
