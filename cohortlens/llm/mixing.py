"""Mixing sources to target weights by entropy balancing.

Each document gets a rate r >= 0, at most MAX_COPIES. Among all rates that give
every source its target of words, those with the least relative entropy to
rate 1 are min(MAX_COPIES, exp(lambda * size)) with one dual variable lambda
per source. The convex dual is solved by Newton steps with a bracket, all
sources at once: a step is one join and one aggregate over the histogram
(source, size, documents), whose state goes to the checkpoint folder. Sums
are decimals, so reruns on other partitions give the same rates.

Rates become whole copies from the largest size down; what a size rounds away
is carried to the next smaller one. Ranges of sizes do so side by side, and what
they are left short of goes to the source's smallest sizes, so a source ends
within about half its smallest document of its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.common import SPACE, cut, numbered, row_keys, same, text_of

#: Weights of the sources in order, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix, as a share of all words.
SHARE = 1.5
MAX_COPIES = 2
#: Sizes of a range that is rounded in one list.
RANGE = 256
#: Slices of a (source, size) cell when its documents are ranked.
SLICES = 256
#: Rounds after which the solver gives up with an error (bisection alone ends far earlier).
MAX_ROUNDS = 200
#: Words, the unit of size in the exponent.
UNIT = 1000.0


def _source_key(col: str) -> Column:
    """Sources in code point order, null last, never null."""
    return F.coalesce(F.concat(F.lit("a"), F.col(col).cast("string")), F.lit("b"))


def _ranked(keys: DataFrame, col: str) -> DataFrame:
    """``keys`` with ``rank`` (from 0) in the order of ``col``, sorted by range
    partitions and per-partition offsets, not in one task."""
    ranged = cut(keys.repartitionByRange(F.col(col)).withColumn("p", F.spark_partition_id()))
    counts = ranged.groupBy("p").agg(F.count("*").alias("n"))  # a row per partition
    offsets = counts.select(F.col("p").alias("q"), (F.sum("n").over(Window.orderBy("p")) - F.col("n")).alias("before"))
    local = ranged.withColumn("i", F.row_number().over(Window.partitionBy("p").orderBy(col)))
    return local.join(F.broadcast(offsets), F.col("p") == F.col("q")).select(*keys.columns, (F.col("before") + F.col("i") - 1).alias("rank"))


def targets(cells: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE) -> DataFrame:
    """key, source_size, target: ``share`` of all words dealt by weight; a
    target stops at MAX_COPIES times its source, what is over goes to the
    others by weight until none is above. Only the water level is on the driver."""
    s = cells.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    s = cut(_ranked(s, "key").withColumn("w", weight))
    most = F.col("source_size") * MAX_COPIES
    total = s.agg((F.sum("source_size") * share).alias("t")).first()["t"]
    level = None
    while total:
        full = F.lit(False) if level is None else most <= F.col("w") * level
        r = s.agg(F.sum(F.when(full, most).otherwise(0)).alias("full"), F.sum(F.when(~full, F.col("w"))).alias("free")).first()
        if r["free"] is None or level == (total - r["full"]) / r["free"]:
            break
        level = (total - r["full"]) / r["free"]
    target = F.least(most.cast("double"), F.col("w") * F.lit(float(level or 0.0)))
    return s.select("key", "source_size", target.alias("target"))


def _rate(lam: Column, size: Column, full: Column) -> Column:
    return F.when(full, F.lit(float(MAX_COPIES))).otherwise(F.least(F.lit(float(MAX_COPIES)), F.exp(lam * size / UNIT)))


def solve(cells: DataFrame, goal: DataFrame) -> DataFrame:
    """key, source_size, target, full, lam: the dual solution of each source."""
    state = goal.select("*", (F.col("target") >= F.col("source_size") * MAX_COPIES).alias("full"), F.lit(0.0).alias("lam"),
                        F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"))
    state = cut(state.withColumn("done", F.col("full") | (F.col("source_size") == 0) | (F.col("target") == 0)))
    keep = ["key", "source_size", "target", "full"]
    for _ in range(MAX_ROUNDS):
        if state.where(~F.col("done")).isEmpty():
            return state.select(*keep, "lam")
        open_cells = cells.withColumnRenamed("key", "k").join(state.where(~F.col("done")), F.col("k") == F.col("key"))
        r = _rate(F.col("lam"), F.col("size"), F.lit(False))
        words = F.col("n") * F.col("size") * r
        slope = F.when(r < MAX_COPIES, words * F.col("size") / UNIT).otherwise(0.0)
        exact = lambda c: F.sum(F.round(c, 6).cast("decimal(32,6)")).cast("double")
        sums = open_cells.groupBy("key").agg(exact(words).alias("s"), exact(slope).alias("d"))
        sums = sums.select(F.col("key").alias("k"), "s", "d")
        j = state.join(sums, F.col("key") == F.col("k"), "left")
        low = F.col("s") < F.col("target")
        lo = F.when(low, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(low, F.col("hi")).otherwise(F.col("lam"))
        newton = F.col("lam") - F.log(F.try_divide("s", "target")) * F.try_divide("s", "d")
        inside = F.col("d").isNotNull() & (F.col("d") > 0) & (F.col("s") > 0) & (lo.isNull() | (newton > lo)) & (hi.isNull() | (newton < hi))
        step = (F.when(inside, newton).when(lo.isNotNull() & hi.isNotNull(), (lo + hi) / 2)
                .when(low, F.greatest(F.col("lam"), F.lit(0.5)) * 2).otherwise(F.least(F.col("lam"), F.lit(-0.5)) * 2))
        near = F.abs(F.col("s") - F.col("target")) <= F.lit(0.25) + F.col("target") * 1e-9
        stuck = lo.isNotNull() & hi.isNotNull() & ((step == lo) | (step == hi))
        still = ~F.col("done")
        state = cut(j.select(*keep, F.when(still & ~near, step).otherwise(F.col("lam")).alias("lam"),
                             F.when(still, lo).otherwise(F.col("lo")).alias("lo"), F.when(still, hi).otherwise(F.col("hi")).alias("hi"),
                             (F.col("done") | F.coalesce(near, F.lit(True)) | F.coalesce(stuck, F.lit(False))).alias("done")))
    raise RuntimeError(f"the dual did not converge in {MAX_ROUNDS} rounds")


def _rounded(cells: DataFrame, solved: DataFrame) -> DataFrame:
    """key, size, copies (for every document of the cell), extra (documents
    that get one more).

    Cells are rounded in order of falling size, each with the words that the
    ones before it were short. Ranges of RANGE sizes do that side by side, a
    list of at most RANGE cells each; what they are left short is added up and
    goes to the source's range of smallest sizes, which is rounded last."""
    c = cells.withColumnRenamed("key", "k").join(solved, F.col("k") == F.col("key"))
    c = c.select("key", "source_size", "target", "size", "n", _rate(F.col("lam"), F.col("size"), F.col("full")).alias("r"))
    per = cut(c.groupBy("key", "source_size", "target", F.expr(f"size div {RANGE}").alias("range")).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("size")).alias("neg"), "n", "r"))).alias("list")))

    def add(acc: Column, x: Column) -> Column:
        size = -x["neg"]
        want = acc["carry"] + x["n"] * x["r"] * size
        k = F.when(size == 0, F.lit(0).cast("long")).otherwise(
            F.greatest(F.lit(0).cast("long"), F.least(x["n"] * MAX_COPIES, F.floor(F.try_divide(want, size) + 0.5).cast("long"))))
        return F.struct((want - k * size).alias("carry"), F.concat(acc["ks"], F.array(k)).alias("ks"))

    def run(df: DataFrame, carry: Column) -> DataFrame:
        start = F.struct(carry.alias("carry"), F.array().cast("array<bigint>").alias("ks"))
        return df.withColumn("done", F.aggregate("list", start, add)).select("key", "source_size", "target", "list", "done")

    last = per.groupBy(F.col("key").alias("lk")).agg(F.min("range").alias("lr"))
    marked = per.join(last, F.col("key") == F.col("lk"))
    most = cut(run(marked.where("range > lr"), F.lit(0.0)))
    short = most.groupBy(F.col("key").alias("sk")).agg(F.sum(F.round("done.carry", 6).cast("decimal(32,6)")).cast("double").alias("short"))
    rest = run(marked.where("range = lr").join(short, F.col("key") == F.col("sk"), "left"), F.coalesce("short", F.lit(0.0)))
    cell = most.unionByName(rest).select("key", "source_size", "target", F.explode(F.arrays_zip(F.col("list"), F.col("done.ks").alias("ks"))).alias("c"))
    n = F.col("c.list.n")
    return cell.select("key", "source_size", "target", (-F.col("c.list.neg")).alias("size"),
                       F.floor(F.col("c.ks") / n).cast("long").alias("copies"), (F.col("c.ks") % n).alias("extra"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple = WEIGHTS, share: float = SHARE) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken
    (copies x size), copies, text_hash.

    A null text has size 0 and copies as its rate of 1 would, but takes no
    words. Null is a source of its own, the last. Ids may be null or repeat;
    rows that repeat get one decision each. Which documents of one source and
    size get one more copy is decided by a hash of id and text. Other columns
    are ignored. An empty table gives an empty result."""
    size = F.regexp_count(text_of(text_col), F.lit(f"[^{SPACE}]+")).cast("long")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_hash"),
                       _source_key(source_col).alias("key"), size.alias("size"))
    order = F.xxhash64("doc_id", "text_hash")
    rows = cut(rows.withColumn("slice", F.pmod(order, F.lit(SLICES))))
    slices = rows.groupBy("key", "size", "slice").agg(F.count("*").alias("n"))
    slices = cut(slices)
    cells = cut(slices.groupBy("key", "size").agg(F.sum("n").alias("n")))
    plan = _rounded(cells, solve(cells, targets(cells, weights, share)))
    before = F.sum("n").over(Window.partitionBy("key", "size").orderBy("slice")) - F.col("n")
    plan = (slices.withColumn("before", before).alias("s").join(plan.alias("p"), ["key", "size"])
            .select(F.col("key").alias("pk"), F.col("size").alias("ps"), F.col("slice").alias("pi"), "before", "source_size", "target",
                    "copies", "extra"))
    w = Window.partitionBy("key", "size", "slice").orderBy(order, "doc_id", "text_hash")
    out = rows.withColumn("i", F.row_number().over(w)).join(
        plan, (F.col("key") == F.col("pk")) & (F.col("size") == F.col("ps")) & (F.col("slice") == F.col("pi")))
    copies = F.col("copies") + (F.col("before") + F.col("i") <= F.col("extra")).cast("long")
    return (out.withColumn("copies", copies)
            .select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "text_hash"))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  weights: tuple = WEIGHTS, share: float = SHARE) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, all columns."""
    plan = (mix(docs, id_col, text_col, source_col, weights, share)
            .groupBy(F.col("doc_id").alias("__pid"), F.col("text_hash").alias("__ptext"))
            .agg(F.sum("copies").alias("__copies"), F.count("*").alias("__rows")))
    plan = cut(plan.where("__copies > 0"))
    rows, names = numbered(docs)
    keyed = rows.select("*", *row_keys(names[id_col], names[text_col]))
    out = keyed.join(plan.hint("shuffle_hash"), [same(F.col("__id"), F.col("__pid")), F.col("__text") == F.col("__ptext")])
    if not plan.where("__rows > 1").isEmpty():  # rows that repeat share their copies
        out = out.where("__rows = 1").unionByName(out.where("__rows > 1").dropDuplicates(["__id", "__text"]))
    out = out.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    return out.select(*[F.col(n).alias(c) for c, n in names.items()])
