"""``raw_campaign``: the 29-column raw customer table built from the driver's
star schema (customer ⋈ nation ⋈ region ⋈ orders ⋈ lineitem ⋈ part, events).

Plan shape (what ``explain`` shows and why):

* lineitem ⋈ part on partkey, then one partial+final aggregate per order:
  six category sums of integer cents. At most one row per order leaves it.
* orders ⟕ per-order spend on orderkey (the aggregate output is already
  hash-partitioned on the key, so only orders is exchanged), then ONE
  customer-level aggregate computes counts, flags, first/last order and the
  spend sums together.
* events are reduced to one row per user before the left join.
* nation ⋈ region is a fixed 25-row dimension and is broadcast.

Money is summed as BIGINT cents × (100 − discount %), so the result is exact
and independent of partitioning; hot customers or parts are handled by the
map-side partial aggregates and AQE skew-join splitting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.config import RAW_COLUMNS
from cohortlens.functions.exprs import nearest
from cohortlens.sources.tables import read_table

# --------------------------------------------------------------------------
# Fixed values of the mart definition, in natural order.
# --------------------------------------------------------------------------
EDUCATION_BY_REGION = [("AFRICA", "2n Cycle"), ("AMERICA", "Basic"), ("ASIA", "Graduation"), ("EUROPE", "Master")]
EDUCATION_OTHER = "PhD"
MARITAL_BY_SEGMENT = [("AUTOMOBILE", "Married"), ("BUILDING", "Together"), ("FURNITURE", "Single"), ("HOUSEHOLD", "Divorced")]
MARITAL_OTHER = "Widow"
# c_custkey % 211 → injected noise category
MARITAL_NOISE_BY_MOD = [(5, "YOLO"), (6, "Absurd"), (7, "Alone")]
# p_type prefix → product column
PRODUCT_BY_TYPE = [
    ("ECONOMY", "MntWines"), ("LARGE", "MntFruits"), ("MEDIUM", "MntMeatProducts"),
    ("PROMO", "MntFishProducts"), ("SMALL", "MntSweetProducts"), ("STANDARD", "MntGoldProds"),
]
# o_orderpriority → channel column
CHANNEL_BY_PRIORITY = [
    ("NumDealsPurchases", ["5-LOW"]), ("NumWebPurchases", ["1-URGENT"]),
    ("NumCatalogPurchases", ["2-HIGH"]), ("NumStorePurchases", ["3-MEDIUM", "4-NOT SPECIFIED"]),
]
# campaign column → year of an urgent order that counts as acceptance
CAMPAIGN_YEAR = [
    ("AcceptedCmp1", 1995), ("AcceptedCmp2", 1996), ("AcceptedCmp3", 1997),
    ("AcceptedCmp4", 1998), ("AcceptedCmp5", 1999), ("Response", 2000),
]
Z_COST_CONTACT, Z_REVENUE = 3, 11
# --------------------------------------------------------------------------


def _case(col: Column, pairs, other) -> Column:
    expr = None
    for key, val in pairs:
        expr = F.when(col == key, val) if expr is None else expr.when(col == key, val)
    return expr.otherwise(other)


def _first_prefix(col: Column, prefixes: list[str]) -> Column:
    """Number of the prefix that the text begins with, else null."""
    return F.coalesce(*[F.when(col.startswith(p), i) for i, p in enumerate(prefixes)])


def _flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


def raw_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customer table (29 columns, one row per customer with an order)."""
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    lineitem = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_discount")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    events = read_table(spark, sf_dir, "events").select("user_id", "event_type")

    # fixed 25-row dimension: broadcast is size-safe by definition
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")

    # -- spend per order: integer cents × (100 - discount%) per category
    amount = nearest(F.col("l_extendedprice") * 100).cast("bigint") * (
        100 - nearest(F.col("l_discount") * 100).cast("int")
    )
    kinds = part.select("p_partkey", _first_prefix(F.col("p_type"), [prefix for prefix, _ in PRODUCT_BY_TYPE]).alias("kind"))
    typed = lineitem.join(kinds, lineitem.l_partkey == kinds.p_partkey).select("l_orderkey", "kind", amount.alias("amt"))
    order_spend = typed.groupBy("l_orderkey").agg(
        *[F.sum(F.when(F.col("kind") == i, F.col("amt"))).alias(f"s_{col}") for i, (_, col) in enumerate(PRODUCT_BY_TYPE)]
    )

    # -- one customer-level aggregate over orders ⟕ order_spend; what it needs
    # of an order is made of it before the exchange: the channels, and the
    # campaigns accepted as bits
    odate = F.col("o_orderdate").cast("date")
    prio = F.col("o_orderpriority")
    year = F.year(odate)
    bits = F.when(prio == "1-URGENT", _case(year, [(y, 1 << i) for i, (_, y) in enumerate(CAMPAIGN_YEAR)], 0)).otherwise(0)
    dated = orders.select("o_orderkey", "o_custkey", odate.alias("odate"), bits.alias("bits"),
                          *[_flag(prio.isin(*prios)).alias(col) for col, prios in CHANNEL_BY_PRIORITY])
    per_order = dated.join(order_spend, dated.o_orderkey == order_spend.l_orderkey, "left")
    cust_orders = per_order.groupBy("o_custkey").agg(
        F.min("odate").alias("first_order"),
        F.max("odate").alias("last_order"),
        F.bit_or("bits").alias("bits"),
        *[F.sum(col).alias(col) for col, _ in CHANNEL_BY_PRIORITY],
        *[F.floor(F.sum(f"s_{col}") / 10000).alias(col) for _, col in PRODUCT_BY_TYPE],
    )
    accepted = [_flag(F.col("bits").bitwiseAND(1 << i) != 0).alias(col) for i, (col, _) in enumerate(CAMPAIGN_YEAR)]
    cust_orders = cust_orders.select("*", *accepted).drop("bits")
    # latest order in the table: a scan of one column, without an exchange
    latest = orders.select(F.max(odate)).scalar()

    ev = events.groupBy("user_id").agg(
        F.sum(_flag(F.col("event_type") == "view")).alias("views"),
        F.max(_flag(F.col("event_type") == "error")).alias("errors"),
    )

    key = F.col("c_custkey")
    marital_noise = _case(key % 211, MARITAL_NOISE_BY_MOD, None)
    joined = (
        customer.join(F.broadcast(geo), customer.c_nationkey == geo.n_nationkey)
        .join(cust_orders, key == cust_orders.o_custkey, "left")
        .join(ev, key == ev.user_id, "left")
    )
    cols = {
        "ID": key,
        "Year_Birth": F.when(key % 499 == 17, 1895).otherwise(1940 + (key * 7919) % 65),
        "Education": _case(F.col("r_name"), EDUCATION_BY_REGION, EDUCATION_OTHER),
        "Marital_Status": F.coalesce(marital_noise, _case(F.col("c_mktsegment"), MARITAL_BY_SEGMENT, MARITAL_OTHER)),
        "Income": F.when(key % 97 == 3, F.lit(None).cast("double"))
        .when(key == 11, F.lit(666666.0))
        .otherwise(F.round((F.col("c_acctbal") + 1000) * 10)),
        "Kidhome": key % 3,
        "Teenhome": F.col("c_nationkey") % 3,
        "Dt_Customer": F.col("first_order"),
        "Recency": F.datediff(latest, F.col("last_order")),
        **{col: F.coalesce(F.col(col), F.lit(0)) for _, col in PRODUCT_BY_TYPE},
        **{col: F.coalesce(F.col(col), F.lit(0)) for col, _ in CHANNEL_BY_PRIORITY},
        "NumWebVisitsMonth": F.coalesce(F.col("views"), F.lit(0)),
        **{col: F.coalesce(F.col(col), F.lit(0)) for col, _ in CAMPAIGN_YEAR},
        "Complain": F.coalesce(F.col("errors"), F.lit(0)),
        "Z_CostContact": F.lit(Z_COST_CONTACT),
        "Z_Revenue": F.lit(Z_REVENUE),
    }
    out = []
    for name in RAW_COLUMNS:
        expr = cols[name]
        if name == "Income":
            expr = expr.cast("double")
        elif name not in ("Education", "Marital_Status", "Dt_Customer"):
            expr = expr.cast("bigint")
        out.append(expr.alias(name))
    return joined.select(*out)


# --------------------------------------------------------------------------
# The same mart as ANSI SQL for the DuckDB oracle (one CTE, ``raw``).
# --------------------------------------------------------------------------
def _sql_case(expr: str, pairs, other: str) -> str:
    whens = " ".join(f"WHEN {expr} = {k!r} THEN {v!r}" for k, v in pairs)
    return f"CASE {whens} ELSE {other!r} END"


def raw_campaign_sql() -> str:
    """SQL body (no WITH) defining CTEs ``geo``..``raw``; prefix with WITH."""
    prod_sums = ",\n      ".join(
        f"sum(CASE WHEN p.p_type LIKE '{prefix}%' THEN "
        f"CAST(round(l.l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l.l_discount * 100) AS INTEGER)) END) AS s_{col}"
        for prefix, col in PRODUCT_BY_TYPE
    )
    chan = ",\n      ".join(
        "sum(CASE WHEN o.o_orderpriority IN ({}) THEN 1 ELSE 0 END) AS {}".format(
            ", ".join(repr(p) for p in prios), col
        )
        for col, prios in CHANNEL_BY_PRIORITY
    )
    camp = ",\n      ".join(
        f"max(CASE WHEN o.o_orderpriority = '1-URGENT' AND year(o.o_orderdate) = {y} THEN 1 ELSE 0 END) AS {col}"
        for col, y in CAMPAIGN_YEAR
    )
    prod_floor = ",\n      ".join(f"floor(sum(os.s_{col}) / 10000) AS {col}" for _, col in PRODUCT_BY_TYPE)
    noise = " ".join(f"WHEN c.c_custkey % 211 = {m} THEN {v!r}" for m, v in MARITAL_NOISE_BY_MOD)
    sel = {
        "ID": "c.c_custkey",
        "Year_Birth": "CASE WHEN c.c_custkey % 499 = 17 THEN 1895 ELSE 1940 + (c.c_custkey * 7919) % 65 END",
        "Education": _sql_case("g.r_name", EDUCATION_BY_REGION, EDUCATION_OTHER),
        "Marital_Status": f"CASE {noise} ELSE {_sql_case('c.c_mktsegment', MARITAL_BY_SEGMENT, MARITAL_OTHER)} END",
        "Income": "CASE WHEN c.c_custkey % 97 = 3 THEN NULL WHEN c.c_custkey = 11 THEN 666666.0 "
        "ELSE round((c.c_acctbal + 1000) * 10) END",
        "Kidhome": "c.c_custkey % 3",
        "Teenhome": "c.c_nationkey % 3",
        "Dt_Customer": "co.first_order",
        "Recency": "date_diff('day', co.last_order, (SELECT max(CAST(o_orderdate AS DATE)) FROM orders))",
        **{col: f"coalesce(co.{col}, 0)" for _, col in PRODUCT_BY_TYPE},
        **{col: f"coalesce(co.{col}, 0)" for col, _ in CHANNEL_BY_PRIORITY},
        "NumWebVisitsMonth": "coalesce(ev.views, 0)",
        **{col: f"coalesce(co.{col}, 0)" for col, _ in CAMPAIGN_YEAR},
        "Complain": "coalesce(ev.errors, 0)",
        "Z_CostContact": str(Z_COST_CONTACT),
        "Z_Revenue": str(Z_REVENUE),
    }
    out = []
    for name in RAW_COLUMNS:
        if name == "Income":
            out.append(f"CAST({sel[name]} AS DOUBLE) AS {name}")
        elif name in ("Education", "Marital_Status", "Dt_Customer"):
            out.append(f"{sel[name]} AS {name}")
        else:
            out.append(f"CAST({sel[name]} AS BIGINT) AS {name}")
    select_list = ",\n  ".join(out)
    return f"""geo AS (
  SELECT n.n_nationkey, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
order_spend AS (
  SELECT l.l_orderkey,
      {prod_sums}
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY l.l_orderkey
),
cust_orders AS (
  SELECT o.o_custkey,
      min(CAST(o.o_orderdate AS DATE)) AS first_order,
      max(CAST(o.o_orderdate AS DATE)) AS last_order,
      {chan},
      {camp},
      {prod_floor}
  FROM orders o LEFT JOIN order_spend os ON o.o_orderkey = os.l_orderkey
  GROUP BY o.o_custkey
),
ev AS (
  SELECT user_id,
      sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS views,
      max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS errors
  FROM events GROUP BY user_id
),
raw AS (
  SELECT
  {select_list}
  FROM customer c
  JOIN geo g ON c.c_nationkey = g.n_nationkey
  LEFT JOIN cust_orders co ON c.c_custkey = co.o_custkey
  LEFT JOIN ev ON c.c_custkey = ev.user_id
)"""
