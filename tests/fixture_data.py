"""Hand-made 12-row raw customer table covering the edge cases the driver
tables never reach (ties, all-zero spend, zero purchases, outliers, noise
categories, small groups, date formats)."""

from __future__ import annotations

from cohortlens.config import RAW_COLUMNS

BASE = dict(Year_Birth=1970, Education="Graduation", Marital_Status="Married", Income=50000.0, Kidhome=0, Teenhome=0,
            Dt_Customer="04-09-2012", Recency=10, MntWines=100, MntFruits=10, MntMeatProducts=50, MntFishProducts=5,
            MntSweetProducts=5, MntGoldProds=5, NumDealsPurchases=1, NumWebPurchases=2, NumCatalogPurchases=1,
            NumStorePurchases=3, NumWebVisitsMonth=4, AcceptedCmp3=0, AcceptedCmp4=0, AcceptedCmp5=0, AcceptedCmp1=0,
            AcceptedCmp2=0, Complain=0, Z_CostContact=3, Z_Revenue=11, Response=0)

ROWS = [
    dict(ID=1),
    dict(ID=2, MntWines=40, MntMeatProducts=40, MntFruits=0, MntFishProducts=0, MntSweetProducts=0, MntGoldProds=0),  # tie
    dict(ID=3, MntWines=0, MntFruits=0, MntMeatProducts=0, MntFishProducts=0, MntSweetProducts=0, MntGoldProds=0),  # all zero
    dict(ID=4, NumDealsPurchases=0, NumWebPurchases=0, NumCatalogPurchases=0, NumStorePurchases=0),  # zero purchases
    dict(ID=5, Income=None),
    dict(ID=6, Year_Birth=1893, MntWines=1),  # inactive age outlier → dropped
    dict(ID=7, Year_Birth=1899, MntWines=5000),  # active age outlier → imputed
    dict(ID=8, Marital_Status="YOLO", Education="PhD"),
    dict(ID=9, Marital_Status="Absurd", Education="PhD"),
    dict(ID=10, Marital_Status="Alone", Education="Basic", Income=999999.0),  # single member group + income outlier
    dict(ID=11, Marital_Status="Divorced", Education="Master", Kidhome=1),
    dict(ID=12, Marital_Status="Divorced", Education="Master", Kidhome=2, Response=1),
]


def rows():
    out = []
    for r in ROWS:
        d = dict(BASE)
        d.update(r)
        out.append(tuple(d[c] for c in RAW_COLUMNS))
    return out


SCHEMA = ", ".join(
    f"{c} {'string' if c in ('Education', 'Marital_Status', 'Dt_Customer') else 'double' if c == 'Income' else 'bigint'}"
    for c in RAW_COLUMNS
)


def raw_frame(spark, iso: bool = False):
    df = spark.createDataFrame(rows(), SCHEMA)
    if iso:
        from pyspark.sql import functions as F
        df = df.withColumn("Dt_Customer", F.date_format(F.to_date("Dt_Customer", "dd-MM-yyyy"), "yyyy-MM-dd"))
    return df
