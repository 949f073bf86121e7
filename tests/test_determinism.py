"""Results do not depend on the number of shuffle partitions."""

from cohortlens.config import DEFAULT
from cohortlens.operators import clean, lookup, rfm
from cohortlens.sources.mart import raw_campaign

SF = "/root/testdata/sf0.001"


def _run(spark, parts: int):
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        t = clean.treat(raw_campaign(spark, SF).repartition(parts), DEFAULT).checkpoint(eager=True)
        seg = rfm.segment(t, DEFAULT)
        return (sorted(map(tuple, rfm.segment_comparison(seg).collect())),
                sorted(map(tuple, lookup.lookup_kpis(seg).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)


def test_same_results_under_1_and_16_partitions(spark):
    assert _run(spark, 1) == _run(spark, 16)
