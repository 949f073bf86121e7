import random

import pytest
from pyspark.sql import functions as F

from cohortlens.llm import common, multiset_hash, url_filter
from llm_rows import rows


@pytest.mark.parametrize("how", ["left", "inner"])
def test_small_join_beyond_the_broadcast_bound(spark, monkeypatch, how):
    """The salted join gives each row its match once: a hot key, keys without a match, null keys."""
    rng = random.Random(4)
    left = [(rng.choice([None, 1, 1, 1, *range(2, 30)]), i) for i in range(400)]
    right = [(k, f"v{k}") for k in (None, *range(1, 20))]
    table = dict(right)
    expected = sorted(((k, i, table.get(k)) for k, i in left if how == "left" or k in table), key=repr)
    a, b = spark.createDataFrame(left, "k long, i long"), spark.createDataFrame(right, "k long, v string")
    for bound in (20_000, 0):
        monkeypatch.setattr(common, "BROADCAST_ROWS", bound)
        assert rows(common.join_small(a, b, ["k"], F.col("i"), how), "k", "i", "v") == expected


def test_operators_beyond_the_broadcast_bound(spark, monkeypatch):
    """Models, verdicts and repeated rows are the same joined by salt as by broadcast."""
    rng = random.Random(5)
    hosts = ["a.net", "example.net", "b.example.com", "x.org", "y.io", "z.dev"]
    urls = [f"http://{rng.choice(hosts)}/{rng.choice(['en', 'de', 'fr', 'shop'])}/{rng.randrange(40)}" for _ in range(300)]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate([*urls, None, "no url"])], "page_id long, url string")
    docs = spark.createDataFrame([(1, "one\ntwo"), (1, "one\ntwo"), (1, "one\ntwo"), (2, None), (None, "x")], "doc_id long, text string")

    def both():
        judged, seen = url_filter.judge(pages), multiset_hash.compare(docs)
        return rows(judged, *judged.columns), rows(seen, *seen.columns)
    broadcast = both()
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    assert both() == broadcast
