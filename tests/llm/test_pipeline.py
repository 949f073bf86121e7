import os
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from cohortlens.llm import entries, exact_dedup, host_rules, mixing, piece_bpe, simhash  # noqa: E402
from cohortlens.llm.common import table  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_equal_their_operators(spark):
    """Every stage against its operator's own verdicts, on its own input."""
    docs = table(spark, SF, "documents").cache()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).cache()
        assert out.columns == docs.columns, name
        got, ids = Counter(r.doc_id for r in out.collect()), {r.doc_id for r in docs.collect()}
        if name == "quality rules":
            expected = Counter(r.doc_id for r in host_rules.judge(docs).where("kept").collect())
        elif name == "exact dedup":
            expected = Counter(r.doc_id for r in exact_dedup.group_copies(docs).where("kept").collect())
        elif name == "SimHash near-dedup":
            expected = Counter(r.doc_id for r in simhash.near_duplicates(docs).where("doc_id = component_id").collect())
        else:
            expected = Counter({r.doc_id: r.copies for r in mixing.mix(docs).where("copies > 0").collect()})
        assert got == expected and set(got) <= ids, name
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    enc = piece_bpe.PrefixEncoder(piece_bpe.default_model())
    n = {r.doc_id: len(enc.library.encode(r.text)) for r in docs.collect()}
    assert all(r.n_tokens == n[r.doc_id] for r in last.collect())
    run = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, last.collect()))


def test_pipeline_edges(spark, clashing_docs, no_docs):
    for docs in (clashing_docs, no_docs):
        d = docs
        for name, stage in corpus_pipeline.STAGES:
            d = stage(spark, d, SF)
        d.count()


def test_registered():
    import __spark_entry__ as e
    q = e.queries()
    assert "pipeline" in q and {x.split("_")[0] for x in entries.queries()} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", sorted(entries.oracle_sql()))
def test_sql_oracle(spark, name):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import oracle_harness as h
    sf = "/root/testdata/sf0.01"
    r = h.compare(spark, h.duck_connection(sf), name, entries.queries()[name], entries.oracle_sql()[name], sf)
    assert r.get("schema_ok") and r.get("values_ok"), r
