"""Write the physical plans of the headline queries to docs/PLANS.md.

Usage: python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEEP = ("Scan", "ReadSchema", "PushedFilters", "Join", "Exchange", "HashAggregate", "Window", "Project",
        "Subquery", "Range", "Filter", "Expand", "Generate", "TakeOrdered", "Union")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from cohortlens.config import DEFAULT
    from cohortlens.operators import clean, lookup, rfm, stats, synth
    from cohortlens.plans.registry import raw, segmented, treated
    from cohortlens.session import local_session
    from cohortlens.sources.mart import raw_campaign

    spark = local_session()
    t = treated(spark, sf_dir)
    md = synth.prepare_generation_metadata(t, stats.group_means(t), stats.group_stds(t), raw(spark, sf_dir))
    items = {
        "raw_campaign (mart)": raw_campaign(spark, sf_dir),
        "treated (cleaning chain over the checkpointed raw table)": clean.treat(raw(spark, sf_dir), DEFAULT),
        "segment_comparison": rfm.segment_comparison(segmented(spark, sf_dir)),
        "lookup_kpis": lookup.lookup_kpis(segmented(spark, sf_dir)),
        "synthetic generator (1,000,000 rows)": synth.generate_synthetic(spark, md, n_rows=1_000_000),
    }
    out = ["# Physical plans (initial AQE plans, `explain(\"formatted\")` operator lines)", "",
           f"Generated by `tools/dump_plans.py` at `{sf_dir}`. Scans show pruned `ReadSchema` and pushed filters.",
           "The synthetic generator plan has no Exchange (no shuffle).", ""]
    for title, df in items.items():
        text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        lines = [ln for ln in text.split("\n") if ln.strip() and any(k in ln for k in KEEP) and len(ln) < 400]
        out += [f"## {title}", "", "```", *lines[:80], "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
