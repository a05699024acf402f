"""Write PLANS.md: the physical plans of the headline queries with a summary of
exchanges, broadcasts, scans (pushed filters, read schema) and code-generated spans.

usage: python scripts/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from txlens.operators import detect_anomalies, enrich_user_stats, merchant_window_aggregates, user_window_stats  # noqa: E402
from txlens.operators.clean import clean_transactions  # noqa: E402
from txlens.plans import batch  # noqa: E402
from txlens.session import build_session  # noqa: E402
from txlens.sources.envelope import read_envelope, to_envelope  # noqa: E402


def summary(plan: str) -> str:
    plan = plan.split("== Initial Plan ==")[0]  # the adaptive plan as it ran
    ex = re.findall(r"(?<!Broadcast)Exchange (\w+)\(([^)]*)\)", plan)
    lines = [f"- shuffles: {sum(1 for k, _ in ex if k != 'SinglePartition')}"]
    for kind, keys in ex:
        lines.append(f"  - `{kind}({re.sub(r'#[0-9]+L?', '', keys)[:90]})`")
    lines.append(f"- broadcasts: {plan.count('BroadcastExchange')}, broadcast joins: {plan.count('BroadcastHashJoin')}, "
                 f"sort-merge joins: {plan.count('SortMergeJoin')}")
    lines.append(f"- code-generated stages: {len(set(re.findall(r'\*\((\d+)\)', plan)))}; "
                 f"object/sort aggregates: {plan.count('ObjectHashAggregate')}/{plan.count('SortAggregate')}; "
                 f"Python UDF nodes: {plan.count('EvalPython')}")
    for m in re.finditer(r"FileScan (\w+) \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\].*?ReadSchema: (struct<[^>]*>)", plan):
        cols = re.sub(r"#[0-9]+L?", "", m.group(2))
        lines.append(f"- scan {m.group(1)} columns [{cols}]; pushed filters [{m.group(3)}]")
    return "\n".join(lines)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    tx = batch.transactions(spark, sf)
    env = to_envelope(batch.fields(spark, sf), offset="transaction_id")
    cases = [
        ("merchant_window_aggregates (batch, flagship)", merchant_window_aggregates(tx)),
        ("user_window_stats (batch)", user_window_stats(tx)),
        ("anomalies (batch: stats broadcast after a size check)", detect_anomalies(enrich_user_stats(tx))),
        ("anomalies, statistics over the broadcast bound (hot keys salted)",
         detect_anomalies(enrich_user_stats(tx, broadcast_max_rows=0, hot_key_rows=5))),
        ("parse + clean (message parsed once)", clean_transactions(env)),
    ]
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `scripts/show_plans.py` at `{sf}` on local[8]; each plan is the final adaptive plan "
           "after one run (AQE has coalesced small partitions; skewed ones would be split). `*(n)` marks "
           "whole-stage code-generated spans.", ""]
    for title, df in cases:
        qe = df._jdf.queryExecution()
        qe.toRdd().count()  # run it, so the adaptive plan is final (coalescing, codegen spans)
        plan = qe.executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        out += [f"## {title}", "", summary(plan), "", "```", re.sub(r"#[0-9]+L?", "", final).strip()[:7000], "```", ""]
    for name, df in [("anomalies (stream)", detect_anomalies(enrich_user_stats(clean_transactions(
            read_envelope(spark, f"{sf}/events.parquet", streaming=True)))))]:
        out += [f"## {name}: logical plan", "", "```", re.sub(r"#[0-9]+L?", "", df._jdf.queryExecution().analyzed().toString()).strip()[:4000], "```", ""]
    open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w").write("\n".join(out))
    print("wrote PLANS.md")


if __name__ == "__main__":
    main()
