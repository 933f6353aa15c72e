"""Summarise the physical plan of every registered batch query as a markdown table.

    python plan_report.py [/root/testdata/sf0.1] > PLANS.md

Each query's plan is executed once (JVM-side count) so AQE's final plan is reported:
exchanges, join strategies, partial Top-N limits before an exchange, filters
pushed to the scan, and aggregate kinds.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skewkit.plans.batch import BATCH_QUERIES  # noqa: E402
from skewkit.session import build_session  # noqa: E402

# Our notes on how each plan behaves at scale (one key may hold a third of the rows).
SCALE_NOTES = {
    "topn_sql": "partial count before the exchange; Top-2 limit applied per map task before the second exchange",
    "topn_salted": "two-phase count over 9 salts by input partition; same bounded Top-2",
    "topn_sql_text": "the same plan from SQL text",
    "topn_distinct": "hot (site, count) pairs combine map-side; Top-2 on distinct counts only",
    "topn_distinct_all": "ranks distinct counts per site: at most sqrt(2·rows) values per site",
    "count_per_key": "one exchange of partial counts",
    "count_salted": "one partial row per key and task, as the plain count; the first exchange spreads a hot key's partials over 9 salts",
    "distinct_keys": "partial distinct before the exchange; nothing collected",
    "scan_text_topn": "staged text split per task; 3-salt two-phase count",
    "scan_orc_topn_all": "typed ORC scan of two columns",
    "salted_join": "reference form: right side replicated x10 in one scan (Generate)",
    "salted_join_hot": "one sketch job (a state per task); nothing is hot, so a plain join",
    "salted_join_2key": "one sketch job per side; nothing is hot, so a plain join",
    "salted_join_mixed_types": "int and bigint keys compared as bigint; merge join",
    "salted_join_hot_left": "5 keys hold all rows: cut into pieces of 500 rows, merge join",
    "salted_join_hot_right": "as above with the right side hot",
    "salted_join_hot_both": "hot on both sides: left piece x right piece, merge join",
    "matched_pairs": "semi-join of distinct keys: no a×b blow-up on hot keys",
    "join_topn": "left rows are counted before the join; a hot key is one row in it",
    "left_lookup": "small side broadcast after a rows+bytes check",
    "left_lookup_hot": "beyond the broadcast bound: inner grid join of hot pieces, and an anti join with the distinct right keys",
    "rank_all_events": "a hot type is many ranges; the sums of earlier ranges are at most two rows a range (the ranged, numbered rows were written before)",
    "inner_lookup": "lookup reduced to one row per key and staged, then broadcast after the check",
    "word_count": "explode + partial count",
    "running_count_batch": "rows shuffled once by (word, offset bucket); prefix sums on the bucket-count table",
    "parse_sales": "map-only; split computed once per record",
    "wide_column_binary": "the same; values and row keys are decoded after the filter",
    "wide_column": "cf/qualifier filter pushed into the cell scan; partial max_by per row key",
}


def summarise(plan: str) -> dict[str, str]:
    # an executed AQE plan prints "== Final Plan ==" and then "== Initial Plan =="
    plan = plan.split("== Initial Plan ==")[0]
    exchanges = re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)", plan)
    joins = sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin)", plan)))
    join_types = sorted(set(re.findall(r"Join \[[^\]]*\], \[[^\]]*\], (\w+)", plan)))
    aggs = sorted(set(re.findall(r"(HashAggregate|SortAggregate|ObjectHashAggregate)", plan)))
    return {
        "exchanges": str(sum(1 for e in exchanges if e != "SinglePartition")),
        "broadcasts": str(len(re.findall(r"\bBroadcastExchange\b", plan))),
        "joins": ", ".join(f"{j}" for j in joins) + (f" ({', '.join(join_types)})" if join_types else "") or "–",
        "partial_topn": "yes" if re.search(r"WindowGroupLimit .*Partial", plan) else "–",
        "aggregates": ", ".join(aggs) or "–",
        "pushed": "yes" if re.search(r"PushedFilters: \[(?!\])", plan) else "–",
        "reused": str(plan.count("ReusedExchange")),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(shuffle_partitions=8, app_name="skewkit-plans")
    print(f"# Physical plans of the batch queries ({os.path.basename(sf_dir.rstrip('/'))}, AQE final plans)\n")
    print("Generated by `python plan_report.py`. *Exchanges* counts shuffles (not the")
    print("single-partition exchanges of broadcasts); *partial Top-N* means a `WindowGroupLimit`")
    print("runs before the exchange, so a hot group ships at most N rows per map task. The last column is our reading")
    print("of each plan, not measured.\n")
    print("| Query | Exchanges | Broadcasts | Joins | Partial Top-N | Aggregates | Pushed filters | At scale |")
    print("| --- | ---: | ---: | --- | --- | --- | --- | --- |")
    for name, fn in BATCH_QUERIES.items():
        qe = fn(spark, sf_dir)._jdf.queryExecution()
        qe.toRdd().count()  # run this very plan (JVM-side) so AQE fixes its final form
        plan = qe.executedPlan().toString()
        s = summarise(plan)
        print(f"| `{name}` | {s['exchanges']} | {s['broadcasts']} | {s['joins']} | {s['partial_topn']} | "
              f"{s['aggregates']} | {s['pushed']} | {SCALE_NOTES.get(name, '')} |")
    spark.stop()


if __name__ == "__main__":
    main()
