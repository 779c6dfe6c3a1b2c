"""Plan review: the shape of every registered query's physical plan, from ``explain()``.

Summarises exchanges (hash, range, single partition), broadcasts, join strategies, window
group limits, aggregates and the filters pushed into each Parquet scan, and flags the
shapes that do not scale: nested-loop or cartesian joins and exchanges into one partition.
Run as ``python -m draftledger.plans.explain <sf_dir> [key,key]``.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

from pyspark.sql import DataFrame

RED_FLAGS = ("BroadcastNestedLoopJoin", "CartesianProduct", "SinglePartition")


def plan_text(df: DataFrame) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def summarize(df: DataFrame) -> dict:
    text = plan_text(df)
    count = lambda pat: len(re.findall(pat, text))
    # a total over all rows: one row of each task meets in one
    flagged = re.sub(r"Exchange SinglePartition[^\n]*\n[^\n]*HashAggregate\(keys=\[\], functions=\[partial_", "", text)
    return {
        "hash_exchanges": count(r"Exchange hashpartitioning"),
        "range_exchanges": count(r"Exchange rangepartitioning"),
        "broadcasts": count(r"BroadcastExchange"),
        "sort_merge_joins": count(r"SortMergeJoin"),
        "broadcast_hash_joins": count(r"BroadcastHashJoin"),
        "window_group_limits": count(r"WindowGroupLimit .*Partial"),
        "partial_aggregates": count(r"(?:Hash|Sort|ObjectHash)Aggregate\(keys?=\[[^\]]*\], functions=\[partial_"),
        "scans": count(r"FileScan parquet"),
        "pushed_filters": sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", text))),
        "red_flags": [f for f in RED_FLAGS if f in flagged],
    }


def main() -> None:
    sys.path.insert(0, ".")
    from draftledger.plans.catalog import QUERIES
    from draftledger.session import build_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2].split(",") if len(sys.argv) > 2 else sorted(QUERIES)
    spark = build_session("local[8]")
    for key in keys:
        s = summarize(QUERIES[key](spark, sf_dir))
        print(f"{key:32s} hash={s['hash_exchanges']} range={s['range_exchanges']} bcast={s['broadcasts']} "
              f"smj={s['sort_merge_joins']} bhj={s['broadcast_hash_joins']} wgl={s['window_group_limits']} "
              f"partial_agg={s['partial_aggregates']} scans={s['scans']} flags={s['red_flags']}")


if __name__ == "__main__":
    main()
