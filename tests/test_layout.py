"""Row budget of the two pick tables (O3) and the rows that fit (O2): own size combinations,
including no space at all and one-row tables."""

import pytest
from pyspark.sql import functions as F

from draftledger.operators.present import budgeted_picks, row_budget

# (standings rows, released rows, worst rows, best rows) -> (worst height, both tables, best height)
CASES = [
    ((4, 40, 30, 30), (14, True, 15)),
    ((4, 40, 5, 30), (5, True, 24)),
    ((4, 40, 30, 3), (14, True, 3)),
    ((4, 13, 10, 10), (1, True, 1)),
    ((4, 12, 10, 10), (5, False, 0)),
    ((4, 8, 10, 10), (1, False, 0)),
    ((4, 7, 10, 10), (0, False, 0)),
    ((4, 2, 10, 10), (0, False, 0)),
    ((4, 40, 1, 30), (0, False, 0)),
    ((4, 40, 30, 1), (30, False, 0)),
    ((4, 40, 0, 0), (0, False, 0)),
    ((10, 100, 100, 100), (41, True, 42)),
    ((2, 30, 2, 2), (2, True, 2)),
    ((0, 3, 5, 5), (0, False, 0)),
    ((6, 20, 8, 1), (8, False, 0)),
]


def _table(spark, league, n, name):
    return spark.range(n).select(F.lit(league).alias("draft_id"), (F.col("id") + 1).alias("rank"),
                                 F.lit(name).alias("title"))


@pytest.fixture(scope="module")
def layout(spark):
    leagues, boards, released, worst, best = [], [], [], [], []
    for i, ((sb, rel, wl, bl), _) in enumerate(CASES):
        lg = f"L{i:02d}"
        leagues.append(lg)
        boards.append(_table(spark, lg, sb, "s"))
        released.append(_table(spark, lg, rel, "r"))
        worst.append(_table(spark, lg, wl, "w"))
        best.append(_table(spark, lg, bl, "b"))

    def union(parts):
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    lg = spark.createDataFrame([(x,) for x in leagues], "draft_id string")
    return {r.draft_id: r for r in row_budget(lg, union(boards), union(released), union(worst), union(best)).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_budget(layout, i):
    (sb, rel, wl, bl), (wh, both, bh) = CASES[i]
    r = layout[f"L{i:02d}"]
    assert (r.worst_picks_height, r.add_both_picks_tables, r.best_picks_height) == (wh, both, bh)
    assert r.available_height == rel - sb - 3
    assert r.worst_picks_row_num == sb + 7
    if both:
        assert r.best_picks_row_num == sb + 7 + 1 + wh + 2
    assert r.add_picks_table == (wh > 0 and wl > 1)


def test_budgeted_rows(spark):
    lay = spark.createDataFrame(
        [("A", True, True, 2, 1), ("B", True, False, 3, 0), ("C", False, False, 0, 0)],
        "draft_id string, add_picks_table boolean, add_both_picks_tables boolean, "
        "worst_picks_height bigint, best_picks_height bigint")
    rows = [(lg, r, f"{lg}{r}", "x", r, 1, 1.0) for lg in "ABC" for r in range(1, 5)]
    worst = spark.createDataFrame(rows, "draft_id string, rank bigint, title string, drafted_by string, "
                                        "overall_pick int, number_of_better_picks bigint, missed_revenue double")
    best = spark.createDataFrame(rows, "draft_id string, rank bigint, title string, drafted_by string, "
                                       "overall_pick int, positions_gained bigint, actual_revenue double")
    got = sorted((r.draft_id, r.table_name, r["rank"]) for r in budgeted_picks(lay, worst, best).collect())
    assert got == [("A", "best", 1), ("A", "worst", 1), ("A", "worst", 2),
                   ("B", "worst", 1), ("B", "worst", 2), ("B", "worst", 3)]
