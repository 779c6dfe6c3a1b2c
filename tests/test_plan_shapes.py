"""No registered query funnels through one task: no nested-loop or cartesian joins and no
exchange into a single partition, in its own plan or in that of any table written on the way."""

import re

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from draftledger.params import DEFAULT_SEASON
from draftledger.plans.catalog import QUERIES
from draftledger.plans.explain import plan_text, summarize

SF = "/root/testdata/sf0.001"
WITHOUT_PAIRS = ["w5_revenue_rank", "w6_best_picks", "a5_freshness", "a6_league_done", "j13_missing_picks", "j14_under_min_revenue"]


@pytest.fixture(scope="module")
def plans(spark):
    """For each query the plan of what it returns, and before it those of the tables it writes."""
    QUERIES["s1_daily_scan"](spark, SF).count()  # the league tables are there
    out, written = {}, []
    patch = pytest.MonkeyPatch()
    original = DataFrameWriter.parquet

    def spy(self, path, *args, **kw):
        written.append((path, self._df))
        return original(self, path, *args, **kw)

    patch.setattr(DataFrameWriter, "parquet", spy)
    try:
        for key, query in sorted(QUERIES.items()):
            if key not in ("k1_refresh", "s8_shared_stream"):  # they write every model; the models are looked at one by one
                written.clear()
                last = query(spark, SF)
                out[key] = [(p, plan_text(df), summarize(df)) for p, df in [*written, ("", last)]]
    finally:
        patch.undo()
    return out


def test_no_single_task_shapes(plans):
    assert not {k: s["red_flags"] for k, all_ in plans.items() for _, _, s in all_ if s["red_flags"]}


def test_the_history_is_never_sorted_whole_for_an_aggregate(plans):
    for key, all_ in plans.items():
        for _, text, _ in all_:
            assert not ("SortAggregate" in text and "/snapshots" in text), key
    text = plans["m1_base_query_int"][-1][1]
    assert "HashAggregate(keys=[draft_id" in text and "partial_min(loaded_date" in text
    assert "partial_max_by" in plans["a7_min_revenue"][-1][1] and "SortAggregate" not in plans["a7_min_revenue"][-1][1]


@pytest.mark.parametrize("key", WITHOUT_PAIRS)
def test_no_pair_join_where_no_alternative_is_read(plans, key):
    assert not any("_lb_bucket" in text or "spans-" in path for path, text, _ in plans[key])


def test_few_tables_are_written_on_the_way(plans):
    labels = {k: [p.rsplit("/", 1)[1].split("-")[0] for p, _, _ in all_ if p] for k, all_ in plans.items()}
    assert labels["o3_row_budget"].count("ranked") == 1
    for key in ("m1_base_query_int", "j13_missing_picks", "j14_under_min_revenue", "a5_freshness", "a6_league_done"):
        assert labels[key] == [], key
    assert labels["w5_revenue_rank"] == ["ranked"]
    for key, written in labels.items():  # the counts of A3 have a second layout and the ranks of the scores
        assert len(written) <= 7, (key, written)


def test_map_side_reduction_where_expected(plans):
    last = {k: all_[-1][2] for k, all_ in plans.items()}
    assert last["w3_still_in_theaters"]["window_group_limits"] >= 1
    assert last["m1_base_query_int"]["window_group_limits"] >= 1
    year = f"EqualTo(release_year,{DEFAULT_SEASON.year})"
    assert any(year in f for f in last["a7_min_revenue"]["pushed_filters"])
    assert any("EqualTo(type,exclusion)" in f for f in last["f2_exclusions"]["pushed_filters"])


def test_a_bucketed_history_is_not_shuffled(plans):
    """Between the scans of the history and the aggregate that has a few rows for each title left."""
    lines = plans["m1_bucketed_history"][-1][1].splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan" in line and "snapshots_by_title" in line]
    union = max(i for i, line in enumerate(lines) if line.strip(" :+-").startswith("Union") and i < scans[0])
    assert len(scans) == 2 and not any("Exchange" in line for line in lines[union:scans[-1] + 1])
    assert any("WindowGroupLimit" in line for line in lines[union:scans[-1]])


@pytest.mark.parametrize("key,scans", [("w2_split_scan", 1), ("a7_split_scan", 1), ("j14_split_scan", 2)])
def test_a_split_history_reads_the_season_s_folder(plans, key, scans):
    """Days are read from one year's folder; first days come from the index, not from the days."""
    history = [line for line in plans[key][-1][1].splitlines() if "FileScan" in line and "release_year#" in line]
    season = [line for line in history if re.search(rf"PartitionFilters: \[[^\]]*release_year#\d+ = {DEFAULT_SEASON.year}", line)]
    assert len(season) >= scans  # and in the filters that Spark makes of joins
    if key != "j14_split_scan":  # its released titles come from M1 over the whole history
        assert history == season
    index = plans["w1_first_seen_index"][-1][1]
    assert "partial_min(first_seen_date" in index and "loaded_date" not in index
