"""The full refresh (K1) and the streaming trigger that refreshes only touched leagues."""


from pyspark.sql import functions as F

import pytest

from draftledger.plans.refresh import InputPaths, league_filter, load_inputs, only_leagues, read_table, refresh
from draftledger.sources import schemas as S
from draftledger.streaming import refresh_stream
from tests.fixtures import D, SEASON, snapshot_rows


def _write_inputs(spark, root, snaps):
    paths = InputPaths(f"{root}/snapshots", f"{root}/draft", f"{root}/rules", f"{root}/manual_adds_absent")
    spark.createDataFrame(snapshot_rows(snaps), S.SNAPSHOT).write.mode("append").parquet(paths.snapshots)
    draft = [("L1", "1", "1", "Ann", "A"), ("L1", "1", "2", "Bob", "B"), ("L2", "1", "1", "Cy", "C")]
    spark.createDataFrame(draft, S.DRAFT_TEXT).write.mode("overwrite").parquet(paths.draft)
    spark.createDataFrame([("L1", "1", "2.0", "round")], S.RULES_TEXT).write.mode("overwrite").parquet(paths.rules)
    return paths


SNAPS = [("L1", "A", 100, 100, 0, D(1998, 12, 1), "1998"), ("L1", "B", 300, 0, 300, D(1998, 12, 1), "1998"),
         ("L2", "C", 50, 50, 0, D(1998, 12, 1), "1998")]


def test_refresh_all_then_one_league(spark, tmp_path):
    paths = _write_inputs(spark, str(tmp_path / "in"), SNAPS)
    out = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        read_table(spark, out, "base_query")
    refresh(spark, load_inputs(spark, paths), out, SEASON)
    bq = read_table(spark, out, "base_query")
    assert bq.count() == 3
    assert {r.draft_id for r in bq.select("draft_id").distinct().collect()} == {"L1", "L2"}
    # new data for L2 only; refreshing L2 leaves L1's partition as it was
    more = [("L2", "C", 80, 80, 0, D(1998, 12, 2), "1998")]
    spark.createDataFrame(snapshot_rows(more), S.SNAPSHOT).write.mode("append").parquet(paths.snapshots)
    refresh(spark, load_inputs(spark, paths), out, SEASON, leagues=league_filter(spark, "L2"))
    bq = read_table(spark, out, "base_query")
    rev = {(r.draft_id, r.title): r.revenue for r in bq.collect()}
    assert rev == {("L1", "A"): 100, ("L1", "B"): 300, ("L2", "C"): 80}
    assert read_table(spark, out, "scoreboard").count() == 3


def _published(spark, out):
    """Titles by table, as readers see them."""
    names = {"base_query_int": "title", "base_query": "title", "best_picks": "title", "worst_picks": "title",
             "better_pick_final": "better_pick_title", "scoreboard": "drafted_by_name"}
    return {n: sorted((r["draft_id"], r[c]) for r in read_table(spark, out, n).collect()) for n, c in names.items()}


def _renew(spark, paths, snaps):
    """Inputs as if the files had been replaced: only these snapshots."""
    inputs = load_inputs(spark, paths)
    return inputs | {"snapshots": spark.createDataFrame(snapshot_rows(snaps), S.SNAPSHOT)}


def test_what_is_gone_is_gone_for_readers(spark, tmp_path):
    """A league without rows, and tables that became empty: full refresh, refresh of one league."""
    paths = _write_inputs(spark, str(tmp_path / "in"), SNAPS)
    for leagues in (None, "L1"):
        out = str(tmp_path / f"out-{leagues}")
        refresh(spark, load_inputs(spark, paths), out, SEASON)
        first = _published(spark, out)
        assert first["best_picks"] == [("L1", "B")] and first["worst_picks"] == [("L1", "A")]
        assert first["better_pick_final"] == [("L1", "B")]
        # A overtakes B: nothing is better or worse than drafted; L2 has no snapshots any more
        later = [("L1", "A", 900, 900, 0, D(1998, 12, 3), "1998"), SNAPS[1]]
        named = None if leagues is None else league_filter(spark, leagues)
        refresh(spark, _renew(spark, paths, later), out, SEASON, leagues=named)
        now = _published(spark, out)
        assert now["best_picks"] == now["worst_picks"] == now["better_pick_final"] == []
        assert [t for lg, t in now["base_query"] if lg == "L1"] == ["A", "B"]
        row = read_table(spark, out, "base_query").filter("title = 'A'").first()
        assert row.better_pick_title == "" and row.revenue == 900
        # L2 was not asked for in the second case, so it stays
        assert [lg for lg, _ in now["scoreboard"]].count("L2") == (0 if leagues is None else 1)


def test_a_league_that_lost_its_rows_in_its_own_refresh(spark, tmp_path):
    paths = _write_inputs(spark, str(tmp_path / "in"), SNAPS)
    out = str(tmp_path / "out")
    refresh(spark, load_inputs(spark, paths), out, SEASON)
    refresh(spark, _renew(spark, paths, SNAPS[:2]), out, SEASON, leagues=league_filter(spark, "L2"))
    now = _published(spark, out)
    assert {lg for rows in now.values() for lg, _ in rows} == {"L1"}


def test_leagues_of_two_seasons_on_one_history(spark, tmp_path):
    """L1 plays 1998, L2 1997; the history has no leagues; a refresh serves both."""
    paths = _write_inputs(spark, str(tmp_path / "in"), SNAPS)
    days = [("x", "A", 100, 100, 0, D(1998, 12, 1), "1998"), ("x", "B", 70, 70, 0, D(1998, 11, 1), "1998"),
            ("x", "C", 40, 40, 0, D(1997, 6, 1), "1997"), ("x", "C", 50, 50, 0, D(1997, 7, 1), "1997")]
    history = spark.createDataFrame(snapshot_rows(days), S.SNAPSHOT).drop("draft_id")
    years = spark.createDataFrame([("L1", 1998), ("L2", 1997)], "draft_id string, year int")
    out = str(tmp_path / "out")
    refresh(spark, load_inputs(spark, paths) | {"snapshots": history}, out, SEASON, league_years=years)
    got = {(r.draft_id, r.title): r.revenue for r in read_table(spark, out, "base_query").collect()}
    assert got == {("L1", "A"): 100, ("L1", "B"): 70, ("L2", "C"): 50}
    done = {r.draft_id: r.done for r in read_table(spark, out, "freshness").collect()}
    assert done == {"L1": False, "L2": True}


def test_a_refresh_of_some_leagues_reads_only_their_folders(spark, tmp_path):
    rows = spark.createDataFrame(snapshot_rows(SNAPS), S.SNAPSHOT)
    rows.write.partitionBy("draft_id").parquet(str(tmp_path / "s"))
    snaps = {"s": spark.read.schema(S.SNAPSHOT).parquet(str(tmp_path / "s"))}
    cut = only_leagues(snaps, league_filter(spark, "L2"))["s"]
    from draftledger.plans.explain import plan_text
    import re
    assert re.search(r"PartitionFilters: \[[^\]]*draft_id", plan_text(cut)) and cut.count() == 1


def test_stream_refreshes_touched_leagues(spark, tmp_path):
    paths = _write_inputs(spark, str(tmp_path / "in"), SNAPS)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    q = refresh_stream.start(spark, paths, out, ckpt, SEASON)
    q.awaitTermination(120)
    assert read_table(spark, out, "base_query").count() == 3
    more = [("L1", "A", 900, 900, 0, D(1998, 12, 3), "1998")]
    spark.createDataFrame(snapshot_rows(more), S.SNAPSHOT).write.mode("append").parquet(paths.snapshots)
    q = refresh_stream.start(spark, paths, out, ckpt, SEASON)
    q.awaitTermination(120)
    bq = read_table(spark, out, "base_query")
    assert bq.filter((F.col("title") == "A")).first().revenue == 900
    assert bq.count() == 3
