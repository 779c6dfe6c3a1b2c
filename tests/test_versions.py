"""Published versions: pruning, concurrent runs, held leagues, compaction, retention."""

import time
import uuid

from pyspark.sql import functions as F

from draftledger import files
from draftledger.operators import present
from draftledger.plans import versions
from draftledger.plans.models import Models
from draftledger.plans.refresh import bad_cells, compact, league_filter, read_table, refresh
from draftledger.sources import schemas as S
from tests.fixtures import D, SEASON, snapshot_rows

DRAFT = [("L1", "1", "1", "Ann", "A"), ("L1", "1", "2", "Bob", "B"), ("L2", "1", "1", "Cy", "C"), ("L3", "1", "1", "Di", "A")]
TITLES = [("L1", "A"), ("L1", "B"), ("L2", "C"), ("L3", "A")]


def inputs(spark, revenue, draft=DRAFT, rules=(("L1", "1", "2.0", "round"),)):
    snaps = [(lg, t, revenue + i, revenue + i, 0, D(1998, 12, 1), "1998") for i, (lg, t) in enumerate(TITLES)]
    return {"snapshots": spark.createDataFrame(snapshot_rows(snaps), S.SNAPSHOT), "draft_text": spark.createDataFrame(draft, S.DRAFT_TEXT),
            "rules_text": spark.createDataFrame(list(rules), S.RULES_TEXT), "manual_adds_text": spark.createDataFrame([], S.MANUAL_ADDS_TEXT)}


def publish(spark, out, revenue, *leagues, stamp=None):
    """A run that writes one table, as a refresh writes each."""
    stamp = stamp or versions.start(spark, out)
    rows = [(lg, t, revenue + i) for i, (lg, t) in enumerate(TITLES) if not leagues or lg in leagues]
    df = spark.createDataFrame(rows, "draft_id string, title string, revenue long").coalesce(1)
    version = uuid.uuid4().hex
    present.write_league_table("base_query", df, out, version, 1)
    some = league_filter(spark, *leagues) if leagues else None
    versions.publish(spark, out, version, 1, {"base_query": df.schema.json()}, stamp, some)


def revenues(spark, out, **kw):
    return {(r.draft_id, r.title): r.revenue for r in read_table(spark, out, "base_query", **kw).collect()}


def test_every_published_table_is_the_models_table(spark, tmp_path):
    given = inputs(spark, 100)
    names = refresh(spark, given, str(tmp_path / "o"), SEASON)
    m = Models(spark, SEASON, **given)
    for name, df in m.outputs().items():
        got = read_table(spark, str(tmp_path / "o"), name)
        assert got.columns == df.columns and sorted(map(str, got.collect())) == sorted(map(str, df.collect())), name
    assert len(names) == 16


def test_files_read_do_not_grow_with_refreshes(spark, tmp_path):
    out = str(tmp_path / "o")
    publish(spark, out, 100)
    read = []
    for i in range(4):
        publish(spark, out, 200 + 10 * i, "L2")
        read.append(len(read_table(spark, out, "base_query").inputFiles()))
    assert read == [read[0]] * 4
    assert revenues(spark, out) == {("L1", "A"): 100, ("L1", "B"): 101, ("L2", "C"): 232, ("L3", "A"): 103}
    assert revenues(spark, out, leagues=["L2"]) == {("L2", "C"): 232}
    assert revenues(spark, out, leagues=["L1", "L2"]) == {("L1", "A"): 100, ("L1", "B"): 101, ("L2", "C"): 232}
    # a league of the newer version alone opens that version's file alone
    assert len(read_table(spark, out, "base_query", leagues=["L2"]).inputFiles()) == 1
    publish(spark, out, 500)
    assert len(versions.last_commit(spark, out).versions) == 1 and revenues(spark, out)["L2", "C"] == 502


def test_the_run_that_started_later_wins_whoever_commits_first(spark, tmp_path):
    out = str(tmp_path / "o")
    publish(spark, out, 100)
    early, late = versions.start(spark, out), versions.start(spark, out)
    publish(spark, out, 300, "L1", "L2", stamp=late)
    publish(spark, out, 200, "L2", "L3", stamp=early)
    assert revenues(spark, out) == {("L1", "A"): 300, ("L1", "B"): 301, ("L2", "C"): 302, ("L3", "A"): 203}
    # a full run that started before them covers nobody but those that no later run has covered
    publish(spark, out, 900, stamp=early)
    assert {k: v // 100 for k, v in revenues(spark, out).items()} == {("L1", "A"): 3, ("L1", "B"): 3, ("L2", "C"): 3, ("L3", "A"): 2}
    publish(spark, out, 900)
    assert set(v // 100 for v in revenues(spark, out).values()) == {9}
    before = versions.last_commit(spark, out)
    publish(spark, out, 100, stamp=early)  # older than what is published for all
    assert revenues(spark, out)["L1", "A"] == 900 and versions.last_commit(spark, out).whole == before.whole


def test_a_number_that_another_run_took_is_not_overwritten(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "o")
    publish(spark, out, 100)
    stamp = versions.start(spark, out)
    original, raced = files.write_new, []

    def race(spark_, path, text):
        if "/_log/" in path and not raced:
            raced.append(path)
            monkeypatch.setattr(files, "write_new", original)
            publish(spark, out, 300, "L3")  # takes the number
        return original(spark_, path, text)

    monkeypatch.setattr(files, "write_new", race)
    publish(spark, out, 200, "L1", stamp=stamp)
    assert revenues(spark, out) == {("L1", "A"): 200, ("L1", "B"): 201, ("L2", "C"): 102, ("L3", "A"): 303}
    assert versions.last_commit(spark, out).number == 3


def test_a_bad_cell_holds_its_league_back_and_no_other(spark, tmp_path):
    out = str(tmp_path / "o")
    refresh(spark, inputs(spark, 100, [("L1", "one", "1", "Ann", "A"), *DRAFT[1:]]), out, SEASON)
    assert set(revenues(spark, out)) == {("L2", "C"), ("L3", "A")} and revenues(spark, out, leagues=["L1"]) == {}
    # L1 is mended, L3 breaks
    refresh(spark, inputs(spark, 200, rules=[("L3", "A", "x2", "movie"), ("L2", "C", " ", "movie")]), out, SEASON)
    assert revenues(spark, out) == {("L1", "A"): 200, ("L1", "B"): 201, ("L2", "C"): 202, ("L3", "A"): 103}
    assert list(map(tuple, bad_cells(spark, out).collect())) == [("L3", "rules_text", "multiplier", "x2")]
    refresh(spark, inputs(spark, 300), out, SEASON, leagues=league_filter(spark, "L3"))
    assert revenues(spark, out)["L3", "A"] == 303 and bad_cells(spark, out).count() == 0


def test_compaction_and_retention(spark, tmp_path):
    out = str(tmp_path / "o")
    publish(spark, out, 100)
    stamp = versions.start(spark, out)
    for i, lg in enumerate(("L1", "L2", "L3")):
        publish(spark, out, 200 + 100 * i, lg)
    want = revenues(spark, out)
    assert len(versions.last_commit(spark, out).versions) == 4
    assert versions.vacuum(spark, out, 3600) == [] and revenues(spark, out) == want
    assert compact(spark, out) and len(versions.last_commit(spark, out).versions) == 1
    assert revenues(spark, out) == want
    # a run that started before the compaction still counts where nothing newer was published, and only there
    publish(spark, out, 900, "L4", "L1", stamp=stamp)
    assert revenues(spark, out) == want
    time.sleep(1.1)
    gone = versions.vacuum(spark, out, 0)
    assert any("/base_query/version=" in p for p in gone) and revenues(spark, out) == want
    left = [e.name for e in files.entries(spark, f"{out}/base_query")]
    assert sorted(left) == sorted(f"version={v}" for v in versions.last_commit(spark, out).versions)


def test_very_many_named_leagues_are_met_by_a_join(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "o")
    monkeypatch.setattr(versions, "NAMED", 1)
    publish(spark, out, 100)
    publish(spark, out, 200, "L1", "L3")
    assert revenues(spark, out) == {("L1", "A"): 200, ("L1", "B"): 201, ("L2", "C"): 102, ("L3", "A"): 203}
    assert revenues(spark, out, leagues=["L3", "L2"]) == {("L2", "C"): 102, ("L3", "A"): 203}


def test_an_unfinished_commit_is_passed_over(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "o")
    monkeypatch.setattr(versions, "WRITING_SECONDS", 0)
    publish(spark, out, 100)
    assert files.write_new(spark, f"{out}/_log/{2:012d}.json", '{"number": 2, "wh')
    assert versions.last_commit(spark, out).number == 1 and revenues(spark, out)["L1", "A"] == 100
    assert not files.write_new(spark, f"{out}/_log/{1:012d}.json", "{}")
    publish(spark, out, 200)
    assert versions.last_commit(spark, out).number == 3 and revenues(spark, out)["L1", "A"] == 200
    assert spark.read.parquet(f"{out}/base_query").where(F.col("draft_id") == "L1").count() == 4
