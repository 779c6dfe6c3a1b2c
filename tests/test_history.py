"""The history as merged state: any order of days gives what the whole history gives; the stream reads the day only."""

import random

import pytest

from draftledger.operators import checks, clean, history, titles
from draftledger.plans import history_state
from draftledger.plans.explain import plan_text
from draftledger.plans.refresh import InputPaths, read_table, refresh_paths
from draftledger.sources import readers
from draftledger.sources import schemas as S
from draftledger.streaming import refresh_stream
from tests.fixtures import D, SEASON, snapshot_rows

YEARS = [("L1", 1998), ("L2", 1997), ("L3", 1998)]


def _snaps(seed, n=150):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        year = r.choice(["1997", "1998", None])
        rev = r.choice([0, 5, 5, r.randrange(100), None])
        day = r.choice([D(1998, 12, r.randrange(1, 29)), D(1997, 6, r.randrange(1, 29)), None] if r.random() < 0.1 else [D(1998, 12, r.randrange(1, 29))])
        out.append((r.choice(["L1", "L2"]), f"t{r.randrange(6)}", rev, rev, 0, day, year))
    return [row[:7] + (None,) if row[5] is None else row for row in snapshot_rows([x for x in out if x[5]])] + [
        (lg, t, a, b, c, d, y, None) for lg, t, a, b, c, d, y in out if d is None]


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("seed,shared", [(1, False), (2, True)])
def test_merged_state_equals_the_state_of_the_whole(spark, tmp_path, seed, shared):
    rows = _snaps(seed)
    whole = spark.createDataFrame(rows, S.SNAPSHOT)
    whole = clean.clean_snapshots(whole.drop("draft_id") if shared else whole)
    want = history.summarize(whole)
    random.Random(seed).shuffle(rows)
    cuts = [0, 3, 40, 41, 110, len(rows)]
    root = str(tmp_path / "state")
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        part = spark.createDataFrame(rows[a:b], S.SNAPSHOT)
        state = history_state.merge(spark, root, clean.clean_snapshots(part.drop("draft_id") if shared else part), "stream", k)
    again = history_state.merge(spark, root, whole, "stream", 2)  # a batch that is run again is not merged twice
    for name, df in want.tables().items():
        assert _rows(state.tables()[name]) == _rows(df) == _rows(again.tables()[name]), name
    years = spark.createDataFrame(YEARS, "draft_id string, year int")
    assert _rows(titles.season_titles(state.titles, SEASON, years)) == _rows(titles.season_titles(history.title_state(whole, 2), SEASON, years))
    assert _rows(checks.season_floor(state.floors, SEASON, years)) == _rows(checks.newest_snapshot_floor(whole, SEASON, years))
    assert _rows(history_state.rebuild(spark, root, whole).titles) == _rows(want.titles)
    assert len(history_state.vacuum(spark, root, 0)) >= 5 and _rows(history_state.load(spark, root).titles) == _rows(want.titles)


def _paths(spark, root, configs, history_rows):
    paths = InputPaths(f"{root}/snapshots", f"{root}/draft", f"{root}/rules", f"{root}/none", f"{root}/configs")
    _add(spark, paths, history_rows)
    draft = [("L1", "1", "1", "Ann", "A"), ("L1", "1", "2", "Bob", "B"), ("L2", "1", "1", "Cy", "C"), ("L3", "1", "1", "Di", "A")]
    spark.createDataFrame(draft, S.DRAFT_TEXT).write.parquet(paths.draft)
    spark.createDataFrame([("L1", "1", "2.0", "round")], S.RULES_TEXT).write.parquet(paths.rules)
    spark.createDataFrame(configs, S.LEAGUE_CONFIGS).write.parquet(paths.configs)
    return paths


def _add(spark, paths, rows):
    days = [("x", t, rev, rev, 0, d, y) for t, rev, d, y in rows]
    spark.createDataFrame(snapshot_rows(days), S.SNAPSHOT).drop("draft_id").coalesce(1).write.mode("append").parquet(paths.snapshots)


FIRST = [("A", 100, D(1998, 12, 1), "1998"), ("B", 70, D(1998, 11, 1), "1998"), ("C", 40, D(1997, 6, 1), "1997"), ("C", 50, D(1997, 7, 1), "1997")]
CONFIGS = [(f"{lg}.yml", lg, y) for lg, y in YEARS]


def _run(spark, paths, out, ckpt):
    q = refresh_stream.start(spark, paths, out, ckpt, SEASON)
    q.awaitTermination(300)
    if q.exception():
        raise q.exception()


def test_stream_over_a_shared_history(spark, tmp_path, monkeypatch):
    paths = _paths(spark, str(tmp_path / "in"), CONFIGS, FIRST)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    refreshed = []
    original = refresh_stream.refresh

    def spy(*args, **kw):
        refreshed.append(sorted(r.draft_id for r in kw["leagues"].collect()))
        return original(*args, **kw)

    monkeypatch.setattr(refresh_stream, "refresh", spy)
    _run(spark, paths, out, ckpt)

    def revenue():
        return {(r.draft_id, r.title): r.revenue for r in read_table(spark, out, "base_query").collect()}

    assert revenue() == {("L1", "A"): 100, ("L1", "B"): 70, ("L2", "C"): 50, ("L3", "A"): 100}

    # a day of 1997 refreshes exactly the leagues of 1997, and the history is not read again
    def unread(*a, **k):
        raise AssertionError("the history was read")

    monkeypatch.setattr(readers, "load_snapshots", unread)
    monkeypatch.setattr(readers, "_declared", unread)
    _add(spark, paths, [("C", 60, D(1997, 7, 2), "1997")])
    _run(spark, paths, out, ckpt)
    assert refreshed == [["L1", "L2", "L3"], ["L2"]]
    assert revenue() == {("L1", "A"): 100, ("L1", "B"): 70, ("L2", "C"): 60, ("L3", "A"): 100}
    monkeypatch.undo()
    # the same tables as a refresh from the files
    full = str(tmp_path / "full")
    refresh_paths(spark, paths, full, SEASON)
    for name in ("base_query", "freshness", "scoreboard"):
        got, want = (read_table(spark, o, name) for o in (out, full))
        if name == "freshness":  # a league that was not refreshed still shows its own newest time
            got, want = got.where("draft_id = 'L2'"), want.where("draft_id = 'L2'")
        assert _rows(got) == _rows(want), name


def test_a_title_of_two_years_touches_both(spark):
    snap = clean.clean_snapshots(spark.createDataFrame(snapshot_rows([
        ("x", "A", 1, 1, 0, D(1998, 1, 1), "1998"), ("x", "A", 1, 1, 0, D(1997, 1, 1), "1997"), ("x", "B", 1, 1, 0, D(1996, 1, 1), "1996")]),
        S.SNAPSHOT).drop("draft_id"))
    years = spark.createDataFrame([*YEARS, ("L4", 1996)], "draft_id string, year int")
    touched = refresh_stream.touched_leagues(snap.where("release_year = '1998'"), history.summarize(snap), years)
    assert sorted(r.draft_id for r in touched.collect()) == ["L1", "L2", "L3"]
    with pytest.raises(ValueError, match="configurations"):
        refresh_stream.touched_leagues(snap, history.summarize(snap), None)


def test_a_league_configured_twice_stops_stream_and_refresh(spark, tmp_path):
    paths = _paths(spark, str(tmp_path / "in"), [*CONFIGS, ("again.yml", "L2", 1998)], FIRST)
    with pytest.raises(ValueError, match="L2"):
        refresh_paths(spark, paths, str(tmp_path / "out"), SEASON)
    with pytest.raises(Exception, match="L2"):
        _run(spark, paths, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    assert history_state.load(spark, str(tmp_path / "out" / "_history")) is None


def test_a_shared_title_is_worked_on_before_it_is_given_to_the_leagues(spark):
    """Its snapshot of a year was looked for in every league, and a merge sorted its snapshots once for every year."""
    whole = clean.clean_snapshots(spark.createDataFrame(_snaps(2), S.SNAPSHOT).drop("draft_id"))
    years = spark.createDataFrame(YEARS, "draft_id string, year int")
    state = history.title_state(whole, 2)
    lines = plan_text(titles.season_titles(state, SEASON, years)).splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert not any("_newest" in line or "lambda" in line for line in lines[:join + 1])
    parts = [history.summarize(whole.where(c)) for c in ("revenue > 5", "not coalesce(revenue > 5, false)")]
    merged = history.merge(*parts).titles
    top = plan_text(merged).split("ObjectHashAggregate")[0]
    assert top.count("sort_array(") == 1, top
    assert _rows(merged) == _rows(history.title_state(whole))
