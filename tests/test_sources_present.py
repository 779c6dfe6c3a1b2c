"""Sources (S3-S7) and display frames (K2, K3, F9) on own fixtures."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from draftledger.operators import checks, present
from draftledger.sources import readers, schemas as S
from tests.fixtures import D, SEASON, models


def test_rules_blank_multiplier_is_zero(spark):
    text = spark.createDataFrame([("L", "T", "", "movie"), ("L", "2", "2.0", "round"), ("L", "X", "  ", "exclusion")],
                                 S.RULES_TEXT)
    assert [r.multiplier for r in readers.rules_from_text(text).collect()] == [0.0, 2.0, 0.0]


def test_draft_text_cast_and_order(spark):
    text = spark.createDataFrame([("L", "1", "3", "Ann", "T"), ("L", None, None, None, None)], S.DRAFT_TEXT)
    rows = readers.draft_from_text(text).collect()
    assert (rows[0]["round"], rows[0].overall_pick) == (1, 3)
    assert rows[1].movie is None
    from draftledger.operators.clean import clean_draft
    assert clean_draft(readers.draft_from_text(text)).columns == ["draft_id", "movie", "name", "overall_pick", "round"]


def test_optional_source(spark, tmp_path):
    empty = readers.optional_source(spark, str(tmp_path / "absent"), S.MANUAL_ADDS_TEXT)
    assert empty.count() == 0 and empty.schema == S.MANUAL_ADDS_TEXT
    with pytest.raises(FileNotFoundError):
        readers.optional_source(spark, str(tmp_path / "absent"), S.DRAFT_TEXT, required=True)
    spark.createDataFrame([("L", "1", "1", "A", "T")], S.DRAFT_TEXT).write.parquet(str(tmp_path / "draft"))
    assert readers.optional_source(spark, str(tmp_path / "draft"), S.DRAFT_TEXT, required=True).count() == 1


def test_read_model_nan_inf_and_rename(spark):
    df = spark.createDataFrame([(1.0, 2.0), (math.nan, math.inf), (-math.inf, None)], "a double, b float")
    out = readers.read_model(df, ["A", "B"])
    assert out.columns == ["A", "B"]
    assert [tuple(r) for r in out.collect()] == [(1.0, 2.0), (None, None), (None, None)]


def test_scraped_page(spark):
    page = spark.createDataFrame([("L", "T", "$1,500", "-", "$1,500")],
                                 f"draft_id string, `{S.SCRAPED_TITLE}` string, {S.SCRAPED_WORLDWIDE} string, "
                                 f"{S.SCRAPED_DOMESTIC} string, {S.SCRAPED_FOREIGN} string")
    r = readers.snapshot_from_scraped(page, SEASON).first()
    assert (r.revenue, r.domestic_rev, r.foreign_rev, r.loaded_date, r.release_year) == (1500, 0, 1500, SEASON.as_of, "1998")


def _league(spark):
    snaps = [("L", "A", 300, 100, 200, D(1998, 12, 30), "1998"), ("L", "A", 200, 100, 100, D(1998, 12, 29), "1998"),
             ("L", "B", 100, 100, 0, D(1998, 10, 1), "1998"), ("L", "C", 900, 0, 900, D(1998, 9, 1), "1998")]
    draft = [("L", 1, 1, "Ann", "A"), ("L", 1, 2, "Bob", "B"), ("L", 2, 3, "Ann", "C"), ("L", 2, 4, "Bob", "Z")]
    return models(spark, snaps, draft)


def test_released_and_standings(spark):
    m = _league(spark)
    bq = {r.title: r for r in m.base_query.collect()}
    assert [bq[t]["rank"] for t in "CAB"] == [1, 2, 3]
    assert bq["B"].better_pick_title == "C" and bq["B"].better_pick_scored_revenue == 900.0
    assert bq["A"].still_in_theaters == "Yes" and bq["B"].still_in_theaters == "No"
    assert bq["A"].first_seen_date == "12/29/1998"
    board = {r.drafted_by_name: r for r in m.scoreboard.collect()}
    assert board["Ann"].scored_revenue == 1200.0 and board["Ann"].num_released == 2
    # A is only beaten by C, which Ann drafted herself: both of her picks count as optimal
    assert board["Ann"].correctly_drafted_pick_count == 2 and board["Ann"].correct_pick_pct == 1.0
    assert board["Bob"].correctly_drafted_pick_count == 0
    missing = [r.movie for r in checks.missing_picks(m.drafter, m.base_query).collect()]
    assert missing == ["Z"]


def test_draftee_tabs_and_default_scoreboard(spark):
    m = _league(spark)
    tabs = {r.Movie: r for r in present.draftee_tabs(m.draftee_dashboard).collect()}
    assert tabs["Z"].Revenue is None and tabs["Z"].Multiplier == 1.0 and tabs["Z"]["First Seen Date"] == ""
    assert tabs["B"]["Better Pick"] == "C" and tabs["B"]["Better Pick Scored Revenue"] == 900.0
    assert tabs["C"]["Better Pick Scored Revenue"] is None
    third = m.draftee_dashboard.withColumn("better_pick_scored_revenue", F.lit(1000 / 3)).withColumn("scored_revenue", F.lit(math.nan))
    shown = present.draftee_tabs(third).first()
    assert shown["Better Pick Scored Revenue"] == 1000 / 3 and shown["Scored Revenue"] is None
    boards = present.drafter_scoreboards(checks.drafter_scoreboard(m.draft, m.scoreboard))
    assert boards.columns == ["draft_id", "draftee_name"] + present.SCOREBOARD_HEADINGS[1:] and boards.count() == 2
    extra = m.draft.unionByName(m.spark.createDataFrame([("L", 3, 9, "Cy", "Q")], "draft_id string, round int, "
                                                         "overall_pick int, name string, movie string"))
    rows = {r.drafted_by_name: r for r in checks.drafter_scoreboard(extra, m.scoreboard).collect()}
    assert (rows["Cy"].scored_revenue, rows["Cy"].num_released, rows["Cy"].unadjusted_revenue) == (0.0, 0, 0)


def test_released_display_blanks_zero_alternative(spark):
    m = _league(spark)
    disp = {r.Title: r for r in present.released_movies(m.base_query).collect()}
    assert disp["C"]["Better Pick Scored Revenue"] is None
    assert "Domestic Revenue %" in present.released_movies(m.base_query).columns


def test_league_done_and_freshness(spark):
    season = SEASON.__class__(year=1998, as_of=dt.date(1999, 3, 1))
    snaps = [("L", "A", 300, 100, 200, D(1998, 12, 30), "1998")]
    m = models(spark, snaps, [("L", 1, 1, "Ann", "A")], season=season)
    done = m.league_done.first()
    assert done.done is True and done.released_count == 1
    fresh = checks.freshness(m.published, m.league_done, season).first()
    assert "Dashboard is done updating" in fresh.status_text
    assert fresh.status_text.endswith("Data Updated Through\n1998-12-30 00:00:00 UTC")


def test_numbers_as_text(spark):
    text = spark.createDataFrame([("L", "1.0", " 3", "Ann", "T")], S.DRAFT_TEXT)
    assert (readers.draft_from_text(text).first()["round"], readers.draft_from_text(text).first().overall_pick) == (1, 3)
    with pytest.raises(Exception, match="not a number"):
        readers.draft_from_text(spark.createDataFrame([("L", "1d", "3", "Ann", "T")], S.DRAFT_TEXT)).collect()


def test_history_without_leagues_is_told_apart(spark, tmp_path):
    rows = spark.createDataFrame([("T", 1, 1, 0, D(1998, 1, 1), "1998", dt.datetime(1998, 1, 1))], S.SHARED_SNAPSHOT)
    rows.write.parquet(str(tmp_path / "shared"))
    with pytest.raises(ValueError, match="draft_id"):
        readers.read_snapshots(spark, str(tmp_path / "shared"))
    assert readers.load_snapshots(spark, SEASON, path=str(tmp_path / "shared")).columns == S.SNAPSHOT_COLUMNS[1:]
    rows.drop("revenue").write.parquet(str(tmp_path / "short"))
    with pytest.raises(ValueError, match="revenue"):
        readers.load_snapshots(spark, SEASON, path=str(tmp_path / "short"))


def test_duplicate_league_ids_stop_the_run(spark):
    cfg = spark.createDataFrame([("b.yml", "X", 1998), ("a.yml", "X", 1998), ("d.yml", "Y", 1998)], S.LEAGUE_CONFIGS)
    with pytest.raises(ValueError, match="X"):
        checks.require_unique_leagues(cfg)
    checks.require_unique_leagues(cfg.filter("config_name <> 'b.yml'"))


def test_duplicate_leagues(spark):
    cfg = spark.createDataFrame([("b.yml", "X", 1998), ("a.yml", "X", 1998), ("c.yml", "X", 1998), ("d.yml", "Y", 1998)],
                                S.LEAGUE_CONFIGS)
    r = checks.duplicate_leagues(cfg).collect()
    assert [(x.draft_id, x.n_configs, x.first_config, x.second_config) for x in r] == [("X", 3, "a.yml", "b.yml")]


def test_tables_are_written_in_buckets_of_leagues(spark, tmp_path):
    m = _league(spark)
    present.write_league_table("base_query", m.base_query, str(tmp_path), "1", 4)
    present.write_league_table("draftee_tabs", present.draftee_tabs(m.draftee_dashboard), str(tmp_path), "1", 4)
    at = spark.range(1).select(present.bucket_of(F.lit("L"), 4)).first()[0]
    assert (tmp_path / "base_query" / "version=1" / f"bucket={at}").exists()
    assert (tmp_path / "draftee_tabs" / "version=1" / f"bucket={at}").exists()
    assert spark.read.parquet(str(tmp_path / "base_query")).filter(F.col("draft_id") == "L").count() == 3


def test_many_leagues_make_few_files_and_one_league_opens_one(spark, tmp_path):
    leagues = spark.range(20_000).select(F.concat(F.lit("L"), "id").alias("draft_id"), F.col("id").alias("n"))
    path = present.write_league_table("t", leagues, str(tmp_path), "1", 40)
    rows = spark.read.parquet(path)
    assert 40 <= len(rows.inputFiles()) <= 80
    one = rows.where((F.col("draft_id") == "L77") & (F.col("bucket") == present.bucket_of(F.lit("L77"), 40)))
    assert one.select("n").first()[0] == 77 and one.select(F.input_file_name()).distinct().count() == 1


def test_dashboard_tables_headings(spark):
    m = _league(spark)
    tables = present.dashboard_tables(m.scoreboard, m.base_query, m.row_budget, m.worst_picks, m.best_picks)
    assert tables["dashboard_standings"].columns == ["draft_id"] + present.SCOREBOARD_HEADINGS
    assert tables["dashboard_worst_picks"].columns == ["draft_id"] + present.WORST_HEADINGS
    assert tables["dashboard_best_picks"].columns == ["draft_id"] + present.BEST_HEADINGS
    assert tables["dashboard_standings"].count() == 2
    # 3 released titles, 2 standings rows: no space for pick tables (available height < 1)
    assert tables["dashboard_worst_picks"].count() == 0


def test_draft_from_csv_export(spark, tmp_path):
    path = tmp_path / "draft.csv"
    path.write_text("draft_id,round,overall_pick,name,movie\nL,1,1,Ann,A\nL,1,2,Bob,B\nL,2,,Ann,C\n")
    rows = readers.read_draft_csv(spark, str(path)).orderBy("movie").collect()
    assert [(r["round"], r.overall_pick, r.name, r.movie) for r in rows] == [(1, 1, "Ann", "A"), (1, 2, "Bob", "B"),
                                                                             (2, None, "Ann", "C")]


def test_optional_source_csv_with_header(spark, tmp_path):
    path = tmp_path / "rules.csv"
    path.write_text("draft_id,value,multiplier,type\nL,T,,movie\nL,2,2.0,round\n")
    rules = readers.rules_from_text(readers.optional_source(spark, str(path), S.RULES_TEXT, fmt="csv"))
    assert sorted((r.value, r.multiplier, r.type) for r in rules.collect()) == [("2", 2.0, "round"), ("T", 0.0, "movie")]
    assert readers.optional_source(spark, str(tmp_path / "none.csv"), S.RULES_TEXT, fmt="csv").count() == 0
