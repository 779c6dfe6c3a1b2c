"""Semantic traps of the reference carried into Spark, on own fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from draftledger.functions.columns import lenient_int, money_text_to_long, share
from draftledger.operators import titles
from tests.fixtures import D, SEASON, models

L = "L1"


def _picks(*movies, league=L):
    """draft rows: (league, round, pick, name, movie) in pick order, 2 drafters"""
    return [(league, (i // 2) + 1, i + 1, f"N{i % 2}", m) for i, m in enumerate(movies)]


def test_latest_snapshot_and_activity_example(spark):
    snaps = [(L, "T1", 500, 300, 200, D(1998, 12, 29), "1998"), (L, "T1", 400, 250, 150, D(1998, 12, 28), "1998"),
             (L, "T2", 90, 50, 40, D(1998, 12, 20), "1998"), (L, "T2", 80, 40, 40, D(1998, 12, 19), "1998")]
    m = models(spark, snaps, _picks("T1", "T2"))
    got = {r.title: (r.revenue, r.still_in_theaters) for r in m.scored.collect()}
    assert got == {"T1": (500, True), "T2": (90, False)}


def test_t2_week_change_never_fires_but_intended_does(spark):
    days = [D(1998, 12, 31) - dt.timedelta(days=i) for i in range(10)]
    # newest equals previous (no daily change) but differs from 7 snapshots ago
    revs = [100, 100, 100, 100, 100, 100, 100, 50, 40, 30]
    snaps = [(L, "T", r, r, 0, d, "1998") for r, d in zip(revs, days)]
    m = models(spark, snaps, _picks("T"))
    assert m.activity.first().still_in_theaters is False
    intended = titles.activity(m.snapshots, SEASON, intended=True).first()
    assert intended.still_in_theaters is True and intended.revenue_7_days_ago == 50


def test_activity_window_edges(spark):
    snaps = [(L, "A", 20, 20, 0, D(1998, 12, 24), "1998"), (L, "A", 10, 10, 0, D(1998, 12, 23), "1998"),
             (L, "B", 20, 20, 0, D(1998, 12, 23), "1998"), (L, "B", 10, 10, 0, D(1998, 12, 22), "1998"),
             (L, "C", 20, 20, 0, D(1998, 12, 30), "1998")]
    m = models(spark, snaps, _picks("A", "B", "C"))
    got = {r.title: (r.days_since_last_update, r.still_in_theaters) for r in m.activity.collect()}
    assert got == {"A": (7, True), "B": (8, False), "C": (1, False)}  # C: one snapshot only


def test_t3_float32_scoring(spark):
    big = 2 ** 24 + 1  # not representable in 32 bits
    snaps = [(L, "T", big, big, 0, D(1998, 12, 1), "1998")]
    m = models(spark, snaps, _picks("T"))
    r = m.scored.first()
    assert r.scored_revenue == float(2 ** 24)
    assert dict(m.scored.dtypes)["scored_revenue"] == "float"
    assert dict(m.scored.dtypes)["multiplier"] == "float"


def test_t5_share_of_zero_total(spark):
    df = spark.createDataFrame([(0, 0), (10, 0), (1, 3), (None, 3)], "a bigint, b bigint")
    got = [r.s for r in df.select(share("a", "b").alias("s")).collect()]
    assert got == [0.0, 0.0, 0.3333, 0.0]


def test_t6_exclusion_list_with_null_removes_everything(spark):
    snaps = [(L, "T1", 5, 5, 0, D(1998, 12, 1), "1998"), ("L2", "T9", 5, 5, 0, D(1998, 12, 1), "1998")]
    rules = [(L, None, "", "exclusion")]
    m = models(spark, snaps, _picks("T1") + _picks("T9", league="L2"), rules=rules)
    assert sorted(r.draft_id for r in m.latest.collect()) == ["L2"]


def test_first_seen_before_the_season_and_season_filter(spark):
    snaps = [(L, "T", 5, 5, 0, D(1997, 3, 1), "1997"), (L, "T", 9, 9, 0, D(1998, 2, 1), "1998"),
             (L, "OLD", 5, 5, 0, D(1997, 3, 1), "1997")]
    m = models(spark, snaps, _picks("T", "OLD"))
    rows = {r.title: r for r in m.scored.collect()}
    assert set(rows) == {"T"}
    assert rows["T"].first_seen_date == D(1997, 3, 1) and rows["T"].revenue == 9


def test_t10_t15_round_rules(spark):
    snaps = [(L, t, 100, 100, 0, D(1998, 12, 1), "1998") for t in ["A", "B", "C", "E"]]
    rules = [(L, "2", "3.0", "round"), (L, "x", "9.0", "round"), (L, "E", " ", "movie")]
    m = models(spark, snaps, _picks("A", "B", "C", "E"), rules=rules)
    got = {r.title: (r.round, r.multiplier, r.scored_revenue) for r in m.scored.collect()}
    assert got == {"A": (1, 1.0, 100.0), "B": (1, 1.0, 100.0), "C": (2, 3.0, 300.0), "E": (2, 0.0, 0.0)}


def test_t12_t18_manual_adds_casts(spark):
    manual = [(L, "M", "1.6", "2", "x", "6/5/1998")]
    m = models(spark, [(L, "T", 5, 5, 0, D(1998, 12, 1), "1998")], _picks("T", "M"), manual=manual)
    r = m.manual_adds.first()
    assert (r.revenue, r.domestic_rev, r.foreign_rev, r.first_seen_date) == (2, 2, None, D(1998, 6, 5))
    df = spark.createDataFrame([("12",), ("2.5",), ("abc",), ("99999999999",)], "v string")
    assert [x[0] for x in df.select(lenient_int("v")).collect()] == [12, 3, None, None]


def test_number_texts_read_as_the_engine_of_the_oracle_reads_them(spark):
    import duckdb
    texts = ["0x2", " 0x2 ", "-0x2", "0b11", "0X1F", "0x", "1_000", "1__0", "_1", "1_", "1e3", "+5", ".5", "5.", "1.5e1", " 2", "\t2\n", "1,000",
             "", "inf", "nan", "2147483648", "2147483647.4", "-0.5", "0.5", "1.5", "2.5", "1e400", "1d", "1f", "2L", None]
    con = duckdb.connect()
    want = [con.execute("select try_cast(? as integer)", [t]).fetchone()[0] for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    assert [r[0] for r in df.orderBy("i").select(lenient_int("v")).collect()] == want


def test_manual_add_replaces_tracked_and_is_never_active(spark):
    snaps = [(L, "T", 500, 500, 0, D(1998, 12, 30), "1998"), (L, "T", 400, 400, 0, D(1998, 12, 29), "1998")]
    manual = [(L, "T", "7000", "6000", "1000", "6/15/1998"), (L, "T", "9000", "9000", "0", "6/15/1998")]
    m = models(spark, snaps, _picks("T"), manual=manual)
    r = m.scored.collect()
    assert len(r) == 1 and r[0].revenue == 9000 and r[0].still_in_theaters is False


def test_t14_future_first_seen_counts_as_showing(spark):
    snaps = [(L, "F", 100, 100, 0, D(1999, 1, 5), "1998")]
    m = models(spark, snaps, _picks("F"))
    assert m.base_query.first().still_in_theaters == "Yes"


def test_t16_title_drafted_twice_fans_out(spark):
    snaps = [(L, "T", 100, 100, 0, D(1998, 12, 1), "1998"), (L, "U", 50, 50, 0, D(1998, 12, 1), "1998")]
    draft = [(L, 1, 1, "N0", "T"), (L, 1, 2, "N1", "T"), (L, 2, 3, "N0", "U")]
    m = models(spark, snaps, draft)
    assert m.scored.filter(F.col("title") == "T").count() == 2
    ranks = sorted(r["rank"] for r in m.base_query.collect())
    assert ranks == [1, 2, 3]


def test_t17_ties_broken_by_title(spark):
    snaps = [(L, t, 100, 100, 0, D(1998, 12, 1), "1998") for t in ["B", "A"]] + [(L, "Z", 10, 10, 0, D(1998, 12, 1), "1998")]
    m = models(spark, snaps, [(L, 1, 1, "N0", "Z"), (L, 1, 2, "N1", "B"), (L, 2, 3, "N1", "A")])
    best = m.best_alternative.first()
    assert (best.overall_pick, best.better_pick_title) == (1, "A")
    assert [r.title for r in m.base_query.orderBy("rank").collect()] == ["A", "B", "Z"]


def test_better_pick_uses_round_multiplier_of_original_pick(spark):
    snaps = [(L, "A", 100, 100, 0, D(1998, 12, 1), "1998"), (L, "B", 150, 150, 0, D(1998, 12, 1), "1998")]
    rules = [(L, "1", "0.5", "round")]
    m = models(spark, snaps, [(L, 1, 1, "N0", "A"), (L, 2, 2, "N1", "B")], rules=rules)
    pair = m.pairs.filter(F.col("title") == "A").first()
    # A scores 50; B scores 150 > 50; hypothetical = 0.5 x 150 = 75, missed 25 (double, unrounded)
    assert (pair.better_pick_title, pair.better_pick_scored_revenue, pair.missed_revenue) == ("B", 75.0, 25.0)


def test_money_text(spark):
    df = spark.createDataFrame([("$1,234,567",), ("-",), ("",), (None,), (" $12 ",)], "v string")
    assert [x[0] for x in df.select(money_text_to_long("v")).collect()] == [1234567, 0, 0, 0, 12]
