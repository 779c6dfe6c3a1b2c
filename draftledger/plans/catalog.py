"""Registered queries: one per operator key of the survey's inventory.

Each entry takes (spark, sf_dir) and returns a DataFrame over the league tables derived
from the driver's tables at ``sf_dir`` (see ``sources.testbed``).
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from draftledger.functions.joins import not_in
from draftledger.operators import checks, clean, history, present, standings, titles
from draftledger.params import DEFAULT_SEASON
from draftledger.plans.models import Models
from draftledger.plans.refresh import InputPaths, read_table, refresh
from draftledger.session import path_complete, shared_dir
from draftledger.sources import bucketed, by_year, readers, schemas, testbed
from draftledger.streaming import refresh_stream

SEASON = DEFAULT_SEASON


# What every query relies on, whatever session the caller brings: dates and publish times are
# UTC, and a bad money value fails.
NEEDED = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true"}


def _session(spark: SparkSession) -> SparkSession:
    """The caller's session if it has what is needed, else a session of our own beside it with
    the caller's settings; the caller's is never changed."""
    if all(spark.conf.get(k).lower() == v.lower() for k, v in NEEDED.items()):
        return spark
    own = spark.newSession()
    for key, value in (spark.conf.getAll | NEEDED).items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def _m(spark: SparkSession, sf_dir: str, **kw) -> Models:
    return Models.from_testbed(_session(spark), sf_dir, SEASON, **kw)


def _on(build: Callable[[Models], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(_m(spark, sf_dir))


def _dashboard(table: str):
    def build(m: Models) -> DataFrame:
        tables = present.dashboard_tables(m.scoreboard, m.base_query, m.row_budget, m.worst_picks, m.best_picks)
        return tables[table]
    return _on(build)


def _s2(spark, sf_dir):
    m = _m(spark, sf_dir)
    return readers.snapshot_from_scraped(testbed.scraped_page(m.raw_snapshots, SEASON), SEASON)


def _s6(spark, sf_dir):
    absent = readers.optional_source(_session(spark), f"{sf_dir}/manual_adds.parquet", schemas.MANUAL_ADDS_TEXT)
    return _m(spark, sf_dir, manual_adds_text=absent).scored


def _s7(spark, sf_dir):
    """M1 whose shares are quotients by totals that may be zero, so that NaN and both infinities
    really occur: the reader shows them, and only them, as NULL."""
    scored = _m(spark, sf_dir).scored
    total = F.when(F.col("title").endswith("3"), F.lit(0.0)).otherwise(F.col("revenue").cast("double"))
    part = F.when(F.col("title").endswith("13"), F.lit(0.0)).otherwise(
        F.when(F.col("title").endswith("23"), -1.0).otherwise(1.0) * F.greatest("domestic_rev", F.lit(1)))
    # IEEE division, which Spark's operator refuses at zero: x * (1 / 0) as a product with infinity
    share = F.when(total == 0, part * F.lit(float("inf"))).otherwise(F.try_divide(part, total))
    return readers.read_model(scored.withColumn("domestic_pct", share))


def _k1(spark, sf_dir):
    """A full refresh into the shared folder, and its first table as published."""
    m = _m(spark, sf_dir)
    root = f"{shared_dir(spark).rstrip('/')}/k1_refresh/{uuid.uuid4().hex}"
    refresh(m.spark, testbed.load(m.spark, sf_dir, SEASON), root, SEASON)
    return read_table(m.spark, root, "base_query_int").select(*m.scored.columns)


def _shared_history(m: Models) -> DataFrame:
    """The snapshots of all leagues as one history without leagues."""
    return m.raw_snapshots.drop("draft_id")


def _m1_shared(spark, sf_dir):
    """Every league scores the one shared history in the season of its own year."""
    m = _m(spark, sf_dir)
    years = testbed.league_years(m.spark, sf_dir, SEASON)
    return _m(spark, sf_dir, snapshots=_shared_history(m), league_years=years).scored


def _shared_folder(m: Models) -> str:
    """A folder of our own for a shared history written from the league tables."""
    return f"{shared_dir(m.spark).rstrip('/')}/shared_history/{uuid.uuid4().hex}"


def _s8(spark, sf_dir):
    """The one loader on both kinds of history: the leagues' folder and a shared history."""
    m = _m(spark, sf_dir)
    shared = f"{_shared_folder(m)}/snapshots"
    _shared_history(m).write.parquet(shared)
    of_leagues = testbed.materialize(m.spark, sf_dir, SEASON)["snapshots"]
    kinds = [(k, readers.load_snapshots(m.spark, SEASON, path=p)) for k, p in (("leagues", of_leagues), ("shared", shared))]
    one, two = [df.withColumn("kind", F.lit(k)) for k, df in kinds]
    return one.unionByName(two, allowMissingColumns=True)


def _s8_stream(spark, sf_dir):
    """A shared history that arrives in two parts, the later days first, each through the stream: the released
    table of every league in its own year, as published after the second trigger."""
    m = _m(spark, sf_dir)
    root = _shared_folder(m)
    inputs = testbed.materialize(m.spark, sf_dir, SEASON)
    years = testbed.league_years(m.spark, sf_dir, SEASON)
    years.select(F.concat("draft_id", F.lit(".yml")).alias("config_name"), "draft_id", F.col("year").cast("int").alias("year")).write.parquet(f"{root}/configs")
    paths = InputPaths(f"{root}/snapshots", inputs["draft_text"], inputs["rules_text"], inputs["manual_adds_text"], f"{root}/configs")
    late = F.col("loaded_date") >= F.make_date(F.lit(SEASON.year), F.lit(7), F.lit(1))
    for part in (late, ~late):
        _shared_history(m).where(part).write.mode("append").parquet(paths.snapshots)
        refresh_stream.start(m.spark, paths, f"{root}/out", f"{root}/checkpoint", SEASON).awaitTermination()
    return read_table(m.spark, f"{root}/out", "base_query")


def _merged(m: Models) -> history.History:
    """The state of the history put together from three parts of its days."""
    part = F.pmod(F.datediff("loaded_date", F.lit(dt.date(1970, 1, 1))), F.lit(3))
    states = [history.summarize(m.snapshots.where(part == i)) for i in range(3)]
    return history.merge(history.merge(states[2], states[0]), states[1])


def _on_state(build: Callable[[Models], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf_dir):
        m = _m(spark, sf_dir)
        return build(_m(spark, sf_dir, history_state=_merged(m)))
    return run


#: Buckets of the bucketed history: a bucket of the largest test table has a few hundred thousand rows.
BUCKETS = 16


def _bucketed(m: Models, sf_dir: str) -> DataFrame:
    """The leagues' history bucketed by title, written once beside the league tables."""
    path = f"{testbed.testbed_root(m.spark, sf_dir, SEASON)}/snapshots_by_title_{BUCKETS}"
    return bucketed.write(m.raw_snapshots, path, BUCKETS, f"snapshots_by_title_{hashlib.sha256(path.encode()).hexdigest()[:16]}")


def _m1_bucketed(spark, sf_dir):
    m = _m(spark, sf_dir)
    return _m(spark, sf_dir, snapshots=_bucketed(m, sf_dir)).scored


def _by_year(m: Models, sf_dir: str) -> str:
    """The leagues' history by release year with its index, written once beside the league tables in two batches,
    the later days first."""
    root = f"{testbed.testbed_root(m.spark, sf_dir, SEASON)}/snapshots_by_year"
    if not path_complete(m.spark, f"{root}/done"):
        late = F.col("loaded_date") >= F.make_date(F.lit(SEASON.year - 2), F.lit(1), F.lit(1))
        root_ = f"{root}-{uuid.uuid4().hex}"  # a build that was broken off is left alone
        for part in (late, ~late):
            by_year.add(m.raw_snapshots.where(part), root_)
        m.spark.createDataFrame([(root_,)], "root string").coalesce(1).write.mode("overwrite").parquet(f"{root}/done")
    return m.spark.read.parquet(f"{root}/done").first()[0]


def _w1_index(spark, sf_dir):
    m = _m(spark, sf_dir)
    return not_in(by_year.first_seen(m.spark, _by_year(m, sf_dir)), "title", m.exclusions, "movie")


def _w2_split(spark, sf_dir):
    m = _m(spark, sf_dir)
    root = _by_year(m, sf_dir)
    snap = clean.clean_snapshots(by_year.days(m.spark, root))
    return titles.latest_snapshot(by_year.season_latest(snap, by_year.first_seen(m.spark, root), SEASON), m.exclusions)


def _j14_split(spark, sf_dir):
    """State and floor from the season's folder alone; the released titles are M1's."""
    m = _m(spark, sf_dir)
    root = _by_year(m, sf_dir)
    snap = clean.clean_snapshots(by_year.days(m.spark, root))
    state = by_year.season_latest(snap, by_year.first_seen(m.spark, root), SEASON)
    return checks.under_floor_titles(state, checks.newest_snapshot_floor(snap, SEASON), m.released)


def _a7_split(spark, sf_dir):
    m = _m(spark, sf_dir)
    return checks.newest_snapshot_floor(clean.clean_snapshots(by_year.days(m.spark, _by_year(m, sf_dir))), SEASON)


def _p5(spark, sf_dir):
    return _m(spark, sf_dir).scored.select("draft_id", "title", "drafted_by", "overall_pick", "round",
                                           "revenue", "multiplier", "scored_revenue")


def _p7(spark, sf_dir):
    return _m(spark, sf_dir).scored.select("draft_id", "title", "drafted_by", "overall_pick", "revenue",
                                           "domestic_rev", "foreign_rev", "domestic_pct", "foreign_pct")


def _j4(spark, sf_dir):
    m = _m(spark, sf_dir)
    mov = m.movie_overrides.withColumnRenamed("multiplier", "movie_multiplier")
    return m.drafter.join(mov, ["draft_id", "movie"], "left")


def _a5(spark, sf_dir):
    m = _m(spark, sf_dir)
    return checks.freshness(m.published, m.league_done, SEASON)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources
    "s1_daily_scan": _on(lambda m: m.raw_snapshots),
    "s2_money_clean": _s2,
    "s3_draft_picks": _on(lambda m: m.draft),
    "s4_manual_adds_raw": _on(lambda m: m.manual_adds_raw),
    "s5_rules_raw": _on(lambda m: m.rules),
    "s6_optional_source": _s6,
    "s7_read_model": _s7,
    "s1_shared_history": _on(_shared_history),
    "s8_load_snapshots": _s8,
    "s8_shared_stream": _s8_stream,
    # sinks
    "k1_refresh": _k1,
    "k2_released_movies": _on(lambda m: present.released_movies(m.base_query)),
    "k2_standings": _dashboard("dashboard_standings"),
    "k2_worst_picks": _dashboard("dashboard_worst_picks"),
    "k2_best_picks": _dashboard("dashboard_best_picks"),
    "k3_scoreboard": _on(lambda m: present.drafter_scoreboards(checks.drafter_scoreboard(m.draft, m.scoreboard))),
    "k3_draftee_tabs": _on(lambda m: present.draftee_tabs(m.draftee_dashboard)),
    # projections / cleaning
    "p1_drafter_clean": _on(lambda m: m.drafter),
    "p3_snapshot_clean": _on(lambda m: m.snapshots),
    "p4_manual_adds_clean": _on(lambda m: m.manual_adds),
    "p5_scoring": _p5,
    "p7_shares": _p7,
    # filters
    "f2_movie_overrides": _on(lambda m: m.movie_overrides),
    "f2_round_overrides": _on(lambda m: m.round_overrides),
    "f2_exclusions": _on(lambda m: m.exclusions),
    "f9_drafter_scoreboard": _on(lambda m: checks.drafter_scoreboard(m.draft, m.scoreboard)),
    # joins
    "j3_round_multiplier_join": _on(lambda m: m.picks),
    "j4_movie_multiplier_join": _j4,
    "j5_exclude_titles": _on(lambda m: titles.exclude_titles(m.snapshots, m.exclusions)),
    "j6_manual_override": _on(lambda m: m.tracked.drop("_act")),
    "j7_better_pick_pairs": _on(lambda m: m.pairs),
    "j8_manual_flag": _on(lambda m: titles.manual_flag(m.base_titles, m.manual_adds, m.activity)),
    "j12_draftee_dashboard": _on(lambda m: m.draftee_dashboard),
    "j13_missing_picks": _on(lambda m: checks.missing_picks(m.drafter, m.released)),
    "j14_under_min_revenue": _on(lambda m: checks.under_floor_titles(m.state, m.floor, m.released)),
    # windows
    "w1_first_seen": _on(lambda m: titles.first_seen(m.snapshots, m.exclusions)),
    "w2_latest_snapshot": _on(lambda m: m.latest.drop("_act")),
    "w1_first_seen_index": _w1_index,
    "w2_split_scan": _w2_split,
    "a7_split_scan": _a7_split,
    "j14_split_scan": _j14_split,
    "w2_merged_state": _on_state(lambda m: m.latest.drop("_act")),
    "a7_merged_state": _on_state(lambda m: m.floor),
    "w3_still_in_theaters": _on(lambda m: m.activity),
    "w3_still_in_theaters_intended": _on(lambda m: titles.activity(m.snapshots, SEASON, intended=True)),
    "w4_base_query": _on(lambda m: m.base_query),
    "w5_revenue_rank": _on(lambda m: standings.revenue_rank(m.ranked)),
    "w6_best_picks": _on(lambda m: m.best_picks),
    "w7_worst_picks": _on(lambda m: m.worst_picks),
    "w8_better_pick_final": _on(lambda m: m.best_alternative),
    "w10_dedupe_titles": _on(lambda m: m.base_titles),
    # set operations
    "u1_with_manual_adds": _on(lambda m: m.with_manual),
    # composite
    "m1_base_query_int": _on(lambda m: m.scored),
    "m1_shared_history": _m1_shared,
    "m1_bucketed_history": _m1_bucketed,
    # aggregations
    "a2_scoreboard": _on(lambda m: m.scoreboard),
    "a3_better_pick_stats": _on(lambda m: m.better_pick_stats),
    "a4_draft_order": _on(lambda m: checks.draft_order(m.drafter)),
    "a5_freshness": _a5,
    "a6_league_done": _on(lambda m: m.league_done),
    "a7_min_revenue": _on(lambda m: m.floor),
    "a9_duplicate_leagues": lambda s, d: checks.duplicate_leagues(testbed.league_configs(s, d, SEASON)),
    # order / limits
    "o1_standings_order": _on(lambda m: standings.standings_order(m.scoreboard)),
    "o2_budgeted_picks": _on(lambda m: present.budgeted_picks(m.row_budget, m.worst_picks, m.best_picks)),
    "o3_row_budget": _on(lambda m: m.row_budget),
}
