"""Data-quality checks and league metadata: J13, J14, A4-A7, A9, F9, P20."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from draftledger.functions.columns import TIMESTAMP_TEXT
from draftledger.params import Season

# Fixed status texts of the dashboard's freshness cell.
LAST_UPDATED = "Dashboard Last Updated"
DONE_UPDATING = "Dashboard is done updating\nand can be removed from the etl"
DATA_THROUGH = "Data Updated Through"


def missing_picks(draft: DataFrame, base_query: DataFrame) -> DataFrame:
    """Drafted titles that are not in the released table (set difference)."""
    released = base_query.select("draft_id", F.col("title").alias("movie"))
    return draft.select("draft_id", "movie").join(released, ["draft_id", "movie"], "left_anti").distinct()


def in_season(snap: DataFrame, season: Season, years: DataFrame | None = None) -> DataFrame:
    """The snapshots of the season; with ``years`` of each league's own, also from a history that
    all leagues share (then every league gets the rows of its year)."""
    if years is None:
        return snap.filter(F.col("release_year") == F.lit(season.year_text))
    own = years.select("draft_id", F.col("year").cast("string").alias("release_year")).distinct()
    return snap.join(own, [c for c in ("draft_id", "release_year") if c in snap.columns])


def newest_snapshot_floor(snap: DataFrame, season: Season, years: DataFrame | None = None) -> DataFrame:
    """A7 (+W9): per league, the newest in-season snapshot day and the smallest revenue on it.

    Two hash aggregates: the smallest revenue of each (league, day), NULL only if the day has
    nothing else, then the day's that is newest.
    """
    rows = in_season(snap, season, years)
    by_day = rows.groupBy("draft_id", "loaded_date").agg(F.min("revenue").alias("_least"))
    return by_day.groupBy("draft_id").agg(F.max("loaded_date").alias("newest_date"),
                                          F.max_by("_least", "loaded_date").alias("min_revenue"))


def season_floor(floors: DataFrame, season: Season, years: DataFrame | None = None) -> DataFrame:
    """A7 from the merged state of the history (``operators.history.floor_state``)."""
    return in_season(floors, season, years).select("draft_id", "newest_date", "min_revenue")


def under_floor_titles(state: DataFrame, floor: DataFrame, released: DataFrame) -> DataFrame:
    """Released titles whose newest in-season revenue (from the per-title state that scored
    them) is at or below the league's floor."""
    latest = state.select("draft_id", "title", "revenue")
    return (latest.join(released.select("draft_id", "title"), ["draft_id", "title"])
            .join(floor, "draft_id")
            .filter(F.col("revenue") <= F.col("min_revenue"))
            .select("draft_id", "title", "revenue", "min_revenue"))


def draft_order(draft: DataFrame) -> DataFrame:
    """A4: drafters of each league with their first overall pick (the display order)."""
    return (draft.filter(F.col("name").isNotNull())
            .groupBy("draft_id", "name").agg(F.min("overall_pick").alias("first_pick")))


def league_done(released: DataFrame, leagues: DataFrame, season: Season, years: DataFrame | None = None) -> DataFrame:
    """A league is finished when it has released titles, none still showing, and its
    season (its own year if ``years`` has one per league) lies before the year of the run."""
    per = released.groupBy("draft_id").agg(
        F.count(F.lit(1)).alias("released_count"),
        F.every(F.col("still_in_theaters") == "No").alias("_all_no"))
    out = leagues.select("draft_id").distinct().join(per, "draft_id", "left")
    if years is None:
        past = F.lit(season.year < season.run_date.year)
    else:
        out = out.join(years.select("draft_id", F.col("year").alias("_year")).distinct(), "draft_id", "left")
        past = F.coalesce(F.col("_year") < season.run_date.year, F.lit(False))
    done = F.coalesce(F.col("_all_no"), F.lit(False)) & (F.coalesce("released_count", F.lit(0)) > 0) & past
    return out.select("draft_id", F.coalesce("released_count", F.lit(0).cast("bigint")).alias("released_count"),
                      done.alias("done"))


def freshness(published: DataFrame, done: DataFrame, season: Season) -> DataFrame:
    """A5 + P20: newest publish time per league (``operators.history.published_state``) and the status
    text shown with it. One history for all leagues has one newest time."""
    newest = published
    if "draft_id" not in published.columns:
        newest = done.select("draft_id", published.agg(F.max("data_through")).scalar().alias("data_through"))
    run = F.date_format(F.lit(season.run_time).cast("timestamp"), TIMESTAMP_TEXT)
    text = F.concat(
        F.lit(LAST_UPDATED + "\n"), run, F.lit(" UTC"),
        F.when(F.col("done"), F.lit("\n" + DONE_UPDATING)).otherwise(F.lit("")),
        F.lit("\n" + DATA_THROUGH + "\n"), F.date_format("data_through", TIMESTAMP_TEXT), F.lit(" UTC"))
    return (newest.join(done.select("draft_id", "done"), "draft_id", "left")
            .select("draft_id", "data_through", F.coalesce("done", F.lit(False)).alias("done"),
                    text.alias("status_text")))


def duplicate_leagues(configs: DataFrame) -> DataFrame:
    """League ids declared by more than one configuration, with the first two
    configuration names in sorted order (the pair a sorted scan reports)."""
    named = configs.select("draft_id", "config_name").distinct()
    first = named.groupBy("draft_id").agg(F.min("config_name").alias("first_config"),
                                          F.count(F.lit(1)).alias("n_configs"))
    second = (named.join(first, "draft_id").filter(F.col("config_name") > F.col("first_config"))
              .groupBy("draft_id").agg(F.min("config_name").alias("second_config")))
    return (first.filter(F.col("n_configs") > 1).join(second, "draft_id")
            .select("draft_id", "n_configs", "first_config", "second_config"))


def require_unique_leagues(configs: DataFrame) -> None:
    """A9 as the run's guard: stop when any league id is declared more than once."""
    named = configs.select("draft_id", "config_name").distinct()
    twice = named.groupBy("draft_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    some = [f"{r['draft_id']} ({r['n']} configurations)" for r in twice.orderBy("draft_id").limit(20).collect()]
    if some:
        raise ValueError("league ids declared more than once: " + ", ".join(some))


def drafter_scoreboard(draft: DataFrame, board: DataFrame) -> DataFrame:
    """one standings row for every drafter of every league; zeros when nothing released."""
    names = draft_order(draft).select("draft_id", F.col("name").alias("drafted_by_name"))
    j = names.join(board, ["draft_id", "drafted_by_name"], "left")
    return j.select(
        "draft_id", "drafted_by_name",
        F.coalesce("scored_revenue", F.lit(0.0)).alias("scored_revenue"),
        F.coalesce("num_released", F.lit(0)).alias("num_released"),
        F.coalesce("correctly_drafted_pick_count", F.lit(0).cast("bigint")).alias("correctly_drafted_pick_count"),
        F.coalesce("correct_pick_pct", F.lit(0.0)).alias("correct_pick_pct"),
        F.coalesce("unadjusted_revenue", F.lit(0).cast("bigint")).alias("unadjusted_revenue"),
    )
