"""Title scoring (M1): one row per title of the season with its pick, score and status.

Per-title state is built from the snapshot history in two passes that both cut a title's rows
before the shuffle (a hash aggregate for the first day, a group limit for the newest
snapshots), so a title with a very long history never lands whole in one task. The league inputs
are joined to that small per-title table on (draft_id, title).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from draftledger.functions.columns import asc, days_until, desc, f32, f32_or_one, share
from draftledger.functions.joins import in_flag, not_in
from draftledger.functions.windows import first_per_key, top_n_per_key
from draftledger.params import Season

KEYS = ["draft_id", "title"]
MONEY = ["revenue", "domestic_rev", "foreign_rev"]
#: Parts that the titles of one release year are dealt to when a shared history meets its leagues.
YEAR_PARTS = 16


def newest_rows(snap: DataFrame, keys: list[str], depth: int) -> DataFrame:
    """Per title its newest ``depth`` snapshots of every release year, one struct ``_snapshot`` each.

    The row_number filter is planned with a map-side group limit, so a title with a long
    history is cut down to a few rows before any shuffle; W2, W3 and J14 all read them.
    Ties on the day go to the larger amounts.
    """
    rows = snap.select(*keys, "release_year", "loaded_date", *MONEY)
    order = [desc("loaded_date"), *[desc(c) for c in MONEY]]
    top = top_n_per_key(rows, [*keys, "release_year"], order, depth, "_pos")
    return top.select(*keys, F.struct("loaded_date", *MONEY, "release_year").alias("_snapshot"))


def newest_per_year(snap: DataFrame, keys: list[str], depth: int) -> DataFrame:
    """The newest snapshots of every title as one array, newest first."""
    return newest_rows(snap, keys, depth).groupBy(*keys).agg(
        F.sort_array(F.collect_list("_snapshot"), asc=False).alias("_newest"))


def _activity_columns(season: Season, intended: bool) -> dict:
    def at(pos: int, c: str) -> F.Column:
        return F.get("_newest", F.lit(pos))[c]

    revenue, previous = at(0, "revenue"), at(1, "revenue")
    week = at(7, "revenue") if intended else F.lit(None).cast("bigint")
    days = days_until(at(0, "loaded_date"), season.as_of)
    still = F.coalesce(((revenue != previous) | (revenue != week)) & (days <= season.window_days), F.lit(False))
    return {"revenue": revenue, "last_day_revenue": previous, "revenue_7_days_ago": week,
            "change_in_last_day": revenue != previous, "change_in_last_week": revenue != week,
            "last_updated_date": at(0, "loaded_date"), "days_since_last_update": days, "still_in_theaters": still}


def season_titles(history: DataFrame, season: Season, years: DataFrame | None = None) -> DataFrame:
    """Per title of the season, from the title state of the history (``operators.history``): its newest
    in-season snapshot (F1 + W2), the first day it was seen over the whole history (W1) and whether
    it still earns (W3).

    ``years``: one row (draft_id, year) per league, for leagues of different seasons; else the
    one season holds for all. A history without ``draft_id`` is shared: its state is made
    once per title and then given to every league of the title's year.
    """
    shared = "draft_id" not in history.columns
    if shared and years is None:
        raise ValueError("a shared history needs the leagues and their years")
    state = history.withColumn("_act", _activity_columns(season, False)["still_in_theaters"])
    if years is not None:
        years = years.select("draft_id", F.col("year").cast("string").alias("_year")).distinct()
    def newest_of(year: F.Column) -> F.Column:
        return F.get(F.filter("_newest", lambda x: x["release_year"] == year), F.lit(0))

    shown = [*[F.col(f"_n.{c}").alias(c) for c in MONEY], F.col("_n.loaded_date").alias("loaded_date"), "first_seen_date", "_act"]
    if shared:  # a title's snapshot of a year is found once, not in every league of the year
        seen = F.array_distinct(F.transform("_newest", lambda x: x["release_year"]))
        by_year = state.select("title", "first_seen_date", "_act", F.explode(F.transform(seen, newest_of)).alias("_n"))
        by_year = by_year.filter(F.col("_n").isNotNull()).select("title", F.col("_n.release_year").alias("_year"), *shown)
        return _to_leagues(by_year, years).drop("_year").select(*KEYS, *MONEY, "loaded_date", "first_seen_date", "_act")
    if years is not None:
        state = state.join(years, "draft_id")
    else:
        state = state.withColumn("_year", F.lit(season.year_text))
    return state.withColumn("_n", newest_of(F.col("_year"))).filter(F.col("_n").isNotNull()).select(*KEYS, *shown)


def _to_leagues(by_year: DataFrame, years: DataFrame) -> DataFrame:
    """Every title to every league of its year. All titles of a year have one key, so both sides get a
    second one: a title falls into one of ``YEAR_PARTS`` by its name, a league into each."""
    part = F.pmod(F.xxhash64("title"), F.lit(YEAR_PARTS)).cast("int")
    every = years.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(YEAR_PARTS - 1))))
    return by_year.withColumn("_part", part).join(every, ["_year", "_part"]).drop("_part")


def first_seen(snap: DataFrame, excl: DataFrame) -> DataFrame:
    """W1 alone: first day each non-excluded title was seen."""
    per_title = snap.groupBy(*KEYS).agg(F.min("loaded_date").alias("first_seen_date"))
    return not_in(per_title, "title", excl, "movie")


def latest_snapshot(state: DataFrame, excl: DataFrame) -> DataFrame:
    """J5 + W1 + F1 + W2 (= A1, the per-title sums are over one row): the season's newest
    snapshot of every non-excluded title. Exclusions remove whole titles, so they are applied
    to the per-title table instead of every snapshot row."""
    return not_in(state, "title", excl, "movie")


def exclude_titles(snap: DataFrame, excl: DataFrame) -> DataFrame:
    """Snapshot rows whose title is not excluded (NOT IN with NULL rules)."""
    return not_in(snap, "title", excl, "movie")


def activity(snap: DataFrame, season: Season, intended: bool = False) -> DataFrame:
    """W3 + P10 + P12: is each title still earning? Over the whole history, no exclusions.

    Reference rule: newest revenue differs from the previous snapshot's, and the newest
    snapshot is at most ``window_days`` old. The "changed in the last week" test compares
    with ``lag(revenue, 7)`` over a descending order, which is always NULL on the newest
    row, so it never fires; ``intended=True`` compares with the snapshot 7 rows older.
    """
    newest = newest_per_year(snap, KEYS, 8 if intended else 2)
    return newest.select(*KEYS, *[c.alias(n) for n, c in _activity_columns(season, intended).items()])


def tracked_titles(latest: DataFrame, manual: DataFrame) -> DataFrame:
    """J6 (+A1): tracked titles that have no manual entry (NOT IN with NULL rules)."""
    kept = not_in(latest, "title", manual, "title")
    extra = ["_act"] if "_act" in latest.columns else []
    return kept.select(*KEYS, *[F.col(c).cast("bigint").alias(c) for c in MONEY], "first_seen_date", *extra)


def _manual_as_tracked(manual: DataFrame) -> DataFrame:
    return manual.select(*KEYS, *[F.col(c).cast("bigint").alias(c) for c in MONEY], "first_seen_date")


def with_manual_adds(tracked: DataFrame, manual: DataFrame) -> DataFrame:
    """Tracked titles plus the manual entries, both in the tracked types."""
    return tracked.unionByName(_manual_as_tracked(manual))


def dedupe_titles(titles: DataFrame) -> DataFrame:
    """One row per title, the largest revenue (then larger parts, earlier first seen)."""
    order = [desc("revenue"), desc("domestic_rev"), desc("foreign_rev"), asc("first_seen_date")]
    return first_per_key(titles, KEYS, order)


def dedupe_titles_split(tracked: DataFrame, manual: DataFrame) -> DataFrame:
    """W10 without shuffling the tracked titles: they are already one row per title and,
    after J6, share no title with the manual entries, so only the manual entries can hold
    duplicates. Same rows as ``dedupe_titles(with_manual_adds(tracked, manual))``."""
    return tracked.unionByName(dedupe_titles(_manual_as_tracked(manual)))


def manual_flag(base: DataFrame, manual: DataFrame, act: DataFrame) -> DataFrame:
    """Manual titles are never "still in theaters"; others take the activity flag."""
    flagged = in_flag(base.select(*KEYS), "title", manual, "title", "is_manual")
    joined = flagged.join(act.select(*KEYS, F.col("still_in_theaters").alias("_act")), KEYS, "left")
    still = F.when(F.col("is_manual"), F.lit(False)).otherwise(F.coalesce("_act", F.lit(False)))
    return joined.select(*KEYS, "is_manual", still.alias("still_in_theaters"))


def pick_table(draft: DataFrame, round_mult: DataFrame) -> DataFrame:
    """Each pick with its round multiplier (duplicated overrides duplicate the pick)."""
    return (draft.select("draft_id", F.col("movie").alias("title"), F.col("name").alias("drafted_by"),
                         "overall_pick", "round")
            .join(round_mult, ["draft_id", "round"], "left"))


def titles_with_status(tracked: DataFrame, manual: DataFrame) -> DataFrame:
    """W10 + J2 + J8: every title once, with its status. A tracked title brings its own along; a
    manual one is never still in theaters, and after J6 no tracked title is a manual one."""
    status = F.col("_act").alias("still_in_theaters")
    return tracked.select(*KEYS, *MONEY, "first_seen_date", status).unionByName(
        dedupe_titles(_manual_as_tracked(manual)).withColumn("still_in_theaters", F.lit(False)))


def score_titles(base: DataFrame, picks: DataFrame, movie_ov: DataFrame) -> DataFrame:
    """The scored title table (M1) from ``titles_with_status``.

    ``picks`` is ``pick_table`` (picks already carry the round multiplier: joining the
    overrides to the picks first gives the same rows as joining them after the title join,
    and keeps every later join on (draft_id, title)).
    """
    mov = movie_ov.select("draft_id", F.col("movie").alias("title"), F.col("multiplier").alias("movie_multiplier"))
    joined = base.join(picks, KEYS, "left").join(mov, KEYS, "left")                  # J1, J4
    mult = f32_or_one("round_multiplier") * f32_or_one("movie_multiplier")           # P5
    scored = F.round(mult * f32("revenue"), 0)                                       # P6
    return joined.select(
        "draft_id", "title", "drafted_by", "overall_pick",
        F.coalesce("revenue", F.lit(0).cast("bigint")).alias("revenue"),
        "round",
        mult.alias("multiplier"),
        scored.alias("scored_revenue"),
        F.coalesce("domestic_rev", F.lit(0).cast("bigint")).alias("domestic_rev"),
        F.coalesce("foreign_rev", F.lit(0).cast("bigint")).alias("foreign_rev"),
        share("domestic_rev", "revenue").alias("domestic_pct"),                     # P7
        share("foreign_rev", "revenue").alias("foreign_pct"),
        "first_seen_date",
        "still_in_theaters",
    )
