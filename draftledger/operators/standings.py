"""League tables: released picks (M4), standings (M5, O1), best (M6) and worst (M7) picks,
per-drafter picks (M8). Every rank is per league and computed with ``row_number_within``,
so a large league is ranked by many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from draftledger.functions.columns import asc, days_until, desc, display_date, lenient_int, share
from draftledger.functions.windows import row_number_within
from draftledger.params import Season

LEAGUE = ["draft_id"]

BASE_QUERY_COLUMNS = ["draft_id", "rank", "title", "drafted_by", "revenue", "scored_revenue", "round",
                      "overall_pick", "multiplier", "domestic_rev", "domestic_pct", "foreign_rev",
                      "foreign_pct", "better_pick_title", "better_pick_scored_revenue",
                      "first_seen_date", "still_in_theaters"]


def released_rows(scored: DataFrame, season: Season) -> DataFrame:
    """M4 before rank and alternative (F3, P8-P11): drafted titles with display date and status
    label. What needs neither rank nor alternative reads these rows."""
    drafted = scored.filter(F.col("drafted_by").isNotNull())
    label = (F.when(F.col("scored_revenue") == 0, F.lit("No"))
             .when(F.col("still_in_theaters")
                   | (days_until("first_seen_date", season.as_of) <= season.window_days), F.lit("Yes"))
             .otherwise(F.lit("No")))
    return drafted.select(
        "draft_id", "title", "drafted_by", "revenue", "scored_revenue", "round", "overall_pick",
        "multiplier", "domestic_rev", "domestic_pct", "foreign_rev", "foreign_pct",
        display_date("first_seen_date").alias("first_seen_date"),          # P9
        label.alias("still_in_theaters"),                                  # P10 + P11
    )


def ranked_rows(released: DataFrame) -> DataFrame:
    """Released titles ranked by score."""
    return row_number_within(released, LEAGUE, score_order(), "rank")


def with_alternative(released: DataFrame, best: DataFrame) -> DataFrame:
    """Each row's best alternative, blank and zero when nothing beats the pick. The
    alternatives have one row per pick, so a reader of other columns never runs the join."""
    return released.join(best, ["draft_id", "overall_pick"], "left").withColumns({
        "better_pick_title": F.coalesce("better_pick_title", F.lit("")),
        "better_pick_scored_revenue": F.coalesce("better_pick_scored_revenue", F.lit(0.0))})


def released_picks(ranked: DataFrame, best: DataFrame) -> DataFrame:
    """M4: the ranked released titles with their best alternatives."""
    return with_alternative(ranked, best).select(*BASE_QUERY_COLUMNS)


def score_order() -> list:
    """Score descending, title ascending; pick and drafter settle the rows a duplicated
    pick creates."""
    return [desc("scored_revenue"), asc("title"), asc("overall_pick"), asc("drafted_by")]


def revenue_rank(base_query: DataFrame) -> DataFrame:
    """Rank of every released title by score. It is the same window as the rank of M4
    (same rows, same order), so the column is reused instead of sorting again."""
    return base_query.select("draft_id", "title", F.col("rank").alias("revenue_order_rank"))


def scoreboard(base_query: DataFrame) -> DataFrame:
    """M5 (F3 + A2): per drafter total score, titles released, picks nobody beat, their
    share and the unadjusted revenue."""
    optimal = F.when((F.col("scored_revenue") > 0) & (F.col("better_pick_scored_revenue") == 0), 1).otherwise(0)
    agg = (base_query.filter(F.col("drafted_by").isNotNull())
           .groupBy("draft_id", F.col("drafted_by").alias("drafted_by_name"))
           .agg(F.sum("scored_revenue").alias("scored_revenue"),
                F.countDistinct("title").cast("int").alias("num_released"),
                F.sum(optimal).alias("correctly_drafted_pick_count"),
                F.sum("revenue").alias("unadjusted_revenue")))
    return agg.select("draft_id", "drafted_by_name", "scored_revenue", "num_released",
                      "correctly_drafted_pick_count",
                      share("correctly_drafted_pick_count", "num_released").alias("correct_pick_pct"),
                      "unadjusted_revenue")


def standings_order(board: DataFrame) -> DataFrame:
    """O1: standings position per league: score descending, then titles released."""
    return row_number_within(board, LEAGUE, [desc("scored_revenue"), asc("num_released"),
                                             asc("drafted_by_name")], "position")


def best_gains(ranked: DataFrame) -> DataFrame:
    """Picks that finished above their draft slot, unranked.

    The rank of a title is a column of its own row; only a title drafted more than once meets
    several ranks, and only such titles are joined.
    """
    ranks = (ranked.groupBy("draft_id", "title").agg(F.collect_list("rank").alias("_ranks"))
             .filter(F.size("_ranks") > 1))
    rows = (ranked.select("draft_id", "title", "drafted_by", "overall_pick", "scored_revenue", "rank")
            .filter(F.col("drafted_by").isNotNull()).join(ranks, ["draft_id", "title"], "left")
            .withColumn("_rank", F.explode(F.coalesce("_ranks", F.array("rank")))))
    gap = F.col("overall_pick") - F.col("_rank")
    return rows.filter((gap > 0) & (F.col("scored_revenue") > 0)).select(
        "draft_id", "title", "drafted_by", "overall_pick", gap.alias("positions_gained"),
        F.col("scored_revenue").alias("actual_revenue"))


def best_picks(gains: DataFrame) -> DataFrame:
    """M6 (W6): the gains ranked."""
    order = [desc("positions_gained"), asc("overall_pick"), asc("title"), desc("actual_revenue"), asc("drafted_by")]
    return row_number_within(gains, LEAGUE, order, "rank").select(
        "draft_id", "rank", "title", "drafted_by", "overall_pick", "positions_gained", "actual_revenue")


def worst_rows(released: DataFrame, stats: DataFrame) -> DataFrame:
    """Picks beaten by later picks, unranked."""
    return (released.select("draft_id", "title", "drafted_by", "overall_pick").join(stats, ["draft_id", "title"])
            .filter(F.col("number_of_better_picks") > 0)
            .withColumnRenamed("max_better_pick_revenue", "missed_revenue"))


def worst_picks(rows: DataFrame) -> DataFrame:
    """M7 (W7): largest miss first."""
    order = [desc("missed_revenue"), desc("number_of_better_picks"), asc("overall_pick"), asc("title"), asc("drafted_by")]
    return row_number_within(rows, LEAGUE, order, "rank").select(
        "draft_id", "rank", "title", "drafted_by", "overall_pick", "number_of_better_picks", "missed_revenue")


def draftee_dashboard(draft: DataFrame, base_query: DataFrame, round_ov: DataFrame,
                      movie_ov: DataFrame) -> DataFrame:
    """M8 (J12, P15, P16): every pick of every drafter; released fields only when released;
    a zero alternative score is NULL; unreleased picks show the rule multiplier."""
    bq = base_query.select("draft_id", F.col("title").alias("movie"), F.lit(True).alias("_released"),
                           F.col("first_seen_date").alias("_first_seen"),
                           F.col("still_in_theaters").alias("_still"),
                           F.col("revenue").alias("_revenue"), F.col("multiplier").alias("_mult"),
                           F.col("scored_revenue").alias("_scored"),
                           F.col("better_pick_title").alias("_better"),
                           F.col("better_pick_scored_revenue").alias("_better_score"))
    rmo = round_ov.select("draft_id", lenient_int("round").alias("round"),
                          F.col("multiplier").alias("_rmo"))
    mmo = movie_ov.select("draft_id", "movie", F.col("multiplier").alias("_mmo"))
    j = (draft.select("draft_id", "name", "round", "overall_pick", "movie")
         .join(bq, ["draft_id", "movie"], "left")
         .join(rmo, ["draft_id", "round"], "left")
         .join(mmo, ["draft_id", "movie"], "left"))
    released = F.col("_released").isNotNull()
    rule_mult = F.coalesce("_rmo", F.lit(1.0)) * F.coalesce("_mmo", F.lit(1.0))
    return j.select(
        "draft_id",
        F.col("name").alias("draftee_name"), "round", "overall_pick", "movie",
        F.when(released, F.col("_first_seen")).alias("first_seen_date"),
        F.when(released, F.col("_still")).alias("still_in_theaters"),
        F.when(released, F.col("_revenue")).alias("revenue"),
        F.coalesce(F.col("_mult").cast("double"), rule_mult).alias("multiplier"),
        F.when(released, F.col("_scored")).alias("scored_revenue"),
        F.when(released, F.col("_better")).alias("better_pick"),
        F.when(released & (F.col("_better_score") != 0), F.col("_better_score")).alias("better_pick_scored_revenue"),
    )
