"""Display-ready tables (K2, K3, P18, P19), the row budget of the pick tables (O3) and the
rows that fit it (O2). Nothing is collected: display frames are written per league."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from draftledger.sources.readers import read_model

# Fixed display headings of the dashboard tables.
RELEASED_HEADINGS = ["Rank", "Title", "Drafted By", "Revenue", "Scored Revenue", "Round Drafted",
                     "Overall Pick", "Multiplier", "Domestic Revenue", "Domestic Revenue %",
                     "Foreign Revenue", "Foreign Revenue %", "Better Pick", "Better Pick Scored Revenue",
                     "First Seen Date", "Still In Theaters"]
SCOREBOARD_HEADINGS = ["Name", "Scored Revenue", "# Released", "# Optimal Picks", "% Optimal Picks",
                       "Unadjusted Revenue"]
WORST_HEADINGS = ["Rank", "Title", "Drafted By", "Overall Pick", "Number of Better Picks", "Missed Revenue"]
BEST_HEADINGS = ["Rank", "Title", "Drafted By", "Overall Pick", "Positions Gained", "Actual Revenue"]
PICKS_HEADINGS = ["Round", "Overall Pick", "Movie", "First Seen Date", "Still In Theaters", "Revenue",
                  "Multiplier", "Scored Revenue", "Better Pick", "Better Pick Scored Revenue"]

# Fixed values of the dashboard sheet, in rows.
ROWS_BEFORE_STANDINGS = 5
ROWS_AFTER_STANDINGS = 2
ROWS_KEPT_FREE = 3
LEAST_ROWS = 2
ROWS_BETWEEN = 2


def released_movies(base_query: DataFrame) -> DataFrame:
    """K2 + P19 + S7: the released table under display headings; a zero alternative score is
    shown blank (NULL), NaN/Infinity as NULL."""
    cols = [c for c in base_query.columns if c != "draft_id"]
    shown = base_query.select("draft_id", *cols).withColumn(
        "better_pick_scored_revenue",
        F.when(F.col("better_pick_scored_revenue") == 0, F.lit(None).cast("double"))
         .otherwise(F.col("better_pick_scored_revenue")))
    return read_model(shown, ["draft_id"] + RELEASED_HEADINGS)


def draftee_tabs(dashboard: DataFrame) -> DataFrame:
    """K3 + P18 + S7: each drafter's picks under display headings. Numbers keep their type and
    value; a missing text is blank, a missing (or NaN, infinite) number NULL, which a sheet
    shows as an empty cell. Written in order of (draft_id, draftee_name): one job, no loop."""
    blank = {c: F.coalesce(c, F.lit("")) for c in ("movie", "first_seen_date", "still_in_theaters", "better_pick")}
    shown = dashboard.withColumns(blank).select(
        "draft_id", "draftee_name", "round", "overall_pick", "movie", "first_seen_date", "still_in_theaters", "revenue",
        "multiplier", "scored_revenue", "better_pick", "better_pick_scored_revenue")
    return read_model(shown, ["draft_id", "draftee_name"] + PICKS_HEADINGS)


def drafter_scoreboards(board: DataFrame) -> DataFrame:
    """K3: the one-row scoreboard on each drafter's tab, under its five headings."""
    shown = board.select("draft_id", "drafted_by_name", "scored_revenue", "num_released",
                         "correctly_drafted_pick_count", "correct_pick_pct", "unadjusted_revenue")
    return read_model(shown, ["draft_id", "draftee_name"] + SCOREBOARD_HEADINGS[1:])


def row_budget(leagues: DataFrame, board: DataFrame, released: DataFrame, worst: DataFrame,
               best: DataFrame) -> DataFrame:
    """O3: per league, how many worst and best picks fit beside the released table.

    Only the lengths of the tables count, so their rows need no rank: one aggregate over the
    rows of all four, each marked with its table. The output names are fixed.
    """
    lengths = ["scoreboard_length", "released_length", "worst_length", "best_length"]
    marked = leagues.select("draft_id", F.lit(-1).alias("t"))
    for i, df in enumerate([board, released, worst, best]):
        marked = marked.unionByName(df.select("draft_id", F.lit(i).alias("t")))
    n = marked.groupBy("draft_id").agg(
        F.count_if(F.col("t") == -1).alias("_known"),
        *[F.count_if(F.col("t") == i).alias(name) for i, name in enumerate(lengths)]).filter("_known > 0")
    free = F.col("released_length") - F.col("scoreboard_length") - ROWS_KEPT_FREE
    two = (free >= 2 * LEAST_ROWS + ROWS_BETWEEN) & (F.col("worst_length") > 1) & (F.col("best_length") > 1)
    n = n.withColumns({
        "available_height": free,
        "worst_picks_row_num": F.col("scoreboard_length") + ROWS_BEFORE_STANDINGS + ROWS_AFTER_STANDINGS,
        "add_both_picks_tables": two,
        "_shared": free - LEAST_ROWS - ROWS_BETWEEN})
    none = F.lit(0).cast("bigint")
    n = n.withColumn("worst_picks_height", F.when(
        F.col("add_both_picks_tables"), F.least(F.floor(F.col("_shared") / 2).cast("bigint"), F.col("worst_length"))).when(
        (F.col("available_height") > 0) & (F.col("worst_length") > 1), F.least("available_height", "worst_length")).otherwise(none))
    below = F.col("worst_picks_row_num") + 1 + F.col("worst_picks_height") + ROWS_BETWEEN
    return n.select(
        "draft_id", *lengths, "available_height", "worst_picks_row_num", "add_both_picks_tables", "worst_picks_height",
        F.when(F.col("add_both_picks_tables"), below).alias("best_picks_row_num"),
        F.when(F.col("add_both_picks_tables"), F.least(F.col("_shared") - F.col("worst_picks_height"), F.col("best_length")))
         .otherwise(none).alias("best_picks_height"),
        ((F.col("worst_picks_height") > 0) & (F.col("worst_length") > 1)).alias("add_picks_table"))


def budgeted_picks(layout: DataFrame, worst: DataFrame, best: DataFrame) -> DataFrame:
    """O2: the worst/best pick rows that fit the budget (first n by rank, n per league)."""
    lay = layout.select("draft_id", "add_picks_table", "add_both_picks_tables",
                        "worst_picks_height", "best_picks_height")
    w = (worst.join(lay, "draft_id")
         .filter(F.col("add_picks_table") & (F.col("rank") <= F.col("worst_picks_height")))
         .select("draft_id", F.lit("worst").alias("table_name"), "rank", "title", "drafted_by", "overall_pick",
                 F.col("number_of_better_picks").cast("bigint").alias("metric"),
                 F.col("missed_revenue").cast("double").alias("amount")))
    b = (best.join(lay, "draft_id")
         .filter(F.col("add_picks_table") & F.col("add_both_picks_tables")
                 & (F.col("rank") <= F.col("best_picks_height")))
         .select("draft_id", F.lit("best").alias("table_name"), "rank", "title", "drafted_by", "overall_pick",
                 F.col("positions_gained").cast("bigint").alias("metric"),
                 F.col("actual_revenue").cast("double").alias("amount")))
    return w.unionByName(b)


def dashboard_tables(board: DataFrame, base_query: DataFrame, layout: DataFrame, worst: DataFrame,
                     best: DataFrame) -> dict[str, DataFrame]:
    """K2: the four dashboard tables under their display headings: standings, released
    titles, and the worst and best picks cut to the row budget (O2, O3)."""
    standings = read_model(board.select("draft_id", "drafted_by_name", "scored_revenue", "num_released",
                                        "correctly_drafted_pick_count", "correct_pick_pct",
                                        "unadjusted_revenue"), ["draft_id"] + SCOREBOARD_HEADINGS)
    shown = budgeted_picks(layout, worst, best)

    def picks(table: str, headings: list[str]) -> DataFrame:
        rows = shown.filter(F.col("table_name") == table).select(
            "draft_id", "rank", "title", "drafted_by", "overall_pick", "metric", "amount")
        return read_model(rows, ["draft_id"] + headings)

    return {"dashboard_standings": standings, "dashboard_released": released_movies(base_query),
            "dashboard_worst_picks": picks("worst", WORST_HEADINGS),
            "dashboard_best_picks": picks("best", BEST_HEADINGS)}


def write_league_table(name: str, df: DataFrame, root: str, version: str, buckets: int = 1) -> str:
    """K1/K2/K3: one table of one version. Leagues are dealt to ``buckets`` folders by a hash and lie sorted in
    them (a league's drafters too, and the blocks of its pairs), so a league is one folder and a few row groups however many leagues there are.
    The number of files follows the size: rows of a bucket come together, and a large bucket is split. Returns the
    table's folder."""
    path = f"{root}/{name}/version={version}"
    order = [c for c in ("bucket", "draft_id", "draftee_name", "block", "place", "bit") if c == "bucket" or c in df.columns]
    placed = df.withColumn("bucket", bucket_of(F.col("draft_id"), buckets)).hint("rebalance", "bucket")
    placed.sortWithinPartitions(*order).write.partitionBy("bucket").parquet(path)
    return path


def bucket_of(league: Column, buckets: int) -> Column:
    """The folder of a league."""
    return F.pmod(F.xxhash64(league.cast("string")), F.lit(buckets)).cast("int")
