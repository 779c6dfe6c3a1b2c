"""Cleaning layer: P1-P4 projections and casts, F2 rule split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from draftledger.functions.columns import lenient_int


def clean_snapshots(raw: DataFrame) -> DataFrame:
    """P2 + P3: strict BIGINT money (a bad value fails the job under ANSI), and a zero total
    repaired from its parts. A NULL total stays NULL."""
    rev = F.col("revenue").cast("bigint")
    dom = F.col("domestic_rev").cast("bigint")
    fgn = F.col("foreign_rev").cast("bigint")
    return raw.select(
        *[c for c in ("draft_id", "title") if c in raw.columns],
        F.when(rev == 0, dom + fgn).otherwise(rev).alias("revenue"),
        dom.alias("domestic_rev"),
        fgn.alias("foreign_rev"),
        "loaded_date", "release_year", "published_timestamp_utc",
    )


def clean_draft(draft: DataFrame) -> DataFrame:
    """Draft picks in the cleaned column order."""
    return draft.select("draft_id", "movie", "name", "overall_pick", "round")


def clean_manual_adds(raw: DataFrame) -> DataFrame:
    """Tolerant casts ('1.6' -> 2, junk -> NULL) and the release date as first-seen date."""
    return raw.select(
        "draft_id",
        F.col("title").try_cast("string").alias("title"),
        lenient_int("revenue").alias("revenue"),
        lenient_int("domestic_rev").alias("domestic_rev"),
        lenient_int("foreign_rev").alias("foreign_rev"),
        F.col("release_date").try_cast("date").alias("first_seen_date"),
    )


def movie_overrides(rules: DataFrame) -> DataFrame:
    """per-title multipliers."""
    return rules.filter(F.col("type") == "movie").select(
        "draft_id", F.col("value").alias("movie"),
        F.col("multiplier").try_cast("double").alias("multiplier"))


def round_overrides(rules: DataFrame) -> DataFrame:
    """per-round multipliers; the round stays text as in the source."""
    return rules.filter(F.col("type").try_cast("string") == "round").select(
        "draft_id", F.col("value").try_cast("string").alias("round"),
        F.col("multiplier").try_cast("double").alias("multiplier"))


def exclusions(rules: DataFrame) -> DataFrame:
    """titles excluded from the season."""
    return rules.filter(F.col("type").try_cast("string") == "exclusion").select(
        "draft_id", F.col("value").try_cast("string").alias("movie"))


def round_multipliers(round_ov: DataFrame) -> DataFrame:
    """Round overrides keyed by an INT round for the join with picks (text round that is
    not a number matches nothing)."""
    return round_ov.select("draft_id", lenient_int("round").alias("round"),
                           F.col("multiplier").alias("round_multiplier"))
