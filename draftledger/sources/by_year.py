"""A snapshot history with a folder for each release year and an index of first days.

What belongs to a season (F1, W2, A7, J14) is one year's folder. The first day of a title (W1) is over all years, so the
year must not be pushed below it; it comes from the index, which has a row for each title and batch of days
instead of one for each day. Days are added in batches, in any order: an index row is the batch's first
day, and readers take the least.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from draftledger.operators import titles
from draftledger.params import Season
from draftledger.sources import schemas as S


def add(snap: DataFrame, root: str) -> None:
    """Adds cleaned or raw snapshots. The index goes first: a batch that is lost in between and added again
    changes nothing there."""
    keys = [c for c in ("draft_id", "title") if c in snap.columns]
    snap.groupBy(*keys).agg(F.min("loaded_date").alias("first_seen_date")).write.mode("append").parquet(f"{root}/first_seen")
    snap.hint("rebalance", "release_year").write.mode("append").partitionBy("release_year").parquet(f"{root}/days")


def days(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(S.SNAPSHOT).parquet(f"{root}/days").select(*S.SNAPSHOT_COLUMNS)


def first_seen(spark: SparkSession, root: str) -> DataFrame:
    """The first day of every title over the whole history."""
    index = spark.read.parquet(f"{root}/first_seen")
    return index.groupBy("draft_id", "title").agg(F.min("first_seen_date").alias("first_seen_date"))


def season_latest(snap: DataFrame, seen: DataFrame, season: Season) -> DataFrame:
    """F1 + W2 + W1: of the season's titles the newest in-season snapshot and the first day. ``snap``: the (cleaned)
    days; only the season's folder of them is read."""
    own = snap.where(F.col("release_year") == season.year_text)
    newest = titles.newest_rows(own, titles.KEYS, 1).select(*titles.KEYS, "_snapshot.*")
    on = newest["draft_id"].eqNullSafe(seen["draft_id"]) & newest["title"].eqNullSafe(seen["title"])
    return newest.join(seen, on).select(
        newest["draft_id"], newest["title"], *titles.MONEY, "loaded_date", "first_seen_date")
