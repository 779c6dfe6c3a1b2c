"""The snapshot history as state that days are merged into.

What the models need of a history is small: for each title its first day and its newest snapshots of every
release year, for each league and year the newest day and the least revenue on it, and the newest
publish time. All three merge: the state of two sets of snapshots follows from the states of the sets,
in any order and grouping. So a day's snapshots are summarised alone and merged into the state, and
the history is not read again.

Corrections and late days: snapshots only ever add up. A day that arrives late takes its place by its
date; a second snapshot of a day counts beside the first, the larger amounts first, exactly as when both
are read from the whole history. A snapshot that is to be taken back needs the state made anew from the files
(``summarize`` over the history).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from draftledger.operators import titles

#: Newest snapshots kept for each title and release year: W3 compares the newest with the one before; its
#: intended form looks seven back.
DEPTH = 8


@dataclass(frozen=True)
class History:
    """``titles``: (keys, first_seen_date, _newest); ``floors``: (league, release_year, newest_date,
    min_revenue); ``published``: (league, data_through). Without leagues if the history is shared."""

    titles: DataFrame
    floors: DataFrame
    published: DataFrame

    @property
    def shared(self) -> bool:
        return "draft_id" not in self.titles.columns

    def tables(self) -> dict[str, DataFrame]:
        return {"titles": self.titles, "floors": self.floors, "published": self.published}


def _league(df: DataFrame) -> list[str]:
    return [c for c in ("draft_id",) if c in df.columns]


def title_state(snap: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Per title its first day (W1) and its newest snapshots of each release year. Both come together in one
    aggregate over a few rows for each title, not in a join; over a history bucketed by title
    (``sources.bucketed``) nothing is shuffled."""
    keys = [*_league(snap), "title"]
    seen = snap.groupBy(*keys).agg(F.min("loaded_date").alias("first_seen_date"))
    newest = titles.newest_rows(snap, keys, depth)
    return seen.unionByName(newest, allowMissingColumns=True).groupBy(*keys).agg(
        F.min("first_seen_date").alias("first_seen_date"), F.sort_array(F.collect_list("_snapshot"), asc=False).alias("_newest"))


def floor_state(snap: DataFrame) -> DataFrame:
    """Per league and release year the newest day and the least revenue on it."""
    return _floors(snap.select(*_league(snap), "release_year", F.col("loaded_date").alias("newest_date"), F.col("revenue").alias("min_revenue")))


def _floors(rows: DataFrame) -> DataFrame:
    by = [*_league(rows), "release_year"]
    by_day = rows.groupBy(*by, "newest_date").agg(F.min("min_revenue").alias("_least"))
    return by_day.groupBy(*by).agg(F.max("newest_date").alias("newest_date"), F.max_by("_least", "newest_date").alias("min_revenue"))


def published_state(snap: DataFrame) -> DataFrame:
    return snap.groupBy(*_league(snap)).agg(F.max("published_timestamp_utc").alias("data_through"))


def summarize(snap: DataFrame, depth: int = DEPTH) -> History:
    """The state of some snapshots (cleaned)."""
    return History(title_state(snap, depth), floor_state(snap), published_state(snap))


def _newest_of(ordered: Column, depth: int) -> Column:
    """Of snapshots in an array, newest first, the newest ``depth`` of each year, newest first."""
    years = F.array_distinct(F.transform(ordered, lambda x: x["release_year"]))
    kept = F.transform(years, lambda y: F.slice(F.filter(ordered, lambda x: x["release_year"].eqNullSafe(y)), 1, depth))
    return F.sort_array(F.flatten(kept), asc=False)


def merge(a: History, b: History, depth: int = DEPTH) -> History:
    """The state of both. A title brings together two short arrays, one from each side."""
    keys = [*_league(a.titles), "title"]
    both = a.titles.unionByName(b.titles).groupBy(*keys).agg(
        F.min("first_seen_date").alias("first_seen_date"), F.flatten(F.collect_list("_newest")).alias("_newest"))
    # a column of its own: within one expression the array would be sorted again for every year
    both = both.withColumn("_newest", F.sort_array("_newest", asc=False))
    through = a.published.unionByName(b.published)
    return History(
        both.select(*keys, "first_seen_date", _newest_of(F.col("_newest"), depth).alias("_newest")),
        _floors(a.floors.unionByName(b.floors)),
        through.groupBy(*_league(through)).agg(F.max("data_through").alias("data_through")))


def only(history: History, cut) -> History:
    """The state of some leagues; a shared history stays whole."""
    return history if history.shared else History(cut(history.titles), cut(history.floors), cut(history.published))


def years_of(history: History, seen: DataFrame) -> DataFrame:
    """The release years that the titles of ``seen`` have snapshots of: a new day of a title moves its
    first day and its activity in all of them."""
    named = history.titles.join(seen.select("title").distinct(), "title", "left_semi")
    years = named.select(F.explode(F.array_distinct("_newest.release_year")).alias("release_year"))  # no other field is read
    return years.where("release_year is not null").distinct()
