"""The model graph of one refresh, built lazily.

Each attribute is one model, defined on first use from the raw inputs; a query only plans
the models it reaches. ``snapshots`` etc. are raw inputs (from the testbed or from files).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from draftledger.operators import alternatives, checks, clean, history, present, standings, titles
from draftledger.params import DEFAULT_SEASON, Season
from draftledger.session import materialize
from draftledger.sources import readers, testbed


class Models:
    def __init__(self, spark: SparkSession, season: Season = DEFAULT_SEASON, *,
                 snapshots=None, draft_text=None, rules_text=None, manual_adds_text=None,
                 sf_dir: str | None = None, pair_bucket_width: int = 128,
                 materialize_shared: bool = True, league_years=None, history_state: history.History | None = None):
        self.spark = spark
        self.season = season
        self.sf_dir = sf_dir
        self.pair_bucket_width = pair_bucket_width
        self.materialize_shared = materialize_shared
        self.league_years = league_years  # (draft_id, year) per league; None: the season's year for all
        self.history_state = history_state  # the merged state of the history, in place of its snapshots
        self._given = {"raw_snapshots": snapshots, "draft_text": draft_text,
                       "rules_text": rules_text, "manual_adds_text": manual_adds_text}

    @classmethod
    def from_testbed(cls, spark: SparkSession, sf_dir: str, season: Season = DEFAULT_SEASON, **kw) -> "Models":
        """Models over the league tables derived from the driver's tables (materialised once)."""
        tables = testbed.load(spark, sf_dir, season)
        given = {"snapshots": tables["snapshots"], "draft_text": tables["draft_text"],
                 "rules_text": tables["rules_text"], "manual_adds_text": tables["manual_adds_text"]}
        given.update({k: v for k, v in kw.items() if k in given})
        rest = {k: v for k, v in kw.items() if k not in given}
        return cls(spark, season, sf_dir=sf_dir, **given, **rest)

    def _input(self, name, make):
        given = self._given.get(name)
        if given is not None:
            return given
        if self.sf_dir is None:
            raise ValueError(f"input {name} missing")
        return make()

    # raw inputs -----------------------------------------------------------------------
    @cached_property
    def raw_snapshots(self) -> DataFrame:
        return self._input("raw_snapshots", lambda: testbed.snapshots(self.spark, self.sf_dir))

    @cached_property
    def draft_text(self) -> DataFrame:
        return self._input("draft_text", lambda: testbed.draft_text(self.spark, self.sf_dir))

    @cached_property
    def rules_text(self) -> DataFrame:
        return self._input("rules_text", lambda: testbed.rules_text(self.spark, self.sf_dir))

    @cached_property
    def manual_adds_text(self) -> DataFrame:
        return self._input("manual_adds_text", lambda: testbed.manual_adds_text(self.spark, self.sf_dir, self.season))

    # sources ---------------------------------------------------------------------------
    @cached_property
    def draft(self) -> DataFrame:
        return readers.draft_from_text(self.draft_text)

    @cached_property
    def rules(self) -> DataFrame:
        return readers.rules_from_text(self.rules_text)

    @cached_property
    def manual_adds_raw(self) -> DataFrame:
        return readers.manual_adds_from_text(self.manual_adds_text)

    # cleaned ---------------------------------------------------------------------------
    @cached_property
    def snapshots(self) -> DataFrame:
        return clean.clean_snapshots(self.raw_snapshots)

    @cached_property
    def drafter(self) -> DataFrame:
        return clean.clean_draft(self.draft)

    @cached_property
    def manual_adds(self) -> DataFrame:
        return clean.clean_manual_adds(self.manual_adds_raw)

    @cached_property
    def movie_overrides(self) -> DataFrame:
        return clean.movie_overrides(self.rules)

    @cached_property
    def round_overrides(self) -> DataFrame:
        return clean.round_overrides(self.rules)

    @cached_property
    def exclusions(self) -> DataFrame:
        return clean.exclusions(self.rules)

    @cached_property
    def round_multipliers(self) -> DataFrame:
        return clean.round_multipliers(self.round_overrides)

    # title scoring (M1) ----------------------------------------------------------------
    @cached_property
    def state(self) -> DataFrame:
        known = self.history_state.titles if self.history_state else history.title_state(self.snapshots, 2)
        return titles.season_titles(known, self.season, self.league_years)

    @cached_property
    def floor(self) -> DataFrame:
        """A7, one row per league."""
        if self.history_state:
            return checks.season_floor(self.history_state.floors, self.season, self.league_years)
        return checks.newest_snapshot_floor(self.snapshots, self.season, self.league_years)

    @cached_property
    def published(self) -> DataFrame:
        return self.history_state.published if self.history_state else history.published_state(self.snapshots)

    @cached_property
    def latest(self) -> DataFrame:
        return titles.latest_snapshot(self.state, self.exclusions)

    @cached_property
    def activity(self) -> DataFrame:
        return titles.activity(self.snapshots, self.season)

    @cached_property
    def tracked(self) -> DataFrame:
        return titles.tracked_titles(self.latest, self.manual_adds)

    @cached_property
    def with_manual(self) -> DataFrame:
        return titles.with_manual_adds(self.tracked.drop("_act"), self.manual_adds)

    @cached_property
    def base_titles(self) -> DataFrame:
        return titles.dedupe_titles_split(self.tracked.drop("_act"), self.manual_adds)

    @cached_property
    def picks(self) -> DataFrame:
        return titles.pick_table(self.draft, self.round_multipliers)

    @cached_property
    def scored(self) -> DataFrame:
        return titles.score_titles(titles.titles_with_status(self.tracked, self.manual_adds), self.picks, self.movie_overrides)

    @cached_property
    def scored_table(self) -> DataFrame:
        """M1 written once: read by both sides of the pair join."""
        return materialize(self.scored, "base_query_int") if self.materialize_shared else self.scored

    # alternatives ----------------------------------------------------------------------
    @cached_property
    def pairs(self) -> DataFrame:
        return alternatives.better_pick_pairs(self.scored_table, self.round_multipliers, self.pair_bucket_width)

    @cached_property
    def _alternatives(self) -> alternatives.Alternatives:
        return alternatives.Alternatives(self.scored_table, self.round_multipliers, self.pair_bucket_width)

    @cached_property
    def best_rows(self) -> DataFrame:
        """Each beaten pick with its best alternative."""
        return self._alternatives.best_rows()

    @cached_property
    def best_alternative(self) -> DataFrame:
        """M3, one row per pick."""
        return alternatives.best_alternative(self.best_rows)

    @cached_property
    def better_pick_stats(self) -> DataFrame:
        """A3, one row per drafted title."""
        return self._alternatives.stats()

    # league tables ---------------------------------------------------------------------
    def _scored_for_rows(self) -> DataFrame:
        """M1 as it was written, if it was; else its plan."""
        return self.__dict__.get("scored_table", self.scored)

    @cached_property
    def released(self) -> DataFrame:
        return standings.released_rows(self._scored_for_rows(), self.season)

    @cached_property
    def ranked(self) -> DataFrame:
        return standings.ranked_rows(self.released)

    @cached_property
    def base_query(self) -> DataFrame:
        best = self.best_alternative
        return standings.released_picks(self.ranked, best)

    @cached_property
    def scoreboard(self) -> DataFrame:
        best = self.best_alternative
        return standings.scoreboard(standings.with_alternative(self.released, best))

    @cached_property
    def best_gains(self) -> DataFrame:
        return standings.best_gains(self.ranked)

    @cached_property
    def best_picks(self) -> DataFrame:
        return standings.best_picks(self.best_gains)

    @cached_property
    def worst_rows(self) -> DataFrame:
        stats = self.better_pick_stats
        return standings.worst_rows(self.released, stats)

    @cached_property
    def worst_picks(self) -> DataFrame:
        return standings.worst_picks(self.worst_rows)

    @cached_property
    def draftee_dashboard(self) -> DataFrame:
        best = self.best_alternative
        return standings.draftee_dashboard(self.draft, standings.with_alternative(self.released, best), self.round_overrides,
                                           self.movie_overrides)

    # checks and presentation -----------------------------------------------------------
    @cached_property
    def leagues(self) -> DataFrame:
        return self.draft.select("draft_id").distinct()

    @cached_property
    def league_done(self) -> DataFrame:
        return checks.league_done(self.released, self.leagues, self.season, self.league_years)

    @cached_property
    def row_budget(self) -> DataFrame:
        """O3 needs the lengths of the tables, so it reads their unranked rows."""
        worst = self.released.join(self._alternatives.beaten(), ["draft_id", "title"], "left_semi")
        names = self.released.select("draft_id", "drafted_by").distinct()
        return present.row_budget(self.leagues, names, self.released, worst, self.best_gains)

    def outputs(self) -> dict[str, DataFrame]:
        """The tables a refresh writes."""
        return {
            "base_query_int": self.scored,
            "better_pick_int": self.pairs,
            "better_pick_final": self.best_alternative,
            "base_query": self.base_query,
            "scoreboard": self.scoreboard,
            "best_picks": self.best_picks,
            "worst_picks": self.worst_picks,
            "draftee_dashboard": self.draftee_dashboard,
            **present.dashboard_tables(self.scoreboard, self.base_query, self.row_budget,
                                       self.worst_picks, self.best_picks),
            "draftee_tabs": present.draftee_tabs(self.draftee_dashboard),
            "drafter_scoreboard": present.drafter_scoreboards(checks.drafter_scoreboard(self.draft, self.scoreboard)),
            "row_budget": self.row_budget,
            "freshness": checks.freshness(self.published, self.league_done, self.season),
        }
