"""Better alternatives: M2 pairs (J7), M3 best alternative per pick (W8), A3 per-title stats.

M2 lists pairs, so it is quadratic in a league's picks. M3 and A3 need one alternative and a
number for each pick; they come from dominance (a later pick that scored more and would have earned
more) and meet no pairs. Titles that such an order cannot tell apart (``unordered_titles``) are met pair by pair.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from draftledger.functions.columns import asc, desc
from draftledger.functions.dominance import best_above, count_above, in_blocks, x_range
from draftledger.functions.joins import later_and_better
from draftledger.functions.windows import first_per_key
from draftledger.session import materialize

PAIR_COLUMNS = ["draft_id", "title", "overall_pick", "better_pick_title", "original_pick_revenue",
                "multiplier", "better_pick_scored_revenue", "missed_revenue",
                "better_pick_drafted_by_someone_else", "better_pick_drafted_by_no_one"]
TITLE = ["draft_id", "title"]
#: Revenues below this are exact in a double, and multipliers between the bounds neither
#: overflow nor vanish, so that more revenue is always a larger hypothetical score.
EXACT = 2 ** 52
LEAST_FACTOR, MOST_FACTOR = 1e-100, 1e100


def _drafted(scored: DataFrame) -> DataFrame:
    return scored.filter(F.col("drafted_by").isNotNull())


def _picks(scored: DataFrame, round_mult: DataFrame) -> DataFrame:
    """Drafted titles with the multiplier of their round."""
    return (_drafted(scored).select("draft_id", "title", "overall_pick", "round",
                                    F.col("revenue").alias("original_pick_revenue"),
                                    F.col("scored_revenue").alias("_p_score"),
                                    F.col("drafted_by").alias("_p_by"))
            .join(round_mult.withColumnRenamed("round_multiplier", "multiplier"), ["draft_id", "round"], "left"))


def _candidates(scored: DataFrame) -> DataFrame:
    return _drafted(scored).select("draft_id",
                                   F.col("title").alias("better_pick_title"),
                                   F.col("overall_pick").alias("_c_pick"),
                                   F.col("revenue").alias("_c_rev"),
                                   F.col("scored_revenue").alias("_c_score"),
                                   F.col("drafted_by").alias("_c_by"))


def _pairs(picks: DataFrame, cands: DataFrame, width: int) -> DataFrame:
    return pair_rows(later_and_better(picks, cands, "overall_pick", "_p_score", "_c_pick", "_c_score", width=width))


def pair_rows(pairs: DataFrame) -> DataFrame:
    """M2's columns and filter over picks that have met their candidates."""
    # Hypothetical score and missed revenue, double and unrounded
    hypo = F.coalesce(F.col("multiplier"), F.lit(1.0)) * F.col("_c_rev").cast("double")
    missed = hypo - F.col("_p_score").cast("double")
    out = pairs.select(
        "draft_id", "title", "overall_pick", "better_pick_title", "original_pick_revenue", "multiplier",
        hypo.alias("better_pick_scored_revenue"),
        missed.alias("missed_revenue"),
        # Pair flags (3-valued, as in SQL)
        ((F.col("_p_by") != F.col("_c_by")) & F.col("_c_by").isNotNull()).alias("better_pick_drafted_by_someone_else"),
        F.col("_c_by").isNull().alias("better_pick_drafted_by_no_one"),
    )
    # F4, after the projection (the SQL filters on a SELECT alias)
    return out.filter((F.col("missed_revenue") > 0) | F.col("missed_revenue").isNull())


def better_pick_pairs(scored: DataFrame, round_mult: DataFrame, width: int = 128) -> DataFrame:
    """M2: every drafted title paired with each later-drafted (or unnumbered) title that
    scored more; picks without one keep a single row of NULLs.

    Hypothetical score = (round multiplier of the original pick, missing -> 1) x the other
    title's unadjusted revenue, in double, unrounded; missed revenue = that minus the pick's
    own score; only pairs with a positive (or unknown) miss are kept.
    """
    return _pairs(_picks(scored, round_mult), _candidates(scored), width)


def _eligible(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("better_pick_drafted_by_someone_else")
                        & ~F.col("better_pick_drafted_by_no_one"))


def unordered_titles(picks: DataFrame) -> DataFrame:
    """Titles that dominance cannot serve: in a league's picks more than once (drafted twice, or a
    doubled override), a multiplier that is not positive or far out, revenue beyond what a double holds."""
    factor = F.coalesce(F.col("multiplier"), F.lit(1.0))
    odd = (~factor.between(LEAST_FACTOR, MOST_FACTOR) | F.isnan(factor)
           | ~F.col("original_pick_revenue").between(-EXACT + 1, EXACT - 1))
    return picks.groupBy(*TITLE).agg(F.count(F.lit(1)).alias("n"), F.max(odd).alias("odd")).filter("n > 1 or odd").select(*TITLE)


class Alternatives:
    """M3 and A3 of all leagues from the written M1."""

    def __init__(self, scored: DataFrame, round_mult: DataFrame, width: int = 128):
        self.picks, self.cands = _picks(scored, round_mult), _candidates(scored)
        unordered = unordered_titles(self.picks)
        self.by_pair = None
        ordered_picks, ordered_cands = self.picks, self.cands
        if not unordered.isEmpty():
            unordered = materialize(unordered, "unordered")
            as_cand = unordered.withColumnRenamed("title", "better_pick_title")
            ordered_picks = self.picks.join(unordered, TITLE, "left_anti")
            ordered_cands = self.cands.join(as_cand, ["draft_id", "better_pick_title"], "left_anti")
            one = _pairs(self.picks.join(unordered, TITLE, "left_semi"), self.cands, width)
            two = _pairs(ordered_picks, self.cands.join(as_cand, ["draft_id", "better_pick_title"], "left_semi"), width)
            self.by_pair = _eligible(one).unionByName(_eligible(two)).select(
                *TITLE, "overall_pick", "better_pick_title", "better_pick_scored_revenue", "missed_revenue")
        score = F.col("_p_score").cast("double")
        self.queries = ordered_picks.filter(score.isNotNull() & ~F.isnan(score)).select(
            "draft_id", F.struct("title", "overall_pick", F.coalesce("multiplier", F.lit(1.0)).alias("factor"), score.alias("score")).alias("qid"),
            F.col("overall_pick").alias("x"), (score + 0.0).alias("y"), F.col("_p_by").alias("owner"))
        score = F.col("_c_score").cast("double")
        self.items = ordered_cands.filter(score.isNotNull()).select(
            "draft_id", F.col("_c_pick").alias("x"), (score + 0.0).alias("y"), F.col("_c_by").alias("owner"), F.col("_c_rev").alias("z"),
            F.struct((-F.col("_c_rev")).alias("less"), F.col("better_pick_title").alias("title")).alias("value"))
        self.range = x_range(self.queries, self.items, "draft_id")

    @cached_property
    def _far(self) -> DataFrame:
        """Each query's best item of another block; written once, as M3, A3 and O3 all read it."""
        return materialize(best_above(self.queries, self.items, "draft_id", self.range), "far")

    def _beaten(self, found: DataFrame) -> DataFrame:
        """Of (qid, value) the picks whose best alternative would have earned more. More revenue is a larger
        miss, so if the best one misses nothing no other does."""
        hypo = F.col("qid.factor") * (-F.col("value.less")).cast("double")
        rows = found.select("*", "qid.title", "qid.overall_pick", F.col("value.title").alias("better_pick_title"),
                            hypo.alias("better_pick_scored_revenue"), (hypo - F.col("qid.score")).alias("missed_revenue"))
        return rows.filter(F.col("missed_revenue") > 0)

    def _found(self) -> DataFrame:
        """Each dominated query's best item."""
        found = in_blocks(self.queries, self.items, "draft_id", self.range)
        if self.range.far:
            found = found.unionByName(self._far).groupBy("draft_id", "qid").agg(F.min("value").alias("value"))
        return found

    def best_rows(self) -> DataFrame:
        """One row for every pick that a later one beats: its best alternative and what it missed."""
        cols = [*TITLE, "overall_pick", "better_pick_title", "better_pick_scored_revenue", "missed_revenue"]
        rows = self._beaten(self._found()).select(*cols)
        return rows if self.by_pair is None else rows.unionByName(self.by_pair.select(*cols))

    def beaten(self) -> DataFrame:
        """The titles that A3 has a row for, without their numbers (all that O3 needs)."""
        return self.best_rows().select(*TITLE).distinct()

    def stats(self) -> DataFrame:
        """A3: per beaten title the number of distinct alternatives and the largest miss."""
        q = self.queries.withColumn("z", least_revenue(F.col("qid.factor"), F.col("qid.score")))
        found = in_blocks(q, self.items, "draft_id", self.range, count=True)
        if self.range.far:
            best = self._far.withColumn("n", F.lit(0).cast("long"))
            n = count_above(q, self.items, "draft_id", self.range)
            found = (found.unionByName(best).unionByName(n, allowMissingColumns=True).groupBy("draft_id", "qid")
                     .agg(F.min("value").alias("value"), F.sum("n").alias("n")))
        rows = self._beaten(found).select(*TITLE, F.col("n").alias("number_of_better_picks"),
                                          F.col("missed_revenue").alias("max_better_pick_revenue"))
        if self.by_pair is not None:  # an ordered title may have alternatives of both kinds, of different titles
            more = self.by_pair.groupBy(*TITLE).agg(F.countDistinct("better_pick_title").alias("number_of_better_picks"),
                                                    F.max("missed_revenue").alias("max_better_pick_revenue"))
            rows = rows.unionByName(more).groupBy(*TITLE).agg(
                F.sum("number_of_better_picks").alias("number_of_better_picks"), F.max("max_better_pick_revenue").alias("max_better_pick_revenue"))
        return rows


def least_revenue(factor: Column, score: Column) -> Column:
    """The least whole revenue r with factor * r > score in doubles, for a positive factor; EXACT if none
    below it."""
    near = F.floor(F.least(F.greatest(score / factor, F.lit(float(-EXACT))), F.lit(float(EXACT)))).cast("bigint")
    some = F.transform(F.sequence(F.lit(-3), F.lit(3)), lambda k: near + k)
    first = F.array_min(F.filter(some, lambda r: factor * r.cast("double") > score))
    return F.coalesce(first, F.lit(EXACT).cast("bigint"))


def best_alternative(best_rows: DataFrame) -> DataFrame:
    """M3 (F5 + W8): per pick number the alternative with the highest hypothetical score
    (ties: title ascending)."""
    known = best_rows.filter(F.col("better_pick_title").isNotNull() & F.col("overall_pick").isNotNull())
    top = first_per_key(known, ["draft_id", "overall_pick"],
                        [desc("better_pick_scored_revenue"), asc("better_pick_title")])
    return top.select("draft_id", "overall_pick", "better_pick_title", "better_pick_scored_revenue")
