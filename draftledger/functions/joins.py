"""Join helpers for the shapes SQL expresses with subqueries and inequality joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from draftledger.session import materialize

# Buckets of picks that one task joins with their candidates, and the most buckets of a league: a candidate
# has a copy in each bucket it may serve, so this bounds what a row is shuffled.
BUCKETS_PER_TASK = 4
MOST_BUCKETS = 32
# Bucket used for rows whose order value is NULL in ``later_and_better``.
NULL_BUCKET = -(2 ** 62)


def not_in(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str,
           by: Sequence[str] = ("draft_id",)) -> DataFrame:
    """Rows of ``df`` where ``key NOT IN (lookup_key of the same league)``, with SQL's NULL rules.

    Per league: an empty (absent) list keeps every row, NULL keys included; a non-empty list
    drops NULL keys and listed keys; a list holding a NULL drops every row. Written as an
    anti join on (league, key) plus one flag row per league, so it runs for many leagues at
    once and never compares a row with a whole list.
    """
    by = list(by)
    values = lookup.select(*by, F.col(lookup_key).alias(key))
    listed = values.filter(F.col(key).isNotNull()).distinct()  # A8
    flags = (values.groupBy(*by)
             .agg(F.max(F.col(key).isNull()).alias("_ni_list_has_null")))
    kept = df.join(listed, on=by + [key], how="left_anti").join(flags, on=by, how="left")
    keep = (F.col("_ni_list_has_null").isNull()
            | (F.col(key).isNotNull() & ~F.col("_ni_list_has_null")))
    return kept.filter(keep).drop("_ni_list_has_null")


def in_flag(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str, name: str,
            by: Sequence[str] = ("draft_id",)) -> DataFrame:
    """Adds boolean ``name``: the key equals some ``lookup_key`` of the same league.

    ``x IN (subquery)`` used as a CASE condition: only a true match counts, NULLs on either
    side fall through to the ELSE branch. A left join to the distinct keys.
    """
    by = list(by)
    marks = (lookup.select(*by, F.col(lookup_key).alias(key))
             .filter(F.col(key).isNotNull()).distinct()
             .withColumn("_in_mark", F.lit(True)))
    return (df.join(marks, on=by + [key], how="left")
            .withColumn(name, F.col("_in_mark").isNotNull()).drop("_in_mark"))


def later_and_better(picks: DataFrame, cands: DataFrame, pick: str, score: str,
                     cand_pick: str, cand_score: str, by: Sequence[str] = ("draft_id",),
                     width: int = 128) -> DataFrame:
    """``picks LEFT JOIN cands ON cand_score > score AND (cand_pick > pick OR cand_pick IS NULL)``
    within each league.

    A plain inequality join would be a nested loop over a whole league in one task. Here
    each league's pick range is cut into ceil(picks / ``width``) buckets, ``MOST_BUCKETS`` at most; a candidate is
    copied into its own bucket and every earlier bucket of its league (a candidate without a
    pick number into all of them and into the NULL bucket), so the join runs on the equi-key
    (league, bucket) with the inequalities as a residual. Each pick sits in exactly one
    bucket, so every qualifying pair is produced once and unmatched picks get one NULL row,
    exactly as the left join. The rows shuffled are linear in the picks, however large a league is;
    a bucket of a big league holds more picks than ``width``. Work per (league, bucket) task is its picks against the
    candidates at or after that bucket, which the sort-merge join walks through row by row (its buffer spills); a big league spreads over many tasks.
    """
    by = list(by)
    # Per league: lo..hi pick range cut into nb = ceil(count / width) buckets, MOST_BUCKETS at most. The bucket is
    # non-decreasing in the pick number, so "later pick" never points to an earlier bucket,
    # and the number of buckets (hence each candidate's copies) is bounded however many or
    # sparse the pick numbers are.
    # The spans have one row per league. They are written once: their size is then known, so the
    # joins below broadcast them when they are small, and otherwise a hot league's rows can be
    # split, as both sides are exchanged for the join alone.
    span = materialize(picks.filter(F.col(pick).isNotNull()).groupBy(*by)
                       .agg(F.min(pick).cast("bigint").alias("_lb_lo"), F.max(pick).cast("bigint").alias("_lb_hi"),
                            F.count(pick).alias("_lb_n"))
                       .withColumn("_lb_nb", F.expr(f"least((_lb_n + {width} - 1) div {width}, {MOST_BUCKETS})")), "spans")

    def bucket_of(c: str) -> F.Column:
        return F.expr(f"((CAST({c} AS BIGINT) - _lb_lo) * _lb_nb) div (_lb_hi - _lb_lo + 1)")

    null_b = F.lit(NULL_BUCKET).cast("bigint")
    left = (picks.join(span, on=by, how="left")
            .withColumn("_lb_bucket", F.when(F.col(pick).isNull() | F.col("_lb_lo").isNull(), null_b)
                        .otherwise(bucket_of(pick)))
            .drop("_lb_lo", "_lb_hi", "_lb_n", "_lb_nb"))
    cbucket = bucket_of(cand_pick)
    all_buckets = F.sequence(F.lit(0).cast("bigint"), F.col("_lb_nb") - 1)
    null_only = F.array(null_b)
    reach = F.when(
        F.col(cand_pick).isNull() & F.col("_lb_lo").isNull(), null_only,
    ).when(
        F.col(cand_pick).isNull(), F.concat(null_only, all_buckets),
    ).when(
        cbucket >= 0, F.sequence(F.lit(0).cast("bigint"), F.least(cbucket, F.col("_lb_nb") - 1)),
    )
    right = (cands.join(span, on=by, how="left")
             .withColumn("_lb_bucket", F.explode_outer(reach))
             .drop("_lb_lo", "_lb_hi", "_lb_n", "_lb_nb")
             .filter(F.col("_lb_bucket").isNotNull()))
    # Both sides hash-partitioned on (league, bucket) with an explicit partition count: the
    # inputs are small but the output is quadratic, so AQE must not fold the join into a
    # few tasks; the sort-merge join reuses this partitioning (no further exchange). The
    # count follows the data: a task for every few buckets of all leagues together, one for each if they are large.
    buckets, n = span.agg(F.coalesce(F.sum("_lb_nb"), F.lit(0)), F.coalesce(F.sum("_lb_n"), F.lit(0))).first()
    parts = max(int(picks.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(buckets, -(-n // (width * BUCKETS_PER_TASK))))
    left = left.repartition(parts, *[F.col(c) for c in by], F.col("_lb_bucket"))
    right = right.repartition(parts, *[F.col(c) for c in by], F.col("_lb_bucket"))
    right = right.withColumnsRenamed({c: f"_lb_r_{c}" for c in by})
    cond = left["_lb_bucket"] == right["_lb_bucket"]
    for c in by:
        cond = cond & (left[c] == right[f"_lb_r_{c}"])
    cond = (cond & (right[cand_score] > left[score])
            & ((right[cand_pick] > left[pick]) | right[cand_pick].isNull()))
    out = left.join(right, cond, "left")
    return out.drop(left["_lb_bucket"]).drop(right["_lb_bucket"]).drop(*[f"_lb_r_{c}" for c in by])
