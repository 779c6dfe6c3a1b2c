"""A league holding most of the rows is spread over several tasks, not one."""

import random

from pyspark.sql import functions as F

from draftledger.functions import joins, windows
from draftledger.functions.columns import asc, desc
from draftledger.functions.joins import later_and_better


def _hot_rows():
    rnd = random.Random(3)
    rows = [("HOT", f"H{i}", i + 1, float(rnd.randint(0, 10 ** 6))) for i in range(2000)]
    rows += [(f"L{j}", f"L{j}T{i}", i + 1, float(rnd.randint(0, 10 ** 6))) for j in range(4) for i in range(50)]
    return rows


def test_rank_spreads_a_hot_league(spark, monkeypatch):
    df = spark.createDataFrame(_hot_rows(), "league string, title string, pick int, score double")
    written = {}
    original = windows.materialize

    def spy(frame, label):
        written["t"] = original(frame, label)
        return written["t"]

    monkeypatch.setattr(windows, "materialize", spy)
    ranked = windows.row_number_within(df, ["league"], [desc("score"), asc("title")], "rk", partitions=8)
    parts = written["t"].filter(F.col("league") == "HOT").select("_rw_part").distinct().count()
    assert parts >= 4
    got = ranked.filter(F.col("league") == "HOT").agg(F.min("rk"), F.max("rk"), F.countDistinct("rk")).first()
    assert tuple(got) == (1, 2000, 2000)


def test_theta_join_spreads_a_hot_league(spark):
    df = spark.createDataFrame(_hot_rows(), "draft_id string, title string, pick int, score double")
    cands = df.select("draft_id", F.col("title").alias("ctitle"), F.col("pick").alias("cpick"),
                      F.col("score").alias("cscore"))
    out = later_and_better(df, cands, "pick", "score", "cpick", "cscore", width=128)
    tasks = (out.filter(F.col("draft_id") == "HOT").select(F.spark_partition_id().alias("p"))
             .distinct().count())
    assert tasks >= 4


def test_copies_of_a_candidate_do_not_grow_with_the_league(spark, monkeypatch):
    """A candidate has a copy in each bucket before its own; a league of 16,000 picks had 125 of them."""
    n, written = 16_000, []
    df = spark.range(n).select(F.lit("L").alias("draft_id"), F.col("id").alias("pick"), (F.col("id") % 5).alias("score"))
    cands = df.where("pick % 100 = 0").select("draft_id", F.col("pick").alias("cpick"), F.lit(4).alias("cscore"))
    original = joins.materialize
    monkeypatch.setattr(joins, "materialize", lambda frame, label: written.append(original(frame, label)) or written[-1])
    out = later_and_better(df, cands, "pick", "score", "cpick", "cscore", width=128)
    assert written[0].agg(F.max("_lb_nb")).first()[0] == joins.MOST_BUCKETS
    later = [sum(100 * c > p for c in range(n // 100)) if p % 5 < 4 else 0 for p in range(n)]
    assert out.count() == sum(max(1, k) for k in later)
