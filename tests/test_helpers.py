"""Window and join helpers against brute force on small random data."""

import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from draftledger.functions.columns import asc, desc
from draftledger.functions.joins import in_flag, later_and_better, not_in
from draftledger.functions.windows import first_per_key, row_number_within, top_n_per_key


def _rows(n, seed, hot=True):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        league = "hot" if hot and rnd.random() < 0.4 else f"L{rnd.randint(0, 5)}"
        score = None if rnd.random() < 0.05 else float(rnd.randint(0, 50))
        out.append((league, f"T{i:04d}", score))
    return out


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_row_number_within_equals_window(spark, parts):
    df = spark.createDataFrame(_rows(600, parts), "league string, title string, score double")
    order = [desc("score"), asc("title")]
    got = row_number_within(df, ["league"], order, "rk", partitions=parts)
    ref = df.withColumn("rk2", F.row_number().over(Window.partitionBy("league").orderBy(*order)))
    j = got.join(ref, ["league", "title"])
    assert j.count() == 600
    assert j.filter("rk <> rk2").count() == 0
    assert dict(got.groupBy("league").agg(F.max("rk")).collect()) == dict(df.groupBy("league").count().collect())


def test_top_n_and_first(spark):
    df = spark.createDataFrame(_rows(300, 7), "league string, title string, score double")
    top = top_n_per_key(df, ["league"], [desc("score"), asc("title")], 3, "n").toPandas()
    pdf = pd.DataFrame(_rows(300, 7), columns=["league", "title", "score"])
    pdf = pdf.sort_values(["league", "score", "title"], ascending=[True, False, True], na_position="last")
    exp = pdf.groupby("league").head(3)
    assert sorted(top.title) == sorted(exp.title)
    first = first_per_key(df, ["league"], [desc("score"), asc("title")]).toPandas()
    assert sorted(first.title) == sorted(pdf.groupby("league").head(1).title)


def _brute_pairs(picks, cands):
    out = []
    for (lg, p, s, pid) in picks:
        hit = False
        for (clg, c, cs, cid) in cands:
            if lg != clg or s is None or cs is None:
                continue
            if cs > s and (c is None or (p is not None and c > p)):
                out.append((pid, cid))
                hit = True
        if not hit:
            out.append((pid, None))
    return sorted(out, key=lambda t: (t[0], t[1] or ""))


@pytest.mark.parametrize("width", [1, 4, 64])
def test_later_and_better_equals_theta_join(spark, width):
    rnd = random.Random(width)
    picks = []
    for lg in ["A", "B", "C"]:
        n = 40 if lg == "A" else 9
        for i in range(1, n + 1):
            pick = None if rnd.random() < 0.08 else i
            score = None if rnd.random() < 0.05 else float(rnd.randint(0, 20))
            picks.append((lg, pick, score, f"{lg}{i}"))
    p = spark.createDataFrame(picks, "draft_id string, pick int, score double, pid string")
    c = p.select("draft_id", F.col("pick").alias("cpick"), F.col("score").alias("cscore"), F.col("pid").alias("cid"))
    got = later_and_better(p, c, "pick", "score", "cpick", "cscore", width=width).select("pid", "cid").collect()
    got = sorted([(r.pid, r.cid) for r in got], key=lambda t: (t[0], t[1] or ""))
    assert got == _brute_pairs(picks, picks)


def test_not_in_null_rules(spark):
    rows = spark.createDataFrame([("A", "x"), ("A", None), ("A", "y"), ("B", "x"), ("B", None), ("C", "x"), ("C", "z")],
                                 "draft_id string, title string")
    # A lists x; B lists nothing; C lists a NULL (NOT IN is never true there)
    lookup = spark.createDataFrame([("A", "x"), ("C", None), ("C", "q")], "draft_id string, movie string")
    got = sorted(((r.draft_id, r.title) for r in not_in(rows, "title", lookup, "movie").collect()),
                 key=lambda t: (t[0], t[1] or ""))
    assert got == [("A", "y"), ("B", None), ("B", "x")]
    rows.createOrReplaceTempView("r")
    lookup.createOrReplaceTempView("l")
    sql = spark.sql("SELECT * FROM r WHERE title NOT IN (SELECT movie FROM l WHERE l.draft_id = r.draft_id)")
    assert sorted(((r.draft_id, r.title) for r in sql.collect()), key=lambda t: (t[0], t[1] or "")) == got


def test_in_flag_only_true_matches(spark):
    rows = spark.createDataFrame([("A", "x"), ("A", None), ("A", "y")], "draft_id string, title string")
    lookup = spark.createDataFrame([("A", "x"), ("A", None)], "draft_id string, title string")
    got = {(r.title, r.f) for r in in_flag(rows, "title", lookup, "title", "f").collect()}
    assert got == {("x", True), (None, False), ("y", False)}


def test_row_number_within_after_aqe_coalescing(spark):
    """No explicit count: AQE merges neighbouring range partitions; numbering stays exact."""
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.createDataFrame(_rows(3000, 11), "league string, title string, score double")
        order = [desc("score"), asc("title")]
        got = row_number_within(df, ["league"], order, "rk")
        ref = df.withColumn("rk2", F.row_number().over(Window.partitionBy("league").orderBy(*order)))
        j = got.join(ref, ["league", "title"])
        assert j.count() == 3000
        assert j.filter("rk <> rk2").count() == 0
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_later_and_better_sparse_pick_numbers(spark):
    """Pick numbers far apart: buckets follow the league's pick count, not the number range."""
    rnd = random.Random(5)
    picks = []
    for i, pick in enumerate([1, 7, 1000, 10 ** 6, 2 ** 30, 2 ** 31 - 1, None, 42, 43]):
        picks.append(("S", pick, float(rnd.randint(0, 9)), f"S{i}"))
    p = spark.createDataFrame(picks, "draft_id string, pick int, score double, pid string")
    c = p.select("draft_id", F.col("pick").alias("cpick"), F.col("score").alias("cscore"), F.col("pid").alias("cid"))
    for width in (1, 2, 128):
        got = later_and_better(p, c, "pick", "score", "cpick", "cscore", width=width).select("pid", "cid").collect()
        got = sorted([(r.pid, r.cid) for r in got], key=lambda t: (t[0], t[1] or ""))
        assert got == _brute_pairs(picks, picks)
