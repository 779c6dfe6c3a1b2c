"""Best and count of dominating items against brute force, and M3 / A3 against the pair table."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from draftledger.functions import dominance
from draftledger.functions.dominance import best_above, count_above, near, x_range
from draftledger.operators import alternatives
from draftledger.plans.catalog import QUERIES
from draftledger.plans.explain import plan_text
from pyspark.sql.readwriter import DataFrameWriter
from tests.fixtures import D, models

SF = "/root/testdata/sf0.001"


def _case(seed, n, groups, values):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        x = None if r.random() < 0.05 else r.randrange(-values, values)
        rows.append((f"g{min(r.randrange(groups), r.randrange(groups))}", i, x, float(r.randrange(values)), r.randrange(values),
                     f"o{r.randrange(4)}", r.randrange(values)))
    return rows


def _above(q, c):
    return (q[0] == c[0] and q[5] != c[5] and (c[2] is None or (q[2] is not None and c[2] > q[2])) and c[3] > q[3])


@pytest.mark.parametrize("seed,n,groups,values,partitions,bits", [
    (1, 400, 3, 9, 8, 0), (2, 500, 2, 1000, 8, 0), (3, 600, 1, 70, 3, 4), (4, 60, 6, 2, 2, 2), (5, 400, 2, 1000, 8, 6), (6, 300, 2, 500, 8, 20)])
def test_against_brute_force(spark, monkeypatch, seed, n, groups, values, partitions, bits):
    rows = _case(seed, n, groups, values)
    df = spark.createDataFrame(rows, "g string, qid int, x int, y double, z int, owner string, value int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several partitions in one node
    try:
        monkeypatch.setattr(dominance, "NEAR_BITS", bits)
        of = x_range(df, df, "g")
        near_ = near(df, df, "g", of).collect()
        best = {r["qid"]: r["value"] for r in best_above(df, df, "g", of).collect()} if of.far else {}
        count = Counter({r["qid"]: r["n"] for r in count_above(df, df, "g", of).collect()} if of.far else {})
        for p in near_:
            best[p["qid"]] = min(p["i_value"], best.get(p["qid"], p["i_value"]))
            count[p["qid"]] += p["i_z"] >= p["z"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for q in rows:
        dominating = [c for c in rows if _above(q, c)]
        assert best.get(q[1]) == min((c[6] for c in dominating), default=None)
        assert count.get(q[1], 0) == sum(c[4] >= q[4] for c in dominating)


def _league(spark, seed, odd):
    r = random.Random(seed)
    snaps, draft, rules = [], [], []
    for lg in ("L1", "L2"):
        n = r.randrange(20, 60)
        for i in range(n):
            rev = r.choice([0, 5, 7, 1000, r.randrange(10_000), -50 if odd else 3])
            snaps.append((lg, f"t{i}", rev, rev, 0, D(1998, 12, 1 + i % 20), "1998"))
            pick = None if r.random() < 0.05 else (r.randrange(1, n) if odd else i + 1)
            draft.append((lg, r.randrange(1, 7), pick, f"d{r.randrange(3)}", f"t{i}"))
        if odd:
            draft += [(lg, 2, 3, "d1", "t5"), (lg, 2, 9, "d2", "t5"), (lg, 1, 4, "d1", "t6")]
        rules += [(lg, "2", "2.0", "round"), (lg, "3", "0.3333", "round"), (lg, "t4", "1.5", "movie")]
        if odd:
            rules += [(lg, "4", "0", "round"), (lg, "5", "-1.5", "round"), (lg, "6", "2", "round"), (lg, "6", "0.5", "round"),
                      (lg, "t7", "-1", "movie"), (lg, "t8", "NaN", "movie"), (lg, "1", "1e200", "round")]
    return models(spark, snaps, draft, rules)


def _same(got, want):
    def key(df):
        return sorted(repr(tuple(r)) for r in df.collect())
    assert key(got) == key(want.select(*got.columns))


@pytest.mark.parametrize("seed,odd,bits", [(1, False, 2), (2, True, 2), (3, True, 10)])
def test_alternatives_equal_the_pair_table(spark, monkeypatch, seed, odd, bits):
    monkeypatch.setattr(dominance, "NEAR_BITS", bits)
    m = _league(spark, seed, odd)
    eligible = alternatives._eligible(m.pairs)
    _same(m.best_alternative, alternatives.best_alternative(eligible))
    want = eligible.groupBy("draft_id", "title").agg(F.countDistinct("better_pick_title").alias("number_of_better_picks"),
                                                     F.max("missed_revenue").alias("max_better_pick_revenue"))
    _same(m.better_pick_stats, want)
    assert m._alternatives.beaten().count() == want.count()


def test_the_far_alternatives_of_m3_a3_and_o3_are_found_once(spark, monkeypatch):
    monkeypatch.setattr(dominance, "NEAR_BITS", 2)
    calls, original = [], alternatives.best_above
    monkeypatch.setattr(alternatives, "best_above", lambda *a: calls.append(1) or original(*a))
    m = _league(spark, 1, False)
    for df in (m.best_alternative, m.better_pick_stats, m.row_budget):
        assert df.count()
    assert len(calls) == 1


def test_least_revenue(spark):
    r = random.Random(5)
    cases = [(f, s) for f in (1.0, 0.1, 1 / 3, 2.5, 1e-9, 1e9) for s in (0.0, 1.0, -7.0, 123456789.0, r.random() * 1e9, float(r.randrange(10 ** 9)))]
    df = spark.createDataFrame(cases, "f double, s double").withColumn("r", alternatives.least_revenue(F.col("f"), F.col("s")))
    for x in df.collect():
        if abs(x["r"]) < alternatives.EXACT:
            assert x["f"] * float(x["r"]) > x["s"] and not x["f"] * float(x["r"] - 1) > x["s"]


@pytest.mark.parametrize("key", ["w8_better_pick_final", "a3_better_pick_stats", "w4_base_query", "a2_scoreboard", "w7_worst_picks",
                                 "j12_draftee_dashboard", "o3_row_budget"])
def test_no_plan_meets_pairs(spark, key, monkeypatch):
    seen, original = [], DataFrameWriter.parquet

    def spy(self, path, *args, **kw):
        seen.append(plan_text(self._df))
        return original(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    last = QUERIES[key](spark, SF)
    texts = [*seen, plan_text(last)]
    assert not any("_lb_bucket" in t for t in texts)


def test_a_block_with_many_rows_of_one_number_is_not_joined(spark, monkeypatch):
    monkeypatch.setattr(dominance, "NEAR_ROWS", 50)
    df = spark.createDataFrame([("g", 7 if i < 90 else i) for i in range(100)], "g string, x int")
    assert x_range(df, df, "g").near == 0
    assert x_range(df.where("x > 20"), df.where("x > 20"), "g").near == dominance.NEAR_BITS
