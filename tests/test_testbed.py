"""The league tables derived from the driver's tables cover every line, and follow their inputs."""

from pyspark.sql import functions as F

from draftledger.params import DEFAULT_SEASON
from draftledger.plans.catalog import QUERIES
from draftledger.sources import testbed

SF = "/root/testdata/sf0.001"


def test_every_line_is_in_the_history(spark):
    snaps = QUERIES["s1_daily_scan"](spark, SF)
    newest = snaps.groupBy("title").agg(F.max(F.col("domestic_rev") + F.col("foreign_rev")).alias("cents"))
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").select(F.floor(F.col("l_extendedprice") * 100).alias("cents"))
    assert newest.agg(F.sum("cents")).first()[0] == lines.agg(F.sum("cents")).first()[0]


def test_activity_is_mixed(spark):
    got = {r[0] for r in QUERIES["w3_still_in_theaters"](spark, SF).select("still_in_theaters").distinct().collect()}
    assert got == {True, False}


def test_other_inputs_at_the_same_path_give_another_answer(spark, tmp_path):
    for t in ("part", "supplier"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    before = testbed.load(spark, str(tmp_path), DEFAULT_SEASON)["snapshots"].count()
    lines.limit(100).write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
    after = testbed.load(spark, str(tmp_path), DEFAULT_SEASON)["snapshots"].count()
    assert after <= 100 < before


def test_lines_are_not_shuffled_before_they_are_summed_by_day(spark):
    """By (part, supplier, day) nearly every line is a group of its own."""
    plan = testbed.snapshots(spark, SF, by_league=True)._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert shuffled and not any("l_suppkey" in line for line in shuffled)
    # what is brought to the leagues has no texts yet
    brought = [line for line in plan.split("\n") if "REBALANCE" in line]
    assert len(brought) == 1 and plan.index("AS title") < plan.index(brought[0])


def test_lines_without_a_supplier_or_price_and_repeated_suppliers(spark, tmp_path):
    day = "timestamp'2001-03-05'"
    spark.sql(f"select * from values (1L, 1L, 1.5D, {day}), (1L, 2L, 2D, {day}), (1L, 9L, 4D, {day}), (1L, null, 8D, {day}), (2L, 1L, null, {day}),"
              f" (3L, 2L, null, {day}), (3L, 2L, 1D, {day}) as t(l_partkey, l_suppkey, l_extendedprice, l_shipdate)").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("select * from values (1L, 5L), (2L, 1L), (2L, null) as t(s_suppkey, s_nationkey)").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.sql("select * from values (1L, 'B1'), (2L, 'B1'), (3L, 'B2') as t(p_partkey, p_brand)").write.parquet(f"{tmp_path}/part.parquet")
    got = {r["title"]: (r["domestic_rev"], r["foreign_rev"], r["revenue"]) for r in testbed.snapshots(spark, str(tmp_path)).collect()}
    assert got == {"P1": (150, 400, 550), "P2": (None, 0, None), "P3": (0, 200, 200)}
