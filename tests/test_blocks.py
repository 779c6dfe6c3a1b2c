"""Rows of one block of numbers meet as columns of numbers in one task, not pair by pair."""

import random
import time

import numpy as np
import pytest
from pyspark.sql.readwriter import DataFrameWriter

from draftledger.functions import dominance
from draftledger.functions.dominance import in_blocks, x_range
from draftledger.plans.catalog import QUERIES
from draftledger.plans.explain import plan_text

SF = "/root/testdata/sf0.001"


def test_a_block_against_brute_force(spark):
    r = random.Random(7)
    rows = [(f"g{r.randrange(2)}", i, r.choice([None, *range(40)]), r.choice([float("nan"), float("inf"), *map(float, range(9))]),
             r.randrange(9), r.choice([None, "a", "b"]), r.randrange(50)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, qid int, x int, y double, z int, owner string, value int")
    found = {c: {f["qid"]: f for f in in_blocks(df, df, "g", x_range(df, df, "g"), c).collect()} for c in (False, True)}

    def y(row):  # NaN is above all
        return (row[3] != row[3], 0 if row[3] != row[3] else row[3])

    for q in rows:
        above = [c for c in rows if None not in (q[2], c[2], q[5], c[5]) and c[0] == q[0] and c[2] > q[2] and y(c) > y(q) and c[5] != q[5]]
        assert (q[1] in found[False]) == (q[1] in found[True]) == bool(above)
        if above:
            best = min(c[6] for c in above)
            assert found[False][q[1]]["value"] == found[True][q[1]]["value"] == best
            assert found[True][q[1]]["n"] == sum(c[4] >= q[4] for c in above)


@pytest.mark.parametrize("key", ["w4_base_query", "w7_worst_picks", "k2_worst_picks"])
def test_no_plan_joins_the_rows_of_a_block(spark, key, monkeypatch):
    seen, original = [], DataFrameWriter.parquet

    def spy(self, path, *args, **kw):
        seen.append(plan_text(self._df))
        return original(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    texts = [plan_text(QUERIES[key](spark, SF)), *seen]
    assert not any("_i_block" in t for t in texts) and any("FlatMapGroupsInArrow" in t for t in texts)


def test_counting_a_block_compares_few_of_its_pairs():
    r = np.random.default_rng(3)
    for n, values, owners in ((0, 1, 1), (1, 3, 1), (700, 9, 3), (3000, 50, 40), (3000, 10 ** 6, 900)):
        q, i = (np.stack([r.integers(0, v, n) for v in (values, values, owners, values)]) for _ in range(2))
        a, b = q[:, :, None], i[:, None, :]
        want = ((b[0] > a[0]) & (b[1] > a[1]) & (b[2] != a[2]) & (b[3] >= a[3])).sum(axis=1)
        assert (dominance._count_in_block(q, i) == want).all()


def test_the_time_to_count_a_block_is_not_quadratic():
    r = np.random.default_rng(4)

    def seconds(n):
        rows = np.stack([r.permutation(n), r.permutation(n), np.arange(n) % 4, r.permutation(n)]).astype(np.int32)
        at = time.process_time()
        dominance._count_in_block(rows, rows)
        return time.process_time() - at

    assert min(seconds(60_000) for _ in range(3)) < 10 * min(seconds(15_000) for _ in range(3))  # quadratic: 16
