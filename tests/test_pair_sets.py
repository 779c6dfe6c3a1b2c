"""M2 as a refresh writes it: a bit for each pair, from which its rows come back."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.readwriter import DataFrameWriter

from draftledger.operators import pair_sets
from draftledger.plans.explain import plan_text
from draftledger.plans.refresh import compact, league_filter, read_table, refresh
from tests.fixtures import SEASON
from tests.test_dominance import _league


def _rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def _inputs(m):
    return {"snapshots": m.raw_snapshots, "draft_text": m.draft_text, "rules_text": m.rules_text, "manual_adds_text": m.manual_adds_text}


@pytest.mark.parametrize("seed,odd,bits", [(1, False, 2), (2, True, 3), (3, True, 4), (4, True, 13)])
def test_the_rows_come_back(spark, monkeypatch, seed, odd, bits):
    monkeypatch.setattr(pair_sets, "BLOCK_BITS", bits)
    monkeypatch.setattr(pair_sets, "AT_ONCE", 50)
    m = _league(spark, seed, odd)
    sides = pair_sets.picks(m.scored_table, m.round_multipliers).cache(), pair_sets.candidates(m.scored_table).cache()
    got = pair_sets.pairs(*sides, pair_sets.sets(*sides))
    assert got.columns == m.pairs.columns and [f.dataType for f in got.schema] == [f.dataType for f in m.pairs.schema]
    assert _rows(got) == _rows(m.pairs) != []


def test_nulls_nans_and_equal_rows(spark):
    nan = float("nan")
    rows = [(lg, f"t{i % 7}", s, p, r, 1 + i % 2, b, i) for i, (lg, s, p, r, b) in enumerate(
        (lg, s, p, r, b) for lg in ("L", None) for s in (None, nan, 0.0, -0.0, 5.0) for p in (None, 1, 2) for r in (None, -3, 9) for b in ("a", "b"))]
    scored = spark.createDataFrame(rows, "draft_id string, title string, scored_revenue float, overall_pick int, revenue long, round int, drafted_by string, i int").drop("i")
    rounds = spark.createDataFrame([("L", 1, 2.0), ("L", 1, nan), ("L", 2, -1.0)], "draft_id string, round int, round_multiplier double")
    from draftledger.operators.alternatives import better_pick_pairs
    sides = pair_sets.picks(scored, rounds).cache(), pair_sets.candidates(scored).cache()
    assert _rows(pair_sets.pairs(*sides, pair_sets.sets(*sides))) == _rows(better_pick_pairs(scored, rounds))


def test_a_refresh_writes_no_row_for_a_pair(spark, monkeypatch, tmp_path):
    plans, original = [], DataFrameWriter.parquet

    def spy(self, path, *args, **kw):
        plans.append(plan_text(self._df))
        return original(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    m, out = _league(spark, 1, False), str(tmp_path / "o")
    refresh(spark, _inputs(m), out, SEASON)
    assert plans and not any("missed_revenue" in p and "_lb_bucket" in p for p in plans)
    assert _rows(read_table(spark, out, "better_pick_int")) == _rows(m.pairs)
    refresh(spark, _inputs(_league(spark, 2, False)), out, SEASON, leagues=league_filter(spark, "L2"))
    want = _rows(m.pairs.where("draft_id = 'L1'")) + _rows(_league(spark, 2, False).pairs.where("draft_id = 'L2'"))
    assert _rows(read_table(spark, out, "better_pick_int")) == sorted(want)
    compact(spark, out)
    assert _rows(read_table(spark, out, "better_pick_int")) == sorted(want)
    assert _rows(read_table(spark, out, "better_pick_int", ["L1"])) == _rows(m.pairs.where("draft_id = 'L1'"))


def test_the_sets_of_a_block_without_meeting_its_pairs():
    """Odd factors, scores and revenues; 8,192 picks and candidates (before, all 67 million were compared)."""
    rng, nan, inf = np.random.default_rng(5), float("nan"), float("inf")

    def rows(n, odd):
        def column(usual, strange):
            return pa.array(np.where(rng.random(n) < odd, rng.choice(strange, n), usual).astype(float))
        some = [rng.integers(0, 20 if odd else 10 ** 8, n) for _ in range(2)]
        null = [pa.array(rng.random(n) < odd / 2) for _ in range(3)]
        pick = pa.array(rng.integers(0, n, n))
        cols = {"score": column(some[0], [nan, inf, -inf, -0.0]), "revenue": column(some[1], [-3, 0, 2.0 ** 62]), "pick": pick}
        cols = {k: pa.compute.if_else(m, pa.scalar(None, c.type), c) for (k, c), m in zip(cols.items(), null)}
        return pa.table(cols | {"factor": column(rng.choice([1, 2, 0.5], n), [nan, inf, -inf, 0, -1.5, 1e308])})

    def beats(p, c):
        """A pair as M2 has it, value by value."""
        (s, pick, f), (t, cand, rev) = p, c
        if s is None or t is None or not (t > s or (t != t and s == s)) or not (cand is None or (pick is not None and cand > pick)):
            return None
        return rev is None or not f * rev - s <= 0

    for k, n in enumerate((1, 63, 64, 65, 130)):
        p, c = rows(70, 0.2 * (k % 2 + 1)), rows(n, 0.3)
        want = [[beats(a, b) for b in zip(*(c[x].to_pylist() for x in ("score", "pick", "revenue")))]
                for a in zip(*(p[x].to_pylist() for x in ("score", "pick", "factor")))]
        any_, words = pair_sets._sets(p, pair_sets._Block(c))
        bits = np.unpackbits(words.view(np.uint8), axis=1, bitorder="little")
        assert [any(v is not None for v in row) for row in want] == any_.tolist()
        assert bits[:, :n].astype(bool).tolist() == [[bool(v) for v in row] for row in want] and not bits[:, n:].any()
        few, n_runs, edges = pair_sets._runs(words)
        ends = iter(edges.reshape(-1, 2).tolist())
        for at, count in zip(np.flatnonzero(few), n_runs):
            assert [i for _ in range(count) for i in range(*next(ends))] == np.flatnonzero(bits[at]).tolist()
        assert next(ends, None) is None
    p, c = rows(8192, 0), rows(8192, 0)
    words = pair_sets._sets(p, pair_sets._Block(c.sort_by("score")))[1]
    assert words.shape == (8192, 129) and np.bitwise_count(words).sum() > 10 ** 6


def test_a_set_of_few_runs_is_written_as_these(spark, monkeypatch):
    """One league of 300 picks in blocks of 128, three of them to a tile: the later titles earn more and more, so all sets are one run."""
    monkeypatch.setattr(pair_sets, "BLOCK_BITS", 7)
    scored = spark.createDataFrame([("L", f"t{i}", float(i), i + 1, i, 1, "ab"[i % 2]) for i in range(300)],
                                   "draft_id string, title string, scored_revenue float, overall_pick int, revenue long, round int, drafted_by string")
    rounds = spark.createDataFrame([], "draft_id string, round int, round_multiplier double")
    sides = pair_sets.picks(scored, rounds).cache(), pair_sets.candidates(scored).cache()
    sets = pair_sets.sets(*sides).cache()
    assert sets.where("words is not null or size(runs) <> 1").count() == 0 and sets.count() == 127 + 255 + 299
    assert pair_sets.pairs(*sides, sets).where("better_pick_title is not null").count() == 300 * 299 // 2
    assert pair_sets.pairs(*sides, sets.drop("runs")).where("better_pick_title is not null").count() == 0  # as a root of before, of words only


def test_a_refresh_reads_the_titles_of_nobody_once(spark, monkeypatch, tmp_path):
    reads, original = [], DataFrameWriter.parquet

    def spy(self, path, *args, **kw):
        reads.append(any("/base_query_int/version=" in f for f in self._df.inputFiles()))
        return original(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    refresh(spark, _inputs(_league(spark, 1, False)), str(tmp_path / "o"), SEASON)
    assert sum(reads) == 1
