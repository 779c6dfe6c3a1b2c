"""M2 as a refresh writes it: every pair, as one bit.

The pair table has a row for each pick and each later title that would have been better, so it is quadratic in a
league's picks; written out, a pair costs a title and two doubles. Here it is three tables: the picks, the candidates,
dealt to blocks of ``1 << BLOCK_BITS`` by their pick number, and for each pick and block the set of the candidates that
pair with it, a bit for each. The bits of a block follow the candidates' scores, so a set is mostly a run: a set of few runs is
written as these, any other as words of 64 bits. ``pairs`` gives back M2's rows.

Blocks of picks meet blocks of candidates in one task, ``1 << TILE_BITS`` of each, as columns of numbers; blocks in which no
candidate is later are not met. Each of the three conditions (scored more, is later, would have earned more) holds for the last ones
of a block's candidates in an order of their own, so a pick's set is the intersection of three that are looked up (``_last``). What a task
holds does not depend on the size of a league.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from draftledger.functions.dominance import TASK_ROWS, _places
from draftledger.functions.windows import row_number_within
from draftledger.operators import alternatives
from draftledger.session import materialize

# ``met`` runs on executors, which need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The tables that M2 is written as.
PICKS, CANDIDATES, SETS = TABLES = ("better_pick_int_picks", "better_pick_int_candidates", "better_pick_int_sets")
#: Bits of the number of rows of a block, and of the number of blocks of a tile; words that are held at a time.
BLOCK_BITS, TILE_BITS, AT_ONCE = 13, 2, 1 << 21
#: Numbers above every pick number: that of a pick without one, and of a candidate without one.
NO_PICK, NO_CANDIDATE = 2 ** 62, 2 ** 62 + 1


def _in_blocks(df: DataFrame, pick: str) -> DataFrame:
    return row_number_within(df, ["draft_id"], [F.col(pick).asc_nulls_last()], "place").withColumn(
        "block", F.shiftright(F.col("place") - 1, BLOCK_BITS).cast("int"))


def picks(scored: DataFrame, round_mult: DataFrame) -> DataFrame:
    """The picks of M2, numbered in each league by pick number."""
    return _in_blocks(alternatives._picks(scored, round_mult).drop("round"), "overall_pick")


def candidates(scored: DataFrame) -> DataFrame:
    """The candidates of M2 with their block and their bit in it."""
    by_score = Window.partitionBy("draft_id", "block").orderBy("_c_score", "place")
    return _in_blocks(alternatives._candidates(scored), "_c_pick").withColumn("bit", F.row_number().over(by_score) - 1).drop("place")


def _values(column: pa.ChunkedArray, null) -> np.ndarray:
    return column.fill_null(null).to_numpy()


def _last(order: np.ndarray) -> np.ndarray:
    """For t = 0, 1, ..., n the set of ``order[t:]``, in words of 64 bits of which the very last is never set."""
    n = len(order)
    sets = np.zeros((n + 1, n // 64 + 1), np.uint64)
    sets[np.arange(n), order // 64] = np.left_shift(np.uint64(1), (order % 64).astype(np.uint64))
    return np.bitwise_or.accumulate(sets[::-1], axis=0)[::-1]


def _first_missed(factor: np.ndarray, score: np.ndarray, revenue: np.ndarray) -> np.ndarray:
    """Per pick the first of the revenues, in which more and more are missed, that is: by bisection, as the arithmetic has it."""
    low, high = np.zeros(len(factor), np.int64), np.full(len(factor), len(revenue))
    while (left := np.flatnonzero(low < high)).size:
        mid = (low[left] + high[left]) // 2
        missed = ~(factor[left] * revenue[mid] - score[left] <= 0)  # NaN is above zero, as in Spark
        high[left], low[left] = np.where(missed, mid, high[left]), np.where(missed, low[left], mid + 1)
    return low


class _Block:
    """A block of candidates, in order of their bits."""

    def __init__(self, c: pa.Table):
        self.score, self.no_score = _values(c["score"], 0.0), c["score"].is_null().to_numpy()
        self.pick, self.revenue, self.unknown = _values(c["pick"], NO_CANDIDATE), _values(c["revenue"], 0.0), c["revenue"].is_null().to_numpy()
        self.by_pick = np.argsort(self.pick, kind="stable")
        self.later = _last(self.by_pick)
        self._earned: dict[bool, tuple[np.ndarray, np.ndarray]] = {}

    def more(self, p_score: np.ndarray, p_null: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sets by score, and which of them is each pick's."""
        p_rank, c_rank = _places(p_score, self.score)
        c_rank = np.where(self.no_score, -1, c_rank)
        order = np.argsort(c_rank, kind="stable")
        at = np.searchsorted(c_rank[order], p_rank, side="right")
        return _last(order), np.where(p_null, len(order), at)

    def earned(self, down: bool) -> tuple[np.ndarray, np.ndarray]:
        """The known revenues, upwards or downwards, and the sets by revenue; what is unknown is in all of them."""
        if down not in self._earned:
            order = np.lexsort((-self.revenue if down else self.revenue, self.unknown))
            self._earned[down] = self.revenue[order[:len(order) - int(self.unknown.sum())]], _last(order)
        return self._earned[down]


def _sets(p: pa.Table, c: _Block) -> tuple[np.ndarray, np.ndarray]:
    """Per pick of ``p``: whether any candidate of ``c`` is later and scored more, and the set of those that also
    would have earned more (or nobody knows), in words of 64 bits."""
    p_score, p_pick, factor = _values(p["score"], 0.0), _values(p["pick"], NO_PICK), p["factor"].to_numpy()
    more, at_score = c.more(p_score, p["score"].is_null().to_numpy())
    at_pick = np.searchsorted(c.pick[c.by_pick], p_pick, side="right")
    any_, words = np.zeros(len(p), bool), np.zeros((len(p), more.shape[1]), np.uint64)
    with np.errstate(all="ignore"):
        for down in (False, True):  # a negative factor turns the order of the revenues round
            own = np.flatnonzero((factor < 0) == down)
            for rows in np.array_split(own, max(1, len(own) * more.shape[1] // AT_ONCE)) if len(own) else ():
                revenue, earned = c.earned(down)
                met = more[at_score[rows]] & c.later[at_pick[rows]]
                any_[rows] = met.any(axis=1)
                words[rows] = met & earned[_first_missed(factor[rows], p_score[rows], revenue)]
    return any_, words


def _runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which sets are few runs, the number of these, and all their starts and stops one after the other. The last bit of a set is never set, so every run stops."""
    before = np.zeros_like(words)
    before[:, 1:] = words[:, :-1] >> np.uint64(63)
    edges = words ^ (words << np.uint64(1) | before)
    n = np.bitwise_count(edges).sum(axis=1, dtype=np.int64)
    few = n <= words.shape[1] + 1  # hardly ever longer than half of the words
    edges = edges[few]
    row, word = np.nonzero(edges)
    one, bit = np.nonzero(np.unpackbits(edges[row, word].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return few, n[few] // 2, (64 * word[one] + bit).astype(np.int32)


def _lists(of: pa.Array, lengths: np.ndarray, valid: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Lists of ``lengths`` for the rows that are ``valid``, null for the others."""
    ends = np.zeros(len(valid) + 1, np.int64)
    ends[1:][valid] = lengths
    ends = ends.cumsum().astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), of, type=kind, mask=pa.array(~valid))


def _tiles(df: DataFrame, block: str, low_or_high, n: str) -> DataFrame:
    tile = F.shiftright(block, TILE_BITS).alias("p_tile" if block == "p_block" else "tile")
    return df.groupBy("draft_id", tile).agg(low_or_high, F.count(F.lit(1)).alias(n))


def sets(picks: DataFrame, candidates: DataFrame) -> DataFrame:
    """Of the written picks and candidates: one row (draft_id, place, block, words, runs) for every pick and block in which
    a candidate is later and scored more. ``runs`` is null where ``words`` are given, and these where the runs are."""
    spark = picks.sparkSession
    score = F.col("_p_score").cast("double").alias("score")
    p = picks.select("draft_id", F.col("block").alias("p_block"), "place", F.col("overall_pick").cast("bigint").alias("pick"), score,
                     F.coalesce("multiplier", F.lit(1.0)).alias("factor"))
    c = candidates.select("draft_id", "block", "bit", F.col("_c_pick").cast("bigint").alias("pick"), F.col("_c_score").cast("double").alias("score"),
                          F.col("_c_rev").cast("double").alias("revenue"))
    low = _tiles(p, "p_block", F.min(F.coalesce("pick", F.lit(NO_PICK))).alias("low"), "p_n")
    high = _tiles(c, "block", F.max(F.coalesce("pick", F.lit(NO_CANDIDATE))).alias("high"), "c_n")
    tiles = materialize(low.join(high, "draft_id").where("high > low").select("draft_id", "p_tile", "tile", (F.col("p_n") + F.col("c_n")).alias("n")), "tiles")
    # few rows make many pairs: the tasks are counted by tiles, not by the size of the input
    n_tiles, n = tiles.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(n_tiles, -(-n // TASK_ROWS)))
    tiles, keys = tiles.drop("n"), ["draft_id", "p_tile", "tile"]
    p = p.withColumn("p_tile", F.shiftright("p_block", TILE_BITS)).join(tiles, ["draft_id", "p_tile"]).repartition(parts, *keys)
    c = c.withColumn("tile", F.shiftright("block", TILE_BITS)).join(tiles, ["draft_id", "tile"]).repartition(parts, *keys)
    schema = p.select("draft_id", "place", F.lit(0).alias("block"), F.lit(None).cast("array<bigint>").alias("words"),
                      F.lit(None).cast("array<struct<start:int,stop:int>>").alias("runs")).schema
    run = pa.struct([("start", pa.int32()), ("stop", pa.int32())])

    def blocks_of(t: pa.Table, block: str, order: str) -> list[tuple[int, pa.Table]]:
        t = t.combine_chunks().sort_by([(block, "ascending"), (order, "ascending")])
        numbers, starts = np.unique(t[block].to_numpy(), return_index=True)
        return [(int(k), t.slice(a, b - a)) for k, a, b in zip(numbers, starts, [*starts[1:], len(t)])]

    def met(p_: pa.Table, c_: pa.Table) -> pa.Table:
        found, p_blocks = [], blocks_of(p_, "p_block", "place")
        for number, of in blocks_of(c_, "block", "bit"):
            c_block = _Block(of)
            for _, of_picks in p_blocks:
                if c_block.pick.max() <= _values(of_picks["pick"], NO_PICK).min():
                    continue
                any_, words = _sets(of_picks, c_block)
                hit = np.flatnonzero(any_)
                few, n_runs, edges = _runs(words := words[hit])
                many = words[~few]
                found.append(pa.Table.from_arrays([
                    *(of_picks[k].take(hit) for k in ("draft_id", "place")), pa.array(np.full(len(hit), number, np.int32)),
                    _lists(pa.array(many.reshape(-1).view(np.int64)), np.full(len(many), many.shape[1]), ~few, pa.list_(pa.int64())),
                    _lists(pa.StructArray.from_arrays([pa.array(edges[::2]), pa.array(edges[1::2])], fields=list(run)), n_runs, few, pa.list_(run)),
                ], names=schema.names))
        if not found:
            return pa.Table.from_arrays([p_["draft_id"].slice(0, 0), p_["place"].slice(0, 0), pa.array([], pa.int32()), pa.array([], pa.list_(pa.int64())),
                                         pa.array([], pa.list_(run))], names=schema.names)
        return pa.concat_tables(found).combine_chunks()

    return p.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInArrow(met, schema)


def pairs(picks: DataFrame, candidates: DataFrame, sets: DataFrame) -> DataFrame:
    """M2's rows from the three tables."""
    at = ["draft_id", "place", "block"]
    words = sets.select(*at, F.posexplode("words").alias("at", "word")).where("word <> 0")
    found = words.select(*at, (F.explode(F.expr("filter(sequence(0, 63), k -> getbit(word, k) = 1)")).alias("k")), "at").select(
        *at, (64 * F.col("at") + F.col("k")).alias("bit"))
    if "runs" in sets.columns:  # a root that was published before has words only
        found = found.unionByName(sets.select(*at, F.inline("runs")).select(*at, F.explode(F.expr("sequence(start, stop - 1)")).alias("bit")))
    picks, met = picks.drop("block"), sets.select("draft_id", "place").distinct()
    better = found.join(candidates, ["draft_id", "block", "bit"]).drop("block", "bit")
    alone = picks.join(met, ["draft_id", "place"], "left_anti")  # one row without an alternative
    return alternatives.pair_rows(picks.join(better, ["draft_id", "place"]).unionByName(alone, allowMissingColumns=True))
