"""Best and number of the items that dominate a query, without meeting them pair by pair.

A query (x, y) of a group asks about the group's items with a larger x and a larger y that belong to
another owner. ``best_above`` gives the best of them, ``count_above`` how many of them have a z that is at
least the query's.

An item and a query whose x differ part at exactly one digit: the first in which their numbers
differ. So both are put, level by level, into the node of the digits before it, the item where its digit is
larger than the query's. In a node the x is settled, and what is left is one order less:

* best: the node's rows in order of y, and a running best. The best item of *another* owner comes from the
  running best and a running best of the losers: whenever an item and the leader so far have different
  owners, the worse of the two is a loser. The best loser is always the best of the owners other than the
  leader's.
* count: the same once more for y (by place), then a running count in order of z. Items of the query's own
  owner are counted in a node of their own and taken off. Here too the lowest levels are left out: ``1 << NEAR_BITS`` places
  of a node are a cell, whose rows meet in one task.

A row has a copy per level, i.e. the logarithm of the number range; nothing is quadratic. The lowest levels are
left out: numbers that differ only there share a block of ``1 << NEAR_BITS`` numbers, whose rows meet in one task (``in_blocks``), as
columns of numbers (``_best_in_block``, ``_higher``). A node may be as
large as a group, so running values are made in two parts (``Layout``): one range shuffle, running values
inside each partition, and what the node's earlier partitions bring along.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from draftledger.functions.windows import row_number_within
from draftledger.session import materialize

# ``in_blocks`` runs on executors, which need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Level of the node for items without an x: they lie above every x.
OPEN = -1
#: Bits of x inside a block, and the rows that a block may have (more only if many share a number; then
#: there are levels down to the last bit and no block is joined).
NEAR_BITS, NEAR_ROWS = 16, 3 << 16
BLOCKS_PER_TASK = 4
#: Rows for which a task is worth its while, and the comparisons that are held at a time.
TASK_ROWS, AT_ONCE = 8192, 1 << 23


@dataclass(frozen=True)
class Range:
    """Over all groups: the least x, the bits of the range of x, whether an item has none, the bits of the
    number of rows of the largest group, the bits that are left to the blocks, the number of blocks, and of rows."""

    least: int
    bits: int
    open: bool
    tall: int
    near: int = 0
    blocks: int = 0
    rows: int = 0

    @property
    def far(self) -> bool:
        """Whether any two rows can meet outside a block."""
        return self.open or self.bits > self.near


def x_range(queries: DataFrame, items: DataFrame, group: str) -> Range:
    """One aggregate; a single row comes to the driver."""
    x = F.col("x").cast("bigint")
    both = queries.select(group, x.alias("x"), F.lit(0).alias("o")).unionByName(
        items.select(group, x.alias("x"), F.when(F.col("x").isNull(), 1).otherwise(0).alias("o")))
    # blocks are counted from zero here and from the least x later: two of these cover one of those
    by_block = both.groupBy(group, F.shiftright("x", NEAR_BITS).alias("_b")).agg(
        F.min("x").alias("a"), F.max("x").alias("b"), F.max("o").alias("o"), F.count(F.lit(1)).alias("n"), F.count("x").alias("m"))
    by = by_block.groupBy(group).agg(F.min("a").alias("a"), F.max("b").alias("b"), F.max("o").alias("o"), F.sum("n").alias("n"),
                                     F.max("m").alias("m"), F.count("a").alias("k"))
    a, b, o, n, m, k, rows = by.agg(F.min("a"), F.max("b"), F.max("o"), F.max("n"), F.max("m"), F.sum("k"), F.sum("n")).first()
    near = NEAR_BITS if (m or 0) <= NEAR_ROWS else 0
    return Range(a or 0, max(1, ((b or 0) - (a or 0)).bit_length()), bool(o), max(1, (n or 0).bit_length()), near, 2 * (k or 0), rows or 0)


class Layout:
    """Rows of one range shuffle by (keys, order), written once, so that every use sees the same
    partitions and places."""

    def __init__(self, df: DataFrame, by: Sequence[str], order: Sequence[Column]):
        self.by = list(by)
        keys = [F.col(c).asc_nulls_first() for c in self.by] + list(order)
        self.rows = materialize(
            df.repartitionByRange(*keys).sortWithinPartitions(*keys)
            .withColumn("_part", F.spark_partition_id()).withColumn("_pos", F.monotonically_increasing_id()), "layout")
        #: The earlier rows of the same keys in the same partition; the earlier partitions of the keys.
        self.local = Window.partitionBy(*self.by, "_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
        self.earlier = Window.partitionBy(*self.by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)

    def blocks(self, rows: DataFrame, **values: Column) -> DataFrame:
        return rows.groupBy(*self.by, "_part").agg(*[v.alias(n) for n, v in values.items()])

    def brought(self, rows: DataFrame, blocks: DataFrame) -> DataFrame:
        return rows.join(blocks, [*self.by, "_part"], "left")


def _nodes(number: Column, bits: int, width: int, keep, skip: int = 0) -> Column:
    """(level, node, digit) of ``number`` on every level above ``skip`` bits whose digit (of ``width`` bits) is kept."""
    every = F.array(*[F.struct(
        F.lit(b).alias("level"), F.shiftright(number, width * (b + 1)).alias("node"),
        F.shiftright(number, width * b).bitwiseAND(F.lit((1 << width) - 1)).cast("int").alias("digit"))
        for b in range(skip // width, -(-bits // width))])
    return F.filter(every, lambda s: keep(s["digit"])) if bits > skip else F.slice(_open(0), 1, 0)


def _open(digit: int) -> Column:
    return F.array(F.struct(F.lit(OPEN).alias("level"), F.lit(0).cast("bigint").alias("node"), F.lit(digit).alias("digit")))


def _with_x(df: DataFrame, of: Range, width: int, item: bool) -> DataFrame:
    """One row per node of x, its struct in ``nx``."""
    top = (1 << width) - 1
    some = _nodes(F.col("x").cast("bigint") - F.lit(of.least), of.bits, width, (lambda d: d > 0) if item else (lambda d: d < top), of.near)
    if item:  # an item without x stands above every query, in a node of its own
        found = F.when(F.col("x").isNull(), _open(1)).otherwise(some)
    elif of.open:  # a query without x sees only those
        found = F.when(F.col("x").isNull(), _open(0)).otherwise(F.concat(some, _open(0)))
    else:
        found = F.when(F.col("x").isNotNull(), some)
    return df.withColumn("nx", F.explode(found))


def near(queries: DataFrame, items: DataFrame, group: str, of: Range, also: Column | None = None, how: str = "inner") -> DataFrame:
    """Pairs of a query and an item of another owner that dominates it, of one block; the item's columns
    are ``i_``, pair by pair (``in_blocks`` without its arithmetic; for small blocks). ``also``: a further condition; ``how``: "left_semi" for the queries that have any. A block has at most ``NEAR_ROWS`` rows, so the pairs are linear in the rows."""
    block = F.shiftright(F.col("x").cast("bigint") - F.lit(of.least), of.near).alias("_block")
    parts = max(int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-of.blocks // BLOCKS_PER_TASK))
    # few rows make many pairs: the tasks are counted by blocks, not by the size of the input
    q = queries.where("x is not null").select("*", block).repartition(parts, group, "_block")
    i = items.where("x is not null").select("*", block)
    i = i.select(F.col("_block").alias("_i_block"), *[F.col(c).alias(f"i_{c}") for c in items.columns]).repartition(parts, f"i_{group}", "_i_block")
    above = ((q[group] == i[f"i_{group}"]) & (q["_block"] == i["_i_block"])
             & (F.col("i_x") > F.col("x")) & (F.col("i_y") > F.col("y")) & (F.col("i_owner") != F.col("owner")))
    return q.join(i, above if also is None else above & also, how).drop("_block", "_i_block", f"i_{group}")


def _places(of_queries: np.ndarray, of_items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in one order, as small numbers; NaN is above all, as in Spark."""
    order = np.unique(np.concatenate([of_queries, of_items]), return_inverse=True)[1].astype(np.int32)
    return order[:len(of_queries)], order[len(of_queries):]


def _best_in_block(q: np.ndarray, i: np.ndarray) -> np.ndarray:
    """``q``, ``i``: x, y and owner in rows, the items best first. Per query the number of the first item that
    dominates it, -1 if none does. A query that has found its item meets no more of them."""
    best, left, at, step = np.full(q.shape[1], -1), np.arange(q.shape[1]), 0, 16
    while at < i.shape[1] and len(left):
        some = i[:, at:at + step]
        for rows in np.array_split(left, max(1, len(left) * some.shape[1] // AT_ONCE)):
            a = q[:, rows, None]
            hit = (some[0] > a[0]) & (some[1] > a[1]) & (some[2] != a[2])
            first = hit.argmax(axis=1)
            best[rows] = np.where(hit[np.arange(len(rows)), first], at + first, -1)
        left, at, step = left[best[left] < 0], at + step, 2 * step
    return best


def _in_order(of_queries: np.ndarray, of_items: np.ndarray, items_first: bool) -> np.ndarray:
    """The places of queries and items (in this order) among all, each its own; of equal ones the items come first or last."""
    last = np.arange(len(of_queries) + len(of_items)) < len(of_queries)
    order = np.lexsort((last if items_first else ~last, np.concatenate([of_queries, of_items])))
    places = np.empty(len(order), np.int32)
    places[order] = np.arange(len(order), dtype=np.int32)
    return places


def _higher(places: np.ndarray, item: np.ndarray) -> np.ndarray:
    """``places``: three rows of places 0, 1, ..., each its own. For every column that is no item the number of items that are higher in
    all three. Places are cut into cells of about a root of their number: what shares a cell of x, of y or of z is compared, the
    rest is read from a grid of cells of y and z, to which the items are added from the highest cell of x down."""
    total, n = places.shape[1], np.zeros(places.shape[1], np.int64)
    width = max(64, int((2 * total) ** 0.5))
    cells = places // width
    strips = [(0, places), (1, np.stack([cells[0], places[1], places[2]])), (2, np.stack([cells[0], cells[1], places[2]]))]
    for k, values in strips:
        order = np.argsort(places[k])
        for at in range(0, total, width):
            some = order[at:at + width]
            q, i = some[~item[some]], some[item[some]]
            if len(q) and len(i):
                a, b = values[:, q, None], values[:, None, i]
                hit = b[0] > a[0]
                hit &= b[1] > a[1]
                hit &= b[2] > a[2]
                n[q] += np.add.reduce(hit, axis=1, dtype=np.int32)
    side, order = -(-total // width), np.argsort(places[0])
    down = side - 1 - cells  # from the highest cell on
    above = np.zeros((side + 1, side + 1), np.int32)  # items so far in the cells of y and z before this one
    for at in reversed(range(0, total, width)):
        some = order[at:at + width]
        q, i = some[~item[some]], some[item[some]]
        n[q] += above[down[1, q], down[2, q]]
        now = np.bincount(down[1, i] * side + down[2, i], minlength=side * side).astype(np.int32).reshape(side, side)
        above[1:, 1:] += now.cumsum(0, dtype=np.int32).cumsum(1, dtype=np.int32)
    return n


def _count_in_block(q: np.ndarray, i: np.ndarray) -> np.ndarray:
    """``q``, ``i``: x, y, owner and z in rows. Per query the number of items that dominate it with a z of at least its own: all
    that are higher, without those of its own owner."""
    places = np.stack([_in_order(q[0], i[0], True), _in_order(q[1], i[1], True), _in_order(q[3], i[3], False)])
    item = np.arange(places.shape[1]) >= q.shape[1]
    n, owner = _higher(places, item), np.concatenate([q[2], i[2]])
    by_owner = np.argsort(owner, kind="stable")
    for own in np.split(by_owner, np.flatnonzero(np.diff(owner[by_owner])) + 1):
        if item[own].any() and not item[own].all():
            n[own] -= _higher(places[:, own].argsort(axis=1).argsort(axis=1).astype(np.int32), item[own])
    return n[:q.shape[1]]


def in_blocks(queries: DataFrame, items: DataFrame, group: str, of: Range, count: bool = False) -> DataFrame:
    """What ``best_above`` (and with ``count`` ``count_above``) give, for the items of the query's own block: one row
    (group, qid, value[, n]) for every query that an item of the block dominates. A block has at most two times ``NEAR_ROWS`` rows;
    a task takes one at a time."""
    block = F.shiftright(F.col("x").cast("bigint") - F.lit(of.least), of.near).alias("_block")
    z = [F.col("z").cast("bigint").alias("z")] if count else []

    def rows(df: DataFrame, *more: Column) -> DataFrame:
        return df.where("x is not null and y is not null and owner is not null").select(
            group, block, F.col("x").cast("bigint").alias("x"), F.col("y").cast("double").alias("y"), "owner", *z, *more)

    both = rows(queries, F.col("qid"), F.lit(0).alias("kind")).unionByName(rows(items, F.col("value"), F.lit(1).alias("kind")), allowMissingColumns=True)
    if count:
        both = both.where("z is not null")
    if not of.near:  # a block is a number, whose rows dominate none of each other
        both = both.limit(0)
    parts = max(int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(4 * of.blocks, -(-of.rows // TASK_ROWS)))
    best_first = Window.partitionBy(group, "_block").orderBy("kind", "value")
    both = both.repartition(parts, group, "_block").withColumn("_place", F.row_number().over(best_first))
    schema = T.StructType([both.schema[group], both.schema["qid"], both.schema["value"], *([T.StructField("n", T.LongType())] if count else [])])

    def met(block_: pa.Table) -> pa.Table:
        block_ = block_.combine_chunks()
        first = block_.sort_by("_place")
        n_q = len(first) - int(np.count_nonzero(first["kind"].to_numpy()))
        q, i = first.slice(0, n_q), first.slice(n_q)
        owner = first["owner"].combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int32)
        cols = [_places(q[c].to_numpy(), i[c].to_numpy()) for c in ("x", "y")] + [(owner[:n_q], owner[n_q:])]
        if count:
            cols.append(_places(q["z"].to_numpy(), i["z"].to_numpy()))
        of_q, of_i = np.stack([c[0] for c in cols]), np.stack([c[1] for c in cols])
        best = _best_in_block(of_q[:3], of_i[:3])
        hit = np.flatnonzero(best >= 0)
        out = [q[group].take(hit), q["qid"].take(hit), i["value"].take(best[hit])]
        if count:
            out.append(pa.chunked_array([_count_in_block(of_q[:, hit], of_i)]))
        return pa.Table.from_arrays(out, names=schema.names)

    return both.groupBy(group, "_block").applyInArrow(met, schema)


def best_above(queries: DataFrame, items: DataFrame, group: str, of: Range | None = None) -> DataFrame:
    """``queries``: (group, qid, x, y, owner); ``items``: (group, x, y, owner, value), the least value
    being the best. One row (group, qid, value) for every query that an item of another owner and outside the
    query's block dominates."""
    of = of or x_range(queries, items, group)
    q = _with_x(queries, of, 1, False).select(group, "nx.level", "nx.node", "y", F.lit(0).alias("kind"), "owner", "qid")
    i = _with_x(items, of, 1, True).select(group, "nx.level", "nx.node", "y", F.lit(1).alias("kind"), "owner", "value")
    # queries before items of their own y: an item must be above
    lay = Layout(q.unionByName(i, allowMissingColumns=True), [group, "level", "node"], [F.col("y").desc(), F.col("kind").asc()])
    now, leader = F.struct("value", "owner"), F.col("leader")
    lost = F.when((F.col("kind") == 1) & (leader["owner"] != F.col("owner")), F.greatest(leader, now))
    rows = (lay.rows.withColumn("own", F.when(F.col("kind") == 1, now)).withColumn("leader", F.min("own").over(lay.local))
            .withColumn("lost", lost).withColumn("second", F.min("lost").over(lay.local)))
    # leader and second of the earlier partitions together: the same rule, over two rows for each
    blocks = lay.blocks(rows, own=F.min("own"), lost=F.min("lost"))
    pairs = blocks.select(*lay.by, "_part", F.posexplode(F.array("own", "lost")).alias("k", "own")).where("k = 0 or own is not null")
    order = Window.partitionBy(*lay.by).orderBy("_part", "k").rowsBetween(Window.unboundedPreceding, -1)
    pairs = pairs.withColumn("leader", F.min("own").over(order)).withColumn(
        "lost", F.when(leader["owner"] != F.col("own.owner"), F.greatest(leader, F.col("own"))))
    carried = lay.blocks(pairs, own=F.min("own"), lost=F.min("lost"))
    carried = carried.select(*lay.by, "_part", F.min("own").over(lay.earlier).alias("c_leader"), F.min("lost").over(lay.earlier).alias("c_lost"))
    both = lay.brought(rows.where("kind = 0"), carried)
    others = F.filter(F.array("leader", "second", "c_leader", "c_lost"), lambda s: s["owner"] != F.col("owner"))
    found = F.array_min(F.transform(others, lambda s: s["value"]))
    return both.groupBy(group, "qid").agg(F.min(found).alias("value")).where(F.col("value").isNotNull())


def _count_in_cells(rows: DataFrame, keys: Sequence[str], of: Range) -> DataFrame:
    """``rows``: the group and further keys, x, y, owner, z, kind (0: an item) and qid. One row (group, qid, n) for every query of a cell
    (the keys): the items of the cell that dominate it. A task takes one cell at a time."""
    schema = T.StructType([rows.schema[keys[0]], rows.schema["qid"], T.StructField("n", T.LongType())])

    def met(cell: pa.Table) -> pa.Table:
        cell = cell.combine_chunks()
        query = cell["kind"].to_numpy() == 1
        owner = cell["owner"].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy().astype(np.int32)
        cols = np.stack([cell["x"].to_numpy(), cell["y"].to_numpy(), owner, cell["z"].to_numpy()])
        at = np.flatnonzero(query)
        n = _count_in_block(cols[:, query], cols[:, ~query])
        return pa.Table.from_arrays([cell[keys[0]].take(at), cell["qid"].take(at), pa.chunked_array([n])], names=schema.names)

    # copies of a row are some for each level of x; a cell has rows enough for a task of its own
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-of.rows * max(1, of.bits - of.near) // (4 * TASK_ROWS)))
    return rows.repartition(parts, *keys).groupBy(*keys).applyInArrow(met, schema)


def count_above(queries: DataFrame, items: DataFrame, group: str, of: Range | None = None) -> DataFrame:
    """``queries``: (group, qid, x, y, z, owner); ``items``: (group, x, y, z, owner). One row (group, qid, n) for every
    query that has any node: the items of other owners and outside the query's block with larger x and y and
    a z of at least the query's."""
    width, top = 2, 3
    of = of or x_range(queries, items, group)
    # every row has a place of its own in order of y, items before queries of their own y: they are not above
    both = queries.select(group, "qid", "x", "y", "z", "owner", F.lit(1).alias("kind")).unionByName(
        items.select(group, "x", "y", "z", "owner", F.lit(0).alias("kind")), allowMissingColumns=True)
    both = row_number_within(both, [group], [F.col("y").asc(), F.col("kind").asc()], "rank_")
    low = NEAR_BITS // width * width  # so many bits of the places are left to cells

    nodes = {item: _with_x(both.where(f"kind = {0 if item else 1}"), of, width, item) for item in (True, False)}
    cells = nodes[True].unionByName(nodes[False]).where("z is not null").select(
        group, F.col("nx.level").alias("lx"), F.col("nx.node").alias("kx"), F.shiftright("rank_", low).alias("ky"), F.col("nx.digit").cast("bigint").alias("x"),
        F.col("rank_").alias("y"), F.col("z").cast("bigint").alias("z"), "owner", "kind", "qid")
    close = _count_in_cells(cells, [group, "lx", "kx", "ky"], of)
    if of.tall <= low:
        return close.groupBy(group, "qid").agg(F.sum("n").alias("n"))

    def placed(item: bool) -> DataFrame:
        ny = _nodes(F.col("rank_"), of.tall, width, (lambda d: d > 0) if item else (lambda d: d < top), low)
        # the nodes of all owners, and those of the own one
        parts = F.array(F.lit("a"), F.concat(F.lit("o"), F.col("owner")))
        return nodes[item].withColumn("ny", F.explode(ny)).withColumn("part", F.explode(parts)).select(
            group, F.col("nx.level").alias("lx"), F.col("nx.node").alias("kx"), F.col("ny.level").alias("ly"), F.col("ny.node").alias("ky"), "part",
            "z", "kind", F.col("nx.digit").alias("dx"), F.col("ny.digit").alias("dy"), *([] if item else ["qid"]))

    # items before queries of their own z: they count
    lay = Layout(placed(True).unionByName(placed(False), allowMissingColumns=True),
                 [group, "lx", "kx", "ly", "ky", "part"], [F.col("z").desc(), F.col("kind").asc()])
    cells = [(a, b) for a in range(top) for b in range(top)]
    hit = {(a, b): F.when((F.col("kind") == 0) & (F.col("dx") > a) & (F.col("dy") > b), 1).otherwise(0) for a, b in cells}
    rows = lay.rows.withColumns({f"n{a}{b}": F.sum(h).over(lay.local) for (a, b), h in hit.items()}).where("kind = 1")
    blocks = lay.blocks(lay.rows, **{f"t{a}{b}": F.sum(h) for (a, b), h in hit.items()})
    blocks = blocks.select(*lay.by, "_part", *[F.sum(f"t{a}{b}").over(lay.earlier).alias(f"c{a}{b}") for a, b in cells])
    zero, n = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
    for a, b in cells:
        n = F.when((F.col("dx") == a) & (F.col("dy") == b), F.coalesce(f"n{a}{b}", zero) + F.coalesce(f"c{a}{b}", zero)).otherwise(n)
    far = lay.brought(rows, blocks).select(group, "qid", F.when(F.col("part") == "a", n).otherwise(-n).alias("n"))
    return far.unionByName(close).groupBy(group, "qid").agg(F.sum("n").alias("n"))
