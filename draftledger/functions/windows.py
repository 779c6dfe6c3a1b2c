"""Window-shaped helpers that stay safe when one key holds a large share of the rows.

* ``first_per_key`` / ``top_n_per_key``: ``row_number() <= n`` filters. Spark plans these
  with a map-side ``WindowGroupLimit`` so at most n rows per key and map task are shuffled,
  however hot the key is.
* ``row_number_within``: a per-group ``row_number`` computed with a range-partitioned sort
  and per-partition offsets. A plain ``Window.partitionBy(league)`` would put a whole league
  into one task; here a league spreads over as many tasks as its size needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from draftledger.functions.columns import col
from draftledger.session import materialize


def _cols(names: Sequence) -> list[Column]:
    return [col(c) for c in names]


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                  name: str = "_rn") -> DataFrame:
    """Rows ranked 1..n within each key by ``order`` (numbered in column ``name``)."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``order`` (F8, QUALIFY row_number() = 1, which Spark SQL
    cannot parse: window column, filter, drop)."""
    return top_n_per_key(df, keys, order, 1, "_first_rn").drop("_first_rn")


def _null_safe_on(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    cond = None
    for c in names:
        term = left[c].eqNullSafe(right[c])
        cond = term if cond is None else cond & term
    return cond


def row_number_within(df: DataFrame, by: Sequence[str], order: Sequence[Column],
                      name: str = "rank", partitions: int | None = None) -> DataFrame:
    """``row_number() over (partition by <by> order by <order>)`` as a BIGINT column ``name``.

    ``order`` must be a total order on the rows that matter (add tie-breakers), else rows
    that tie get their numbers in an arbitrary order, as with any row_number.

    Plan: one range shuffle on (by, order), written once to the shared folder; inside each shuffle partition the
    rows are sorted and numbered by position; a small table with one row per (group, partition)
    gives each partition the number of rows of its group in earlier partitions. The
    small table has at most (#groups + #partitions) rows; it is joined back on
    (group, partition) and Spark broadcasts it only when its measured size is under the
    broadcast threshold.
    """
    keys = [col(c).asc_nulls_first() for c in by] + list(order)
    # Without an explicit count AQE may coalesce the range partitions of a small input; it
    # only merges neighbouring ranges, so partition order still follows the sort order.
    ranged_in = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    # Written once to the shared folder: both uses below must see the same partition
    # numbers and positions (a second range exchange would sample its own bounds).
    ranged = materialize(ranged_in
                         .sortWithinPartitions(*keys)
                         .withColumn("_rw_part", F.spark_partition_id())
                         .withColumn("_rw_pos", F.monotonically_increasing_id()), "ranked")
    blocks = (ranged.groupBy(*_cols(by), "_rw_part")
              .agg(F.min("_rw_pos").alias("_rw_first"), F.count(F.lit(1)).alias("_rw_n")))
    earlier = Window.partitionBy(*_cols(by)).orderBy("_rw_part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_rw_before", F.coalesce(F.sum("_rw_n").over(earlier), F.lit(0).cast("bigint")))
    blocks = blocks.select(*[F.col(c).alias(f"_rw_by_{i}") for i, c in enumerate(by)],
                           F.col("_rw_part").alias("_rw_part_b"), "_rw_first", "_rw_before")
    cond = ranged["_rw_part"] == blocks["_rw_part_b"]
    for i, c in enumerate(by):
        cond = cond & ranged[c].eqNullSafe(blocks[f"_rw_by_{i}"])
    joined = ranged.join(blocks, cond, "inner")
    number = F.col("_rw_before") + F.col("_rw_pos") - F.col("_rw_first") + F.lit(1)
    out = joined.withColumn(name, number.cast("bigint"))
    drop = ["_rw_part", "_rw_pos", "_rw_part_b", "_rw_first", "_rw_before"] + [f"_rw_by_{i}" for i in range(len(by))]
    return out.drop(*drop)
