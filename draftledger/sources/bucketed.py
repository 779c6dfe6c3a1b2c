"""A snapshot history as a table bucketed and sorted by title.

Equal titles of a league lie in one bucket, so the aggregates over the history (first day, newest snapshots) and
the joins with its per-title state start without a shuffle, every day anew. Meant for histories in which no
single title holds a large share of the rows, as a bucket is read by one task; others stay unbucketed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from draftledger.session import path_complete
from draftledger.sources import schemas as S

KEYS = ("draft_id", "title")


def _keys(columns) -> list[str]:
    return [c for c in KEYS if c in columns]


def write(snap: DataFrame, path: str, buckets: int, table: str) -> DataFrame:
    """Writes the history (unless a finished one is there) and opens it."""
    spark = snap.sparkSession
    if not path_complete(spark, path):
        keys = _keys(snap.columns)
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        # the same hash as the buckets': one file for each
        (snap.repartition(buckets, *keys).write.mode("overwrite").option("path", path)
         .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return open_table(spark, path, buckets, table, shared="draft_id" not in snap.columns)


def open_table(spark: SparkSession, path: str, buckets: int, table: str, shared: bool = False) -> DataFrame:
    """The history at ``path``, made known to the session's catalog if it is not."""
    schema = S.SHARED_SNAPSHOT if shared else S.SNAPSHOT
    keys = ", ".join(_keys(schema.names))
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                  f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table).select(*schema.names)
