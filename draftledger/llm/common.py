"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from draftledger.session import materialize

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

__all__ = ["WORD", "load", "materialize", "pack", "release", "unpack"]


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def pack(df: DataFrame, **named: str | Column) -> DataFrame:
    """One struct column ``row`` with everything in ``df`` plus the named working columns, so
    that no column of the input can clash with a working column."""
    taken = {k: (F.col(f"`{v}`") if isinstance(v, str) else v).alias(k) for k, v in named.items()}
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *taken.values())


def unpack(df: DataFrame, *extra: str) -> DataFrame:
    """The columns of ``row`` again; ``extra`` working columns follow unless the row has one of
    that name (then the working column replaces it)."""
    names = [f.name for f in df.schema["row"].dataType.fields]
    kept = [F.col(f"row.`{n}`").alias(n) for n in names if n not in extra]
    return df.select(*kept, *[F.col(e) for e in extra])


def release(spark: SparkSession) -> None:
    """Ask the driver's JVM to collect, so that Spark's cleaner deletes the shuffle files of jobs
    whose result has been written; otherwise they stay until the next full collection."""
    spark.sparkContext._jvm.System.gc()
