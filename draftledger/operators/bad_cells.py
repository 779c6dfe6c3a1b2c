"""Cells that a strict cast would stop at, and the leagues they hold back.

A league with such a cell keeps the tables it has; all others are refreshed. The cells are listed
with league, source, column and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from draftledger.functions.columns import lenient_int

BAD_CELL = "draft_id string, source string, column string, text string"


def _number(c: str) -> Column:
    return F.col(c).isNotNull() & lenient_int(c).isNull()


def _double(c: str) -> Column:
    text = F.col(c).cast("string")
    return (F.coalesce(F.trim(text), F.lit("")) != "") & text.try_cast("double").isNull()


def _whole(c: str) -> Column:
    return F.col(c).isNotNull() & F.col(c).cast("string").try_cast("bigint").isNull()


#: By source the columns that are cast strictly, with the condition of a bad cell.
STRICT = {
    "draft_text": {"round": _number, "overall_pick": _number},
    "rules_text": {"multiplier": _double},
    "snapshots": {"revenue": _whole, "domestic_rev": _whole, "foreign_rev": _whole},
}


def _leagues_of(rows: DataFrame, league_years: DataFrame | None) -> DataFrame:
    """Rows of a shared history with every league of their year."""
    if "draft_id" in rows.columns:
        return rows
    if league_years is None:
        raise ValueError("a shared history needs the leagues and their years")
    own = league_years.select("draft_id", F.col("year").cast("string").alias("release_year")).distinct()
    return rows.join(own, "release_year")


def bad_cells(inputs: dict[str, DataFrame], league_years: DataFrame | None = None) -> DataFrame:
    """(draft_id, source, column, text) of every bad cell. A column that is a number in its file has none,
    so a typed history is not read for this."""
    out = None
    for source, columns in STRICT.items():
        df = inputs.get(source)
        if df is None:
            continue
        text = {c: bad for c, bad in columns.items() if isinstance(df.schema[c].dataType, T.StringType)}
        if not text:
            continue
        cells = F.filter(F.array(*[F.when(bad(c), F.struct(F.lit(c).alias("column"), F.col(c).alias("text"))) for c, bad in text.items()]),
                         lambda x: x.isNotNull())
        rows = df.withColumn("_cells", cells).where(F.size("_cells") > 0)
        rows = _leagues_of(rows, league_years).select("draft_id", F.lit(source).alias("source"), F.explode("_cells").alias("c"))
        rows = rows.select("draft_id", "source", "c.column", "c.text")
        out = rows if out is None else out.unionByName(rows)
    return out


def without(inputs: dict[str, DataFrame], held: DataFrame) -> dict[str, DataFrame]:
    """The inputs without the leagues that are held back. A row without a league goes if one of its own
    cells is bad, as no league can be held for it; in a shared history likewise."""
    out = {}
    for name, df in inputs.items():
        if df is not None and "draft_id" in df.columns:
            df = df.join(held, "draft_id", "left_anti")
        for c, bad in STRICT.get(name, {}).items():
            if df is not None and isinstance(df.schema[c].dataType, T.StringType):
                df = df.where(~bad(c))
        out[name] = df
    return out
