"""Sources S1-S8: typed league inputs from Parquet, CSV or captured text.

Nothing here fetches from the web or a spreadsheet; inputs arrive as files or DataFrames.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from draftledger.functions.columns import SHEET_DATE_INPUT, money_text_to_long, strict_int
from draftledger.params import Season
from draftledger.sources import schemas as S


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """The daily snapshot history, only the seven snapshot columns (plus the league).

    The schema is declared, so no inference pass runs; the projection reaches the scan. A
    column that the files lack is an error, not a column of NULLs.
    """
    return _declared(spark, path, S.SNAPSHOT)


def read_shared_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """S1 for one history that all leagues share: the seven snapshot columns, no league."""
    return _declared(spark, path, S.SHARED_SNAPSHOT)


def _declared(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    there = set(spark.read.parquet(path).columns)
    missing = [f.name for f in schema.fields if f.name not in there]
    if missing:
        hint = "; a history without leagues is read by read_shared_snapshots" if missing == ["draft_id"] else ""
        raise ValueError(f"{path} lacks {', '.join(missing)}{hint}")
    return spark.read.schema(schema).parquet(path).select(*[f.name for f in schema.fields])


def snapshot_from_scraped(page: DataFrame, season: Season) -> DataFrame:
    """A captured results page (text cells) as one snapshot per title.

    Money text loses '$', ',' and blanks, becomes BIGINT, unreadable -> 0. The load date is
    the as-of date, the release year the season, the publish time the run time.
    """
    return page.select(
        "draft_id",
        F.col(S.SCRAPED_TITLE).alias("title"),
        money_text_to_long(S.SCRAPED_WORLDWIDE).alias("revenue"),
        money_text_to_long(S.SCRAPED_DOMESTIC).alias("domestic_rev"),
        money_text_to_long(S.SCRAPED_FOREIGN).alias("foreign_rev"),
        F.lit(season.as_of).alias("loaded_date"),
        F.lit(season.year_text).alias("release_year"),
        F.lit(season.run_time).cast("timestamp").alias("published_timestamp_utc"),
    )


def is_shared(spark: SparkSession, path: str) -> bool:
    """Whether the history at ``path`` has no league column."""
    return "draft_id" not in spark.read.parquet(path).columns


def load_snapshots(spark: SparkSession, season: Season, path: str | None = None,
                   page: DataFrame | None = None) -> DataFrame:
    """One loader for all kinds of source: a path to league histories or to a shared one,
    told apart by their columns, or a captured page."""
    if path is not None:
        return read_shared_snapshots(spark, path) if is_shared(spark, path) else read_snapshots(spark, path)
    if page is not None:
        return snapshot_from_scraped(page, season)
    raise ValueError("give a Parquet path or a captured page")


def draft_from_text(text: DataFrame) -> DataFrame:
    """S3: draft picks read as text, cast to the declared types (round, overall_pick INT;
    '1.0' reads 1, text that is no number is an error)."""
    return text.select(
        F.col("draft_id").cast("string"),
        strict_int("round").alias("round"),
        strict_int("overall_pick").alias("overall_pick"),
        F.col("name").cast("string"),
        F.col("movie").cast("string"),
    )


def read_draft_csv(spark: SparkSession, path: str) -> DataFrame:
    """S3 from a CSV export: every column read as text, then cast."""
    return draft_from_text(spark.read.schema(S.DRAFT_TEXT).option("header", True).csv(path))


def manual_adds_from_text(text: DataFrame) -> DataFrame:
    """Manual additions as text; the release date is month/day/year text."""
    return text.select(
        "draft_id",
        F.col("title").cast("string"),
        F.col("revenue").cast("string"),
        F.col("domestic_rev").cast("string"),
        F.col("foreign_rev").cast("string"),
        F.try_to_date(F.col("release_date"), SHEET_DATE_INPUT).alias("release_date"),
    )


def rules_from_text(text: DataFrame) -> DataFrame:
    """Scoring rules; a blank multiplier becomes 0.0 (not NULL, not 1). A CSV export
    reads a blank cell as NULL, so NULL counts as blank."""
    m = F.col("multiplier").cast("string")
    blank = F.coalesce(F.trim(m), F.lit("")) == ""
    return text.select(
        "draft_id",
        F.col("value").cast("string"),
        F.when(blank, F.lit(0.0)).otherwise(m.cast("double")).alias("multiplier"),
        F.col("type").cast("string"),
    )


def optional_source(spark: SparkSession, path: str, schema: T.StructType,
                    required: bool = False, fmt: str = "parquet") -> DataFrame:
    """A source that may be absent. Absent and optional -> empty frame with full schema;
    absent and required (the draft) -> error."""
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)  # sheet exports carry a header row
    try:
        return reader.load(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err) and "Path does not exist" not in str(err):
            raise
    if required:
        raise FileNotFoundError(f"required source missing: {path}")
    return spark.createDataFrame([], schema)


def read_model(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """A materialised model for display: optional positional rename, and every float or
    double that is NaN or +-Infinity becomes NULL."""
    if names:
        df = df.toDF(*names)
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            bad = F.isnan(c) | (F.abs(c) == F.lit(math.inf))
            c = F.when(bad, F.lit(None).cast(field.dataType)).otherwise(c)
        out.append(c.alias(field.name))
    return df.select(*out)
