"""League inputs derived from the driver's TPC-H-style tables (read-only Parquet).

Mapping (a league is a part brand, a title is a part):

* snapshots: lineitem x part x supplier, every line; per title and ship day the
  line amounts in cents (floor(extendedprice * 100)), domestic when the supplier's nation
  key is a multiple of 5, else foreign; all three amounts cumulative over ship days. The
  capture misses the worldwide total on Sundays (revenue 0, repaired by the cleaning step).
* draft: parts whose key is not a multiple of 5, numbered per league by retail price
  (descending) then key; four drafters D0..D3 in turn; 4 picks per round.
* rules: exclusion for size 13, movie multiplier 0.5 for sizes divisible by 10, round 2 x 2.0
  and round 3 x 0.5 in every league; multipliers as text, blank for exclusions.
* manual adds: parts of size 7, revenue key*1000 (domestic key*600, foreign key*400),
  first seen June 15 of the season, all as text.
* scraped page: latest in-season snapshot per title as money text.
* league configurations: one per (part type, brand); a brand listed by several types is a
  duplicated league id.

All of it is plain DataFrame code that scales with the input tables.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from draftledger.functions.columns import asc, desc
from draftledger.functions.windows import row_number_within
from draftledger.params import Season
from draftledger.session import path_complete, shared_root
from draftledger.sources import schemas as S

# Fixed values of the testbed mapping.
DRAFTERS = 4                 # drafters per league, named D0..D3
EXCLUDED_SIZE = 13
MOVIE_RULE_SIZE_STEP = 10
MOVIE_RULE_MULTIPLIER = "0.5"
ROUND_RULES = [("2", "2.0"), ("3", "0.5")]
MANUAL_SIZE = 7
MANUAL_FIRST_SEEN = (6, 15)  # month, day within the season
UNDRAFTED_KEY_STEP = 5
DOMESTIC_NATION_STEP = 5


def _title(partkey) -> F.Column:
    return F.concat(F.lit("P"), F.col(partkey).cast("string"))


def _tables(spark: SparkSession, sf_dir: str):
    def read(name, *cols):
        return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)
    return read


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The amounts of every part up to each of its days, in few and narrow columns."""
    read = _tables(spark, sf_dir)
    lines = read("lineitem", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    sup = read("supplier", "s_suppkey", "s_nationkey")
    part = read("part", "p_partkey", "p_brand")
    cents = F.floor(F.col("l_extendedprice") * 100).cast("bigint")
    domestic = (F.col("s_nationkey") % DOMESTIC_NATION_STEP) == 0
    zero = F.lit(0).cast("bigint")
    # Lines are summed by (part, day) before they are shuffled, so a part that holds a large share of
    # them never lands whole in one task. They meet their supplier before that: while the suppliers are few
    # they are broadcast and nothing is shuffled, else a supplier of many lines is split as a skewed key.
    flagged = lines.join(sup, lines.l_suppkey == sup.s_suppkey)
    per_day = (flagged.groupBy("l_partkey", F.to_date("l_shipdate").alias("loaded_date"))
               .agg(F.sum(F.when(domestic, cents).otherwise(zero)).alias("dom_day"),
                    F.sum(F.when(domestic, zero).otherwise(cents)).alias("for_day")))
    daily = per_day.join(part, per_day.l_partkey == part.p_partkey)
    to_date = Window.partitionBy("l_partkey").orderBy("loaded_date").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select("p_brand", "l_partkey", "loaded_date", F.sum("dom_day").over(to_date).alias("domestic_rev"),
                        F.sum("for_day").over(to_date).alias("foreign_rev"))


def _as_snapshots(days: DataFrame) -> DataFrame:
    sunday = F.dayofweek("loaded_date") == 1
    return days.select(
        F.col("p_brand").alias("draft_id"),
        _title("l_partkey").alias("title"),
        F.when(sunday, F.lit(0).cast("bigint"))
         .otherwise(F.col("domestic_rev") + F.col("foreign_rev")).alias("revenue"),
        "domestic_rev",
        "foreign_rev",
        "loaded_date",
        F.year("loaded_date").cast("string").alias("release_year"),
        F.col("loaded_date").cast("timestamp").alias("published_timestamp_utc"),
    )


def snapshots(spark: SparkSession, sf_dir: str, by_league: bool = False) -> DataFrame:
    """Raw daily snapshot history with the league column (S1 schema). ``by_league``: the rows of a league
    in few tasks; they are brought there before they get their texts and further columns."""
    days = _days(spark, sf_dir)
    return _as_snapshots(days.hint("rebalance", "p_brand") if by_league else days)


def draft_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draft picks as text (the shape of a sheet export)."""
    part = _tables(spark, sf_dir)("part", "p_partkey", "p_brand", "p_retailprice")
    drafted = part.filter((F.col("p_partkey") % UNDRAFTED_KEY_STEP) != 0)
    numbered = row_number_within(drafted, ["p_brand"], [desc("p_retailprice"), asc("p_partkey")], "pick")
    pick = F.col("pick")
    return numbered.select(
        F.col("p_brand").alias("draft_id"),
        (F.floor((pick - 1) / DRAFTERS) + 1).cast("string").alias("round"),
        pick.cast("string").alias("overall_pick"),
        F.concat(F.lit("D"), ((pick - 1) % DRAFTERS).cast("string")).alias("name"),
        _title("p_partkey").alias("movie"),
    )


def rules_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring rules as text: exclusions, movie multipliers, round multipliers."""
    part = _tables(spark, sf_dir)("part", "p_partkey", "p_brand", "p_size")
    excl = part.filter(F.col("p_size") == EXCLUDED_SIZE).select(
        F.col("p_brand").alias("draft_id"), _title("p_partkey").alias("value"),
        F.lit("").alias("multiplier"), F.lit("exclusion").alias("type"))
    movie = part.filter((F.col("p_size") % MOVIE_RULE_SIZE_STEP) == 0).select(
        F.col("p_brand").alias("draft_id"), _title("p_partkey").alias("value"),
        F.lit(MOVIE_RULE_MULTIPLIER).alias("multiplier"), F.lit("movie").alias("type"))
    leagues = part.select(F.col("p_brand").alias("draft_id")).distinct()
    rounds = F.array(*[F.struct(F.lit(r).alias("value"), F.lit(m).alias("multiplier")) for r, m in ROUND_RULES])
    rnd = leagues.select("draft_id", F.inline(rounds)).withColumn("type", F.lit("round"))
    return excl.unionByName(movie).unionByName(rnd)


def manual_adds_text(spark: SparkSession, sf_dir: str, season: Season) -> DataFrame:
    """Manual additions as text, release date as month/day/year text."""
    part = _tables(spark, sf_dir)("part", "p_partkey", "p_brand", "p_size")
    month, day = MANUAL_FIRST_SEEN
    key = F.col("p_partkey")
    return part.filter(F.col("p_size") == MANUAL_SIZE).select(
        F.col("p_brand").alias("draft_id"),
        _title("p_partkey").alias("title"),
        (key * 1000).cast("string").alias("revenue"),
        (key * 600).cast("string").alias("domestic_rev"),
        (key * 400).cast("string").alias("foreign_rev"),
        F.lit(f"{month}/{day}/{season.year}").alias("release_date"),
    )


def scraped_page(snap: DataFrame, season: Season) -> DataFrame:
    """The season's latest snapshot per title rendered like a results web page."""
    in_season = snap.filter(F.col("release_year") == season.year_text)
    latest = (in_season.groupBy("draft_id", "title")
              .agg(F.max(F.struct("loaded_date", "domestic_rev", "foreign_rev")).alias("s")))

    def money(c):
        return F.concat(F.lit("$"), F.format_number(c, 0))

    dom, fgn = F.col("s.domestic_rev"), F.col("s.foreign_rev")
    return latest.select(
        "draft_id",
        F.col("title").alias(S.SCRAPED_TITLE),
        money(dom + fgn).alias(S.SCRAPED_WORLDWIDE),
        F.when(dom == 0, F.lit("-")).otherwise(money(dom)).alias(S.SCRAPED_DOMESTIC),
        F.when(fgn == 0, F.lit("")).otherwise(money(fgn)).alias(S.SCRAPED_FOREIGN),
    )


def league_years(spark: SparkSession, sf_dir: str, season: Season) -> DataFrame:
    """Leagues of two seasons: brands with an odd last digit play the season, others the one before."""
    brand = F.col("p_brand")
    year = F.lit(season.year) - (F.substring(brand, -1, 1).cast("int") + 1) % 2
    return _tables(spark, sf_dir)("part", "p_brand").select(brand.alias("draft_id"), year.alias("year")).distinct()


def league_configs(spark: SparkSession, sf_dir: str, season: Season) -> DataFrame:
    part = _tables(spark, sf_dir)("part", "p_brand", "p_type")
    return part.select(
        F.concat(F.lower("p_type"), F.lit("_"), F.regexp_replace(F.lower("p_brand"), "#", ""),
                 F.lit(".yml")).alias("config_name"),
        F.col("p_brand").alias("draft_id"),
        F.lit(season.year).alias("year"),
    ).distinct()


# Bump when the mapping above changes, so stale tables are not reused.
TESTBED_VERSION = "v3"

BUILDERS = {
    "snapshots": lambda spark, sf_dir, season: snapshots(spark, sf_dir, by_league=True),
    "draft_text": lambda spark, sf_dir, season: draft_text(spark, sf_dir),
    "rules_text": lambda spark, sf_dir, season: rules_text(spark, sf_dir),
    "manual_adds_text": lambda spark, sf_dir, season: manual_adds_text(spark, sf_dir, season),
}
INPUTS = ("lineitem", "part", "supplier")


def input_mark(spark: SparkSession, sf_dir: str) -> str:
    """A mark of the input files: names, lengths and modification times, not their content."""
    mark = []
    for table in INPUTS:
        files = spark.read.format("binaryFile").load(f"{sf_dir}/{table}.parquet").select("path", "length", "modificationTime")
        row = files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()
        mark.append(f"{row[0]}-{row[1]}")
    return hashlib.sha256("/".join(mark).encode()).hexdigest()[:16]


def testbed_root(spark: SparkSession, sf_dir: str, season: Season) -> str:
    slug = re.sub(r"[^A-Za-z0-9._-]+", "_", sf_dir.strip("/"))
    return (f"{shared_root(spark)}/draftledger-testbed/{TESTBED_VERSION}/"
            f"{slug}-{input_mark(spark, sf_dir)}/{season.year}-{season.as_of.isoformat()}")


def _write(spark: SparkSession, root: str, sf_dir: str, season: Season) -> dict[str, str]:
    paths = {}
    for name, build in BUILDERS.items():
        path = f"{root}/{name}"
        if not path_complete(spark, path):
            df = build(spark, sf_dir, season)
            if name == "snapshots":  # a folder per league, so a refresh of some leagues reads only theirs
                (df.write.mode("overwrite").option("partitionOverwriteMode", "static")
                 .partitionBy("draft_id").parquet(path))  # a dynamic overwrite would leave no _SUCCESS marker
            else:
                df.write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths


def materialize(spark: SparkSession, sf_dir: str, season: Season) -> dict[str, str]:
    """Write the league tables once into the shared folder and return their paths.

    The reference reads its snapshot history from Parquet; the derived tables play that
    part here, so every query starts from a column-pruned Parquet scan instead of
    re-deriving the history from lineitem. A table is built again when its write did not
    finish (no ``_SUCCESS`` marker) or when the input files are others than it was built from.
    """
    return _write(spark, testbed_root(spark, sf_dir, season), sf_dir, season)


_LOADED: dict = {}


def load(spark: SparkSession, sf_dir: str, season: Season) -> dict[str, DataFrame]:
    """The materialised league tables as DataFrames (built on first use, opened once per
    application)."""
    root = testbed_root(spark, sf_dir, season)
    key = (spark.sparkContext.applicationId, root)
    if key not in _LOADED:
        paths = _write(spark, root, sf_dir, season)
        out = {name: spark.read.parquet(path) for name, path in paths.items()}
        out["snapshots"] = spark.read.schema(S.SNAPSHOT).parquet(paths["snapshots"]).select(*S.SNAPSHOT_COLUMNS)
        _LOADED[key] = out
    return dict(_LOADED[key])
