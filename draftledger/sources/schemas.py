"""Declared schemas of the league inputs. Every league table starts with ``draft_id``."""

from pyspark.sql import types as T


def _f(name, dtype, comment=None, nullable=True):
    return T.StructField(name, dtype, nullable, {"comment": comment} if comment else {})


SNAPSHOT = T.StructType([
    _f("draft_id", T.StringType(), "league the history belongs to"),
    _f("title", T.StringType(), "title of the release"),
    _f("revenue", T.LongType(), "worldwide revenue to date"),
    _f("domestic_rev", T.LongType(), "domestic revenue to date"),
    _f("foreign_rev", T.LongType(), "foreign revenue to date"),
    _f("loaded_date", T.DateType(), "day the snapshot was taken"),
    _f("release_year", T.StringType(), "season of the release, as text"),
    _f("published_timestamp_utc", T.TimestampType(), "when the snapshot was published"),
])
SNAPSHOT_COLUMNS = [f.name for f in SNAPSHOT.fields]
# One history that all leagues share.
SHARED_SNAPSHOT = T.StructType(SNAPSHOT.fields[1:])

DRAFT = T.StructType([
    _f("draft_id", T.StringType()),
    _f("round", T.IntegerType(), "draft round, counted from 1"),
    _f("overall_pick", T.IntegerType(), "position in the whole draft"),
    _f("name", T.StringType(), "drafter who made the pick"),
    _f("movie", T.StringType(), "title that was picked"),
])

MANUAL_ADDS_RAW = T.StructType([
    _f("draft_id", T.StringType()),
    _f("title", T.StringType(), "title entered by hand"),
    _f("revenue", T.StringType(), "worldwide amount as typed"),
    _f("domestic_rev", T.StringType(), "domestic amount as typed"),
    _f("foreign_rev", T.StringType(), "foreign amount as typed"),
    _f("release_date", T.DateType(), "release day, first day the title counts as seen"),
])

MANUAL_ADDS_TEXT = T.StructType([
    _f("draft_id", T.StringType()),
    _f("title", T.StringType()),
    _f("revenue", T.StringType()),
    _f("domestic_rev", T.StringType()),
    _f("foreign_rev", T.StringType()),
    _f("release_date", T.StringType()),
])

RULES = T.StructType([
    _f("draft_id", T.StringType()),
    _f("value", T.StringType(), "round or title the rule is about"),
    _f("multiplier", T.DoubleType(), "factor on the score"),
    _f("type", T.StringType(), "round, movie or exclusion"),
])

RULES_TEXT = T.StructType([
    _f("draft_id", T.StringType()),
    _f("value", T.StringType()),
    _f("multiplier", T.StringType()),
    _f("type", T.StringType()),
])

DRAFT_TEXT = T.StructType([
    _f("draft_id", T.StringType()),
    _f("round", T.StringType()),
    _f("overall_pick", T.StringType()),
    _f("name", T.StringType()),
    _f("movie", T.StringType()),
])

# Columns of a scraped yearly results page (fixed headings of the source page).
SCRAPED_TITLE = "Release Group"
SCRAPED_WORLDWIDE = "Worldwide"
SCRAPED_DOMESTIC = "Domestic"
SCRAPED_FOREIGN = "Foreign"

LEAGUE_CONFIGS = T.StructType([
    _f("config_name", T.StringType(), "configuration file the league is declared in"),
    _f("draft_id", T.StringType()),
    _f("year", T.IntegerType()),
])
