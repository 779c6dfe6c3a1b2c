"""Incremental trigger for the daily refresh, as a Structured Streaming query.

The reference refreshes every league on a daily schedule. Here new snapshot files landing in a folder are the
stream. Each micro-batch is merged into the state of the history (``plans.history_state``), so a day costs
the day's files and the state, not the history; then the leagues it touches are refreshed as a new version.

The stream's schema follows the files: a history of leagues touches the leagues in the batch; a shared
history touches, through the configurations, the leagues of every year that one of the batch's titles has
snapshots of, as a new day of a title moves its first day and its activity in all of them. Configurations
that name a league twice stop the trigger before anything is merged.

Run it with ``available_now=True`` from a scheduler to process whatever arrived since the last run and
stop; the checkpoint in the shared folder remembers which files were processed, and the state which
batch was merged, so a lost driver or executor resumes without reprocessing or skipping files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from draftledger.operators import checks, clean, history
from draftledger.params import DEFAULT_SEASON, Season
from draftledger.plans import history_state, versions
from draftledger.plans.refresh import InputPaths, load_inputs, refresh
from draftledger.session import materialize
from draftledger.sources import readers
from draftledger.sources import schemas as S


def new_snapshot_files(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None,
                       shared: bool | None = None) -> DataFrame:
    """New files of a history of leagues or of a shared one (``shared``; None: as the files there are)."""
    if shared is None:
        shared = readers.is_shared(spark, landing)
    reader = spark.readStream.schema(S.SHARED_SNAPSHOT if shared else S.SNAPSHOT).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(landing)


def touched_leagues(batch: DataFrame, state: history.History, league_years: DataFrame | None) -> DataFrame:
    """One row per league whose tables the batch changes."""
    if not state.shared:
        return batch.select("draft_id").where("draft_id is not null").distinct()
    if league_years is None:
        raise ValueError("a shared history needs the leagues and their years: give the paths of the configurations")
    years = league_years.select("draft_id", F.col("year").cast("string").alias("release_year")).distinct()
    return years.join(history.years_of(state, batch), "release_year", "left_semi").select("draft_id").distinct()


def start(spark: SparkSession, paths: InputPaths, out_root: str, checkpoint: str,
          season: Season = DEFAULT_SEASON, available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the trigger. ``paths.snapshots`` is the landing folder of the history; its state is kept under
    ``out_root``/_history."""
    state_root = f"{out_root}/_history"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        stamp = versions.start(spark, out_root)
        inputs = load_inputs(spark, paths, season, snapshots=False)
        years = None
        if "configs" in inputs:
            checks.require_unique_leagues(inputs["configs"])
            years = inputs["configs"].select("draft_id", "year").distinct()
        rows = materialize(clean.clean_snapshots(batch), "batch")  # read once, used for the state and the leagues
        state = history_state.merge(spark, state_root, rows, checkpoint, batch_id)
        touched = materialize(touched_leagues(rows, state, years), "touched")
        if not touched.isEmpty():
            refresh(spark, inputs, out_root, season, leagues=touched, state=state, stamp=stamp)

    writer = (new_snapshot_files(spark, paths.snapshots, max_files_per_trigger).writeStream
              .foreachBatch(on_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 day")
    return writer.start()
