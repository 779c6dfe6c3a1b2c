"""The history's state (``operators.history``) as tables that batches of snapshots are merged into.

Each merge writes a version of the three state tables beside the last and then commits it as one small file,
``<root>/_log/<n>.json``, created only if it does not exist. The commit also says which batch of
which stream came last, so a batch that is run again after a failure is not merged twice, and a
merge that finds another one committed in between is done again on top of it.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from draftledger import files
from draftledger.operators import history
from draftledger.operators.history import History
from draftledger.plans.versions import WRITING_SECONDS

TABLES = ("titles", "floors", "published")


def _last(spark: SparkSession, root: str) -> dict:
    found, taken = files.last_json(spark, f"{root}/_log", WRITING_SECONDS)
    return (found or {"number": 0, "version": None, "batches": {}}) | {"taken": taken}


def _read(spark: SparkSession, root: str, version: str) -> History:
    return History(*[spark.read.parquet(f"{root}/version={version}/{t}") for t in TABLES])


def load(spark: SparkSession, root: str) -> History | None:
    """The state as last committed; None before the first merge."""
    last = _last(spark, root)
    return _read(spark, root, last["version"]) if last["version"] else None


def merge(spark: SparkSession, root: str, snap: DataFrame, stream: str, batch: int) -> History:
    """Merges the cleaned snapshots of one batch and returns the state with them."""
    while True:
        last = _last(spark, root)
        if last["batches"].get(stream, -1) >= batch:
            return _read(spark, root, last["version"])
        state = history.summarize(snap)
        if last["version"]:
            state = history.merge(_read(spark, root, last["version"]), state)
        done = _commit(spark, root, last, state, last["batches"] | {stream: batch})
        if done:
            return _read(spark, root, done)


def rebuild(spark: SparkSession, root: str, snap: DataFrame) -> History:
    """The state made anew from a whole history, e.g. after snapshots were taken back."""
    while True:
        last = _last(spark, root)
        done = _commit(spark, root, last, history.summarize(snap), last["batches"])
        if done:
            return _read(spark, root, done)


def _commit(spark: SparkSession, root: str, last: dict, state: History, batches: dict) -> str | None:
    version = uuid.uuid4().hex
    for name, df in state.tables().items():
        # a league's titles lie together, so that a refresh of some leagues skips the others' row groups
        if name == "titles" and not state.shared:
            df = df.hint("rebalance", "draft_id").sortWithinPartitions("draft_id")
        df.write.parquet(f"{root}/version={version}/{name}")
    number = last["taken"] + 1
    text = json.dumps({"number": number, "version": version, "batches": batches})
    return version if files.write_new(spark, f"{root}/_log/{number:012d}.json", text) else None


def vacuum(spark: SparkSession, root: str, grace_seconds: float) -> list[str]:
    """Deletes the versions but the last that are older than the grace time."""
    last, before = _last(spark, root), (time.time() - grace_seconds) * 1000
    gone = [e.path for e in files.entries(spark, root)
            if e.name.startswith("version=") and e.name != f"version={last['version']}" and e.modified_ms < before]
    for path in gone:
        files.delete(spark, path)
    return gone
