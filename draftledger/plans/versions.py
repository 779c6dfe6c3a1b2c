"""Versions of published tables: a commit log, what readers see, compaction and retention.

A run writes its tables as a version of its own (``<root>/<table>/version=<id>/``) and then commits.
Commit n is the file ``<root>/_log/<n>.json``; it is created only if it does not exist, so of two runs
that commit at once one finds the number taken, reads what the other published, and tries the
next. (The store must create files exclusively, as HDFS and local disks do.) A commit says:

* ``whole``: the version that holds for every league that is not named;
* ``coverage``: a Parquet folder with the leagues that are named, each with its version (null: it has none),
  the stamp of the run that made it, and, if a run held the league back, that run;
* ``versions``: every version that a reader may need, with its number of buckets.

A run's stamp is the commit it started from and its time. For each league the run that started
later wins, whichever commits first, so two runs at once leave one state, that of the
later inputs. Readers resolve the last commit first and list only the versions in it; versions that nothing
refers to are deleted by ``vacuum`` once they are older than a grace time, which must be longer than a
run or a read takes.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from draftledger import files
from draftledger.operators.present import bucket_of

COVERAGE = "draft_id string, version string, base long, at long, held_by string"
#: So many leagues are named in the scan's filter; more are met by a join.
NAMED = 1000
#: The table of the cells that held a league back, one version for each run that held any.
BAD_CELLS = "_bad_cells"
#: Commits that stay in the log.
KEPT_COMMITS = 20
#: A commit file that cannot be read counts as lost, not as being written, after so long.
WRITING_SECONDS = 30


@dataclass
class Commit:
    number: int = 0
    whole: str | None = None
    base: int = -1          # stamp of the run that made ``whole``
    at: int = 0
    coverage: str | None = None
    versions: dict[str, int] = field(default_factory=dict)  # version: buckets
    schemas: dict[str, str] = field(default_factory=dict)   # table: schema as JSON
    taken: int = 0          # the highest number in the log: above ``number`` if a writer was lost while writing


def _log(root: str, number: int) -> str:
    return f"{root}/_log/{number:012d}.json"


def last_commit(spark: SparkSession, root: str) -> Commit:
    """The newest complete commit; an empty one if nothing was published."""
    found, taken = files.last_json(spark, f"{root}/_log", WRITING_SECONDS)
    return Commit(**(found or {}) | {"taken": taken})


def start(spark: SparkSession, root: str) -> tuple[int, int]:
    """The stamp of a run that reads its inputs from now on."""
    return last_commit(spark, root).number, time.time_ns()


def named(spark: SparkSession, commit: Commit) -> DataFrame:
    if commit.coverage is None:
        return spark.createDataFrame([], COVERAGE)
    return spark.read.schema(COVERAGE).parquet(commit.coverage)


def _older(base: Column, at: Column, stamp: tuple[int, int]) -> Column:
    """Whether a stamp in columns is older than ``stamp``."""
    return (base < stamp[0]) | ((base == stamp[0]) & (at < stamp[1]))


def publish(spark: SparkSession, root: str, version: str, buckets: int, schemas: dict[str, str], stamp: tuple[int, int],
            leagues: DataFrame | None = None, held: DataFrame | None = None) -> int:
    """Commits ``version`` for ``leagues`` (None: for all), except those in ``held``, which stay where they
    are. Returns the number of the commit."""
    while True:
        last = last_commit(spark, root)
        old = named(spark, last)
        whole, base, at = last.whole, last.base, last.at
        mine = F.struct(F.lit(stamp[0]).alias("base"), F.lit(stamp[1]).alias("at"))
        if held is not None:
            # where a held league is read from today
            was = held.select("draft_id").distinct().join(old, "draft_id", "left")
            stays = was.select(
                "draft_id", F.when(F.col("at").isNull(), F.lit(whole)).otherwise(F.col("version")).alias("version"),
                F.coalesce("base", F.lit(base)).cast("long").alias("base"), F.coalesce("at", F.lit(at)).cast("long").alias("at"),
                F.lit(version).alias("held_by"))
        else:
            stays = spark.createDataFrame([], COVERAGE)
        rest = old.join(stays.select("draft_id"), "draft_id", "left_anti")
        newer = rest.where(~_older(F.col("base"), F.col("at"), stamp))
        if leagues is None:
            if (base, at) < stamp:
                whole, base, at = version, stamp[0], stamp[1]
                rows = newer.unionByName(stays)
            else:  # a full run that started later was published: nothing of this one counts
                rows = old
        else:
            own = (leagues.select("draft_id").distinct().join(stays.select("draft_id"), "draft_id", "left_anti")
                   .join(newer.select("draft_id"), "draft_id", "left_anti"))
            if (base, at) > stamp:
                own = own.limit(0)
            own = own.select("draft_id", F.lit(version).alias("version"), mine["base"].alias("base"), mine["at"].alias("at"),
                             F.lit(None).cast("string").alias("held_by"))
            rows = rest.join(own.select("draft_id"), "draft_id", "left_anti").unionByName(own).unionByName(stays)
        path = f"{root}/_coverage/{uuid.uuid4().hex}"
        rows.select("draft_id", "version", F.col("base").cast("long"), F.col("at").cast("long"), "held_by").write.parquet(path)
        rows = spark.read.schema(COVERAGE).parquet(path)
        used = {r["version"] for r in rows.select("version").distinct().collect()} | {whole}  # bounded by compaction
        sizes = last.versions | {version: buckets}
        commit = Commit(last.taken + 1, whole, base, at, None if rows.isEmpty() else path, {v: sizes[v] for v in used if v},
                        last.schemas | schemas)
        if files.write_new(spark, _log(root, commit.number), json.dumps(asdict(commit))):
            return commit.number


def read(spark: SparkSession, root: str, name: str, commit: Commit | None = None, leagues: list[str] | None = None) -> DataFrame:
    """A table as published, for all leagues or only for some. Only the versions of the commit are listed."""
    commit = commit or last_commit(spark, root)
    if commit.number == 0:
        raise FileNotFoundError(f"nothing has been published under {root}")
    cover = named(spark, commit)
    some = cover.limit(NAMED + 1).collect() if commit.coverage else []
    path = f"{root}/{name}"

    if name not in commit.schemas:
        raise FileNotFoundError(f"no table {name} has been published under {root}")
    own = T.StructType.fromJson(json.loads(commit.schemas[name]))
    schema = T.StructType([*own.fields, T.StructField("version", T.StringType()), T.StructField("bucket", T.IntegerType())])

    def rows(versions: list[str]) -> DataFrame:
        df = spark.read.option("basePath", path).schema(schema).parquet(*[f"{path}/version={v}" for v in versions])
        if leagues is None:
            return df
        places = F.lit(False)
        for v in versions:
            at = [bucket_of(F.lit(lg), commit.versions[v]) for lg in leagues]
            places = places | ((F.col("version") == v) & F.col("bucket").isin(at))
        return df.where(places & F.col("draft_id").isin(leagues))

    if len(some) <= NAMED:  # the versions that are read from are few or their leagues are: named in the filter
        by: dict[str, list[str]] = {}
        for r in some:
            if leagues is None or r["draft_id"] in leagues:
                by.setdefault(r["version"], []).append(r["draft_id"])
        parts = [rows([v]).where(F.col("draft_id").isin(ids)) for v, ids in sorted(by.items(), key=str) if v]
        if commit.whole and not (leagues is not None and set(leagues) <= {r["draft_id"] for r in some}):
            others = [r["draft_id"] for r in some]
            parts.append(rows([commit.whole]).where(F.coalesce(~F.col("draft_id").isin(others), F.lit(True)) if others else F.lit(True)))
        out = spark.createDataFrame([], schema) if not parts else parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
    else:
        all_ = rows(sorted(commit.versions)).join(cover.select("draft_id", F.col("version").alias("_own"), F.lit(True).alias("_named")),
                                                  "draft_id", "left")
        out = all_.where(F.col("version") == F.when(F.col("_named"), F.col("_own")).otherwise(F.lit(commit.whole))).drop("_own", "_named")
    return out.drop("version", "bucket")


def compact(spark: SparkSession, root: str, rewrite) -> int | None:
    """Folds all versions in use into one. ``rewrite(version, commit)`` writes every table as read under
    ``commit`` and returns the number of buckets. None if another run published meanwhile."""
    last = last_commit(spark, root)
    if len(last.versions) <= 1:
        return last.number
    version = uuid.uuid4().hex
    buckets = rewrite(version, last)
    path = f"{root}/_coverage/{uuid.uuid4().hex}"
    # each league keeps its stamp, so that a run that started before still counts where it should
    rows = named(spark, last).withColumn("version", F.when(F.col("version").isNotNull(), F.lit(version)))
    rows.write.parquet(path)
    commit = Commit(last.taken + 1, version if last.whole else None, last.base, last.at, path, {version: buckets}, last.schemas)
    return commit.number if files.write_new(spark, _log(root, commit.number), json.dumps(asdict(commit))) else None


def vacuum(spark: SparkSession, root: str, grace_seconds: float) -> list[str]:
    """Deletes versions and coverage that the last commit does not refer to and that are older than the
    grace time, and all but the last commits of the log. Returns the deleted paths."""
    last = last_commit(spark, root)
    before = time.time() * 1000 - grace_seconds * 1000
    # runs whose list of bad cells is still shown; bounded by compaction like the versions
    holders = {r["held_by"] for r in named(spark, last).select("held_by").distinct().collect()}
    gone = []
    for table in files.entries(spark, root):
        keep = set(last.versions) | (holders if table.name == BAD_CELLS else set())
        for e in files.entries(spark, table.path):
            if e.name.startswith("version=") and e.name[len("version="):] not in keep and e.modified_ms < before:
                gone.append(e.path)
    kept = (last.coverage or "").rsplit("/", 1)[-1]
    gone += [e.path for e in files.entries(spark, f"{root}/_coverage") if e.name != kept and e.modified_ms < before]
    gone += [_log(root, n) for n in sorted(int(e.name[:12]) for e in files.entries(spark, f"{root}/_log") if e.name.endswith(".json"))[:-KEPT_COMMITS]]
    for path in gone:
        files.delete(spark, path)
    return gone
