"""Filter interaction audit by failing-id relations.

Filters that are applied one after the other hide each other: what the third removes depends on the
first two. One table of failing rows is stored for every filter, and joins with these tables
answer for every set of filters that may stand before a step:

* survivors: rows left-anti joined with the tables of the set;
* removed by a filter: its failing rows left-anti joined with the set's tables, with the good and toxic
  ones among them;
* redundant: its failing rows left-semi joined with them, i.e. removed before.

What happened before a step depends on the set, not its order, so with n filters there are
n * 2^(n-1) cases and not n * n!. A row of a relation stands once for each set it is asked about,
as a bit mask; one anti and one semi join on the row number with "the other's filter is in the
mask" decide all cases of a relation at once. Everything is partitioned by the row
number, which no two rows share, so copies, hot sources or repeated ids meet in no task.

The duplicates filter compares digests of whole texts (SHA-256). Digests that hold over a
``1 / HOT`` part of all rows, of which there can be at most ``HOT``, are broadcast; the others are
shuffled, so that no task sees a large group of copies.

Defined results: null text is empty; a null source is the part ''; a null id counts as larger than every id
and has no label; rows with equal ids are no copies of each other; of several labels of one id any that
says 1 counts; an empty table gives an empty result; texts are read whole; columns of the input never clash with
the working columns.
"""

from __future__ import annotations

import itertools
import math
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from draftledger.llm.common import WORD, load, materialize
from draftledger.session import shared_dir

MIN_WORDS = 200
LEAST_DISTINCT, MOST_CAPITALS = 50, 2  # of a hundred words, of a hundred code points
SYMBOLS = r"[#$%&*|]"
#: The name of the filter that duplicates fail; it needs other rows, so it has no condition.
COPIES = "E"
HOT = 1000


def conditions(text: Column) -> dict[str, Column]:
    """Filters by name: the condition that a failing text meets; None for duplicates."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > MOST_CAPITALS * F.length(text),
        "D": text.rlike(SYMBOLS),
        COPIES: None,
    }


def measured(docs: DataFrame, filters: dict, *, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """One short row per document: uid, id, part, digest and the bits of the filters with a condition."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    bits = F.lit(0)
    for i, condition in enumerate(filters.values()):
        if condition is not None:
            bits = bits + F.when(condition, 1 << i).otherwise(0)
    return materialize(docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), bits.alias("bits")), "auditrows")


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """With ``good`` and ``toxic`` (0 or 1)."""
    marks = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("_key"))
             .agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
                  F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")))
    # rows without an id get a key of their own each, so that they do not meet in one task
    key = F.when(F.col("id").isNull(), F.concat(F.lit("n"), F.col("uid").cast("string"))).otherwise(
        F.concat(F.lit("d"), F.col("id").cast("string")))
    out = rows.withColumn("_key", key).join(marks, "_key", "left").drop("_key")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})


def copies(rows: DataFrame) -> DataFrame:
    """The rows whose text a row with a smaller id has."""
    total = rows.count()
    repeated = materialize(
        rows.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count(F.lit(1)).alias("n"),
                                   F.count("id").alias("known"))
        .where((F.col("least") < F.col("most")) | ((F.col("known") > 0) & (F.col("known") < F.col("n"))))
        .select("digest", "least", "n"), "auditcopies")
    hot = F.broadcast(repeated.where(F.col("n") * HOT > total).select("digest", "least"))  # at most HOT rows
    cold = repeated.where(F.col("n") * HOT <= total).select("digest", "least")
    pairs = rows.join(hot, "digest").unionByName(rows.join(hot.select("digest"), "digest", "left_anti").join(cold, "digest"))
    return pairs.where(F.col("id").isNull() | (F.col("id") > F.col("least"))).drop("least")


def failing(rows: DataFrame, names: list[str], folder: str) -> DataFrame:
    """The failing-id tables, one folder ``filter=<name>`` each, read back with the filter's number ``f``."""
    keep = ["uid", "part", "good", "toxic"]
    own = rows.withColumn("filter", F.explode(F.filter(
        F.array(*[F.when(F.col("bits").bitwiseAND(1 << i) != 0, F.lit(name)) for i, name in enumerate(names) if name != COPIES]),
        lambda x: x.isNotNull()))).select(*keep, "filter")
    if COPIES in names:
        own = own.unionByName(copies(rows).select(*keep, F.lit(COPIES).alias("filter")))
    own.write.partitionBy("filter").parquet(folder)
    number = F.create_map(*itertools.chain(*[(F.lit(n), F.lit(i)) for i, n in enumerate(names)]))
    schema = "uid long, part string, good int, toxic int, filter string"
    return rows.sparkSession.read.schema(schema).parquet(folder).withColumn("f", F.element_at(number, F.col("filter")))


def survivors(rows: DataFrame, fails: DataFrame, names: list[str]) -> DataFrame:
    """The rows that no filter in ``names`` removes."""
    return rows.join(fails.where(F.col("filter").isin(names)), "uid", "left_anti")


def _masks(n: int, without: int | None = None) -> list[int]:
    return [m for m in range(1 << n) if without is None or not m >> without & 1]


def cases(rows: DataFrame, fails: DataFrame, n: int) -> DataFrame:
    """Counts by part, filter and mask of the filters before it (filter -1: survivors of the mask)."""
    # partitioned by row number first, then asked about every mask: the joins shuffle nothing more
    known = fails.repartition("uid")
    other = known.select(F.col("uid").alias("_uid"), F.col("f").alias("_f"))
    sets = F.array(*[F.array(*[F.lit(m) for m in _masks(n, f)]) for f in range(n)])
    asked = known.select("uid", "part", "good", "toxic", "f", F.explode(F.get(sets, F.col("f"))).alias("mask"))
    every = rows.select("uid", "part").repartition("uid").select(
        "uid", "part", F.explode(F.array(*[F.lit(m) for m in _masks(n)])).alias("mask"))
    before = (F.col("uid") == F.col("_uid")) & (F.col("mask").bitwiseAND(F.call_function("shiftleft", F.lit(1), F.col("_f"))) != 0)
    zero, by = F.lit(0).cast("long"), ["part", "f", "mask"]
    count = F.count(F.lit(1))
    left = every.join(other, before, "left_anti").withColumn("f", F.lit(-1)).groupBy(*by).agg(
        count.alias("kept"), *[zero.alias(c) for c in ("removed", "redundant", "good_lost", "toxic_lost")])
    removed = asked.join(other, before, "left_anti").groupBy(*by).agg(
        zero.alias("kept"), count.alias("removed"), zero.alias("redundant"), F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost"))
    redundant = asked.join(other, before, "left_semi").groupBy(*by).agg(
        zero.alias("kept"), zero.alias("removed"), count.alias("redundant"), zero.alias("good_lost"), zero.alias("toxic_lost"))
    return left.unionByName(removed).unionByName(redundant)


def _steps(names: list[str]) -> list[tuple[str, int, int, int]]:
    """(order, step, filter, mask of the filters before it) of every step of every order."""
    out = []
    for order in itertools.permutations(range(len(names))):
        for k, f in enumerate(order):
            out.append(("".join(names[i] for i in order), k + 1, f, sum(1 << i for i in order[:k])))
    return out


def report(counts: DataFrame, names: list[str]) -> DataFrame:
    """One row per part, order and step."""
    n = len(names)
    sums = counts.groupBy("part", "f", "mask").agg(*[F.sum(c).alias(c) for c in ("kept", "removed", "redundant", "good_lost", "toxic_lost")])
    # a part has at most 2^n + 2 n 2^(n-1) cases
    table = sums.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct(
        F.struct("f", "mask"), F.struct("kept", "removed", "redundant", "good_lost", "toxic_lost")))).alias("case"))

    def of(f: Column, mask: Column, field: str) -> Column:
        return F.coalesce(F.try_element_at(F.col("case"), F.struct(f.alias("f"), mask.alias("mask")))[field], F.lit(0).cast("long"))

    def shapley(f: int) -> Column:
        return sum((F.lit(math.factorial(m.bit_count()) * math.factorial(n - 1 - m.bit_count())) * of(F.lit(f), F.lit(m), "removed")
                    for m in _masks(n, f)), F.lit(0).cast("long"))

    table = table.withColumn("_shapley", F.array(*[shapley(f) for f in range(n)]))
    steps = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(k).alias("step"), F.lit(f).alias("f"), F.lit(m).alias("mask"))
                      for o, k, f, m in _steps(names)])
    rows = table.withColumn("_s", F.explode(steps)).select("part", "case", "_shapley", "_s.*")
    f, mask = F.col("f"), F.col("mask")
    own = F.call_function("shiftleft", F.lit(1), f)
    return rows.select(
        "part", "filter_order", "step", of(F.lit(-1), mask + own, "kept").alias("kept"), of(f, mask, "removed").alias("removed"),
        of(f, mask, "redundant").alias("redundant"), of(f, F.lit((1 << n) - 1) - own, "removed").alias("unique_fails"),
        of(f, mask, "good_lost").alias("good_lost"), of(f, mask, "toxic_lost").alias("toxic_lost"),
        F.get("_shapley", f).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, filters: dict | None = None, *, text_col: str = "text", **options) -> DataFrame:
    """The report over all orders of ``filters`` (name: condition that a failing row meets; None for
    the duplicates filter, which is named ``COPIES``)."""
    filters = filters or conditions(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    names = list(filters)
    rows = materialize(labelled(measured(docs, filters, text_col=text_col, **options), labels), "auditlabelled")
    folder = f"{shared_dir(docs.sparkSession).rstrip('/')}/tables/auditfails-{uuid.uuid4().hex}"
    fails = failing(rows, names, folder)
    return report(materialize(cases(rows, fails, len(names)), "auditcases"), names)


def query(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return audit(docs, load(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT d.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
         (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
         + 4 * (100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), min(d.doc_id) OVER (PARTITION BY text) IS NOT NULL)::INT AS bits
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
s AS (SELECT part, bits, good, toxic, count(*) AS n FROM f GROUP BY ALL),
letter AS (SELECT unnest(range(5))::INT AS i),
o AS (
  SELECT a.i AS a, b.i AS b, c.i AS c, e.i AS d, g.i AS e FROM letter a, letter b, letter c, letter e, letter g
  WHERE len(list_distinct([a.i, b.i, c.i, e.i, g.i])) = 5),
t AS (
  SELECT array_to_string(list_transform([a, b, c, d, e], lambda x: substr('ABCDE', x + 1, 1)), '') AS filter_order, step,
         [a, b, c, d, e][step] AS f, list_sum(list_transform([a, b, c, d, e][1:step - 1], lambda x: 1 << x)) AS before
  FROM o, (SELECT unnest(range(1, 6))::INT AS step)),
u AS (SELECT filter_order, step, f, coalesce(before, 0)::INT AS mask, (1 << f) AS own FROM t),
r AS (
  SELECT s.part, u.filter_order, u.step, u.f,
         sum(CASE WHEN bits & (mask + own) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN bits & mask = 0 AND bits & own <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN bits & mask <> 0 AND bits & own <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN bits = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN bits & mask = 0 AND bits & own <> 0 THEN n * good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN bits & mask = 0 AND bits & own <> 0 THEN n * toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM s, u GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley
FROM r
"""
