"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Every document of a source expects the same number of copies, target / source size. Within the
source the documents stand in order of size; the running total of expected copies is shifted by
one random offset of the source, and a document is emitted once for each integer boundary its
share of the total crosses. Because the order is by size, the words taken stay within about one
large document of the target.

The running total needs a document's place in its source. A window over the source would put a
hot source into one task, so the place is put together from three counts: documents of smaller
size (one row per source and distinct size), documents of that size in earlier salts (at most
``SALTS`` rows per source and size), and the place within (source, size, salt).

Defined results: null text has size 0; a null source is a source of its own, last in order; a
null document id sorts last among documents of its size; repeated rows count as documents of
their own; an empty table gives an empty result; columns of the input never clash with the
working columns. A source of size 0 has target 0 and no copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from draftledger.llm.common import WORD, load, materialize, pack, unpack

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix"
SALTS = 4096  # three hexadecimal digits


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(totals: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """``totals``: one row (key, source, source_size) per source. Adds weight and target: shares
    of all sizes by weight, each at most ``cap`` times its source, the excess reshared by weight
    among the others until none is above.

    The fixed point is min(cap * size, level * weight) for one level. In order of cap * size /
    weight the capped sources come first; the level follows from the sums before each source.
    Windows over all rows here see one row per source, never documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights) + 1
    t = (totals.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), place))
         .withColumn("most", F.col("source_size") * cap)
         .withColumn("ratio", F.col("most").cast("double") / F.col("weight")))
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    zero = F.lit(0).cast("long")
    t = (t.withColumn("full_before", F.coalesce(F.sum("most").over(before), zero))
         .withColumn("weight_left", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), zero))
         .withColumn("level", (F.sum("source_size").over(whole) - F.col("full_before")).cast("double")
                     / F.col("weight_left")))
    # Past the first source that stays under its cap the levels only fall: the first that fits holds.
    fits = F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "source", "level"))
    first = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    t = t.withColumn("level", F.first(fits, ignorenulls=True).over(first)["level"])
    return t.select("key", "source", "source_size", "weight",
                    F.least(F.col("most").cast("double"), F.coalesce(F.col("level") * F.col("weight"),
                                                                   F.col("most").cast("double"))).alias("target"))


def plan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         size_col: str | None = None, weights=WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """Every document as struct ``row`` with size, source_size, target and copies. Sizes are
    words of ``text_col`` unless ``size_col`` names a column that has them."""
    size = F.col(f"`{size_col}`") if size_col else words(F.col(f"`{text_col}`"))
    sized = pack(docs, id=F.col(f"`{id_col}`"), source=F.col(f"`{source_col}`").cast("string"), size=size)
    key = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source")))
    salt = F.substring(F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")), 1, 3)
    sized = sized.withColumn("key", key).withColumn("salt", salt)

    cells = materialize(sized.groupBy("key", "source", "size", "salt").agg(F.count(F.lit(1)).alias("n")), "mixcells")
    totals = cells.groupBy("key", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    sources = water_fill(totals, weights, cap)
    offset = (F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("key")).cast("binary")), 1, 8), 16, 10)
              .cast("double") / F.lit(4294967296.0))
    sources = materialize(sources.withColumn("offset", offset).withColumn(
        "expected", F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(F.col("target") / F.col("source_size"))),
        "mixsources")

    earlier = (Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    by_size = (cells.groupBy("key", "size").agg(F.sum("n").alias("n"))
               .withColumn("smaller", F.coalesce(F.sum("n").over(
                   Window.partitionBy("key").orderBy("size").rowsBetween(*earlier)), zero)).drop("n"))
    by_salt = cells.drop("source").withColumn("same", F.coalesce(F.sum("n").over(
        Window.partitionBy("key", "size").orderBy("salt").rowsBetween(*earlier)), zero)).drop("n")
    before = by_salt.join(by_size, ["key", "size"]).join(sources.drop("source", "weight"), "key")

    within = Window.partitionBy("key", "size", "salt").orderBy(F.col("id").asc_nulls_last())
    placed = sized.drop("source").join(before, ["key", "size", "salt"]).withColumn(
        "place", F.col("smaller") + F.col("same") + F.row_number().over(within))
    upto = F.floor(F.col("expected") * F.col("place") + F.col("offset"))
    behind = F.floor(F.col("expected") * (F.col("place") - 1) + F.col("offset"))
    return placed.select("row", "size", "source_size", "target", (upto - behind).cast("int").alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document once per boundary crossed, numbered in ``copy``."""
    p = plan(docs, **options)
    p = p.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return unpack(p, "copy")


def query(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    # the text is only counted: (id, source, size) is what the later passes read
    lean = materialize(docs.select("doc_id", "source", words(F.col("text")).alias("size")), "mixsizes")
    p = plan(lean, size_col="size")
    return p.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
t AS (SELECT key, source, sum(size)::BIGINT AS source_size FROM d GROUP BY key, source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM t),
r AS (SELECT *, source_size * 3 AS most, (source_size * 3)::DOUBLE / weight AS ratio FROM w),
l AS (
  SELECT a.*, ((SELECT sum(source_size) FROM r) - coalesce((SELECT sum(b.most) FROM r b WHERE b.ratio < a.ratio), 0))::DOUBLE
         / ((SELECT sum(b.weight) FROM r b WHERE b.ratio >= a.ratio))::DOUBLE AS level
  FROM r a),
g AS (
  SELECT key, source_size, least(most::DOUBLE, coalesce(
           (SELECT arg_min(level, ratio) FROM l WHERE level <= ratio) * weight, most::DOUBLE)) AS target
  FROM l),
e AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0.0 ELSE target / source_size END AS expected,
         ('0x' || substr(md5('mix' || key), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS shift
  FROM g),
p AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.expected, e.shift,
         row_number() OVER (PARTITION BY d.key ORDER BY d.size, substr(md5(coalesce(d.doc_id::VARCHAR, '')), 1, 3),
                            d.doc_id NULLS LAST) AS place
  FROM d JOIN e USING (key))
SELECT doc_id, size, source_size, target,
       (size * (floor(expected * place + shift) - floor(expected * (place - 1) + shift)))::BIGINT AS taken
FROM p
"""
