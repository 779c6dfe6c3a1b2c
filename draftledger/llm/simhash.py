"""SimHash near-duplicates by bit-sliced comparison.

A document's fingerprint has a bit set when more than half of its shingle hashes have it.
Documents link when their fingerprints differ in at most ``RADIUS`` bits; a class is everything
reachable over links.

1. Equal fingerprints are one node, so a group of exact copies of any size is one row here.
2. The 64 bits are cut into four segments. Two fingerprints within two bits agree on at least two
   segments, so each fingerprint goes to six buckets, one per pair of segments, and every link
   shows in at least one of them.
3. A bucket is compared bit-sliced: plane b holds bit b of 64 fingerprints in each machine word.
   For a query the planes are turned by its own bits and added, 64 distances at a time, to
   carry-save counters (one word per binary digit of the distance). A block of 64 whose distances
   all exceed the radius is abandoned; the rest goes on. A bucket of more than ``LANES``
   fingerprints is cut into blocks, and each pair of blocks is a task's worth of work.
4. A bucket gives a spanning forest of its links, not all pairs: at most one row per member.
5. Components of the forest edges: alternating large-star and small-star rounds over DataFrames,
   each round written to the shared folder.

Defined results: null or empty text, or text of white space only, has fingerprint 0, linked like
any other; fewer words than a shingle make one shingle of all words; a null document id never
becomes a class's smallest id (a class of null ids alone has a null one); repeated rows are kept,
each with its class; columns of the input never clash with the working columns.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from draftledger.llm.common import load, materialize, pack, release, unpack

SHINGLE = 3
RADIUS = 2
LANES = 4096
HASH_SEED = 42
_SEGMENTS = [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)]


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as an unsigned integer."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only ASCII is touched
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(line, HASH_SEED)], dtype="<u8")
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
        starts = np.concatenate(([0], ends[:-shingle])).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(line[a:b - 1], HASH_SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())),
                             dtype="<u8", count=len(starts))
    set_bits = np.zeros(64, dtype=np.int64)
    for part in range(0, len(hashes), 65536):
        bits = np.unpackbits(hashes[part:part + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    bits = (2 * set_bits > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    @F.pandas_udf(T.LongType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64))

    return run.asNondeterministic()


def planes_of(prints: np.ndarray) -> np.ndarray:
    """64 planes: bit j of word w in plane b is bit b of fingerprint 64 w + j. The last word is
    filled up with the last fingerprint."""
    padded = np.concatenate([prints, np.repeat(prints[-1:], -len(prints) % 64)])
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def near_pairs(prints: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[int, int]]:
    """Index pairs i < j with at most ``radius`` different bits, by bit-sliced comparison."""
    prints = np.ascontiguousarray(prints, dtype="<u8")
    planes, n = planes_of(prints), len(prints)
    words, every = planes.shape[1], np.uint64(0xFFFFFFFFFFFFFFFF)
    digits = (radius + 1).bit_length()
    step = max(1, (1 << 18) // words)  # queries at a time: the counters stay small
    for first in range(0, n, step):
        q = np.arange(first, min(n, first + step))
        # blocks still of interest: (query, word) with lanes after the query
        query, word = np.nonzero(np.arange(words)[None, :] >= (q // 64)[:, None])
        query = q[query]
        count = [np.zeros(len(query), dtype=np.uint64) for _ in range(digits)]
        over = np.zeros(len(query), dtype=np.uint64)
        for bit in range(64):
            turn = np.where((prints[query] >> np.uint64(bit)) & np.uint64(1), every, np.uint64(0))
            carry = planes[bit, word] ^ turn
            for d in range(digits):
                count[d], carry = count[d] ^ carry, count[d] & carry
            over |= carry  # past the largest number the counters hold
            over |= _exceeds(count, radius)
            if bit % 8 == 7:
                open_ = np.flatnonzero(over != every)
                query, word, over, count = query[open_], word[open_], over[open_], [c[open_] for c in count]
        lanes = np.unpackbits((~over).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at, lane = np.nonzero(lanes)
        a, b = query[at], word[at].astype(np.int64) * 64 + lane
        for i, j in zip(a.tolist(), b.tolist()):
            if i < j < n:
                yield i, j


def _exceeds(count: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is greater than ``radius``: digit by digit from the highest."""
    greater, equal = np.zeros_like(count[0]), ~np.zeros_like(count[0])
    for d in reversed(range(len(count))):
        if not radius >> d & 1:
            greater |= equal & count[d]
            equal &= ~count[d]
        else:
            equal &= count[d]
    return greater


def forest(prints: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """(fingerprint, smallest fingerprint of its component here) for all that have a link."""
    parent = list(range(len(prints)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in near_pairs(prints.view(np.uint64), radius):
        a, b = root(i), root(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(int(prints[i]), int(prints[root(i)])) for i in range(len(prints)) if root(i) != i]


def _compare(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by bucket; a bucket is compared once its last row is seen."""
        held: list[np.ndarray] = []
        key = None

        def close():
            prints = np.unique(np.concatenate(held))
            if len(prints) > 1:
                return pd.DataFrame(forest(prints, radius), columns=["a", "b"], dtype=np.int64)
            return None

        for batch in batches:
            keys = batch[["bucket", "part"]].to_numpy()
            prints = batch["fp"].to_numpy(dtype=np.int64)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            out = []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                if key is not None and key != tuple(keys[a]):
                    out.append(close())
                    held.clear()
                key = tuple(keys[a])
                held.append(prints[a:b])
            if out := [x for x in out if x is not None and len(x)]:
                yield pd.concat(out)
        if held and (last := close()) is not None:
            yield last

    return run


def links(prints: DataFrame, radius: int = RADIUS, lanes: int = LANES) -> DataFrame:
    """Forest edges (a, b) between the distinct fingerprints in column ``fp``."""
    if radius > 2:
        raise ValueError("the buckets are exact up to two differing bits")

    def segment(i: int):
        return F.shiftrightunsigned(F.col("fp"), 16 * i).bitwiseAND(F.lit(0xFFFF).cast("long"))

    buckets = F.array(*[F.struct(F.lit(k).alias("t"), (F.shiftleft(segment(i), 16).bitwiseOR(segment(j))).alias("v"))
                        for k, (i, j) in enumerate(_SEGMENTS)])
    rows = materialize(prints.select("fp", F.inline(buckets)).select(
        "fp", (F.shiftleft(F.col("t").cast("long"), 32) + F.col("v")).alias("bucket")), "simhashbuckets")
    full = materialize(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhashcounts")
    blocks = F.ceil(F.col("n") / F.lit(lanes)).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), blocks - 1),
                        lambda other: F.least(own, other) * blocks + F.greatest(own, other))
    dealt = rows.join(full, "bucket").select("bucket", "fp", F.explode(pairs).alias("part"))
    # comparing costs far more than the rows weigh, so the number of tasks is not left to their size
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (dealt.repartition(tasks, "bucket", "part").sortWithinPartitions("bucket", "part")
            .mapInPandas(_compare(radius), "a long, b long"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the component's smallest node.

    Large-star: every node's larger neighbours move to the smallest node it knows. Small-star:
    every node joins itself and its smaller neighbours to the smallest of them. When a round
    changes nothing each component is one star. A hub's rows meet only in joins that can be
    split and in sums that are combined before the shuffle.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        seen = both if large else both.where("b < a")
        least = materialize(seen.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "componentsleast")
        met = seen.join(least, "a")
        moved = met.where("b > a") if large else met
        moved = moved.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        if not large:
            moved = moved.unionByName(least.select("a", F.col("m").alias("b")))
        return materialize(moved.where("a <> b").distinct(), "componentsedges")

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                    "componentsedges")
    before, now = None, mark(e)
    while now[0] and now != before:
        e = star(star(e, True), False)
        before, now = now, mark(e)
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
            radius: int = RADIUS, keep: list[str] | None = None) -> DataFrame:
    """Every document as struct ``row`` with fp, its class ``root`` (a fingerprint),
    component_id (smallest document id of the class) and ``first`` (true for the one row that
    stands for the class). ``keep``: the columns to carry along, all if None."""
    spark = docs.sparkSession
    marked = pack(docs, id=F.col(f"`{id_col}`"), fp=_fingerprints(shingle)(F.col(f"`{text_col}`")))
    if keep is not None:
        marked = marked.withColumn("row", F.struct(*[F.col("row")[c].alias(c) for c in keep]))
    marked = materialize(marked.withColumn("uid", F.monotonically_increasing_id()), "simhash")
    release(spark)
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "uid"))
    prints = materialize(marked.groupBy("fp").agg(best.alias("best")), "simhashprints")
    found = materialize(components(links(prints.select("fp"), radius)), "simhashcomponents")
    labels = prints.join(found, prints["fp"] == found["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "best")
    heads = materialize(labels.groupBy("root").agg(F.min("best").alias("head")), "simhashheads")
    table = materialize(labels.join(heads, "root").select(
        "fp", "root", F.col("head.id").alias("component_id"), F.col("head.uid").alias("head_uid")), "simhashlabels")
    release(spark)
    return marked.join(table, "fp").select("row", "fp", "root", "component_id",
                                           (F.col("uid") == F.col("head_uid")).alias("first"))


def dedup(docs: DataFrame, **options) -> DataFrame:
    """One document of each class: that with the smallest id."""
    return unpack(classes(docs, **options).where("first"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    found = classes(docs.select("doc_id", "text"), keep=["doc_id"])
    return found.select("row.doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
