"""Sharding, fill-in-middle and the filter audit against brute force, and on hard rows."""

import hashlib
import itertools
import math
import os
import random
import re
import sys
import zlib
from collections import Counter

import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hard_rows import ROWS, own_columns_kept, rows  # noqa: E402

from draftledger.llm import audit, fim, shards  # noqa: E402

SF = "/root/testdata/sf0.001"


# ---- sharding

def slow_shard(key, tree):
    """Descends by drawing for every entry."""
    some, path, at = [s for s in tree.shards if s.weight > 0], "", 0

    def time(name, weight):
        seed = 42 if key is None else xxhash.xxh64_intdigest(key.encode(), 42)
        return -math.log(((xxhash.xxh64_intdigest(name.encode(), seed) >> 11) + 0.5) / 2.0 ** 53) / weight

    for level in ("region", "rack"):
        names = sorted({(getattr(s, level), s.epoch) for s in some})
        drawn = {(n, e): time(f"{path}/{n}#{e}", sum(s.weight for s in some if (getattr(s, level), s.epoch) == (n, e))) for n, e in names}
        n, e = min(drawn, key=drawn.get)
        path, some = f"{path}/{n}#{e}", [s for s in some if (getattr(s, level), s.epoch) == (n, e)]
    return min(some, key=lambda s: time(f"{path}/{s.number}", s.weight)).number


def keys(spark, n=20_000):
    return spark.range(n).select(F.col("id").cast("string").alias("id"))


def moved(spark, a, b, n=20_000):
    k = F.col("id")
    out = keys(spark, n).select("id", shards.shard_of(k, a).alias("a"), shards.shard_of(k, b).alias("b"))
    return [(r["a"], r["b"]) for r in out.collect()]


def test_shards_against_brute_force(spark):
    out = shards.query(spark, SF).collect()
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    tree, grown = shards.Tree.of(16), shards.Tree.of(17)
    assert len(out) == len(docs)
    for r in out:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert (r["shard"], r["grown_shard"]) == (slow_shard(str(r["doc_id"]), tree), slow_shard(str(r["doc_id"]), grown))
    for shard in range(16):
        own = sorted(r["slot"] for r in out if r["shard"] == shard)
        assert own == list(range(len(own)))
    assert out and sorted(map(str, out)) == sorted(map(str, shards.query(spark, SF).collect()))


def test_shard_sizes_follow_weights(spark):
    tree = shards.Tree((shards.Shard(0, "x", "a", 1.0), shards.Shard(1, "x", "b", 3.0), shards.Shard(2, "y", "a", 4.0), shards.Shard(3, "y", "a", 0.0)))
    n = Counter(a for a, _ in moved(spark, tree, tree))
    assert [round(n[i] / 20_000 * 8) for i in range(4)] == [1, 3, 4, 0]


def test_a_new_shard_takes_rows_only_into_itself(spark):
    tree = shards.Tree.of(16)
    later = [tree.grown(), tree.grown("r2", "k1"), tree.grown("r9", "k0", 2.0), tree.grown().grown(), tree.grown("r1", "k7")]
    for t in later:
        new = {s.number for s in t.shards} - {s.number for s in tree.shards}
        gone = [(a, b) for a, b in moved(spark, tree, t, 8000) if a != b]
        assert gone and all(b in new for _, b in gone)
    # each step of growth alone, too
    assert all(b == 18 for a, b in moved(spark, shards.Tree.of(18), shards.Tree.of(19), 8000) if a != b)


def test_a_changed_weight_moves_rows_of_its_subtree_only(spark):
    tree = shards.Tree.of(16)
    more = [(a, b) for a, b in moved(spark, tree, tree.weighted(5, 2.5)) if a != b]
    assert more and all(b == 5 for _, b in more)
    place = {s.number: s.region for s in tree.shards}
    less = [(a, b) for a, b in moved(spark, tree, tree.weighted(5, 0.5)) if a != b]
    assert less and all(place[a] == place[5] for a, _ in less)
    assert not [b for _, b in moved(spark, tree, tree.weighted(5, 0.0)) if b == 5]


def test_shards_of_hard_rows(spark, tmp_path):
    out = shards.numbered(shards.assign(shards.measured(rows(spark)), shards.Tree.of(16), shards.Tree.of(17))).collect()
    assert len(out) == len(ROWS)
    assert {r["size"] for r in out if r["row"]["text"] is None} == {1} and {r["text_crc32"] for r in out if not r["row"]["text"]} == {0}
    for shard in {r["shard"] for r in out}:
        assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in out)))
    assert len({r["shard"] for r in out if r["row"]["doc_id"] is None}) == 1
    assert shards.numbered(shards.assign(shards.measured(rows(spark, empty=True)), shards.Tree.of(16))).count() == 0
    back = shards.write(rows(spark), str(tmp_path / "sharded"))
    assert back.count() == len(ROWS) and own_columns_kept(back)


def test_many_equal_rows_are_numbered_by_many_tasks(spark):
    same = spark.range(30_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    out = shards.numbered(shards.assign(shards.measured(same), shards.Tree.of(16)))
    assert out.agg(F.countDistinct("slot"), F.min("slot"), F.max("slot")).first() == (30_000, 0, 29_999)


# ---- fill-in-middle

def slow_rearranged(text, key):
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h = hashlib.sha256(f"1:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or h3 % 100 >= 90 or any(x in text for x in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fenwick_descent_against_brute_force():
    r = random.Random(1)
    for block in (1, 2, 3, 5, 8, 4096):
        for i in range(120):
            text = "".join(r.choice("abZ .\n<PM>é\U0001f600字") * r.choice([1, 1, 1, 9]) for _ in range(r.randrange(60)))
            assert fim.rearrange(text, str(i), block=block) == slow_rearranged(text, str(i))
            units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
            tree = fim.Fenwick(text, block)
            assert [tree.place(k) for k in range(len(units) + 1)] == [len("".join(units[:k])) for k in range(len(units) + 1)]


def test_fim_on_documents_and_hard_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for df in (docs, rows(spark)):
        out = fim.transform(df)
        out = out.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
        assert len(out) == df.count()
        for x in out:
            text, key = x["row"]["text"] or "", "" if x["row"]["doc_id"] is None else str(x["row"]["doc_id"])
            assert (x["n"], x["form"], x["prefix_chars"], x["middle_chars"], x["output"]) == slow_rearranged(text, key)
            assert x["back"] == text
    assert {r["form"] for r in fim.query(spark, SF).select("form").distinct().collect()} == {"plain", "psm", "spm"}
    new = fim.rearranged(rows(spark))
    assert own_columns_kept(new) and new.where("text is null").count() == sum(r[1] is None for r in ROWS)
    assert fim.transform(rows(spark, empty=True)).count() == 0


def test_fim_of_one_very_long_word_and_of_one_very_long_text():
    for text in ("x" * 3_000_000, "ab1 " * 700_000):
        key = next(str(i) for i in range(50) if fim.rearrange(text[:99], str(i))[1] == "psm")
        n, form, p, m, out = fim.rearrange(text, key)
        assert (n, form, p, m, out) == slow_rearranged(text, key)


# ---- filter audit

def slow_audit(docs, labels):
    """docs: (id, text, source); labels: (id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    info = []
    for i, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
                 "E": text in least and (i is None or i > least[text])}
        info.append((source or "", {f for f, x in fails.items() if x}, i in good, i in toxic))
    out = {}
    for part in {x[0] for x in info}:
        own = [x[1:] for x in info if x[0] == part]
        shapley = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for k, f in enumerate(order):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                shapley[f] += len(gone)
                out[part, order, k + 1] = (len(left), len(gone), sum(f in x[0] for x in own) - len(gone), sum(x[0] == {f} for x in own),
                                           sum(x[1] for x in gone), sum(x[2] for x in gone), f)
        for key, v in out.items():
            if key[0] == part:
                out[key] = (*v[:6], shapley[v[6]])
    return out


def got(df):
    cols = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in cols) for r in df.collect()}


def test_audit_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality", "toxic")
    want = slow_audit([tuple(r) for r in docs.collect()], [tuple(r) for r in labels.collect()])
    assert got(audit.audit(docs, labels)) == want


def test_audit_of_hard_rows(spark):
    some = [(None, 1, 1), (1, None, 1), (1, 1, 0), (1, 1, 0), (5, 0, 1), (9, 1, None), (77, 1, 1)]
    labels = spark.createDataFrame(some, "doc_id long, quality int, toxic int")
    want = slow_audit([(r[0], r[1], r[3]) for r in ROWS], some)
    assert got(audit.audit(rows(spark), labels)) == want
    assert audit.audit(rows(spark, empty=True), labels.limit(0)).count() == 0


def test_audit_copies_hot_and_cold(spark):
    r = random.Random(2)
    data = [(i if r.random() < 0.9 else None, r.choice(["hot"] * 5 + [f"t{r.randrange(40)}", ""]), r.choice("ab")) for i in range(3000)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(5)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert got(audit.audit(docs, labels)) == slow_audit(data, [])


def test_survivors_of_some_filters(spark):
    filters = {"short": F.length("text") < 3, "digit": F.col("text").rlike("[0-9]")}
    docs = spark.createDataFrame([(1, "a", "s"), (2, "abcd", "s"), (3, "abc1", "s"), (4, "1", "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    m = audit.labelled(audit.measured(docs, filters), labels)
    folder = f"{spark.sparkContext.getCheckpointDir()}/fails-{random.random()}"
    fails = audit.failing(m, list(filters), folder)
    assert [r["id"] for r in audit.survivors(m, fails, ["short"]).orderBy("id").collect()] == [2, 3]
    assert [r["id"] for r in audit.survivors(m, fails, ["short", "digit"]).collect()] == [2]
