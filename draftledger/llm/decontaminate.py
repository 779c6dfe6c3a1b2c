"""Benchmark decontamination with a generalised suffix automaton over the test items.

The automaton holds every run of consecutive words of every item. A document's words are
streamed through it; after each word the state and the length of the longest run that ends
there and occurs in some item are known, so every item window that ends there is known too.
A window is ``window`` consecutive words of an item; an item of fewer words is one window.

Size: an automaton covers items of at most ``MAX_WORDS`` words in all and is broadcast. A larger
benchmark is dealt over several automata, one pass over the documents each, with the findings
written in between, so no broadcast exceeds the bound.

Defined results: null or empty text has no words and no hits; an empty benchmark gives no hits;
items without words are ignored; repeated items count once by id; an item with a null id marks
words but is not listed; repeated documents are judged row by row; columns of the input never
clash with the working columns; texts are read whole, whatever their length.
"""

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from draftledger.llm.common import load, materialize, pack, unpack

WINDOW = 10
MAX_WORDS = 2_000_000
#: A document that loses more than this share of its words is dropped whole.
MAX_COVERAGE = 0.5

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {i: i + 32 for i in range(65, 91)}
#: Byte table: A-Z to lower case, everything that is no word byte to a space.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split()


class Automaton:
    """Suffix automaton of all items; ``owners`` names the items of a window's state."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window, self.vocab = window, {}
        self.next, self.link, self.length = [{}], [-1], [0]
        runs = [(key, [self.vocab.setdefault(w, len(self.vocab)) for w in words]) for key, words in items if words]
        for _, run in runs:
            last = 0
            for c in run:
                last = self._extend(last, c)
        n = len(self.next)
        self.owners: dict[int, set] = {}
        self.short: dict[int, list[tuple[int, set]]] = {}
        full = self._window_states(window)
        for key, run in runs:
            v = 0
            for i, c in enumerate(run):
                v = self.next[v][c]
                if i + 1 >= window:
                    self.owners.setdefault(full[v], set()).add(key)
            if len(run) < window:
                while self.length[self.link[v]] >= len(run):
                    v = self.link[v]
                for size, keys in self.short.setdefault(v, []):
                    if size == len(run):
                        keys.add(key)
                        break
                else:
                    self.short[v].append((len(run), {key}))
        self.full = full
        # the nearest state at or above each one that ends a short item
        self.above = [-1] * n
        for v in sorted(range(1, n), key=self.length.__getitem__):
            self.above[v] = v if v in self.short else self.above[self.link[v]]

    def _new(self, length: int, like: int | None = None) -> int:
        self.next.append(dict(self.next[like]) if like is not None else {})
        self.link.append(self.link[like] if like is not None else 0)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, c: int) -> int:
        """The state of the longest run of ``p`` followed by ``c``, split off if need be."""
        q = self.next[p][c]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._new(self.length[p] + 1, q)
        self.link[q] = clone
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, c)
        cur, p = self._new(self.length[last] + 1), last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        self.link[cur] = 0 if p == -1 else self._split(p, c)
        return cur

    def _window_states(self, window: int) -> list[int]:
        """For each state the state at or above it that holds its last ``window`` words."""
        out = [-1] * len(self.next)
        for v in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            if self.length[v] >= window:
                out[v] = v if self.length[self.link[v]] < window else out[self.link[v]]
        return out

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Runs [a, b) of hit words, and the items whose windows occur."""
        nxt, link, length, above, window = self.next, self.link, self.length, self.above, self.window
        v = n = 0
        ends, states, items = [], set(), set()
        for i, c in enumerate(map(self.vocab.get, words)):
            if c is None:
                v = n = 0
                continue
            u = nxt[v].get(c)
            if u is None:
                while v and c not in nxt[v]:
                    v = link[v]
                n, v = length[v] + 1, nxt[v][c]  # every known word leaves the start
            else:
                v = u
                n += 1
            if n >= window:
                ends.append((i + 1 - window, i + 1))
                states.add(self.full[v])
            u = above[v]
            while u != -1:
                for size, keys in self.short[u]:
                    if size <= n:
                        ends.append((i + 1 - size, i + 1))
                        items |= keys
                u = above[link[u]]
        for s in states:
            items |= self.owners[s]
        return merged(ends), items


def merged(runs) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


#: ``runs`` has the bounds of the hit runs of words one after the other: a, b, a, b ...
FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(T.IntegerType())),
                      T.StructField("items", T.ArrayType(T.StringType()))])


def _pass(automaton):
    """One pass: adds what one broadcast automaton finds to what is there."""

    @F.pandas_udf(FOUND)
    def find(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        a = Automaton.__new__(Automaton)
        a.__dict__.update(automaton.value)
        for texts, before in batches:
            rows = []
            for text, runs, items in zip(texts, before["runs"], before["items"]):
                words = words_of(text) if text else []
                found, keys = a.scan(words)
                if len(runs):
                    found = merged(found + list(zip(runs[::2], runs[1::2])))
                rows.append((len(words), [int(x) for r in found for x in r],
                             sorted({k for k in keys if k is not None} | set(items))))
            yield pd.DataFrame(rows, columns=["n_words", "runs", "items"])

    return find.asNondeterministic()


def _item_words(text: str) -> list[bytes]:
    return words_of(text) if text else []


def automata(benchmark: DataFrame, window: int, max_words: int, id_col: str, text_col: str):
    """Bounded automata that cover the whole benchmark, built one after the other."""
    text = F.col(f"`{text_col}`")
    items = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("id"), text.alias("text")).where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] // 2  # a word and its gap: 2 characters at least
    shards = total // max_words + 1
    for shard in range(shards):
        part = items if shards == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(shards)) == shard)
        yield Automaton([(r["id"], _item_words(r["text"])) for r in part.distinct().toLocalIterator()], window)


def scan(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_id: str = "item_id",
         item_text: str = "text", window: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """Every document as struct ``row`` with ``text`` and ``found``: number of words, hit runs
    of words, items whose windows occur."""
    spark = docs.sparkSession
    empty = F.struct(F.lit(0).cast("long").alias("n_words"),
                     F.array().cast("array<int>").alias("runs"),
                     F.array().cast("array<string>").alias("items"))
    out = pack(docs, text=F.col(f"`{text_col}`")).withColumn("found", empty)
    passes = 0
    for a in automata(benchmark, window, max_words, item_id, item_text):
        if passes:
            out = materialize(out, "decontaminate")
        find = _pass(spark.sparkContext.broadcast(vars(a)))
        out = out.select("row", "text", find("text", "found").alias("found"))
        passes += 1
    return out


@F.pandas_udf(T.StringType())
def _cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """The text without the hit runs of words; the text between is kept as it is."""
    for texts, all_runs in batches:
        out = []
        for text, runs in zip(texts, all_runs):
            if text and len(runs):
                at = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
                keep, behind = [], 0
                for a, b in zip(runs[::2], runs[1::2]):
                    keep.append(text[behind:at[a][0]])
                    behind = at[b - 1][1]
                text = "".join([*keep, text[behind:]])
            out.append(text)
        yield pd.Series(out, dtype=object)


def n_hit():
    return F.aggregate(F.transform("found.runs", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)),
                       F.lit(0).cast("long"), lambda s, x: s + x)


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text",
                  max_coverage: float = MAX_COVERAGE, **options) -> DataFrame:
    """Documents without the runs of words that match; those of which more than
    ``max_coverage`` of all words match are dropped. Untouched texts stay as they are."""
    found = scan(docs, benchmark, text_col=text_col, **options).withColumn("n_hit", n_hit())
    kept = found.where(F.col("n_hit") <= F.col("found.n_words") * max_coverage)
    cut = kept.withColumn("text", F.when(F.col("n_hit") == 0, F.col("text")).otherwise(_cut("text", "found.runs")))
    return unpack(cut.withColumn("row", F.col("row").withField(f"`{text_col}`", F.col("text"))))


def query(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, load(spark, sf_dir, "benchmark"))
    ids = F.array_sort("found.items")
    return found.select("row.doc_id", "found.n_words", n_hit().alias("n_hit"),
                        F.size("found.items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
                        (n_hit() > 0).alias("contaminated"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
k AS (SELECT item_id, least(len(w), 10) AS n, w FROM b WHERE len(w) > 0),
p AS (SELECT DISTINCT item_id, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS win
      FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM k)),
s AS (SELECT DISTINCT n FROM p),
g AS (SELECT r, n, i, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS win
      FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, s WHERE len(w) >= n)),
h AS (SELECT g.r, g.n, g.i, p.item_id FROM g JOIN p ON g.n = p.n AND g.win = p.win),
hit AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM h) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
       FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM h) GROUP BY r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(hit.n_hit, 0)::BIGINT AS n_hit,
       coalesce(it.n_items, 0)::BIGINT AS n_items, sha256(coalesce(it.ids, '')) AS items_sha256,
       coalesce(hit.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""
