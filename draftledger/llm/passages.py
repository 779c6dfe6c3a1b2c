"""Repeated passages, byte by byte: merged Burrows-Wheeler transforms of shared windows.

A byte goes when it lies in a string of ``LENGTH`` bytes that also starts in a document with a
smaller id. Sorting every suffix of a corpus in one place is out of the question, so the suffixes
are dealt so that equal ones meet, and only those that can repeat are looked at:

1. Texts are packed into batches of some megabytes and written once; a batch is the unit that
   later steps read again.
2. The key of a window of ``LENGTH`` bytes is the least hash of its ``GRAM``-byte pieces, so it depends on
   the window alone. Runs of windows with one key are one string of at most ``LONGEST`` bytes.
   Every batch reports its keys, each once; keys that more than one document has are shared. What comes
   back to a batch is one bit for each of its keys.
3. Every batch sends the strings of shared keys, each once, with its smallest document id. They
   are dealt by key; a batch's strings in a bucket are one shard.
4. In a bucket, shard by shard, the Burrows-Wheeler transform of the strings is built; the
   transforms are merged by refining the interleave (Holt and McMillan): each round
   reads the next symbols before the rows of all transforms in the current order and sorts the rows
   stably by them, ``STEP`` symbols a round, so that after k rounds the rows stand in the order of
   their first k steps. Rows part where a symbol or an earlier part differs, which yields the
   common prefixes; rows still together after ``LENGTH`` symbols are one repeated interval, and its
   smallest id is every member's.
5. Batches read the intervals' smallest ids back and remove the windows with a smaller id than
   their document's.

A passage that any number of documents share is one string per batch, so no bucket or task sees
all its copies. A batch has at most one row per bucket, and never more than it has keys.

Defined results: null text is empty; texts under ``LENGTH`` bytes lose nothing; a null id counts as
larger than every id; rows with equal ids do not take from each other; an empty table gives an
empty result; only the id and the text are read, so other columns cannot clash.
"""

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from draftledger.llm.common import load, materialize, release

LENGTH = 50
GRAM = 24
LONGEST = 2 * LENGTH - GRAM
SPREAD = LENGTH - GRAM + 1  # pieces of a window
CHUNK = 1 << 15
BATCH_BYTES = 4 * 1024 * 1024
BUCKET_BYTES = 32 * 1024 * 1024
MIN_BUCKETS = 64
#: Strings that are merged in one go: their rows fit a processor's cache and two-byte ranks. The
#: merge refines by so many symbols a round.
MERGE_STRINGS, SHARDS, STEP = 800, 8, 5
_BITS = 56
_LAST = np.iinfo(np.int64).max
_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= _MULTIPLIERS[1]
    h ^= h >> np.uint64(29)
    h *= _MULTIPLIERS[2]
    return h ^ (h >> np.uint64(32))


def _grams(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from every position on, from hashes of 8 and 16 bytes."""
    h = (data.astype(np.uint64) + np.uint64(1)) * _MULTIPLIERS[0]
    by = {}
    for size in (1, 2, 4, 8):
        h = h[:-size] * _MULTIPLIERS[3] + h[size:]
        h ^= h >> np.uint64(27)
        by[2 * size] = h
    return _mix(by[16][:len(data) - GRAM + 1] * _MULTIPLIERS[1] + by[8][16:])


def _least(data: np.ndarray) -> np.ndarray:
    """The least hash of the pieces of every window, by doubling the number of pieces."""
    low, size = _grams(data), 1
    while 2 * size <= SPREAD:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    n = len(data) - LENGTH + 1
    return np.minimum(low[:n], low[SPREAD - size:][:n])


def runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, text, start, windows) of the runs in texts that lie end to end in ``data``."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < LENGTH:
        return none.astype(np.uint64), none, none, none
    # some windows at a time, so that the hashes stay in a processor's cache
    low = np.concatenate([_least(data[at:at + CHUNK + LENGTH - 1]) for at in range(0, len(data) - LENGTH + 1, CHUNK)])
    first = np.concatenate(([0], ends[:-1]))
    text = np.repeat(np.arange(len(ends)), ends - first)[:len(low)]
    inside = np.arange(len(low)) + LENGTH <= ends[text]
    new = np.concatenate(([True], (low[1:] != low[:-1]) | (text[1:] != text[:-1])))
    start = np.flatnonzero(new & inside)
    # a run ends before the next one, and where its text's windows end
    stop = np.minimum(np.concatenate((np.flatnonzero(new)[1:], [len(low)]))[np.searchsorted(np.flatnonzero(new), start)],
                      ends[text[start]] - LENGTH + 1)
    n = stop - start
    parts = -(-n // SPREAD)  # the same least piece may recur for long: cut such runs
    at = np.repeat(start, parts) + SPREAD * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    n = np.minimum(SPREAD, np.repeat(stop, parts) - at)
    return _mix(low[at]) >> np.uint64(64 - _BITS), text[at], at, n


# ---- blobs ----------------------------------------------------------------------------------

def _squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays by byte plane, compressed; lengths and types are in front."""
    import zstandard

    head = ";".join(f"{a.dtype.str},{len(a)}" for a in arrays).encode()
    body = b"".join(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes() if len(a) else b"" for a in arrays)
    return len(head).to_bytes(4, "little") + head + zstandard.ZstdCompressor(level=1).compress(body)


def _spread(blob: bytes) -> list[np.ndarray]:
    import zstandard

    n = int.from_bytes(blob[:4], "little")
    body, out, at = zstandard.ZstdDecompressor().decompress(blob[4 + n:]) if len(blob) > 4 + n else b"", [], 0
    for part in blob[4:4 + n].decode().split(";"):
        kind, size = part.split(",")
        kind, size = np.dtype(kind), int(size)
        planes = np.frombuffer(body, np.uint8, size * kind.itemsize, at).reshape(kind.itemsize, size)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind) if size else np.zeros(0, kind))
        at += size * kind.itemsize
    return out


class Batch:
    """Texts end to end with their ids, and their runs."""

    def __init__(self, blob: bytes):
        self.data, self.ends, self.ids = _spread(blob)
        self.key, self.text, self.start, self.n = runs(self.data, self.ends)
        self.keys, self.of = np.unique(self.key, return_inverse=True)

    def shared_by_two(self) -> np.ndarray:
        """For each key whether two texts of different ids here have it."""
        ids = self.ids[self.text]
        least, most = np.full(len(self.keys), _LAST), np.full(len(self.keys), np.iinfo(np.int64).min)
        np.minimum.at(least, self.of, ids)
        np.maximum.at(most, self.of, ids)
        return least < most

    def strings(self, shared: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The distinct strings of shared keys in order of key and first place; their keys,
        smallest and largest ids; the runs that hold them and which string each is."""
        runs_ = np.flatnonzero(shared[self.of])
        runs_ = runs_[np.argsort(self.of[runs_], kind="stable")]
        raw, order = self.data.tobytes(), {}
        a, b = self.start[runs_].tolist(), (self.start[runs_] + self.n[runs_] + LENGTH - 1).tolist()
        of = np.array([order.setdefault(raw[x:y], len(order)) for x, y in zip(a, b)], dtype=np.int64)
        least, most = np.full(len(order), _LAST), np.full(len(order), np.iinfo(np.int64).min)
        np.minimum.at(least, of, self.ids[self.text[runs_]])
        np.maximum.at(most, of, self.ids[self.text[runs_]])
        keys = np.empty(len(order), dtype=np.uint64)
        keys[of] = self.key[runs_]
        return list(order), keys, least, most, runs_, of


def _cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where the sorted keys pass from one bucket to the next."""
    edges = [(b << _BITS) // buckets for b in range(buckets + 1)]
    return np.searchsorted(keys, np.array(edges, dtype=np.uint64))


# ---- merging transforms ---------------------------------------------------------------------

def _symbols(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The strings one after the other, each with an end symbol below all others, as ranks of the
    bytes that occur, from 2 on (UTF-8 leaves bytes unused, so they fit); and the ends."""
    raw = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    ends = np.cumsum([len(s) + 1 for s in strings])
    there = np.zeros(256, dtype=bool)
    text = np.ones(len(raw), dtype=bool)
    text[ends - 1] = False
    there[raw[text]] = True
    if there.sum() > 254:
        raise ValueError("texts use more byte values than UTF-8 has")
    out = (np.cumsum(there) + 1).astype(np.uint8)[raw]
    out[ends - 1] = 1
    return out, ends


def transform(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Burrows-Wheeler transform of ended strings over their rotations: (symbol before each row,
    string of each row, offset of each row)."""
    first = np.concatenate(([0], ends[:-1]))
    sizes = ends - first
    deep = LENGTH + 6  # rows are sorted deep enough for every comparison that the merge makes
    # each string twice over, or as often as it takes, so that a rotation is a window
    times = 1 + -(-deep // sizes)
    room = np.cumsum(sizes * times)
    at = np.arange(room[-1]) - np.repeat(room - sizes * times, sizes * times)
    long_ = symbols[np.repeat(first, sizes * times) + at % np.repeat(sizes, sizes * times)]
    of = np.repeat(np.arange(len(ends)), sizes)
    offset = np.arange(len(symbols)) - first[of]
    rows = np.lib.stride_tricks.sliding_window_view(long_, deep)[(room - sizes * times)[of] + offset]
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{deep}").ravel(), kind="stable")
    before = np.where(offset == 0, sizes[of] - 1, offset - 1)
    return symbols[first[of] + before][order], of[order], offset[order]


def merge(transforms: list[np.ndarray], depth: int = LENGTH, step: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the rows of sorted transforms by their first ``depth`` symbols, ``step``
    symbols a round: the rows, numbered through all transforms, in merged order, and how many
    symbols each has in common with the one before it, in whole steps and up to ``depth``."""
    symbols = np.concatenate(transforms)
    back, at = np.empty(len(symbols), dtype=np.int32), 0
    for t in transforms:  # where the row with one more symbol in front stands in its transform
        back[at + np.argsort(t, kind="stable")] = at + np.arange(len(t))
        at += len(t)
    # the steps before a row as one symbol, by rank
    block, to = np.zeros(len(symbols), dtype=np.uint64), np.arange(len(symbols))
    for k in range(step):
        block |= symbols[to].astype(np.uint64) << np.uint64(8 * k)
        to = back[to]
    names, block = np.unique(block, return_inverse=True)
    block = block.astype(np.uint16 if len(names) <= 1 << 16 else np.uint32)
    row, part = np.arange(len(symbols), dtype=np.int32), np.zeros(len(symbols), dtype=np.int32)
    common = np.full(len(symbols), depth, dtype=np.uint8)
    common[0] = 0
    for k in range(0, depth, step):
        now = block[row]
        order = np.argsort(now, kind="stable")
        row, now, part = to[row[order]], now[order], part[order]
        new = (now[1:] != now[:-1]) | (part[1:] != part[:-1])
        part = np.concatenate(([0], np.cumsum(new, dtype=np.int32)))
        fresh = np.flatnonzero(new) + 1
        common[fresh] = np.minimum(common[fresh], k)
    return row, common


def least_ids(strings: list[bytes], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id of every window of every string, over all the strings, one string after the
    other; and where each string's windows begin (and the last ones end)."""
    shards = [range(i, len(strings), SHARDS) for i in range(min(SHARDS, len(strings)))]
    symbols, ends = _symbols(strings)
    first = np.concatenate(([0], ends[:-1]))
    made = []
    for s in shards:
        own = np.concatenate([symbols[first[i]:ends[i]] for i in s])
        made.append(transform(own, np.cumsum([ends[i] - first[i] for i in s])))
    row, common = merge([m[0] for m in made], step=STEP)
    string = np.concatenate([np.asarray(s)[m[1]] for s, m in zip(shards, made)])[row]
    offset = np.concatenate([m[2] for m in made])[row]
    sizes = ends - first - 1
    whole = offset + LENGTH <= sizes[string]
    interval = np.cumsum(common < LENGTH) - 1
    least = np.full(interval[-1] + 1, _LAST)
    np.minimum.at(least, interval[whole], ids[string[whole]])
    begin = np.concatenate(([0], np.cumsum(sizes - LENGTH + 1)))
    flat = np.empty(begin[-1], dtype=np.int64)
    flat[begin[string[whole]] + offset[whole]] = least[interval[whole]]
    return flat, begin


# ---- jobs -----------------------------------------------------------------------------------

def pack_batches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (batch, blob) of up to BATCH_BYTES of text, or one longer text, written once."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts, ids, size = [], [], 0

        def full():
            ends = np.cumsum(np.array([len(t) for t in texts], dtype=np.int64))
            return pd.DataFrame({"blob": [_squeeze(np.frombuffer(b"".join(texts), np.uint8), ends,
                                                   np.array(ids, dtype=np.int64))]})

        for batch in batches:
            for i, t in zip(batch["id"], batch["text"]):
                texts.append(bytes(t))
                ids.append(int(i))
                size += len(t)
                if size >= BATCH_BYTES:
                    yield full()
                    texts, ids, size = [], [], 0
        if texts:
            yield full()

    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_LAST)).alias("id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"))
    packed = rows.mapInPandas(run, "blob binary").withColumn("batch", F.monotonically_increasing_id())
    return materialize(packed, "passagebatches")


def _report(buckets: int):
    """Keys of each batch by bucket, each with a bit for "two texts here have it"."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for batch, blob in zip(frame["batch"], frame["blob"]):
                b = Batch(blob)
                two, cuts = b.shared_by_two(), _cuts(b.keys, buckets)
                some = [k for k in range(buckets) if cuts[k] < cuts[k + 1]]
                yield pd.DataFrame({"bucket": some, "batch": [batch] * len(some), "blob": [
                    _squeeze(np.diff(b.keys[cuts[k]:cuts[k + 1]], prepend=np.uint64(0)),
                             np.packbits(two[cuts[k]:cuts[k + 1]])) for k in some]})

    return run


def _shared(frame: pd.DataFrame) -> pd.DataFrame:
    """One bucket: for each batch a bit for each of its keys, set if another batch or text has it."""
    keys, two = [], []
    for blob in frame["blob"]:
        steps, bits = _spread(blob)
        keys.append(np.cumsum(steps, dtype=np.uint64))
        two.append(np.unpackbits(bits, count=len(steps)))
    sizes = [len(k) for k in keys]
    _, of, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    many = np.bincount(of, weights=np.concatenate(two)) + count > 1
    bits = np.split(many[of], np.cumsum(sizes)[:-1])
    out = pd.DataFrame({"batch": frame["batch"], "bucket": frame["bucket"], "bits": [np.packbits(x).tobytes() for x in bits]})
    return out[[x.any() for x in bits]]


def _bits(batch: Batch, buckets: int, answers) -> np.ndarray:
    shared, cuts = np.zeros(len(batch.keys), dtype=bool), _cuts(batch.keys, buckets)
    for a in answers:
        k = a["bucket"]
        shared[cuts[k]:cuts[k + 1]] = np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=cuts[k + 1] - cuts[k])
    return shared


def _send(buckets: int):
    """Strings of shared keys by bucket."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for batch, blob, answers in zip(frame["batch"], frame["blob"], frame["answers"]):
                b = Batch(blob)
                strings, keys, least, most, _, _ = b.strings(_bits(b, buckets, answers))
                sizes, cuts = np.array([len(s) for s in strings], dtype=np.uint8), _cuts(keys, buckets)
                some = [k for k in range(buckets) if cuts[k] < cuts[k + 1]]
                yield pd.DataFrame({"bucket": some, "batch": [batch] * len(some), "blob": [
                    _squeeze(np.diff(keys[x:y], prepend=np.uint64(0)), sizes[x:y],
                             np.frombuffer(b"".join(strings[x:y]), np.uint8), least[x:y], most[x:y])
                    for x, y in ((cuts[k], cuts[k + 1]) for k in some)]})

    return run


def _intervals(frame: pd.DataFrame) -> pd.DataFrame:
    """One bucket: for each batch (string, first window, window after the last, smallest id)
    wherever that id is smaller than some of the batch's."""
    ids: dict[bytes, int] = {}
    key: dict[bytes, int] = {}  # equal strings have equal keys
    parts = []
    for blob in frame["blob"]:
        steps, sizes, data, least, most = _spread(blob)
        raw, ends = data.tobytes(), np.cumsum(sizes, dtype=np.int64).tolist()
        own = [raw[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        key.update(zip(own, np.cumsum(steps, dtype=np.uint64).tolist()))
        for s, i in zip(own, least.tolist()):
            if ids.get(s, _LAST) >= i:
                ids[s] = i
        parts.append((own, most))
    # equal windows have equal keys: a string that is alone under its key shares no window with another one,
    # so each of its windows has its own smallest id; the others are merged
    under = Counter(key.values())
    order = sorted((s for s in ids if under[key[s]] > 1), key=key.__getitem__)
    place: dict[bytes, tuple[int, int, int]] = {}  # group, and its windows' bounds there
    groups, lowest = [], {}
    at = 0
    while at < len(order):  # strings of one key stay together
        to = min(len(order), at + MERGE_STRINGS)
        while to < len(order) and key[order[to]] == key[order[to - 1]]:
            to += 1
        some = order[at:to]
        flat, begin = least_ids(some, np.array([ids[s] for s in some]))
        bounds = begin.tolist()
        place |= {s: (len(groups), a, b) for s, a, b in zip(some, bounds, bounds[1:])}
        lowest |= dict(zip(some, np.minimum.reduceat(flat, begin[:-1]).tolist()))
        groups.append(flat)
        at = to
    blobs = []
    for own, most in parts:
        rows: list[tuple[int, int, int, int]] = []
        for n, (s, high) in enumerate(zip(own, most.tolist())):
            if s not in lowest:
                if ids[s] < high:
                    rows.append((n, 0, len(s) - LENGTH + 1, ids[s]))
            elif lowest[s] < high:
                g, x, y = place[s]
                low = groups[g][x:y]
                cuts = [0, *(np.flatnonzero(low[1:] != low[:-1]) + 1).tolist(), len(low)]
                rows += [(n, a, b, int(low[a])) for a, b in zip(cuts, cuts[1:]) if low[a] < high]
        table = np.array(rows, dtype=np.int64).reshape(-1, 4)
        blobs.append(_squeeze(table[:, 0].astype(np.uint32), table[:, 1].astype(np.uint8), table[:, 2].astype(np.uint8),
                              np.ascontiguousarray(table[:, 3])) if rows else None)
    out = pd.DataFrame({"batch": frame["batch"], "bucket": frame["bucket"], "blob": blobs})
    return out[out["blob"].notna()]


RESULT = "id long, n_bytes long, spans array<long>, kept binary"


def _apply(buckets: int, keep_bytes: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for blob, answers, found in zip(frame["blob"], frame["answers"], frame["found"]):
                b = Batch(blob)
                gone = np.zeros(len(b.data) + 1, dtype=np.int32)
                if found is not None and len(found):
                    _, keys, _, _, runs_, of = b.strings(_bits(b, buckets, answers))
                    cuts = _cuts(keys, buckets)
                    by = np.argsort(of, kind="stable")
                    first = np.searchsorted(of[by], np.arange(len(keys) + 1))
                    for f in found:
                        string, a, z, low = _spread(f["found"])
                        string = string.astype(np.int64) + cuts[f["bucket"]]
                        n = first[string + 1] - first[string]  # the runs that hold each string
                        which = runs_[by[np.repeat(first[string], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]]
                        a, z, low = np.repeat(a, n), np.repeat(z, n), np.repeat(low, n)
                        hit = low < b.ids[b.text[which]]
                        np.add.at(gone, b.start[which[hit]] + a[hit], 1)
                        np.add.at(gone, b.start[which[hit]] + z[hit] + LENGTH - 1, -1)
                cover = np.cumsum(gone[:-1]) > 0
                rows, at = [], 0
                for i, end in zip(b.ids.tolist(), b.ends.tolist()):
                    own, data = cover[at:end], b.data[at:end]
                    edge = np.flatnonzero(np.diff(own, prepend=False, append=False)).tolist() if own.any() else []
                    kept = data[~own].tobytes()
                    rows.append((i, end - at, edge, kept if keep_bytes else hashlib.sha256(kept).digest()))
                    at = end
                yield pd.DataFrame(rows, columns=["id", "n_bytes", "spans", "kept"])

    return run


def repeated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep_bytes: bool = True) -> DataFrame:
    """One row per document: id, n_bytes, ``spans`` (bounds of the maximal removed runs of bytes,
    one after the other) and ``kept``, the bytes that stay (or their SHA-256 alone)."""
    spark = docs.sparkSession
    packed = pack_batches(docs, id_col, text_col)
    total = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(f"`{text_col}`"))), F.lit(0))).first()[0]
    buckets = max(MIN_BUCKETS, -(-total // BUCKET_BYTES))

    keys = packed.mapInPandas(_report(buckets), "bucket int, batch long, blob binary")
    shared = materialize(keys.groupBy("bucket").applyInPandas(_shared, "batch long, bucket int, bits binary"), "passagekeys")
    release(spark)
    answers = materialize(shared.groupBy("batch").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers")), "passageanswers")

    sent = packed.join(answers, "batch").mapInPandas(_send(buckets), "bucket int, batch long, blob binary")
    found = materialize(sent.groupBy("bucket").applyInPandas(_intervals, "batch long, bucket int, blob binary"), "passageintervals")
    release(spark)
    found = materialize(found.groupBy("batch").agg(F.collect_list(F.struct("bucket", F.col("blob").alias("found"))).alias("found")), "passagefound")
    told = materialize(answers.join(found, "batch"), "passagetold")
    out = packed.join(told, "batch", "left").mapInPandas(_apply(buckets, keep_bytes), RESULT)
    return out.withColumn("id", F.when(F.col("id") != _LAST, F.col("id")))


def query(spark, sf_dir: str) -> DataFrame:
    found = repeated(load(spark, sf_dir, "documents").select("doc_id", "text"), keep_bytes=False)
    bound = F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    return found.select(F.col("id").alias("doc_id"), "n_bytes",
                        F.aggregate(bound, F.lit(0).cast("long"), lambda s, x: s + x).alias("n_removed"),
                        (F.size("spans") / 2).cast("long").alias("n_spans"), F.lower(F.hex("kept")).alias("kept_sha256"))
