"""Toxicity by compression distance: separate zstandard dictionaries for toxic and ordinary text.

Training (labelled rows whose crc32(doc_id as text) mod 5 is not 0, a bounded sample):

* equal texts count once; near-copies stay together in one fold and count once where words are counted;
* words of toxic texts that ordinary texts hardly have are found by comparing document counts,
  and the toxic dictionary is trained on those passages of the toxic texts; the ordinary
  dictionary is trained on the windows of ordinary texts. Both serve as plain content, without
  entropy tables, so that a window's literals cost the same under either;
* a logistic model turns a text's window lengths into a calibrated score, fitted on texts that
  their dictionaries have not seen, weighted to the share of toxic labels in the whole table.

Scoring: the whole text is cut at spaces into windows, twice, of each of ``WINDOWS`` bytes; each is compressed
without a dictionary, with the ordinary one and with the toxic one. What counts is how much
shorter the toxic dictionary makes it, against both others.

Defined results: a null or empty text has no windows and gets the score of a text without any
gain; with no labelled texts of one class every score is the share of toxic labels (0 without
labels); labels of null or conflicting value are left out; repeated rows get equal scores;
columns of the input never clash with the working columns.
"""

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from draftledger.llm.common import load, pack, unpack

#: The sample's bounds: documents of each class and bytes of one document. Longer documents are
#: scored like any other; they are only not learned from.
MAX_TOXIC, MAX_ORDINARY, MAX_BYTES = 3000, 8000, 32 * 1024
#: Bytes of a window. In long ones a match costs little beside the others; in short ones hardly
#: anything but a telling word changes the length.
WINDOWS = (256, 48)
DICTIONARY = 4096
LEVEL, MIN_MATCH, SEGMENT = 3, 5, 64
#: A telling word or beginning of words is in toxic texts so many times as often as in ordinary ones,
#: and that by chance with a probability of at most e to the power of -TELL_SURPRISE.
TELL_TIMES, TELL_SURPRISE = 10, 9
#: The score is fitted on texts that their dictionaries were not trained on: each fold's dictionaries
#: are trained on the others.
FOLDS = 3
THRESHOLD = 0.5
#: Near-copies count once: hash functions of a sketch, share of equal hashes, groups looked at for each hash pair.
HASHES, ALIKE, HELD = 64, 0.4, 16
_MULTIPLY, _ADD = np.random.default_rng(1).integers(1, 1 << 63, (2, HASHES), dtype=np.uint64) | np.uint64(1)

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def windows(text: str, size: int) -> list[bytes]:
    data = text.encode("utf-8", "surrogatepass")
    out, at, n = [], 0, len(data)
    while at < n:
        to = at + size
        if to < n:
            space = data.rfind(b" ", at + 1, to)
            to = space if space > 0 else to
        out.append(data[at:to])
        at = to
    return out


def _compressor(dictionary: bytes | None, size: int):
    import zstandard

    params = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, source_size=size, dict_size=len(dictionary or b""), min_match=MIN_MATCH,
        write_content_size=0, write_dict_id=0, write_checksum=0)
    data = dictionary and zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(compression_params=params, **({"dict_data": data} if data else {}))


class Lengths:
    """Window lengths of a text under no, the ordinary and the toxic dictionary, as features."""

    EACH = 9
    N = EACH * len(WINDOWS) + 1

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.by = [(size, [_compressor(d, size).compress for d in (None, ordinary, toxic)]) for size in WINDOWS]

    def features(self, text: str | None) -> np.ndarray:
        out = np.zeros(self.N)
        if not text:
            return out
        for k, (size, compress) in enumerate(self.by):
            pieces = windows(text, size)
            plain, ordinary, toxic = (np.array([len(f(w)) for w in pieces], dtype=float) for f in compress)
            gain, ahead = plain - toxic, ordinary - toxic
            top = np.concatenate([np.sort(gain)[::-1][:3], np.zeros(3)])
            out[k * self.EACH:(k + 1) * self.EACH] = (
                top[0], top[1], top[2], gain.mean(), np.maximum(gain - 2, 0).mean(),
                math.log1p(np.maximum(gain - 1, 0).sum()), ahead.max(), ahead.mean(), np.maximum(ahead - 2, 0).mean())
        out[-1] = math.log(len(pieces))
        return out


def _sketch(text: str) -> np.ndarray:
    """Least hashes of the runs of three words, under ``HASHES`` hash functions."""
    words = text.lower().split()
    grams = {" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))}
    base = np.array([zlib.crc32(g.encode("utf-8", "surrogatepass")) for g in grams], dtype=np.uint64)
    return ((base[:, None] * _MULTIPLY + _ADD) >> np.uint64(32)).min(axis=0)


def near_copies(texts: list[str]) -> list[list[str]]:
    """The distinct texts, near-copies in one group: of their runs of three words, a share of about
    ``ALIKE`` or more is in both. A line that many texts have does not make them alike."""
    at, groups, sketches = {}, [], []
    for text in dict.fromkeys(texts):
        sketch = _sketch(text)
        keys = [(i, sketch[i:i + 2].tobytes()) for i in range(0, HASHES, 2)]
        near = dict.fromkeys(g for k in keys for g in at.get(k, ()) if (sketches[g] == sketch).mean() >= ALIKE)
        if near:
            groups[next(iter(near))].append(text)
            continue
        for k in keys:
            at.setdefault(k, [])
            if len(at[k]) < HELD:
                at[k].append(len(groups))
        groups.append([text])
        sketches.append(sketch)
    return groups


def _starts(word: bytes) -> list[bytes]:
    """The word and its beginnings of four bytes or more, the latter marked with a star."""
    return [word, *(word[:n] + b"*" for n in range(4, min(len(word), 12)))]


def telling_words(toxic: list[list[str]], ordinary: list[list[str]]) -> set[bytes]:
    """Words, and beginnings of words, that toxic texts have and ordinary ones hardly; a group of
    near-copies counts as one text."""
    def documents_with(groups, among=None):
        n = Counter()
        for group in groups:
            words = {w for text in group for w in _WORD.findall(text.lower().encode("utf-8", "surrogatepass"))}
            starts = {s for w in words for s in _starts(w)}
            n.update(starts if among is None else starts & among)
        return n

    a = documents_with(toxic)
    a = {w: n for w, n in a.items() if n >= 4}
    b = documents_with(ordinary, a.keys())
    share = len(toxic) / (len(toxic) + len(ordinary))

    def surprise(n: int, total: int) -> float:
        """Bound of the log chance that n or more of total documents are toxic, if the word told nothing."""
        rate = n / total
        return total * (rate * math.log(rate / share) + ((1 - rate) * math.log((1 - rate) / (1 - share)) if n < total else 0))

    return {w for w, n in a.items() if n / len(toxic) >= TELL_TIMES * b[w] / max(1, len(ordinary))
            and surprise(n, n + b[w]) >= TELL_SURPRISE}


def _trained(samples: list[bytes]) -> bytes:
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY, samples, k=SEGMENT, d=6).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself is the dictionary
        return b"".join(dict.fromkeys(samples))[:DICTIONARY]


def dictionaries(toxic: list[list[str]], ordinary: list[list[str]]) -> tuple[bytes, bytes]:
    """(ordinary, toxic), from groups of near-copies."""
    tells = telling_words(toxic, ordinary)
    passages = []
    for text in (t for group in toxic for t in group):
        found = [w for w in _WORD.findall(text.lower().encode("utf-8", "surrogatepass")) if any(s in tells for s in _starts(w))]
        if found:
            passages.append(b" " + b"  ".join(found) + b" ")
    plain = [w for group in ordinary for text in group for w in windows(text, WINDOWS[0])]
    return _trained(plain), _trained(passages * 3)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    a, w = np.c_[np.ones(len(x)), x], np.zeros(x.shape[1] + 1)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w)),
                               a.T @ (weight * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(sample: list[tuple[str, int]], share: float) -> dict:
    """``sample``: texts with their label, in an order that has nothing to do with either."""
    by = {y: near_copies([t for t, label in sample if label == y]) for y in (0, 1)}
    if not by[0] or not by[1]:
        return {"constant": share}
    x, y = [], []
    for fold in range(FOLDS):
        rest = {k: [t for i, t in enumerate(by[k]) if i % FOLDS != fold] or by[k] for k in by}
        lengths = Lengths(*dictionaries(rest[1], rest[0]))
        for k in by:
            texts = [t for group in by[k][fold::FOLDS] for t in group]
            x += [lengths.features(t) for t in texts]
            y += [float(k)] * len(texts)
    x, y = np.array(x), np.array(y)
    ordinary, toxic = dictionaries(by[1], by[0])
    share = min(max(share, 0.01), 0.99)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    return {"ordinary": ordinary, "toxic": toxic, "mean": mean, "scale": scale,
            "weights": _logistic((x - mean) / scale, y, weight)}


def held_out(doc_id):
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5) == 0


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> dict:
    lab = (labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"))
           .where("id is not null and y in (0, 1)").groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("z"))
           .where("y = z").drop("z").where(~held_out(F.col("id"))))
    share = lab.agg(F.coalesce(F.avg("y"), F.lit(0.0))).first()[0]
    mixed = F.xxhash64("id")
    # at most MAX_TOXIC + MAX_ORDINARY rows, so small enough to send to every task
    chosen = (lab.where("y = 1").orderBy(mixed, "id").limit(MAX_TOXIC)
              .unionByName(lab.where("y = 0").orderBy(mixed, "id").limit(MAX_ORDINARY)))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    sample = (texts.where(F.octet_length("text").between(1, MAX_BYTES)).join(F.broadcast(chosen), "id")
              .orderBy(mixed, "id", "text").limit(MAX_TOXIC + MAX_ORDINARY).collect())
    return fit([(r["text"], r["y"]) for r in sample], share)


def _scorer(model: dict):
    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if "constant" in model:
            for texts in batches:
                yield pd.Series([model["constant"]] * len(texts), dtype=float)
            return
        lengths = Lengths(model["ordinary"], model["toxic"])
        weights = model["weights"]
        for texts in batches:
            x = np.array([lengths.features(t) for t in texts]).reshape(-1, Lengths.N)
            z = weights[0] + ((x - model["mean"]) / model["scale"]) @ weights[1:]
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return score.asNondeterministic()


def score(docs: DataFrame, model: dict, *, text_col: str = "text") -> DataFrame:
    """Every document as struct ``row`` with its score."""
    return pack(docs, score=_scorer(model)(F.col(f"`{text_col}`")))


def reject(docs: DataFrame, model: dict, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold."""
    return unpack(score(docs, model, text_col=text_col).where(F.col("score") < threshold))


def query(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, load(spark, sf_dir, "labels")))
    return scored.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
