"""Personal data: base patterns, and boosted trees over further candidates (DataFrame functions only).

Base spans (``email``, ``ip``, ``card``, ``phone``) always stay. High-recall generators propose
overlapping candidates: ``contact`` (addresses, also spelt out), ``number`` (digits with any of the
usual separators) and ``ip6``. A gradient-boosted classifier reads format and context features
of a candidate. It learns from the table itself: candidates that a strict base pattern confirms
or that have a valid form are positive (spelt-out addresses, IPv6 addresses, telephone numbers after a
word that announces one), all others negative. ``examples`` of those forms and of what resembles
them are learned from too, so that forms that the table has rarely are known. It is fitted on one half of all
candidates, dealt by hash; over all of the other half the lowest score is found, for each generator,
above which at least ``PRECISION`` of the candidates are positive. Candidates above their threshold are added unless they overlap a
base span. The fitted trees are applied as nested conditions inside the row, so no candidate is
shuffled and there is no join back.

Defined results: null text is empty and has no spans; repeated rows get equal spans; texts are read whole; columns of the input never
clash with the working columns; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import random
import re

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from draftledger.llm.common import load, materialize, pack, unpack
from draftledger.llm.spans import as_text, bound, digits, listed, matches, overlaps, ranked, redacted, with_fields, with_reach

#: Patterns that start with a look-behind begin only where a run of their first class begins or
#: the last match ended; that is where a leftmost match begins, and long runs stay linear.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
CONTACT = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}+"
           r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z]{2,24}+)++")
NUMBER = r"(?<![0-9A-Za-z+])[+(]?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,}+"
IP6 = (r"(?<![0-9A-Za-z:])(?:(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}"
       r"|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5}::[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})(?![0-9A-Za-z:])")
BASE = ("email", "ip", "card", "phone")
GENERATORS = {"contact": (CONTACT, r"@|\(at\)|\[at\]"), "number": (NUMBER, "[0-9]"), "ip6": (IP6, "[0-9A-Fa-f]::?[0-9A-Fa-f]")}
_CONTEXT = r"(?i)\b(call|phone|tel|fax|mobile|cell|e-?mail|contact|reach|write|card|visa|account|iban|ssn|ip|host|server)\b"

_ANNOUNCED = r"(?i)\b(call|phone|telephone|tel|fax|mobile|cell)\b[^0-9A-Za-z]{0,4}$"
_SPELT = r"\(at\)|\[at\]"

#: Different feature rows that one task of the fit holds, and the least number of candidates to learn from.
KINDS_PER_TASK = 100_000
LEAST = 100
PRECISION = 0.95
TREES, DEPTH = 10, 3


def _luhn(number: Column) -> Column:
    each = F.transform(F.filter(F.split(F.reverse(number), ""), lambda c: c != ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise(2 * c.cast("int") - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda s, x: s + x) % 10 == 0


def _small(part: Column) -> Column:
    """Whether a run of digits is at most 255, whatever its length."""
    short = F.regexp_replace(part, "^0+(?=.)", "")
    return (F.length(short) <= 3) & (F.substring(short, 1, 3).cast("int") <= 255)


def base_spans(df: DataFrame, text: str) -> DataFrame:
    """Adds array columns email, ip, card and phone."""
    df = matches(df, "email", text, EMAIL, "@")
    df = matches(df, "ip", text, IP)
    df = df.withColumn("ip", F.filter("ip", lambda s: F.forall(F.split(s["text"], r"\."), _small)))
    df = matches(df, "card", text, CARD, "[0-9][ -]?[0-9]")
    df = df.withColumn("card", F.filter("card", lambda s: F.when(
        F.length(digits(s["text"])).between(14, 19), _luhn(digits(s["text"]))).otherwise(False)))
    df = matches(df, "phone", text, PHONE, r"\+[0-9]")
    return df.withColumn("phone", F.filter("phone", lambda s: F.length(digits(s["text"])).between(10, 15)))


def _flag(c: Column) -> Column:
    return F.when(c, 1.0).otherwise(0.0)


def _features(s: Column) -> Column:
    text, number = s["text"], digits(s["text"])
    n, nd = F.length(text).cast("double"), F.length(number).cast("double")
    groups = F.filter(F.split(text, "[^0-9]+"), lambda g: g != "")
    return F.array(
        s["generator"].cast("double"), n, nd, nd / n,
        F.length(F.regexp_replace(text, "[^A-Za-z]", "")).cast("double"),
        F.size(groups).cast("double"),
        F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g).cast("double"))), F.lit(0.0)),
        _flag(F.startswith(text, F.lit("+"))), _flag(F.contains(text, F.lit("("))), _flag(F.contains(text, F.lit("@"))),
        F.length(F.regexp_replace(text, r"[^.]", "")).cast("double"), F.length(F.regexp_replace(text, "[^-]", "")).cast("double"),
        F.length(F.regexp_replace(text, r"[^\x20]", "")).cast("double"),
        F.when(nd.between(12, 19), _flag(_luhn(number))).otherwise(0.0),
        F.coalesce(F.expr("1.0D") * F.ascii(F.substring(number, 1, 1)), F.lit(0.0)),
        F.length(F.regexp_replace(text, "[^:]", "")).cast("double"), _flag(F.contains(text, F.lit("::"))), _flag(text.rlike(_SPELT)),
        _flag(s["before"].rlike(_ANNOUNCED)), _flag(s["before"].rlike(_CONTEXT)), _flag(s["before"].rlike(r"[A-Za-z]\x20$")), _flag(s["after"].rlike("^[A-Za-z0-9]")))


N_FEATURES = 22


def _valid(s: Column) -> Column:
    """Whether a candidate that no base pattern matches has the form of what its generator looks for."""
    text, nd = s["text"], F.length(digits(s["text"]))
    parts = F.size(F.filter(F.split(text, ":"), lambda g: g != ""))
    contact = text.rlike(_SPELT) & text.rlike("^[^@(\\[]*[A-Za-z]")
    number = s["before"].rlike(_ANNOUNCED) & nd.between(7, 12)
    ip6 = F.when(F.contains(text, F.lit("::")), parts.between(3, 7)).otherwise(parts == 8) & text.rlike("[0-9]")
    return F.when(s["generator"] == 0, contact).when(s["generator"] == 1, number).otherwise(ip6)


def examples(n: int = 200) -> list[str]:
    """Texts with forms that a table may have rarely, and with what resembles them."""
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefghijklmnoprstuvw") for _ in range(r.randrange(3, 9)))
    number = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    groups = lambda k, size=4: [f"{r.randrange(16 ** r.randrange(1, size + 1)):x}" for _ in range(k)]
    out = []
    for _ in range(n):
        sep, k = r.choice(" -./"), r.randrange(2, 5)
        local = r.choice([f"0{number(2)}{sep}{number(4)}{sep}{number(4)}", f"({number(3)}) {number(3)}-{number(4)}",
                          f"{number(3)}{sep}{number(3)}{sep}{number(4)}", f"0{number(9)}"])
        at, dot = r.choice([("(at)", "(dot)"), ("[at]", "[dot]"), ("(at)", "."), (" (at) ", " (dot) "), (" [at] ", ".")])
        texts = [f"{word()}{r.choice(['', '.' + word()])}{at}{word()}{dot}{r.choice(['com', 'org', 'de', 'net'])}",
                 f"{r.choice(['call', 'phone', 'tel:', 'Fax', 'mobile', 'cell'])} {local}",
                 ":".join(["2001", *groups(7)]), f"{r.choice(['2001:db8', 'fe80:' + groups(1)[0]])}::{':'.join(groups(k))}",
                 local, number(16), f"20{number(2)}-{number(2)}-{number(2)}", f"{number(2)}.{number(2)}.20{number(2)}",
                 ":".join(number(2) for _ in range(r.randrange(4, 8))), ":".join(f"{r.randrange(256):02x}" for _ in range(6)),
                 f"{word()} @ {word()}.{word()}", f"{r.choice('abcdef')}::{r.choice(['add', 'be', 'f'])}"]
        out += [f"{word()} {word()} {t} {word()}" for t in texts]
    return out


def _from(spans: Column, generator: int) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(generator).alias("generator"), *[
        s[f].alias(f) for f in ("start", "end", "text", "before", "after")]))


def scan(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """Every document as struct ``row`` with ``text``, the base spans and ``candidates`` (start,
    end, generator, confirmed, positive, features)."""
    df = base_spans(pack(docs, text=F.coalesce(F.col(f"`{text_col}`"), F.lit(""))), "text")
    for name, (pattern, hint) in GENERATORS.items():
        df = matches(df, name, "text", pattern, hint)
    df = df.withColumn("base", listed(*[ranked(F.col(k), k, i) for i, k in enumerate(BASE)]))
    df = with_reach(df, "_reach", "base")
    proposed = F.concat(*[_from(F.col(k), i) for i, k in enumerate(GENERATORS)])
    x = bound(F.col("_reach"), lambda reach: with_fields(proposed, ["start", "end", "generator", "text", "before", "after"],
                                                         confirmed=lambda s: overlaps(s, reach).cast("int"))[0])
    x = F.transform(x, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["generator"].alias("generator"),
                                          s["confirmed"].alias("confirmed"),
                                          F.when(_valid(s), 1).otherwise(s["confirmed"]).alias("positive"), _features(s).alias("features")))
    return df.select("row", "text", *BASE, "base", x.alias("candidates"))


def _tree(lines: list[str], features: Column) -> Column:
    """The condition that a printed tree stands for; takes its lines off the list."""
    line = lines.pop(0).strip()
    if m := re.match(r"Predict: (\S+)", line):
        return F.lit(float(m[1]))
    m = re.match(r"If \(feature (\d+) <= (\S+)\)", line)
    low = _tree(lines, features)
    lines.pop(0)  # Else
    return F.when(features[int(m[1])] <= float(m[2]), low).otherwise(_tree(lines, features))


def fit(scanned: DataFrame) -> dict | None:
    """The fitted trees (printed) with weights, thresholds by generator and the numbers of candidates that either
    comes from (together all of them, and those of ``examples``); None if there is too little to learn from. ``scanned`` is a written table: candidates are filtered here, and a filter
    would be pushed through all the steps of a scan that is still to be planned."""
    mixed = F.xxhash64("c.start", "c.end", "c.features")
    proposed = scanned.select(F.explode_outer("candidates").alias("c")).where("c is not null")
    made = materialize(scan(scanned.sparkSession.createDataFrame([(t,) for t in examples()], "text string")).select("candidates"), "piiexamples")
    every = proposed.unionByName(made.select(F.explode("candidates").alias("c")))
    # candidates with equal features get equal scores: one weighted row stands for all of them, counted map-side first
    learned = materialize(every.select("c.positive", "c.features", (mixed % 2 == 0).alias("half")).groupBy(
        "features", "positive", "half").agg(F.count(F.lit(1)).alias("n")), "piifeatures")
    half = F.col("half")
    counts = learned.where(half).groupBy("positive").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect()  # two rows
    if len(counts) < 2 or sum(r["n"] for r in counts) < LEAST:
        return None
    kinds = sum(r["kinds"] for r in counts)
    parts = -(-kinds // KINDS_PER_TASK)
    # Spark ML looks for places to split in max(10,000, bins ** 2) rows: so many bins that these are all rows
    bins = 32 if kinds <= 10_000 else math.isqrt(kinds) + 1
    train = learned.where(half).repartition(parts, "features").sortWithinPartitions("features", "positive").select(
        array_to_vector("features").alias("features"), F.col("positive").cast("double").alias("label"), F.col("n").cast("double").alias("weight"))
    gbt = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=1, cacheNodeIds=False, maxBins=bins, weightCol="weight").fit(train)
    trees = [(w, t.toDebugString.strip().split("\n")[1:]) for w, t in zip(gbt.treeWeights, gbt.trees)]
    step = F.floor(_score(trees, F.col("features")) * 100).cast("int")
    rows = learned.where(~half).groupBy(F.col("features")[0].cast("int").alias("generator"), step.alias("step")).agg(
        F.sum(F.col("positive") * F.col("n")).alias("yes"), F.sum("n").alias("n")).collect()  # at most 101 for each generator
    thresholds = {}
    for g in range(len(GENERATORS)):
        yes = n = 0
        for r in sorted((r for r in rows if r["generator"] == g and r["step"] >= 50), key=lambda r: -r["step"]):
            yes, n = yes + r["yes"], n + r["n"]
            if yes >= PRECISION * n:
                thresholds[g] = r["step"] / 100
    return {"trees": trees, "thresholds": thresholds, "fitted": sum(r["n"] for r in counts), "held_out": sum(r["n"] for r in rows)}


def _score(trees: list, features: Column) -> Column:
    margin = F.lit(0.0)
    for weight, lines in trees:
        margin = margin + weight * _tree(list(lines), features)
    return 1 / (1 + F.exp(-2 * margin))


def found(scanned: DataFrame, model: dict | None) -> DataFrame:
    """Adds ``spans``: the base spans and the candidates above their threshold, as listed."""
    added = []
    if model:
        scored, f = with_fields(F.filter("candidates", lambda s: s["confirmed"] == 0), ["start", "end", "generator", "features"],
                                score=lambda s: _score(model["trees"], s["features"]))

        def above(g: int) -> Column:
            return F.filter(scored, lambda s: (s["generator"] == g) & (s["score"] >= model["thresholds"][g]))

        added = [ranked(above(g), kind, len(BASE) + g) for g, kind in enumerate(GENERATORS) if g in model["thresholds"]]
    return scanned.withColumn("spans", listed(F.col("base"), *added))


def redact(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in brackets; null texts stay null."""
    # written once: the fit and the redaction read it, and neither scans the texts again
    scanned = materialize(scan(docs, text_col=text_col).select("row", "base", "candidates"), "piiscan")
    out = found(scanned, fit(scanned)).withColumn("text", F.coalesce(F.col("row")[text_col], F.lit("")))
    out = redacted(out, "_clean", "text", "spans", lambda s: F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
    clean = F.when(F.size("spans") > 0, F.col("_clean")).otherwise(F.col("row")[text_col])
    return unpack(out.withColumn("row", F.col("row").withField(f"`{text_col}`", clean)))


def query(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = materialize(scan(docs).select(
        F.struct("row.doc_id").alias("row"), *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE], "base", "candidates"), "pii")
    return found(scanned, fit(scanned)).select(
        "row.doc_id", *[f"n_{k}" for k in BASE], F.sha2(as_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        as_text(F.col("spans")).alias("spans"))
