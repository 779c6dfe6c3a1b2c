"""Secret scans: base patterns and a battery of randomness tests (DataFrame functions only).

Base spans (``assign``, ``access``, ``hex``) always stay. Further candidates are long runs of
token characters that have letters and digits. For each the smallest alphabet that holds it is
inferred, and three tests ask whether its symbols look drawn at random from that alphabet:

* chi-squared uniformity over the alphabet, the symbols dealt into fewer bins for short tokens so
  that every bin expects five;
* the runs test above and below the alphabet's middle;
* lag-one serial correlation of the symbols' places.

The smallest of the three p-values (times three) is the token's. Benjamini and Hochberg's rule,
applied for each length class over the counts of all candidates of the table, decides which tokens
are *not* random; the others are reported as ``random``. The counts are by length class and
power of two of the p-value, so what the driver reads has at most ``CLASSES * BINS`` rows.

Defined results: null text is empty and has no spans; candidates that overlap a base span are not
added; repeated rows get equal spans; texts are read whole; columns of the input never clash with
the working columns; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from draftledger.llm.common import load, materialize, pack, unpack
from draftledger.llm.spans import as_text, bound, listed, matches, overlaps, ranked, redacted, with_fields, with_reach

_SECRET = r"[A-Za-z0-9+/_.=-]"
ASSIGN = rf"(?i:(password|passwd|secret|token|api_?key))[\"']?+\x20*+[:=]\x20*+[\"']?+({_SECRET}++)"
ACCESS = r"AKIA[A-Z0-9]{14,}+"
#: Runs of 16 and more; the look-behind starts only at a run's beginning, so long runs stay linear.
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}+"
MIN_ASSIGN = 12
#: Candidates: at least so many token characters in a row.
MIN_TOKEN = 20
TOKEN = rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{MIN_TOKEN},}}+={{0,2}}+"

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets by size; the first that holds a token is its encoding.
ALPHABETS = {
    "hex": _DIGITS + _LOWER[:6],
    "HEX": _DIGITS + _UPPER[:6],
    "base32": _UPPER + "234567",
    "lower36": _DIGITS + _LOWER,
    "UPPER36": _DIGITS + _UPPER,
    "base62": _DIGITS + _UPPER + _LOWER,
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
    "base64": _UPPER + _LOWER + _DIGITS + "+/",
}
RATE = 0.05
CLASSES, BINS = 8, 64


def base_spans(df: DataFrame, text: str) -> DataFrame:
    """Adds array columns assign, access and hex."""
    df = matches(df, "assign", text, ASSIGN)
    df = df.withColumn("assign", F.filter("assign", lambda s: F.length(F.regexp_extract(s["text"], ASSIGN, 2)) >= MIN_ASSIGN))
    return matches(matches(df, "access", text, ACCESS, "AKIA"), "hex", text, HEX)


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution (a polynomial approximation for z >= 0)."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    p = F.exp(-a * a / 2) * F.lit(1 / math.sqrt(2 * math.pi)) * series
    return F.when(z >= 0, p).otherwise(1 - p)


def _sum(array: Column, start=0.0) -> Column:
    return F.aggregate(array, F.lit(start), lambda s, x: s + x)


def _next(array: Column, f) -> Column:
    """``f`` over neighbours."""
    n = F.size(array) - 1
    return F.zip_with(F.slice(array, 1, n), F.slice(array, 2, n), f)


def _alphabet(core: Column) -> Column:
    out = F.lit(None).cast("string")
    for alphabet in reversed(ALPHABETS.values()):
        out = F.when(F.translate(core, alphabet, "") == "", F.lit(alphabet)).otherwise(out)
    return out


def tested(spans: Column) -> Column:
    """Spans (start, end, text) with length class and p-value bin under "drawn at random from its
    alphabet"; spans that no alphabet holds are left out."""
    x, f = with_fields(spans, ["start", "end"], core=lambda s: F.regexp_replace(s["text"], "=+$", ""))
    x, f = with_fields(x, f, alphabet=lambda s: _alphabet(s["core"]))
    x = F.filter(x, lambda s: s["alphabet"].isNotNull())
    x, f = with_fields(x, f, k=lambda s: F.length(s["alphabet"]), n=lambda s: F.length(s["core"]).cast("double"),
                 place=lambda s: F.transform(F.filter(F.split(s["core"], ""), lambda c: c != ""),
                                             lambda c: F.instr(s["alphabet"], c) - 1))
    # bin b of the alphabet has the places with floor(place * bins / k) = b
    x, f = with_fields(x, f, bins=lambda s: F.greatest(F.lit(2), F.least(s["k"], F.floor(s["n"] / 5).cast("int"))))
    x, f = with_fields(x, f, dealt=lambda s: F.transform(s["place"], lambda p: F.floor(p * s["bins"] / s["k"]).cast("int")),
                 high=lambda s: F.transform(s["place"], lambda p: (2 * p >= s["k"]).cast("int")),
                 off=lambda s: F.transform(s["place"], lambda p: p - (s["k"] - 1) / 2))

    def chi(s: Column) -> Column:
        expected = lambda b: s["n"] * (F.ceil((b + 1) * s["k"] / s["bins"]) - F.ceil(b * s["k"] / s["bins"])) / s["k"]
        seen = lambda b: F.size(F.filter(s["dealt"], lambda d: d == b)).cast("double")
        return _sum(F.transform(F.sequence(F.lit(0), s["bins"] - 1), lambda b: F.pow(seen(b), 2) / expected(b))) - s["n"]

    x, f = with_fields(x, f, chi=chi, above=lambda s: _sum(s["high"], 0).cast("double"),
                 runs=lambda s: _sum(_next(s["high"], lambda a, b: (a != b).cast("int")), 1),
                 square=lambda s: _sum(F.transform(s["off"], lambda v: v * v)),
                 lag=lambda s: _sum(_next(s["off"], lambda a, b: a * b)), df=lambda s: (s["bins"] - 1).cast("double"))
    x, f = with_fields(x, f, mean=lambda s: 2 * s["above"] * (s["n"] - s["above"]) / s["n"] + 1)
    x, f = with_fields(x, f, var=lambda s: (s["mean"] - 1) * (s["mean"] - 2) / (s["n"] - 1))
    x, f = with_fields(
        x, f,
        z_chi=lambda s: (F.pow(F.greatest(s["chi"], F.lit(0.0)) / s["df"], 1 / 3) - (1 - 2 / (9 * s["df"]))) / F.sqrt(2 / (9 * s["df"])),
        z_runs=lambda s: F.when(s["var"] > 0, F.abs(s["runs"] - s["mean"]) / F.sqrt(s["var"])).otherwise(F.lit(9.0)),
        z_serial=lambda s: F.when(s["square"] > 0, F.abs(s["lag"] / s["square"]) * F.sqrt(s["n"])).otherwise(F.lit(9.0)))
    x, f = with_fields(x, f, p=lambda s: F.least(F.lit(1.0), 3 * F.greatest(F.lit(0.0), F.least(
        _tail(s["z_chi"]), 2 * _tail(s["z_runs"]), 2 * _tail(s["z_serial"])))))
    return F.transform(x, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                             _class(s["n"]).alias("class"), _bin(s["p"]).alias("bin")))


def _class(n: Column) -> Column:
    """Length class: up to 28 characters, up to 39, 56, 79 and so on."""
    return F.least(F.lit(CLASSES - 1), F.greatest(F.lit(0), F.floor(2 * F.log2(n / MIN_TOKEN)).cast("int")))


def _bin(p: Column) -> Column:
    """p is at most 2 to the power of -bin."""
    return F.least(F.lit(BINS - 1), F.floor(-F.log2(F.greatest(p, F.lit(2.0 ** -BINS)))).cast("int"))


def scan(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """Every document as struct ``row`` with ``text``, base spans ``base`` and ``tokens``: the
    candidates with length class and p-value bin."""
    df = pack(docs, text=F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    df = matches(base_spans(df, "text"), "token", "text", TOKEN)
    base = listed(ranked(F.col("assign"), "assign", 0), ranked(F.col("access"), "access", 1), ranked(F.col("hex"), "hex", 2))
    df = with_reach(df.withColumn("base", base), "_reach", "base")
    mixed = bound(F.col("_reach"), lambda reach: F.filter(
        "token", lambda s: s["text"].rlike("[0-9]") & s["text"].rlike("[A-Za-z]") & ~overlaps(s, reach)))
    return df.select("row", "text", "assign", "access", "hex", "base",
                     F.when(F.size("token") > 0, tested(mixed)).otherwise(
                         F.array().cast("array<struct<start:int,end:int,class:int,bin:int>>")).alias("tokens"))


def limits(scanned: DataFrame, rate: float = RATE) -> dict[int, int]:
    """For each length class the smallest p-value bin whose tokens are not random."""
    # not explode: the filter that Spark infers for it would be pushed through all the steps of a scan
    counts = (scanned.select(F.explode_outer("tokens").alias("t")).where("t is not null").groupBy("t.class", "t.bin")
              .agg(F.count(F.lit(1)).alias("n")).collect())  # at most CLASSES * BINS rows
    out = {}
    for c in range(CLASSES):
        by = {r["bin"]: r["n"] for r in counts if r["class"] == c}
        total, seen = sum(by.values()), 0
        for b in sorted(by, reverse=True):
            seen += by[b]
            if total * 2.0 ** -b <= rate * seen:
                out[c] = b
    return out


def found(scanned: DataFrame, rejected: dict[int, int]) -> DataFrame:
    """Adds ``spans``: base spans and the tokens taken for random, as listed."""
    def random(t: Column) -> Column:
        keep = F.lit(True)
        for c, b in rejected.items():
            keep = F.when(t["class"] == c, t["bin"] < b).otherwise(keep)
        return keep

    return scanned.withColumn("spans", listed(F.col("base"), ranked(F.filter("tokens", random), "random", 3)))


def redact(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The documents with every secret replaced by its kind in brackets."""
    scanned = materialize(scan(docs, text_col=text_col).select("row", "base", "tokens"), "secretscan")
    out = found(scanned, limits(scanned)).withColumn("text", F.coalesce(F.col("row")[text_col], F.lit("")))
    out = redacted(out, "_clean", "text", "spans", lambda s: F.concat(F.lit("["), s["kind"], F.lit("]")))
    clean = F.when(F.size("spans") > 0, F.col("_clean")).otherwise(F.col("row")[text_col])
    return unpack(out.withColumn("row", F.col("row").withField(f"`{text_col}`", clean)))


def query(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = materialize(scan(docs).select(
        F.struct("row.doc_id").alias("row"), *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        "base", "tokens"), "secrets")
    return found(scanned, limits(scanned)).select(
        "row.doc_id", "n_assign", "n_access", "n_hex", F.sha2(as_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        as_text(F.col("spans")).alias("spans"))
