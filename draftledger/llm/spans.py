"""Spans of pattern matches as array columns (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters of context kept with a match: before it and after it.
BEFORE, AFTER = 24, 8
#: Running values are folded inside pieces of an array and then over the pieces, as a fold that appends
#: copies its array at each step; texts are cut from pieces of so many code points.
FOLD, PIECE = 128, 4096
SPAN = "array<struct<start:int,end:int,text:string,before:string,after:string>>"


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value held in a variable: an expression that stands inside a lambda would be
    evaluated again for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _with_running(df, name: str, values: str, op, levels: int = 3):
    """Adds ``name``: for each element of the array column ``values`` (int, not null) ``op`` (associative, 0 neutral)
    over all elements before it."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def fold(array: Column) -> Column:
        return F.aggregate(array, start, lambda acc, x: F.struct(
            op(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))

    if levels == 1:
        return df.withColumn(name, fold(F.col(values))["out"])
    # every step is a column of its own, so that none is evaluated again for each piece
    folded, totals, before = (f"{name}{levels}{c}" for c in "fto")
    df = df.withColumn(folded, F.when(F.size(values) > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / FOLD).cast("int")),
        lambda k: fold(F.slice(values, k * FOLD + 1, FOLD)))).otherwise(F.array().cast("array<struct<at:int,out:array<int>>>")))
    df = df.withColumn(totals, F.transform(folded, lambda p: p["at"]))
    df = _with_running(df, before, totals, op, levels - 1)
    df = df.withColumn(name, F.flatten(F.zip_with(folded, before, lambda p, at: F.transform(p["out"], lambda v: op(at, v)))))
    return df.drop(folded, totals, before)


def _sum(a: Column, b: Column) -> Column:
    return a + b


def _largest(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def matches(df, name: str, text: str, pattern: str, hint: str | None = None):
    """Adds column ``name``: the leftmost non-overlapping matches of ``pattern`` in column
    ``text`` (not null) with their code-point bounds. ``hint``: a string or pattern that every
    text with a match has, cheaper to look for than ``pattern``; pass None to look for that.

    Matches and the pieces between them come from the same matcher; the bounds are the running
    sums of their lengths. The time is linear in the text.
    """
    found, parts, rows, sizes, before = (f"_{name}_{c}" for c in "mprsb")
    there = F.col(text).rlike(pattern) if hint is None else F.col(text).rlike(hint)
    df = df.withColumn(found, F.when(there, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    df = df.withColumn(parts, F.when(F.size(found) > 0, F.split(text, pattern, -1)))
    n = F.size(found)
    zipped = F.arrays_zip(F.slice(parts, 1, n).alias("p"), F.col(found).alias("m"), F.slice(parts, 2, n).alias("q"))
    df = df.withColumn(rows, F.when(n > 0, F.transform(zipped, lambda x: F.struct(
        F.length(x["p"]).alias("gap"), F.length(x["m"]).alias("size"), x["m"].alias("text"),
        F.substring(x["p"], -BEFORE, BEFORE).alias("before"), F.substring(x["q"], 1, AFTER).alias("after")))))
    none = F.array().cast("array<int>")
    df = df.withColumn(sizes, F.when(n > 0, F.transform(rows, lambda x: x["gap"] + x["size"])).otherwise(none))
    df = _with_running(df, before, sizes, _sum)
    spans = F.zip_with(rows, before, lambda x, at: F.struct(
        (at + x["gap"]).alias("start"), (at + x["gap"] + x["size"]).alias("end"), x["text"].alias("text"),
        x["before"].alias("before"), x["after"].alias("after")))
    return df.withColumn(name, F.when(n > 0, spans).otherwise(F.array().cast(SPAN))).drop(found, parts, rows, sizes, before)


def with_fields(spans: Column, fields: list[str], **new) -> tuple[Column, list[str]]:
    """Spans with further fields, each from the fields so far, so that each is computed once."""
    out = F.transform(spans, lambda s: F.struct(*[s[f].alias(f) for f in fields],
                                                *[make(s).alias(name) for name, make in new.items()]))
    return out, [*fields, *new]


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def ranked(spans: Column, kind: str, rank: int) -> Column:
    """Spans as (start, rank, kind, end), the order in which they are listed."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"),
                                                 F.lit(kind).alias("kind"), s["end"].alias("end")))


def listed(*arrays: Column) -> Column:
    return F.array_sort(F.concat(*arrays))


def as_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def with_reach(df, name: str, spans: str):
    """Adds ``name``: of spans in order of start, the starts and the largest end up to each span; for ``overlaps``."""
    ends, before = f"_{name}_e", f"_{name}_b"
    df = _with_running(df.withColumn(ends, F.transform(spans, lambda s: s["end"])), before, ends, _largest)
    return df.withColumn(name, F.struct(F.transform(spans, lambda s: s["start"]).alias("starts"),
                                        F.zip_with(before, ends, _largest).alias("reach"))).drop(ends, before)


def overlaps(a: Column, reach: Column) -> Column:
    """Whether span ``a`` overlaps one of the spans of ``reach``: of those that start before its end, the
    one that reaches farthest ends after its start. Their number is found by bisection."""
    n = F.size(reach["starts"])
    start = F.struct(F.lit(0).alias("low"), n.alias("high"))

    def halve(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        before = F.get(reach["starts"], mid) < a["end"]
        open_ = acc["low"] < acc["high"]
        return F.struct(F.when(open_ & before, mid + 1).otherwise(acc["low"]).alias("low"),
                        F.when(open_ & ~before, mid).otherwise(acc["high"]).alias("high"))

    k = F.aggregate(F.sequence(F.lit(0), F.length(F.bin(n))), start, halve, lambda acc: acc["low"])
    return F.coalesce(F.get(reach["reach"], k - 1) > a["start"], F.lit(False))


def redacted(df, name: str, text: str, spans: str, mark):
    """Adds ``name``: column ``text`` with every span (sorted by start) replaced by ``mark(span)``; spans that
    overlap an earlier one only lengthen it. The text is cut into pieces once, and what stays is put together from
    them, so the time is linear in the text and the spans."""
    pieces, ends, before = (f"_{name}_{c}" for c in "teb")
    some = F.size(spans) > 0
    df = df.withColumn(pieces, F.when(some, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))))
    df = _with_running(df.withColumn(ends, F.transform(spans, lambda s: s["end"])), before, ends, _largest)

    def cut(t: Column, x: Column, y: Column) -> Column:
        """The text from x up to y, of pieces t."""
        first, last = F.floor(x / PIECE).cast("int"), F.floor((y - 1) / PIECE).cast("int")
        parts = F.transform(F.sequence(first, last), lambda k: F.substring(
            F.get(t, k), F.greatest(x - k * PIECE, F.lit(0)) + 1, F.least(y - k * PIECE, F.lit(PIECE)) - F.greatest(x - k * PIECE, F.lit(0))))
        return F.when(x >= y, "").otherwise(F.array_join(parts, ""))

    kept = F.filter(F.zip_with(spans, before, lambda s, at: F.struct(s.alias("span"), at.alias("at"))), lambda x: x["span"]["start"] >= x["at"])
    end = F.array_max(ends)
    out = bound(F.col(pieces), lambda t: F.concat(
        F.array_join(F.transform(kept, lambda x: F.concat(cut(t, x["at"], x["span"]["start"]), mark(x["span"]))), ""),
        cut(t, end, F.length(text))))
    return df.withColumn(name, F.when(some, out).otherwise(F.col(text))).drop(pieces, ends, before)
