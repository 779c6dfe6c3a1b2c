"""Quality rules, line first: bad lines go, then documents that lose too much text.

A line is judged by three rules, in this order:

* punctuation: hardly any letters, many symbols, shouted (most words end in exclamation marks), or
  the same word again and again;
* navigation: words between separators like ``|`` or ``>``, or a short line of link words;
* boilerplate: licence, copyright, cookie and similar notices, or a repeat of an earlier long line.

Failing lines are removed. A document is rejected when more than ``MAX_LOST`` of its words were on
them, or when it fails one of the base limits on the whole text.

Defined results: null text has no words, zero counts, fails the base limits and is rejected; so is
an empty text or one of white space; repeated rows are judged alike; a text is read whole and line
by line, whatever its length; columns of the input never clash with the working columns.
"""

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from draftledger.llm.common import load, pack, unpack

MIN_WORDS = 50
MAX_REPEATED = 50    # per cent of the words
MAX_LOST = 0.5
_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
#: Every ASCII byte that is no letter; other bytes are taken for letters.
_NO_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha())
_SEPARATORS = re.compile("»|›|•|·|[|>]".encode())
_LINKS = re.compile(rb"\W*(home|menu|login|log in|sign (in|up)|register|search|contact|about( us)?|next|previous|share|"
                    rb"read more|skip to content|back to top|sitemap|subscribe)\b", re.I)
_NOTICE = re.compile("licen[cs]ed under|released under the|under the terms of|general public license|apache license|"
                     r"mit license|creative commons|\bcc[ -]by\b|all rights reserved|copyright (\(c\)|©|\d)|© ?\d|"
                     r"\bcookies?\b.*\b(accept|policy|use)|privacy policy|terms of (use|service)|enable javascript|"
                     r"lorem ipsum".encode(), re.I)
#: A notice has one of these; looking for them first spares most lines the pattern.
_NOTICE_PARTS = [k.encode() for k in ("licen", "released under", "terms of", "creative commons", "cc by", "cc-by",
                                      "rights reserved", "copyright", "©", "cookie", "privacy policy",
                                      "enable javascript", "lorem ipsum")]
LONG_LINE = 40


def line_fault(line: bytes, words: list[bytes], seen: set) -> str | None:
    """The rule that the line fails, or None. ``seen``: earlier long lines of the document."""
    n = len(words)
    if not n:
        return None
    solid = len(line.translate(None, _SPACE))
    if n >= 3 and (2 * len(line.translate(None, _NO_LETTERS)) < solid or 2 * line.count(b"!!") > n):
        return "punctuation"
    if 10 * (len(line) - len(line.translate(None, _SYMBOLS))) > solid:
        return "punctuation"
    if n >= 8 and 2 * len(set(words)) <= n + 2 and 2 * max(Counter(words).values()) > n:
        return "punctuation"
    separators = len(_SEPARATORS.findall(line))
    if separators >= 2 and 4 * separators >= n or n <= 4 and _LINKS.match(line):
        return "navigation"
    if n <= 40:
        low = line.lower()
        if any(k in low for k in _NOTICE_PARTS) and _NOTICE.search(line):
            return "boilerplate"
    if len(line) >= LONG_LINE:
        line = line.strip()
        if line in seen:
            return "boilerplate"
        seen.add(line)
    return None


RULES = T.StructType([T.StructField(n, T.LongType()) for n in
                      ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost", "n_bad_lines")]
                     + [T.StructField("clean", T.StringType())])


def measure(text: str | None) -> tuple:
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()  # bytes: exactly the six ASCII white-space characters part words
    chars = len(text or "") - (len(data) - len(data.translate(None, _SPACE)))
    triples = list(zip(words, words[1:], words[2:]))
    n_repeat = 0
    if len(set(triples)) < len(triples):
        count, upto = Counter(triples), 0
        for i, t in enumerate(triples):
            if count[t] > 1:
                n_repeat += i + 3 - max(i, upto)
                upto = i + 3
    n_dup, lines, kept, seen, lost, bad = 0, set(), [], set(), 0, 0
    for line in data.split(b"\n"):
        own = line.split()
        if own:
            n_dup += line in lines
            lines.add(line)
        if line_fault(line, own, seen):
            lost += len(own)
            bad += 1
        else:
            kept.append(line)
    return (len(words), chars, len(data) - len(data.translate(None, _SYMBOLS)), n_dup, n_repeat, lost, bad,
            b"\n".join(kept).decode("utf-8", "surrogatepass") if bad else None)


@F.pandas_udf(RULES)
def _measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([measure(t) for t in texts], columns=[f.name for f in RULES.fields])


def judge(docs: DataFrame, *, text_col: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """Every document as struct ``row`` with its measures, base_failed, kept, and ``clean``: the
    text without its failing lines (null when it has none)."""
    m = pack(docs, text=F.col(f"`{text_col}`")).withColumn("m", _measured.asNondeterministic()("text"))
    base = (F.col("m.n_words") < MIN_WORDS) | (100 * F.col("m.n_repeat_words") > MAX_REPEATED * F.col("m.n_words"))
    kept = ~base & (F.col("m.n_lost") <= F.col("m.n_words") * max_lost)
    return m.select("row", "text", "m.*", base.alias("base_failed"), kept.alias("kept"))


def clean(docs: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The documents that are kept, without their failing lines."""
    kept = judge(docs, text_col=text_col, **options).where("kept")
    return unpack(kept.withColumn("row", F.col("row").withField(f"`{text_col}`", F.coalesce("clean", "text"))))


def query(spark, sf_dir: str) -> DataFrame:
    found = judge(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "kept", "n_lost", "n_bad_lines")
