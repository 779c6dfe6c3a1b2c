"""Fill-in-middle transformation: a Fenwick tree over fixed text blocks finds the cuts.

A text is read as units (a run of ASCII letters, or any other code point). Two cuts, drawn from a
hash of the document's id, part it into prefix, middle and suffix, which are put in another order
behind markers. The cuts are numbers of units, so a unit is never split.

The text is looked at in blocks of ``BLOCK`` code points. A Fenwick tree holds for every block how
many units begin in it and how many code points it has. A cut is found by binary lifting: from the
largest power of two down, the descent takes each stretch of blocks whose units all lie before
the cut and adds up its code points; what is left names a unit of one block, and only that
block is looked at again. Building is linear in the text, a cut takes the logarithm of its blocks, and besides
the text no more than one block and two numbers for each block are held.

A text that is empty, has one of the markers in it, or is drawn to stay is left as it is
(``plain``); so every output can be turned back, which ``restored`` does from output and form alone.

Defined results: null text is empty; a null id draws as an empty string does; repeated rows get
equal outputs; texts are read whole; an empty table gives an empty result; columns of the input never
clash with the working columns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from draftledger.llm.common import load, pack, unpack

BLOCK = 4096
#: Outputs that a Python worker holds at once.
ROWS = 256
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred draws: documents that are rearranged, and of those the ones whose suffix comes first.
REARRANGED, SUFFIX_FIRST = 90, 20
SEED = "1"
MADE = "n long, form string, prefix_chars long, middle_chars long, output string"


def unit_starts(block: str, in_word: bool) -> tuple[np.ndarray, bool]:
    """For each code point whether a unit begins there; ``in_word``: whether the code point before
    the block is a letter. Also that of the block's last one."""
    codes = np.frombuffer(block.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = (codes | 32) - np.uint32(97) < 26
    begins = ~letter
    begins[1:] |= ~letter[:-1]
    begins[0] |= not in_word
    return begins, bool(letter[-1])


class Fenwick:
    """Running totals of (units, code points) over the blocks of one text."""

    def __init__(self, text: str, block: int = BLOCK):
        self.text, self.block = text, block
        self.units, self.chars = [0], [0]
        in_word = False
        for at in range(0, len(text), block):
            some = text[at:at + block]
            begins, in_word = unit_starts(some, in_word)
            self._append(int(np.count_nonzero(begins)), len(some))
        self.n = self._total()

    def _append(self, units: int, chars: int) -> None:
        """One more block: its node is the block and the nodes of the stretches right before it."""
        k = len(self.units)
        before = k - 1
        while before > k - (k & -k):
            units, chars = units + self.units[before], chars + self.chars[before]
            before &= before - 1
        self.units.append(units)
        self.chars.append(chars)

    def _total(self) -> int:
        total, k = 0, len(self.units) - 1
        while k:
            total += self.units[k]
            k &= k - 1
        return total

    def place(self, units: int) -> int:
        """Code points before the unit of that number (the text's length if it is the number of units)."""
        if units >= self.n:
            return len(self.text)
        at = chars = 0
        step = 1 << (len(self.units) - 1).bit_length()
        while step:
            if at + step < len(self.units) and self.units[at + step] <= units:
                at += step
                units -= self.units[at]
                chars += self.chars[at]
            step >>= 1
        some = self.text[chars:chars + self.block]
        begins, _ = unit_starts(some, chars > 0 and _is_letter(self.text[chars - 1]))
        return chars + int(np.flatnonzero(begins)[units])


def _is_letter(c: str) -> bool:
    return c.isascii() and c.isalpha()


def draws(key: str, seed: str = SEED) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{seed}:{key}".encode("utf-8", "surrogatepass")).hexdigest()
    return tuple(int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))


def rearrange(text: str, key: str, seed: str = SEED, block: int = BLOCK) -> tuple:
    """(units, form, code points of prefix and of middle, output) of one text."""
    h1, h2, h3, h4 = draws(key, seed)
    tree = Fenwick(text, block)
    if not text or h3 % 100 >= REARRANGED or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return tree.n, "plain", None, None, text
    one, two = sorted((h1 % (tree.n + 1), h2 % (tree.n + 1)))
    a, b = tree.place(one), tree.place(two)
    if h4 % 100 < SUFFIX_FIRST:
        return tree.n, "spm", a, b - a, "".join((SUFFIX, text[b:], PREFIX, text[:a], MIDDLE, text[a:b]))
    return tree.n, "psm", a, b - a, "".join((PREFIX, text[:a], SUFFIX, text[b:], MIDDLE, text[a:b]))


def _made(seed: str):
    @F.pandas_udf(MADE)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for keys, texts in batches:
            for at in range(0, len(keys), ROWS):  # the outputs of a whole batch never stand beside its texts
                yield pd.DataFrame([rearrange(t, k, seed) for k, t in zip(keys[at:at + ROWS], texts[at:at + ROWS])],
                                   columns=["n", "form", "prefix_chars", "middle_chars", "output"]).astype(
                    {"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    return run.asNondeterministic()


def transform(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", seed: str = SEED) -> DataFrame:
    """Every document as struct ``row`` with n (units), form, prefix_chars, middle_chars and output."""
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    made = pack(docs, made=_made(seed)(key, F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    return made.select("row", "made.*")


def rearranged(docs: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The documents with their text in the new order; null texts stay null."""
    new = F.when(F.col("row")[text_col].isNotNull(), F.col("output"))
    return unpack(transform(docs, text_col=text_col, **options).withColumn("row", F.col("row").withField(f"`{text_col}`", new)))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. A marker occurs once, as texts with one are plain."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    # psm: prefix, suffix, middle behind the first marker; spm: suffix, prefix, middle
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def query(spark, sf_dir: str) -> DataFrame:
    made = transform(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", _sha(F.col("output")).alias("output_sha256"),
                       _sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u
  FROM documents),
h AS (
  SELECT *, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h),
p AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
         array_to_string(u[b + 1:n], '') AS suffix
  FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
