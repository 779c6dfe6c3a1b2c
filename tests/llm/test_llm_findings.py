"""Cases that a review found to be done in part only."""

import random

import pandas as pd

from draftledger.llm import fim, pii, toxicity


def prose(seed, n=80):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def test_toxicity_learns_from_texts_that_share_a_line():
    header = "All of this text stands under the licence that is printed on the first page."
    texts = [f"{header}\n{prose(i)}" for i in range(60)]
    assert sorted(t for group in toxicity.near_copies(texts + texts) for t in group) == sorted(texts)
    assert len(toxicity.near_copies(texts)) == 60


def test_toxicity_counts_near_copies_once():
    text = prose(1, 200)
    copies = [text.replace(text.split()[i], "other") for i in range(0, 200, 20)]
    groups = toxicity.near_copies(copies + [prose(2, 200)])
    assert sorted(map(len, groups)) == [1, 10]
    ordinary = [[prose(i)] for i in range(100, 160)]
    assert not toxicity.telling_words(groups, ordinary)  # in ten near-copies, which are one text


def test_personal_data_in_forms_that_no_base_pattern_matches(spark):
    planted = ["2001:db8:85a3:8d3:1319:8a2e:370:7348", "fe80:1::8a2e:370:7348", "jane.doe(at)example(dot)org", "bob [at] mail.net", "020 7946 0958", "(555) 555-0100"]
    plain = ["at 12:34:56:78 then", "00:1b:44:11:3a:b7", "on 2024-01-02 we", "number 1234567890123456", "a::b"]
    texts = [f"please call {t} today" for t in planted] + [f"some words {t} more" for t in plain]
    texts += [f"write to user{i}@example.com or +1 (555) 555-{i:04d}" for i in range(200)]
    out = [r["text"] for r in pii.redact(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert not [(t, o) for t, o in zip(planted, out) if t in o]
    assert out[len(planted):len(planted) + len(plain)] == texts[len(planted):len(planted) + len(plain)]


def test_personal_data_is_learned_from_every_candidate(spark):
    row = lambda i: {"start": i, "end": i + 9, "generator": i % 3, "confirmed": 0, "positive": i % 2,
                     "features": [float(i % 3), float(i % 2)] + [float(i % 7)] * (pii.N_FEATURES - 2)}
    n = 50_000  # more than the sample of 20,000 that was once fitted on
    candidates = "array<struct<start int, end int, generator int, confirmed int, positive int, features array<double>>>"
    scanned = spark.createDataFrame([([row(i) for i in range(a, a + 500)],) for a in range(0, n, 500)], f"candidates {candidates}")
    made = pii.scan(spark.createDataFrame([(t,) for t in pii.examples()], "text string")).selectExpr("sum(size(candidates))").first()[0]
    model = pii.fit(scanned)
    assert model["fitted"] + model["held_out"] == n + made
    assert abs(model["fitted"] - model["held_out"]) < 0.05 * n


def test_fill_in_middle_hands_on_its_outputs_in_pieces(spark):
    """The outputs of a whole batch were held beside its texts."""
    texts = [prose(i, 5) for i in range(2 * fim.ROWS + 3)]
    batch = (pd.Series([str(i) for i in range(len(texts))]), pd.Series(texts))
    frames = list(fim._made(fim.SEED).func(iter([batch, (batch[0][:1], batch[1][:1])])))
    assert [len(f) for f in frames] == [fim.ROWS, fim.ROWS, 3, 1]
    assert list(pd.concat(frames[:3])["output"]) == [fim.rearrange(t, str(i))[4] for i, t in enumerate(texts)]
