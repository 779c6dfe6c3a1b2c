"""The stages one after the other, each against what it should do to its own input."""

import re
from collections import Counter

import corpus_pipeline
from draftledger.llm import decontaminate, mixing, toxicity
from draftledger.llm.common import materialize

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontaminate", "personal_data", "mix"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        out = materialize(stage(spark, docs, SF), name)
        after = out.collect()
        if name != "mix":
            assert out.columns == columns and out.dtypes == docs.dtypes
            assert len({r["doc_id"] for r in after}) == len(after)
            assert all(r["n_chars"] == len(r["text"]) for r in after if r["text"] != before[r["doc_id"]]["text"])
        if name == "toxicity":
            model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
            scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).select("row.doc_id", "score").collect()}
            assert {r["doc_id"] for r in after} == {i for i, s in scores.items() if s < 0.5}
        if name == "near_duplicates":
            assert len({r["text"] for r in after}) == len(after)
        if name == "decontaminate":
            items = [decontaminate.words_of(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            windows = {tuple(w[i:i + 10]) for w in items for i in range(max(1, len(w) - 9))}
            changed = [r for r in after if r["text"] != before[r["doc_id"]]["text"]]
            for r in after:
                words = decontaminate.words_of(before[r["doc_id"]]["text"])
                hit = any(tuple(words[i:i + 10]) in windows for i in range(len(words) - 9))
                assert hit == (r in changed)
        if name == "personal_data":
            assert not any(re.search(r"[a-z]@[a-z]+\d?\.example", r["text"]) for r in after)
        if name == "mix":
            plan = {r["doc_id"]: r["copies"] for r in mixing.plan(docs).select("row.doc_id", "copies").collect()}
            assert Counter(r["doc_id"] for r in after) == Counter({i: n for i, n in plan.items() if n})
            assert {r["copy"] for r in after} <= {1, 2, 3}
        docs = out


def test_empty_table(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
