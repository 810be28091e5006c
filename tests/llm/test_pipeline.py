"""The pipeline's stages against brute force, each on its own input."""

import sys
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import helpers as H  # noqa: E402

import corpus_pipeline as P  # noqa: E402
from tessera.llm.common import stage_table  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bad = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0").collect()}
    columns, inputs = docs.columns, {}
    for name, stage in P.STAGES:
        inputs[name] = docs
        docs = stage_table(stage(spark, docs, SF), name)
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
    rows = {n: [(r.doc_id, r.text) for r in d.collect()] for n, d in inputs.items()}
    ids = {n: [i for i, _ in r] for n, r in rows.items()}
    gone = set(ids["quality"]) - set(ids["exact_dedup"])
    assert len(gone & bad) >= 0.8 * len(bad & set(ids["quality"])) and len(gone - bad) < 0.2 * len(ids["quality"])
    assert sorted(ids["simhash"]) == sorted(i for i, keep, *_ in H.exact(rows["exact_dedup"]) if i == keep)
    assert sorted(ids["mixing"]) == sorted(i for i, _, c in H.simhash(rows["simhash"]) if i == c)
    words = Counter(i for i, t in rows["packing"] for _ in H.words(t))
    before = Counter(i for i, t in rows["mixing"] for _ in H.words(t))
    assert all(n <= 2 * before[i] for i, n in words.items())
    longest = Counter()  # documents stay whole, so a source may miss its target by half a document
    for r in inputs["mixing"].collect():
        longest[r.source] = max(longest[r.source], len(H.words(r.text)))
    assert abs(sum(words.values()) - 1.5 * sum(before.values())) <= sum(n / 2 + 1 for n in longest.values())
    assert {(i, t) for i, t in rows["packing"]} <= {(i, t) for i, t in rows["mixing"]}
    want = Counter(ids["packing"])
    assert Counter(r.doc_id for r in docs.where("start = 0").collect()) == want


def test_awkward_rows(spark, tmp_path):
    H.awkward(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).count() > 0
    H.awkward(spark).limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/none/labels.parquet")
    assert P.run(spark, f"{tmp_path}/none").count() == 0
