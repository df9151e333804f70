"""The pipeline's stages on the smallest tables, each against its input."""

import brute
import corpus_pipeline

from chartlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_queries_are_named_by_operator():
    assert sorted(QUERIES) == sorted(["pipeline", *[k for n in range(1, 14) for k in QUERIES if k.startswith(f"op{n}_")]])


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        old = {r.doc_id: r.text for r in before.collect()}
        new = {r.doc_id: r.text for r in docs.collect()}
        assert set(new) <= set(old)
        if name != "mix":
            assert docs.columns == columns
        if name == "quality":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            right = [(i in new) == bool(q) for i, q in labels.items() if i in old]
            assert sum(right) / len(right) > 0.95
        if name == "exact":
            want = brute.exact(list(old.items()))
            assert set(new) == {i for i, x in want.items() if x[2]}
        if name == "near":
            want = brute.near(list(old.items()))
            assert set(new) == {i for i, x in want.items() if x[2]}
        if name == "benchmark":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            hit = brute.decontaminate(list(old.items()), items)
            assert not any(x[4] for x in brute.decontaminate(list(new.items()), items).values())
            assert all(i in new and new[i] == t for i, t in old.items() if not hit[i][4])
        if name == "mix":
            assert docs.where("copies < 1 or copies > 3").count() == 0
            assert all(new[i] == old[i] for i in new)
