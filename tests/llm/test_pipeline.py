"""The pipeline's stages on a small corpus: what each must drop and keep."""

from __future__ import annotations

import random

import corpus_pipeline
from test_operators import labelled_docs, words


def test_stages(spark, tmp_path):
    docs, labels = labelled_docs(spark)
    rows = [(r["doc_id"], r["text"], "en", "s", len(r["text"])) for r in docs.collect()]
    base = words(150, 7000)
    edited = base.split()
    edited[70] = "other"
    passage = words(60, 7001)
    rows += [
        (1000, base, "en", "s", len(base)), (1001, base, "en", "s", len(base)), (1002, " ".join(edited), "en", "s", 1),
        (1003, passage + " " + words(50, 7002), "en", "s", 1), (1004, words(50, 7003) + " " + passage, "en", "s", 1),
        (1005, words(40, 7004) + " grobmar snivoid grobulen", "en", "s", 1), (1006, None, None, None, None),
    ]
    random.Random(1).shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "repeated_passages", "packing"]
    d = spark.read.parquet(f"{tmp_path}/documents.parquet")
    known = {r["doc_id"]: r for r in labels.where("quality in (0, 1) and doc_id < 400").collect()}
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = d.columns
        stage(spark, d, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        d = spark.read.parquet(f"{tmp_path}/{k}")
        if name != "packing":
            assert d.columns == before
        kept.append({r["doc_id"]: r for r in d.collect()})
    assert {i for i in known if known[i]["quality"] == 0}.isdisjoint(kept[0])
    clean = {i for i in known if known[i]["quality"] == 1 and known[i]["toxic"] == 0}
    assert len(clean & set(kept[1])) >= 0.97 * len(clean)
    assert 1005 in kept[0] and 1005 not in kept[1]
    assert 1000 in kept[2] and 1001 not in kept[2] and 1002 not in kept[2] and 1003 in kept[2] and 1004 in kept[2]
    assert passage in kept[3][1003]["text"] and passage not in kept[3][1004]["text"]
    assert all(r["n_chars"] == len(r["text"] or "") for r in kept[3].values())
    assert set(kept[4]) == set(kept[3])
    direct = corpus_pipeline.run(spark, str(tmp_path))
    assert direct.agg({"length": "sum"}).first()[0] == d.agg({"length": "sum"}).first()[0]


def test_scores_leave_the_documents_columns_alone(spark, tmp_path):
    docs, labels = labelled_docs(spark)
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    given = docs.selectExpr("doc_id", "text", "42.0D AS _score", "'x' AS _score_", "1 AS score")
    for stage in (corpus_pipeline.quality, corpus_pipeline.toxicity):
        kept = stage(spark, given, str(tmp_path))
        assert kept.columns == given.columns
        assert {tuple(r) for r in kept.select("_score", "_score_", "score").distinct().collect()} == {(42.0, "x", 1)}
