"""The pipeline against its operators, stage by stage, on a small fixture."""

import random

import corpus_pipeline
from eqscene.llm.queries import ORACLES, QUERIES

from .test_free import labelled


def test_registry():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 11)}
    assert set(ORACLES) <= set(QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "decontamination", "tokens"]


def test_pipeline(spark, docs, tmp_path):
    rows, labels = labelled(spark, random.Random(9))
    clean = [(i, t.replace("idiot", "w1")) for i, t in rows]
    passage = clean[1][1]
    near = passage.split()
    near[50] = "changed"
    extra = [(1000, passage), (1001, " ".join(near)), (1002, "line one is here\n" + clean[2][1])]
    docs(clean + extra, clash=False).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, clean[4][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r.doc_id for r in got}
    assert {i for i in ids if i < 300} == {i for i in range(300) if i % 3 and i != 4}  # rejected: every third; contaminated: 4
    assert 1001 not in ids  # near document 1
    assert 1002 in ids  # keeps its own line
    assert all(r.n_tokens == len(r.token_ids) for r in got)
