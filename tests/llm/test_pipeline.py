"""The pipeline's stages, each on what the one before kept."""

import corpus_pipeline
from evidtable.llm import pii
from evidtable.llm.common import stage


def test_stages(spark):
    text = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    rows = [(i, text(i)) for i in range(20)] + [(20, text(3)), (21, None), (22, "one two"), (23, text(50) + " mail a.b@c.example.com now"), (None, text(70))]
    docs = spark.createDataFrame([(a, b, "en", "s", len(b or "")) for a, b in rows], "doc_id long, text string, lang string, source string, n_chars long")
    seen = {}
    for name, work in corpus_pipeline.STAGES[:2]:
        docs = stage(work(spark, docs, ""), name)
        seen[name] = {r["doc_id"] for r in docs.collect()}
    assert {21, 22} & seen["quality_rules"] == set() and 23 in seen["quality_rules"]
    assert 20 not in seen["near_dedup"] and 3 in seen["near_dedup"] and None in seen["near_dedup"]
    out = {r["doc_id"]: r["text"] for r in corpus_pipeline.private(spark, docs, "").collect()}
    assert "[EMAIL]" in out[23] and not any(k == 0 for t in out.values() for _, k, _ in pii.base_spans(t))
