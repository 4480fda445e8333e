"""The pipeline, stage by stage, on the smallest table."""

import corpus_pipeline
from test_documents import check_packing, slow_groups, slow_pii, slow_print, words

from tidemill.llm import mixing


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, sf).cache()
        held[name] = (before, docs)
        if name != "pack":
            assert docs.columns == columns and docs.schema["doc_id"].dataType == before.schema["doc_id"].dataType
    before, after = held["language_id"]
    assert after.count() >= 0.99 * before.count()
    before, after = held["near_dedup"]
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(set(slow_groups({r["doc_id"]: slow_print(r["text"]) for r in before.collect()}).values()))
    before, after = held["sanitise"]
    assert before.count() == after.count() and not any(slow_pii(r["text"]) for r in after.collect())
    before, after = held["mix_sources"]
    assert sum(len(words(r["text"])) for r in after.collect()) == sum(r["taken"] for r in mixing.plan(before).collect())
    before, after = held["pack"]
    copies = [(r["doc_id"], r["text"]) for r in before.collect()]
    once = {d: t for d, t in copies if [x for x, _ in copies].count(d) == 1}
    check_packing([r for r in after.collect()], {}, spare=0.05)
    pieces = [r for r in after.collect() if r["doc_id"] in once]
    total = {}
    for r in pieces:
        total.setdefault(r["doc_id"], [r["doc_tokens"], 0])[1] += r["length"]
    assert set(total) == set(once) and all(a == b for a, b in total.values())


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0
