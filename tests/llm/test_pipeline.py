"""The stages in order, each on what its predecessor kept."""

import hashlib

import corpus_pipeline
import __spark_entry__
from tests.llm.test_neardup import brute
from tests.llm.test_repeats import first_occurrence_kept


def test_stages(spark, sf):
    source = spark.read.parquet(f"{sf}/documents.parquet")
    docs, kept = source, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = corpus_pipeline.write_stage(stage(spark, docs, sf), f"test-{name}")
        assert docs.columns == source.columns
        kept[name] = before, {r.doc_id: r for r in docs.collect()}
    before, after = kept["language_id"]
    assert len(after) >= 0.97 * len(before)
    before, after = kept["line_dedup"]
    ids = sorted(before)
    cut = {i: [x.strip(" \t\r\v\f") for x in before[i].text.split("\n") if x.strip(" \t\r\v\f")] for i in ids}
    for i, gone in zip(ids, first_occurrence_kept([cut[i] for i in ids], 3)):
        left = [x for x, g in zip(cut[i], gone) if not g]
        assert (i in after) == bool(left or not cut[i])
        if left:
            assert [x.strip(" \t\r\v\f") for x in after[i].text.split("\n") if x.strip(" \t\r\v\f")] == left
    before, after = kept["near_dedup"]
    ids = sorted(before)
    assert set(after) == {i for i, (_, top) in zip(ids, brute([before[i].text for i in ids], 5, 80)) if ids[top] == i}
    before, after = kept["decontamination"]
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for i, r in before.items():
        if any(t in r.text for t in items):
            assert i not in after
    assert len(before) - len(after) < 0.1 * len(before)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in last} == set(after) and all(r.n_tokens == len(r.ids) for r in last)


def test_last_stage_tells_what_its_ids_decode_to(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(20)
    want = {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in docs.collect()}
    assert {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()} == want


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
