"""Classifiers by held-out accuracy, and the pipeline stage by stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_whole_job import brute_firsts
from screenroll.llm import decontaminate, pii, quality, toxicity
from screenroll.llm.common import read, remainder, ship, slices, stage

SF = "/root/testdata/sf0.01"


def test_isotonic_is_monotone_and_keeps_means():
    import numpy as np

    x, y = quality.isotonic(np.arange(5.0), np.array([0.0, 0.6, 0.2, 0.9, 0.9]), np.array([1, 1, 1, 2, 1.0]))
    assert (np.diff(y) >= 0).all() and y[1] == pytest.approx(0.4)


@pytest.mark.parametrize("name, label, module", [("op7_quality", "quality", quality), ("op4_toxicity", "toxic", toxicity)])
def test_held_out_accuracy(spark, name, label, module):
    scored = stage(corpus_pipeline.REGISTRY[name][0](spark, SF), "test-scores")
    fold = remainder("doc_id", module.FOLDS) == module.HELD_FOLD
    assert scored.count() == read(spark, SF, "documents").count()
    assert scored.where(F.col("held_out") != fold).count() == 0
    assert scored.where("score is null or score < 0 or score > 1 or predicted <> cast(score >= 0.3 as int)").count() == 0
    held = scored.where("held_out").join(read(spark, SF, "labels").select("doc_id", label), "doc_id").select(
        F.col(label), "predicted").collect()
    assert sum(a == b for a, b in held) >= 0.9 * len(held)


def test_models_take_empty_and_missing_input(spark, documents):
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (None, 1, 1), (3, None, None), (1, 1, 1)], "doc_id long, quality int, toxic int")
    rows = documents([(1, "good words here"), (2, None), (3, ""), (None, "x"), (3, "")], score="clash", label="clash", stats="clash")
    for module in (quality, toxicity):
        got = module.report(rows, labels).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
        assert module.report(documents([]), labels).count() == 0
        assert module.report(rows, labels.where("false")).count() == 5


def test_offending_sentences_are_located(spark, documents):
    rows = read(spark, SF, "documents")
    model = toxicity.train(rows, read(spark, SF, "labels"))
    found = toxicity.offending(documents([(1, "Thou rest there. You idiot and scum pathetic loser! Er heon.")]), model).collect()[0].offending
    assert [s.sentence for s in found] == ["You idiot and scum pathetic loser!"]


def test_pipeline_stages_take_effect(spark):
    docs = read(spark, SF, "documents")
    columns, before = docs.columns, docs
    kept = {}
    for name, function in corpus_pipeline.STAGES:
        after = stage(function(spark, before, SF), f"test-{name}")
        kept[name] = (before, after)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == columns
        before = after
    start, end = kept["quality"]
    model = quality.train(quality.learnable(quality.stats_table(start)), read(spark, SF, "labels"), "quality")
    scores = quality.score_stats(quality.stats_table(start), model).where(F.col("score") >= quality.THRESHOLD)
    assert {r.doc_id for r in scores.collect()} == {r.doc_id for r in end.collect()}
    start, end = kept["near_copies"]
    assert brute_firsts([(r.doc_id, r.text) for r in start.collect()], 5, 80, 100) == {r.doc_id for r in end.collect()}
    start, end = kept["decontamination"]
    leaks = {r.doc_id for r in decontaminate.find_leaks(start, read(spark, SF, "benchmark")).collect()}
    assert leaks and {r.doc_id for r in start.collect()} - leaks == {r.doc_id for r in end.collect()}
    start, end = kept["personal_data"]
    assert start.count() == end.count() and pii.report(start).where("spans <> ''").count() > 0
    assert pii.report(end).where("n_email + n_ip + n_card + n_phone > 0").count() == 0
    start, end = kept["tokens"]
    assert start.count() == end.count() and end.where("not intact or n_tokens is null").count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_any_input(spark, documents, name):
    """NULL ids and texts, repeated rows, clashing names, empty tables."""
    stage_of = dict(corpus_pipeline.STAGES)[name]
    words = " ".join(r.text for r in read(spark, SF, "documents").where("lang = 'en'").limit(3).collect())
    rows = [(1, words), (None, words), (2, None), (3, ""), (3, ""), (None, None), (4, "call me at a@b.org or +1 555 123 4567")]
    clash = dict.fromkeys(["pii", "ids", "n_tokens", "intact", "decoded", "set", "n", "score", "stats", "item_id", "component_id", "n_chars"], "1")
    docs = documents(rows, **clash)
    out = stage_of(spark, docs, SF)
    kept = stage(out, "test-any")
    assert len({c.lower() for c in kept.columns}) == len(kept.columns) and set(docs.columns) - set(kept.columns) <= {"decoded"}
    assert 0 <= kept.count() <= len(rows)
    assert stage_of(spark, docs.where("false"), SF).count() == 0
    if name == "decontamination":
        item = read(spark, SF, "benchmark").first().text
        assert stage_of(spark, documents([(None, item), (5, item), (5, words)]), SF).collect()[0].text == words


def test_slices_are_bounded_by_rows_and_bytes(spark):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (10, 10, 50, 10, 200, 5, 5, 5, 5)] + [None], "n": list(range(10))})
    cut = [b.column("n").to_pylist() for b in slices([batch], rows=3, most=60)]
    assert cut == [[0, 1], [2, 3], [4], [5, 6, 7], [8, 9]]


def test_batches_to_workers_are_bounded(spark):
    import pyarrow as pa

    ship(spark)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    rows = read(spark, "/root/testdata/sf0.1", "documents").select("text").mapInArrow(sizes, "size long").collect()
    assert max(r["size"] for r in rows) < 6 << 20
