"""Online learning goes through all runs of a task, however they come in Arrow batches."""

import random

import numpy as np
import pyarrow as pa

from folioframe.llm import lm_scoring

CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_weights_do_not_depend_on_batches(spark):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=60)).encode()) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, data binary").coalesce(1)
    before = spark.conf.get(CONF)
    try:
        weights = []
        for n in (before, "100"):
            spark.conf.set(CONF, n)
            weights.append(np.concatenate(lm_scoring.train(docs).weights))
    finally:
        spark.conf.set(CONF, before)
    assert np.allclose(*weights, atol=1e-5)


def test_blocks():
    value = np.arange(3 * lm_scoring.BLOCK + 5)
    columns = (value, value % 7 + 1)
    batches = [pa.record_batch([pa.array(x[a : a + 10_000]) for x in columns], ["run", "n"]) for a in range(0, len(value), 10_000)]
    got = [*lm_scoring._columns(iter(batches))]
    assert [len(v) for v, *_ in got] == [lm_scoring.BLOCK] * 3 + [5]
    assert all(np.array_equal(np.concatenate(x), want) for x, want in zip(zip(*got, strict=True), columns, strict=True))
    assert [*lm_scoring._columns(iter(batches[:0]))] == []


def test_scores_do_not_depend_on_batches(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["one", "two", "three", "x"], k=rng.randint(0, 300)))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    before = spark.conf.get(CONF)
    try:
        scores = []
        for n in (before, "7"):
            spark.conf.set(CONF, n)
            scores.append([r.score for r in lm_scoring.lm_scores(docs).orderBy("doc_id").collect()])
    finally:
        spark.conf.set(CONF, before)
    assert np.allclose(*scores, atol=1e-5)
