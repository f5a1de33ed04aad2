"""The pipeline's stages with repeated rows, null identifiers, null texts and empty tables."""

import random

import pytest
from conftest import SMALL
from test_near_copies import left

import corpus_pipeline

def text(seed, n=60):
    return " ".join(f"w{x}" for x in random.Random(seed).sample(range(5000), n))


def test_exact_dedup_keeps_one_of_repeated_rows(spark):
    a, b, c = text(1), text(2), text(3)
    rows = [(1, a), (1, a), (2, a), (3, b), (3, c), (4, b), (None, c), (None, c), (5, None), (6, ""), (None, None)]
    assert left(spark, "exact dedup", rows) == sorted([(1, a), (3, b), (None, c), (None, None)], key=repr)


def test_near_dedup_keeps_one_of_repeated_rows(spark):
    a, b, c = text(1), text(2), text(3)
    rows = [(1, a), (1, a), (2, b), (2, c), (0, b), (None, c), (None, c), (7, None), (8, None)]
    assert left(spark, "SimHash near-dedup", rows) == sorted([(1, a), (0, b), (2, c), (7, None)], key=repr)


def test_substring_dedup_keeps_the_number_of_rows(spark):
    a, tail = text(1), text(9, 20)
    rows = [(1, a), (2, f"{a} {tail}"), (2, f"{a} {tail}"), (3, None), (3, a), (None, f"{a} end")]
    assert left(spark, "substring dedup", rows) == sorted([(1, a), (2, tail), (2, tail), (3, None), (3, ""), (None, "end")], key=repr)


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_empty_tables(spark, stage):
    assert left(spark, stage, []) == []


def test_quality_keeps_rows_apart(spark):
    some = spark.read.parquet(f"{SMALL}/documents.parquet").limit(20).collect()
    good = left(spark, "quality classifier", [(r.doc_id, r.text) for r in some])
    again = left(spark, "quality classifier", [(i, r.text) for r in some for i in (r.doc_id, r.doc_id, None)])
    assert len(again) == 3 * len(good)
    left(spark, "quality classifier", [(None, None), (1, None)])


def test_long_texts(spark):
    """A text of many words goes through all stages whole, beside a near copy and a repeated passage of it."""
    long = text(7, 4000) + " " + " ".join(f"{x}" for x in range(60_000))
    words = long.split()
    near = " ".join(words[:30_000] + ["another"] + words[30_001:])
    rows = [(1, long), (2, long), (3, near), (4, " ".join(["start", *words[100:200], "end"]))]
    assert left(spark, "exact dedup", rows) == sorted([(1, long), (3, near), rows[3]], key=repr)
    assert left(spark, "SimHash near-dedup", rows[1:]) == sorted([(2, long), rows[3]], key=repr)
    assert left(spark, "substring dedup", [rows[0], rows[3]]) == sorted([(1, long), (4, "start end")], key=repr)
    assert set(left(spark, "quality classifier", rows)) <= set(rows)
    docs = spark.createDataFrame([(1, long), (2, None)], "doc_id long, text string")
    packed = corpus_pipeline.pack(spark, docs, SMALL).collect()
    assert sorted(r.start for r in packed if r.doc_id == 1) == list(range(0, 4096 * sum(r.doc_id == 1 for r in packed), 4096)) and [r.length for r in packed if r.doc_id == 2] == [1]


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_columns_whose_names_clash(spark, stage):
    """Columns named like those that stages and operators make come out as they went in."""
    names = ["row", "Row_", "no text", "No Text_", "data", "carried", "keep_id", "kept", "fp", "bucket", "text_sha256", "n_words", "score"]
    columns = ["doc_id", "text", "lang", "source", "n_chars", *names]
    rows = [(i, text(i % 3 + 20), "en", "s", 1, *(f"{n} {i}" for n in names)) for i in range(6)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    docs = spark.createDataFrame(rows, schema)
    out = dict(corpus_pipeline.STAGES)[stage](spark, docs, SMALL)
    assert out.columns == columns
    got = {r.doc_id: r for r in out.collect()}
    assert all(got[i][n] == f"{n} {i}" for i in got for n in names) and (stage == "quality classifier" or set(got) >= {0, 1, 2})


def test_substring_dedup_without_n_chars(spark):
    docs = spark.createDataFrame([(1, text(1)), (2, text(1))], "doc_id long, text string")
    assert sorted(map(tuple, corpus_pipeline.drop_repeats(spark, docs, SMALL).collect())) == [(1, text(1)), (2, "")]
