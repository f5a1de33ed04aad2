"""Near copies against brute force."""

import random

import pytest
from conftest import SMALL

import corpus_pipeline
from folioframe.llm import near_copies

STAGES = dict(corpus_pipeline.STAGES)
COLUMNS = "doc_id long, text string, n_chars int"


def left(spark, stage, rows):
    docs = spark.createDataFrame([(i, t, None if t is None else len(t)) for i, t in rows], COLUMNS).repartition(3)
    out = STAGES[stage](spark, docs, SMALL)
    return sorted(((r.doc_id, r.text) for r in out.select("doc_id", "text").collect()), key=repr)


def brute(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def edited(words, n, rng):
    out = list(words)
    for at in rng.sample(range(len(out) // 12), n):
        out[at * 12 + 5] = f"new{rng.random()}"
    return out


def corpus(copies=40, seed=1):
    rng = random.Random(seed)
    rows = []
    for k in range(30):
        words = [f"w{x}" for x in rng.choices(range(5000), k=400)]
        rows += [(10 * k, " ".join(words)), (10 * k + 1, " ".join(edited(words, 6, rng))), (10 * k + 2, " ".join(edited(words, 20, rng)))]
    words = [f"v{x}" for x in rng.choices(range(5000), k=400)]
    rows += [(1000 + k, " ".join(edited(words, 3, rng))) for k in range(copies)]  # a dense group
    return [*rows, (2000, "Two words"), (2001, "two\nWORDS"), (2002, "two words more"), (2003, "four words are short")]


def linked(pairs):
    """Groups of what pairs connect."""
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in list(root)}


@pytest.mark.parametrize("long_list", [near_copies.LONG_LIST, 4])
def test_pairs(spark, monkeypatch, long_list):
    """Every pair that is found is similar, and what is similar is connected."""
    monkeypatch.setattr(near_copies, "LONG_LIST", long_list)
    rows = corpus()
    sets = {i: brute(t) for i, t in rows}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    df = spark.createDataFrame(rows, "row long, text string").selectExpr("row", "cast(text as binary) as data").repartition(3)
    found = near_copies.similar_rows(near_copies.marks(df), df).collect()
    got = {(r.a, r.b) for r in found}
    assert len(got) == len(found) and got <= want and linked(got) == linked(want)
    assert len(got) < len(want), "a dense group gives stars, not all its pairs"
    assert any(a == 0 and b == 1 for a, b in got) and not any(b % 10 == 2 for a, b in got if b < 300)


def test_pairs_of_a_frequent_row(spark):
    """The pairs of a frequent first row are dealt over slices; none is lost."""
    rng = random.Random(2)
    words = [f"v{x}" for x in rng.choices(range(5000), k=60)]
    rows = [(k, " ".join(words) + f" end{k}") for k in range(400)]
    df = spark.createDataFrame(rows, "row long, text string").selectExpr("row", "cast(text as binary) as data").repartition(3)
    pairs = spark.range(1, 400).selectExpr("0L as a", "id as b")
    assert near_copies.verified(pairs, df).count() == 399


def test_stage_drops_edited_copies(spark):
    rows = corpus(5)
    ids = [i for i, _ in left(spark, "SimHash near-dedup", rows)]
    assert not {10 * k + 1 for k in range(30)} & set(ids)
    assert {10 * k for k in range(30)} | {10 * k + 2 for k in range(30)} <= set(ids)


def test_small_table_pairs(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    sets = {r.doc_id: brute(r.text) for r in docs.collect()}
    want = {(a, b) for a in sets for b in sets if a < b and sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    rows = docs.selectExpr("doc_id as row", "cast(text as binary) as data")
    got = {(r.a, r.b) for r in near_copies.similar_rows(near_copies.marks(rows), rows).collect()}
    assert got <= want and linked(got) == linked(want) and want


def template_rows(n, pairs, seed=5):
    """Rows of one pattern, far from each other, and pairs of near copies among them."""
    rng = random.Random(seed)
    fixed = [f"f{i}" for i in range(400)]
    slots = [13 * i + 4 for i in range(30)]

    def row(values):
        words = list(fixed)
        for at, v in zip(slots, values, strict=True):
            words[at] = f"v{at}_{v}"
        return " ".join(words)

    rows = [[rng.randrange(3) for _ in slots] for _ in range(n)]
    for i in range(pairs):
        b = list(rows[2 * i])
        for at in rng.sample(range(30), 5):
            b[at] = (b[at] + 1) % 3
        rows[2 * i + 1] = b
    return [row(x) for x in rows]


@pytest.mark.parametrize("size", [2 << 20, 40_000])
def test_long_lists_lose_no_pair(spark, monkeypatch, size):
    """Rows of one pattern share long lists, of one slice or of many; all near copies among them are linked, whatever the first rows are."""
    monkeypatch.setattr(near_copies, "LONG_LIST", 2)
    monkeypatch.setattr(near_copies, "SLICE", size, raising=False)
    texts = template_rows(300, 40)
    rows = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "row long, data binary").repartition(4)
    got = {(r.a, r.b) for r in near_copies.similar_rows(near_copies.stored(near_copies.marks(rows)), rows).collect()}
    sets = [brute(t) for t in texts]
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert got <= want and linked(got) == linked(want) and len(want) >= 40


def test_rows_that_a_first_row_links_meet_the_others(spark, monkeypatch):
    """Of a chain in long lists, the middle is linked to a first row and the end only to the middle."""
    monkeypatch.setattr(near_copies, "LONG_LIST", 2)
    rng = random.Random(7)
    words = [f"w{x}" for x in range(400)]
    rows = []
    for k in range(12):
        chain = [[f"c{k % 3}x{w}" for w in words]]
        for step in range(4):  # each changes places of its own
            chain.append([f"{w}new{k}" if i % 65 == 8 * step + 5 else w for i, w in enumerate(chain[-1])])
        rows += [" ".join(x) for x in chain]
    rng.shuffle(rows)
    sets = [brute(t) for t in rows]
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    df = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(rows)], "row long, data binary").repartition(3)
    got = {(r.a, r.b) for r in near_copies.similar_rows(near_copies.stored(near_copies.marks(df)), df).collect()}
    assert got <= want and linked(got) == linked(want)
    assert any(linked(want)[i] == linked(want)[j] and (i, j) not in want for i in linked(want) for j in linked(want) if i < j)
