"""The pipeline against brute force, stage by stage and from end to end, on the smallest tables."""

import zlib

import numpy as np
import pytest
from conftest import SMALL
from test_models import brute_scores
from test_near_copies import brute as shingles
from test_text_ops import BPE, brute_fingerprint, brute_substrings, norm_groups
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from folioframe.llm._common import stored


def near_roots(text):
    """Smallest identifier reachable over SimHash links and similarities of 0.8."""
    ids = sorted(text)
    points, sets = {i: brute_fingerprint(text[i], 3) for i in ids}, {i: shingles(text[i]) for i in ids}
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            shared = len(sets[a] & sets[b])
            if (points[a] ^ points[b]).bit_count() <= 2 or shared and shared >= 0.8 * (len(sets[a]) + len(sets[b]) - shared):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


@pytest.fixture(scope="module")
def expected(spark):
    """What each stage leaves, by plain Python, each from what the one before leaves."""
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()]
    score, _ = brute_scores(list(text.items()), labels)
    good = {i: t for i, t in text.items() if score[i] >= 0.3}
    unique = {min(g)[1] for g in norm_groups(list(good.items())).values()}
    apart = {i for i, r in near_roots({i: good[i] for i in unique}).items() if i == r}
    left = {i: (good[i] if not gone else kept) for i, _, gone, kept in brute_substrings([(i, good[i]) for i in apart])}
    return {"quality classifier": good, "exact dedup": {i: good[i] for i in unique}, "SimHash near-dedup": {i: good[i] for i in apart}, "substring dedup": left}


def test_stages(spark, expected):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SMALL))
        assert docs.columns == columns
        assert {r.doc_id: r.text for r in docs.collect()} == expected[name], name


def test_run(spark, expected):
    """The pieces that run() packs are those of what brute force leaves, each in one place of a full enough sequence."""
    rows = corpus_pipeline.run(spark, SMALL).collect()
    tokenizer, want = Tokenizer.from_file(BPE), []
    for i, t in expected["substring dedup"].items():
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        want += [(i, k, s, len(ids[s : s + 4096]), zlib.crc32(np.array(ids[s : s + 4096], "<u4").tobytes())) for k, s in enumerate(range(0, len(ids), 4096))]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == np.cumsum([0, *(n for _, n in b[:-1])]).tolist() and sum(b[-1]) <= 4096
    assert len(bins) <= -(-sum(x[3] for x in want) // 4096) + 2
    assert "pipeline" in entry.queries() and len([n for n in entry.queries() if n.startswith("op")]) == 10
