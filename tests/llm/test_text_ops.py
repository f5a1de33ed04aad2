"""Deduplication and packing against brute force, with the edge cases of each."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import xxhash
from conftest import SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from folioframe.llm import _common as common
from folioframe.llm import exact_dedup, packing, simhash, substring_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, bucket string, fp string, piece string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BPE = public_tokenizers.path("word_bpe_49k.json")


def corpus(n=60, seed=3):
    """Copies, near copies, shared passages, nulls, blanks, odd white space, a very long text, repeated identifiers."""
    rng = random.Random(seed)
    vocabulary = [f"wö{i}" if i % 7 == 0 else f"Word{i}," for i in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=30))
    out = []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 12, 13, 40, 90]))
        if i % 4 == 0:
            words[len(words) // 2 : len(words) // 2] = passage.split()
        out.append((i, " ".join(words)))
    base = out[5][1]
    out += [(100 + i, base) for i in range(20)] + [(200 + i, f"{base} tail{i}") for i in range(5)] + [(300, base.replace(" ", "\n")), (301, f"  {base}\t"), (302, None), (303, ""), (304, " \t\n\x0b\x0c\r "), (305, "a b c"), (305, "a b c"), (306, "x\x85y\xa0z"), (307, "!" * 3)]
    out.append((400, " ".join(rng.choices(vocabulary, k=20_000))))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None, "x", "y", "z", "p") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def rows():
    return corpus()


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", "", text or "")


def norm_groups(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i))
    return groups


def test_exact_dedup(spark, rows):
    groups = norm_groups(rows)
    want = sorted((i, min(groups[norm(t)])[1], len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in rows)
    got = exact_dedup.exact_dedup(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sorted(r.doc_id for r in got if r.kept) == sorted({min(g)[1] for g in groups.values()})


def test_exact_dedup_of_one_large_group(spark):
    got = exact_dedup.exact_dedup(frame(spark, [(i, "same text" + " " * (i == 77)) for i in range(300)])).collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(77, 300)} and sum(r.kept for r in got) == 1


def test_exact_dedup_with_null_identifiers(spark):
    got = exact_dedup.exact_dedup(frame(spark, [(None, "a"), (1, "a"), (2, "b")])).collect()
    assert sorted((r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in got) == [(0, None, 2, True), (1, None, 2, False), (2, 2, 1, True)]


def test_neighbours_decide(spark):
    """On a whole table the sort alone finds every copy, however many partitions; a hot run is cut and joined again."""
    docs = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    groups = norm_groups(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        got = exact_dedup.content_sort(docs).collect()
        assert not any(r.slices for r in got), "no run of this table is hot"
        assert {r.doc_id: r.slice_size for r in got} == {i: len(groups[norm(t)]) for i, t in rows}
        hot = docs.select("doc_id", "text").unionByName(spark.range(10_000, 10_900).selectExpr("id as doc_id", "'one text' as text"))
        cut = exact_dedup.content_sort(hot).where("slices IS NOT NULL").collect()
        assert len(cut) == 900 and max(r.slice_size for r in cut) < 100 and sum(r.place == 1 for r in cut) == len({r.slice for r in cut}) > 10
        out = exact_dedup.exact_dedup(hot).where("doc_id >= 10000").collect()
        assert {(r.keep_id, r.group_size) for r in out} == {(10_000, 900)} and sum(r.kept for r in out) == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def brute_fingerprint(text, size):
    words = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(points):
    """Smallest identifier reachable over pairs at distance 2 or less."""
    root = {i: i for i in points}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(points)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (points[a] ^ points[b]).bit_count() <= 2 and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


def test_simhash(spark, rows):
    unique = list(dict(rows).items())
    points = {i: brute_fingerprint(t, 3) for i, t in unique}
    want = brute_components(points)
    got = simhash.near_dedup(frame(spark, unique)).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in got} == {i: (points[i], want[i]) for i in points}
    assert len(simhash.near_dedup(frame(spark, [(1, "a"), (1, "a")])).collect()) == 2


@pytest.mark.parametrize("long_list", [2, 32])
def test_simhash_links_in_dense_lists(spark, long_list):
    """Many fingerprints that agree on some bytes: stars must keep what pairs connect."""
    rng = random.Random(11)
    base = [rng.getrandbits(64) for _ in range(3)]
    points = {}
    for b in base:
        x = b
        for _ in range(60):
            points[len(points)] = x
            x = (x if rng.random() < 0.7 else b) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (rng.random() < 0.3) * (1 << rng.randrange(64))
    by_value = {}
    for i, x in points.items():
        by_value.setdefault(x, i)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    distinct = spark.createDataFrame([(signed(x),) for x in by_value], "fp long")
    found = simhash.components(simhash.links(distinct, long_list)).collect()
    root = {r.node: r.root for r in found}
    groups, wanted = {}, {}
    for x, i in by_value.items():
        groups.setdefault(root.get(signed(x), signed(x)), set()).add(i)
    for i, r in brute_components({i: x for x, i in by_value.items()}).items():
        wanted.setdefault(r, set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_tallies_are_a_filter(spark):
    """Pairs that meet in a list, before and after the count filter: it keeps those with six equal bytes, and only those."""
    rng = random.Random(7)
    points = {rng.getrandbits(64) for _ in range(20)}
    for x in [*points]:
        for k in (1, 2, 3, 4, 5):
            y = x
            for p in rng.sample(range(8), k):
                y ^= rng.randrange(1, 256) << 8 * p
            points.add(y)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = spark.createDataFrame([(signed(x),) for x in points], "fp long")
    got = {(r.a, r.b): r.shared for r in simhash.tallies(simhash.postings(rows), 200).collect()}
    equal = lambda a, b: sum((a ^ b) >> 8 * p & 255 == 0 for p in range(8))
    ordered = sorted(map(signed, points))
    want = {(a, b): equal(a, b) for k, a in enumerate(ordered) for b in ordered[k + 1 :]}
    assert {p for p, n in want.items() if n >= 6} == {p for p, n in got.items() if n >= 6}
    assert all(want[p] == n for p, n in got.items() if n >= 6) and all(n == 4 for n in got.values() if n < 6)
    assert sum(n < 6 for n in got.values()) > 20 and len(simhash.BLOCKS) == 14


def test_spread_join(spark):
    """A join whose left side has a hot key, a null key, keys without partner and clashing names."""
    left = spark.createDataFrame([(1, i, "l") for i in range(700)] + [(k, k, "l") for k in range(2, 40)] + [(None, 7, "l"), (99, 8, "l")], "k long, v long, is_hot string")
    right = spark.createDataFrame([(k, f"r{k}") for k in range(45)], "k long, w string")
    got = common.spread_join(left, right, ["k"])
    assert got.columns == ["k", "v", "is_hot", "w"]
    assert sorted(map(tuple, got.collect())) == sorted([(1, i, "l", "r1") for i in range(700)] + [(k, k, "l", f"r{k}") for k in range(2, 40)])
    assert common.spread_join(left.limit(0), right, ["k"]).count() == 0


def test_one_star(spark):
    """A node that is an end of most edges: its edges are not brought to one task, and no connection is lost."""
    edges = spark.createDataFrame([(5, 1000 + i) for i in range(2000)] + [(3, 1500), (1, 2), (1000 + 1999, 5000)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {2: 1, 5: 3, 5000: 3, **{1000 + i: 3 for i in range(2000)}}


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 501: 500}
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_substrings(rows, window=13):
    first = {}
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in words:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


def test_substring_dedup(spark, rows):
    got = substring_dedup.substring_dedup(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == brute_substrings(rows)
    for r in got:
        assert sum(s.end - s.start for s in r.removed) == r.n_removed


def test_substring_edges(spark):
    a = " ".join(f"w{i}" for i in range(20))
    rows = [(1, a), (1, f"{a} x"), (2, a), (None, a), (None, f"y {a}"), (3, None), (3, "")]
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(frame(spark, rows)).collect()), key=repr)
    assert got == sorted([(1, 20, 0), (1, 21, 0), (2, 20, 20), (None, 20, 20), (None, 21, 20), (3, 0, 0), (3, 0, 0)], key=repr)
    with pytest.raises(TypeError):
        substring_dedup.substring_dedup(frame(spark, rows).withColumn("doc_id", F.col("doc_id").cast("string")))


def test_buckets_follow_bytes(spark, rows, monkeypatch):
    """Many small buckets give what one gives."""
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", 2000)
    got = substring_dedup.substring_dedup(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == brute_substrings(rows)


def test_substring_dedup_at_every_offset(spark):
    """A 13-word passage at all alignments to the blocks, and one of 12 words that must stay."""
    rows = [(0, " ".join(f"p{i}" for i in range(13))), (1, " ".join(f"q{i}" for i in range(12)))]
    rows += [(10 + k, " ".join([f"l{k}x{i}" for i in range(k)] + [f"p{i}" for i in range(13)] + [f"r{k}"])) for k in range(15)]
    rows += [(50, " ".join(["z"] + [f"q{i}" for i in range(12)] + ["y"]))]
    got = substring_dedup.substring_dedup(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == brute_substrings(rows)
    assert {r.n_removed for r in got if 10 <= r.doc_id < 30} == {13}


def test_packing(spark, rows):
    pieces = packing.tokenised_pieces(frame(spark, rows), BPE, length=256)
    placed = packing.pack(pieces, capacity=256, group=40).collect()
    tokenizer = Tokenizer.from_file(BPE)
    want = []
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        want += [(i, k, s, zlib.crc32(np.array(ids[s : s + 256], "<u4").tobytes())) for k, s in enumerate(range(0, len(ids), 256))]
    assert sorted((r.doc_id, r.piece, r.start, zlib.crc32(r.ids)) for r in placed) == sorted(want)
    bins = {}
    for r in placed:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 256
    assert len(bins) <= -(-sum(r.length for r in placed) // 256) + 4
    whole = packing.sequences(packing.pack(pieces, 256, group=40)).collect()
    assert sum(len(r.ids) for r in whole) == sum(4 * r.length for r in placed)


def test_word_ids_equal_the_tokenizer():
    tokenizer, own = Tokenizer.from_file(BPE), packing.WordIds(BPE)
    texts = ["it's I'LL 'S don't", "Straße, ÀÉÎ’s ŉİ × ÷", "<|endoftext|> a<|b", "日本語 😀 é ﬁ", "12a3!? ... a.b,c", "\x1c\x1f x\x0by", "", "  ", "A" * 500]
    assert own.encode([t.encode() for t in texts]) == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_ids_of_a_whole_table():
    """Every document of a table against the tokenizers library."""
    docs = pq.read_table(f"{SMALL.replace('0.001', '0.01')}/documents.parquet")["text"].to_pylist()
    tokenizer, own = Tokenizer.from_file(BPE), packing.WordIds(BPE)
    want = [np.array(x.ids, "<u4").tobytes() for x in tokenizer.encode_batch([t or "" for t in docs], add_special_tokens=False)]
    assert own.encode([(t or "").encode() for t in docs]) == want


def test_memory_of_words(monkeypatch):
    texts = [f"word{i} other{i % 7}".encode() for i in range(200)]
    want = packing.WordIds(BPE).encode(texts)
    monkeypatch.setattr(packing, "CACHE", 10)
    own = packing.WordIds(BPE)
    assert [own.encode([t])[0] for t in texts] == want and len(own.known) < 20


def test_dominance():
    """A filling is kept only if no single exchange gives a fuller one, by trying them all."""
    rng = random.Random(9)
    for _ in range(300):
        sizes = sorted(rng.sample(range(1, 30), 8))
        left = {n: rng.randint(0, 2) for n in sizes}
        pool = [n for n in sizes for _ in range(left[n])]
        if not pool:
            continue
        taken = tuple(sorted(rng.sample(pool, rng.randint(1, min(4, len(pool)))), reverse=True))
        room = rng.randint(0, 10)
        spare = list(pool)
        for n in taken:
            spare.remove(n)
        parts = [(), *[(n,) for n in taken], *[(a, b) for i, a in enumerate(taken) for b in taken[i + 1 :]]]
        want = room > 0 and any(sum(s) < x + (len(s) == 2) and x <= sum(s) + room for s in parts for x in spare)
        assert packing.dominated(left, sizes, room, taken) == want, (left, taken, room)


def test_no_group_gathers_all(spark):
    """Pieces that no two fit together: each level's groups stay as small as the first ones, and the levels end."""
    pieces = spark.range(4000).selectExpr("id as doc_id", "0 as piece", "3000L as length")
    out = packing.pack(pieces, capacity=4096, group=100, fan_in=4)
    placed = out.collect()
    assert len(placed) == 4000 and len({r.sequence_id for r in placed}) == 4000
    groups = {}
    for r in placed:
        groups[r.sequence_id >> 32] = groups.get(r.sequence_id >> 32, 0) + 1
    assert max(groups.values()) <= 150
    mixed = spark.range(4000).selectExpr("id as doc_id", "0 as piece", "if(id % 2 = 0, 3000L, 1096L) as length")
    got = packing.pack(mixed.orderBy("length").coalesce(1), capacity=4096, group=100, fan_in=4).collect()
    assert len(got) == 4000 and len({r.sequence_id for r in got}) < 2200


def test_handed_on():
    lengths = np.array([3000, 2000, 2000, 4090, 10, 5])
    assert packing.handed_on([[0], [1, 2], [3], [4, 5]], lengths, 4096, 10) == {3, 0, 1}
    assert packing.handed_on([[0], [1, 2], [3], [4, 5]], lengths, 4096, 3) == {3, 0}


def test_pieces_of_repeated_rows(spark):
    rows = [(None, "a b"), (None, "a b"), (1, "x"), (1, "y"), (2, None), (2, "long " * 30_000)]
    placed = packing.pack(packing.tokenised_pieces(frame(spark, rows), BPE), group=2).collect()
    assert sum(r.length for r in placed) == 3 + 3 + 2 + 2 + 1 + 30_001 and sum(r.doc_id is None for r in placed) == 2


def test_bin_completion_beats_best_fit():
    lengths = np.array([6, 5, 5, 4, 4, 3, 3] * 1)  # capacity 10: three bins, where best fit may need four
    assert len(packing.pack_lengths(lengths, 10)) == 3
    rng = random.Random(5)
    for _ in range(40):
        x = np.array([rng.randint(1, 40) for _ in range(rng.randint(1, 30))])
        bins = packing.pack_lengths(x, 40)
        assert sorted(i for b in bins for i in b) == list(range(len(x))) and all(x[b].sum() <= 40 for b in bins)
        assert len(bins) <= len(packing.best_fit_decreasing(sorted(x.tolist(), reverse=True), 40))


@pytest.mark.parametrize("op", [exact_dedup.exact_dedup, simhash.near_dedup, substring_dedup.substring_dedup, lambda d: packing.pack(packing.tokenised_pieces(d, BPE))])
def test_empty_table(spark, op):
    assert op(frame(spark, [])).count() == 0


def test_word_ids_are_made_once_where_they_are_met():
    """A word costs one look-up: no set of a batch's words is made beside it."""
    own = packing.WordIds(BPE)
    made, word = [], own.known.function
    own.known.function = lambda w: made.append(w) or word(w)
    first = own.encode([b"one two two", b"two One \xff\xfe one"])
    assert own.encode([b"one two two", b"two One \xff\xfe one"]) == first and sorted(made) == [b"One", b"one", b"two", b"\xff\xfe"]
