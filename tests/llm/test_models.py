"""Classifier, token counts, language model and pieces: held-out quality, brute force, round trips."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from conftest import SMALL

from folioframe.llm import lm_scoring, quality, sentence_pieces, token_counts

DOCS = "doc_id long, text string, lang string, score string, section string"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", "t") for i, t in rows], DOCS)


# ---- quality


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.quality_scores(docs, labels).collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [(got[r.doc_id].predicted, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert sum(p == q for p, q in held) / len(held) > 0.95
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, r in got.items() if r.predicted}


def test_quality_never_sees_held_out_labels(spark):
    rows = [(i, "good words here. " * 5 if i % 2 else "### $$$ %%% " * 9) for i in range(60)]
    labels = lambda flip: spark.createDataFrame([(i, (i % 2) ^ (flip and zlib.crc32(str(i).encode()) % 5 == 0), None) for i in range(60)], "doc_id long, quality int, toxic int")
    a, b = ({r.doc_id: r.score for r in quality.quality_scores(frame(spark, rows), labels(f)).collect()} for f in (False, True))
    assert a == b


def test_quality_edges(spark):
    docs = frame(spark, [(1, None), (2, ""), (3, "x" * 100_000), (3, "x")])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.quality_scores(docs, none).collect()] == [0.5] * 4
    nulls = spark.createDataFrame([(1, None), (2, 1), (3, 0), (None, 1)], "doc_id long, quality int")
    assert quality.quality_scores(docs, nulls).count() == 4 and quality.quality_scores(docs.limit(0), nulls).count() == 0
    unnamed = quality.quality_scores(frame(spark, [(None, "some words"), (None, "some words"), (2, "a b")]), nulls).collect()
    assert len(unnamed) == 3 and all(r.score is not None for r in unnamed) and not any(r.held_out for r in unnamed if r.doc_id is None)


def test_risk_stays_non_negative():
    rng = np.random.default_rng(0)
    positive, other = rng.random((200, 3)) * 0.5 + 0.5, rng.random((80, 3)) * 0.4
    moments = [quality.Moments.of(x) for x in (positive, np.concatenate([positive[:120], other]))]
    model = quality.fit(*moments, 0.6)
    assert (model.score(positive) > 0.5).mean() > 0.95 and (model.score(other) < 0.5).mean() > 0.9
    # few unlabelled rows and a prior that is too high: the plain risk would go below zero, the weights stay bounded
    model = quality.fit(quality.Moments.of(positive[:5]), quality.Moments.of(other[:3]), 0.95)
    assert np.abs(model.weights).max() < 10


def brute_scores(docs, labels):
    """The classifier over rows in memory: the risk's parts are means of each row's loss, step by step."""
    fold = {i: zlib.crc32(str(i).encode()) % 5 for i, _ in docs}
    x = {i: np.concatenate([[1], quality.expanded(np.array([quality.statistics((t or "").encode())]))[0]]) for i, t in docs}
    taught = [(i, q) for i, q in labels if q is not None and i in fold and fold[i]]
    prior = float(np.clip(np.mean([q for i, q in labels if q is not None and zlib.crc32(str(i).encode()) % 5]), 0.05, 0.95))
    p, u = np.array([x[i] for i, q in taught if q == 1]), np.array([x[i] for i, _ in docs if fold[i]])
    mean, scale = u[:, 1:].mean(axis=0), u[:, 1:].std(axis=0) + 1e-3
    shift = lambda m: np.concatenate([m[:, :1], (m[:, 1:] - mean) / scale], axis=1)
    p, u = shift(p), shift(u)
    w = np.zeros(p.shape[1])
    w[0] = 2 * prior - 1
    first, second = np.zeros_like(w), np.zeros_like(w)
    clipped = 0
    for t in range(1, quality.STEPS + 1):
        zp, zu = p @ w, u @ w
        wrong = u.T @ (1 + zu) / len(u) / 2 - prior * (p.T @ (1 + zp)) / len(p) / 2  # slope of R_U(-) - prior R_P(-)
        if ((1 + zu) ** 2).mean() - prior * ((1 + zp) ** 2).mean() < 0:
            slope, clipped = -wrong, clipped + 1
        else:
            slope = wrong - prior * (p.T @ (1 - zp)) / len(p) / 2
        slope = slope + quality.DECAY * w
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        w = w - quality.RATE / math.sqrt(t) * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    z = shift(np.array([x[i] for i, _ in docs])) @ w
    return dict(zip([i for i, _ in docs], 1 / (1 + np.exp(-np.clip(quality.SLOPE * z, -30, 30))), strict=True)), clipped


def test_quality_equals_brute_force(spark):
    """Sums over tasks against every row's loss in memory."""
    docs, labels = (spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want, clipped = brute_scores(rows, [(r.doc_id, r.quality) for r in labels.collect()])
    assert clipped, "the plain risk falls below zero here"
    got = {r.doc_id: r.score for r in quality.quality_scores(docs.repartition(5), labels).collect()}
    assert max(abs(got[i] - want[i]) for i in want) < 1e-3


def test_moments_cover_all_rows(spark):
    texts = [(i, f"text number {i} " * (i % 40)) for i in range(300)]
    got = quality.moments(quality.measured(frame(spark, texts).repartition(7)))
    want = quality.Moments.of(np.array([quality.statistics(t.encode()) for _, t in texts]))
    assert got.n == 300 and np.allclose(got.second, want.second)


# ---- token counts


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts(spark, rule):
    rows = [(1, "one two\nthree  four\n\nfive"), (2, None), (3, ""), (4, "héllo wörld 日本\n😀😀\nx"), (5, "a\n" * 50), (5, "\n\n\n   \n"), (6, "<|endoftext|>\nz")]
    got = token_counts.section_counts(frame(spark, rows), RANKS, public_tokenizers.PATTERN, rule).collect()
    encoding, _ = token_counts.load_ranks(RANKS, public_tokenizers.PATTERN)
    assert sum(r.n_tokens for r in got) == pytest.approx(sum(len(encoding.encode_ordinary(t or "")) for _, t in rows))
    for i, t in rows:
        mine = sorted((r.section, r.start, r.end) for r in got if r.doc_id == i)
        if [x for x, _ in rows].count(i) == 1:
            parts = (t or "").split("\n")
            ends = np.cumsum([len(p) + 1 for p in parts]).tolist()
            ends[-1] -= 1
            assert mine == list(zip(range(len(parts)), [0, *ends[:-1]], ends, strict=True))


def brute_sections(text, encoding, rule):
    """Tokens of each line, character by character: the token that holds a character's first byte owns it."""
    raw, at, owned, before = text.encode(), 0, [], []
    lead = [b & 0xC0 != 0x80 for b in raw]
    for i in encoding.encode_ordinary(text):
        n = len(encoding.decode_single_token_bytes(i))
        owned.append([sum(lead[:k]) for k in range(at, at + n) if lead[k]])
        before.append(sum(lead[:at]))
        at += n
    line, of = 0, []
    for c in text:
        of.append(line)
        line += c == "\n"
    counts = [0.0] * (line + 1)
    for chars, start in zip(owned, before, strict=True):
        if not chars:
            counts[of[start - 1]] += 1
        elif rule == "start":
            counts[of[chars[0]]] += 1
        else:
            held = Counter(of[c] for c in chars)
            if rule == "share":
                for k, n in held.items():
                    counts[k] += n / len(chars)
            else:
                counts[min(k for k, n in held.items() if n == max(held.values()))] += 1
    return counts


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections_equal_brute_force(spark, rule):
    encoding, _ = token_counts.load_ranks(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(10)
    texts = ["".join(rng.choices(["word", " ", "\n", "\n\n", "  \n ", "é", "日本", "😀", ".", "\r\n", "\t"], k=rng.randint(0, 40))) for _ in range(60)]
    got = {}
    for r in token_counts.section_counts(frame(spark, enumerate(texts)), RANKS, public_tokenizers.PATTERN, rule).collect():
        got.setdefault(r.doc_id, {})[r.section] = r.n_tokens
    for i, t in enumerate(texts):
        want = brute_sections(t, encoding, rule)
        assert [got[i][k] for k in range(len(want))] == pytest.approx(want), (t, rule)


def test_token_counts_edges(spark):
    long = "some words\n" * 50_000
    got = token_counts.section_counts(frame(spark, [(1, long), (None, None), (None, None)]), RANKS, public_tokenizers.PATTERN)
    assert got.where("doc_id = 1").count() == 50_001 and got.where("doc_id IS NULL").count() == 2
    assert got.where("doc_id = 1").selectExpr("sum(n_tokens)").first()[0] == got.where("doc_id = 1").first().n_document
    assert token_counts.section_counts(frame(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


def test_token_spans_equal_offsets():
    encoding, sizes = token_counts.load_ranks(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(3)
    for _ in range(50):
        text = "".join(rng.choice("ab cd\n.é日😀") for _ in range(60))
        ids = encoding.encode_to_numpy(text, disallowed_special=())
        starts, ends = token_counts.token_spans(text.encode(), ids, sizes)
        at, want = 0, []
        for i in ids.tolist():  # characters whose first byte a token holds
            raw = encoding.decode_single_token_bytes(i)
            n = sum(b & 0xC0 != 0x80 for b in raw)
            want.append((at, at + n))
            at += n
        assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == want


def test_rules_at_a_boundary():
    starts, ends, bounds = np.array([0, 2, 6]), np.array([2, 6, 7]), np.array([3, 7])
    assert token_counts.attribute(starts, ends, bounds, "start").tolist() == [2, 1]
    assert token_counts.attribute(starts, ends, bounds, "most").tolist() == [1, 2]
    assert token_counts.attribute(starts, ends, bounds, "share").tolist() == [1.25, 1.75]
    assert tiktoken is not None


# ---- language model

STRANGE = next(i for i in range(600, 700) if zlib.crc32(str(i).encode()) % 7 == 2)  # held out


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(9)
    words = ["the", "cat", "sat", "on", "mat", "A", "dog", "ran", "far", "Wörld"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(150)] + [(500, None), (501, ""), (502, "zzzz unseen qqqq"), (STRANGE, "".join(rng.choices("qxzj", k=300))), (504, "the cat " * 5000), (504, "the cat " * 5000)]
    return rows, lm_scoring.lm_scores(frame(spark, rows)).collect()


def test_base_score(scored):
    rows, got = scored
    tokens = {i: [*(t or "").encode().lower().split(), "end"] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    counts = Counter(w for i, _ in rows if not held[i] for w in tokens[i])
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    for r in got:
        want = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens[r.doc_id])
        assert r.base_score == pytest.approx(want, abs=1e-6) and (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(tokens[r.doc_id]), sum(counts[w] > 0 for w in tokens[r.doc_id]), n)


def test_mixed_score(scored):
    rows, got = scored
    per_byte = {r.doc_id: -r.score / math.log10(2) / (r.n_bytes + 1) for r in got}
    normal = [per_byte[i] for i in range(150)]
    assert max(normal) < 8 and sum(normal) / 150 < 3 and per_byte[STRANGE] > max(3 * sum(normal) / 150, max(normal)), "strange letters cost more, though the text learns from itself"
    assert {r.score for r in got if r.doc_id in (500, 501)} == {next(r.score for r in got if r.doc_id == 500)}


def test_rare_words_join(spark, monkeypatch):
    """All words rare: the base score comes by the join alone."""
    rows = [(i, f"w{i % 3} w{i % 5} w{i}") for i in range(40)]
    want = {r.doc_id: (r.base_score, r.n_known) for r in lm_scoring.lm_scores(frame(spark, rows)).collect()}
    monkeypatch.setattr(lm_scoring, "FREQUENT", 1)
    got = {r.doc_id: (r.base_score, r.n_known) for r in lm_scoring.lm_scores(frame(spark, rows)).collect()}
    assert {i: x[1] for i, x in got.items()} == {i: x[1] for i, x in want.items()} and all(got[i][0] == pytest.approx(want[i][0], abs=1e-8) for i in want)


def random_model(seed=1):
    rng = np.random.default_rng(seed)
    tables = lm_scoring.Tables(1 << 12)
    states = (rng.integers(0, 5, tables.size) << 8 | rng.integers(0, 5, tables.size)).astype("u2")
    weights = [rng.normal(0.3, 0.1, (g, lm_scoring.INPUTS + 1)).astype("f4") for g in lm_scoring.GATES]
    return lm_scoring.Mixer(tables, states, weights, rng.random((2, 256, lm_scoring.BUCKETS, 2)) * 9)


def test_bits_are_probabilities():
    """The probabilities of all 256 next bytes sum to one, after any text."""
    scorer = lm_scoring.Scorer(random_model())
    own = np.zeros(256)
    before = b"some text before " * 40
    scorer.part([(bytes(4), before)] * 256, own, 0)
    assert np.abs(own).min() > 0.01
    cost = scorer.part([(before[-4:], bytes([b])) for b in range(256)], own, len(before))
    assert (2.0**-cost).sum() == pytest.approx(1, abs=1e-4)


def test_scores_do_not_depend_on_company(monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choices("abc de.\né", k=rng.choice([0, 1, 300, 5000]))).encode() for _ in range(12)]
    scorer = lm_scoring.Scorer(random_model())
    alone = [scorer.bits([t])[0] for t in texts]
    assert scorer.bits(texts) == pytest.approx(alone, abs=1e-6) and scorer.bits(texts[::-1]) == pytest.approx(alone[::-1], abs=1e-6)
    long = b"words of a long text " * 400
    monkeypatch.setattr(lm_scoring, "SEGMENT", 4096)
    assert scorer.bits([b"x", long, b"y"])[1] == pytest.approx(scorer.alone(long)) == pytest.approx(scorer.bits([long])[0])


def brute_model_counts(texts):
    """Bit counts of (predictor, context, bits so far), by plain dictionaries."""
    counts = {}
    for text in texts:
        for names, prefix, bit in brute_bits(text):
            for name in names:
                n = counts.setdefault((name, prefix), [0, 0])
                n[bit] += 1
    return counts


def brute_bits(text):
    data = bytes(4) + text + b"\0"
    for i in range(4, len(data)):
        start = i
        while start > 0 and (bytes([data[start - 1]]).isalpha() or data[start - 1] >= 128):
            start -= 1
        names = [(k, data[i - k : i]) for k in range(1, 5)] + [("word", data[start:i].lower())]
        for j in range(8):
            yield names, (1 << j) | data[i] >> (8 - j), data[i] >> (7 - j) & 1


def brute_score(text, counts, model):
    """Bits of a text, bit by bit."""
    shown = lambda n: float(lm_scoring._COUNT[int(lm_scoring.level(n))])
    squash = lambda z: 1 / (1 + math.exp(-max(-20, min(20, z))))
    own, held, due, total, bit_no, chances = 0.0, [], 256, 0.0, 0, [1.0, 1.0]
    for names, prefix, bit in brute_bits(text):
        x, seen = [], []
        for name in names:
            zeros, ones = (shown(n) for n in counts.get((name, prefix), (0, 0)))
            x.append(math.log(ones + 0.1) - math.log(zeros + 0.1))
            seen.append(zeros + ones)
        x.append(1.0)
        longest = next((k for k in range(4) if not seen[k]), 4)
        often = seen[longest - 1] if longest else 0
        gates = ((bit_no % 8 * 5 + longest) * 3 + (0 if often < 1.5 else 1 if often < 7.5 else 2), prefix)
        rows = (prefix, names[0][1][0])
        for which in (0, 1):
            z = sum(a * w for a, w in zip(x, model.weights[which][gates[which]].tolist(), strict=True))
            zeros, ones = model.refined[which, rows[which], int(max(0, min(31, (z + 8) * 2)))]
            p = squash(z)
            p = max(1e-4, min(1 - 1e-4, (p + (ones + 20 * p) / (zeros + ones + 20)) / 2))
            chances[which] *= p if bit else 1 - p
        bit_no += 1
        if bit_no % 8 == 0:
            weight = squash(own)
            both = weight * chances[0] + (1 - weight) * chances[1]
            total -= math.log2(both)
            held.append(weight * chances[0] / both - weight)
            chances = [1.0, 1.0]
            if bit_no == due * 8:
                own = max(-4, min(4, own + 0.02 * sum(held)))
                held, due = [], due + min(due, 4096)
    return total


def test_score_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "LEAST_BITS", 21)
    monkeypatch.setattr(lm_scoring, "MOST_BITS", (21,) * 5)  # few of this small table's contexts share a slot
    rng = random.Random(14)
    words = ["the", "cat", "Sat", "on", "mat", "él", "ran", "7,", "far.\n"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(12)] + [(100, "".join(rng.choices("xyz ", k=300))), (101, " ".join(rng.choices(words, k=120)))]
    taught = [t.encode() for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    model = lm_scoring.train(spark.createDataFrame([(0, bytearray(t)) for t in taught], "doc_id long, data binary"))
    counts = brute_model_counts(taught)
    got = {r.doc_id: r.score for r in lm_scoring.lm_scores(frame(spark, rows)).collect()}
    for i, t in rows:
        assert got[i] == pytest.approx(-brute_score(t.encode(), counts, model) * math.log10(2), rel=3e-3), i


def test_fewer_bits_than_a_plain_model(spark):
    """Held-out rows of the small tables against a byte model of four bytes, backed off to shorter ones."""
    docs = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/documents.parquet")
    got = {r.doc_id: r for r in lm_scoring.lm_scores(docs).collect()}
    seen, after = Counter(), Counter()
    texts = {r.doc_id: (r.text or "").encode() + b"\0" for r in docs.collect()}
    for i, t in texts.items():
        if not got[i].held_out:
            data = bytes(4) + t
            for k in range(5):
                for j in range(4, len(data)):
                    context = data[j - k : j]
                    seen[context] += 1
                    after[context, data[j]] += 1
    plain = mixed = size = 0
    for i, t in texts.items():
        if got[i].held_out:
            data = bytes(4) + t
            for j in range(4, len(data)):
                p = 1 / 256
                for k in range(5):
                    context = data[j - k : j]
                    p = (after[context, data[j]] + 8 * p) / (seen[context] + 8)
                plain -= math.log2(p)
            mixed -= got[i].score / math.log10(2)
            size += len(t)
    assert mixed < plain and mixed / size < 2.3


def test_lm_edges(spark):
    assert lm_scoring.lm_scores(frame(spark, [])).count() == 0


def test_runs():
    value, sizes = lm_scoring.runs([p for t in (b"ab", b"", b"x aB") for p in lm_scoring.segments(t)])
    assert sizes.tolist() == [3, 1, 5] and [int(v) >> lm_scoring.WORD for v in value[:4]] == [0x61, 0x6162, 0x616200, 0]
    word = value & ((1 << lm_scoring.WORD) - 1)
    assert word[[0, 3, 4, 6]].tolist() == [0] * 4 and word[2] == word[8] != 0 and word[1] == word[7]


def test_counts_equal_plain_ones(spark, monkeypatch):
    """Counts of runs by task, with a memory of every size; sums of parts over more tasks than FAN_IN."""
    rng = random.Random(4)
    texts = ["".join(rng.choices("ab c", k=rng.randint(0, 200))).encode() for _ in range(60)]
    want = Counter(v for t in texts for v in lm_scoring.runs([*lm_scoring.segments(t)])[0].tolist())
    for memory, held in ((1 << 4, 50), (1 << 12, 10_000)):
        monkeypatch.setattr(lm_scoring, "MEMORY", memory)
        monkeypatch.setattr(lm_scoring, "HELD", held)
        got = Counter()
        for out in lm_scoring._counted(iter([pa.record_batch([pa.array(texts[a : a + 7], pa.binary())], ["data"]) for a in range(0, 60, 7)])):
            for run, n in zip(out["run"].to_pylist(), out["n"].to_pylist(), strict=True):
                got[run] += n
        assert got == want
    docs = spark.createDataFrame([(0, bytearray(t)) for t in texts], "doc_id long, data binary")
    states = lm_scoring.train(docs).states
    monkeypatch.setattr(lm_scoring, "FAN_IN", 2)
    assert np.array_equal(lm_scoring.train(docs).states, states)


def test_levels():
    n = np.array([0, 1, 63, 64, 65, 1000, 10**6, 10**15])
    at = lm_scoring.level(n)
    assert at[:4].tolist() == [0, 1, 63, 64] and np.abs(lm_scoring._COUNT[at] / np.maximum(n, 1) - 1)[1:].max() < 0.1 and at.max() < 255


# ---- pieces


def test_pieces_equal_the_library(spark):
    rng = random.Random(5)
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()]
    texts += ["", " ", "  a   b", "\n\nx\t\ty ", "日本語😀", "a" * 300, "don't    stop", "1.5,2;3", "é" * 9, *("".join(rng.choice("ab ,.\néK▂9") for _ in range(80)) for _ in range(150))]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = sentence_pieces.decode_pieces(sentence_pieces.encode_pieces(frame(spark, enumerate(texts)), PIECES), PIECES).collect()
    for r in got:
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(texts[r.doc_id]), texts[r.doc_id][:50]
        assert r.text == texts[r.doc_id]
    assert sentence_pieces.encode_pieces(frame(spark, [(1, None), (1, None)]), PIECES).count() == 2


def test_streaming_commits_equal_a_whole_search():
    """Unigram scores: the windowed search against plain dynamic programming over the whole text."""
    model = sentence_pieces.Model(PIECES)
    model.bpe = False
    rng = random.Random(8)
    model.score = {p: -rng.random() * 10 for p in model.score}
    model.worst = -30.0
    for _ in range(20):
        text = "".join(rng.choice(["the", "ing", "▁", "a", "tion", "é", "日", "x"]) for _ in range(200))
        best = [(0.0, 0)] + [(-1e18, 0)] * len(text)
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - model.longest), end):
                piece = text[start:end]
                s = model.score.get(piece, model.worst if len(piece) == 1 else None)
                if s is not None and best[start][0] + s > best[end][0]:
                    best[end] = (best[start][0] + s, start)
        got = list(model.stream(text))
        assert "".join(got) == text and sum(model.score.get(p, model.worst) for p in got) == pytest.approx(best[-1][0])


def test_pairs_of_pieces():
    """The test of two neighbours against merging them."""
    model, rng = sentence_pieces.Model(PIECES), random.Random(2)
    every = [*model.halves]
    short = [p for p in every if len(p) < 4]
    for i in range(6000):
        a, b = rng.choice(every if i % 2 else short), rng.choice(every if i % 3 else short)
        assert model.fits(a, b) == (model.merged(a + b) == [a, b]), (a, b)


def test_commits_inside_a_long_text(monkeypatch):
    """A text is committed piece by piece, in stretches that join to the text, and the window stays small."""
    monkeypatch.setattr(sentence_pieces, "HOLD", 50)
    model, rng = sentence_pieces.Model(PIECES), random.Random(3)
    processor = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text in (" ".join(rng.choices(["the", "straße", "naïve,", "x1", "日本", "...", "  "], k=3000)), "abcdefgh" * 2000, "".join(rng.choices("日本語é😀", k=3000)), "\n\n" * 500):
        parts = [*model.stretches(sentence_pieces.MARK + text.replace(" ", sentence_pieces.MARK))]
        assert "".join(x for p in parts for x in p) == sentence_pieces.MARK + text.replace(" ", sentence_pieces.MARK)
        assert model.encode(text) == np.array(processor.encode(text), "<u4").tobytes()
    marked = sentence_pieces.MARK + "the straße " * 1000
    assert len([*model.stretches(marked.replace(" ", sentence_pieces.MARK))]) > 10, "ids are committed before the text ends"
    # a stretch longer than the window: paths meet inside it
    whole = "".join(rng.choices(["ing", "tion", "er", "th", "a"], k=3000))
    assert "".join(model.stream(whole)) == whole and [*model.stream(whole)] == model.within(whole)


def test_memory_of_stretches(monkeypatch):
    """What a worker remembers is bounded and changes no id."""
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choices("abcde", k=5)) for _ in range(50)) for _ in range(60)]
    want = [sentence_pieces.Model(PIECES).encode(t) for t in texts]
    monkeypatch.setattr(sentence_pieces, "CACHE", 100)
    monkeypatch.setattr(sentence_pieces, "PAIRS", 100)
    model = sentence_pieces.Model(PIECES)
    assert [model.encode(t) for t in texts * 2] == want * 2
    assert len(model.young) < 300 and len(model.old) < 300 and len(model.stable) <= 101


def test_pieces_edges(spark):
    long = "word " * 200_000
    rows = [(1, "a▁b ▁▁ c"), (2, None), (3, ""), (4, long), (None, "x"), (None, "x")]
    got = {r.doc_id: r.text for r in sentence_pieces.decode_pieces(sentence_pieces.encode_pieces(frame(spark, rows), PIECES), PIECES).collect()}
    assert got == {1: "a b    c", 2: "", 3: "", 4: long, None: "x"}, "the model's sign for a space comes back as a space"
    assert sentence_pieces.encode_pieces(frame(spark, []), PIECES).count() == 0
