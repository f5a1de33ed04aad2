"""The source divergence audit against brute force in Python's integers."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from folioframe.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, term string, part string, id string, value string"
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")


def brute(rows, min_docs, top):
    docs = [(lang or "", source or "", [t.lower() for t in TERM.findall((text or "").encode())]) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        held, counts = Counter(), defaultdict(Counter)
        for own, source, terms in docs:
            if own == lang:
                held.update(set(terms))
                counts[source].update(terms)
        kept = [t for t, n in held.items() if n >= min_docs]
        total = sum(counts.values(), Counter())

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in counts.items()}, shares(total)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in counts if o != s]
            terms = [(-f(p[s][t], q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(found)]
    return sorted(out)


def audited(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, lang, s, None, "x", "y", "z", "v") for i, t, lang, s in rows], SCHEMA)
    return sorted(map(tuple, divergence.audit(df, **kw).select("lang", "source", "part", "item", "value", "rank").collect()))


def corpus(n=120, seed=5):
    rng = random.Random(seed)
    words = [f"{'é' * (i % 3)}Wort{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else f"s{i % 7}"
        own = [w for k, w in enumerate(words) if (k + len(source) + i % 2) % 5]
        rows.append((i, " ".join(rng.choices(own, k=rng.choice([0, 1, 9, 60]))) + rng.choice([".", "\x00A1b", "日本 x"]), rng.choice(["en", "de"]), source))
    return rows + [(900, None, "en", "hot"), (900, "Worta", None, None), (None, "worta", "fr", ""), (1, "worta", "fr", "one"), (2, "", "de", "empty")] + [(3, "copy copy", "en", "s1")] * 5


def test_against_brute_force(spark):
    rows = corpus()
    got = audited(spark, rows, min_docs=4, top=5)
    assert got == brute(rows, 4, 5)
    assert {r[2] for r in got} == {"pair", "term"} and any(r[0] == "fr" for r in got) and ("de", "empty") in {r[:2] for r in got}


def test_long_texts_are_cut_outside_terms(spark, monkeypatch):
    rows = corpus(40)
    monkeypatch.setattr(divergence, "CHUNK", 64)
    batch = pa.record_batch([pa.array([r[i] or "" for r in rows]) for i in (2, 3)] + [pa.array([(r[1] or "").encode() for r in rows])], ["lang", "source", "data"])
    got = Counter()
    for b in divergence.counted(iter([batch])):
        for r in b.to_pylist():
            got[r["lang"], r["term"], r["source"]] += r["n"]
            got[r["lang"], r["term"], None] += r["docs"]
    want = Counter()
    for _, text, lang, source in rows:
        terms = [t.lower() for t in TERM.findall((text or "").encode())]
        want.update((lang or "", t, source or "") for t in terms)
        want.update((lang or "", t, None) for t in set(terms))
    assert got == want


def test_equal_hashes_are_verified():
    batch = pa.record_batch([pa.array(["en"] * 3), pa.array(["a", "a", "b"]), pa.array([b"aa bb aa ccc", b"bb BB", b"ccc"])], ["lang", "source", "data"])
    for digest in (len, lambda _: 7):
        rows = [r for b in divergence.counted(iter([batch]), digest) for r in b.to_pylist()]
        assert {(r["term"], r["source"]): r["n"] for r in rows} == {(b"aa", "a"): 2, (b"bb", "a"): 3, (b"ccc", "a"): 1, (b"ccc", "b"): 1}
        assert {t: sum(r["docs"] for r in rows if r["term"] == t) for t in (b"aa", b"bb", b"ccc")} == {b"aa": 1, b"bb": 2, b"ccc": 2}


def test_tasks_hand_on_often(spark, monkeypatch):
    rows = corpus(40)
    want = brute(rows, 3, 10)
    monkeypatch.setattr(divergence, "PAIRS", 7)
    assert audited(spark, rows, min_docs=3) == want


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)], [(1, "a", "en", "x"), (2, "a", "en", "y")]])
def test_small_tables(spark, rows):
    assert audited(spark, rows) == brute(rows, 10, 10)


def test_shares_are_exact(spark):
    big = 3 * 10**15
    row = spark.range(1).select(F.expr(divergence.share(f"{big}L", f"{2 * big}L", "5L")).alias("p")).first()
    assert row.p == 1 + 10**9 * (big + 2) // (2 * big + 10)
