"""Embedding near-dedup and vector codes against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest

from folioframe.llm import embedding_dedup, vector_codes

SCHEMA = "vec_id long, embedding array<{}>, label int, row string, key string, lead string, code string, error string"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, label, "a", "b", "c", "d", "e") for i, v, label in rows], SCHEMA.format(kind))


def vectors(n=160, width=24, seed=1):
    """Random vectors, close groups, equal ones, chains, and rows that link with nothing."""
    rng = np.random.default_rng(seed)
    out = [(i, rng.standard_normal(width).tolist(), i % 3) for i in range(n)]
    base = rng.standard_normal(width)
    out += [(1000 + i, (base + 0.05 * rng.standard_normal(width)).tolist(), 1) for i in range(60)]  # a tight group
    out += [(2000 + i, (base + 0.16 * rng.standard_normal(width)).tolist(), 1) for i in range(30)]  # a loose one around it
    u, v = np.linalg.qr(rng.standard_normal((width, 2)))[0].T
    out += [(3000 - i, (math.cos(0.3 * i) * u + math.sin(0.3 * i) * v).tolist(), 2) for i in range(12)]  # a chain, each linked to the next
    out += [(4000 + i, base.tolist(), 2) for i in range(20)] + [(5000, base.tolist(), None), (5001, base.tolist(), None)]
    out += [(6000, None, 1), (6001, [], 1), (6002, [0.0] * width, 1), (6003, [math.nan] * width, 1), (6004, [math.inf] + [1.0] * (width - 1), 1), (6005, [None] + [1.0] * (width - 1), 1), (6006, [1.0, 2.0], 1), (6007, [2.0, 4.0], 1)]
    return out + [(1001, out[n + 1][1], 1), (None, base.tolist(), 2), (None, None, None)]


def links(rows, threshold=0.93):
    ok = [v if v and label is not None and None not in v and np.isfinite(v).all() and any(v) else None for _, v, label in rows]
    unit = [None if v is None else np.float32(v).astype("f8") / np.linalg.norm(np.float32(v).astype("f8")) for v in ok]
    return [(i, j) for i in range(len(rows)) for j in range(i) if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold]


def wanted(rows, pairs):
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    degree = [0] * len(rows)
    for i, j in pairs:
        degree[i] += 1
        degree[j] += 1
        root[find(i)] = find(j)
    named = {}
    for i, (vec_id, _, _) in enumerate(rows):
        named.setdefault(find(i), []).append(vec_id)
    least = {r: min((x for x in ids if x is not None), default=None) for r, ids in named.items()}
    return sorted(((vec_id, degree[i], least[find(i)], vec_id == least[find(i)]) for i, (vec_id, _, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_near_dedup(spark, kind):
    rows = [(i, None if v is None else [x if x is None else float(np.float32(x)) for x in v], label) for i, v, label in vectors()]
    got = sorted(map(tuple, embedding_dedup.near_dedup(frame(spark, rows, kind), chunk=8).collect()), key=str)
    assert got == wanted(rows, links(rows))


def test_one_large_group(spark):
    """Followers cost no pairs: the chunks of one following never meet."""
    rng = np.random.default_rng(2)
    base = rng.standard_normal(16)
    rows = [(i, (base + 0.02 * rng.standard_normal(16)).tolist(), 0) for i in range(400)]
    got = embedding_dedup.near_dedup(frame(spark, rows), chunk=8).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(399, 0)} and sum(r.kept for r in got) == 1
    valid = embedding_dedup.vectors(frame(spark, rows)).where("v IS NOT NULL")
    plans = {16: embedding_dedup.plan(16, 400)}
    state = embedding_dedup.followed(embedding_dedup.with_keys(valid, plans), plans[16][0], {16: plans[16][1]})
    assert state.select("lead.row").distinct().count() <= 3
    assert embedding_dedup.chunks(embedding_dedup.postings(state, plans), 8).count() < 1000


def test_recall_at_the_threshold():
    """Pairs at the threshold meet in some table, more often than 1 - 5 MISS."""
    rng = np.random.default_rng(7)
    for width, rows in ((64, 5000), (64, 10**7), (100, 1000)):
        tables, turns = embedding_dedup.plan(width, rows)
        x, z = rng.standard_normal((2, 1500, width))
        x /= np.linalg.norm(x, axis=1)[:, None]
        z -= (z * x).sum(axis=1)[:, None] * x
        y = 0.93 * x + math.sqrt(1 - 0.93**2) * z / np.linalg.norm(z, axis=1)[:, None]
        table, _ = embedding_dedup.common(embedding_dedup.keys(x, tables, turns), embedding_dedup.keys(y, tables, turns))
        assert (table >= 0).mean() > 1 - 5 * embedding_dedup.MISS


def test_hadamard():
    h = np.array([[1.0]])
    while len(h) < 16:
        h = np.block([[h, h], [h, -h]])
    x = np.random.default_rng(0).standard_normal((5, 16))
    assert np.allclose(embedding_dedup.hadamard(x.copy()), x @ h)


def test_empty_tables(spark):
    assert embedding_dedup.near_dedup(frame(spark, [])).count() == 0
    assert vector_codes.vector_codes(frame(spark, [])).count() == 0
    assert embedding_dedup.near_dedup(frame(spark, [(1, None, 1)])).collect()[0].kept
    assert vector_codes.vector_codes(frame(spark, [(1, None, 1), (2, [1.0] * 7, 1)])).count() == 0


def lloyd(rows, rounds=6):
    """Codes by plain Lloyd in Python's integers."""
    kept = [(i, [math.floor(4096 * x) if abs(x) < 2**900 else int(x) * 4096 for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0))
    size = len(kept[0][1]) // 8
    kept = [r for r in kept if len(r[1]) == 8 * size]
    parts = [[tuple(v[p * size : (p + 1) * size]) for _, v, _ in kept] for p in range(8)]
    books = [list(part[:16]) for part in parts]
    far = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c, strict=True))
    near = lambda x, book: min(range(len(book)), key=lambda e: (far(x, book[e]), e))
    for _ in range(rounds):
        for p in range(8):
            of = [near(x, books[p]) for x in parts[p]]
            for e in range(len(books[p])):
                own = [x for x, a in zip(parts[p], of, strict=True) if a == e]
                if own:
                    books[p][e] = tuple(sum(c) // len(own) for c in zip(*own, strict=True))
    sha = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
    out, total = [], {}
    for i, (vec_id, _, label) in enumerate(kept):
        code = [near(parts[p][i], books[p]) for p in range(8)]
        error = sum(far(parts[p][i], books[p][code[p]]) for p in range(8))
        total[label] = total.get(label, 0) + error
        out.append((vec_id, bytes(code).hex(), error, label))
    fits = lambda n: n if n < 2**63 else None
    return sorted((i, code, fits(error), fits(total[label]), sha) for i, code, error, label in out)


def code_rows(n=150, width=16, grid=None, seed=4):
    rng = random.Random(seed)
    draw = (lambda: rng.randrange(-grid, grid + 1) / 4096) if grid else (lambda: rng.gauss(0, 1))
    rows = [(i, [draw() for _ in range(width)], rng.choice([None, 1, 2])) for i in rng.sample(range(1000), n)]
    return rows + [(2000, None, 1), (2001, [math.nan] * width, 1), (2002, [None] * width, 2), (2003, [math.inf] * width, 1)]


@pytest.mark.parametrize("grid", [None, 1, 3])
def test_vector_codes(spark, grid):
    """grid: integers on a small grid, so that ties abound."""
    rows = code_rows(grid=grid)
    assert sorted(map(tuple, vector_codes.vector_codes(frame(spark, rows, "double")).collect())) == lloyd(rows)


def test_vector_codes_of_few_copies_and_large_components(spark):
    for rows in ([(i, [float(i)] * 8, 1) for i in range(5)], [(1, [0.5] * 8, None)] * 30, [(i, [3e5 * (i % 20) + j for j in range(8)], 1) for i in range(40)]):
        assert sorted(map(tuple, vector_codes.vector_codes(frame(spark, rows, "double")).collect())) == lloyd(rows)
    huge = [(i, [1e300 * (i + 1)] * 8, 1) for i in range(20)]
    got = vector_codes.vector_codes(frame(spark, huge, "double")).collect()
    assert len(got) == 20 and {r.codebooks_sha256 for r in got} == {lloyd(huge)[0][4]}


def test_bounds_save_distances():
    """After the first round most rows are not compared with all entries, and the result is the plain one."""
    rng = np.random.default_rng(3)
    centres = 2000 * rng.integers(-9, 9, (16, 8))
    x = (centres[rng.integers(0, 16, 3000)] + rng.integers(-99, 99, (3000, 8))).astype("i8")
    book = centres.astype("i8") + 5
    group = vector_codes.clustered(book)
    entry, upper, lower = np.zeros(3000, "i8"), np.zeros(3000), np.zeros((3000, vector_codes.GROUPS))
    vector_codes.assign(x, book, group, np.zeros(16), entry, upper, lower, fresh=True)
    computed = 0
    for step in range(4):
        after = book + rng.integers(-3, 4, book.shape)
        moved = np.sqrt(((after - book) ** 2).sum(axis=1)) * (1 + vector_codes.SLACK)
        book = after
        computed += vector_codes.assign(x, book, group, moved, entry, upper, lower, fresh=False)
        assert (entry == ((x[:, None] - book) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert computed < 4 * 3000 * 4
