"""Vector codes by Yinyang Lloyd in integers.

Each component x becomes floor(4096 x); vectors are cut into PARTS equal parts,
and each part position has a codebook of ENTRIES entries, which start as that
part of the vectors with the smallest identifiers. ROUNDS rounds of Lloyd's
algorithm follow: every part goes to its nearest entry, entries become the
floors of their parts' means, unused ones stay.

Each codebook's entries are clustered into GROUPS groups once. A row keeps, for
every part, its entry, an upper bound of the distance to it and a lower bound
of the distance to the other entries of each group. After a round the bounds
are shifted by what the entries have moved; a row whose upper bound lies below
all lower ones keeps its entry unseen. Otherwise its distance is computed, and
then only the groups whose bound still fails are scanned. Bounds are floats
with a slack of SLACK, so a group that holds an equally near entry always
fails; the scan compares exact integers, and of equally near entries the first
one wins. Rows of large components are computed with Python's integers.

Rows with their state are a written table, made anew in each round (the one
before goes). What tasks send on are sums of parts by entry, fixed in size; the
driver holds codebooks only.

Defined results: null vectors and vectors with null or non-finite components
are dropped; so are vectors whose length is not that of the vector with the
smallest identifier (of equal ones, the smallest vector), and all if that
length is no positive multiple of PARTS; fewer than ENTRIES kept rows make
smaller codebooks; repeated rows count as often as they occur, also as first
entries; a null identifier is larger than all others; null labels are one
label; an error, or a sum of errors, beyond a long is null; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import discard
from ._common import spread_join, stored

SCALE, PARTS, ENTRIES, ROUNDS, GROUPS = 4096, 8, 16, 6, 4
#: Of the bounds, relative and absolute.
SLACK = 1e-6
#: Components below this are computed with 64-bit integers.
EXACT = 1 << 26
#: Bits of a limb of a sum.
LIMB = 40
#: Integers that fit a float.
LARGE = 1 << 1000
STATE = "vec_id {id}, label {label}, ints binary, entry binary, upper binary, lower binary"
MOST_LONG = (1 << 63) - 1


@dataclass
class Codebooks:
    """entries: part x entry x position (objects beyond EXACT); group: part x entry; moved: part x entry, since the round before."""

    entries: np.ndarray
    group: np.ndarray
    moved: np.ndarray

    def exact(self) -> bool:
        return not self.entries.size or int(abs(self.entries).max()) < EXACT


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors along the last axis."""
    d = x - y
    return (d * d).sum(axis=-1)


def _root(squares: np.ndarray) -> np.ndarray:
    """Roots as floats, infinite beyond them; they only bound."""
    if squares.dtype != object:
        return np.sqrt(squares.astype("f8"))
    squares, shape = squares.ravel(), squares.shape
    roots = [math.sqrt(v) if v < LARGE else float(math.isqrt(v)) if v < LARGE * LARGE else math.inf for v in map(int, squares)]
    return np.array(roots, "f8").reshape(shape)


def clustered(entries: np.ndarray, groups: int = GROUPS, steps: int = 10) -> np.ndarray:
    """The group of each entry: a few Lloyd steps from the first entries. It steers the work, not the result."""
    e = (np.clip(entries, -LARGE, LARGE) if entries.dtype == object else entries).astype("f8")
    centres = e[: max(1, min(groups, len(e)))].copy()
    of = np.zeros(len(e), "i8")
    for _ in range(steps):
        of = ((e[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1) if len(e) else of
        for g in range(len(centres)):
            if (of == g).any():
                centres[g] = e[of == g].mean(axis=0)
    return of


def assign(x: np.ndarray, book: np.ndarray, group: np.ndarray, moved: np.ndarray, entry: np.ndarray, upper: np.ndarray, lower: np.ndarray, fresh: bool) -> int:
    """Brings entry, upper and lower (rows, rows, rows x GROUPS) of one part position up to date, in place. Returns the distances computed.

    x and book are exact integers. fresh: nothing is known yet.
    """
    members = [np.flatnonzero(group == g) for g in range(GROUPS)]
    if fresh:
        upper[:], lower[:] = np.inf, [-np.inf if len(m) else np.inf for m in members]
        todo = np.arange(len(x))
    else:
        upper += moved[entry]
        lower -= np.array([moved[m].max() if len(m) else 0.0 for m in members])
        todo = np.flatnonzero(~(upper < lower.min(axis=1)))
    if not len(todo):
        return 0
    best = _squares(x[todo], book[entry[todo]])  # exact, of the present entry
    upper[todo] = _root(best) * (1 + SLACK) + SLACK
    computed = len(todo)
    was, was_at = entry[todo].copy(), best.copy()
    now = was.copy()
    scan = [np.flatnonzero(~(upper[todo] < lower[todo, g])) if len(members[g]) else np.zeros(0, "i8") for g in range(GROUPS)]
    found: list[tuple[int, np.ndarray, np.ndarray]] = []
    for g, rows in enumerate(scan):
        if not len(rows):
            continue
        d = _squares(x[todo[rows], None], book[members[g]])
        computed += d.size
        for k, e in enumerate(members[g]):
            nearer = (d[:, k] < best[rows]) | ((d[:, k] == best[rows]) & (e < now[rows]))
            now[rows[nearer]], best[rows[nearer]] = e, d[nearer, k]
        found.append((g, rows, d))
    for g, rows, d in found:  # the nearest other entry of each scanned group
        near = _root(d)
        near[now[rows][:, None] == members[g]] = np.inf
        lower[todo[rows], g] = near.min(axis=1) * (1 - SLACK) - SLACK
    left = np.flatnonzero(now != was)  # an entry that is given up bounds its group, scanned or not
    if len(left):
        g = group[was[left]]
        lower[todo[left], g] = np.minimum(lower[todo[left], g], _root(was_at[left]) * (1 - SLACK) - SLACK)
    entry[todo] = now
    upper[todo] = _root(best) * (1 + SLACK) + SLACK
    return computed


def _integers(column: pa.Array, width: int) -> np.ndarray:
    """Rows x components, as 64-bit integers or, if some are large, objects."""
    parts = column.to_pylist()
    wide = any(len(p) != 8 * width for p in parts)
    if not wide:
        return np.frombuffer(b"".join(parts), "<i8").reshape(len(parts), width)
    return np.array([[int(v) for v in p[1:].decode().split(",")] if len(p) != 8 * width else np.frombuffer(p, "<i8").tolist() for p in parts], object)


def _packed(values: np.ndarray) -> bytes:
    """Integers of a row: 8 bytes each; beyond EXACT, decimal after a sign that makes the length another."""
    if not len(values) or abs(values).max() < EXACT:
        return values.astype("<i8").tobytes()
    text = b"#" + ",".join(str(int(v)) for v in values).encode()
    return text if len(text) % 8 else text.replace(b"#", b"#0", 1)


def with_integers(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, label, width, ints) of the rows whose vector is neither null nor holds null or non-finite components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, vectors = batch.columns
            rows = vectors.to_pylist()
            ok = [i for i, v in enumerate(rows) if v is not None and None not in v and np.isfinite(np.array(v, "f8")).all()]
            packed = []
            for i in ok:
                scaled = np.floor(np.array(rows[i], "f8") * SCALE) if max(map(abs, rows[i]), default=0) < 1e300 else None
                exact = scaled if scaled is not None and (not len(scaled) or abs(scaled).max() < EXACT) else np.array([_floor(v) for v in rows[i]], object)
                packed.append(_packed(exact))
            take = pa.array(ok, pa.int64())
            yield pa.record_batch([ids.take(take), labels.take(take), pa.array([len(rows[i]) for i in ok], pa.int32()), pa.array(packed, pa.binary())], ["vec_id", "label", "width", "ints"])

    rows = df.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, width int, ints binary")


def _floor(x: float) -> int:
    n, d = float(x).as_integer_ratio()
    return n * SCALE // d


def first_codebooks(rows: DataFrame, width: int) -> Codebooks:
    """The parts of the vectors with the smallest identifiers."""
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "ints").limit(ENTRIES).select("ints").collect()
    vectors = _integers(pa.array([bytes(r.ints) for r in first], pa.binary()), width)
    entries = vectors.reshape(len(vectors), PARTS, width // PARTS).transpose(1, 0, 2).copy()
    return Codebooks(entries, np.array([clustered(p) for p in entries]), np.zeros(entries.shape[:2]))


def _assigned(rows: DataFrame, books: Codebooks, width: int, fresh: bool) -> DataFrame:
    """rows with their state brought up to date under the codebooks."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            ints = _integers(batch.column("ints"), width)
            if ints.dtype != object and not books.exact():
                ints = ints.astype(object)
            x = ints.reshape(n, PARTS, width // PARTS)
            if fresh:
                entry, upper, lower = np.zeros((n, PARTS), "i8"), np.zeros((n, PARTS)), np.zeros((n, PARTS, GROUPS))
            else:
                entry = np.frombuffer(b"".join(batch.column("entry").to_pylist()), "u1").reshape(n, PARTS).astype("i8")
                upper = np.frombuffer(b"".join(batch.column("upper").to_pylist()), "<f8").reshape(n, PARTS).copy()
                lower = np.frombuffer(b"".join(batch.column("lower").to_pylist()), "<f8").reshape(n, PARTS, GROUPS).copy()
            for p in range(PARTS):
                assign(x[:, p], books.entries[p].astype(x.dtype), books.group[p], books.moved[p], entry[:, p], upper[:, p], lower[:, p], fresh)
            state = [pa.array([a[i].tobytes() for i in range(n)], pa.binary()) for a in (entry.astype("u1"), upper, lower)]
            yield pa.record_batch([batch.column("vec_id"), batch.column("label"), batch.column("ints"), *state], ["vec_id", "label", "ints", "entry", "upper", "lower"])

    return rows.mapInArrow(run, STATE.format(id=kinds["vec_id"], label=kinds["label"]))


def _sums(state: DataFrame, width: int, entries: int) -> dict[tuple[int, int, int], int]:
    """The sum of each (part, entry, position) over all rows; at position -1, the number of its parts."""
    size = width // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((PARTS, entries, size), object), np.zeros((PARTS, entries), "i8")
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _integers(batch.column("ints"), width).reshape(batch.num_rows, PARTS, size)
            entry = np.frombuffer(b"".join(batch.column("entry").to_pylist()), "u1").reshape(batch.num_rows, PARTS)
            for p in range(PARTS):
                order = np.argsort(entry[:, p], kind="stable")
                used, first, n = np.unique(entry[order, p], return_index=True, return_counts=True)
                total[p, used] += np.add.reduceat(x[order, p], first, axis=0).astype(object)
                count[p, used] += n
        sums = [(p, e, i, total[p, e, i]) for p in range(PARTS) for e in range(entries) if count[p, e] for i in range(size)]
        sums += [(p, e, -1, int(count[p, e])) for p in range(PARTS) for e in range(entries) if count[p, e]]
        rows = [(p, e, i, k, limb) for p, e, i, value in sums for k, limb in enumerate(_limbs(int(value)))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["part", "entry", "position", "limb", "value"])

    sums = state.select("ints", "entry").mapInArrow(run, "part bigint, entry bigint, position bigint, limb bigint, value bigint")
    out: dict[tuple[int, int, int], int] = {}
    for r in sums.groupBy("part", "entry", "position", "limb").agg(F.sum("value").alias("value")).collect():
        key = (r.part, r.entry, r.position)
        out[key] = out.get(key, 0) + (r.value << LIMB * r.limb)
    return out


def _limbs(value: int) -> list[int]:
    """value in base 2 ** LIMB, the last limb signed, so that sums of any size add up as longs."""
    out = []
    while not -(1 << LIMB) <= value < 1 << LIMB:
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


def moved_codebooks(books: Codebooks, sums: dict[tuple[int, int, int], int]) -> Codebooks:
    """Each entry becomes the floor of its parts' mean; unused entries stay."""
    parts, entries, size = books.entries.shape
    out = books.entries.astype(object)
    for p in range(parts):
        for e in range(entries):
            if count := sums.get((p, e, -1)):
                out[p, e] = [sums[p, e, i] // count for i in range(size)]
    if not out.size or abs(out).max() < EXACT:
        out = out.astype("i8")
    change = out.astype(object) - books.entries.astype(object)
    moved = _root((change * change).sum(axis=2)) * (1 + SLACK) + SLACK
    return Codebooks(out, books.group, moved)


def encode(df: DataFrame, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, Codebooks | None]:
    """((vec_id, label, code, error), codebooks). Without rows to encode the codebooks are None."""
    rows = stored(with_integers(df, id_col, vector_col, label_col))
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "ints").select("width").first()
    width = first.width if first else 0
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint"
    if width < 1 or width % PARTS:
        return df.sparkSession.createDataFrame([], schema), None
    rows = rows.where(F.col("width") == width)
    books = first_codebooks(rows, width)
    state = rows
    for turn in range(rounds + 1):
        before, state = state, stored(_assigned(state, books, width, fresh=turn == 0))
        if turn:
            discard(before)
        if turn < rounds:
            books = moved_codebooks(books, _sums(state, width, books.entries.shape[1]))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            entry = np.frombuffer(b"".join(batch.column("entry").to_pylist()), "u1").reshape(n, PARTS)
            x = _integers(batch.column("ints"), width).reshape(n, PARTS, width // PARTS)
            if not books.exact():
                x = x.astype(object)
            error = sum(_squares(x[:, p], books.entries[p].astype(x.dtype)[entry[:, p]]) for p in range(PARTS)) if n else np.zeros(0, "i8")
            errors = pa.array([int(v) if v <= MOST_LONG else None for v in error], pa.int64())
            yield pa.record_batch([batch.column("vec_id"), batch.column("label"), pa.array([e.tobytes().hex() for e in entry], pa.string()), errors], ["vec_id", "label", "code", "error"])

    return state.select("vec_id", "label", "ints", "entry").mapInArrow(finish, schema), books


def digest(books: Codebooks | None) -> str:
    """SHA-256 of all entries' components by part, entry and position."""
    return hashlib.sha256(",".join(str(int(v)) for v in books.entries.ravel()).encode()).hexdigest() if books else ""


def vector_codes(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256), a row for each kept row of df."""
    codes, books = encode(df, id_col=id_col, vector_col=vector_col, label_col=label_col)
    rows = stored(codes.select("vec_id", "code", "error", F.struct("label").alias("label")))
    sums = stored(rows.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint").alias("label_error")))
    return spread_join(rows, sums, ["label"]).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _oracle() -> str:
    """Lloyd's rounds written out one after another."""
    steps = [
        r"""
kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cells AS MATERIALIZED (
  SELECT r, CAST(i // (len(v) // 8) AS INT) AS part, CAST(i % (len(v) // 8) AS INT) AS pos, v[i + 1] AS x FROM (SELECT r, v, unnest(range(len(v))) AS i FROM kept)
), parts AS MATERIALIZED (SELECT r, part, list(x ORDER BY pos) AS xs FROM cells GROUP BY r, part),
b0 AS MATERIALIZED (SELECT part, CAST(r AS INT) AS entry, xs AS c FROM parts WHERE r < 16)"""
    ]
    for i in range(ROUNDS + 1):
        steps.append(f"""d{i} AS MATERIALIZED (
  SELECT r, part, min(struct_pack(d := d, entry := entry)) AS best
  FROM (SELECT p.r, p.part, b.entry, CAST(list_sum(list_transform(list_zip(p.xs, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM parts p JOIN b{i} b USING (part))
  GROUP BY r, part
)""")
        if i < ROUNDS:
            steps.append(f"""m{i} AS MATERIALIZED (
  SELECT part, entry, list(m ORDER BY pos) AS c FROM (
    SELECT d.part, d.best.entry AS entry, c.pos, CAST((sum(c.x) - ((sum(c.x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
    FROM d{i} d JOIN cells c ON c.r = d.r AND c.part = d.part GROUP BY d.part, d.best.entry, c.pos
  ) GROUP BY part, entry
), b{i + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.c, b.c) AS c FROM b{i} b LEFT JOIN m{i} m USING (part, entry))""")
    return (
        "WITH "
        + ", ".join(steps)
        + f""", coded AS (
  SELECT k.vec_id, k.label, string_agg(printf('%02x', d.best.entry), '' ORDER BY d.part) AS code, CAST(sum(d.best.d) AS BIGINT) AS error
  FROM d{ROUNDS} d JOIN kept k USING (r) GROUP BY k.r, k.vec_id, k.label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM b{ROUNDS}) AS codebooks_sha256
FROM coded
"""
    )


ORACLE = _oracle()
