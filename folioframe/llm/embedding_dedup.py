"""Near-duplicate embeddings by cross-polytope hashing.

A vector is padded to a power of two and rotated by three rounds of random
signs and the fast Hadamard transform; the axis end that it comes nearest to is
its hash. A table's key joins the hashes of several rotations, as many as the
largest label needs for buckets of OCCUPANCY rows. A vector is posted under its
own key and under the keys in which one of its hashes gives way to the second
nearest end (multiprobe). How often two vectors at the threshold meet in a
table is measured on made pairs of that dimension, and there are so many tables
that a pair at the threshold is missed with a chance below MISS; closer pairs
meet more often. All pairs of a bucket are verified by their cosine.

Close groups are not compared pair by pair. Every vector looks for a leader in
ROUNDS passes over the buckets: among the leaders of its bucket that with the
smallest hash, if it lies within half the threshold's angle. Two vectors that
follow one leader are within the whole angle, so they are linked unseen; what
is linked to others is still verified. A bucket is cut into chunks of about
CHUNK rows, each large following in chunks of its own, and chunks meet in
pairs, except two of one following: a group that holds a third of all rows
costs as many chunk pairs as it has chunks, not their square.

A pair may meet in several buckets; it counts in the first common one, which
both keys tell. Tasks hand on counts and spanning edges for each vector, never
pairs. Components come from star contraction.

Defined results: vectors of another label or length are never linked; null
labels, null or zero vectors and vectors with null or non-finite components are
linked with nothing; equal vectors are linked; repeated rows are vectors of
their own, and component_id is the smallest identifier among a component's
rows, null ones last; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import spread_join, stored
from ._words import mixed
from .simhash import components

THRESHOLD = 0.93
#: Rows wanted in a bucket; the chance of missing a pair at the threshold; rows of a chunk; passes that look for leaders.
OCCUPANCY, MISS, CHUNK, ROUNDS = 8, 1e-3, 128, 4
#: Of cosines, so that rounding never makes two followers of a leader linked that aren't.
SLACK = 1e-9
SEED = 20_240_917
BUCKET = ["label", "width", "key"]


# ---- hashing


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, in place; the width is a power of two."""
    n, width = x.shape
    half = 1
    while half < width:
        y = x.reshape(n, width // (2 * half), 2, half)
        a, b = y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]
        y[:, :, 0], y[:, :, 1] = a, b
        half *= 2
    return x


@lru_cache(maxsize=64)
def _signs(width: int, table: int, turn: int) -> np.ndarray:
    return np.random.default_rng([SEED, width, table, turn]).choice([-1.0, 1.0], (3, width))


def padded(unit: np.ndarray) -> np.ndarray:
    width = 1 << max(0, unit.shape[1] - 1).bit_length()
    return np.pad(unit, ((0, 0), (0, width - unit.shape[1])))


def ends(x: np.ndarray, table: int, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest and the second nearest axis end of each padded row under a rotation."""
    y = x.copy()
    for signs in _signs(x.shape[1], table, turn):
        y *= signs
        y = hadamard(y)
    size, rows = np.abs(y), np.arange(len(y))
    first = size.argmax(axis=1)
    size[rows, first] = -1
    second = size.argmax(axis=1)
    return 2 * first + (y[rows, first] < 0), 2 * second + (y[rows, second] < 0)


def keys(unit: np.ndarray, tables: int, turns: int) -> np.ndarray:
    """Rows x tables x (1 + turns) signed integers: the own key first, then the probes."""
    x = padded(unit)
    out = np.zeros((len(x), tables, turns + 1), "u8")
    for t in range(tables):
        near = [ends(x, t, j) for j in range(turns)]
        for probe in range(turns + 1):
            h = np.full(len(x), t + 1, "u8")
            for j, (first, second) in enumerate(near):
                h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + (second if probe == j + 1 else first).astype("u8"))
            out[:, t, probe] = h
    return out.view("i8")


def common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each pair of key rows the first table in which they share a key, -1 if none, and the smallest key that they share there."""
    equal = a[:, :, :, None] == b[:, :, None, :]
    shared = equal.any(axis=3)
    met = shared.any(axis=2)
    table = np.where(met.any(axis=1), met.argmax(axis=1), -1)
    rows = np.arange(len(a))
    key = np.where(shared[rows, table], a[rows, table], np.iinfo("i8").max).min(axis=1)
    return table, key


@lru_cache(maxsize=64)
def meeting_rate(width: int, turns: int, cosine: float = THRESHOLD, pairs: int = 1000, tables: int = 8) -> float:
    """How often two vectors at the cosine share a key of a table, measured on made pairs."""
    rng = np.random.default_rng([SEED, width, turns])
    x, z = rng.standard_normal((2, pairs, width))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z -= (z * x).sum(axis=1)[:, None] * x
    norm = np.linalg.norm(z, axis=1)[:, None]
    z = np.divide(z, norm, out=np.zeros_like(z), where=norm > 1e-9)
    y = cosine * x + math.sqrt(1 - cosine**2) * z
    a, b = keys(x, tables, turns), keys(y, tables, turns)
    return float((a[:, :, :, None] == b[:, :, None, :]).any(axis=(2, 3)).mean())


def plan(width: int, rows: int, cosine: float = THRESHOLD, occupancy: int = OCCUPANCY, miss: float = MISS) -> tuple[int, int]:
    """(tables, rotations a key) for a label of so many rows."""
    size = 2 << max(0, width - 1).bit_length()
    turns = max(1, round(math.log(max(1, rows / occupancy)) / math.log(max(2, size))))
    rate = min(0.999, max(1e-3, meeting_rate(width, turns, cosine)))
    return max(2, math.ceil(math.log(miss) / math.log(1 - rate))), turns


# ---- tables


def vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(row, vec_id, label, width, v): each row of df with a number; width and v, packed components, are null where nothing may be linked."""
    kind = df.schema[vector_col].dataType
    narrow = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, values = batch.columns
            out = []
            for v, label in zip(values.to_pylist(), labels.to_pylist(), strict=True):
                x = np.array(v, "f8") if v and label is not None and None not in v else np.zeros(0)
                out.append(x if len(x) and np.isfinite(x).all() and x.any() else None)
            packed = [None if x is None else x.astype("<f4" if narrow else "<f8").tobytes() for x in out]
            yield pa.record_batch([ids, labels, pa.array([None if x is None else len(x) for x in out], pa.int32()), pa.array(packed, pa.binary())], ["vec_id", "label", "width", "v"])

    return rows.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, width int, v binary").withColumn("row", F.monotonically_increasing_id())


def units(packed: list[bytes], width: int) -> np.ndarray:
    """Unit vectors in double precision."""
    data = b"".join(packed)
    x = np.frombuffer(data, "<f4" if len(data) == 4 * width * len(packed) else "<f8").reshape(len(packed), width).astype("f8")
    x = x / np.abs(x).max(axis=1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def with_keys(rows: DataFrame, plans: dict[int, tuple[int, int]]) -> DataFrame:
    """(row, label, width, v, keys): keys packed, tables x probes."""
    label = rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("width").to_numpy()
            for width in np.unique(widths).tolist():
                part = batch.take(pa.array(np.flatnonzero(widths == width)))
                found = keys(units(part.column("v").to_pylist(), width), *plans[width])
                packed = pa.array([x.tobytes() for x in found], pa.binary())
                yield pa.record_batch([*part.select(["row", "label", "width", "v"]).columns, packed], ["row", "label", "width", "v", "keys"])

    return rows.select("row", "label", "width", "v").mapInArrow(run, f"row bigint, label {label}, width int, v binary, keys binary")


def own_key(table: int, turns):
    """The packed own key of a table; turns is a column."""
    return F.substring("keys", F.lit(8 * table) * (turns + 1) + 1, F.lit(8))


def followed(hashed: DataFrame, tables: int, turns: dict[int, int], threshold: float = THRESHOLD, rounds: int = ROUNDS) -> DataFrame:
    """hashed with lead, the row that a vector follows: itself, or one within half the threshold's angle."""
    tight = math.cos(math.acos(threshold) / 2) + SLACK
    state = hashed.withColumn("lead", F.struct(F.xxhash64("row").alias("place"), F.col("row").alias("row"), F.col("v").alias("v")))
    schema = T.StructType(state.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths, names = batch.column("width").to_numpy(), batch.schema.names
            v, lead, offer = batch.column("v").to_pylist(), batch.column("lead"), batch.column("offer")
            offered = offer.field("v").to_pylist()
            take = np.zeros(batch.num_rows, bool)
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(widths == width)
                take[at] = (units([v[i] for i in at], width) * units([offered[i] for i in at], width)).sum(axis=1) >= tight
            better = np.array([(o["place"], o["row"]) < (x["place"], x["row"]) for o, x in zip(_places(offer), _places(lead), strict=True)], bool)
            chosen = pa.concat_arrays([lead, offer]).take(pa.array(np.where(take & better, np.arange(len(v)) + len(v), np.arange(len(v)))))
            yield pa.record_batch([*batch.select(names[:-2]).columns, chosen], names[:-1])

    turns_of = F.create_map(*(F.lit(x) for pair in turns.items() for x in pair))[F.col("width")]
    for turn in range(rounds):
        keyed = state.withColumn("key", own_key(turn % tables, turns_of))
        offers = keyed.groupBy(*BUCKET).agg(F.min_by("lead", F.struct("lead.place", "lead.row")).alias("offer"))
        met = spread_join(stored(keyed), stored(offers), BUCKET)
        state = stored(met.select(*hashed.columns, "lead", "offer").mapInArrow(run, schema))
    return state


def _places(column: pa.StructArray) -> list[dict]:
    return [{"place": p, "row": r} for p, r in zip(column.field("place").to_pylist(), column.field("row").to_pylist(), strict=True)]


class _Chunk:
    """Members of a bucket."""

    def __init__(self, members: list[dict], width: int) -> None:
        self.rows = np.array([m["row"] for m in members], "i8")
        self.leads = np.array([m["lead"] for m in members], "i8")
        self.unit = units([m["v"] for m in members], width)
        self.keys = np.frombuffer(b"".join(m["keys"] for m in members), "<i8")


def verified(one: _Chunk, two: _Chunk | None, key: int, probes: int, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, links, root): rows of the chunks with links that count in this bucket, how many, and the smallest row that they connect with here."""
    other = two or one
    close = one.unit @ other.unit.T >= threshold
    close &= one.leads[:, None] != other.leads
    i, j = np.nonzero(np.triu(close, 1) if two is None else close)
    a, b = one.keys.reshape(len(one.rows), -1, probes)[i], other.keys.reshape(len(other.rows), -1, probes)[j]
    _, first = common(a, b)
    i, j = i[first == key], j[first == key]
    rows, place = np.unique(np.concatenate([one.rows[i], other.rows[j]]), return_inverse=True)
    u, v = place[: len(i)], place[len(i) :]
    root = np.arange(len(rows))
    while len(u):
        least = np.minimum(root[u], root[v])
        if (least == root[u]).all() and (least == root[v]).all():
            break
        np.minimum.at(root, u, least)
        np.minimum.at(root, v, least)
    return rows, np.bincount(place, minlength=len(rows)), rows[root]


def counted(met: DataFrame, turns: dict[int, int], threshold: float = THRESHOLD) -> DataFrame:
    """(row, n, root) of each chunk, or pair of chunks, in (width, key, one, two)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i in range(batch.num_rows):
                width, key, one, two = (batch.column(c)[i].as_py() for c in range(4))
                found.append(verified(_Chunk(one, width), _Chunk(two, width) if two else None, int.from_bytes(key, "little", signed=True), turns[width] + 1, threshold))
            if found:
                yield pa.record_batch([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], ["row", "n", "root"])

    return met.select("width", "key", "one", "two").mapInArrow(run, "row bigint, n bigint, root bigint")


def postings(state: DataFrame, plans: dict[int, tuple[int, int]]) -> DataFrame:
    """(label, width, key, row, lead, v, keys), written: each vector under all its keys that another one has, with the rows of the bucket as n."""
    keyed = state.withColumn("lead", F.col("lead.row")).withColumn("at", F.expr("explode(sequence(0, octet_length(keys) DIV 8 - 1))"))
    posted = keyed.select("label", "width", F.expr("substring(keys, CAST(8 * at + 1 AS INT), 8)").alias("key"), "row", "lead", "v", "keys")
    sizes = stored(posted.groupBy(*BUCKET).agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    return stored(spread_join(posted, sizes, BUCKET))


def chunks(posted: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(width, key, one, two): the members of each small bucket, and the pairs of chunks of each larger one; two is null for a chunk by itself."""
    member = F.struct("row", "lead", "v", "keys")
    small = posted.where(F.col("n") <= chunk).groupBy(*BUCKET).agg(F.collect_list(member).alias("one"))
    large = posted.where(F.col("n") > chunk)
    own = large.groupBy(*BUCKET, "lead").agg(F.count(F.lit(1)).alias("m")).withColumn("part", F.when(F.col("m") > chunk, F.col("lead")))
    parts = own.groupBy(*BUCKET, "part").agg(F.sum("m").alias("part_rows")).withColumn("slices", F.ceil(F.col("part_rows") / chunk).cast("long"))
    own = own.alias("o").join(parts.alias("p"), (F.col("o.part").eqNullSafe(F.col("p.part"))) & (F.col("o.label") == F.col("p.label")) & (F.col("o.width") == F.col("p.width")) & (F.col("o.key") == F.col("p.key")))
    own = stored(own.select("o.label", "o.width", "o.key", "o.lead", "o.part", "p.slices"))
    cut = spread_join(large, own, [*BUCKET, "lead"]).withColumn("slice", F.pmod(F.xxhash64("row"), "slices"))
    whole = stored(cut.groupBy(*BUCKET, "part", "slice").agg(F.collect_list(member).alias("members")))
    one, two = whole.alias("a"), whole.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in BUCKET]
    before = F.struct(F.coalesce("a.part", F.lit(-1)), "a.slice") < F.struct(F.coalesce("b.part", F.lit(-1)), "b.slice")
    apart = F.col("a.part").isNull() | ~F.col("a.part").eqNullSafe(F.col("b.part"))
    pairs = one.join(two, same[0] & same[1] & same[2] & before & apart).select("a.width", "a.key", F.col("a.members").alias("one"), F.col("b.members").alias("two"))
    none = F.lit(None).cast(small.schema["one"].dataType).alias("two")
    alone = small.select("width", "key", "one", none).unionByName(whole.where("part IS NULL").select("width", "key", F.col("members").alias("one"), none))
    return alone.unionByName(pairs)


def near_dedup(df: DataFrame, threshold: float = THRESHOLD, chunk: int = CHUNK, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each row of df."""
    rows = stored(vectors(df, id_col, vector_col, label_col))
    valid = rows.where("v IS NOT NULL")
    largest = valid.groupBy("label", "width").count().groupBy("width").agg(F.max("count").alias("n")).collect()  # one row a length of vectors
    plans = {r.width: plan(r.width, r.n, threshold) for r in largest}
    none = df.sparkSession.createDataFrame([], "row bigint, n_links bigint, component bigint")
    linked = _linked(valid, plans, threshold, chunk, rounds) if plans else none
    out = stored(rows.select("row", "vec_id").join(linked, "row", "left").select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component", "row").alias("component")))
    named = stored(out.groupBy("component").agg(F.min("vec_id").alias("component_id")))
    return spread_join(out, named, ["component"]).select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _linked(valid: DataFrame, plans: dict[int, tuple[int, int]], threshold: float, chunk: int, rounds: int) -> DataFrame:
    """(row, n_links, component) of the rows with links."""
    turns = {width: t for width, (_, t) in plans.items()}
    hashed = stored(with_keys(valid, plans))
    state = followed(hashed, min(t for t, _ in plans.values()), turns, threshold, rounds)
    found = stored(counted(chunks(postings(state, plans), chunk), turns, threshold).groupBy("row", "root").agg(F.sum("n").alias("n")))
    followers = stored(state.select("row", F.col("lead.row").alias("lead")))
    balls = stored(followers.groupBy("lead").agg((F.count(F.lit(1)) - 1).alias("n")).where("n > 0"))
    inside = spread_join(followers, balls, ["lead"])
    counts = found.select("row", "n").unionByName(inside.select("row", "n")).groupBy("row").agg(F.sum("n").alias("n_links"))
    edges = found.select(F.col("row").alias("a"), F.col("root").alias("b")).unionByName(inside.select(F.col("row").alias("a"), F.col("lead").alias("b")))
    roots = components(edges)
    return counts.join(roots, counts["row"] == roots["node"], "left").select("row", "n_links", F.coalesce("root", "row").alias("component"))


ORACLE = r"""
WITH RECURSIVE u AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), n AS (SELECT a, count(*) AS n FROM links GROUP BY a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""
