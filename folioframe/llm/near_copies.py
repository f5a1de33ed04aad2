"""Rows whose texts are near copies of another row's, by SimHash links and by shingles.

Two rows are linked if their three-word SimHashes are linked (simhash.links),
or if the Jaccard similarity of their sets of five-word shingles is LEAST or
more. Candidates for the second kind agree in one of BANDS bands of WIDTH
minima each: at a similarity of 0.8 a pair is missed with a chance of
(1 - 0.8 ** WIDTH) ** BANDS, 3 in a million. Every candidate is verified by the
shingles of both whole texts.

First each row of a band's list meets the list's first row. In a list of up to
LONG_LIST rows, those that this leaves unlinked then meet all the others. In a
longer one they do so as far as nothing links them yet: what is linked so far
is contracted to components, and of the lists that hold several, every two rows
of different components are compared by all their shingles (crossing). Such a
list is cut into slices that meet in pairs; a component that fills slices of
its own is not compared with itself, and no pair leaves a task but the few that
link its components. So a group of copies costs as many candidates as it has
rows, rows of one pattern that are all different cost comparisons with the
square of their number, and no pair that agrees in a band stays unlinked.

Defined results: words are lowercased (A-Z) and split at ASCII white space;
texts of fewer words than a shingle are one shingle; null, empty and blank
texts are linked to each other by SimHash zero; of linked rows the smallest
identifier stays, null ones last, then the smallest row key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from ._common import hot_limit, map_slices, partitions, slices, spread_join, stored
from ._words import WINDOW_BASE, hashed_words, mixed, window_hashes

SHINGLE, LEAST = 5, 0.8
BANDS, WIDTH, LONG_LIST = 24, 4, 32
#: Bytes of shingles in a slice of a long list.
SLICE = 2 << 20
_MULTIPLIERS = mixed(np.arange(1, BANDS * WIDTH + 1, dtype="u8")) | np.uint64(1)


def shingles(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' shingles and the position in texts of each one's text, which rises."""
    words, text_of = hashed_words([t.lower() for t in texts])
    h, at = window_hashes(words, text_of, size)
    owner = text_of[at]
    counts = np.bincount(text_of, minlength=len(texts))
    short = np.flatnonzero((counts > 0) & (counts < size))
    if not len(short):
        return h, owner
    first = np.searchsorted(text_of, short)
    whole = words[first].copy()
    for i in range(1, size - 1):
        more = counts[short] > i
        whole[more] = whole[more] * WINDOW_BASE + words[first[more] + i]
    h, owner = np.concatenate([h, mixed(whole)]), np.concatenate([owner, short])
    order = np.argsort(owner, kind="stable")
    return h[order], owner[order]


def band_keys(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Texts x BANDS: a hash of each band's minima; starts are the texts' first shingles."""
    keys = np.empty((len(starts), BANDS), "u8")
    for b in range(BANDS):
        key = np.full(len(starts), b, "u8")
        for k in range(b * WIDTH, (b + 1) * WIDTH):
            key = mixed(key * WINDOW_BASE + np.minimum.reduceat(h * _MULTIPLIERS[k], starts))
        keys[:, b] = key
    return keys.view("i8")


def marks(rows: DataFrame) -> DataFrame:
    """(row, fp, n, bands) of rows (row, data): the SimHash, the count of distinct shingles and the bands' keys."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        h, owner = shingles(texts)
        some, starts = np.unique(owner, return_index=True)
        n, bands = np.zeros(len(texts), "i8"), [[] for _ in texts]
        if len(some):
            n[some] = [len(np.unique(x)) for x in np.split(h, starts[1:])]
            for i, x in zip(some.tolist(), band_keys(h, starts).tolist(), strict=True):
                bands[i] = x
        fp = np.array([simhash.fingerprint(x) for x in texts], "<u8").view("<i8")
        return pa.record_batch([batch.column(0), pa.array(fp), pa.array(n), pa.array(bands, pa.list_(pa.int64()))], ["row", "fp", "n", "bands"])

    return map_slices(rows, one, "row bigint, fp bigint, n bigint, bands array<bigint>")


def _similar_sizes(x, y):
    """No smaller set can be similar enough."""
    return F.least(x, y) >= LEAST * F.greatest(x, y)


def _stars(members: DataFrame) -> DataFrame:
    """members (key, row, n, ...) with the first row of their list: first, first_n."""
    firsts = members.groupBy("key").agg(F.min_by(F.struct("row", "n"), "row").alias("f")).select("key", F.col("f.row").alias("first"), F.col("f.n").alias("first_n"))
    return stored(spread_join(members, firsts, ["key"]))


def _pairs_with_first(stars: DataFrame) -> DataFrame:
    return stars.where((F.col("row") != F.col("first")) & _similar_sizes(F.col("n"), F.col("first_n"))).select(F.col("first").alias("a"), F.col("row").alias("b")).distinct()


def verified(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts in rows (row, data) have a similarity of LEAST or more.

    The pairs of a frequent a are dealt over slices, as often as its text is repeated.
    """
    limit = hot_limit(pairs.sparkSession, pairs.count())
    hot = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)  # fewer than twice the partitions
    hot = stored(hot.select("a", F.least(F.ceil(F.col("n") / limit), F.lit(partitions(pairs.sparkSession))).cast("int").alias("slices")))
    dealt = pairs.join(F.broadcast(hot), "a", "left").select("a", "b", F.coalesce(F.pmod(F.xxhash64("b"), F.col("slices")).cast("int"), F.lit(0)).alias("slice"))
    left = rows.select(F.col("row").alias("a"), F.col("data").alias("left")).join(F.broadcast(hot), "a", "left")
    left = left.select("a", "left", F.explode(F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)).alias("slice"))
    both = dealt.join(left, ["a", "slice"]).join(rows.select(F.col("row").alias("b"), F.col("data").alias("right")), "b").select("a", "b", "left", "right")

    def sets(texts: list[bytes]) -> list[np.ndarray]:
        h, owner = shingles(texts)
        return [np.unique(x) for x in np.split(h, np.searchsorted(owner, np.arange(1, len(texts))))]

    def similar(batches):
        for batch in slices(batches, "left"):
            found = []
            for x, y in zip(sets(batch.column(2).to_pylist()), sets(batch.column(3).to_pylist()), strict=True):
                shared = len(np.intersect1d(x, y, assume_unique=True))
                found.append(shared > 0 and shared >= LEAST * (len(x) + len(y) - shared))
            yield batch.select([0, 1]).filter(pa.array(found, pa.bool_()))

    return both.mapInArrow(similar, "a bigint, b bigint")


def shingle_sets(rows: DataFrame) -> DataFrame:
    """(row, shingles) of rows (row, data): the hashes of the distinct shingles, rising, 8 bytes each."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        h, owner = shingles(batch.column(1).to_pylist())
        sets = np.split(h, np.searchsorted(owner, np.arange(1, batch.num_rows)))
        return pa.record_batch([batch.column(0), pa.array([np.unique(x).tobytes() for x in sets], pa.binary())], ["row", "shingles"])

    return map_slices(rows, one, "row bigint, shingles binary")


def links_across(cell: pa.Table) -> pa.Table:
    """(a, b): similar rows of a cell that link its roots, no more than it takes. cell has key, side, row, root, bands, shingles.

    Rows of side 0 meet those of side 1, or each other if there is no side 1.
    Pairs that agree in an earlier band have met in its list.
    """
    row, root, side = (cell[c].to_numpy() for c in ("row", "root", "side"))
    order = np.argsort(side, kind="stable")
    row, root = row[order], root[order]
    bands = cell["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)[order]
    earlier = bands[:, : int(np.argmax(bands[0] == cell["key"][0].as_py()))]
    sets = [np.frombuffer(x, "u8") for x in cell["shingles"].take(pa.array(order)).to_pylist()]
    n = np.array([len(x) for x in sets])
    starts = np.concatenate([[0], np.cumsum(n)])
    values, ids = np.unique(np.concatenate(sets), return_inverse=True)
    held = np.zeros(len(values), "u1")
    second = int(np.count_nonzero(side == 0))
    found = []
    for i in range(second):
        first = second if second < len(row) else i + 1
        at = first + np.flatnonzero((root[first:] != root[i]) & _similar_sets_possible(n[i], n[first:]))
        at = at[~(earlier[at] == earlier[i]).any(axis=1)]
        if not len(at):
            continue
        mine = ids[starts[i] : starts[i + 1]]
        held[mine] = 1
        if 4 * len(at) > len(row) - first:
            shared = np.add.reduceat(held[ids[starts[first] :]], starts[first:-1] - starts[first], dtype="i8")[at - first]
        else:
            shared = np.array([np.count_nonzero(held[ids[starts[j] : starts[j + 1]]]) for j in at.tolist()])
        held[mine] = 0
        for j in at[(shared > 0) & (shared >= LEAST * (n[i] + n[at] - shared))].tolist():
            if root[i] != root[j]:
                found.append((min(row[i], row[j]), max(row[i], row[j])))
                root = np.where(root == root[j], root[i], root)
    return pa.table([pa.array([int(x[k]) for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])


def _similar_sets_possible(x: int, y: np.ndarray) -> np.ndarray:
    return np.minimum(x, y) >= LEAST * np.maximum(x, y)


def crossing(lists: DataFrame, marked: DataFrame, texts: DataFrame, edges: DataFrame) -> DataFrame:
    """(a, b), a < b: similar rows that share a list of lists (key, row, n), enough to connect all such rows beside edges (a, b)."""
    roots = simhash.components(edges).withColumnRenamed("node", "row")
    rooted = stored(lists.join(roots, "row", "left").select("key", "row", "n", F.coalesce("root", "row").alias("root")))
    groups = stored(rooted.groupBy("key", "root").agg(F.sum(8 * F.col("n")).alias("bytes")))
    own = F.col("bytes") > SLICE // 2
    mixed_lists = groups.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.sum(F.when(own, 0).otherwise(F.col("bytes"))).alias("others"))
    mixed_lists = stored(mixed_lists.where("least < most").select("key", "others"))
    parts = F.greatest(F.lit(1), F.ceil(F.when(own, F.col("bytes")).otherwise(F.col("others")) / SLICE)).cast("long")
    cut = stored(spread_join(groups, mixed_lists, ["key"]).select("key", "root", own.alias("own"), parts.alias("parts")))
    number = F.pmod(F.xxhash64(F.when(F.col("own"), F.col("row")).otherwise(F.col("root"))), F.col("parts"))
    part = F.struct("own", F.when(F.col("own"), F.col("root")).otherwise(F.lit(0)).alias("of"), number.alias("number"))
    dealt = stored(spread_join(rooted, cut, ["key", "root"]).select("key", "row", "root", part.alias("part")))
    slices_of = stored(dealt.select("key", "part").distinct())
    one, two = slices_of.select("key", F.col("part").alias("one")), slices_of.select("key", F.col("part").alias("two"))
    cells = one.join(two, "key").where((F.col("one") <= F.col("two")) & ~(F.col("one.own") & F.col("two.own") & (F.col("one.of") == F.col("two.of"))))
    sides = F.when(F.col("one") == F.col("two"), F.array("one")).otherwise(F.array("one", "two"))
    cells = stored(cells.select("key", F.xxhash64("one", "two").alias("cell"), F.posexplode(sides).alias("side", "part")))
    meant = stored(dealt.join(cells, ["key", "part"]).select("key", "cell", "side", "row", "root"))
    known = texts.join(meant.select("row").distinct(), "row", "left_semi").select("row", "data")
    known = shingle_sets(known).join(marked.select("row", "bands"), "row")
    met = meant.join(stored(known), "row").select("key", "cell", "side", "row", "root", "bands", "shingles")
    return met.groupBy("key", "cell").applyInArrow(links_across, "a bigint, b bigint").distinct()


def similar_rows(marked: DataFrame, rows: DataFrame, linked: DataFrame | None = None) -> DataFrame:
    """(a, b), a < b: rows of rows (row, data) that share LEAST of their shingles, enough to connect all such rows; marked are marks() of them.

    What linked (a, b) connects need not be connected once more.
    """
    posted = stored(marked.select("row", "n", F.explode("bands").alias("key")))
    lists = posted.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = stored(spread_join(posted, lists, ["key"]))
    texts = stored(rows.join(members.select("row").distinct(), "row"))  # only the texts that meet another
    stars = _stars(members)
    found = stored(verified(_pairs_with_first(stars), texts))
    starred = found.select(F.col("a").alias("first"), F.col("b").alias("row"))
    rest = stored(stars.where(F.col("row") != F.col("first")).join(starred, ["first", "row"], "left_anti").select("key", "row", "n", "size", "first"))
    others = members.where(F.col("size") <= LONG_LIST).select("key", F.col("row").alias("other"), F.col("n").alias("other_n"))
    pairs = rest.where(F.col("size") <= LONG_LIST).join(others, "key").where((F.col("row") != F.col("other")) & (F.col("other") != F.col("first")) & _similar_sizes(F.col("n"), F.col("other_n")))
    found = found.unionByName(stored(verified(stored(pairs.select(F.least("row", "other").alias("a"), F.greatest("row", "other").alias("b")).distinct()), texts)))
    loose = stored(rest.where(F.col("size") > LONG_LIST).select("key").distinct())  # long lists that stars leave in parts
    if not loose.isEmpty():
        edges = found if linked is None else found.unionByName(linked)
        found = found.unionByName(stored(crossing(spread_join(members, loose, ["key"]), marked, texts, edges)))
    return found.distinct()


def gone(df: DataFrame, row_col: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row): the keys of the rows of df that go, so that one of each group of linked rows stays. row_col is a key of rows, a bigint."""
    rows = df.select(F.col(row_col).alias("row"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"))
    marked = stored(marks(rows))
    distinct = stored(marked.groupBy("fp").agg(F.min("row").alias("first")))
    same = spread_join(marked.select("row", "fp"), distinct, ["fp"]).where(F.col("row") != F.col("first")).select(F.col("first").alias("a"), F.col("row").alias("b"))
    named = [distinct.select(F.col("fp").alias(x), F.col("first").alias(f"row_{x}")) for x in "ab"]
    close = simhash.links(distinct.select("fp")).join(named[0], "a").join(named[1], "b").select(F.col("row_a").alias("a"), F.col("row_b").alias("b"))
    alike = stored(same.unionByName(close))
    edges = alike.unionByName(similar_rows(marked, rows, alike))
    roots = stored(simhash.components(edges))
    members = stored(roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()))
    ids = df.select(F.col(row_col).alias("node"), F.col(id_col).alias("id"))
    named_rows = members.join(ids, "node").select("root", F.struct(F.col("id").isNull().alias("nameless"), "id", F.col("node").alias("row")).alias("x"))
    kept = named_rows.groupBy("root").agg(F.min("x")["row"].alias("keep"))
    return spread_join(members, kept, ["root"]).where(F.col("node") != F.col("keep")).select(F.col("node").alias("row"))
