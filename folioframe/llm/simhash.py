"""SimHash near-deduplication with an inverted index over fingerprint bytes.

A 64-bit fingerprint has eight positional bytes. If two fingerprints differ in
at most two bits, at least LEAST_BYTES = 6 of the eight agree. The index posts
each distinct fingerprint under the 14 sets of four positions in BLOCKS. Of any
six positions exactly three of these sets consist, and they cover all six; of
fewer positions one set at most consists. So a pair's tally, the positional
bytes of all lists that it meets in, is six or more if and only if six bytes
agree: pairs below that guaranteed minimum are dropped by the count alone, and
only the others are verified bit by bit.

Copies share a fingerprint and are one posting. A list with more than
LONG_LIST postings is not expanded into pairs: its members, which agree on
four bytes, are posted again under each value that the other four can take
with at most one bit changed. Two fingerprints at distance two or less meet
under such a value, all that meet there are within distance two, and at most
33 can, so a star around the smallest loses no connection.

Components come from alternating star contraction over the links; no link,
component or fingerprint is collected to the driver. What a frequent node,
fingerprint or component needs is broadcast (spread_join), the rest shuffled.

Defined results: null or empty text has fingerprint zero and is linked like
any other; texts of fewer words than a shingle are one shingle; a null
identifier is larger than all others; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import hot_limit, id_bytes, map_slices, spread_join, stored

SEED = 42
LONG_LIST = 32
#: Bits that may differ, and so the least number of equal bytes.
MOST_BITS, LEAST_BYTES = 2, 6
#: The sets of four of the positions 0 to 7 whose numbers' binary sum without carry is 0.
BLOCKS = [c for c in combinations(range(8), 4) if c[0] ^ c[1] ^ c[2] ^ c[3] == 0]
CHUNK = 1 << 15


def fingerprint(data: bytes, size: int = 3) -> int:
    """SimHash of a text's bytes: a bit is 1 if set in over half of the shingles' hashes."""
    words = data.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)) if len(words) >= size else [b" ".join(words)]
    n = max(1, len(words) - size + 1)
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), "<u8", n)
    ones = np.zeros(64, "int64")
    for start in range(0, n, CHUNK):
        bits = np.unpackbits(hashes[start : start + CHUNK].view("u1").reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype="uint32")
    return int(np.packbits((2 * ones > n).astype("u1"), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): each row's fingerprint as a signed 64-bit integer."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([fingerprint(x, size) for x in batch.column(1).to_pylist()], "<u8").view("<i8")
        return pa.record_batch([batch.column(0), pa.array(values)], ["doc_id", "fp"])

    rows = id_bytes(df, id_col, text_col)
    return map_slices(rows, one, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp bigint")


def _byte(fp, position: int):
    return F.shiftrightunsigned(fp, 8 * position).bitwiseAND(0xFF)


def postings(distinct: DataFrame) -> DataFrame:
    """(fp, slot, key): each fingerprint under the four bytes of each of BLOCKS."""
    fp = F.col("fp")
    keys = [sum((F.shiftleft(_byte(fp, p), 8 * i) for i, p in enumerate(block)), F.lit(0).cast("long")) for block in BLOCKS]
    posted = [F.struct(F.lit(slot).alias("slot"), key.alias("key")) for slot, key in enumerate(keys)]
    return distinct.select("fp", F.explode(F.array(*posted)).alias("p")).select("fp", "p.slot", "p.key")


def tallies(short: DataFrame, long_list: int = LONG_LIST) -> DataFrame:
    """(a, b, shared), a < b: the positional bytes of all lists (slot, key, fp) that a pair meets in."""
    masks = F.array(*(F.lit(sum(1 << p for p in block)) for block in BLOCKS))
    lists = short.groupBy("slot", "key").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    met = lists.select("slot", "fps", F.posexplode("fps").alias("i", "a")).select("slot", "a", F.explode(F.slice("fps", F.col("i") + 2, F.lit(long_list))).alias("b"))
    return met.groupBy("a", "b").agg(F.bit_count(F.bit_or(F.element_at(masks, F.col("slot") + 1))).alias("shared"))


def links(distinct: DataFrame, long_list: int = LONG_LIST) -> DataFrame:
    """(a, b), a < b: links between distinct fingerprints (column fp), enough to keep every connection.

    Pairs from short lists are all given; long lists give stars.
    """
    posted = stored(postings(distinct))
    lists = stored(posted.groupBy("slot", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    met = stored(spread_join(posted, lists, ["slot", "key"]))
    enough = tallies(met.where(F.col("n") <= long_list), long_list).where(F.col("shared") >= LEAST_BYTES)
    close = enough.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MOST_BITS).select("a", "b")
    # long lists: bits of the four bytes that the list does not fix
    flips = F.array(*(F.array(F.lit(0).cast("long"), *(F.shiftleft(F.lit(1).cast("long"), 8 * p + i) for p in range(8) if p not in block for i in range(8))) for block in BLOCKS))
    spread = met.where(F.col("n") > long_list).select("slot", "fp", F.explode(F.element_at(flips, F.col("slot") + 1)).alias("flip")).select("slot", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("near"))
    near = spread.groupBy("slot", "near").agg(F.sort_array(F.collect_list("fp")).alias("fps")).where(F.size("fps") > 1)
    stars = near.select(F.element_at("fps", 1).alias("a"), F.explode(F.slice("fps", 2, 64)).alias("b"))
    return close.unionByName(stars).distinct()


def _with_least(pairs: DataFrame, rows: int) -> DataFrame:
    """(u, v, m): m is the smallest v of each u. What frequent u's need is broadcast, fewer than twice the partitions."""
    degrees = stored(pairs.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")))
    hot = degrees.where(F.col("n") > hot_limit(pairs.sparkSession, rows)).select("u", "m")
    tagged = pairs.join(F.broadcast(hot), "u", "left")
    cold = tagged.where("m IS NULL").select("u", "v").join(degrees.select("u", "m"), "u")
    return tagged.where("m IS NOT NULL").select("u", "v", "m").unionByName(cold.select("u", "v", "m"))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable from each node of edges (a, b), by alternating star contraction.

    Large star links each node's larger neighbours to its smallest one, small
    star its smaller neighbours; neighbourhoods are aggregated, never gathered.
    """
    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    state = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.col("v").cast("decimal(38,0)")), F.sum(F.hash("u", "v").cast("long"))).first()
    size = state(e)
    for _ in range(most_rounds):
        if not size[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, 2 * size[0]).select("u", "v", F.least("u", "m").alias("m")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large)
        small = _with_least(large, size[0]).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        e = stored(small.where("u > v").distinct())
        now = state(e)
        if now == size:
            break
        size = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_dedup(df: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): component_id is the smallest identifier reachable over links, itself included."""
    docs = stored(fingerprints(df, size, id_col, text_col))
    distinct = stored(docs.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = components(links(distinct.select("fp")))
    rooted = stored(distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root")))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named_fp = stored(spread_join(rooted.select("fp", "root"), named, ["root"]).select("fp", "component_id"))
    return spread_join(docs, named_fp, ["fp"]).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
