"""Substring deduplication by fixed-block anchors.

With windows of w words, each window holds a whole block of (w + 1) // 2
words that starts at a multiple of that length in its own document. So:

1. every document's non-overlapping blocks are the index, and every rolling
   window of a block's length is a probe; documents are dealt into buckets by
   a hash of identifier and text, as many as hold BUCKET_BYTES of text each,
   and a bucket posts each distinct hash once, whatever the number of
   documents that hold it;
2. where a probe meets an index block of another document, the hit is extended
   to all windows of w words around it, and each bucket posts each distinct
   one once with the smallest identifier that holds it;
3. a window that a smaller identifier holds is repeated; overlapping repeated
   windows join into maximal repeats, whose words go.

Step 1 compares 32-bit hashes within a partition and may let too much through;
step 2 compares 64-bit hashes of the whole window and decides. The text is
shuffled once and read by all three steps.

Defined results: null or empty text has no words and nothing is removed;
identifiers are integers, others are refused; rows with one identifier don't
repeat each other; a null identifier counts as larger than all others; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import partitions
from ._words import hashed_words, window_hashes

WINDOW = 13
#: Bytes of text that a bucket stands for.
BUCKET_BYTES = 6 << 20
LAST = np.iinfo("i8").max


def planes(values: np.ndarray) -> bytes:
    """Rising unsigned integers as differences, byte by byte of each place: shuffles compress it well."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return np.ascontiguousarray(steps.view("u1").reshape(len(values), values.dtype.itemsize).T).tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    steps = np.ascontiguousarray(np.frombuffer(data, "u1").reshape(width, -1).T).view(kind).ravel()
    return np.cumsum(steps, dtype=kind)


class Bucket:
    """A bucket's documents: identifiers, words and their hashes."""

    def __init__(self, rows: pa.Table):
        self.ids = pc.fill_null(rows["doc_id"], int(LAST)).to_numpy().astype("i8")
        self.texts = rows["data"].to_pylist()
        self.words, self.text_of = hashed_words(self.texts)
        self.first = np.searchsorted(self.text_of, np.arange(len(self.ids)))  # each text's first word

    def anchors(self, block: int):
        """Distinct hashes of all runs of a block's length; which are index blocks; each run's place; the runs."""
        h, at = window_hashes(self.words, self.text_of, block)
        distinct, inverse = np.unique(h, return_inverse=True)
        fixed = (at - self.first[self.text_of[at]]) % block == 0
        indexed = np.zeros(len(distinct), bool)
        indexed[inverse[fixed]] = True
        return distinct, indexed, inverse, at

    def shared_inside(self, distinct, indexed, inverse, at) -> np.ndarray:
        """Of the distinct hashes, those that two of this bucket's documents hold, one of them as an index block."""
        doc = self.text_of[at]
        low, high = np.full(len(distinct), len(self.ids)), np.full(len(distinct), -1)
        np.minimum.at(low, inverse, doc)
        np.maximum.at(high, inverse, doc)
        return indexed & (high > low)


def substring_dedup(df: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_words, n_removed, removed, kept_text): removed has the spans [start, end) of words that went. With carry, also data (the text before) and carried (a struct of those columns of the row)."""
    block = (window + 1) // 2
    spark = df.sparkSession
    if not isinstance(df.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"identifiers are integers, not {df.schema[id_col].dataType.simpleString()}")
    size = df.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    n = max(partitions(spark), -(-size // BUCKET_BYTES))
    docs = df.select(
        F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(n)).cast("int").alias("bucket"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"), *([F.struct(*carry).alias("carried")] if carry else [])
    )

    def dealt(bucket: int, h: np.ndarray, *more: np.ndarray) -> list[tuple]:
        """(part, bucket, slices of the arrays) for distinct rising h, dealt by the upper half of the hash."""
        part = (h >> np.uint64(32)) % np.uint64(n)
        order = np.argsort(part, kind="stable")
        parts, starts = np.unique(part[order], return_index=True)
        return [(int(p), bucket, *(x[order[a:b]] for x in (h, *more))) for p, a, b in zip(parts, starts, np.append(starts, len(order))[1:], strict=True)]

    def post_anchors(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        distinct, indexed, _, _ = Bucket(rows).anchors(block)
        out = []
        for p, q, h, own in dealt(key[0].as_py(), distinct, indexed):
            low = h.astype("u4")  # the lower half
            out.append((p, q, planes(np.unique(low[own])), planes(np.unique(low[~own]))))
        return pa.table([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["part", "bucket", "blocks", "probes"])

    def meet_anchors(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        buckets = rows["bucket"].to_pylist()
        blocks, probes = ([from_planes(x, "<u4") for x in rows[c].to_pylist()] for c in ("blocks", "probes"))
        values, owner = np.concatenate(blocks), np.repeat(np.arange(len(blocks)), [len(x) for x in blocks])
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        starts = np.flatnonzero(np.diff(values, prepend=~values[:1])) if len(values) else np.zeros(0, "i8")
        index = values[starts]  # the distinct index hashes
        low, high = (f.reduceat(owner, starts) if len(starts) else starts for f in (np.minimum, np.maximum))
        prober_low, prober_high = np.full(len(index), len(buckets)), np.full(len(index), -1)
        places, found = [], []
        for k, x in enumerate(probes):
            at = np.searchsorted(index, x)
            hit = at < len(index)
            hit[hit] = index[at[hit]] == x[hit]
            at = at[hit]
            places.append((x[hit], at))
            prober_low[at] = np.minimum(prober_low[at], k)
            prober_high[at] = np.maximum(prober_high[at], k)
        asked = np.maximum(high, prober_high) > np.minimum(low, prober_low)  # more than one bucket holds it
        for k, (x, at) in enumerate(places):
            mine = blocks[k]
            b = mine[asked[np.searchsorted(index, mine)]]
            flagged = np.union1d(x[(low[at] != k) | (high[at] != k)], b)
            if len(flagged):
                found.append((buckets[k], key[0].as_py(), planes(flagged.astype("<u4"))))
        return pa.table([pa.array([x[i] for x in found], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary()))], ["bucket", "part", "found"])

    def candidates(bucket: Bucket, found: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and places of the windows around a hit."""
        distinct, indexed, inverse, at = bucket.anchors(block)
        hit = bucket.shared_inside(distinct, indexed, inverse, at)
        code = ((distinct >> np.uint64(32)) % np.uint64(n)) << np.uint64(32) | (distinct & np.uint64(0xFFFFFFFF))
        told = [from_planes(data, "<u4").astype("u8") | np.uint64(p) << np.uint64(32) for p, data in zip(found["part"].to_pylist(), found["found"].to_pylist(), strict=True)]
        hit |= np.isin(code, np.concatenate([np.zeros(0, "u8"), *told]))
        near = np.zeros(len(bucket.words) + 1, "i4")
        np.add.at(near, np.maximum(at[hit[inverse]] - (window - block), 0), 1)  # windows that start from here
        np.add.at(near, at[hit[inverse]] + 1, -1)  # to here hold the hit
        h, begin = window_hashes(bucket.words, bucket.text_of, window)
        chosen = np.cumsum(near)[begin] > 0
        return h[chosen], begin[chosen]

    def post_windows(key: tuple[pa.Scalar, ...], rows: pa.Table, found: pa.Table) -> pa.Table:
        out = []
        if len(rows):
            bucket = Bucket(rows)
            h, begin = candidates(bucket, found)
            distinct, inverse = np.unique(h, return_inverse=True)
            least = np.full(len(distinct), LAST)
            np.minimum.at(least, inverse, bucket.ids[bucket.text_of[begin]])
            for p, q, x, d in dealt(key[0].as_py(), distinct, least):
                ids, place = np.unique(d, return_inverse=True)  # the identifiers that these windows need, no others
                out.append((p, q, planes(x), place.astype("<u4").view("u1").reshape(-1, 4).T.tobytes(), planes(ids.view("u8"))))
        return pa.table([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))], ["part", "bucket", "windows", "holder", "ids"])

    def meet_windows(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        windows = [from_planes(x, "<u8") for x in rows["windows"].to_pylist()]
        holders = []
        for places, ids in zip(rows["holder"].to_pylist(), rows["ids"].to_pylist(), strict=True):
            at = np.ascontiguousarray(np.frombuffer(places, "u1").reshape(4, -1).T).view("<u4").ravel()
            holders.append(from_planes(ids, "<u8").view("i8")[at])
        index, inverse = np.unique(np.concatenate(windows), return_inverse=True)
        least = np.full(len(index), LAST)
        holder = np.concatenate(holders)
        np.minimum.at(least, inverse, holder)
        gone, edges = least[inverse] < holder, np.cumsum([0, *map(len, windows)])
        found = [(q, planes(x[gone[a:b]])) for q, x, a, b in zip(rows["bucket"].to_pylist(), windows, edges, edges[1:], strict=False) if gone[a:b].any()]
        return pa.table([pa.array([x[i] for x in found], t) for i, t in enumerate((pa.int32(), pa.binary()))], ["bucket", "gone"])

    def remove(key: tuple[pa.Scalar, ...], rows: pa.Table, found: pa.Table) -> pa.Table:
        bucket = Bucket(rows)
        # all windows are looked at again: those that some smaller identifier elsewhere holds, or one of this bucket
        h, begin = window_hashes(bucket.words, bucket.text_of, window)
        distinct, inverse = np.unique(h, return_inverse=True)
        least = np.full(len(distinct), LAST)
        doc = bucket.ids[bucket.text_of[begin]]
        np.minimum.at(least, inverse, doc)
        elsewhere = np.isin(distinct, np.concatenate([np.zeros(0, "u8"), *(from_planes(x, "<u8") for x in found["gone"].to_pylist())]))
        repeated = begin[elsewhere[inverse] | (least[inverse] < doc)]
        cover = np.zeros(len(bucket.words) + 1, "i4")
        np.add.at(cover, repeated, 1)
        np.add.at(cover, np.minimum(repeated + window, len(bucket.words)), -1)
        gone = np.cumsum(cover)[:-1] > 0
        counts, removed, spans, kept = [], [], [], []
        last = np.append(bucket.first[1:], len(bucket.words))
        for text, a, b in zip(bucket.texts, bucket.first.tolist(), last.tolist(), strict=True):
            mine = gone[a:b]
            lost = int(mine.sum())
            words = text.split()
            if lost:
                words = compress(words, (~mine).tolist())
                edges = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype("i1"))).reshape(-1, 2)
                spans.append([{"start": s, "end": e} for s, e in edges.tolist()])
            else:
                spans.append([])
            counts.append(b - a)
            removed.append(lost)
            kept.append(b" ".join(words))
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.table([rows["doc_id"], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary()).cast(pa.string(), safe=False), *(rows[c] for c in more)], ["doc_id", "n_words", "n_removed", "removed", "kept_text", *more])

    more = ["data", "carried"] if carry else []
    schema = T.StructType.fromDDL("doc_id bigint, n_words bigint, n_removed bigint, removed array<struct<start:int,end:int>>, kept_text string")
    schema = T.StructType([*schema.fields, *(docs.schema[c] for c in more)])
    dealt_docs = docs.groupBy("bucket")
    anchors = dealt_docs.applyInArrow(post_anchors, "part int, bucket int, blocks binary, probes binary")
    hits = anchors.groupBy("part").applyInArrow(meet_anchors, "bucket int, part int, found binary")
    windows = dealt_docs.cogroup(hits.groupBy("bucket")).applyInArrow(post_windows, "part int, bucket int, windows binary, holder binary, ids binary")
    gone = windows.groupBy("part").applyInArrow(meet_windows, "bucket int, gone binary")
    return dealt_docs.cogroup(gone.groupBy("bucket")).applyInArrow(remove, schema)


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13
), x AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 12], ' ')) AS h FROM s
), m AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) < doc_id AS repeated FROM x
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM m WHERE repeated
), each AS (
  SELECT doc_id, words[j] AS word, j FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS j FROM w)
), kept AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.j) AS t, count(*) AS n FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.j = g.j GROUP BY e.doc_id
)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(len(w.words) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""
