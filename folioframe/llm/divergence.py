"""Divergence of the sources of each language, from exact term counts.

Terms are the runs of ASCII letters and of bytes from 128 on in a text's UTF-8
bytes, A-Z lower-cased. A task joins texts into one buffer; a table of 256
entries lower-cases it and zeroes all other bytes, so that the edges between
zeros and the rest are the terms' boundaries. Each slice is hashed by xxhash,
equal hashes are grouped, and every slice's bytes are compared with those of
its group's first one; slices that differ become groups of their own. A task
sums what it finds and hands on a row for each (language, term, source), with
the documents of each (language, term) in one of them.

A language keeps the terms that at least MIN_DOCS of its documents hold. With
count c of a term in a source, N the source's sum over kept terms and V the
kept terms, p = 1 + floor(10^9 (c + 2) / (N + 2 V)), and two such numbers
differ by f = floor((p - q)^2 / (p + q)). All of it is integer arithmetic.

Most terms occur in few sources, so that pairs are summed sparsely. With
p0 of a source standing for a count of zero, the sum of f over all V terms is

    base(a, b) + base(b, a) + both(a, b) + (V - terms of a - terms of b) f(p0a, p0b)

base(a, b) sums f(pa, p0b) over the terms of a: a CSR matrix holds a source's
distinct p with the number of terms that have it, and reduceat sums its rows
for every b. both(a, b) sums f(pa, pb) - f(pa, p0b) - f(p0a, pb) + f(p0a, p0b)
over the terms that both hold: a CSR matrix of terms by sources is expanded to
the pairs in its rows, PAIRS at a time, and reduceat sums them by pair.

Defined results: null text, language or source counts as an empty one; each
row is a document, repeated ones too; a source without kept terms has pairs; a
language without kept terms has pairs of value 0; one source alone has no
pair; long texts are cut at bytes outside terms and are one document all the
same; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import slices, stored

MIN_DOCS, TOP, SCALE = 10, 10, 1_000_000_000
#: Bytes looked at together, at least; (source, term) entries and bytes of terms that a task sums before it hands them on; pairs expanded at a time.
CHUNK, ENTRIES, TERM_BYTES, PAIRS = 4 << 20, 1 << 20, 32 << 20, 1 << 20
#: Bytes of terms, lower-cased; 0: not in a term.
LETTERS = np.zeros(256, "u1")
LETTERS[[*range(97, 123), *range(128, 256)]] = [*range(97, 123), *range(128, 256)]
LETTERS[65:91] = range(97, 123)

Hash = Callable[[bytes], int]


def boundaries(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the terms of lower-cased bytes start and end."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], data != 0, [False]])))
    return edges[::2], edges[1::2]


def grouped(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, digest: Hash = xxhash.xxh3_64_intdigest) -> tuple[list[bytes], np.ndarray]:
    """The distinct slices, and which of them each slice is. Equal hashes are verified byte by byte."""
    if not len(starts):
        return [], np.zeros(0, "i8")
    buffer = data.tobytes()
    hashes = np.fromiter([digest(buffer[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)], "u8", len(starts))
    _, first, group = np.unique(hashes, return_index=True, return_inverse=True)
    lengths = ends - starts
    differs = lengths != lengths[first[group]]
    same = np.flatnonzero(~differs)
    n = lengths[same]
    begin = np.cumsum(n) - n
    inner = np.arange(int(n.sum())) - np.repeat(begin, n)
    unequal = data[np.repeat(starts[same], n) + inner] != data[np.repeat(starts[first[group[same]]], n) + inner]
    differs[same] = np.logical_or.reduceat(unequal, begin)
    terms = [buffer[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
    others: dict[bytes, int] = {}
    for i in np.flatnonzero(differs).tolist():
        term = buffer[starts[i] : ends[i]]
        group[i] = len(terms) + others.setdefault(term, len(others))
    return [*terms, *others], group


class _Sums:
    """What a task has counted and not yet handed on: occurrences by (source, term), documents by (language, term)."""

    def __init__(self) -> None:
        self.terms: dict[bytes, int] = {}
        self.groups: dict[tuple[str, str], int] = {}
        self.spoken: dict[str, int] = {}
        self.counts: list[tuple[np.ndarray, np.ndarray]] = []
        self.docs: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = self.bytes = 0

    def numbered(self, terms: list[bytes]) -> np.ndarray:
        """The terms' numbers here."""
        before = len(self.terms)
        out = np.array([self.terms.setdefault(t, len(self.terms)) for t in terms], "i8")
        self.bytes += sum(len(t) for t, no in zip(terms, out.tolist(), strict=True) if no >= before)
        return out

    def add(self, group: np.ndarray, lang: np.ndarray, term: np.ndarray, n: np.ndarray, new: np.ndarray) -> None:
        """n occurrences of terms (numbers) in a document of a source; new: whether the document has not been counted for the term."""
        self.counts.append(_totals(group << 32 | term, n))
        self.docs.append(_totals(lang[new] << 32 | term[new], np.ones(int(new.sum()), "i8")))
        self.size += len(self.counts[-1][0])
        if self.size > ENTRIES:
            self._sum()

    def _sum(self) -> None:
        for parts in (self.counts, self.docs):
            parts[:] = [_totals(*(np.concatenate(x) for x in zip(*parts, strict=True)))]
        self.size = len(self.counts[0][0])

    def full(self) -> bool:
        return self.size > ENTRIES or self.bytes > TERM_BYTES

    def rows(self) -> Iterator[pa.RecordBatch]:
        """(lang, term, source, n, docs): a term's documents stand in the first of its language's rows."""
        if self.counts:
            self._sum()
            (entry, n), (held, d) = self.counts[0], self.docs[0]
            terms, groups = pa.array(list(self.terms), pa.binary()), list(self.groups)
            langs, sources = (pa.array([g[i] for g in groups], pa.string()) for i in (0, 1))
            lang_of = np.array([self.spoken[g[0]] for g in groups], "i8")
            docs = np.zeros(len(entry), "i8")
            same, first = np.unique(lang_of[entry >> 32] << 32 | entry & 0xFFFFFFFF, return_index=True)
            docs[first[np.searchsorted(same, held)]] = d
            for i in range(0, len(entry), 1 << 16):
                part = slice(i, i + (1 << 16))
                key, term = entry[part] >> 32, entry[part] & 0xFFFFFFFF
                yield pa.record_batch([langs.take(pa.array(key)), terms.take(pa.array(term)), sources.take(pa.array(key)), pa.array(n[part]), pa.array(docs[part])], ["lang", "term", "source", "n", "docs"])
        self.__init__()


def _totals(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, rising, and the sums of their numbers."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(n[order], first) if len(first) else n[:0]


def _chunks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes lower-cased and zeroed, the text of each byte's term by its end): texts joined, cut outside terms."""
    data = LETTERS[np.frombuffer(b" ".join([*texts, b""]), "u1")]
    ends = np.cumsum([len(t) + 1 for t in texts])
    start = 0
    while start < len(data):
        stop = min(len(data), start + CHUNK)
        while stop < len(data) and data[stop - 1]:
            gap = np.flatnonzero(data[stop : stop + CHUNK] == 0)
            stop = min(len(data), stop + (int(gap[0]) + 1 if len(gap) else CHUNK))
        yield data[start:stop], ends - start
        start = stop


def counted(batches: Iterator[pa.RecordBatch], digest: Hash = xxhash.xxh3_64_intdigest) -> Iterator[pa.RecordBatch]:
    """(lang, term, source, n, docs) of (lang, source, data): occurrences, and the documents that hold the term, which add up over a language's rows."""
    sums = _Sums()
    for batch in slices(batches, most=CHUNK):
        langs, sources, texts = (batch.column(i).to_pylist() for i in range(3))
        group_of = np.array([sums.groups.setdefault(g, len(sums.groups)) for g in zip(langs, sources, strict=True)], "i8")
        lang_of = np.array([sums.spoken.setdefault(x, len(sums.spoken)) for x in langs], "i8")
        met = np.zeros(0, "i8")  # (text, term) of the chunks before, of texts that are cut
        for data, ends in _chunks(texts):
            starts, stops = boundaries(data)
            terms, term_of = grouped(data, starts, stops, digest)
            if not terms:
                continue
            number = sums.numbered(terms)
            pair, n = np.unique(np.searchsorted(ends, starts, "right") << 32 | number[term_of], return_counts=True)
            text, term = pair >> 32, pair & 0xFFFFFFFF
            new = ~np.isin(pair, met, assume_unique=True) if len(met) else np.ones(len(pair), bool)
            sums.add(group_of[text], lang_of[text], term, n, new)
            if len(data) < ends[-1]:  # more follows
                met = np.union1d(met[met >> 32 >= text[-1]], pair[text == text[-1]])
        if sums.full():
            yield from sums.rows()
    yield from sums.rows()


def kept_terms(df: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, n, counts): the kept terms with their count in the language and, as (source, n), in its sources."""
    named = df.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")), F.coalesce("text", F.lit("")).cast("binary").alias("data"))
    found = named.mapInArrow(counted, "lang string, term binary, source string, n bigint, docs bigint")
    summed = found.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = summed.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("counts"))
    return by_term.where(F.col("docs") >= min_docs).select("lang", "term", "n", "counts")


def share(count: str, total: str, terms: str) -> str:
    """SQL of p, by long division: exact for totals up to 9 * 10^15."""
    d, x = f"({total} + 2 * {terms})", f"({count} + 2)"
    step, rest = (lambda x: f"({x} * 1000 DIV {d})"), (lambda x: f"({x} * 1000 % {d})")
    return f"1 + 1000000 * {step(x)} + 1000 * {step(rest(x))} + {step(rest(rest(x)))}"


def apart(p: str, q: str) -> str:
    """SQL of f."""
    return f"(({p} - {q}) * ({p} - {q}) DIV ({p} + {q}))"


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(values, indptr) of a column of lists of numbers."""
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).astype("i8")


def base_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, value): base of each source a, given as CSR rows (a, ps, ns), and each source b of (others, zeros), those of a's language."""
    for batch in batches:
        a = batch.column(0).to_numpy()
        (ps, ptr), (ns, _), (others, to), (zeros, _) = (_lists(batch.column(i)) for i in range(1, 5))
        i = 0
        while i < len(a):  # rows of one language follow one another, or are taken alone
            j = i + 1
            while j < len(a) and np.array_equal(others[to[j] : to[j + 1]], others[to[i] : to[i + 1]]):
                j += 1
            p, n, indptr = ps[ptr[i] : ptr[j]], ns[ptr[i] : ptr[j]], ptr[i:j] - ptr[i]
            for b, zero in zip(others[to[i] : to[i + 1]].tolist(), zeros[to[i] : to[i + 1]].tolist(), strict=True):
                yield pa.record_batch([pa.array(a[i:j]), pa.array(np.full(j - i, b, "i8")), pa.array(np.add.reduceat(n * _f(p, zero), indptr))], ["a", "b", "value"])
            i = j


def pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, value), a < b: both, of CSR rows (ids, ps, zeros), one a term, as sums of each batch."""
    for batch in batches:
        (ids, ptr), (ps, _), (zeros, _) = (_lists(batch.column(i)) for i in range(3))
        sizes = np.diff(ptr)
        row_end = np.repeat(ptr[1:], sizes)
        later = row_end - np.arange(len(ids)) - 1  # entries after each one in its row
        done, total = 0, np.concatenate([[0], np.cumsum(later)])
        summed: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while done < total[-1]:
            pair = np.arange(done, min(done + PAIRS, total[-1]))
            left = np.searchsorted(total, pair, "right") - 1
            right = left + 1 + pair - total[left]
            flip = ids[left] > ids[right]
            left, right = np.where(flip, right, left), np.where(flip, left, right)
            value = _f(ps[left], ps[right]) - _f(ps[left], zeros[right]) - _f(zeros[left], ps[right]) + _f(zeros[left], zeros[right])
            summed.append(_by_pair(ids[left], ids[right], value))
            done += len(pair)
        if summed:
            a, b, value = _by_pair(*(np.concatenate(x) for x in zip(*summed, strict=True)))
            yield pa.record_batch([pa.array(a), pa.array(b), pa.array(value)], ["a", "b", "value"])


def _by_pair(a: np.ndarray, b: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return a[first], b[first], np.add.reduceat(value[order], first)


def source_groups(df: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, id, n, terms, v, lang_n, zero): each occurring source with its sums, written. zero: p of a count of zero, null without kept terms."""
    named = df.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    own = kept.select("lang", F.explode("counts").alias("c")).groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("n"), F.count(F.lit(1)).alias("terms"))
    spoken = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("lang_n"))
    out = named.join(own, ["lang", "source"], "left").join(spoken, "lang", "left").na.fill(0, ["n", "terms", "v", "lang_n"])
    zero = F.when(F.col("v") > 0, F.expr(share("0L", "n", "greatest(v, 1)")))
    return stored(out.withColumn("zero", zero).withColumn("id", F.monotonically_increasing_id()))


def audit(df: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from the others of its language, and its terms that set it off most.

    Columns text, lang and source of df are read. Tables of a row for each
    source are joined by their size: Spark broadcasts small ones only.
    """
    kept = stored(kept_terms(df, min_docs))
    groups = source_groups(df, kept)
    entries = kept.select("lang", "term", F.col("n").alias("total"), F.explode("counts").alias("c")).select("lang", "term", "total", "c.source", F.col("c.n").alias("count"))
    entries = entries.join(groups, ["lang", "source"]).select("lang", "source", "term", "id", "zero", F.expr(share("count", "n", "v")).alias("p"), F.expr(share("total", "lang_n", "v")).alias("q"))
    entries = stored(entries)
    place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = ["lang", "source", "part", "item", "value", "rank"]

    term = entries.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), F.expr(apart("p", "q")).alias("value"))
    term = term.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)

    spoken = groups.where("v > 0").groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("id", "zero"))).alias("all"))
    spoken = spoken.select("lang", F.col("all.id").alias("others"), F.col("all.zero").alias("zeros"))
    held = entries.groupBy("lang", "id", "p").agg(F.count(F.lit(1)).alias("n")).groupBy("lang", "id").agg(F.collect_list(F.struct("p", "n")).alias("held"))
    csr = held.join(spoken, "lang").select("id", F.col("held.p").alias("ps"), F.col("held.n").alias("ns"), "others", "zeros")
    base = csr.mapInArrow(base_sums, "a bigint, b bigint, value bigint").where("a != b")
    rows = entries.groupBy("lang", "term").agg(F.collect_list(F.struct("id", "p", "zero")).alias("row")).where(F.size("row") > 1)
    both = rows.select("row.id", "row.p", "row.zero").mapInArrow(pair_sums, "a bigint, b bigint, value bigint")
    sums = base.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "value").unionByName(both).groupBy("a", "b").agg(F.sum("value").alias("value"))

    one, two = groups.alias("one"), groups.alias("two")
    pairs = one.join(two, (F.col("one.lang") == F.col("two.lang")) & (F.col("one.id") != F.col("two.id")))
    rest = F.expr("(one.v - one.terms - two.terms)") * F.expr(apart("one.zero", "two.zero"))
    pairs = pairs.select("one.lang", "one.source", F.lit("pair").alias("part"), F.col("two.source").alias("item"), F.coalesce(rest, F.lit(0)).alias("rest"), F.least("one.id", "two.id").alias("a"), F.greatest("one.id", "two.id").alias("b"))
    pairs = pairs.join(sums, ["a", "b"], "left").withColumn("value", F.coalesce("value", F.lit(0)) + F.col("rest"))
    pairs = pairs.withColumn("rank", F.row_number().over(place))
    return pairs.select(out).unionByName(term.select(out))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), occurrences AS (
  SELECT row_no, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS MATERIALIZED (
  SELECT lang, term FROM occurrences GROUP BY lang, term HAVING count(DISTINCT row_no) >= 10
), own AS MATERIALIZED (
  SELECT o.lang, o.source, o.term, count(*) AS c FROM occurrences o JOIN kept USING (lang, term) GROUP BY ALL
), v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (
  SELECT g.lang, g.source, coalesce(any_value(v.v), 0) AS v, coalesce(sum(own.c), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN v ON v.lang = g.lang LEFT JOIN own ON own.lang = g.lang AND own.source = g.source
  GROUP BY g.lang, g.source
), p AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(own.c, 0) AS c, 1 + 1000000000::HUGEINT * (coalesce(own.c, 0) + 2) // (g.n + 2 * g.v) AS p
  FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN own ON own.lang = g.lang AND own.source = g.source AND own.term = k.term
), q AS (
  SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(c) + 2) // (sum(sum(c)) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS q
  FROM p GROUP BY lang, term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), out AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, (p.p - q.q) * (p.p - q.q) // (p.p + q.q) FROM p JOIN q USING (lang, term) WHERE p.c > 0 AND p.p > q.q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM out QUALIFY part = 'pair' OR rank <= 10
"""
