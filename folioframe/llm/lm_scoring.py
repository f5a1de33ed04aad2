"""Language-model scores by online logistic context mixing over bits.

Predictors: the last 1 to 4 bytes and the word begun so far are hashed
contexts. Each points, together with the bits of the current byte so far, into
a table of bit counts and gives the logit of the smoothed frequency there. Two
mixers add the logits up with weights that a gate selects: one by the bit's
place, the longest context that was seen and how often it was, one by the bits
so far. Each mixed bit is refined by an adaptive table. The bits of a byte give
its probability under each mixer, and a last weight, the text's own, joins the
two. Minus the sum of the logs over a text and its closing zero byte is its
score; the mixers' bits for a run of bytes are remembered by a worker.

What is learned before scoring covers every training text. Runs of 5 bytes with
their word are counted in each task and summed by a shuffle; the bit counts of
all contexts follow from those sums. The tables' sizes follow the number of
training bytes, up to MOST_BITS of each predictor, which bounds what is
broadcast; counts are kept on a scale that is exact up to 63 and logarithmic
beyond, so none overflows. Weights are learned online: each task goes once
through all its runs, in the order of a hash and in steps of STEP, each bit
leaving its own count out; the tasks' weights are averaged, and a further round
starts from the average. A last pass fills the adaptive tables.

Scoring goes on learning: the last weight starts anew for each text and moves
along it by its gradient, after its first FIRST bytes and each time its length
has doubled, at most LAST bytes later. A score is a function of the model and of
the text alone.

The base score is a smoothed unigram model over words, which stand as 64-bit
hashes (of 10 million words two share one with a chance of 3 in a million).
Words that are at least one in FREQUENT of all are at most FREQUENT in number
and are broadcast as two arrays; the others' counts are joined by a shuffle, on
words that cannot be hot.

Defined results: null or empty text is its end alone (one token, one byte); a
null identifier is learned from and its held_out is null; a long text is read
whole, in segments of SEGMENT bytes at whose borders the begun word is
forgotten; without training rows all counts are zero; repeated rows count and
are scored as often as they occur; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import id_bytes, map_slices, partitions, slices, stored
from ._words import hashed_words, mixed, prefix_hashes

#: Folds, and the one that is held out.
FOLDS, HELD_OUT = 7, 2
#: Stands for a text's end among the words' hashes.
END = 1
#: Words of at least a share of 1 / FREQUENT are broadcast.
FREQUENT = 1_000_000
#: Bytes of the longest context; predictors: one for each length and the word.
ORDERS = 4
INPUTS = ORDERS + 1
#: Bits of a word's hash.
WORD = 24
#: Slots of the predictors' tables as powers of two, at least and at most; slots that a group of the shuffle packs; tasks whose counts are summed at a time.
LEAST_BITS, MOST_BITS, PART_BITS, FAN_IN = 12, (16, 19, 20, 21, 21), 16, 32
BUCKETS = 32
ROUNDS, STEP, RATE = 2, 4096, 5.0
#: Runs that a task looks at in one go; rows that a task sums before it hands them on.
BLOCK, HELD = 16 * STEP, 750_000
#: Gates of the two mixers: place of the bit x longest context seen x how often; the bits so far.
GATES = (8 * INPUTS * 3, 256)
#: Bytes of a text that are looked at together; bytes scored with one state at first and at most.
SEGMENT, FIRST, LAST = 1 << 17, 256, 4096
#: How fast a text's own weight moves, and how far (as a logit); the weight of a mixed bit in its adaptive table.
OWN_RATE, MOST_OWN, PRIOR = 0.02, 4.0, 20.0
#: Entries of a worker's memory of runs.
MEMORY = 1 << 20
_NODE, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype="u1")
_LOWER[65:91] += 32


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD_OUT


# ---- counts on a scale of 8 bits


def level(n: np.ndarray) -> np.ndarray:
    """Counts as 0 to 255: exact up to 63, then four steps to an octave."""
    n = np.asarray(n, "f8")
    return np.where(n < 64, n, np.minimum(255, 64 + np.floor(4 * np.log2(np.maximum(n, 64) / 64)))).astype("u2")


_COUNT = np.concatenate([np.arange(64.0), 64 * 2 ** ((np.arange(192) + 0.5) / 4)])
_ZEROS, _ONES = np.repeat(_COUNT, 256), np.tile(_COUNT, 256)


def _looked_up(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logit, and class of the total (0: not seen), of each pair of levels."""
    return (np.log(ones + 0.1) - np.log(zeros + 0.1)).astype("f4"), np.digitize(zeros + ones, (0.5, 1.5, 7.5)).astype("u1")


LOGIT, SEEN = _looked_up(_ZEROS, _ONES)
#: The same without one count of the bit itself: bit << 16 | levels.
LOGIT_LESS, SEEN_LESS = (np.concatenate(x) for x in zip(_looked_up(np.maximum(_ZEROS - 1, 0), _ONES), _looked_up(_ZEROS, np.maximum(_ONES - 1, 0)), strict=True))


# ---- runs of bytes and their contexts


def segments(data: bytes):
    """(bytes before, bytes) of a text and its closing zero, SEGMENT bytes at a time."""
    data += b"\0"
    for a in range(0, len(data), SEGMENT):
        yield data[max(0, a - ORDERS) : a].rjust(ORDERS, b"\0"), data[a : a + SEGMENT]


def runs(parts: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Of each byte of the segments: ORDERS bytes before it, the byte and a hash of the word begun before it, as one integer; bytes of each segment."""
    data = np.frombuffer(b"".join([x for part in parts for x in part]), "u1")
    value = np.zeros(max(0, len(data) - ORDERS), "u8")
    for i in range(ORDERS + 1):
        value <<= np.uint64(8)
        value |= data[i : len(data) - ORDERS + i]
    value <<= np.uint64(WORD)
    value |= prefix_hashes(_LOWER[data], _LETTER[data])[ORDERS:] >> np.uint64(64 - WORD)
    sizes = np.array([len(x) for _, x in parts], "i8")
    own = np.ones(len(value) + ORDERS, bool)  # not the bytes before a segment
    starts = np.cumsum(sizes + ORDERS) - sizes - ORDERS
    for i in range(ORDERS):
        own[starts + i] = False
    return value[own[ORDERS:]].view("i8"), sizes


class Tables:
    """Where the predictors' slots are: a power of two of them for each."""

    def __init__(self, size: int):
        """size: training bytes."""
        self.bits = [min(most, max(LEAST_BITS, math.ceil(math.log2(max(1, size))))) for most in MOST_BITS]
        self.base = np.cumsum([0, *(1 << b for b in self.bits)])[:-1]
        self.size = sum(1 << b for b in self.bits)

    def places(self, value: np.ndarray):
        """The slots (runs x 8 bits) of each predictor."""
        node = prefixes(value).astype("u8") * _NODE
        for k, bits in enumerate(self.bits):
            context = value & ((1 << WORD) - 1) if k == ORDERS else (value >> (WORD + 8)) & ((1 << 8 * (k + 1)) - 1)
            slots = mixed((context.astype("u8") << np.uint64(3)) + np.uint64(k))[:, None] ^ node
            slots *= _SPREAD
            slots >>= np.uint64(64 - bits)
            slots += np.uint64(self.base[k])
            yield slots.view("i8")


def prefixes(value: np.ndarray) -> np.ndarray:
    """1 and the bits so far, for each bit of each run's byte."""
    return (((value >> WORD) & 255)[:, None] | 256) >> np.arange(8, 0, -1)


def byte_bits(value: np.ndarray) -> np.ndarray:
    return (value[:, None] >> np.arange(WORD + 7, WORD - 1, -1)) & 1


def squash(z):
    return 1 / (1 + np.exp(-np.clip(z, -20, 20)))


def bucket(z: np.ndarray) -> np.ndarray:
    return np.clip((z + 8) * (BUCKETS / 16), 0, BUCKETS - 1).astype("i8")


class Mixer:
    """The model: bit counts as levels, the mixers' weights and their adaptive tables."""

    def __init__(self, tables: Tables, states: np.ndarray, weights: list[np.ndarray] | None = None, refined: np.ndarray | None = None):
        self.tables, self.states = tables, states  # zeros << 8 | ones of each slot
        self.weights = [w.copy() for w in weights] if weights else [np.array([[0.3] * INPUTS + [0]] * g, "f4") for g in GATES]
        self.refined = np.zeros((2, 256, BUCKETS, 2)) if refined is None else refined

    def inputs(self, value: np.ndarray, leave_out: bool = False):
        """The predictors' logits (each runs x 8 bits), the two mixers' gates and the rows of their adaptive tables."""
        less = byte_bits(value) << 16 if leave_out else None
        logit_of, seen_of = (LOGIT_LESS, SEEN_LESS) if leave_out else (LOGIT, SEEN)
        logits, longest, often = [], np.zeros((len(value), 8), "u1"), np.zeros((len(value), 8), "u1")
        for k, slots in enumerate(self.tables.places(value)):
            state = self.states.take(slots).astype("i8")  # the type that indexes need
            if leave_out:
                state += less
            logits.append(logit_of.take(state))
            if k < ORDERS:
                seen = seen_of.take(state)
                there = seen > 0
                if k:
                    there &= longest == k  # a longer context is seen only where the shorter ones are
                longest += there.view("u1")
                np.copyto(often, seen, where=there)
        prefix = prefixes(value)
        gates = [(np.arange(8) * INPUTS + longest) * 3 + np.maximum(often, 1) - 1, prefix]
        return logits, gates, [prefix, np.broadcast_to((value >> (WORD + 8) & 255)[:, None], prefix.shape)]

    def mix(self, logits: list[np.ndarray], gate: np.ndarray, which: int) -> np.ndarray:
        weights = self.weights[which].T.copy()
        z = weights[INPUTS].take(gate)
        for x, w in zip(logits, weights, strict=False):
            z += x * w.take(gate)
        return z

    def learn(self, value: np.ndarray, count: np.ndarray) -> None:
        """Online: a gradient step for each STEP runs, weighted by their counts."""
        for a in range(0, len(value), STEP):
            logits, gates, _ = self.inputs(value[a : a + STEP], leave_out=True)
            bits, weight = byte_bits(value[a : a + STEP]), count[a : a + STEP, None].astype("f8")
            power = (weight * (sum(np.square(x) for x in logits) + 1)).ravel()
            for which, gate in enumerate(gates):
                error = (bits - squash(self.mix(logits, gate, which))) * weight
                flat, n = gate.ravel(), GATES[which]
                total = np.bincount(flat, power, n) + 1e-9
                for j, x in enumerate([*logits, 1.0]):
                    self.weights[which][:, j] += RATE * np.bincount(flat, (error * x).ravel(), n) / total

    def tally(self, value: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Bits met in each cell of the adaptive tables."""
        out = np.zeros(self.refined.size)
        for a in range(0, len(value), STEP):
            v = value[a : a + STEP]
            logits, gates, rows = self.inputs(v, leave_out=True)
            bits, weight = byte_bits(v), np.repeat(count[a : a + STEP].astype("f8"), 8)
            for which in (0, 1):
                cell = (which * 256 + rows[which]) * BUCKETS + bucket(self.mix(logits, gates[which], which))
                out += np.bincount((cell * 2 + bits).ravel(), weight, out.size)
        return out

    def chances(self, value: np.ndarray) -> np.ndarray:
        """The probability of each run's last byte under the two mixers (runs x 2)."""
        out = np.empty((len(value), 2), "f4")
        sure, ones = self.refined.sum(axis=-1).astype("f4"), self.refined[..., 1].astype("f4")
        for a in range(0, len(value), STEP):
            v = value[a : a + STEP]
            logits, gates, rows = self.inputs(v)
            is_one = byte_bits(v).astype(bool)
            for which in (0, 1):
                z = self.mix(logits, gates[which], which)
                p, cell = squash(z), rows[which] * BUCKETS + bucket(z)
                q = (ones[which].ravel().take(cell) + PRIOR * p) / (sure[which].ravel().take(cell) + PRIOR)
                p = np.clip((p + q) / 2, 1e-4, 1 - 1e-4)
                out[a : a + STEP, which] = np.where(is_one, p, 1 - p).prod(axis=1)
        return out


class Scorer:
    """Bits that texts take: many texts go forward together, each with a last weight of its own."""

    def __init__(self, model: Mixer):
        self.model = model
        self.key, self.value = np.full(MEMORY, -1, "i8"), np.zeros((MEMORY, 2), "f4")  # runs met, and their chances

    def chances(self, value: np.ndarray) -> np.ndarray:
        at = (mixed(value.astype("u8")) & np.uint64(MEMORY - 1)).view("i8")
        out = self.value[at]
        miss = np.flatnonzero(self.key[at] != value)
        if len(miss):
            new, inverse = np.unique(value[miss], return_inverse=True)
            found = self.model.chances(new)
            out[miss] = found[inverse]
            slot = (mixed(new.astype("u8")) & np.uint64(MEMORY - 1)).view("i8")
            self.key[slot], self.value[slot] = new, found
        return out

    def bits(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros(len(texts))
        held, size = [], 0
        for i, t in enumerate(texts):
            if len(t) < SEGMENT:
                held.append(i)
                size += len(t) + 1
                if size >= SEGMENT:
                    out[held] = self.together([texts[j] for j in held])
                    held, size = [], 0
            else:
                out[i] = self.alone(t)
        if held:
            out[held] = self.together([texts[j] for j in held])
        return out

    def alone(self, text: bytes) -> float:
        own, total, at = np.zeros(1), 0.0, 0
        for part in segments(text):
            total += self.part([part], own, at)[0]
            at += len(part[1])
        return total

    def together(self, texts: list[bytes]) -> np.ndarray:
        return self.part([next(segments(t)) for t in texts], np.zeros(len(texts)), 0)

    def part(self, parts: list[tuple[bytes, bytes]], own: np.ndarray, at: int) -> np.ndarray:
        """Bits of segments that begin at byte `at` of their texts; own, the logits of the last weights, are carried on."""
        value, sizes = runs(parts)
        chances = self.chances(value)
        starts, total = np.cumsum(sizes) - sizes, np.zeros(len(sizes))
        done, longest = 0, int(sizes.max(initial=0))
        while done < longest:
            step = min(max(FIRST, at + done), LAST)  # the text's bytes so far, within bounds
            lanes = np.flatnonzero(sizes > done)
            n = np.minimum(sizes[lanes] - done, step)
            begin = np.cumsum(n) - n
            rows = np.repeat(starts[lanes] + done - begin, n) + np.arange(int(n.sum()))
            weight = squash(own[lanes])
            w = np.repeat(weight, n)
            first = chances[rows, 0] * w
            both = first + chances[rows, 1] * (1 - w)
            total[lanes] -= np.add.reduceat(np.log2(both), begin)
            # the text's own weight moves on, along its gradient
            own[lanes] = np.clip(own[lanes] + OWN_RATE * (np.add.reduceat(first / both, begin) - weight * n), -MOST_OWN, MOST_OWN)
            done += step
        return total


_scorers: dict[str, Scorer] = {}


def scorer_of(name: str, made) -> Scorer:
    """A worker's scorer of the model of that name: what it remembers outlives the task."""
    if name not in _scorers:
        _scorers.clear()
        _scorers[name] = Scorer(made())
    return _scorers[name]


# ---- training


def _summed(value: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kinds, inverse = np.unique(value, return_inverse=True)
    return kinds, np.bincount(inverse, n, len(kinds)).astype("i8")


def _together(texts: list[bytes], most: int = 4 * SEGMENT):
    """Segments of the texts in lists of about `most` bytes."""
    held, size = [], 0
    for part in (p for t in texts for p in segments(t)):
        held.append(part)
        size += len(part[1])
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def _counted(batches):
    """Counts of runs in a task: (run, n). Those met before are counted in place, the others are sorted."""
    key, count = np.full(MEMORY, -1, "i8"), np.zeros(MEMORY, "i8")
    held, rows = [], 0

    def merged():
        return _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))

    for batch in slices(batches):
        for parts in _together(batch.column("data").to_pylist()):
            value, _ = runs(parts)
            at = (mixed(value.astype("u8")) & np.uint64(MEMORY - 1)).view("i8")
            known = key[at] == value
            count += np.bincount(at[known], minlength=MEMORY)
            new, n = _summed(value[~known], np.ones(len(value) - int(known.sum())))
            slot = (mixed(new.astype("u8")) & np.uint64(MEMORY - 1)).view("i8")
            free = key[slot] < 0
            key[slot[free]] = new[free]
            held.append((new, n))
            rows += len(new)
            if rows > HELD:
                held = [merged()]
                rows = len(held[0][0])
                if rows > HELD // 2:
                    yield pa.record_batch([pa.array(x) for x in held[0]], ["run", "n"])
                    held, rows = [], 0
    some = np.flatnonzero(count)
    held.append((key[some], count[some]))
    yield pa.record_batch([pa.array(x) for x in merged()], ["run", "n"])


def _columns(batches, most: int = BLOCK):
    """Runs and counts of a task in blocks of `most` rows, however they come in batches."""
    held: list[tuple[np.ndarray, ...]] = []
    rows = 0
    for batch in batches:
        held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(2)))
        rows += len(held[-1][0])
        if rows >= most:
            whole = [np.concatenate(x) for x in zip(*held, strict=True)]
            for a in range(0, rows - rows % most, most):
                yield tuple(x[a : a + most] for x in whole)
            rows %= most
            held = [tuple(x[len(x) - rows :] for x in whole)]
    if rows:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


_SLOTS = "part bigint, task bigint, slots binary, zeros binary, ones binary"


def _slot_rows(task: int, part: int, zeros: np.ndarray, ones: np.ndarray) -> pa.RecordBatch:
    """The used slots of a part and their counts."""
    some = np.flatnonzero((zeros > 0) | (ones > 0)).astype("u2")
    columns = [[part], [task], [some.tobytes()], [zeros[some].astype("i8").tobytes()], [ones[some].astype("i8").tobytes()]]
    return pa.record_batch([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), *[pa.binary()] * 3), strict=True)], ["part", "task", "slots", "zeros", "ones"])


def _slot_counts(tables: Tables):
    def count(batches):
        """Bit counts of all contexts of a task's runs, by parts of the tables."""
        counts = np.zeros((2, -(-tables.size >> PART_BITS) << PART_BITS), "f4")  # exact up to 2 ** 24, as levels need no more
        for value, n in _columns(batches):
            weight = np.repeat(n.astype("f8"), 8)
            ones = byte_bits(value).ravel() * weight
            weight -= ones
            for k, slots in enumerate(tables.places(value)):
                base, size = int(tables.base[k]), 1 << tables.bits[k]
                flat = slots.ravel()
                flat -= base
                counts[0, base : base + size] += np.bincount(flat, weight, size)
                counts[1, base : base + size] += np.bincount(flat, ones, size)
        task = TaskContext.get()
        number = task.partitionId() if task else 0
        for part in range(counts.shape[1] >> PART_BITS):
            zeros, ones = counts[:, part << PART_BITS : (part + 1) << PART_BITS]
            if zeros.any() or ones.any():
                yield _slot_rows(number, part, zeros, ones)

    return count


def _part_sums(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    zeros, ones = (np.zeros(1 << PART_BITS, "i8") for _ in range(2))
    for slots, a, b in zip(*(rows[c].to_pylist() for c in ("slots", "zeros", "ones")), strict=True):
        at = np.frombuffer(slots, "u2")
        zeros[at] += np.frombuffer(a, "i8")
        ones[at] += np.frombuffer(b, "i8")
    return zeros, ones


def _summed_part(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    return pa.Table.from_batches([_slot_rows(key[1].as_py(), key[0].as_py(), *_part_sums(rows))])


def _packed(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """The slots of a part as levels, two bytes each."""
    zeros, ones = _part_sums(rows)
    return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([(level(zeros) << 8 | level(ones)).tobytes()], pa.binary())], ["part", "states"])


def train(docs: DataFrame) -> Mixer:
    """The model of all texts of docs (doc_id, data)."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("data").cast("long") + 1)).first()[0] or 0
    tables = Tables(size)
    counted = docs.mapInArrow(_counted, "run bigint, n bigint").groupBy("run").agg(F.sum("n").alias("n"))
    grams = stored(counted.sortWithinPartitions(F.xxhash64("run"), "run"))
    # counts of a part are summed FAN_IN tasks at a time, so that no group grows with the tasks
    tasks = partitions(spark)
    parts = grams.repartition(tasks, F.shiftright("run", WORD + 8)).mapInArrow(_slot_counts(tables), _SLOTS)
    while tasks > FAN_IN:
        parts = parts.groupBy("part", F.floor(F.col("task") / FAN_IN).alias("group")).applyInArrow(_summed_part, _SLOTS)
        tasks = -(-tasks // FAN_IN)
    got = parts.groupBy("part").applyInArrow(_packed, "part bigint, states binary").toArrow()  # two bytes a slot
    states = np.zeros(-(-tables.size >> PART_BITS) << PART_BITS, "u2")
    for part, data in zip(got["part"].to_pylist(), got["states"], strict=True):
        states[part << PART_BITS : (part + 1) << PART_BITS] = np.frombuffer(data.as_py(), "u2")
    del got
    shared = spark.sparkContext.broadcast(states)  # at most 5.8 million slots
    model = Mixer(tables, states)
    shapes = [w.shape for w in model.weights]

    def over_runs(weights, step):
        def go(batches):
            mixer, total, out = Mixer(tables, shared.value, weights), 0.0, None
            for value, n in _columns(batches):
                out = step(mixer, value, n, out)
                total += float(n.sum())
            if out is not None:
                yield pa.record_batch([pa.array([total]), pa.array([out.astype("f8").tolist()], pa.list_(pa.float64()))], ["n", "x"])

        return grams.mapInArrow(go, "n double, x array<double>")

    def learned(mixer, value, n, _):
        mixer.learn(value, n)
        return np.concatenate([w.ravel() for w in mixer.weights])

    def tallied(mixer, value, n, before):
        return mixer.tally(value, n) + (0 if before is None else before)

    def summed_up(df, weighted):
        """Element sums, by tasks first."""
        each = df.select(F.posexplode("x").alias("i", "v"), "n")
        rows = each.groupBy("i").agg(F.sum(F.col("v") * F.col("n") if weighted else F.col("v")).alias("v"), F.sum("n").alias("n")).collect()  # as many as weights or cells
        out = np.zeros(max((r["i"] for r in rows), default=-1) + 1)
        for r in rows:
            out[r["i"]] = r["v"] / r["n"] if weighted else r["v"]
        return out

    for _ in range(ROUNDS):
        if len(w := summed_up(over_runs(model.weights, learned), True)):
            cut = shapes[0][0] * shapes[0][1]
            model.weights = [x.reshape(s).astype("f4") for x, s in zip((w[:cut], w[cut:]), shapes, strict=True)]
    if len(t := summed_up(over_runs(model.weights, tallied), False)):
        model.refined = t.reshape(model.refined.shape)
    model.shared = shared
    return model


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of the texts, lower-cased (A-Z), and its text's position."""
    h, of = hashed_words([t.lower() for t in texts])
    return h.view("i8"), of


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): hashes of the tokens of docs (doc_id, data) and how often they occur; END for the ends."""

    def count(batches):
        held, rows, ends = [], 0, 0
        for batch in slices(batches):
            h, _ = word_hashes(batch.column("data").to_pylist())
            held.append(_summed(h, np.ones(len(h))))
            rows, ends = rows + len(held[-1][0]), ends + len(batch)
            if rows > HELD:
                held = [_summed(*(np.concatenate(x) for x in zip(*held, strict=True)))]
                rows = len(held[0][0])
                if rows > HELD // 2:
                    yield pa.record_batch([pa.array(x) for x in held[0]], ["word", "n"])
                    held, rows = [], 0
        held.append((np.array([END]), np.array([ends])))
        yield pa.record_batch([pa.array(x) for x in _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))], ["word", "n"])

    return docs.mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")


def unigrams(texts: list[bytes], known: np.ndarray, logs: np.ndarray):
    """Words, known words and the sum of their logs for each text; and its other words as a list of (word, n). known rises."""
    h, of = word_hashes(texts)
    at = np.minimum(np.searchsorted(known, h), max(0, len(known) - 1))
    found = known[at] == h if len(known) else np.zeros(len(h), bool)
    gained = np.bincount(of[found], logs[at[found]], len(texts)).astype("f8")
    words, owner = h[~found], of[~found]
    order = np.lexsort((words, owner))
    words, owner = words[order], owner[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(words)), bool), (words[1:] != words[:-1]) | (owner[1:] != owner[:-1])]))
    n = np.diff(np.append(first, len(words)))
    offsets = np.searchsorted(owner[first], np.arange(len(texts) + 1)).astype("i4")
    rare = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(words[first]), pa.array(n.astype("i8"))], ["word", "n"]))
    return np.bincount(of, minlength=len(texts)), np.bincount(of[found], minlength=len(texts)), gained, rare


# ---- scoring


def lm_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes) for every row of df.

    Learns from the rows whose crc32 of the identifier as text, mod FOLDS, is
    not HELD_OUT.
    """
    spark = df.sparkSession
    rows = id_bytes(df, id_col, text_col)
    training = rows.where(~F.coalesce(held_out(), F.lit(False)))
    counts = stored(word_counts(training))
    total, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    common = counts.where(F.col("n") >= max(1, total / FREQUENT)).orderBy("word").toArrow()  # at most FREQUENT rows
    frequent = spark.sparkContext.broadcast((common["word"].to_numpy(), np.log10(common["n"].to_numpy() + 1.0)))
    end = (counts.where(F.col("word") == END).select("n").first() or [0])[0]
    model = train(training)
    shared, tables, weights, refined = model.shared, model.tables, model.weights, model.refined
    name = uuid.uuid4().hex

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        scorer = scorer_of(name, lambda: Mixer(tables, shared.value, weights, refined))
        texts = batch.column("data").to_pylist()
        n_words, n_known, gained, rare = unigrams(texts, *frequent.value)
        return pa.record_batch(
            [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(n_words.astype("i8")), pa.array(n_known.astype("i8")), pa.array(gained), pa.array(-scorer.bits(texts) * math.log10(2)), rare],
            ["doc_id", "n_bytes", "n_words", "n_known", "gained", "score", "rare"],
        )

    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, n_words bigint, n_known bigint, gained double, score double, rare array<struct<word:bigint,n:bigint>>"
    scored = stored(map_slices(rows, score, schema, 4 * SEGMENT).withColumn("row", F.monotonically_increasing_id()))
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", F.col("r.word").alias("word"), F.col("r.n").alias("times"))
    seen = counts.where(F.col("n") < max(1, total / FREQUENT))
    found = rare.join(seen, "word").groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("gain"))
    tokens = F.col("n_words") + 1
    base = F.round(F.col("gained") + F.coalesce("gain", F.lit(0.0)) + math.log10(end + 1) - tokens * math.log10(total + kinds + 1), 9)
    out = scored.drop("rare").join(found, "row", "left")
    return out.select(
        "doc_id", held_out().alias("held_out"), tokens.alias("n_tokens"), (F.col("n_known") + F.coalesce("more", F.lit(0)) + int(end > 0)).alias("n_known"), F.lit(int(total)).cast(T.LongType()).alias("train_tokens"),
        base.alias("base_score"), F.round("score", 6).alias("score"), "n_bytes",
    )
