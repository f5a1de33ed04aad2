"""Best-fit packing of documents into fixed-length sequences by bin completion.

Documents are tokenised, ended and cut into pieces no longer than a sequence.
Pieces are dealt by a hash into groups of bounded size; in each group a
branch-and-bound search (bin completion) fills one sequence at a time around
the largest piece left: it enumerates undominated fillings by rising waste,
prunes a branch when its waste exceeds what the target count of sequences
allows, and starts from the best-fit-decreasing solution as incumbent.

A filling is dominated if a piece that is left would still fit beside it, or
fits in place of one of its pieces that is shorter, or of two that together are
no longer: what it leaves can then be packed no better than what the other
filling leaves.

The sequences that stay far from full are packed again together with those of
other groups, level by level. Each group hands on its emptiest sequences, and
at most so many pieces that no later group holds more than the first ones do;
when a level saves less than one sequence in LEAST_GAIN, it was the last.

The search of a group is given NODES nodes and NODES_PER_BIN for each bin; when
they are spent, the incumbent stands. No piece depends on that, only how many
sequences hold them.

Defined results: null or empty text gives one piece of the end id; a null
identifier is one like any other; repeated rows are packed as often as they
occur; bytes that are no UTF-8 count as U+FFFD; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import os
from array import array
from bisect import bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import id_bytes, map_slices, stored

END_ID = 1
LENGTH = 4096
#: Pieces in a group; branch-and-bound nodes in a group, and more for each bin; groups packed again together; the share of sequences that a level must save.
GROUP, NODES, NODES_PER_BIN, FAN_IN, LEAST_GAIN = 40_000, 20_000, 4, 256, 64
#: Fillings that a node chooses from; branches that are looked at for each; pieces up to which pairs are tried in the test of dominance.
FILLINGS, TRIES, FEW = 6, 8, 8
#: Words of a generation that a task keeps the ids of.
CACHE = 150_000


class Kept(dict):
    """What a function gave for each key; for a missing one it is called."""

    def __init__(self, function):
        super().__init__()
        self.function = function

    def __missing__(self, key):
        got = self[key] = self.function(key)
        return got


class WordIds:
    """Ids of a text by a tokenizer whose tokens never cross white space: words are encoded once and kept.

    The file has a byte-level BPE whose words end in a marker. Words of ASCII
    and Latin letters are split and merged here, by the same vocabulary as
    ranks with the marker as byte 255, which UTF-8 never has; all other words
    go to the tokenizers library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.known, self.old, self.merges = Tokenizer.from_file(path), Kept(self.word), {}, {}
        printed = sorted(pre_tokenizers.ByteLevel.alphabet())
        plain = [c for c in printed if ord(c) < 256]  # these stand for themselves, the others in order for the rest
        byte_of = {c: ord(c) for c in plain} | dict(zip((c for c in printed if ord(c) >= 256), (b for b in range(256) if chr(b) not in plain), strict=True))
        ranks = {}
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            body = token.removesuffix("</w>")
            ranks[bytes(byte_of[c] for c in body) + b"\xff" * (body != token)] = i
        self.merged = tiktoken.Encoding("words", pat_str=r"[\s\S]", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.simple = regex.compile(r"[\x21-\x3b\x3d-\x7e\u00c0-\u012f\u0131-\u0148\u014a-\u017e]+").fullmatch
        self.parts = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall

    def word(self, word: bytes) -> bytes:
        """Ids of a word that this generation has not met yet."""
        if (got := self.old.get(word)) is not None:
            return got
        text = word.decode("utf-8", "replace")
        if text.isascii() and text.isprintable() and "<|" not in text or self.simple(text):
            core = text.rstrip(".,;:!?")
            parts = [core.lower(), text[len(core) :]] if core.isalpha() else self.parts(text.lower())
            return b"".join(map(self.part, parts))
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def part(self, text: str) -> bytes:
        """Ids of letters, a digit or signs of one kind."""
        got = self.merges.get(text)
        if got is None:
            if len(self.merges) > CACHE:
                self.merges.clear()
            got = self.merges[text] = array("I", self.merged(text.encode() + b"\xff")).tobytes() if text else b""
        return got

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        if len(self.known) > CACHE:  # two generations: what is met again stays
            self.known, self.old = Kept(self.word), self.known
        get = self.known.__getitem__
        return [b"".join(map(get, t.split())) for t in texts]


def tokenised_pieces(df: DataFrame, tokenizer: str, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids): the pieces of each document; ids are little-endian unsigned 32-bit."""
    holder: list[WordIds] = []  # a task's own: idle workers keep nothing
    end = np.array([END_ID], "<u4").tobytes()

    def pieces(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not holder:
            holder.append(WordIds(tokenizer))
        out: tuple[list, ...] = ([], [], [], [], [])
        for doc, ids in zip(batch.column(0).to_pylist(), holder[0].encode(batch.column(1).to_pylist()), strict=True):
            ids += end
            for piece, start in enumerate(range(0, len(ids) // 4, length)):
                part = ids[start * 4 : (start + length) * 4]
                for column, x in zip(out, (doc, piece, start, len(part) // 4, part), strict=True):
                    column.append(x)
        return pa.record_batch([pa.array(x, t) for x, t in zip(out, (kind, pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["doc_id", "piece", "start", "length", "ids"])

    rows = id_bytes(df, id_col, text_col)
    kind = pa.int64() if rows.schema["doc_id"].dataType.simpleString() == "bigint" else pa.string()
    rows = rows if kind == pa.int64() else rows.withColumn("doc_id", F.col("doc_id").cast("string"))
    return map_slices(rows, pieces, f"doc_id {'bigint' if kind == pa.int64() else 'string'}, piece int, start bigint, length bigint, ids binary")


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of positions of lengths, which fall: each goes where the least room is left that takes it."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: some bin has room r
    for i, n in enumerate(lengths):
        fit = rooms >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            k = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[k].append(i)
        else:
            room, k = capacity, len(bins)
            bins.append([i])
        if left := room - n:
            by_room.setdefault(left, []).append(k)
            rooms |= 1 << left
    return bins


def dominated(left: dict[int, int], sizes: list[int], room: int, taken: tuple[int, ...]) -> bool:
    """Whether a length that is left would do better in a filling that leaves `room`: beside it, for a shorter one, or for two together no longer."""

    def free(least: int, most: int) -> bool:
        k = bisect_right(sizes, most) - 1
        while k >= 0 and sizes[k] >= least:
            if left.get(sizes[k], 0) > taken.count(sizes[k]):
                return True
            k -= 1
        return False

    if not room:
        return False  # nothing wastes less
    if free(1, room) or any(free(n + 1, n + room) for n in set(taken)):
        return True
    return len(taken) <= FEW and any(free(n, n + room) for n in {a + b for i, a in enumerate(taken) for b in taken[i + 1 :]})


def fillings(left: dict[int, int], sizes: list[int], room: int, waste: int, most: int = FILLINGS) -> list[tuple[int, tuple[int, ...]]]:
    """Undominated sets of lengths that leave at most `waste` of room, by rising waste; `most` at most, from `most` * TRIES branches."""
    found: list[tuple[int, tuple[int, ...]]] = []
    tries = 0

    def grow(room: int, top: int, taken: tuple[int, ...]) -> bool:
        nonlocal tries
        tries += 1
        k = min(bisect_right(sizes, room), top + 1) - 1
        fits = False
        while k >= 0:
            n = sizes[k]
            if left.get(n, 0) > taken.count(n):
                fits = True
                if grow(room - n, k, (*taken, n)):
                    return True
                if tries > most * TRIES:
                    return bool(found)
            k -= 1
        if not fits and room <= waste and not dominated(left, sizes, room, taken):
            found.append((room, taken))
        return len(found) >= most

    grow(room, len(sizes) - 1, ())
    return sorted(found)


def bin_completion(lengths: list[int], capacity: int, target: int, nodes: int) -> list[list[int]] | None:
    """A packing into at most `target` bins as lists of lengths, or None if none was found within `nodes` nodes."""
    left: dict[int, int] = {}
    for n in lengths:
        left[n] = left.get(n, 0) + 1
    sizes = sorted(left)
    slack = target * capacity - sum(lengths)
    if slack < 0:
        return None
    rest, done, stack = len(lengths), [], []

    def options(slack: int):
        largest = next(n for n in reversed(sizes) if left[n])
        left[largest] -= 1
        got = fillings(left, sizes, capacity - largest, slack)
        left[largest] += 1
        return iter([(w, (largest, *f)) for w, f in got])

    while rest:
        nodes -= 1
        if nodes < 0:
            return None
        if len(stack) == len(done):
            stack.append(options(slack))
        nxt = next(stack[-1], None)
        if nxt is None or nxt[0] > slack:  # no filling wastes little enough: back
            stack.pop()
            if not done:
                return None
            w, f = done.pop()
            slack, rest = slack + w, rest + len(f)
            for n in f:
                left[n] += 1
            continue
        w, f = nxt
        done.append(nxt)
        slack, rest = slack - w, rest - len(f)
        for n in f:
            left[n] -= 1
    return [list(f) for _, f in done]


def pack_lengths(lengths: np.ndarray, capacity: int = LENGTH, nodes: int = NODES) -> list[list[int]]:
    """Bins of positions of lengths (each 1 to capacity)."""
    order = np.argsort(-lengths, kind="stable")
    falling = lengths[order].tolist()
    bins = best_fit_decreasing(falling, capacity)
    least = -(-int(sum(falling)) // capacity)
    for target in range(least, len(bins)):
        if (better := bin_completion(falling, capacity, target, nodes + NODES_PER_BIN * target)) is not None:
            places: dict[int, list[int]] = {}
            for i, n in enumerate(falling):
                places.setdefault(n, []).append(i)
            bins = [[places[n].pop() for n in b] for b in better]
            break
        nodes //= 2
    return [[int(order[i]) for i in b] for b in bins]


def handed_on(bins: list[list[int]], lengths: np.ndarray, capacity: int, most: int) -> set[int]:
    """The bins to pack again, the emptiest first, with at most `most` pieces in all; a bin that is nearly full stays."""
    room = [capacity - int(lengths[b].sum()) for b in bins]
    chosen, pieces = set(), 0
    for k in sorted(range(len(bins)), key=lambda k: -room[k]):
        if room[k] <= capacity // 64 or pieces + len(bins[k]) > most:
            break
        chosen.add(k)
        pieces += len(bins[k])
    return chosen


def pack(pieces: DataFrame, capacity: int = LENGTH, group: int = GROUP, nodes: int = NODES, fan_in: int = FAN_IN) -> DataFrame:
    """Adds sequence_id and offset to pieces, which need doc_id, piece and length (1 to capacity) and may have more columns."""
    own = {"sequence_id", "offset", "_group", "_open"}
    pieces = stored(pieces.select(*(c for c in pieces.columns if c not in own)))
    groups = max(1, -(-pieces.count() // group))
    columns = pieces.columns
    added = [T.StructField(c, t) for c, t in (("sequence_id", T.LongType()), ("offset", T.LongType()), ("_group", T.IntegerType()), ("_open", T.BooleanType()))]
    schema = T.StructType([*pieces.schema.fields, *added])
    fan_in = max(2, min(fan_in, group // 8))
    quota = max(1, group // fan_in)

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        g = int(pdf["_group"].iloc[0])
        pdf = pdf.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        lengths = pdf["length"].to_numpy()
        bin_of, offset, is_open = (np.zeros(len(pdf), "int64") for _ in range(3))
        bins = pack_lengths(lengths, capacity, nodes)
        again = handed_on(bins, lengths, capacity, quota)
        for k, b in enumerate(bins):
            at = np.array(b)
            bin_of[at], offset[at] = k, np.cumsum(lengths[at]) - lengths[at]
            is_open[at] = k in again
        return pdf[columns].assign(sequence_id=bin_of + (g << 32), offset=offset, _group=g, _open=is_open.astype(bool))

    # by the row, not by the identifier, which rows may share
    todo = pieces.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("int"))
    done, level, before = [], 0, None
    while True:
        packed = stored(todo.groupBy("_group").applyInPandas(fill, schema))
        level += 1
        packed = packed.withColumn("sequence_id", F.col("sequence_id") + F.lit(level << 56))
        if before is not None:
            saved = before - packed.select("sequence_id").distinct().count()
        if groups == 1 or before is not None and saved * LEAST_GAIN < before:
            done.append(packed)
            break
        done.append(packed.where("not _open"))
        again = packed.where("_open")
        before = again.select("sequence_id").distinct().count()
        if not before:
            break
        todo = again.select(*columns, (F.col("_group") / fan_in).cast("int").alias("_group"))
        groups = -(-groups // fan_in)
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out.drop("_group", "_open")


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): whole sequences from placed pieces that carry ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts")).select("sequence_id", "length", F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
