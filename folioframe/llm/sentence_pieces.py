"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search goes once through a text, piece match by piece match, and keeps a
window of the last places that a longer piece could still reach. A place that
no match crosses is a boundary where all surviving paths converge: what lies
before it is committed as soon as the search is further than the longest piece
behind it. Between two boundaries the paths differ; there the search keeps the
best way to reach each place and a backpointer, and commits whenever the heads
of all paths meet, so that its memory is bounded by the longest piece too.

Two ways to score paths:

- unigram models: the sum of the pieces' scores, the highest wins;
- BPE models: a path survives at a position if its last piece is what the
  merges give after the piece before it. The merges' result is the one path
  whose neighbouring pieces are all stable, and each position has one such
  path, so the result equals the merges'.

The ids of a stretch between two boundaries depend on its characters alone; a
worker remembers those of the last it met, in two generations, so that what is
met again stays.

Defined results: null or empty text gives no ids; characters outside the
vocabulary become byte pieces; decoding gives the text back exactly, as the
model's normaliser is the identity, but for U+2581, which is the model's own
sign for a space and comes back as one; bytes that are no UTF-8 count as
U+FFFD; repeated rows give a row each; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import id_bytes, map_slices

MARK = "▁"
#: Stretches in a generation of a worker's memory; pairs of pieces it remembers; boundaries it holds before it commits.
CACHE, PAIRS, HOLD = 250_000, 500_000, 4096


class Model:
    """Pieces and scores of a model file, and the search over them."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        usable = [i for i in range(n) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in usable}
        self.score = {self.pieces[i]: sp.get_score(i) for i in usable}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.longest = max(map(len, self.ids))
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(sp.serialized_model_proto())
        self.bpe = proto.trainer_spec.model_type == proto.trainer_spec.BPE
        self.worst = min(self.score.values()) - 10  # of a character outside the vocabulary
        self.automaton, self.long = ahocorasick.Automaton(), ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        self.halves: dict[str, list[str]] = {}  # the two parts that a piece's last merge joins
        for piece in self.ids:
            parts = self.merged(piece, 2) if self.bpe else [piece]
            if len(parts) == 1 or len(parts) == 2 and self.merged(piece) == [piece]:
                self.halves[piece] = parts
                self.automaton.add_word(piece, piece)
                if len(piece) > 1:
                    self.long.add_word(piece)
        self.automaton.make_automaton()
        self.long.make_automaton()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.stable: dict[tuple[str, str], bool] = {}
        self.edges: tuple[dict[str, list[tuple[str, float]]], ...] = ({}, {})

    # -- what merges do, for pairs of pieces

    def merged(self, text: str, down_to: int = 1) -> list[str]:
        """The pieces that merging the best-scored neighbours, the leftmost of equals, gives; no fewer than down_to."""
        parts, score = list(text), self.score
        while len(parts) > down_to:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def edge(self, piece: str, side: int) -> list[tuple[str, float]]:
        """What stands at a piece's left (0) or right (1) end while merges build it: each part, and the score of the merge that ends it."""
        got = self.edges[side].get(piece)
        if got is None:
            got, ends, part = [], -np.inf, piece
            while True:
                got.append((part, ends))
                if len(part) == 1:
                    break
                part, ends = self.halves[part][-side], self.score[part]
            got = self.edges[side][piece] = got[::-1]
        return got

    def fits(self, left: str, right: str) -> bool:
        """Whether merging leaves the two pieces side by side as they are.

        Merges go by falling score. Two parts that meet at the border join if
        they make a piece whose turn comes before that of the merges that end
        either of them; of equal turns the leftmost is first.
        """
        got = self.stable.get((left, right))
        if got is None:
            if len(self.stable) > PAIRS:
                self.stable.clear()
            a, b, i, j = self.edge(left, 1), self.edge(right, 0), 0, 0
            while True:
                (x, x_ends), (y, y_ends) = a[i], b[j]
                s = self.score.get(x + y)
                if s is not None and s > x_ends and s >= y_ends:
                    got = False
                    break
                if x_ends == y_ends == -np.inf:
                    got = True
                    break
                if x_ends >= y_ends:
                    i += 1
                else:
                    j += 1
            self.stable[left, right] = got
        return got

    # -- the search

    def stream(self, text: str):
        """Pieces of a text, committed as soon as all paths agree; the automaton gives the pieces that end at each place."""
        bpe, longest = self.bpe, self.longest
        base, last = 0, 0
        back: dict[int, tuple[int, str, float]] = {0: (0, "", 0.0)}  # position: where its last piece begins, the piece, the score
        for end, piece in chain(self.automaton.iter(text), [(len(text), "")]):
            end += 1
            while last < end - 1:  # places behind us that no piece reached: a character of its own
                last += 1
                if last not in back:
                    back[last] = (last - 1, text[last - 1], back[last - 1][2] + self.worst)
            if last - base >= 4 * longest:
                heads = set(range(last - longest + 1, last + 1))  # a later piece can begin there
                while len(heads) > 1:  # back to where they meet
                    far = max(heads)
                    heads.discard(far)
                    heads.add(back[far][0])
                meet = heads.pop()
                if meet > base:
                    yield from self.path(back, base, meet)
                    back = {p: x for p, x in back.items() if p >= meet}
                    base = meet
            if not piece:
                break
            start = end - len(piece)
            if start < base:
                continue
            way = back[start]
            if bpe:
                if end not in back and (not way[1] or self.fits(way[1], piece)):
                    back[end] = (start, piece, 0.0)
            elif end not in back or way[2] + self.score[piece] > back[end][2]:
                back[end] = (start, piece, way[2] + self.score[piece])
        yield from self.path(back, base, len(text))

    @staticmethod
    def path(back, base: int, end: int) -> list[str]:
        out = []
        while end > base:
            start, piece, _ = back[end]
            out.append(piece)
            end = start
        return out[::-1]

    # -- texts

    def stretches(self, text: str):
        """Lists of the stretches between boundaries that no match crosses, committed once none can."""
        begins: list[int] = []  # the character before each stretch's first
        ends: list[int] = []  # the last characters of all stretches but the last
        top, last, done, longest = -1, -1, 0, self.longest
        for end, n in self.long.iter(text) if len(self.long) else ():
            before = end - n
            if before >= top:
                if before < last:  # it crosses nothing but the last stretch
                    last = end
                    continue
            else:  # it joins stretches
                while begins and before < begins[-1]:
                    begins.pop()
                    if ends:
                        last = ends.pop()
                if begins and before < last:
                    top, last = begins[-1], end
                    continue
                if begins:
                    ends.append(last)
                begins.append(before)
                top, last = before, end
                continue
            if begins:
                ends.append(last)
            begins.append(before)
            top, last = before, end
            if len(begins) > HOLD:
                k = len(begins) - 1
                while k and ends[k - 1] > end - longest:
                    k -= 1
                yield self.cut(text, done, begins[:k], ends[:k])
                done = ends[k - 1] + 1 if k else done
                del begins[:k], ends[:k]
        if begins:
            ends.append(last)
        yield [*self.cut(text, done, begins, ends), *text[max(done, last + 1) :]]

    @staticmethod
    def cut(text: str, at: int, begins: list[int], ends: list[int]) -> list[str]:
        out = []
        for a, b in zip(begins, ends, strict=True):
            if at <= a:  # characters that no match holds stand alone
                out.extend(text[at : a + 1])
            at = b + 1
            out.append(text[a + 1 : at])
        return out

    def within(self, stretch: str) -> list[str]:
        """The search of stream() by merges, for a stretch that the window holds whole."""
        best, stable = [""] * (len(stretch) + 1), self.stable  # the last piece of the path to each place; none: its own character
        for end, n in self.long.iter(stretch):
            end += 1
            if not best[end]:
                start = end - n
                piece = stretch[start:end]
                if start:
                    left = best[start] or stretch[start - 1]
                    fits = stable.get((left, piece))
                    if not (self.fits(left, piece) if fits is None else fits):
                        continue
                best[end] = piece
        out, end = [], len(stretch)
        while end:
            piece = best[end] or stretch[end - 1]
            out.append(piece)
            end -= len(piece)
        return out[::-1]

    def searched(self, stretch: str) -> bytes:
        if self.bpe and stretch in self.halves:
            pieces = [stretch]
        else:
            pieces = self.within(stretch) if self.bpe and len(stretch) <= self.longest else [*self.stream(stretch)]
        found = [*map(self.ids.get, pieces)]
        if None in found:  # characters outside the vocabulary: a piece for each byte
            found = [x for i, piece in zip(found, pieces, strict=True) for x in ([i] if i is not None else map(self.bytes.__getitem__, piece.encode()))]
        return array("I", found).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        out = []
        for parts in self.stretches(MARK + text.replace(" ", MARK)):
            if len(self.young) > CACHE:
                self.young, self.old = {}, self.young
            young, old = self.young, self.old
            for x in set(parts).difference(young):
                young[x] = old.get(x) or self.searched(x)
            out.append(b"".join(map(young.__getitem__, parts)))
        return b"".join(out)

    def decode(self, ids) -> str:
        out, held = [], bytearray()
        for i in ids:
            if (b := self.byte_of.get(i)) is not None:
                held.append(b)
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held = bytearray()
            out.append(self.pieces[i])
        out.append(held.decode("utf-8", "replace"))
        text = "".join(out)
        return text.removeprefix(MARK).replace(MARK, " ")


@lru_cache(1)
def loaded(path: str) -> Model:
    """A worker's model: it outlives the task."""
    return Model(path)


def encode_pieces(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): ids of each text as little-endian unsigned 32-bit integers."""

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = loaded(model)
        return pa.record_batch([batch.column(0), pa.array([own.encode(t.decode("utf-8", "replace")) for t in batch.column(1).to_pylist()], pa.binary())], ["doc_id", "ids"])

    rows = id_bytes(df, id_col, text_col)
    return map_slices(rows, encode, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode_pieces(df: DataFrame, model: str) -> DataFrame:
    """(doc_id, ids, text) of (doc_id, ids)."""

    def decode(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = loaded(model)
        texts = [own.decode(np.frombuffer(x, "<u4").tolist()) for x in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    rows = df.selectExpr("doc_id", "ids AS data")
    return map_slices(rows, decode, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, text string")
