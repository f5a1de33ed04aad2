"""Token counts by section, from one encoding of each whole document.

A document is encoded once; its tokens' spans follow from the lengths of their
bytes. Sections are given as spans of characters; tokens are joined to them as
intervals by one merge over both sorted lists. A token that crosses a boundary
goes by an explicit rule:

- start: to the section that holds its first character;
- most: to the section that holds most of its characters, the first of equals;
- share: to each section by its share of the token's characters (fractions).

A character that is cut over several tokens (byte-level tokenizers do that)
belongs to the token that holds its first byte; a token without a character of
its own goes where its first byte's character is.

The query counts each line (with its line break) of each document. Defined
results: null or empty text is one empty section without tokens; repeated rows
give rows each; texts are UTF-8, as Spark's strings are; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._common import id_bytes, map_slices

RULES = ("start", "most", "share")


@lru_cache(1)
def load_ranks(path: str, pattern: str):
    """A tiktoken encoding of a file of ranks, and the bytes of each token; a worker keeps them."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    sizes = np.zeros(max(ranks.values()) + 1, "i8")
    for token, i in ranks.items():
        sizes[i] = len(token)
    return tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes


def token_spans(data: bytes, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[start, end) of each token in characters: those whose first byte it holds."""
    ends = np.cumsum(sizes[ids])
    if data.isascii():
        return ends - sizes[ids], ends
    lead = (np.frombuffer(data, "u1") & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(lead)])  # characters that begin before a byte
    return before[ends - sizes[ids]], before[ends]


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section; bounds: the sections' rising ends, the last the text's length.

    A token that begins no character counts where the character before its start ends.
    """
    n = len(bounds)
    empty = ends == starts
    first = np.minimum(np.searchsorted(bounds, np.where(empty, np.maximum(starts - 1, 0), starts), "right"), n - 1)
    if rule == "start" or not len(starts):
        return np.bincount(first, minlength=n).astype("f8")
    last = np.minimum(np.searchsorted(bounds, np.where(empty, np.maximum(starts - 1, 0), ends - 1), "right"), n - 1)
    whole = first == last
    out = np.bincount(first[whole], minlength=n).astype("f8")
    for a, b, s, e in zip(first[~whole].tolist(), last[~whole].tolist(), starts[~whole].tolist(), ends[~whole].tolist(), strict=True):
        edges = np.concatenate([[s], bounds[a:b], [e]])
        parts = np.diff(edges)
        if rule == "share":
            out[a : b + 1] += parts / (e - s)
        else:
            out[a + int(parts.argmax())] += 1
    return out


def lines(data: bytes) -> np.ndarray:
    """Ends, in characters, of the lines of a text, each with its line break; the last line may be empty."""
    raw = np.frombuffer(data, "u1")
    breaks = np.flatnonzero(raw == 10) + 1
    ends = np.append(breaks, len(data))
    if data.isascii():
        return ends
    return np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[ends]


def section_counts(df: DataFrame, ranks: str, pattern: str, rule: str = "start", sections=lines, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, section, start, end, n_tokens, n_document): tokens of each section and of its whole document.

    sections gives the ends of a text's sections in characters from its bytes.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoding, sizes = load_ranks(ranks, pattern)
        owner, number, bounds, counts, totals = [], [], [], [], []
        for k, data in enumerate(batch.column(1).to_pylist()):
            ids = encoding.encode_to_numpy(data.decode("utf-8", "replace"), disallowed_special=())
            ends = sections(data)
            got = attribute(*token_spans(data, ids, sizes), ends, rule)
            owner.append(np.full(len(ends), k))
            number.append(np.arange(len(ends)))
            bounds.append(np.stack([np.concatenate([[0], ends[:-1]]), ends]))
            counts.append(got)
            totals.append(np.full(len(ends), len(ids)))
        at = np.concatenate(owner)
        span = np.concatenate(bounds, axis=1)
        return pa.record_batch([batch.column(0).take(pa.array(at)), pa.array(np.concatenate(number).astype("i4")), pa.array(span[0]), pa.array(span[1]), pa.array(np.concatenate(counts)), pa.array(np.concatenate(totals).astype("i8"))], ["doc_id", "section", "start", "end", "n_tokens", "n_document"])

    rows = id_bytes(df, id_col, text_col)
    return map_slices(rows, count, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, section int, start bigint, end bigint, n_tokens double, n_document bigint")
