"""Quality classifier by positive-unlabelled learning.

A linear model over text statistics is fitted by minimising the non-negative
unbiased risk: with class prior p, positives P and unlabelled U,

    p * R_P(+) + max(0, R_U(-) - p * R_P(-)),

where a step that would push the second part below zero ascends it instead.
Positives are trusted rows labelled 1, the unlabelled rows are all texts
outside the held-out fold, and the prior is the share of 1 among the labelled
training rows. With the squared loss (1 - y z)^2 / 4 of the margin z, every
part of the risk is a quadratic form in the weights, so the sums of x and of
x x' over the rows of P and of U are all that the fit needs: each task sums its
rows, Spark sums the tasks, and no row is left out. The minimiser of the loss
is 2 q - 1 for a positive's probability q; the score is a logistic curve
through q = 0.3 and q = 0.5.

Inputs of a score are the text's bytes alone. Defined results: null text
counts as empty and is scored like any other; rows with a null label don't
teach, nor do rows with a null identifier, whose fold is unknown (held_out is
false); a document with several labels teaches with each; without positives every score is 0.5; repeated rows are
scored each and count as often as they occur; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import id_bytes, map_slices, slices, stored

#: The cut of `predicted`; folds, of which fold 0 is held out.
CUT, FOLDS = 0.3, 5
STEPS, RATE, DECAY = 2000, 0.05, 1e-4
#: The logistic curve's slope: a margin of 2 * 0.3 - 1 scores 0.3.
SLOPE = float(np.log(0.7 / 0.3) / 0.4)

_CLASSES = [
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".", b",", b";:'\"()-?", b"!", b"|", b"#$%&*", b"<>=+_/\\~^`@[]{}", bytes(range(128, 256)), bytes([*range(9), 11, 12, *range(14, 32), 127]),
]
_TABLE = np.zeros((256, len(_CLASSES)))
for _k, _c in enumerate(_CLASSES):
    _TABLE[list(_c), _k] = 1
#: White space, and the signs that few words end in.
_BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_ODD = np.array([c < 128 and not bytes([c]).isalnum() and bytes([c]) not in b".,;:?'\")-" for c in range(256)]) & ~_BLANK


def statistics(data: bytes) -> list[float]:
    """Shares of kinds of bytes, and how words and lines repeat."""
    shares = np.bincount(np.frombuffer(data, "u1"), minlength=256) @ _TABLE / max(1, len(data))
    words = data.split()
    n = max(1, len(words))
    again = sum(map(eq, words, words[1:])) / n
    kinds = len(set(words)) / n
    codes = np.frombuffer(data + b" ", "u1")
    blank = _BLANK[codes]
    odd = int(np.count_nonzero(_ODD[codes[:-1]] & blank[1:])) / n
    upper = sum(map(bytes.isupper, words)) / n
    alone = sum(len(w) == 1 for w in words) / n
    lines = data.split(b"\n")
    return [*shares, again, kinds, kinds * np.sqrt(n) / 20, odd, upper, alone, np.log1p(n) / 10, (len(data) / n) / 20, len(set(lines)) / len(lines)]


def expanded(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.sqrt(x), np.minimum(x, 0.05) * 20, np.minimum(x, 0.25) * 4], axis=1)


@dataclass
class Moments:
    """Rows, and the mean of x and of x x' over them, for x = (1, the expanded statistics)."""

    n: float
    second: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        z = np.concatenate([np.ones((len(x), 1)), expanded(x)], axis=1)
        return cls(len(x), z.T @ z / max(1, len(x)))


@dataclass
class Model:
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (expanded(x) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(SLOPE * (z @ self.weights[1:] + self.weights[0]), -30, 30)))


def fit(positive: Moments, unlabelled: Moments, prior: float, steps: int = STEPS) -> Model:
    """Minimises the non-negative unbiased risk with the squared loss by Adam, from the two classes' moments."""
    mean = unlabelled.second[0, 1:]
    scale = np.sqrt(np.maximum(np.diag(unlabelled.second)[1:] - mean**2, 0)) + 1e-3
    change = np.zeros_like(unlabelled.second)  # x to (1, (x - mean) / scale)
    change[0, 0] = 1
    change[1:, 0] = -mean / scale
    change[1:, 1:] = np.diag(1 / scale)
    p, u = (change @ m.second @ change.T for m in (positive, unlabelled))
    loss = lambda m, w, y: (1 - 2 * y * (m[0] @ w) + w @ m @ w) / 4
    slope = lambda m, w, y: (m @ w - y * m[0]) / 2
    w = np.zeros(len(p))
    w[0] = 2 * prior - 1
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        rest = loss(u, w, -1) - prior * loss(p, w, -1)
        rest_slope = slope(u, w, -1) - prior * slope(p, w, -1)
        grad = -rest_slope if rest < 0 else rest_slope + prior * slope(p, w, 1)
        grad = grad + DECAY * w
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        w = w - RATE / np.sqrt(t) * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return Model(w, mean, scale, prior)


def held_out(id_col: str = "doc_id", folds: int = FOLDS):
    """Whether a row is in the held-out fold; a null identifier is not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of each text, stored."""
    rows = id_bytes(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return stored(map_slices(rows, lambda b: pa.record_batch([b.column(0), pa.array([statistics(x) for x in b.column(1).to_pylist()], pa.list_(pa.float64()))], ["doc_id", "x"]), f"doc_id {kind}, x array<double>"))


def moments(rows: DataFrame) -> Moments:
    """Moments of the statistics in rows (x), each row once: summed by tasks, then by Spark."""
    width = len(expanded(np.zeros((1, len(statistics(b""))))[0:1])[0]) + 1

    def summed(batches):
        n, total = 0, np.zeros((width, width))
        for batch in batches:
            if len(batch):
                m = Moments.of(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1))
                n, total = n + m.n, total + m.second * m.n
        if n:
            yield pa.record_batch([pa.array([n] * width, pa.int64()), pa.array(range(width), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["n", "i", "row"])

    parts = rows.select("x").mapInArrow(summed, "n bigint, i int, row array<double>").select("n", "i", F.posexplode("row").alias("j", "v"))
    got = parts.groupBy("i", "j").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).toArrow()  # width * width rows
    out = np.zeros((width, width))
    out[got["i"].to_numpy(), got["j"].to_numpy()] = got["v"].to_numpy()
    n = float(got["n"][0].as_py()) if len(got) else 0.0
    return Moments(n, out / max(1.0, n))


def train(measured_docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model of measured() texts by labels (doc_id, quality); None without positives."""
    taught = labels.select("doc_id", F.col("quality").alias("q")).where(F.col("q").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    prior = taught.agg(F.avg("q")).first()[0]
    if not prior:
        return None
    positive = moments(measured_docs.join(taught.where("q = 1").select("doc_id"), "doc_id"))
    unlabelled = moments(measured_docs.where(F.col("doc_id").isNotNull() & ~held_out()))
    if not positive.n or not unlabelled.n:
        return None
    return fit(positive, unlabelled, float(np.clip(prior, 0.05, 0.95)))


def scores(model: Model | None, x: np.ndarray) -> np.ndarray:
    return model.score(x) if model else np.full(len(x), 0.5)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs (doc_id, text), by labels (doc_id, quality)."""
    known = measured(docs)
    model = train(known, labels)

    def scored(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            yield pa.record_batch([batch.column(0), pa.array(scores(model, x))], ["doc_id", "score"])

    out = known.mapInArrow(scored, f"doc_id {known.schema['doc_id'].dataType.simpleString()}, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that the classifier does not reject."""
    model = train(measured(docs), labels)
    own = "bytes of the text"

    def good(batches):
        for part in slices(batches, own):
            x = np.array([statistics(t) for t in part.column(part.num_columns - 1).to_pylist()])
            yield part.select(range(part.num_columns - 1)).filter(pa.array(scores(model, x) >= CUT))

    return docs.withColumn(own, F.coalesce("text", F.lit("")).cast("binary")).mapInArrow(good, docs.schema)
