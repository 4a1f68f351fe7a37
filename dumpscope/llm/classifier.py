"""Quality classifier: regularised quadratic discriminant over transformed statistics of the whole text.

Each class has a mean and a covariance, which is shrunk towards the pooled covariance and towards a multiple of the identity. A
text's score is the posterior of label 1: the difference of the two Gaussian log-densities, whose Mahalanobis
distances come from Cholesky factors that are computed once, plus the log prior. All labelled training rows are used; what
reaches the driver is one row of sums for each class.

Null and empty texts have statistics of 0 words and are scored like others. Rows that repeat a ``doc_id`` count once each.
Repeated label rows count once, the largest label; null labels and labels without a text are ignored. Where a class has fewer than two
training texts, every score is the smoothed share of label 1. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumpscope.llm.common import bounded_batches, crc_remainder, list_column, runs, written

THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0
#: Weights of the pooled covariance and of the identity in a class covariance.
POOLED, IDENTITY = 0.2, 0.05

_SYMBOLS, _UPPER, _DIGITS = b"#*$%&|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789"
_STOPS, _MARKS, _SPACE = b".?!", b"!\"'()+-/:;=@[\\]^_`{}~", b" \t\n\r\x0b\x0c"
STATISTICS = (
    "words", "word_bytes", "symbols", "capitals", "digits", "stops", "marks", "variety", "echoes", "repeated_lines",
)


def statistics(text: bytes) -> tuple[float, ...]:
    """Counts and shares of a UTF-8 text, in the order of ``STATISTICS``."""
    words = text.split()
    n, size = len(words), max(1, len(text))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    part = lambda chars: (len(text) - len(text.translate(None, chars))) / size
    return (
        n,
        len(text.translate(None, _SPACE)) / max(1, n),
        part(_SYMBOLS),
        part(_UPPER),
        part(_DIGITS),
        part(_STOPS),
        part(_MARKS),
        len(set(words)) / max(1, n),
        sum(map(eq, words, words[1:])) / max(1, n),
        1 - len(set(lines)) / max(1, len(lines)) if lines else 0.0,
    )


def transformed(raw: np.ndarray) -> np.ndarray:
    """Rows of statistics on scales on which classes are closer to Gaussian."""
    out = np.empty_like(raw, float)
    out[:, 0] = np.log1p(raw[:, 0])
    out[:, 1] = np.log1p(raw[:, 1])
    out[:, 2:7] = np.log(raw[:, 2:7] + 0.01)
    # Variety falls with length by itself: take what is left of its logarithm over that of the length.
    out[:, 7] = np.log(raw[:, 7] + 0.01) / np.log(raw[:, 0] + 10)
    out[:, 8:] = np.log(raw[:, 8:] + 0.05)
    return out


def features(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``x``, the transformed statistics."""

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in runs(batches):
            x = transformed(np.array([statistics(t) for t in texts], float))
            lists = list_column(x.ravel(), np.full(len(texts), x.shape[1]), pa.float64())
            yield pa.record_batch([batch.column("doc_id"), lists], names=["doc_id", "x"])

    return bounded_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(compute, "doc_id long, x array<double>")


@dataclasses.dataclass
class Discriminant:
    """Means, inverse Cholesky factors and log-determinants of both classes."""

    share: float
    means: np.ndarray | None = None
    inverses: np.ndarray | None = None
    logdets: np.ndarray | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.share)
        log = [
            -0.5 * (np.square((x - m) @ inv.T).sum(axis=1) + d)
            for m, inv, d in zip(self.means, self.inverses, self.logdets, strict=True)
        ]
        odds = np.clip(log[1] - log[0] + np.log(self.share / (1 - self.share)), -700, 700)
        return 1 / (1 + np.exp(-odds))


def discriminant(sums: dict[int, tuple[int, np.ndarray, np.ndarray]]) -> Discriminant:
    """From the number of rows, sum and sum of outer products of each class."""
    n = [sums[c][0] if c in sums else 0 for c in (0, 1)]
    share = (n[1] + 1) / (sum(n) + 2)
    if min(n) < 2:
        return Discriminant(share)
    means = np.array([sums[c][1] / n[c] for c in (0, 1)])
    scatter = [sums[c][2] - n[c] * np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = sum(scatter) / (sum(n) - 2)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    inverses, logdets = [], []
    for c in (0, 1):
        cov = (1 - POOLED - IDENTITY) * scatter[c] / (n[c] - 1) + POOLED * pooled
        cov += IDENTITY * np.diag(scale**2)
        factor = np.linalg.cholesky(cov)
        inverses.append(np.linalg.inv(factor))
        logdets.append(2 * np.log(np.diag(factor)).sum())
    return Discriminant(share, means, np.array(inverses), np.array(logdets))


def fit(table: DataFrame, labels: DataFrame) -> Discriminant:
    """Learn from the feature rows that have a label and are not held out."""
    d = len(STATISTICS)
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
    known = known.filter("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    train = table.filter(crc_remainder("doc_id", FOLDS) != HELD_OUT).join(known, "doc_id")
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    x = [F.col("x")[i] for i in range(d)]
    sums = [F.sum(v) for v in x] + [F.sum(x[i] * x[j]) for i, j in pairs]
    of = {}
    for row in train.groupBy("quality").agg(F.count("*"), *sums).collect():
        square = np.zeros((d, d))
        for (i, j), v in zip(pairs, row[2 + d :], strict=True):
            square[i, j] = square[j, i] = v
        of[row[0]] = (row[1], np.array(row[2 : 2 + d]), square)
    return discriminant(of)


def scored(table: DataFrame, model: Discriminant) -> DataFrame:
    shared = table.sparkSession.sparkContext.broadcast(model)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            yield pa.record_batch([batch.column("doc_id"), pa.array(shared.value.score(x))], names=["doc_id", "score"])

    return table.mapInArrow(compute, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each document: ``held_out``, ``score`` and ``predicted``."""
    table = written(features(docs), "features")
    out = scored(table, fit(table, labels))
    held, predicted = crc_remainder("doc_id", FOLDS) == HELD_OUT, (F.col("score") >= THRESHOLD).cast("int")
    return out.select("doc_id", held.alias("held_out"), "score", predicted.alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """The documents with a score of ``THRESHOLD`` or more, all columns as given; learnt from ``source``, or else from themselves."""
    # Only statistics meet the labels: a join of the texts would move every text of the source.
    table = written(features(docs if source is None else source), "features")
    shared = docs.sparkSession.sparkContext.broadcast(fit(table, labels))

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in runs(batches):
            score = shared.value.score(transformed(np.array([statistics(t) for t in texts], float)))
            yield batch.filter(pa.array(score >= THRESHOLD))

    return docs.mapInArrow(keep, docs.schema)
