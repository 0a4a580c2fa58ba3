"""Text quality by regularised quadratic discriminant analysis of document statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from txrisk.llm.common import Batches, emit, texts_of

STATISTICS = [
    "bytes", "words", "bytes_per_word", "upper", "digits", "symbols", "stops", "beyond_ascii",
    "lines", "distinct_words", "repeated_lines", "symbol_ends", "short_words", "line_ends",
]

SPACE, UPPER, DIGIT, SYMBOL, STOP, HIGH = 1, 2, 4, 8, 16, 32


def _byte_classes() -> np.ndarray:
    out = np.zeros(256, dtype=np.uint8)
    out[[9, 10, 11, 12, 13, 32]] = SPACE
    out[ord("A") : ord("Z") + 1] = UPPER
    out[ord("0") : ord("9") + 1] = DIGIT
    out[[b for b in range(33, 127) if not chr(b).isalnum()]] = SYMBOL
    out[[ord("."), ord(",")]] = STOP
    out[128:] = HIGH
    return out


CLASSES = _byte_classes()


def statistics(text: str) -> list[float]:
    """Transformed counts of a whole text; shares under the root, sizes under the logarithm."""
    data = text.encode("utf-8", "replace")
    kinds = CLASSES[np.frombuffer(data, dtype=np.uint8)]
    count = np.bincount(kinds, minlength=33)
    size = max(1, len(data))
    words = data.split()
    n = max(1, len(words))
    lines = [x for x in data.split(b"\n") if x]
    m = max(1, len(lines))
    symbols = kinds == SYMBOL
    space = kinds == SPACE
    ends = int((symbols[:-1] & space[1:]).sum()) + int(len(kinds) > 0 and symbols[-1])
    shares = [
        count[UPPER] / size,
        count[DIGIT] / size,
        count[SYMBOL] / size,
        count[STOP] / size,
        count[HIGH] / size,
        data.count(b"\n") / n,
        len(set(words)) / n,
        1 - len(set(lines)) / m,
        ends / n,
        sum(len(w) < 4 for w in words) / n,
        sum(x.endswith(b".") for x in lines) / m,
    ]
    letters = (len(data) - count[SPACE]) / n
    return [np.log1p(len(data)), np.log1p(len(words)), np.log1p(letters), *np.sqrt(np.maximum(shares, 0.0))]


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, x`` for every row; a null text counts as empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield emit(schema, batch.column(0), [statistics(t) for t in texts_of(batch.column(1))])

    rows = docs.selectExpr("cast(doc_id as bigint) doc_id", "text")
    return rows.mapInArrow(run, "doc_id long, x array<double>")


@dataclass
class Discriminant:
    """Class means, inverted Cholesky factors of the class covariances and log constants."""

    means: np.ndarray  # (2, d)
    whiten: np.ndarray  # (2, d, d)
    constant: np.ndarray  # (2,)
    temperature: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 from the difference of the log densities."""
        density = []
        for mean, whiten, constant in zip(self.means, self.whiten, self.constant, strict=True):
            density.append(constant - 0.5 * (((x - mean) @ whiten.T) ** 2).sum(axis=1))
        return 1 / (1 + np.exp(np.clip((density[0] - density[1]) / self.temperature, -700, 700)))


def class_moments(labelled: DataFrame, size: int) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and sum of outer products of ``x`` for each label, over all rows ``(label, x)``.

    Each batch is reduced to one row per label where it is read.
    """
    schema = pa.schema([("label", pa.int32()), ("m", pa.list_(pa.float64()))])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            label = np.array(batch.column(0).to_pylist())
            x = np.array(batch.column(1).to_pylist(), dtype=float).reshape(-1, size)
            found = np.unique(label)
            moments = []
            for one in found:
                part = x[label == one]
                moments.append(np.concatenate([[len(part)], part.sum(axis=0), (part.T @ part).ravel()]))
            yield emit(schema, found, pa.array(moments, pa.list_(pa.float64())))

    sums = (
        labelled.select(F.col("label").cast("int"), "x")
        .mapInArrow(run, "label int, m array<double>")
        .select("label", F.posexplode("m").alias("i", "v"))
        .groupBy("label", "i")
        .agg(F.sum("v").alias("v"))
    )
    flat: dict[int, np.ndarray] = {}
    for row in sums.collect():  # two labels times 1 + d + d * d numbers
        flat.setdefault(row.label, np.zeros(1 + size + size * size))[row.i] = row.v
    return {k: (v[0], v[1 : size + 1], v[size + 1 :].reshape(size, size)) for k, v in flat.items()}


def fit_discriminant(
    moments: dict[int, tuple[float, np.ndarray, np.ndarray]], shrinkage: float = 0.1, temperature: float = 3.0
) -> Discriminant | None:
    """Covariances shrunk towards the pooled one and its diagonal; None unless both classes occur.

    ``temperature`` divides the log odds: the statistics depend on each other in more
    ways than a normal density knows, which makes it too sure.
    """
    if not all(moments.get(c, (0,))[0] for c in (0, 1)):
        return None
    total = sum(moments[c][0] for c in (0, 1))
    means, covariances = [], []
    for c in (0, 1):
        n, s, outer = moments[c]
        means.append(s / n)
        covariances.append(outer / n - np.outer(s / n, s / n))
    pooled = sum(moments[c][0] * v for c, v in zip((0, 1), covariances, strict=True)) / total
    floor = np.diag(np.diag(pooled) + 1e-6)
    whiten, constant = [], []
    for c, own in zip((0, 1), covariances, strict=True):
        mixed = (1 - 2 * shrinkage) * own + shrinkage * pooled + shrinkage * floor
        factor = np.linalg.cholesky(mixed)
        whiten.append(np.linalg.inv(factor))
        constant.append(np.log(moments[c][0] / total) - np.log(np.diag(factor)).sum())
    return Discriminant(np.array(means), np.array(whiten), np.array(constant), temperature)


def score_quality(features: DataFrame, model: Discriminant | None, fallback: float = 0.5) -> DataFrame:
    """``doc_id, score`` for each row of ``document_statistics``; ``fallback`` without a model."""
    if model is None:
        return features.select("doc_id", F.lit(float(fallback)).alias("score"))
    shared = features.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), dtype=float).reshape(-1, len(STATISTICS))
            yield emit(schema, batch.column(0), shared.value.scores(x))

    return features.mapInArrow(run, "doc_id long, score double")


def quality_scores(features: DataFrame, labels: DataFrame, rows: Column, **options: float) -> DataFrame:
    """Quality of every document, learned from all labelled documents among ``rows``.

    ``features`` is the kept result of ``document_statistics``, ``labels`` has ``doc_id``
    and ``quality`` (0, 1; others and nulls teach nothing; repeated labels count as often as
    they stand). Returns ``doc_id, score`` for every row, empty texts included. If one
    class is missing, every score is the share of class 1, and 0.5 without any label.
    """
    known = labels.select(F.col("doc_id").alias("labelled_id"), F.col("quality").alias("label")).where("label in (0, 1)")
    teach = features.where(rows).join(known, F.col("doc_id") == F.col("labelled_id")).select("label", "x")
    moments = class_moments(teach, len(STATISTICS))
    seen = {c: m[0] for c, m in moments.items()}
    fallback = seen.get(1, 0) / sum(seen.values()) if seen else 0.5
    return score_quality(features, fit_discriminant(moments, **options), fallback)
