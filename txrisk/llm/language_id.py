"""Language identification by a string kernel, Nyström landmarks and ridge regression."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from txrisk.llm.common import Batches, append, emit, keep, texts_of

WORDS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
LONGEST_GRAM = 3
GRAM_BITS = 18
# Characters turned into grams at once, so that a long text needs no long arrays.
SLICE = 1 << 18
# Ids of sampled texts that may be broadcast.
BROADCAST_ROWS = 200_000
# Texts scored in one matrix product.
BLOCK = 64
# Fixed odd multipliers, one per place in a gram.
PLACE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def gram_set(text: str, seen: np.ndarray) -> np.ndarray:
    """Numbers of the distinct 1- to 3-grams of a text's letters, in ascending order.

    Lower case; whatever lies between words counts as one space. ``seen`` is an
    all-false array of ``2**GRAM_BITS`` flags and is left so.
    """
    words = WORDS.findall(text.lower())
    if not words:
        return np.zeros(0, dtype=np.int32)
    codes = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "replace"), dtype=np.uint32)
    for start in range(0, len(codes), SLICE):
        part = codes[start : start + SLICE + LONGEST_GRAM - 1].astype(np.uint64)
        mixed = np.zeros(len(part), dtype=np.uint64)
        for n in range(min(LONGEST_GRAM, len(part))):
            mixed = mixed[: len(part) - n] + part[n:] * PLACE[n]
            spread = (mixed ^ (mixed >> np.uint64(29))) * (PLACE[0] + np.uint64(2 * n))
            seen[spread >> np.uint64(64 - GRAM_BITS)] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found.astype(np.int32)


@dataclass
class KernelModel:
    """Landmark texts as gram sets, and the weight of each landmark for each language.

    ``kernel(x, y) = |x & y| / sqrt(|x| |y|)`` over gram sets.
    """

    languages: list[str] = field(default_factory=list)
    landmarks: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def __post_init__(self):
        # Only grams of landmarks can add to a kernel value.
        grams = np.unique(np.concatenate(self.landmarks)) if self.landmarks else np.zeros(0, dtype=np.int32)
        self.place = np.full(1 << GRAM_BITS, len(grams), dtype=np.int32)
        self.place[grams] = np.arange(len(grams))
        self.columns = np.zeros((len(grams) + 1, len(self.landmarks)), dtype=np.float32)
        for j, grams_of_one in enumerate(self.landmarks):
            self.columns[self.place[grams_of_one], j] = 1 / np.sqrt(max(1, len(grams_of_one)))

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        """Kernel values of many texts with all landmarks, by one matrix product per block."""
        out = np.zeros((len(sets), len(self.landmarks)))
        for start in range(0, len(sets), BLOCK):
            block = sets[start : start + BLOCK]
            present = np.zeros((len(block), len(self.columns)), dtype=np.float32)
            for i, grams in enumerate(block):
                present[i, self.place[grams]] = 1
            present[:, -1] = 0
            sizes = np.sqrt([max(1, len(g)) for g in block])
            out[start : start + len(block)] = (present @ self.columns) / sizes[:, None]
        return out

    def scores(self, sets: list[np.ndarray]) -> np.ndarray:
        return self.kernel(sets) @ self.weights


def fit(sets: list[np.ndarray], labels: list[str], landmarks_per_language: int, ridge: float) -> KernelModel:
    """Ridge regression, one language against the rest, on Nyström features.

    The features of a text are its kernel values with the landmarks times the inverse
    square root of the landmarks' own kernel matrix.
    """
    languages = sorted(set(labels))
    taken: dict[str, int] = {}
    landmarks = []
    for grams, lang in zip(sets, labels, strict=True):
        taken[lang] = taken.get(lang, 0) + 1
        if taken[lang] <= landmarks_per_language:
            landmarks.append(grams)
    model = KernelModel(languages, landmarks, np.zeros((len(landmarks), len(languages))))
    values, vectors = np.linalg.eigh(model.kernel(landmarks))
    good = values > 1e-6 * max(values.max(), 1e-9)
    to_features = vectors[:, good] / np.sqrt(values[good])
    features = model.kernel(sets) @ to_features
    target = np.array([[float(lang == x) for x in languages] for lang in labels])
    # Every language weighs the same, however many of its texts were drawn.
    weight = 1 / target.sum(axis=0)
    row_weight = (target @ weight)[:, None] * len(labels) / len(languages)
    gram = features.T @ (features * row_weight) + ridge * np.eye(features.shape[1])
    model.weights = to_features @ np.linalg.solve(gram, features.T @ (target * row_weight))
    return model


def training_sample(docs: DataFrame, rows: Column, per_language: int) -> DataFrame:
    """At most ``per_language`` rows of each language, ``(text, lang)``, spread evenly by a hash of the id.

    The smallest hash of each of ``per_language`` hash buckets: a map-side combined
    minimum, whatever the size of a language. Of rows that repeat a drawn id one counts, by a hash of the text.
    """
    eligible = docs.where(rows).where("lang is not null and text is not null and doc_id is not null")
    spread = F.xxhash64("doc_id")
    drawn = (
        eligible.groupBy("lang", F.pmod(spread, F.lit(per_language)).alias("bucket"))
        .agg(F.min(F.struct(spread.alias("h"), F.col("doc_id").alias("doc_id"))).alias("m"))
        .select("lang", "bucket", F.col("m.doc_id").alias("doc_id"))
    )
    drawn = keep(drawn, "language-sample")
    # A few hundred rows for each language; more than that only where there are thousands of languages.
    few = drawn.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    sample = eligible.select("doc_id", "lang", "text").join(F.broadcast(drawn) if few else drawn, ["doc_id", "lang"])
    one = F.min_by(F.struct("doc_id", "text"), F.struct(F.xxhash64("text"), F.col("text"))).alias("one")
    return sample.groupBy("lang", "bucket").agg(one).select("one.doc_id", "lang", "one.text")


def fit_languages(
    docs: DataFrame, rows: Column, per_language: int = 256, landmarks_per_language: int = 32, ridge: float = 0.1
) -> KernelModel:
    """Learns from a sample of the ``rows`` of ``docs`` that have a language.

    The bound is ``per_language`` texts of each language; the driver receives their gram
    sets, at most ``2**GRAM_BITS`` numbers each. The number of languages should be that of a labelled set.
    """

    def grams(batches: Batches) -> Batches:
        schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("grams", pa.list_(pa.int32()))])
        seen = np.zeros(1 << GRAM_BITS, dtype=bool)
        for batch in batches:
            sets = [gram_set(t, seen) for t in texts_of(batch.column(2))]
            yield emit(schema, batch.column(0), batch.column(1), pa.array(sets, pa.list_(pa.int32())))

    sample = training_sample(docs, rows, per_language).selectExpr("cast(doc_id as bigint) doc_id", "lang", "text")
    found = sample.mapInArrow(grams, "doc_id long, lang string, grams array<int>").where("size(grams) > 0")
    drawn = found.toArrow()
    lists = drawn["grams"].combine_chunks()
    grams, at = lists.flatten().to_numpy(), lists.offsets.to_numpy()
    at = at - at[0]
    rows = zip(drawn["lang"].to_pylist(), drawn["doc_id"].to_pylist(), range(len(drawn)), strict=True)
    order = sorted(rows, key=lambda r: (r[0], r[1], at[r[2] + 1] - at[r[2]]))
    if not order:
        return KernelModel()
    sets = [grams[at[i] : at[i + 1]] for _, _, i in order]
    return fit(sets, [lang for lang, _, _ in order], landmarks_per_language, ridge)


def predictor(model: KernelModel) -> Callable[[list[str]], tuple[list[str], list[float]]]:
    """From texts to languages and scores."""
    seen = np.zeros(1 << GRAM_BITS, dtype=bool)

    def predict(texts: list[str]) -> tuple[list[str], list[float]]:
        sets = [gram_set(t, seen) for t in texts]
        if not model.languages:
            return [UNKNOWN] * len(sets), [0.0] * len(sets)
        scores = model.scores(sets)
        best = scores.argmax(axis=1)
        top = np.clip(scores[np.arange(len(sets)), best], 0, 1)
        known = [len(s) > 0 for s in sets]
        names = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
        return names, [float(t) if k else 0.0 for t, k in zip(top, known, strict=True)]

    return predict


def identify(docs: DataFrame, model: KernelModel, prefix: str = "") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (after ``prefix``), from the text alone.

    ``und`` with score 0 for a null text, a text without letters, or a model that learned
    nothing; otherwise the language with the highest ridge score, ties to the
    first in alphabetical order, and that score cut to 0..1. All rows and columns stay; choose a
    ``prefix`` that keeps the new names apart from theirs. Map-only; the model is bounded by
    its landmarks.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.landmarks, model.weights))
    fields = f"{prefix}lang_pred string, {prefix}score double"
    return append(docs, fields, lambda: predictor(KernelModel(*shared.value)))
