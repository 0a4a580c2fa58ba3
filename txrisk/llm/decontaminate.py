"""Benchmark decontamination by spaced seeds."""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from txrisk.llm.common import Batches, emit, keep, spans, texts_of

WORDS = re.compile(r"\w+")
# Which of the words at consecutive places a seed reads. Found by a greedy search over all masks of 7 in 12, so that
# whatever 2 of 13, 3 of 15, 4 of 20 or 5 of 25 words are changed, some mask at some place reads none of them. That
# covers every stretch of 13 words or more of which 0.8 are the same: one of 13 to 25 words has as many in one of
# these lengths, and a longer one can be halved until it is that short.
MASKS = [
    "110010100111", "101110011001", "010001111101", "101111100010", "100011010111", "111001001101", "111010011010",
    "011110000111", "111111010000",
]
MIN_WORDS = 5
MIN_OVERLAP = 13
SIMILARITY = 0.8
# A first sieve of all positions: of fixed size, so that it may be broadcast. A seed is looked up by its top
# bits, and if they are there, in a second table by the bits below. Beyond
# some millions of seeds it lets more through, and the join behind it does the work.
SIEVE_BITS = 24
SIEVE_TABLES = 2
# Seeds are worked out for this many words at once.
SLICE = 1 << 18


def word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.array(list(map(xxh3_64_intdigest, words)), dtype=np.uint64)


def split_words(text: str) -> list[bytes]:
    """Lower-case words; punctuation and spacing do not count."""
    words = WORDS.findall(text.lower())
    return " ".join(words).encode("utf-8", "replace").split(b" ") if words else []


def seeds(hashes: np.ndarray, mask: str) -> np.ndarray:
    """The seed at each position where the mask fits: a hash of the words that it reads."""
    n = len(hashes) - len(mask) + 1
    if n < 1:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, int(mask, 2) * len(mask), dtype=np.uint64)
    factor = 0x9E3779B97F4A7C15  # each place has an odd factor of its own
    for i, c in enumerate(mask):
        if c == "1":
            out += hashes[i : i + n] * np.uint64(factor)
        factor = factor * 0xC2B2AE3D27D4EB4F % (1 << 64)
    out ^= out >> np.uint64(31)
    out *= np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(29))


def masks_for(n: int, masks: list[str], min_words: int) -> list[str]:
    """Masks to hash an item of ``n`` words with: one without gaps over all of it if it is shorter than the others."""
    span = min(map(len, masks))
    if n >= span:
        return [m for m in masks if len(m) <= n]
    return ["1" * n] if n >= min_words else []


def item_masks(n: int, masks: list[str], min_words: int, similarity: float) -> list[str]:
    """Masks to hash an item of ``n`` words with.

    An item of fewer than ``MIN_OVERLAP`` words brings masks of its own over all of it, one for each choice of the
    words that may differ; its first and last word may not.
    """
    if n < min_words:
        return []
    if n >= MIN_OVERLAP:
        return masks_for(n, masks, min_words)
    free = min(n - 2, int(n * (1 - similarity) + 1e-9))
    gaps = itertools.combinations(range(1, n - 1), max(0, free))
    return ["".join("0" if i in x else "1" for i in range(n)) for x in gaps]


def item_seeds(items: DataFrame, masks: list[str], min_words: int, similarity: float) -> DataFrame:
    """``seed, item_id, at, words`` for every position of every item; ``words`` is the item's length."""
    schema = pa.schema([("seed", pa.int64()), ("item_id", pa.int64()), ("at", pa.int32()), ("words", pa.int32())])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                words = split_words(text)
                hashes = word_hashes(words)
                for mask in item_masks(len(words), masks, min_words, similarity):
                    found = seeds(hashes, mask)
                    n = len(found)
                    yield emit(schema, found.view(np.int64), [item] * n, np.arange(n), [len(words)] * n)

    return items.select("item_id", "text").mapInArrow(run, "seed long, item_id long, at int, words int")


def sieve_bits(seed: np.ndarray, table: int) -> np.ndarray:
    """The bits of the seeds that a table of the sieve is for."""
    return (seed << np.uint64(SIEVE_BITS * table) >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)


def sieve_of(seed_rows: DataFrame) -> np.ndarray:
    """One flag for each value of the seeds' bits, in each table; of fixed size."""
    size = 1 << (SIEVE_BITS - 3)

    def run(batches: Batches) -> Batches:
        flags = np.zeros(SIEVE_TABLES << SIEVE_BITS, dtype=bool)
        for batch in batches:
            for table in range(SIEVE_TABLES):
                flags[(table << SIEVE_BITS) + sieve_bits(batch.column(0).to_numpy().view(np.uint64), table)] = True
        packed = np.packbits(flags)
        at = np.flatnonzero(packed).astype(np.int32)
        schema = pa.schema([("at", pa.int32()), ("bits", pa.int32())])
        yield emit(schema, at, packed[at].astype(np.int32))

    packed = np.zeros(SIEVE_TABLES * size, dtype=np.uint8)
    words = seed_rows.select("seed").mapInArrow(run, "at int, bits int").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    found = words.toArrow()
    packed[found["at"].to_numpy()] = found["bits"].to_numpy()
    return packed.reshape(SIEVE_TABLES, size)


def document_hits(docs: DataFrame, sieve: np.ndarray, masks: list[str]) -> DataFrame:
    """``seed, doc_id, at`` for the positions of all documents that the sieve lets through."""
    shared = docs.sparkSession.sparkContext.broadcast(sieve)
    schema = pa.schema([("seed", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int32())])

    def hits(ids: list[int], lists: list[np.ndarray]) -> Batches:
        """Seeds of many documents at once; those over the end of one do not count."""
        bits, words = shared.value, np.concatenate(lists)
        start = spans(np.array([len(x) for x in lists]))
        for mask in masks:
            for first in range(0, len(words), SLICE):
                s = seeds(words[first : first + SLICE + len(mask) - 1], mask)
                at = np.arange(len(s))
                for table in range(SIEVE_TABLES):
                    top = sieve_bits(s[at], table)
                    at = at[(bits[table][top >> 3] >> (7 - (top & 7)).astype(np.uint8) & 1).astype(bool)]
                doc = np.searchsorted(start, at + first, side="right") - 1
                inside = at + first + len(mask) <= start[doc + 1]
                at, doc = at[inside], doc[inside]
                if len(at):
                    yield emit(schema, s[at].view(np.int64), np.array(ids, dtype=np.int64)[doc], at + first - start[doc])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = texts_of(batch.column(1))
            if texts:
                yield from hits(batch.column(0).to_pylist(), [word_hashes(split_words(t)) for t in texts])

    rows = docs.selectExpr("cast(doc_id as bigint) doc_id", "text").where("doc_id is not null and text is not null")
    return rows.mapInArrow(run, "seed long, doc_id long, at int")


def best_overlap(same: np.ndarray, least: int, similarity: float) -> tuple[int, int] | None:
    """Start and end of the longest stretch of at least ``least`` places, ``similarity`` of which are the same.

    A stretch begins and ends with a place that is the same; the first of equal length counts.
    """
    total = np.concatenate([[0.0], np.cumsum(same - similarity)])
    ends = np.flatnonzero(same) + 1
    best, length = None, max(1, least) - 1
    for start in np.flatnonzero(same):
        if not len(ends) or ends[-1] - start <= length:
            break
        # Not negative: the surplus of agreement from the start to the end.
        good = ends[(ends - start > length) & (total[ends] - total[start] >= -1e-9)]
        if len(good):
            best, length = (int(start), int(good[-1])), int(good[-1] - start)
    return best


def verified(candidates: DataFrame, docs: DataFrame, items: DataFrame, min_overlap: int, similarity: float) -> DataFrame:
    """``doc_id, item_id, start, words, agreement`` of the candidates ``doc_id, item_id, shift`` whose words agree.

    The longest overlap of each document row with each item. A document travels once, with all its candidates.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int32()), ("words", pa.int32()), ("agreement", pa.float64())
    ])

    def words_of(text: str) -> np.ndarray:
        return np.array(split_words(text), dtype=object)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            out = []
            for doc_id, text, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                doc = words_of(text)
                for candidate in found:
                    item, best = words_of(candidate["item_text"]), None
                    for shift in sorted(candidate["shifts"]):
                        # Item words that fall outside the document are words that differ.
                        low, high = max(0, -shift), min(len(item), len(doc) - shift)
                        same = (item[low:high] == doc[low + shift : high + shift]).astype(float)
                        place = best_overlap(same, min(min_overlap, len(item)), similarity)
                        if place and (best is None or place[1] - place[0] > best[1]):
                            start, end = place
                            best = (low + start + shift, end - start, same[start:end].mean())
                    if best:
                        out.append((doc_id, candidate["item_id"], *best))
            yield emit(schema, *zip(*out, strict=True)) if out else pa.RecordBatch.from_pylist([], schema)

    shifts = candidates.groupBy("doc_id", "item_id").agg(F.collect_list("shift").alias("shifts"))
    named = shifts.join(items.select("item_id", F.col("text").alias("item_text")), "item_id")
    by_doc = named.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "item_text", "shifts")).alias("found"))
    whole = docs.selectExpr("cast(doc_id as bigint) doc_id", "text").where("doc_id is not null and text is not null")
    rows = whole.join(by_doc, "doc_id").select("doc_id", "text", "found")
    return rows.mapInArrow(run, "doc_id long, item_id long, start int, words int, agreement double")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: list[str] | None = None,
    min_words: int = MIN_WORDS,
    min_overlap: int = MIN_OVERLAP,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``doc_id, item_id, start, words, agreement``: the best overlap of each document with each item it contains.

    A document contains an item if, from some word on, a stretch of at least ``min_overlap``
    words (all words of a shorter item) agrees with the item in ``similarity`` of its
    places; ``start`` and ``words`` give the stretch in the document's words. Places that
    agree are found through spaced seeds; none is missed with the default masks at
    a similarity of 0.8 and ``min_overlap`` of 13, or more.
    Items of fewer than ``min_words`` words, and null texts and ids on either side, are not searched; an
    item of up to 12 words is searched with masks for every choice of the words that may differ. Equal benchmark texts are searched
    once, under their smallest item_id; repeated documents give one row per doc_id and item.
    """
    masks = masks or MASKS
    items = (
        benchmark.selectExpr("cast(item_id as bigint) item_id", "text")
        .where("item_id is not null and text is not null")
        .groupBy("text")
        .agg(F.min("item_id").alias("item_id"))
    )
    items = keep(items, "benchmark-items")
    found = keep(item_seeds(items, masks, min_words, similarity), "benchmark-seeds")
    # Short items bring masks of their own: the same for all of a length.
    short = found.where(F.col("words") < max(MIN_OVERLAP, min(map(len, masks)))).select("words").distinct().collect()
    own = [m for r in short for m in item_masks(r.words, masks, min_words, similarity)]
    used = list(dict.fromkeys(masks + own))
    hits = document_hits(docs, sieve_of(found), used)
    candidates = (
        hits.alias("d")
        .join(found.alias("i"), "seed")
        .select("d.doc_id", "i.item_id", (F.col("d.at") - F.col("i.at")).alias("shift"))
        .distinct()
    )
    rows = verified(keep(candidates, "seed-hits"), docs, items, min_overlap, similarity)
    best = F.max(F.struct("words", "agreement", (-F.col("start")).alias("s"))).alias("m")
    return rows.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("m.s")).alias("start"), "m.words", "m.agreement"
    )
