"""Spelling variants: words within one edit, found through a reduced alphabet."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from txrisk.llm.common import Batches, emit, keep, prepare, spans

LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A letter's symbol is its code point modulo this; common letters fall into all classes about evenly.
SYMBOLS = 8
# A reduced word is known by a polynomial of its symbols modulo 2**64; the factor is odd, so it has an inverse.
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)
# Bits of the sieve of reduced words: a fixed size, whatever the vocabulary.
SIEVE_BITS = 1 << 26
# Words of one reduced form that are compared with those of neighbouring forms; more are compared by exact keys.
BUCKET = 64
# Neighbour codes made at once.
CHUNK = 1 << 20


def word_counts(docs: DataFrame, min_length: int, min_count: int, deletion: int | None) -> DataFrame:
    """``word, n`` of the runs of letters in whole texts, A-Z lower-cased.

    With ``deletion`` a run loses one letter if that number divides the CRC-32 of ``<doc_id>:<run>``; the CRC-32
    chooses the letter too. A null doc_id counts as the empty text there.
    """
    # Shorter runs only get shorter; greedy matching takes whole runs.
    runs = F.regexp_extract_all("text", F.lit(f"([{LETTERS}]{{{min_length},}})"), 1)
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(id_text.alias("id"), F.explode(runs).alias("run"))
    rows = rows.select("id", F.translate("run", UPPER, LOWER).alias("word"))
    if deletion is not None:
        rows = rows.withColumn("h", F.crc32(F.encode(F.concat_ws(":", "id", "word"), "UTF-8")))
        at = "int(h % length(word))"
        shorter = F.expr(f"concat(left(word, {at}), substring(word, {at} + 2))")
        rows = rows.withColumn("word", F.when(F.col("h") % deletion == 0, shorter).otherwise(F.col("word")))
        rows = rows.where(F.length("word") >= min_length)
    return rows.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


class Reduced:
    """Reduced words of a batch, by length, as arrays of symbols, and the codes of their neighbours."""

    def __init__(self, symbols: int = SYMBOLS):
        self.symbols = symbols
        self.powers = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> np.ndarray:
        if len(self.powers) < n:
            more = np.full(n, FACTOR, dtype=np.uint64)
            more[0] = 1
            self.powers = np.cumprod(more)
        return self.powers[:n]

    def reduce(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per length: the numbers of its words and their symbols (counted from 1) as a matrix."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        starts = spans(lengths)[:-1]
        for n in np.unique(lengths):
            rows = np.flatnonzero(lengths == n)
            step = max(1, CHUNK // int(n))
            for a in range(0, len(rows), step):
                some = rows[a : a + step]
                yield some, (points[starts[some, None] + np.arange(n)] % self.symbols + 1).astype(np.uint64)

    def codes(self, words: list[str]) -> np.ndarray:
        out = np.zeros(len(words), dtype=np.uint64)
        for rows, symbols in self.reduce(words):
            out[rows] = (symbols * self._powers(symbols.shape[1])).sum(axis=1, dtype=np.uint64)
        return out

    def neighbourhood(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(numbers, codes)`` of the full one-edit neighbourhood of every word's reduced form, itself included."""
        for rows, symbols in self.reduce(words):
            n = symbols.shape[1]
            powers = self._powers(n + 1)
            worth = symbols * powers[:n]
            before = np.zeros((len(rows), n + 1), dtype=np.uint64)
            np.cumsum(worth, axis=1, out=before[:, 1:])
            whole = before[:, -1]
            after = whole[:, None] - before  # what stands at a place or behind it
            yield rows, whole
            factor, inverse = np.uint64(FACTOR), np.uint64(INVERSE)
            yield np.repeat(rows, n), (before[:, :-1] + after[:, 1:] * inverse).ravel()  # deletions
            for symbol in range(1, self.symbols + 1):
                replaced = whole[:, None] + (np.uint64(symbol) - symbols) * powers[:n]
                yield np.repeat(rows, n), replaced.ravel()
                inserted = before + np.uint64(symbol) * powers + after * factor
                yield np.repeat(rows, n + 1), inserted.ravel()


def _sieve_places(codes: np.ndarray) -> np.ndarray:
    """A bit of the sieve for each code."""
    mixed = (codes ^ (codes >> np.uint64(31))) * np.uint64(FACTOR)
    return (mixed >> np.uint64(64 - SIEVE_BITS.bit_length() + 1)).astype(np.int64)


def _with_codes(counts: DataFrame) -> DataFrame:
    """``word, n, code`` and the place of the code's bit in the sieve."""

    def run(batches: Batches) -> Batches:
        reduced = Reduced()
        for batch in batches:
            codes = reduced.codes(batch.column(0).to_pylist())
            bits = pa.array(_sieve_places(codes), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(codes.view(np.int64)), bits], names=["word", "n", "code", "bit"]
            )

    return counts.mapInArrow(run, "word string, n bigint, code bigint, bit bigint")


def _sieve(words: DataFrame) -> bytes:
    """Bits of all reduced words. Tasks and the driver hold no more than its fixed size."""
    byte = F.shiftright("bit", 3).cast("int")
    mask = F.expr("bit_or(shiftleft(1, int(bit & 7)))")
    found = words.groupBy(byte.alias("byte")).agg(mask.cast("int").alias("mask")).toArrow()
    sieve = np.zeros(SIEVE_BITS // 8, dtype=np.uint8)
    sieve[found["byte"].to_numpy()] = found["mask"].to_numpy()
    return sieve.tobytes()


def _neighbours(words: DataFrame) -> DataFrame:
    """``word, n, code, near``: of each word's reduced neighbourhood the codes that the sieve lets through.

    The neighbourhood is symmetric, so of two codes the greater is left to the lesser's word.
    """
    shared = words.sparkSession.sparkContext.broadcast(_sieve(words))
    out = pa.schema([("word", pa.string()), ("n", pa.int64()), ("code", pa.int64()), ("near", pa.int64())])

    def run(batches: Batches) -> Batches:
        reduced = Reduced()
        sieve = np.frombuffer(shared.value, dtype=np.uint8)
        for batch in batches:
            code = batch.column(2).to_numpy()
            rows, near = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for numbers, codes in reduced.neighbourhood(batch.column(0).to_pylist()):
                bit = _sieve_places(codes)
                passed = np.flatnonzero(sieve[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
                numbers, codes = numbers[passed], codes[passed].view(np.int64)
                upper = codes >= code[numbers]
                rows.append(numbers[upper])
                near.append(codes[upper])
            pairs = np.unique(np.stack([np.concatenate(rows), np.concatenate(near)]), axis=1)
            at = pa.array(pairs[0])
            yield emit(out, batch.column(0).take(at), batch.column(1).take(at), batch.column(2).take(at), pairs[1])

    return words.select("word", "n", "code").mapInArrow(run, "word string, n bigint, code bigint, near bigint")


def _exact_pairs(words: DataFrame) -> DataFrame:
    """``a, n_a, b, n_b`` of words one edit apart, by what is left of them without one letter.

    Words that share what is left without their letter at the same place differ by one replacement:
    they are no more than there are letters. So no group grows with the vocabulary.
    """
    places = F.sequence(F.lit(1), F.length("word"))
    gaps = F.transform(
        places,
        lambda i: F.struct(i.alias("place"), F.concat(F.substring("word", F.lit(1), i - 1), F.substring("word", i + 1, F.length("word"))).alias("rest")),
    )
    rest = words.select("word", "n", F.inline(gaps))
    a = rest.select(F.col("word").alias("a"), F.col("n").alias("n_a"), "place", "rest")
    b = rest.select(F.col("word").alias("b"), F.col("n").alias("n_b"), "place", "rest")
    replaced = a.join(b, ["place", "rest"]).where("a < b").select("a", "n_a", "b", "n_b")
    shorter = words.select(F.col("word").alias("b"), F.col("n").alias("n_b"))
    deleted = a.select("a", "n_a", "rest").distinct().join(shorter, F.col("rest") == F.col("b"))
    return replaced.unionByName(deleted.select("a", "n_a", "b", "n_b"))


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, n_a, b, n_b``, each two words one edit apart once; ``words`` has ``word, n, code, bit``, words unique."""
    around = keep(_neighbours(words), "reduced-neighbours")
    crowded = keep(words.groupBy("code").count().where(F.col("count") > BUCKET).select("code"), "crowded-codes")
    hot, near_hot = crowded.select(F.col("code").alias("hot")), crowded.select(F.col("code").alias("near_hot"))
    calm = around.join(hot, F.col("code") == F.col("hot"), "left_anti").join(near_hot, F.col("near") == F.col("near_hot"), "left_anti")
    targets = words.select(F.col("word").alias("b"), F.col("n").alias("n_b"), F.col("code").alias("near"))
    found = calm.join(targets, "near").where(
        ((F.col("code") < F.col("near")) | (F.col("word") < F.col("b"))) & (F.levenshtein("word", "b", 1) == 1)
    )
    found = found.select(F.col("word").alias("a"), F.col("n").alias("n_a"), "b", "n_b")
    # Words of crowded forms with all words around them: those in such forms, those whose neighbourhood holds one,
    # and those that the neighbourhood of one holds.
    beside = around.join(near_hot, F.col("near") == F.col("near_hot"), "left_semi").select("word", "n", "code")
    held = around.join(hot, F.col("code") == F.col("hot"), "left_semi").select("near").distinct()
    beside = beside.union(words.select("word", "n", "code").join(held.withColumnRenamed("near", "code"), "code", "left_semi").select("word", "n", "code"))
    beside = beside.union(words.join(hot, F.col("code") == F.col("hot"), "left_semi").select("word", "n", "code")).distinct()
    marked = beside.join(hot, F.col("code") == F.col("hot"), "left").selectExpr("word", "n", "hot is not null as hot")
    marked = keep(marked, "crowded-words")
    exact = _exact_pairs(marked.select("word", "n"))
    is_hot = marked.where("hot").select(F.col("word").alias("hot_word"))
    either = exact.join(is_hot.withColumnRenamed("hot_word", "a_hot"), F.col("a") == F.col("a_hot"), "left")
    either = either.join(is_hot.withColumnRenamed("hot_word", "b_hot"), F.col("b") == F.col("b_hot"), "left")
    return found.unionByName(either.where("a_hot is not null or b_hot is not null").select("a", "n_a", "b", "n_b"))


def spelling_variants(
    docs: DataFrame, min_length: int = 7, min_count: int = 2, ratio: int = 10, deletion: int | None = None
) -> DataFrame:
    """Words with the far commoner word each may be a variant of: ``word, form, root, n, n_near, form_n``.

    A word is a run of at least ``min_length`` letters that occurs at least ``min_count`` times. Words are near if one
    inserted, deleted or replaced letter makes one of the other. ``form`` is the near word that occurs most
    (of equals the first in code-point order), if it occurs ``ratio`` times as often; ``root`` is where following
    forms ends, the word itself if it has none. Null and empty texts have no words, repeated rows count as often as
    they occur, and an empty table has no words. Other columns play no part. ``deletion``: see ``word_counts``.

    The vocabulary is one row per word after combining on the map side. Candidates come from the full one-edit
    neighbourhoods of words in a reduced alphabet, joined with the reduced vocabulary and verified on the words.
    """
    if min_length < 2 or ratio < 2:
        raise ValueError("words need two letters and forms a ratio of 2 at least")
    prepare(docs.sparkSession)
    counts = keep(word_counts(docs, min_length, min_count, deletion), "word-counts")
    words = keep(_with_codes(counts), "vocabulary")
    pairs = keep(near_pairs(words), "near-words")
    both = pairs.selectExpr("a as word", "n_b as near_n", "b as near").union(pairs.selectExpr("b", "n_a", "a"))
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best")
    )
    joined = words.select("word", "n").join(best, "word", "left")
    commoner = -F.col("best.minus") >= ratio * F.col("n")
    table = keep(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(commoner, F.col("best.near")).alias("form"), F.when(commoner, -F.col("best.minus")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(table, ratio)
    out = table.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(table: DataFrame, ratio: int) -> DataFrame:
    """``word, root`` of the words that have a form, by doubling the steps along forms.

    Each step multiplies the count by ``ratio`` at least, so that the number of steps is known beforehand.
    """
    links = table.where("form is not null").select("word", F.col("form").alias("root"))
    most = table.agg(F.max("n")).first()[0] or 1
    steps, reached = math.floor(math.log(most, ratio)) + 1, 1
    while reached < steps:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = keep(
            links.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots"
        )
        reached *= 2
    return links
