"""Substring dedup of paragraphs: MinHash bands, exact Jaccard, components.

A paragraph is a line. A passage that lies within longer lines makes them no similar
lines, so passages are also found on their own, as paragraphs without fixed ends: by
blocks of words at places that the words themselves choose.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from txrisk.llm.common import Batches, components, discard, emit, keep, spans, texts_of

SHINGLE = 5
SIMILARITY = 0.8
# A pair at the threshold shares a band with probability 1 - (1 - 0.8 ** 4) ** 10 = 0.995.
BANDS = 10
ROWS = 4
# Paragraphs of a band value up to which all pairs of different components are compared one by one.
CROWD = 32
# Beyond, so many at a time by matrix products over so many shingles.
BLOCK = 256
COLUMNS = 1 << 14
# A passage is found by a block of so many words, at the smallest block hash of each so many
# consecutive places: whatever surrounds it, a passage of BLOCK_WORDS + PLACES - 1 = 25 words
# has one of its own blocks chosen in every document. Documents that share one are compared.
BLOCK_WORDS = 10
PLACES = 16
PASSAGE = BLOCK_WORDS + PLACES - 1
# Words that a passage must have in common with an earlier document.
LEAST = PASSAGE
# In a passage a changed word weighs as much as so many equal ones (a similarity of 0.8); at most so many follow one another.
DIFFERENT = 4
GAP = 5
# Words (of whole texts) that are hashed at once, shingles that are signed at once, and runs that are compared at once.
SLICE = 1 << 16
SIGNED = 1 << 14
COMPARED = 1 << 14
SEED = 20240607


# What lies between the spaces that part the bytes of a text.
WORD = re.compile(r"[^ \t\n\r\x0b\x0c]+")


def paragraphs_of(text: str) -> list[str]:
    """The lines of a text; the line ends part them."""
    return text.split("\n")


def word_list(paragraph: str) -> list[bytes]:
    """The words of a line, or those of all lines: a line end parts words, and no letter's lower case depends on what lies behind one."""
    return paragraph.lower().encode("utf-8", "replace").split()


def word_lines(text: str) -> list[list[bytes]]:
    """``word_list`` of each line."""
    return [line.split() for line in text.lower().encode("utf-8", "replace").split(b"\n")]


def word_hashes(words: Iterable[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_digest

    return np.frombuffer(b"".join(map(xxh3_64_digest, words)), dtype=">u8").astype(np.uint64)


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words, from hashes of the words."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        out = (out ^ (out >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    return (out ^ (out >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)


def long_run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Like ``run_hashes``, other values: a run's hash is made from those of its first and of its last words, half as many or more."""

    def mixed(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        return (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)

    if len(words) < size:
        return words[:0]
    out, n = mixed(words + np.uint64(1)), 1
    while n < size:
        step = min(n, size - n)
        out, n = mixed((out[:-step] ^ (out[:-step] >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + out[step:]), n + step
    return out


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    return run_hashes(word_hashes(words), SHINGLE)


def extremes(values: np.ndarray, size: int, pick: np.ufunc) -> np.ndarray:
    """The smallest (or largest) of each ``size`` consecutive values, from those of half as many."""
    n = 1
    while n < size:
        step = min(n, size - n)
        values, n = pick(values[:-step], values[step:]), n + step
    return values


def chosen_places(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Block hashes, and the places of those that are the smallest of some ``PLACES`` consecutive ones of a text.

    ``words`` are the texts' words one after another, ``sizes`` the number of each text's words.
    """
    blocks = run_hashes(words, BLOCK_WORDS)
    n = len(blocks) - PLACES + 1
    if n < 1:
        return blocks, np.zeros(0, dtype=np.int64)
    lowest = extremes(blocks, PLACES, np.minimum)
    # Not those that reach into the next text.
    lowest[np.arange(n) + PASSAGE > np.repeat(np.cumsum(sizes), sizes)[:n]] = 0
    # A block is the smallest of a window if the largest of the minima of its windows is its own hash.
    edge = np.zeros(PLACES - 1, dtype=np.uint64)
    around = extremes(np.concatenate([edge, lowest, edge]), PLACES, np.maximum)
    return blocks, np.flatnonzero(around == blocks)


def chosen_blocks(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first words of the chosen blocks of one text; each hash once."""
    blocks, at = chosen_places(words, np.array([len(words)]))
    found, first = np.unique(blocks[at], return_index=True)
    return found, at[first]


class Signer:
    """MinHash bands of many shingle lists at once."""

    def __init__(self, bands: int, rows: int):
        random = np.random.default_rng(SEED)
        self.bands, self.rows = bands, rows
        self.factor = random.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.offset = random.integers(0, 1 << 63, bands * rows, dtype=np.uint64)

    def sign(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One 64-bit value per list and band. No list is empty."""
        out = np.zeros((len(starts), self.bands), dtype=np.uint64)
        ends = np.append(starts[1:], len(hashes))
        first = 0
        while first < len(starts):  # so many lists that their shingles stay in the processor's cache
            last = max(first + 1, int(np.searchsorted(ends, starts[first] + SIGNED, side="right")))
            part = hashes[starts[first] : ends[last - 1]]
            out[first:last] = self.sign_part(part, starts[first:last] - starts[first])
            first = last
        return out

    def sign_part(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        out = np.zeros((len(starts), self.bands), dtype=np.uint64)
        mixed = np.empty_like(hashes)
        for band in range(self.bands):
            value = np.full(len(starts), band + 1, dtype=np.uint64)
            for i in range(band * self.rows, (band + 1) * self.rows):
                np.multiply(hashes, self.factor[i], out=mixed)
                np.add(mixed, self.offset[i], out=mixed)
                low = np.minimum.reduceat(mixed, starts) >> np.uint64(20)
                value = (value ^ (value >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + low
            out[:, band] = (value ^ (value >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
        return out


def paragraph_table(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """``doc_id, par, pid, p, bands, h`` for every paragraph of at least five words and every chosen block.

    ``pid`` is a 128-bit hash of the paragraph's lower-case words, ``p`` half of it. ``bands`` is null
    where the task has met the paragraph before. Blocks have a null ``pid``; ``par`` is the
    number of a line, or of a block's first word, and ``h`` a block's hash.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("par", pa.int32()), ("pid", pa.string()), ("p", pa.int64()), ("bands", pa.list_(pa.int64())),
        ("h", pa.int64()),
    ])

    def run(batches: Batches) -> Batches:
        from xxhash import xxh3_128_digest

        signer, met = Signer(bands, rows), set()

        def tables(docs: list[int], texts: list[list[list[bytes]]]) -> Batches:
            lines = list(chain.from_iterable(texts))
            sizes, numbers = np.fromiter(map(len, lines), np.int64, len(lines)), np.fromiter(map(len, texts), np.int64, len(texts))
            starts, of_text = spans(sizes), spans(numbers)
            hashes = word_hashes(chain.from_iterable(lines))
            in_text = np.diff(starts[of_text])  # words by text
            ids = np.array(docs, dtype=np.int64)
            at = np.flatnonzero(sizes >= SHINGLE)
            if len(at):
                digests = [xxh3_128_digest(b" ".join(lines[i])) for i in at.tolist()]
                new = np.zeros(len(at), dtype=bool)
                for i, digest in enumerate(digests):
                    if digest not in met:
                        met.add(digest)
                        new[i] = True
                flat = np.zeros(0, np.int64)
                if new.any():
                    counts = np.zeros(len(lines), dtype=np.int64)
                    counts[at[new]] = sizes[at[new]] - SHINGLE + 1
                    first = (np.arange(starts[-1]) - np.repeat(starts[:-1], sizes)) < np.repeat(counts, sizes)
                    shingles = run_hashes(hashes, SHINGLE)
                    chosen = shingles[first[: len(shingles)]]
                    flat = signer.sign(chosen, spans(counts[at[new]])[:-1]).view(np.int64).ravel()
                offsets = spans(np.where(new, bands, 0)).astype(np.int32)
                values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=pa.array(~new))
                half = np.frombuffer(b"".join(digests), dtype=">u8")[::2].astype(np.uint64).view(np.int64)
                text = np.repeat(np.arange(len(docs)), numbers)[at]
                pars = at - of_text[text]
                yield emit(schema, ids[text], pars.astype(np.int32), [x.hex() for x in digests], half, values, pa.nulls(len(at), pa.int64()))
            blocks, place = chosen_places(hashes, in_text)
            if len(place):
                text = np.repeat(np.arange(len(docs)), in_text)[place]
                order = np.lexsort((blocks[place], text))  # each hash of a text once, at its first place
                text, place = text[order], place[order]
                once = np.append(True, (np.diff(text) > 0) | (blocks[place[1:]] != blocks[place[:-1]]))
                text, place = text[once], place[once]
                none = [pa.nulls(len(place), schema.field(name).type) for name in ("pid", "p", "bands")]
                yield emit(schema, ids[text], (place - starts[of_text[text]]).astype(np.int32), *none, blocks[place].view(np.int64))

        for batch in batches:
            docs, texts, held = [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                docs.append(doc)
                texts.append(word_lines(text))
                held += sum(map(len, texts[-1]))
                if held > SLICE:
                    yield from tables(docs, texts)
                    docs, texts, held = [], [], 0
            if docs:
                yield from tables(docs, texts)
            if len(met) > 200_000:
                met.clear()

    texts = docs.selectExpr("cast(doc_id as bigint) doc_id", "text").where("doc_id is not null and text is not null")
    return texts.mapInArrow(run, "doc_id long, par int, pid string, p long, bands array<long>, h long")


def extension(same: np.ndarray) -> int:
    """How many places a match goes on: to the largest surplus of agreement over ``SIMILARITY``, past at most ``GAP`` different places."""
    best = score = reached = 0
    for start in range(0, len(same), 512):
        # An equal place counts 1 and a different one -4: 0 at a similarity of 0.8.
        scores = score + np.cumsum(np.where(same[start : start + 512], 1, -DIFFERENT))
        low = np.maximum.accumulate(np.concatenate([[best], scores]))[1:] - scores > GAP * DIFFERENT
        end = int(low.argmax()) if low.any() else len(scores)
        if end and (top := int(scores[:end].max())) >= best:
            best, reached = top, start + end - int(scores[:end][::-1].argmax())
        if end < len(scores):
            break
        score = int(scores[-1])
    return reached


def numbered(texts: tuple[str, str]) -> list[np.ndarray]:
    """The words of both texts as numbers that are equal where the words are."""
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    return [np.fromiter(map(numbers.__getitem__, w), np.uint64, len(w)) for w in map(word_list, texts)]


def common_runs(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """``start, end`` of the stretches of ``a`` whose runs of ``PASSAGE`` words ``b`` has too."""
    ours, theirs = long_run_hashes(a, PASSAGE), long_run_hashes(b, PASSAGE)
    values, first = np.unique(theirs, return_index=True)
    at = np.minimum(np.searchsorted(values, ours), len(values) - 1)
    same = np.flatnonzero(values[at] == ours)
    runs_a, runs_b = (np.lib.stride_tricks.sliding_window_view(x, PASSAGE) for x in (a, b))
    equal = np.ones(len(same), dtype=bool)
    for start in range(0, len(same), COMPARED):
        part = same[start : start + COMPARED]
        equal[start : start + COMPARED] = (runs_a[part] == runs_b[first[at[part]]]).all(axis=1)
    same = same[equal]
    if not len(same):
        return []
    cuts = np.flatnonzero(np.diff(same) > 1)
    starts, lasts = same[np.append(0, cuts + 1)], same[np.append(cuts, len(same) - 1)]
    return list(zip(starts.tolist(), (lasts + PASSAGE).tolist(), strict=True))


def common_passages(text: str, kept: str) -> list[tuple[int, int, int]]:
    """``start, end, equal`` of the passages of ``text`` that ``kept`` has, in words; near copies with their changed words.

    Compared word by word from runs of ``SHINGLE`` equal words to both true ends. Stretches on both sides of inserted
    or missing words are one passage if these are at most ``GAP`` and a quarter of either stretch.
    """
    if text == kept:
        n = len(word_list(text))
        return [(0, n, n)] if n >= PASSAGE else []
    a, b = numbered((text, kept))
    if min(len(a), len(b)) < PASSAGE:
        return []
    ours, theirs = run_hashes(a, SHINGLE), run_hashes(b, SHINGLE)
    order = np.argsort(theirs, kind="stable")
    ordered = theirs[order]
    low, high = (np.searchsorted(ordered, ours, side=x) for x in ("left", "right"))
    seeds = np.flatnonzero(low < high)
    found: list[list[int]] = []  # start and end here, start and end there, equal words
    i = there = 0
    while (n := int(np.searchsorted(seeds, i))) < len(seeds):
        i = int(seeds[n])
        places = order[low[i] : high[i]]  # ascending; the next one behind the last match, or else the first
        j = int(places[k]) if (k := int(np.searchsorted(places, there))) < len(places) else int(places[0])
        if not (a[i : i + SHINGLE] == b[j : j + SHINGLE]).all():
            i += 1
            continue
        right = extension(a[i : i + len(b) - j] == b[j : j + len(a) - i])
        back = min(i, j)
        left = extension((a[i - back : i] == b[j - back : j])[::-1])
        same = int((a[i - left : i + right] == b[j - left : j + right]).sum())
        found.append([i - left, i + right, j - left, j + right, same])
        i, there = i + right, j + right
    joined: list[list[int]] = []
    for x in found:
        if joined:
            y = joined[-1]
            twice = max(0, y[1] - x[0], y[3] - x[2])  # words at the seam that fit on either side
            gap = max(x[0] - y[1], x[2] - y[3]) + twice
            least = min(y[1] - y[0], x[1] - x[0]) - twice
            if x[2] > y[2] and gap <= GAP and gap * DIFFERENT <= least:
                joined[-1] = [min(y[0], x[0]), max(y[1], x[1]), y[2], x[3], y[4] + x[4] - twice]
                continue
        joined.append(x)
    out = [(x[0], x[1], x[4]) for x in joined]
    # Whatever the way through the matches was: every run of PASSAGE words that both have.
    return out + [(start, end, end - start) for start, end in common_runs(a, b)]


def longest(passages: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``start, end, kept`` without those that lie within another; of equal ones the one kept first."""
    out: list[tuple[int, int, int]] = []
    for x in sorted(passages, key=lambda x: (x[0], -x[1], x[2])):
        if not out or x[1] > out[-1][1]:
            out.append(x)
    return out


def passage_pairs(docs: DataFrame, blocks: DataFrame) -> DataFrame:
    """``doc_id, kept``: documents to compare, among them, for every run of ``PASSAGE`` words, with the first that has it.

    ``blocks`` is ``(doc_id, h)``. A document is compared with the first that has one of its
    blocks. That one may have less of a passage than another; so where more than two documents have
    a block, the runs of which it is the smallest are hashed too, and the first that has one is compared as well.
    """
    shared = blocks.groupBy("h").agg(F.min("doc_id").alias("kept"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
    shared = keep(shared.where("kept <> last").select("h", "kept", "n"), "shared-blocks")
    known = keep(blocks.join(shared, "h").select("doc_id", "h", "kept", "n"), "blocks-of-documents")
    pairs = known.where("doc_id <> kept").select("doc_id", "kept")
    by_doc = known.where("n > 2").groupBy("doc_id").agg(F.collect_set("h").alias("hs"))  # at most a document's blocks
    texts = docs.selectExpr("cast(doc_id as bigint) doc_id", "text").where("doc_id is not null and text is not null")
    schema = pa.schema([("doc_id", pa.int64()), ("w", pa.int64())])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            lists = batch.column(2)
            for i, (doc, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                hashes = word_hashes(word_list(text))
                runs = long_run_hashes(hashes, PASSAGE)
                if not len(runs):
                    continue
                # A run has the same smallest block wherever it is, and that block is a chosen one.
                lowest = extremes(run_hashes(hashes, BLOCK_WORDS), PLACES, np.minimum)
                near = np.isin(lowest, lists[i].values.to_numpy().view(np.uint64))
                found = np.unique(runs[near])
                yield emit(schema, np.full(len(found), doc), found.view(np.int64))

    runs = texts.join(by_doc, "doc_id").select("doc_id", "text", "hs").mapInArrow(run, "doc_id long, w long")
    runs = keep(runs, "runs-of-documents")
    first = runs.groupBy("w").agg(F.min("doc_id").alias("kept"), F.max("doc_id").alias("last")).where("kept <> last")
    more = runs.join(first.select("w", "kept"), "w").where("doc_id <> kept").select("doc_id", "kept")
    found = keep(pairs.union(more).distinct(), "passage-pairs")
    discard(shared, known, runs)
    return found


def repeated_passages(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """``doc_id, start, words, kept_doc_id`` of the passages that an earlier document has.

    ``pairs`` of ``passage_pairs`` only say what documents to compare. The texts decide, word by word.
    """
    texts = docs.selectExpr("cast(doc_id as bigint) doc_id", "text").where("doc_id is not null and text is not null")
    rows = texts.toDF("kept", "kept_text").join(pairs, "kept").join(texts, "doc_id")
    schema = pa.schema([
        ("doc_id", pa.int64()), ("start", pa.int32()), ("words", pa.int32()), ("kept_doc_id", pa.int64())
    ])

    def compare(batches: Batches) -> Batches:
        for batch in batches:
            out = []
            for doc, kept, text, other in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out += [(doc, start, end - start, kept) for start, end, same in common_passages(text, other) if same >= LEAST]
            yield emit(schema, *zip(*out, strict=True)) if out else pa.RecordBatch.from_pylist([], schema)

    def pick(batches: Batches) -> Batches:
        for batch in batches:
            out = []
            for doc, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                passages = longest([(x["start"], x["start"] + x["words"], x["kept_doc_id"]) for x in found])
                out += [(doc, start, end - start, kept) for start, end, kept in passages]
            yield emit(schema, *zip(*out, strict=True)) if out else pa.RecordBatch.from_pylist([], schema)

    columns = "doc_id long, start int, words int, kept_doc_id long"
    found = rows.select("doc_id", "kept", "text", "kept_text").mapInArrow(compare, columns)
    by_doc = found.groupBy("doc_id").agg(  # at most the passages of a document's pairs
        F.collect_set(F.struct("start", "words", "kept_doc_id")).alias("found")
    )
    return by_doc.mapInArrow(pick, columns)


def shingle_sets(docs: DataFrame, occurrences: DataFrame, wanted: DataFrame) -> DataFrame:
    """``pid, p, n, shingles`` of the wanted paragraphs ``p``, from one document that holds each."""
    holders = occurrences.join(wanted, "p", "left_semi").groupBy("pid").agg(F.min("doc_id").alias("doc_id"))
    by_doc = holders.groupBy("doc_id").agg(F.collect_set("pid").alias("pids"))  # at most a document's paragraphs
    texts = docs.selectExpr("cast(doc_id as bigint) doc_id", "text").where("doc_id is not null and text is not null")
    schema = pa.schema([("pid", pa.string()), ("p", pa.int64()), ("n", pa.int32()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Batches) -> Batches:
        from xxhash import xxh3_128_hexdigest

        for batch in batches:
            pids, sets = [], []
            for text, ids in zip(texts_of(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                open_ = set(ids)
                for paragraph in paragraphs_of(text):
                    words = word_list(paragraph)
                    if len(words) >= SHINGLE and (pid := xxh3_128_hexdigest(b" ".join(words))) in open_:
                        open_.discard(pid)
                        pids.append(pid)
                        sets.append(np.unique(shingle_hashes(words)).view(np.int64))
            half = np.array([int(x[:16], 16) for x in pids], dtype=np.uint64).view(np.int64)
            yield emit(schema, pids, half, [len(x) for x in sets], pa.array(sets, pa.list_(pa.int64())))

    rows = texts.join(by_doc, "doc_id").select("text", "pids")
    # Rows that repeat a doc_id may bring a paragraph twice.
    return rows.mapInArrow(run, "pid string, p long, n int, shingles array<long>").dropDuplicates(["pid"])


def similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``a, b`` (as pid) of the pairs ``x, y`` (as p) whose exact Jaccard similarity is high enough."""
    left = sets.selectExpr("p x", "pid a", "n na", "shingles sa")
    right = sets.selectExpr("p y", "pid b", "n nb", "shingles sb")
    both = pairs.join(left, "x").join(right, "y").where(f"least(na, nb) >= {similarity} * greatest(na, nb)")
    shared = both.selectExpr("a", "b", "na + nb total", "size(array_intersect(sa, sb)) same")
    return shared.where(f"same >= {similarity} * (total - same)").select("a", "b")


def forest(same: np.ndarray, left: list[int], right: list[int]) -> list[tuple[int, int]]:
    """Of the similar places of a block, those that connect roots not yet connected."""
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(same), strict=True):
        a, b = find(left[i]), find(right[j])
        if a != b:
            parent[a] = b
            out.append((i, j))
    return out


def similar_in_crowds(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links ``a, b`` that connect the components ``root`` of paragraphs ``p`` of a key.

    Per key, the members of the largest component are not compared among
    themselves; all others are compared with every member, block by block, by a product of
    the blocks' membership matrices. A block returns links that join components, never all
    similar pairs.
    """
    sizes = members.groupBy("key", "root").agg(F.count("*").alias("n"))
    plan = sizes.groupBy("key").agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("n"))
    plan = plan.selectExpr(
        "key", "main.root main", f"cast(ceil(n / {BLOCK}) as int) blocks",
        f"cast(ceil((n - main.n) / {BLOCK}) as int) rests",
    )
    known = members.join(plan, "key").join(sets.select("p", "pid", "n", "shingles"), "p")
    block = "cast(pmod(xxhash64(p), {0}) as int) {1}"
    columns = ["key", "i", "j", "root", "pid", "n", "shingles"]
    rest = known.where("root <> main").selectExpr("*", block.format("rests", "i"), "explode(sequence(0, blocks - 1)) j")
    every = known.selectExpr("*", block.format("blocks", "j"), "explode(sequence(0, rests - 1)) i")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("a", pa.string()), ("b", pa.string())])
        found: list[tuple[int, int]] = []
        if len(left) and len(right):
            sides = []
            for side in (left, right):
                lists = side["shingles"].combine_chunks()
                sides.append((np.repeat(np.arange(len(side)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()))
            same = np.zeros((len(left), len(right)))
            common = np.intersect1d(sides[0][1], sides[1][1])
            for start in range(0, len(common), COLUMNS):
                columns = common[start : start + COLUMNS]
                matrix = [np.zeros((len(t), len(columns)), dtype=np.float32) for t in (left, right)]
                for rows, (row, shingle) in zip(matrix, sides, strict=True):
                    at = np.minimum(np.searchsorted(columns, shingle), len(columns) - 1)
                    there = columns[at] == shingle
                    rows[row[there], at[there]] = 1
                same += matrix[0] @ matrix[1].T
            total = left["n"].to_numpy()[:, None] + right["n"].to_numpy() - same
            roots = left["root"].to_pylist(), right["root"].to_pylist()
            found = forest(same >= similarity * total, *roots)
        pids = left["pid"].to_pylist(), right["pid"].to_pylist()
        return pa.table([[pids[0][i] for i, _ in found], [pids[1][j] for _, j in found]], schema=schema)

    by = ["key", "i", "j"]
    # New names for columns that both sides have from the same tables.
    left, right = (side.select(columns).toDF(*columns).groupBy(by) for side in (rest, every))
    return left.cogroup(right).applyInArrow(compare, "a string, b string")


def paragraph_links(docs: DataFrame, occurrences: DataFrame, similarity: float, crowd: int) -> DataFrame:
    """Links ``a, b`` between different paragraphs; their components are those of all similar pairs that share a band."""
    band = F.explode("bands").alias("key")
    rows = occurrences.select("p", band)
    busy = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    busy_rows = keep(rows.join(busy, "key").distinct(), "shared-bands")
    wanted = busy_rows.groupBy("key").agg(F.min("p").alias("low"), F.max("p").alias("high")).where("low <> high")
    wanted = keep(wanted.select("key", "low"), "band-leaders")
    shared = keep(busy_rows.join(wanted, "key"), "band-members")
    discard(busy_rows)
    sets = keep(shingle_sets(docs, occurrences, shared.select("p").distinct()), "shingle-sets")

    # First everything is compared with one member of its key, at one comparison per row.
    stars = shared.where("p <> low").select(F.col("low").alias("x"), F.col("p").alias("y")).distinct()
    first = keep(similar(stars, sets, similarity), "star-links")
    roots = components(first, "star-edges")
    # Keys in which more than one component is left.
    numbered = sets.select("p", "pid").join(roots, F.col("pid") == F.col("node"), "left")
    numbered = numbered.select("p", F.xxhash64(F.coalesce("root", "pid")).alias("root"))
    rooted = shared.join(numbered, "p")
    open_ = rooted.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s"), F.count("*").alias("n"))
    rooted = keep(rooted.join(open_.where("r <> s").select("key", "n"), "key"), "open-bands")
    few, many = rooted.where(F.col("n") <= crowd), rooted.where(F.col("n") > crowd)
    pairs = (
        few.alias("f")
        .join(few.alias("g"), F.expr("f.key = g.key and f.p < g.p and f.root <> g.root and f.p <> f.low"))
        .select(F.col("f.p").alias("x"), F.col("g.p").alias("y"))
        .distinct()
    )
    crowded = similar_in_crowds(many.select("key", "root", "p"), sets, similarity)
    links = keep(first.union(similar(pairs, sets, similarity)).union(crowded), "paragraph-links")
    discard(shared, wanted, sets, first, rooted)
    return links


def repeated_paragraphs(
    docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, crowd: int = CROWD
) -> DataFrame:
    """``doc_id, paragraph, start, words, component, kept_doc_id, kept_paragraph, removed``.

    One row for each paragraph (a line of at least five words, numbered from 0 among all
    lines of the text) whose component reaches over more than one document. Paragraphs are linked if
    their lower-case words are the same, or if the Jaccard similarity of their five-word shingles is
    at least ``similarity``; similar ones are found by MinHash bands. The
    component's first occurrence by doc_id and paragraph is kept, all others are ``removed``.
    One row also for each passage within lines that the document ``kept_doc_id`` with a smaller doc_id
    has: ``start`` and ``words`` count the words of the text, ``paragraph`` and ``component`` are null.
    It has at least 25 words in common with that document, and every such run of words is in some row. Passages are compared word by word to their ends; ``common_passages`` says how far changed words belong to them.
    Passages that a text has in common with several documents may overlap.
    Null ids and texts hold no paragraphs. Rows that repeat a doc_id are one document. Other columns
    of ``docs`` stay out.
    """
    found = keep(paragraph_table(docs, bands, rows), "paragraphs")
    occurrences, blocks = found.where("pid is not null"), found.where("h is not null").select("doc_id", "h")
    links = paragraph_links(docs, occurrences, similarity, crowd)
    pairs = passage_pairs(docs, blocks)
    places = keep(occurrences.select("doc_id", "par", "pid"), "places")
    discard(found)  # before texts are brought together
    roots = components(links, "paragraph-edges")
    placed = places.join(roots, F.col("pid") == F.col("node"), "left")
    placed = placed.select("doc_id", "par", F.coalesce("root", "pid").alias("component"))
    groups = placed.groupBy("component").agg(
        F.min(F.struct("doc_id", "par")).alias("kept"), F.max("doc_id").alias("last")
    )
    groups = groups.where("kept.doc_id <> last").select(
        "component", F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.par").alias("kept_paragraph")
    )
    groups = keep(groups, "paragraph-groups")  # a join of its own, which can split a large component
    lines = placed.join(groups, "component").selectExpr(
        "doc_id", "par paragraph", "cast(null as int) start", "cast(null as int) words", "component", "kept_doc_id",
        "kept_paragraph", "not (doc_id = kept_doc_id and par = kept_paragraph) removed",
    )
    passages = keep(repeated_passages(docs, pairs), "passages").selectExpr(
        "doc_id", "cast(null as int) paragraph", "start", "words", "cast(null as string) component", "kept_doc_id",
        "cast(null as int) kept_paragraph", "true removed",
    )
    return lines.union(passages)


def cut_text(text: str, lines: list[int], passages: list[dict]) -> str:
    """``text`` without these lines and stretches of words; a line of which nothing is left goes."""
    gone = set(lines)
    cut = {n for x in passages for n in range(x["start"], x["start"] + x["words"])}
    out, n = [], 0
    for number, line in enumerate(paragraphs_of(text)):
        words = list(WORD.finditer(line))
        mine = [n + i in cut for i in range(len(words))]
        n += len(words)
        if number in gone or (words and all(mine)):
            continue
        kept, at = [], 0
        for i, word in enumerate(words):
            if mine[i]:
                if not i or not mine[i - 1]:
                    kept.append(line[at : word.start()])
                at = words[i + 1].start() if i + 1 < len(words) else len(line)
        out.append("".join([*kept, line[at:]]))
    return "\n".join(out)


def without_repeats(docs: DataFrame, repeats: DataFrame) -> DataFrame:
    """``docs`` without the removed paragraphs; ``n_chars``, where it is a column, counts what is left.

    A document of which no word is left goes. All other columns and documents stay as they are.
    """
    cuts = repeats.where("removed").groupBy(F.col("doc_id").alias("_cut_id"))
    cuts = cuts.agg(  # at most a document's lines and words
        F.collect_set("paragraph").alias("_lines"),
        F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", "words"))).alias("_passages"),
    )
    joined = docs.join(cuts, F.col("doc_id") == F.col("_cut_id"), "left").drop("_cut_id")
    names, types = docs.columns, to_arrow_schema(docs.schema)
    at = names.index("text")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            lines, passages = batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist()
            texts = batch.column(at).to_pylist()
            mask = [True] * len(texts)
            sizes = batch.column(names.index("n_chars")).to_pylist() if "n_chars" in names else None
            for i, text in enumerate(texts):
                if lines[i] is not None and text is not None:
                    texts[i] = cut_text(text, lines[i], passages[i])
                    mask[i] = bool(texts[i].strip())
                    if sizes is not None:
                        sizes[i] = len(texts[i])
            columns = list(batch.columns[: len(names)])
            columns[at] = pa.array(texts, types.field(at).type)
            if sizes is not None:
                columns[names.index("n_chars")] = pa.array(sizes, types.field("n_chars").type)
            kept = pa.RecordBatch.from_arrays(columns, names=names)
            yield kept if all(mask) else kept.filter(pa.array(mask))

    return joined.mapInArrow(run, docs.schema)
