"""Token counts by rank-synchronous merging of ragged symbol arrays."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from txrisk.llm.common import Batches, emit, spans, texts_of
from txrisk.llm.tokenizer import WORD_END, Vocabulary, read_vocabulary, vocabulary

# Entries of the worker's table of counted pieces; it is emptied beyond, which costs time only.
CACHE_PIECES = 800_000
# Symbols merged at once.
MERGE_SYMBOLS = 1 << 20
NO_RANK = np.int64(1) << 62

COUNT_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())]
)


class RankMerger:
    """Counts the symbols that are left of many words after all merges.

    All words lie behind one another in one array. In each round every word applies
    its lowest-ranked pair, at all its places from left to right, at the same time as the
    other words. Where the new symbol could take part in a merge of a lower rank,
    which the order of single merges would do next, only the first place is merged.
    """

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        size = vocab.size
        keys = np.array([a * size + b for a, b in vocab.pairs], dtype=np.int64)
        values = np.array(list(vocab.pairs.values()), dtype=np.int64).reshape(-1, 2)
        self.ranks, self.merged = values[:, 0], values[:, 1]
        # A table with open addresses, sparse enough to need few probes.
        self.bits = max(4, int(len(keys)).bit_length() + 4)
        self.slots = np.full(1 << self.bits, -1, dtype=np.int64)  # of the pair in each slot
        self.slot_keys = np.full(1 << self.bits, -1, dtype=np.int64)
        waiting, probe = np.arange(len(keys)), 0
        while len(waiting):
            slot = self._slot(keys[waiting], probe)
            free = self.slot_keys[slot] < 0
            _, first = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            placed = first[free[first]]
            self.slots[slot[placed]], self.slot_keys[slot[placed]] = waiting[placed], keys[waiting[placed]]
            waiting, probe = np.delete(waiting, placed), probe + 1
        self.probes = probe
        lowest = np.full(size, NO_RANK)  # of the merges that a symbol takes part in
        if len(keys):
            np.minimum.at(lowest, keys // size, values[:, 0])
            np.minimum.at(lowest, keys % size, values[:, 0])
        self.together = lowest[self.merged] > self.ranks

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(64 - self.bits)).astype(np.int64) + probe) & ((1 << self.bits) - 1)

    def pair_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of each pair of symbols, -1 where no merge joins it."""
        keys = a * self.vocab.size + b
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for probe in range(self.probes):
            slot = self._slot(keys[open_], probe)
            there = self.slot_keys[slot]
            hit = there == keys[open_]
            out[open_[hit]] = self.slots[slot[hit]]
            open_ = open_[~hit & (there >= 0)]
            if not len(open_):
                break
        return out

    def symbols(self, words: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.vocab.ids
        flat: list[int] = []
        lengths = []
        for w in words:
            if w:
                flat.extend([ids[c] for c in w[:-1]])
                flat.append(ids[w[-1] + WORD_END])
            lengths.append(len(w))
        return np.array(flat, dtype=np.int64), np.array(lengths, dtype=np.int64)

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each word, in blocks of words of bounded size."""
        out, block, size = [np.zeros(0, np.int64)], [], 0
        for w in words:
            block.append(w)
            size += len(w)
            if size >= MERGE_SYMBOLS:
                out.append(self._merge(*self.symbols(block)))
                block, size = [], 0
        if block:
            out.append(self._merge(*self.symbols(block)))
        return np.concatenate(out)

    def _merge(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        result = lengths.copy()
        rows = np.flatnonzero(lengths > 1)  # words that may still merge
        symbols = symbols[np.repeat(lengths > 1, lengths)]
        lengths = lengths[rows]
        if not len(rows):
            return result
        # The pair of each symbol with its successor; none at a word's last symbol.
        pair = np.full(len(symbols), -1, dtype=np.int64)
        pair[:-1] = self.pair_of(symbols[:-1], symbols[1:])
        pair[spans(lengths)[1:] - 1] = -1
        while True:
            rank = np.where(pair >= 0, self.ranks[pair], NO_RANK)
            best = np.minimum.reduceat(rank, spans(lengths)[:-1])
            done = best == NO_RANK
            if done.any():
                result[rows[done]] = lengths[done]
                left = np.repeat(~done, lengths)
                symbols, pair, rank = symbols[left], pair[left], rank[left]
                rows, lengths, best = rows[~done], lengths[~done], best[~done]
                if not len(rows):
                    return result
            owner = np.repeat(np.arange(len(rows)), lengths)
            places = np.flatnonzero(rank == best[owner])
            word = owner[places]
            # In a run of overlapping places (the pair of a symbol with itself) every second one merges.
            index = np.arange(len(places))
            fresh = np.ones(len(places), dtype=bool)
            fresh[1:] = np.diff(places) > 1
            apply = (index - np.maximum.accumulate(np.where(fresh, index, 0))) % 2 == 0
            first = np.ones(len(places), dtype=bool)
            first[1:] = word[1:] != word[:-1]
            apply &= self.together[pair[places]] | first
            places, word = places[apply], word[apply]
            symbols[places] = self.merged[pair[places]]
            left = np.ones(len(symbols), dtype=bool)
            left[places + 1] = False
            lengths = lengths - np.bincount(word, minlength=len(rows))
            symbols, pair = symbols[left], pair[left]
            # Only the pairs at the new symbols have changed.
            places = places - np.arange(len(places))
            start = spans(lengths)
            changed = np.unique(np.concatenate([places, places[places > start[word]] - 1]))
            last = np.zeros(len(symbols), dtype=bool)
            last[start[1:] - 1] = True
            pair[changed[last[changed]]] = -1
            changed = changed[~last[changed]]
            pair[changed] = self.pair_of(symbols[changed], symbols[changed + 1])


class PieceCounter:
    """Token counts of texts; pieces between white space are counted once while they are remembered."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.merger = vocab, RankMerger(vocab)
        self.known: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        known = self.known
        if len(known) > CACHE_PIECES:
            known.clear()
        split = [self.vocab.chunks(t) for t in texts]
        new = list(set().union(*split).difference(known))
        parts = self.vocab.parts_of_all(new)
        words = list({w for p in parts for w in p if isinstance(w, str)})
        size = dict(zip(words, self.merger.counts(words).tolist(), strict=True))
        known.update(zip(new, [sum([1 if isinstance(w, int) else size[w] for w in p]) for p in parts], strict=True))
        return [sum(map(known.__getitem__, pieces)) for pieces in split]


_counters: dict[str, PieceCounter] = {}


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_column: str = "doc_id") -> DataFrame:
    """Tokens of every whole text under the vocabulary file at ``path``.

    Returns ``doc_id, n_bytes, n_tokens, over_limit`` for every row, in no order and
    without other columns of ``docs``. A null text counts as empty: 0 bytes, 0 tokens. Null
    and repeated ids pass through. Map-only: no shuffle. The vocabulary, of a fixed size,
    is broadcast; a worker holds one batch and a table of at most ``CACHE_PIECES`` pieces.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batches: Batches) -> Batches:
        data = shared.value
        if data not in _counters:
            _counters.clear()
            _counters[data] = PieceCounter(vocabulary(data))
        counter = _counters[data]
        for batch in batches:
            texts = texts_of(batch.column(1))
            n = counter.count(texts)
            yield emit(COUNT_SCHEMA, batch.column(0), [len(t.encode()) for t in texts], n, [x > limit for x in n])

    rows = docs.selectExpr(f"cast(`{id_column}` as bigint) doc_id", "text")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
