"""BPE encoding and decoding by traversal of a trie of words."""

from __future__ import annotations

import hashlib
from array import array
from copy import copy

from pyspark.sql import DataFrame

from txrisk.llm.common import append
from txrisk.llm.tokenizer import WORD_END, Vocabulary, read_vocabulary, vocabulary

# Bounds of a task's tables; emptied beyond, which costs time only.
CACHE_PIECES = 500_000
CACHE_PAIRS = 400_000
# A word's last character is moved by this much, so that it is another symbol than inside a word.
END = 0x1000

class TrieEncoder:
    """Encodes words by their trie.

    The tokens of a prefix follow from its last token alone: the rest are the tokens
    of the shorter prefix where that token begins. The last token is the one that ends the
    prefix and that the merges keep apart from the last token of that shorter
    prefix. So a depth-first walk needs one state per node of the path, and a prefix that
    words share is worked out once.
    """

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.ids = {self.marked(t): i for t, i in vocab.ids.items()}
        self.beginnings = {t[:k] for t in self.ids for k in range(len(t) + 1)}
        self.steps: dict[str, tuple[str, list[tuple[int, int]]]] = {}
        self.length = [0] * vocab.size
        for t, i in self.ids.items():
            self.length[i] = len(t)
        self.rank, self.left, self.right = vocab.rank.tolist(), vocab.left.tolist(), vocab.right.tolist()
        self.apart: dict[int, bool] = {}

    @staticmethod
    def marked(token: str) -> str:
        if token.endswith(WORD_END) and len(token) > len(WORD_END):
            token = token[: -len(WORD_END)]
            return token[:-1] + chr(ord(token[-1]) + END)
        return token

    def kept_apart(self, a: int, b: int) -> bool:
        """Whether merging leaves the border between neighbouring tokens ``a`` and ``b``.

        Undoes the merges of both, latest first, and looks for a merge across the border
        that would have come before the one undone last.
        """
        key = a * len(self.rank) + b
        known = self.apart.get(key)
        if known is not None:
            return known
        pairs, rank, left, right = self.vocab.pairs, self.rank, self.left, self.right
        limit = len(pairs) + 1
        while True:
            across = pairs.get((a, b))
            if across is not None and across[0] < limit:
                result = False
                break
            if rank[a] > rank[b]:
                limit, a = rank[a], right[a]
            elif rank[b] >= 0:
                limit, b = rank[b] + 1, left[b]
            else:
                result = True
                break
        if len(self.apart) > CACHE_PAIRS:
            self.apart.clear()
        self.apart[key] = result
        return result

    def step(self, text: str) -> tuple[str, list[tuple[int, int]]]:
        """The longest ending of ``text`` that begins a token, and the tokens that end it, longest first.

        All tokens that end a prefix end that ending too, so it is all of a prefix that
        its extensions need.
        """
        state = text
        while state not in self.beginnings:
            state = state[1:]
        tokens = [(self.ids[t], len(t)) for k in range(len(state)) if (t := state[k:]) in self.ids]
        if len(self.steps) > CACHE_PAIRS:
            self.steps.clear()
        self.steps[text] = state, tokens
        return state, tokens

    def encode(self, words: list[str]) -> list[list[int]]:
        """Ids of each word (not empty)."""
        return [memoryview(x).cast("i").tolist() for x in self.encode_packed(words)]

    def encode_packed(self, words: list[str]) -> list[bytes]:
        """Ids of each word (not empty) as 32-bit numbers.

        Words in sorted order are the leaves of their trie, depth first: of each only what it does not share with
        the word before is new, and the path's states and last tokens are kept by depth.
        """
        steps, kept_apart, length = self.steps, self.kept_apart, self.length
        apart, size = self.apart, len(self.rank)
        out = [b""] * len(words)
        last = [-1] * (max(map(len, words), default=0) + 1)  # last token by depth on the path
        states = [""] * len(last)
        before, depth = "", 0
        for i in sorted(range(len(words)), key=words.__getitem__):
            word = words[i]
            # An end of a word is always a leaf, so the last characters are never shared.
            end, depth = len(word) - 1, 0
            for a, b in zip(word[:end], before):
                if a != b:
                    break
                depth += 1
            before = word[:end]
            for c in word[depth:end] + chr(ord(word[end]) + END):
                text = states[depth] + c
                depth += 1
                state, tokens = steps.get(text) or self.step(text)
                for token, n in tokens:
                    if n == depth:
                        break
                    border = apart.get(last[depth - n] * size + token)
                    if kept_apart(last[depth - n], token) if border is None else border:
                        break
                last[depth] = token
                states[depth] = state
            found = []
            while depth:
                token = last[depth]
                found.append(token)
                depth -= length[token]
            found.reverse()
            out[i] = array("i", found).tobytes()
        return out


class Codec:
    """Encodes texts and decodes ids; pieces between white space are encoded once while they are remembered."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.trie = vocab, TrieEncoder(vocab)
        self.digits = [str(i) for i in range(vocab.size)]
        self.known: dict[str, bytes] = {}  # ids as 32-bit numbers, the compactest form here

    def emptied(self) -> Codec:
        """The same vocabulary with tables of its own."""
        out = copy(self)
        out.trie, out.known = copy(self.trie), {}
        out.trie.steps, out.trie.apart = {}, {}
        return out

    def encode(self, texts: list[str]) -> list[list[int]]:
        known = self.known
        if len(known) > CACHE_PIECES:
            known.clear()
        split = [self.vocab.chunks(t) for t in texts]
        new = list(set().union(*split).difference(known))
        parts = self.vocab.parts_of_all(new)
        words = list({w for p in parts for w in p if isinstance(w, str)})
        ids = dict(zip(words, self.trie.encode_packed(words), strict=True))
        for piece, p in zip(new, parts, strict=True):
            if len(p) == 1 and p[0] in ids:
                known[piece] = ids[p[0]]
            else:
                known[piece] = b"".join([array("i", [w]).tobytes() if isinstance(w, int) else ids[w] for w in p])
        return [memoryview(b"".join([known[p] for p in pieces])).cast("i").tolist() for pieces in split]

    def decode(self, ids: list[int]) -> str:
        """The file names no decoder: the tokens as they stand in the vocabulary, joined by spaces."""
        return " ".join(map(self.vocab.tokens.__getitem__, ids))

    def digests(self, ids: list[list[int]]) -> tuple[list[int], list[str], list[str]]:
        """Number of ids, SHA-256 of their decimal form and of what they decode to."""
        numbers = [sha256(" ".join(map(self.digits.__getitem__, x))) for x in ids]
        return [len(x) for x in ids], numbers, [sha256(self.decode(x)) for x in ids]


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


_codecs: dict[str, Codec] = {}


def worker_codec(data: str) -> Codec:
    """One for each task: the vocabulary is read once per Python worker, what is remembered of texts goes with the task.

    Workers live on and serve later stages, whose memory it would take.
    """
    if data not in _codecs:
        _codecs.clear()
        _codecs[data] = Codec(vocabulary(data))
    return _codecs[data].emptied()


def encode_decode(docs: DataFrame, path: str, prefix: str = "") -> DataFrame:
    """``docs`` with the ids of every whole text under the vocabulary file at ``path``, and what they decode to.

    Adds ``ids`` and ``decoded`` (after ``prefix``). A null or empty text has no ids and
    decodes to the empty text. All rows and columns stay; choose a ``prefix`` that keeps the
    new names apart from theirs. Map-only; the vocabulary, of a fixed size, is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def maker():
        codec = worker_codec(shared.value)

        def make(texts: list[str]) -> tuple[list[list[int]], list[str]]:
            ids = codec.encode(texts)
            return ids, [codec.decode(x) for x in ids]

        return make

    return append(docs, f"{prefix}ids array<int>, {prefix}decoded string", maker)


def codec_digests(docs: DataFrame, path: str, prefix: str = "", keep_ids: bool = False) -> DataFrame:
    """``encode_decode`` with ids and decoded text reduced to SHA-256 digests where they arise.

    Adds ``n_tokens, ids_sha256, decoded_sha256`` (after ``prefix``), and ``ids`` if they are kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def maker():
        codec = worker_codec(shared.value)

        def make(texts: list[str]) -> list[list]:
            ids = codec.encode(texts)
            return [*codec.digests(ids), *[ids] * keep_ids]

        return make

    fields = f"{prefix}n_tokens bigint, {prefix}ids_sha256 string, {prefix}decoded_sha256 string"
    return append(docs, fields + f", {prefix}ids array<int>" * keep_ids, maker)
