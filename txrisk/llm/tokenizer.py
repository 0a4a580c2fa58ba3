"""A word-end BPE vocabulary file as plain tables, and the split of texts into pre-tokens."""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np

# Chunks of these characters are split by the pattern below; all others by the library.
SIMPLE = re.compile(r"[\x21-\x7e\xa1-ɏ‐-‧]+")
# The vocabulary's own split pattern, for the characters above.
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[0-9²³¹¼½¾]|(?:[^\s\w]|_)+")
# Python's white space that Unicode does not count as such.
CONTROL_SPACE = re.compile(r"[\x1c-\x1f]")
WORD_END = "</w>"


class Vocabulary:
    """Tables of a ``tokenizers`` file with a word-end BPE model.

    ``pairs[(a, b)]`` is ``(rank, merged id)``; symbols that no merge makes have rank -1.
    """

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        data = json.loads(text)
        model = data["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != WORD_END:
            raise ValueError("a BPE vocabulary with word ends is needed")
        if model["merges"] and isinstance(model["merges"][0], str):
            model["merges"] = [m.split(" ") for m in model["merges"]]
        self.library = Tokenizer.from_str(text)
        self.library.no_padding()
        self.library.no_truncation()
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in data["added_tokens"]):
            raise ValueError("added tokens must be matched as they stand")
        self.special_pattern = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for token, i in [*self.ids.items(), *self.special.items()]:
            self.tokens[i] = token
        self.rank = np.full(size, -1, dtype=np.int64)
        self.left, self.right = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            merged = self.ids[a + b]
            x, y = self.ids[a], self.ids[b]
            self.pairs[x, y] = (rank, merged)
            if self.rank[merged] < 0:
                self.rank[merged], self.left[merged], self.right[merged] = rank, x, y
        self.size = size

    def words(self, chunk: str) -> list[str]:
        """Byte-level pre-tokens of a text without special strings."""
        chunk = self.library.normalizer.normalize_str(chunk)
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(chunk)]

    def parts(self, chunk: str) -> list[str | int]:
        """Pre-tokens of a text, special strings as their ids."""
        out: list[str | int] = []
        at = 0
        for m in self.special_pattern.finditer(chunk):
            out += self.words(chunk[at : m.start()])
            out.append(self.special[m[0]])
            at = m.end()
        return out + self.words(chunk[at:])

    def parts_of_all(self, chunks: list[str]) -> list[list[str | int]]:
        """``parts`` of many chunks, those of common characters without the library."""
        # Lower case of these characters depends on no neighbour.
        table = byte_level_table()
        out: list[list[str | int]] = []
        for chunk in chunks:
            if "<|" in chunk or not SIMPLE.fullmatch(chunk):
                out.append(self.parts(chunk))
                continue
            lower = chunk.lower()
            # A run of letters is one piece.
            found = [lower] if lower.isalpha() else PIECE.findall(lower)
            out.append(found if lower.isascii() else [w.translate(table) for w in found])
        return out

    def chunks(self, text: str) -> list[str]:
        """Pieces whose pre-tokens do not depend on one another: what white space separates."""
        return [text] if CONTROL_SPACE.search(text) else text.split()


@lru_cache
def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself if visible, else the next free one."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


@lru_cache
def byte_level_table() -> dict[int, str]:
    """From the characters of ``SIMPLE`` and those of their lower case to the byte alphabet."""
    alphabet = byte_alphabet()
    # The lower case of a few is far from them.
    lower = {ord(x) for c in range(0x80, 0x250) for x in chr(c).lower() if ord(x) >= 0x80}
    codes = lower | {*range(0x80, 0x400), *range(0x2010, 0x2028)}
    return {c: "".join(alphabet[b] for b in chr(c).encode()) for c in codes}


@lru_cache(maxsize=2)
def vocabulary(text: str) -> Vocabulary:
    """One per Python worker."""
    return Vocabulary(text)


def read_vocabulary(path: str) -> str:
    """The file's text: of fixed size, whatever the corpus, so that it may be broadcast."""
    with open(path, encoding="utf-8") as f:
        return f.read()
