"""Byte-level BPE encoding and decoding with recursive DuckDB queries inside each partition."""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import sys
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from txrisk.llm.common import append

# Bound of a worker's table of encoded pieces; emptied beyond, which costs time only.
CACHE_PIECES = 500_000
# Bytes of the words of one query: bounds the rows a recursion can make.
QUERY_BYTES = 400_000
# Tokens of one decoding query.
QUERY_TOKENS = 400_000
# Words longer than this are encoded in overlapping windows that are put together again.
WINDOW, STEP = 96, 48
# Rank and place in one number: the rank counts in units of this.
UNIT = 1 << 40
# A character no version of Unicode has assigned, and one whose class every version agrees on.
UNASSIGNED, FIRST_ODD = "͸", "԰"

# One row per place (counted through all words) with the place before it and the rank of the pair it begins, if any.
KEYED = f"""
    select word, place, token, before, merged, merged * {UNIT} + place as key
    from (select word, place, token, lag(place) over w as before,
            case when lead(word) over w = word then lead(token) over w end as next
          from state where not done window w as (order by place)) s
    left join merges on pair = token * {1 << 32} + next"""
DONE = "select word, token from state where done order by place"

# Each round contracts the leftmost pair of least rank of every word; words without a pair are done.
CONTRACT = f"""
with recursive state(word, place, token, done) as (
  select word, place, token, false from start
  union all
  (with keyed as ({KEYED}),
  best as (select word as of, min(key) as best from keyed group by word)
  select word, place, case when key = best then merged else token end, best is null
  from keyed join best on word = of
  where best is null or before is distinct from best % {UNIT}))
{DONE}"""

# The same with all the equal pairs that would follow one another from the left in one round. What a
# contraction makes never has a lower rank than the pair contracted, so nothing can come between them.
CONTRACT_EQUAL = f"""
with recursive state(word, place, token, done) as (
  select word, place, token, false from start
  union all
  (with keyed as ({KEYED}),
  best as (select word as of, min(merged) as best from keyed group by word),
  numbered as (
    select word, place, token, before, best, coalesce(merged = best, false) as equal,
      row_number() over (partition by word order by place) as i
    from keyed join best on word = of),
  runs as (
    select *, i - row_number() over (partition by word, equal order by place) as run from numbered),
  hits as (
    select *, equal and row_number() over (partition by word, equal, run order by place) % 2 = 1 as hit from runs),
  marked as (
    select *, coalesce(lag(hit) over (partition by word order by place), false) as gone from hits)
  select word, place, case when hit then best else token end, best is null from marked where not gone))
{DONE}"""

DECODE = """
select doc, string_agg(shown, '' order by nth) as shown
from tokens join vocabulary using (token) group by doc"""


@lru_cache
def odd_characters() -> str:
    """Characters that the ``regex`` module takes for letters or digits and the library's older Unicode does not.

    Found by asking the library whether a character, and a letter or a mark, make one piece.
    """
    import public_tokenizers
    import tiktoken

    new = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) == "Cn")
    asked = regex.findall(r"[\p{L}\p{N}]", new)
    ranks = {bytes([b]): b for b in range(256)} | {(c + "!").encode(): 256 + i for i, c in enumerate(asked)}
    library = tiktoken.Encoding("asked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return "".join(c for c in asked if len(library.encode_ordinary(c + "!")) == 1)


class Splitter:
    """Splits texts into the matches of a pattern as the library does."""

    def __init__(self, pattern: str, odd: str):
        self.find = regex.compile(pattern).findall
        self.spans = regex.compile(pattern).finditer
        self.beyond = re.compile(f"[{FIRST_ODD}-\U0010ffff]")
        self.odd = str.maketrans(dict.fromkeys(odd, UNASSIGNED))

    def pieces(self, text: str) -> list[str]:
        if self.beyond.search(text):
            plain = text.translate(self.odd)
            if plain != text:
                return [text[m.start() : m.end()] for m in self.spans(plain)]
        return self.find(text)


class RankTables:
    """A rank file as DuckDB tables, and the queries over them."""

    def __init__(self, data: bytes):
        import duckdb

        self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, data.splitlines())}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("a rank for each single byte is needed")
        pairs, merged = [], []
        for token, rank in self.ranks.items():
            made = len(token) == 1
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs.append((a << 32) + b)
                    merged.append(rank)
                    made |= a < rank and b < rank
            if not made:
                raise ValueError("every token must be made of tokens of lower rank")
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.length = {r: len(t) for t, r in self.ranks.items()}
        self.known = np.zeros(max(self.length) + 1, dtype=bool)
        self.known[list(self.length)] = True
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        merges = pa.table({"pair": pa.array(pairs, pa.int64()), "merged": pa.array(merged, pa.int64())})
        shown = {"token": pa.array(self.ranks.values(), pa.int64()), "shown": [t.hex() for t in self.ranks]}
        for name, rows in (("merges", merges), ("vocabulary", pa.table(shown))):
            self.db.register("rows_", rows)
            self.db.execute(f"create table {name} as select * from rows_")
            self.db.unregister("rows_")

    def _query(self, sql: str, name: str, rows: pa.Table) -> pa.Table:
        self.db.register(name, rows)
        try:
            return self.db.sql(sql).to_arrow_table()
        finally:
            self.db.unregister(name)

    def contract(self, words: list[bytes], sql: str = CONTRACT) -> list[bytes]:
        """Ids of words, as 32-bit numbers, by one recursive query over a row per byte."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        token = self.byte[np.frombuffer(b"".join(words), dtype=np.uint8)]
        word = np.repeat(np.arange(len(words), dtype=np.int64), lengths)
        found = self._query(sql, "start", pa.table({"word": word, "place": np.arange(len(token)), "token": token}))
        ends = np.searchsorted(found["word"].to_numpy(), np.arange(len(words) + 1)) * 4
        ids = found["token"].to_numpy().astype(np.uint32).tobytes()
        return [ids[a:b] for a, b in itertools.pairwise(ends.tolist())]

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as 32-bit numbers: its own rank if it has one, else what contraction leaves."""
        out = [b""] * len(words)
        short, long = [], []
        for i, w in enumerate(words):
            rank = self.ranks.get(w)
            if rank is not None:
                out[i] = array("I", [rank]).tobytes()
            elif w:
                (short if len(w) <= WINDOW else long).append(i)
        start, size = 0, 0
        for k, i in enumerate(short):
            size += len(words[i])
            if size >= QUERY_BYTES or k == len(short) - 1:
                chosen = short[start : k + 1]
                for j, ids in zip(chosen, self.contract([words[j] for j in chosen]), strict=True):
                    out[j] = ids
                start, size = k + 1, 0
        for i in long:
            out[i] = array("I", self.encode_long(words[i])).tobytes()
        return out

    def encode_long(self, word: bytes, window: int = WINDOW, step: int = STEP) -> list[int]:
        """Ids of a long word out of overlapping windows.

        Tokens are the encoding of what they spell if each two neighbours are that of theirs. Two windows that share
        a border and the token after it can so be joined there. If some two share none (in
        periodic words), wider windows are tried, up to the whole word.
        """
        if len(word) <= window:
            return list(memoryview(self.contract([word], CONTRACT_EQUAL)[0]).cast("I"))
        starts = range(0, len(word) - window + step, step)
        pieces = [word[s : s + window] for s in starts]
        per_query = max(1, QUERY_BYTES // window)
        out: list[int] = []
        borders: dict[int, int] = {}  # places where a token of ``out`` starts, with its index
        for at in range(0, len(pieces), per_query):
            # Wider windows hold periods, of which equal pairs are contracted together.
            sql = CONTRACT if window == WINDOW else CONTRACT_EQUAL
            for s, found in zip(starts[at : at + per_query], self.contract(pieces[at : at + per_query], sql), strict=True):
                ids = list(memoryview(found).cast("I"))
                place, joined = s, not out
                for i, token in enumerate(ids):
                    known = borders.get(place)
                    if not joined and known is not None and out[known] == token:
                        del out[known:]
                        joined = True
                    if joined:
                        borders = self._starts(out, ids[i:], place)
                        out += ids[i:]
                        break
                    place += self.length[token]
                if not joined:
                    return self.encode_long(word, 4 * window, 2 * window)
        return out

    def _starts(self, out: list[int], added: list[int], place: int) -> dict[int, int]:
        """Where each of the ``added`` tokens starts, with the index it will have."""
        starts = {}
        for i, token in enumerate(added):
            starts[place] = len(out) + i
            place += self.length[token]
        return starts

    def decode(self, ids: list[list[int]]) -> list[bytes]:
        """The bytes that each list of ids spells, joined in order by the database."""
        out = [b""] * len(ids)
        start, size = 0, 0
        for k, x in enumerate(ids):
            size += len(x)
            if size >= QUERY_TOKENS or k == len(ids) - 1:
                self._decode(ids, start, k + 1, out)
                start, size = k + 1, 0
        return out

    def _decode(self, ids: list[list[int]], first: int, last: int, out: list[bytes]) -> None:
        lengths = np.array([len(x) for x in ids[first:last]], dtype=np.int64)
        total = int(lengths.sum())
        tokens = np.concatenate([np.zeros(0, np.int64), *[np.asarray(x, dtype=np.int64) for x in ids[first:last]]])
        if total and not (tokens.min() >= 0 and tokens.max() < len(self.known) and self.known[tokens].all()):
            raise ValueError("an id that the vocabulary does not have")
        doc = np.repeat(np.arange(first, last), lengths)
        # A very long list is decoded in parts, which end anywhere between its tokens.
        for a in range(0, total, QUERY_TOKENS):
            b = a + QUERY_TOKENS
            rows = pa.table({"doc": doc[a:b], "nth": np.arange(a, min(b, total)), "token": tokens[a:b]})
            found = self._query(DECODE, "tokens", rows)
            for d, shown in zip(found["doc"].to_pylist(), found["shown"].to_pylist(), strict=True):
                out[d] += bytes.fromhex(shown)


class ByteCodec:
    """Encodes texts and decodes ids; pieces are encoded once while they are remembered."""

    def __init__(self, data: bytes, pattern: str, odd: str):
        self.split, self.tables = Splitter(pattern, odd), RankTables(data)
        self.known: dict[str, bytes] = {}  # ids as 32-bit numbers, the compactest form here

    def encode(self, texts: list[str]) -> list[array]:
        known = self.known
        if len(known) > CACHE_PIECES:
            known.clear()
        split = [self.split.pieces(t) for t in texts]
        new = list(set().union(*split).difference(known))
        known.update(zip(new, self.tables.encode([p.encode() for p in new]), strict=True))
        return [array("I", b"".join([known[p] for p in pieces])) for pieces in split]

    def decode(self, ids: list) -> list[bytes]:
        return self.tables.decode(ids)


_codecs: dict[tuple[bytes, str, str], ByteCodec] = {}


def worker_codec(data: bytes, pattern: str, odd: str) -> ByteCodec:
    """One per Python worker."""
    key = data, pattern, odd
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = ByteCodec(*key)
    return _codecs[key]


def _shared(docs: DataFrame, path: str, pattern: str):
    """The rank file and the split, of a fixed size whatever the corpus."""
    with open(path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast((f.read(), pattern, odd_characters()))


def encode_decode(docs: DataFrame, path: str, pattern: str, prefix: str = "") -> DataFrame:
    """``docs`` with the ids of every whole text under the rank file at ``path``, and what they decode to.

    Adds ``ids`` and ``decoded`` (bytes), after ``prefix``. ``pattern`` splits a text into pieces that are encoded
    separately, without special tokens. A null or empty text has no ids and decodes to no bytes. All rows and columns
    stay, repeated ones too; choose a ``prefix`` that keeps the new names apart from theirs. Map-only.
    """
    shared = _shared(docs, path, pattern)

    def maker():
        codec = worker_codec(*shared.value)

        def make(texts: list[str]) -> list[list]:
            ids = codec.encode(texts)
            return [ids, codec.decode(ids)]

        return make

    return append(docs, f"{prefix}ids array<bigint>, {prefix}decoded binary", maker)


def codec_digests(docs: DataFrame, path: str, pattern: str, prefix: str = "") -> DataFrame:
    """``encode_decode`` with ids (as little-endian 32-bit numbers) and decoded bytes reduced to SHA-256 digests.

    Adds ``n_tokens, ids_sha256, decoded_sha256`` (after ``prefix``). Rows and nulls are treated as there.
    """
    shared = _shared(docs, path, pattern)

    def maker():
        codec = worker_codec(*shared.value)

        def make(texts: list[str]) -> list[list]:
            ids = codec.encode(texts)
            numbers = [np.array(x, dtype="<u4").tobytes() for x in ids]
            return [[len(x) for x in ids], [sha256(x) for x in numbers], [sha256(x) for x in codec.decode(ids)]]

        return make

    return append(docs, f"{prefix}n_tokens bigint, {prefix}ids_sha256 string, {prefix}decoded_sha256 string", maker)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
