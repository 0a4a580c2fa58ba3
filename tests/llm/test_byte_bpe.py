import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from txrisk.llm import byte_bpe, queries
from txrisk.llm.byte_bpe import ByteCodec, RankTables, codec_digests, encode_decode, odd_characters
from txrisk.llm.common import prepare
from txrisk.llm.queries import BYTE_RANKS, vocabulary_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def codec():
    with open(vocabulary_path(BYTE_RANKS), "rb") as f:
        return ByteCodec(f.read(), public_tokenizers.PATTERN, odd_characters())


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.tables.ranks, special_tokens={}
    )


def same(codec, library, text):
    ids = list(codec.encode([text])[0])
    assert ids == library.encode_ordinary(text)
    assert codec.decode([ids]) == [text.encode()]


R = random.Random(12)
HARD = [
    "", " ", "\n\n  x \t\t", "it's DON'T 'LL we'll", "<|endoftext|>", "日本語 テスト 12 ½²³ a_b __ –—…", "İstanbul ǅ ß ﬁ",
    "a" * 30_000, "ab" * 5000, "abc" * 5000, " " * 5000 + "x", "\n" * 777, "!?" * 999, "the" * 3000, "aab" * 4000,
    "".join(R.choice("etaoinshr") for _ in range(9000)), "".join(chr(R.randrange(0x4E00, 0x9FFF)) for _ in range(3000)),
    "\x00\x1c\x85 ", "\U0001f600‍\U0001f600", "ՙ՘a!", "\U000323b0 \U0001df90x!",
]


@pytest.mark.parametrize("text", HARD, ids=range(len(HARD)))
def test_hard_texts_as_the_library(codec, library, text):
    same(codec, library, text)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text_as_the_library(codec, library, text):
    same(codec, library, text)


def test_long_words_as_the_library(codec, library):
    for seed in range(60):
        r = random.Random(seed)
        part = "".join(r.choice("abcdefghijklmnopqrstuvwxyz"[: r.randrange(1, 27)]) for _ in range(r.randrange(1, 40)))
        same(codec, library, (part * 400)[: r.randrange(97, 1500)])


def test_characters_that_newer_tables_call_letters(codec, library):
    odd = odd_characters()
    for i in range(0, len(odd), max(1, len(odd) // 50)):
        same(codec, library, f"a{odd[i]}b {odd[i]}1!{odd[i]}")


def test_every_token_is_its_own_encoding(codec):
    tokens = [t for t in codec.tables.ranks if len(t) > 1]
    # By contraction alone, without the look-up of whole words.
    chosen = [t for t in tokens if len(t) <= byte_bpe.WINDOW]
    found = codec.tables.contract(chosen)
    assert [np.frombuffer(x, np.uint32).tolist() for x in found] == [[codec.tables.ranks[t]] for t in chosen]


def test_both_ways_of_contraction_agree(codec):
    words = ["".join(R.choice("abab etnn") for _ in range(R.randrange(1, 80))).encode() for _ in range(300)]
    assert codec.tables.contract(words) == codec.tables.contract(words, byte_bpe.CONTRACT_EQUAL)


def test_small_queries_and_caches(codec, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "QUERY_BYTES", 40)
    monkeypatch.setattr(byte_bpe, "QUERY_TOKENS", 7)
    monkeypatch.setattr(byte_bpe, "CACHE_PIECES", 3)
    texts = [f"alpha{i} beta{'xyz' * i} gamma{i % 3} delta" for i in range(45)]
    for i in range(0, 45, 9):
        ids = codec.encode(texts[i : i + 9])
        assert [list(x) for x in ids] == [library.encode_ordinary(t) for t in texts[i : i + 9]]
        assert codec.decode(ids) == [t.encode() for t in texts[i : i + 9]]


def test_ids_and_files_that_do_not_fit(codec):
    with pytest.raises(ValueError):
        codec.decode([[1, 10**6]])
    with pytest.raises(ValueError):
        RankTables(b"YQ== 0\n")


def test_odd_documents(spark, library, odd_docs):
    prepare(spark)
    path = vocabulary_path(BYTE_RANKS)
    rows = encode_decode(odd_docs, path, public_tokenizers.PATTERN, "_new_").collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert list(r._new_ids) == library.encode_ordinary(r.text or "")
        assert bytes(r._new_decoded) == (r.text or "").encode()


def test_empty_table(spark, no_docs):
    prepare(spark)
    found = codec_digests(no_docs.select("doc_id", "text"), vocabulary_path(BYTE_RANKS), public_tokenizers.PATTERN)
    assert found.count() == 0


def test_query_against_the_library(spark, library, sf_docs):
    rows = queries.op12_byte_bpe(spark, SF)
    assert rows.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    expected = []
    for d in sf_docs.collect():
        ids = library.encode_ordinary(d.text or "")
        digests = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), (d.text or "").encode())]
        expected.append((d.doc_id, len(ids), *digests))
    assert sorted(map(tuple, rows.collect())) == sorted(expected)
