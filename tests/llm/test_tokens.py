"""Token counts, token files and byte-level BPE against the libraries."""

import hashlib
import json
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from goldweave.llm import byte_bpe, chunks, token_counts, token_files

TEXTS = [
    "", None, "plain words, with marks. And more!", "  two  spaces   three \n\n lines\n x\t\ty ", "a" * 5000,
    "don't you'll 123 4567 x1y2", "Éeau naïve Straße 你好世界 🙂🙂 مرحبا", "<|endoftext|> in  <|endoftext|>text",
    "<|startoftext|>lower UPPER<|endoftext|>", "  wide space line", "word. word, (word) word.. word",
    "same text", "same text", "\n\n\nx", "trailing   ", "é ́x", "a\x1cb \x1d c\x00d", "ΑΣ. ΑΣ ",
    " ".join(f"word{i % 997}" for i in range(20_000)),
]


@pytest.fixture
def table(spark):
    rows = [(i, t, i, "x") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, ids string")


@lru_cache
def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


@pytest.mark.parametrize("name,spaces", [("byte_bpe_50k.json", "kept"), ("word_bpe_49k.json", "dropped")])
def test_counts_are_those_of_the_library(table, name, spaces):
    found = {r.doc_id: r for r in token_counts.count_tokens(
        table, public_tokenizers.path(name), spaces).collect()}
    for i, e in enumerate(library(name).encode_batch([t or "" for t in TEXTS], add_special_tokens=False)):
        assert (found[i].n_tokens, found[i].n_bytes, found[i].over_limit) == (
            len(e.ids), len((TEXTS[i] or "").encode()), len(e.ids) > 1024), TEXTS[i]


def test_sentence_pieces(table):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(table, path).collect()}
    assert found == {i: len(model.encode(t or "")) for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("max_bytes,kept", [(0, [0]), (800, [1, 2, 3]), (1 << 20, [7])])
def test_a_full_cache_is_cleared(max_bytes, kept):
    encoder = chunks.ChunkEncoder(lambda g: [[len(w)] * len(w) for w in g], "dropped", max_bytes=max_bytes)
    long = "x" * (chunks.LONG + 1)
    for _ in range(3):
        ids, n = encoder.ids(pa.array(["aa bbb. c", "", f"dd {long}. aa"]))
        assert n.tolist() == [7, 0, 5 + len(long)]
        encoder._trim()
        assert not any(len(w) > chunks.LONG for w in encoder.slot)
        assert len(encoder.slot) in kept
    # Used in three slices, and so kept before words seen once.
    encoder.ids(pa.array(["aa dd", "aa zz"]))
    encoder.ids(pa.array(["aa xx yy"]))
    encoder._trim()
    assert kept == [0] or "aa" in encoder.slot


# Letters, marks and white space of every kind the libraries treat apart, and whole special strings.
PARTS = [
    *"aZé0.,!?;:'-\u0301\u0307\u0308İΣßΑ你ﬁ½٣\x00\x01\x1c\x1d\x1e\x1f\x7f\x85\xa0\u1680\u2003\u2028\u202f\u3000\u200b\u180e\ufeff🙂",
    " ", " ", " ", " ", "  ", "\n", "\n\n", "\t", "\x0b", "\x0c", "\r\n", "'ll", "'s", "İ!", "word", "Word.", "the",
    "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>",
]
FUZZ = st.lists(st.sampled_from(PARTS), max_size=12).map("".join)


def same(encoder, ours, texts):
    ids, n = encoder.ids(pa.array(texts, pa.string()))
    ends = np.cumsum(n)
    for t, e, k in zip(texts, ends, n, strict=True):
        assert ids[e - k:e].tolist() == ours(t), ascii(t)


@settings(max_examples=400, deadline=None)
@given(st.lists(FUZZ, min_size=1, max_size=12))
def test_ids_of_odd_texts(texts):
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        tokenizer = library(name)
        same(cutting(public_tokenizers.path(name)),
             lambda t, k=tokenizer: k.encode(t, add_special_tokens=False).ids, texts)
    path = public_tokenizers.path("piece_bpe_32k.model")
    same(cutting(path), model(path).encode, [t.replace("\x00", "") for t in texts])
    for name in ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"):
        path = public_tokenizers.path(name)
        same(ranked(path).encoder, encoding(path).encode_ordinary, texts)


# Letters and marks around the places where words are cut from what follows them.
ENDS = st.lists(st.sampled_from([
    *"aZ×÷ÀßƀȿɀʰéΑ你'’.,$(1٣<\x00\x1c\n\t\u0301\u2003\xad", " ", " ", "'s", "'ll", "''s", "$$$", "\n\n", " \n", "<|endoftext|>"]),
    max_size=14).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(ENDS, min_size=1, max_size=12))
def test_ids_where_words_end(texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    same(cutting(path), lambda t: library("byte_bpe_50k.json").encode(t, add_special_tokens=False).ids, texts)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    same(ranked(path).encoder, encoding(path).encode_ordinary, texts)


@pytest.mark.parametrize("make", [
    lambda: chunks.library_encoder.__wrapped__(public_tokenizers.path("byte_bpe_50k.json")),
    lambda: byte_bpe.ByteBpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).encoder])
def test_a_word_is_learnt_once_whatever_follows(make):
    encoder = make()
    words, ends = ["one", "Two", "drée", "Ünß"], [".", ",\n", "\n", "$$$", " ", ".\nThen ", "1"]
    encoder.ids(pa.array([f"x {w}{e}Last" for w in words for e in ends]))
    assert {w.strip() for w in encoder.slot} <= {
        *words, "x", "Then", "Last", "", ".Last", ".", ",", "$$$Last", "1Last"}


def test_other_patterns_keep_line_feeds_with_marks():
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    pattern = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+[\r\n]*|\s+(?!\S)|\s+"
    other = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.load_ranks(path), special_tokens={})
    same(byte_bpe.ByteBpe(path, pattern).encoder, other.encode_ordinary, ["one.\nTwo, three;\n}\nx", "a\nb"])


# The library keeps two of each at most.
cutting = lru_cache(chunks.library_encoder.__wrapped__)


@lru_cache
def ranked(path):
    return byte_bpe.ByteBpe(path, public_tokenizers.PATTERN)


@lru_cache
def model(path):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache
def encoding(path):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=byte_bpe.load_ranks(path), special_tokens={})


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_many_chunks_at_once(name):
    tokenizer = library(name)
    joined = cutting(public_tokenizers.path(name)).joined
    words = [w for t in TEXTS if t for w in t.split(" ")] + ["don't", "x1y2", "a.b,c", "_", "'s", "''", "1234", "Ünï"]
    words = [w for w in (f" {w}" if name.startswith("byte") else w for w in words) if joined.fits(w)]
    assert len(words) > 100
    ids, n = joined.encode(words)
    ends = np.cumsum(n)
    for w, e, k in zip(words, ends, n, strict=True):
        assert ids[e - k:e].tolist() == tokenizer.encode(w, add_special_tokens=False).ids, w
    # Ids that do not end where a chunk does are no result.
    broken = chunks.Joined(lambda t: [0], joined.sizes, "kept")
    assert broken.encode([" a", " b"]) is None


def test_white_space_is_read_from_the_file():
    found = {n: json.loads(library(n).to_str()) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")}
    assert [chunks.white_space(f) for f in found.values()] == ["kept", "dropped"]
    byte, word = found.values()
    assert chunks.white_space({**byte, "normalizer": {"type": "NFKC"}}) == "whole"
    assert chunks.white_space({**word, "normalizer": {"type": "Replace", "pattern": {"String": " "}, "content": "_"}}) == "whole"
    assert chunks.white_space({**word, "pre_tokenizer": None}) == "whole"
    with pytest.raises(ValueError):
        chunks.library_encoder(public_tokenizers.path("byte_bpe_50k.json"), "dropped")


def test_round_trip_is_both_ways(table):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    apart = byte_bpe.decode_documents(
        byte_bpe.encode_documents(table, path, public_tokenizers.PATTERN), path, public_tokenizers.PATTERN, digest=True)
    found = byte_bpe.round_trip(table, path, public_tokenizers.PATTERN)
    assert sorted(found.collect()) == sorted(apart.collect())


@pytest.mark.parametrize("bits", [1, 8])
@pytest.mark.parametrize("n", [0, 1, 7, 8192, 8193, 30_000])
def test_planes_come_back(bits, n):
    values = np.random.default_rng(n).integers(0, 60_000, n).astype(np.uint32)
    assert (token_files.restore_planes(token_files.shuffle_planes(values, bits)) == values).all()


def test_token_files_hold_all_ids_in_order(spark, table, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(table.union(table.limit(1)), path, public_tokenizers.path("word_bpe_49k.json"),
                             "dropped", end_id=2, chunk_ids=500)
    rows = token_files.read_tokens(spark, path).orderBy("start").collect()
    ids = [(e.ids + [2]) for e in library("word_bpe_49k.json").encode_batch(
        [t or "" for t in TEXTS], add_special_tokens=False)]
    expected = [(0, ids[0]), *enumerate(ids)]
    start = 0
    for r, (i, own) in zip(rows, expected, strict=True):
        assert (r.doc_id, r.start, r.n_tokens) == (i, start, len(own))
        assert np.frombuffer(r.ids, "<u4").tolist() == own
        start += len(own)
    crc = {(r.doc_id, r.ids_crc32) for r in token_files.read_tokens(spark, path, digest=True).collect()}
    assert crc == {(i, zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in expected}


def test_null_ids_and_empty_tables(spark, table, tmp_path):
    path = str(tmp_path / "a")
    name = public_tokenizers.path("word_bpe_49k.json")
    rows = spark.createDataFrame([(None, "x"), (3, "y"), (None, None)], "doc_id long, text string")
    token_files.write_tokens(rows, path, name, "dropped", end_id=2)
    assert [r.doc_id for r in token_files.read_tokens(spark, path).orderBy("start").collect()] == [None, None, 3]
    path = str(tmp_path / "b")
    token_files.write_tokens(rows.limit(0), path, name, "dropped", end_id=2)
    assert token_files.read_tokens(spark, path).count() == 0
    assert token_counts.count_tokens(rows.limit(0), name).count() == 0


def test_byte_bpe_is_that_of_the_library(table):
    import tiktoken

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=byte_bpe.load_ranks(path),
                                 special_tokens={})
    encoded = byte_bpe.encode_documents(table, path, pattern)
    for r in encoded.collect():
        own = encoding.encode_ordinary(TEXTS[r.doc_id] or "")
        assert np.frombuffer(r.ids, "<u4").tolist() == own, TEXTS[r.doc_id]
    for r in byte_bpe.decode_documents(encoded, path, pattern).collect():
        assert r.decoded == (TEXTS[r.doc_id] or "").encode()
    for r in byte_bpe.decode_documents(encoded, path, pattern, digest=True).collect():
        assert r.decoded_sha256 == hashlib.sha256((TEXTS[r.doc_id] or "").encode()).hexdigest()
