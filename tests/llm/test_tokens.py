"""Token counts and the SentencePiece codec against the libraries."""

import random

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from creditpulse.llm import bpe_codec as W
from creditpulse.llm import sentencepiece_codec as S
from creditpulse.llm.token_counts import Counter, count_tokens, merged_lengths, read_bpe

BPE, PIECES = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


def fuzz(alphabet, n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(n)]


def test_counts_equal_the_library(library):
    parts = ["a", "ab", " ", "  ", "\n", "\t", "the", "<|endoftext|>", "é", "世", "😀", "\x85", "\x1c", "0", "'s", "　", "\U000323b0", "՘"]
    texts = fuzz(parts, 2000) + ["", "a" * 5000, " " * 3000, "<|endoftext|>" * 3 + "x", "the<|endoftext|> the", " lead", "trail "]
    got = Counter(read_bpe(BPE, P.PATTERN)).count(texts)
    assert got == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_merging_takes_runs_from_the_left(library):
    t = read_bpe(BPE, P.PATTERN)
    words = [b"a" * n for n in range(1, 40)] + [b"abab" * 7, "é".encode() * 9]
    assert merged_lengths(words, t).tolist() == [len(library.encode(w.decode()).ids) for w in words]


def test_count_rows(spark, odd_frame, empty_frame, library):
    out = count_tokens(odd_frame, BPE, P.PATTERN)
    rows = sorted(map(tuple, out.collect()), key=str)
    want = sorted(((r.doc_id, len((r.text or "").encode()), n := len(library.encode(r.text or "").ids), n > 1024)
                   for r in odd_frame.collect()), key=str)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and rows == want
    assert count_tokens(empty_frame, BPE, P.PATTERN).count() == 0


def test_not_a_byte_level_vocabulary():
    with pytest.raises(ValueError):
        read_bpe(P.path("word_bpe_49k.json"), P.PATTERN)


# --- SentencePiece -----------------------------------------------------------


def field(number, value):
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def unigram_model(squeeze=1):
    """A small unigram model, written by hand: pieces and scores are made up."""
    import struct

    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    words = ["▁", "▁the", "▁a", "the", "he", "t", "h", "e", "a", "b", "ab", "▁ab", "▁▁", "n", "an", "▁an", "d", "and"]
    pieces += [(w, -2.0 - 0.37 * i, 1) for i, w in enumerate(words)]
    out = b""
    for p, s, t in pieces:
        out += field(1, field(1, p.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", s) + field(3, t))
    out += field(2, field(3, 1) + field(4, len(pieces)) + field(35, 1) + field(40, 0) + field(41, 1) + field(42, 2))
    return out + field(3, field(1, b"identity") + field(3, 1) + field(4, squeeze) + field(5, 1))


@pytest.mark.parametrize("source", [open(PIECES, "rb").read(), unigram_model(), unigram_model(0)], ids=["bpe", "unigram", "unigram-spaces"])
def test_ids_and_texts_equal_the_library(source):
    parts = ["a", "ab", " ", "  ", "the", "and", "\n", "é", "世", "😀", "▁", "<s>", "0", "12", "Zeit", "\x00"]
    texts = fuzz(parts, 1500) + ["", " ", "   ", "the the and"]
    judge = sentencepiece.SentencePieceProcessor(model_proto=source)
    codec = S.Codec(S.read_model(source))
    ids, parity, good = codec.encode(texts)
    assert codec.encode(texts) == (ids, parity, good)  # from memory
    numbers = [list(memoryview(b).cast("i")) for b in ids]
    assert numbers == judge.encode(texts)
    assert good == [codec.decode(n) == codec.expected(t) for n, t in zip(numbers, texts)]
    assert [codec.decode(n) for n in numbers] == judge.decode(numbers)
    assert all(p for p, t in zip(parity, texts) if "▁" not in t)
    spoken = [t for t in texts if "▁" not in t]
    assert [codec.decode(list(memoryview(b).cast("i"))) for b in codec.encode(spoken)[0]] == [codec.expected(t) for t in spoken]


def test_model_fields_equal_the_protobuf():
    from sentencepiece import sentencepiece_model_pb2 as pb

    want = pb.ModelProto()
    want.ParseFromString(open(PIECES, "rb").read())
    m = S.read_model(open(PIECES, "rb").read())
    assert m.pieces == [p.piece for p in want.pieces] and m.scores == [p.score for p in want.pieces]
    assert m.types == [p.type for p in want.pieces] and m.kind == want.trainer_spec.model_type
    assert (m.byte_fallback, m.dummy_prefix, m.squeeze) == (True, True, False) and m.separable


def test_encode_and_decode_rows(spark, odd_frame, empty_frame):
    judge = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    out = S.encode(odd_frame, PIECES, keep=["doc_id", "kept"])
    back = S.decode(out.withColumnRenamed("kept", "text"), PIECES)
    got = sorted(((r.doc_id, tuple(r.ids), r.n_tokens, r.parity, r.round_trip, r.text) for r in back.collect()), key=str)
    want = sorted(((r.doc_id, tuple(i := judge.encode(r.text or "")), len(i), True, True, r.text or "") for r in odd_frame.collect()), key=str)
    assert got == want
    assert S.encode(empty_frame, PIECES).count() == 0


# --- BPE with word ends --------------------------------------------------------


WORDS = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORDS)


def test_word_ids_and_texts_equal_the_library(word_library):
    parts = ["a", "ab", " ", "  ", "\n", "\t", "the", "The", "<|endoftext|>", "<|startoftext|>", "<|", "é", "e\u0301", "\u0301", "世", "😀", "\x85",
             "\x1c", "0", "12", "'s", "'S", "'ll", "\u3000", "\xa0", "\u200b", "\U000323b0", "\u0558", "\u0130", "Σ", "ß", "ſ", "½", "²", "\x00", "_", "..."]
    texts = fuzz(parts, 4000) + ["", "a" * 5000, " " * 100, "x y" * 1000]
    want = word_library.encode_batch(texts, add_special_tokens=False)
    v = W.read_vocabulary(WORDS)
    encoder = W.Encoder(v)
    for _ in range(2):  # the second time from memory
        got = [list(memoryview(b).cast("i")) for b in encoder.encode([t.encode() for t in texts])]
        assert got == [e.ids for e in want]
    assert [W.decoded(i, v.strings).decode() for i in got] == [word_library.decode(i, skip_special_tokens=False) for i in got]


def test_forgetting_changes_nothing(word_library, monkeypatch):
    monkeypatch.setattr(W, "GENERATION", 20)
    encoder = W.Encoder(W.read_vocabulary(WORDS))
    texts = fuzz(["a", "b", "cat", "dog", " ", ".", "é"], 300)
    for _ in range(2):
        got = [list(memoryview(b).cast("i")) for t in texts for b in encoder.encode([t.encode()])]
        assert got == [e.ids for e in word_library.encode_batch(texts, add_special_tokens=False)]
    assert len(encoder.chunks.young) < 60


def test_word_rows(spark, odd_frame, empty_frame, word_library):
    out = W.encode(odd_frame, WORDS, keep=["doc_id", "kept"], decoded_col="text")
    want = sorted(((r.doc_id, "clash", len(i := word_library.encode(r.text or "").ids), i, word_library.decode(i, skip_special_tokens=False))
                   for r in odd_frame.collect()), key=str)
    assert out.columns == ["doc_id", "kept", "n_tokens", "ids", "text"]
    assert sorted(map(tuple, out.collect()), key=str) == want
    back = W.decode(out.select("doc_id", "ids").union(spark.createDataFrame([(99, None)], "doc_id long, ids array<int>")), WORDS)
    assert sorted((r.text for r in back.collect()), key=str) == sorted([*(w[4] for w in want), None], key=str)
    assert W.encode(empty_frame, WORDS).count() == 0


def test_not_a_vocabulary_with_word_ends():
    with pytest.raises(ValueError):
        W.read_vocabulary(BPE)
