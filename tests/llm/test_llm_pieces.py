"""SentencePiece encoding by the table of last tokens, against the library."""

import random

import brute
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece

from linetally.llm import pieces, pretokens, queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def codec():
    return pieces.PieceCodec(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def hard_texts(codec):
    rng = random.Random(1)
    parts = ["a", "The", " ", "  ", "\n", "\t", "▁", "é", "'s", "12", "½", "中", "😀", "́", "\x1c", "\x00", "</s>", "\r"]
    parts += ["​", "﷐", "İ", "ing", "<0x0A>", "한국", "    "]
    tokens = codec._vocabulary.tokens
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["".join(rng.choice(tokens) for _ in range(rng.randint(1, 8))).replace("▁", " ") for _ in range(8000)]
    texts += ["".join(rng.choice("abcdetino ") for _ in range(rng.randint(1, 300))) for _ in range(500)]
    return texts + ["a" * n for n in range(99)] + [" " * n for n in range(99)] + [" " * n + "x" for n in range(60)] + ["xy" * 50_000]


def test_ids_and_texts_match_the_library(codec, library):
    texts = hard_texts(codec)
    found = codec.encode(pa.array(texts))
    for text, ids, want in zip(texts, found, library.encode(texts, add_bos=True, add_eos=True, num_threads=1), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert codec.decode(ids) == library.decode(want), text


def test_decoding_any_ids_matches_the_library(codec, library):
    rng = random.Random(2)
    some = [0, 1, 2, 3, 13, 259, 260, 28705]
    for _ in range(20_000):
        ids = [rng.choice([*some, rng.randrange(3, 259), rng.randrange(3, 259), rng.randrange(32_000)]) for _ in range(rng.randint(0, 8))]
        assert codec.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids), ids


def test_compatible_pairs_are_those_that_merging_leaves_apart(codec):
    rng, vocabulary = random.Random(3), codec._vocabulary
    short = [t for t in vocabulary.tokens if len(t) < 5]
    found = []
    for _ in range(20_000):
        x, y = rng.choice(short), rng.choice(short)
        found.append(vocabulary.compatible(x, y))
        assert found[-1] == (pieces.merged(x + y, vocabulary._rank)[0] == [x, y]), (x, y)
    assert 1000 < sum(found) < 19_900


def test_small_vocabulary_with_characters_that_are_no_pieces():
    vocabulary = pieces.Vocabulary({"ab": -1.0, "abc": -2.0, "bc": -3.0, "a": -9.0})
    for text in ("abcbc", "bcab", "aabbcc", "c", "cabc"):
        tokens = [vocabulary.tokens[t] for t in vocabulary.encode(text)]
        assert tokens == pieces.merged(text, vocabulary._rank)[0]
    with pytest.raises(ValueError, match="rank before"):
        pieces.Vocabulary({"ab": -2.0, "abc": -1.0})


def test_query_matches_the_library(spark, sf_dir, library):
    for docs in (spark.read.parquet(f"{sf_dir}/documents.parquet"), brute.awkward(spark), brute.empty(spark)):
        want = []
        for r in docs.select("doc_id", "text").collect():
            ids = library.encode(r.text or "", add_bos=True, add_eos=True)
            want.append((r.doc_id, len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha(library.decode(ids))))
        assert brute.multiset(pieces.encode_and_decode(docs, MODEL).collect()) == brute.multiset(want)
    assert queries.op12_sentencepiece(spark, sf_dir).count() == 1000


def test_caches_are_bounded_in_bytes():
    memo = pretokens.Memo(lambda new: [x * 2 for x in new], capacity_bytes=50_000, fixed={b"f": b"F"})
    for start in range(0, 5000, 50):
        some = [f"{i}".encode() * 10 for i in range(start, start + 50)]
        assert memo.values_of(some) == [x * 2 for x in some]
        assert memo._bytes == memo._weight(memo.keys() - {b"f"}, memo) <= 50_000 + 50 * 400
    assert memo.values_of([b"x" * 600]) == [b"x" * 1200] and b"x" * 600 not in memo and memo[b"f"] == b"F"
