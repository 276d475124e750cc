"""Byte-level BPE by a sentencepiece model written straight from a vocabulary of ranks.

Each byte string of the vocabulary becomes a piece: its bytes are mapped to visible code points,
its score is minus its rank, and nothing is normalised.  The library's merge loop (best score
first, leftmost among equals) then is the merge loop of the ranks.  Texts are cut by the
vocabulary's pattern and every match is encoded by itself; a match that is a piece as a whole is
that piece.  Decoding maps ids back to bytes.

Defined cases: a null or empty text has no ids and decodes to no bytes; repeated rows and ids
are encoded each by itself; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linetally.llm.pretokens import Memo, all_chunks, text_slices
from linetally.llm.workers import shipped


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file, by rank."""
    with open(path, "rb") as lines:
        ranked = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    if sorted(ranked) != list(range(len(ranked))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    return [ranked[i] for i in range(len(ranked))]


def byte_letters() -> list[str]:
    """A visible code point for each byte: CJK ideographs, which the library takes as they are."""
    return [chr(0x4E00 + byte) for byte in range(256)]


def serialised_model(tokens: list[bytes], letters: list[str]) -> bytes:
    """A sentencepiece BPE model whose piece i is token i; the unknown piece comes last."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    for rank, token in enumerate(tokens):
        piece = "".join(letters[byte] for byte in token)
        model.pieces.add(piece=piece, score=-float(rank), type=pb.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=0.0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    spec = model.trainer_spec
    spec.model_type = pb.TrainerSpec.BPE
    spec.vocab_size = len(model.pieces)
    spec.unk_id, spec.bos_id, spec.eos_id, spec.pad_id = len(tokens), -1, -1, -1
    norm = model.normalizer_spec
    norm.name = "identity"
    norm.add_dummy_prefix = norm.remove_extra_whitespaces = norm.escape_whitespaces = False
    return model.SerializeToString()


class ByteBpe:
    """Encoder and decoder for one vocabulary and pattern."""

    def __init__(self, ranks_path: str, pattern: str):
        import sentencepiece

        tokens = read_ranks(ranks_path)
        letters = byte_letters()
        self._letters = {byte: letter for byte, letter in enumerate(letters)}
        self._pattern = regex.compile(pattern)
        self._whole = {token: rank for rank, token in enumerate(tokens)}
        self._model = sentencepiece.SentencePieceProcessor(model_proto=serialised_model(tokens, letters))
        self._lengths = np.array([len(token) for token in tokens], np.int64)
        self._starts = np.cumsum(self._lengths) - self._lengths
        self._bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self._matches = Memo(self._encode_matches, capacity=250_000)
        self._chunks = Memo(self._encode_chunks, capacity=500_000)

    def _encode_matches(self, matches: list[bytes]) -> list[bytes]:
        mapped = [match.decode("latin-1").translate(self._letters) for match in matches]
        found = self._model.encode(mapped, num_threads=1)
        ids = [[self._whole[m]] if m in self._whole else got for m, got in zip(matches, found, strict=True)]
        return [np.array(x, "<u4").tobytes() for x in ids]

    def _encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of chunks: of each match of the pattern, one after the other."""
        found = [[match.encode() for match in self._pattern.findall(chunk.decode())] for chunk in chunks]
        distinct = list({match for matches in found for match in matches})
        ids = dict(zip(distinct, self._matches.values_of(distinct), strict=True))
        return [b"".join(map(ids.__getitem__, matches)) for matches in found]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        chunks = all_chunks(texts)
        return chunks.join(self._chunks.values_of(chunks.distinct), 4)

    def decode(self, ids: bytes) -> bytes:
        """The bytes that encoded ids stand for."""
        tokens = np.frombuffer(ids, "<u4")
        lengths = self._lengths[tokens]
        ends = np.cumsum(lengths)
        if not len(ends):
            return b""
        shift = np.repeat(self._starts[tokens] - (ends - lengths), lengths)
        return self._bytes[shift + np.arange(ends[-1])].tobytes()


@lru_cache(maxsize=2)
def _codec(ranks_path: str, pattern: str) -> ByteBpe:
    return ByteBpe(ranks_path, pattern)


def encode_and_decode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the bytes they decode to."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_path, pattern)
        for batch in batches:
            for rows, texts in text_slices(batch):
                ids = codec.encode(texts)
                digests = [hashlib.sha256(x).hexdigest() for x in ids]
                decoded = [hashlib.sha256(codec.decode(x)).hexdigest() for x in ids]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": rows.column("doc_id"),
                        "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                        "ids_sha256": pa.array(digests, pa.string()),
                        "decoded_sha256": pa.array(decoded, pa.string()),
                    }
                )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return shipped(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(code, schema)
