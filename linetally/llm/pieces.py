"""SentencePiece BPE encoding by a table of every prefix's last token, and decoding.

The library's merge loop gives every prefix of a text an encoding, whose last token depends on the
prefix only.  That token is the one piece that ends the prefix, was found there by an automaton over
all pieces, and is compatible with the last token of the prefix before it: two pieces are compatible
if merging their characters alone gives these two again.  So one pass over the characters fills
a table of last tokens, and walking back from the end recovers the ids, without a merge loop.

Compatibility is decided on the merge trees of the pieces: while the left piece grows along its
right edge and the right one along its left edge, in the order of their ranks, no merge across the
border may come first.  Among equal ranks the leftmost pair merges first.  Pieces that share their
rank with others (runs of spaces, as a rule) are tried by merging them.

No piece reaches across the start of a run of spaces or a character that is in no piece, so that
texts are cut there and every worker sees each chunk once, through a cache bounded in bytes.

Defined cases: a null or empty text has the begin and end ids only; repeated rows and ids are
encoded each by itself; texts of any length are encoded whole, with four bytes of table per
character of the longest chunk; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import inf

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linetally.llm.pretokens import Memo, chunks_of, holds, plain_texts, text_slices
from linetally.llm.workers import shipped

SPACE = "▁"  # how the library writes a space
UNKNOWN_SURFACE = " ⁇ "
MOST_PAIRS = 2_000_000
CACHE_BYTES = 96_000_000
_CHUNK = re.compile(f"[ {SPACE}]*[^ {SPACE}\n]+|[ {SPACE}]+|\n")


def merged(text: str, rank: dict[str, int]) -> tuple[list[str], tuple[str, str] | None]:
    """What merging the characters of a short text gives, and the last pair merged."""
    parts, pair = list(text), None
    while len(parts) > 1:
        ranks = [rank.get(a + b, inf) for a, b in zip(parts, parts[1:])]
        best = min(ranks)
        if best == inf:
            break
        at = ranks.index(best)
        pair = (parts[at], parts[at + 1])
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts, pair


def spaced_chunks(text: str) -> list[str]:
    """The chunks of a text that starts with the space put before it; none if that is all."""
    return _CHUNK.findall(text) if text != " " else []


def check_cuts(pieces: Iterable[str]) -> None:
    """Fail where texts may not be cut before runs of spaces and around line ends."""
    if any(re.search(f"[^{SPACE}]{SPACE}|\n", piece) for piece in pieces if len(piece) > 1):
        raise ValueError("pieces must not reach across words or lines")


def read_model(path: str):  # sentencepiece's ModelProto
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    return model


class Vocabulary:
    """The normal pieces of a model: their ranks, merge trees, and an automaton that finds them."""

    def __init__(self, scores: dict[str, float]):
        import ahocorasick

        order = {score: rank for rank, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self._rank = {piece: order[score] for piece, score in scores.items() if len(piece) > 1}
        self.alphabet = set("".join(scores))
        holders: dict[int, int] = {}
        for rank in self._rank.values():
            holders[rank] = holders.get(rank, 0) + 1
        # Growing to the right edge and to the left edge: (token, rank at which it merges on).
        self._right: dict[str, list[tuple[str, float]]] = {c: [(c, inf)] for c in self.alphabet}
        self._left = dict(self._right)
        self._tied = set()
        for piece in sorted(self._rank, key=lambda p: (self._rank[p], len(p))):
            parts, pair = merged(piece, self._rank)
            if len(parts) > 1:
                continue  # no text gives it
            rank = self._rank[piece]
            if any(self._rank.get(part, -1) > rank for part in pair):
                raise ValueError("a piece must not rank before its parts")
            if holders[rank] > 1 or any(part in self._tied for part in pair):
                self._tied.add(piece)
            left, right = pair
            self._right[piece] = [*self._right[right][:-1], (right, rank), (piece, inf)]
            self._left[piece] = [*self._left[left][:-1], (left, rank), (piece, inf)]
        self.tokens = list(self._right)
        self._automaton = ahocorasick.Automaton()
        for token, piece in enumerate(self.tokens):
            self._automaton.add_word(piece, (token, len(piece)))
        self._automaton.make_automaton()
        self._lengths = [len(piece) for piece in self.tokens]
        self._pairs: dict[int, bool] = {}

    def compatible(self, x: str, y: str) -> bool:
        """Whether the merge loop leaves these two pieces apart, as they are."""
        if x in self._tied or y in self._tied:
            return merged(x + y, self._rank)[0] == [x, y]
        right, left = self._right[x], self._left[y]
        i = j = 0
        while True:
            (a, a_ends), (b, b_ends) = right[i], left[j]
            across = self._rank.get(a + b, inf)
            if across < a_ends and across <= b_ends and across < inf:
                return False
            if a_ends == b_ends == inf:
                return True
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1

    def encode(self, text: str) -> list[int]:
        """The tokens of a text of known characters."""
        size, pairs, tokens = len(self.tokens), self._pairs, self.tokens
        last = array("i", [-1]) * (len(text) + 1)
        for end, (token, length) in self._automaton.iter(text):
            before = last[end + 1 - length]
            if before >= 0:
                key = before * size + token
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= MOST_PAIRS:
                        pairs.clear()
                    fits = pairs[key] = self.compatible(tokens[before], tokens[token])
                if not fits:
                    continue
            elif end + 1 > length:
                raise ValueError("a prefix has no last token")
            if last[end + 1] >= 0:
                raise ValueError("a prefix has two last tokens")
            last[end + 1] = token
        found, end = [], len(text)
        while end:
            found.append(last[end])
            end -= self._lengths[last[end]]
        return found[::-1]


class PieceCodec:
    """Encoder and decoder of one SentencePiece BPE model."""

    def __init__(self, model_path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = read_model(model_path)
        trainer, norm = model.trainer_spec, model.normalizer_spec
        kinds = pb.ModelProto.SentencePiece
        if trainer.model_type != pb.TrainerSpec.BPE or not trainer.byte_fallback or trainer.treat_whitespace_as_suffix:
            raise ValueError("only BPE models with byte fallback and leading spaces are supported")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not (
            norm.escape_whitespaces and norm.add_dummy_prefix
        ):
            raise ValueError("only models that leave texts as they are, with a space before them and spaces escaped, are supported")
        if {p.type for p in model.pieces} - {kinds.NORMAL, kinds.UNKNOWN, kinds.CONTROL, kinds.BYTE}:
            raise ValueError("user defined and unused pieces are not supported")
        self._byte_ids = [0] * 256
        normal: dict[str, int] = {}
        surfaces = []
        for i, piece in enumerate(model.pieces):
            surface = b""
            if piece.type == kinds.NORMAL:
                normal[piece.piece] = i
                surface = piece.piece.replace(SPACE, " ").encode()
            elif piece.type == kinds.BYTE:
                surface = bytes([int(piece.piece[3:5], 16)])
                self._byte_ids[surface[0]] = i
            elif piece.type == kinds.UNKNOWN:
                surface = (trainer.unk_surface or UNKNOWN_SURFACE).encode()
            surfaces.append(surface)
        self.bos_id, self.eos_id = trainer.bos_id, trainer.eos_id
        self._is_control = np.array([p.type == kinds.CONTROL for p in model.pieces])
        self._is_byte = np.array([p.type == kinds.BYTE for p in model.pieces])
        self._starts_spaced = np.array([p.type == kinds.NORMAL and p.piece[0] == SPACE for p in model.pieces])
        self._lengths = np.array([len(s) for s in surfaces], np.int64)
        self._starts = np.cumsum(self._lengths) - self._lengths
        self._bytes = np.frombuffer(b"".join(surfaces), np.uint8)
        check_cuts(normal)
        vocabulary = Vocabulary({piece: model.pieces[i].score for piece, i in normal.items()})
        self._vocabulary = vocabulary
        # Characters without a piece of their own may be parts of pieces; alone they are bytes.
        self._ids_of = [
            [normal[piece]] if piece in normal else [self._byte_ids[b] for b in piece.encode()]
            for piece in vocabulary.tokens
        ]
        known = "".join(map(re.escape, sorted(vocabulary.alphabet)))
        self._unknown = re.compile(f"([^{known}]+)")
        self._memo = Memo(self._encode_chunks, capacity_bytes=CACHE_BYTES)

    def _encode_chunk(self, chunk: str) -> list[int]:
        ids: list[int] = []
        for n, part in enumerate(self._unknown.split(chunk.replace(" ", SPACE))):
            if n % 2:
                ids += [self._byte_ids[b] for b in part.encode()]
            else:
                for token in self._vocabulary.encode(part):
                    ids += self._ids_of[token]
        return ids

    def _encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        return [np.array(self._encode_chunk(chunk.decode()), "<u4").tobytes() for chunk in chunks]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, begin and end included, as little-endian unsigned 32-bit integers."""
        plain = plain_texts(texts) & ~holds(texts, SPACE)
        spaced = pc.binary_join_element_wise(" ", texts, "")
        chunks = chunks_of(spaced, plain, spaced_chunks)
        begin, end = (np.array([i], "<u4").tobytes() for i in (self.bos_id, self.eos_id))
        return [begin + ids + end for ids in chunks.join(self._memo.values_of(chunks.distinct), 4)]

    def decode(self, encoded: bytes) -> str:
        """The text of ids as the library's decode gives it: control ids vanish, a first space too."""
        given = np.frombuffer(encoded, "<u4")
        places = np.flatnonzero(~self._is_control[given])
        if not len(places):
            return ""
        ids = given[places]
        lengths = self._lengths[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self._starts[ids] - (ends - lengths), lengths)
        raw = self._bytes[shift + np.arange(ends[-1])].tobytes()
        first = 1 if self._starts_spaced[ids[0]] else 0
        if places[-1] - places[0] + 1 == len(places):
            try:
                return raw[first:].decode()
            except UnicodeDecodeError:
                pass
        return self._decode_runs(places, ids, raw, ends)[first:]

    def _decode_runs(self, places: np.ndarray, ids: np.ndarray, raw: bytes, ends: np.ndarray) -> str:
        """Like decoding everything, but each run of byte pieces alone, wrong bytes one by one."""
        runs = np.flatnonzero(np.diff(self._is_byte[ids]) | (np.diff(places) > 1)) + 1
        out = []
        for run in np.split(np.arange(len(ids)), runs):
            part = raw[ends[run[0]] - self._lengths[ids[run[0]]] : ends[run[-1]]]
            while part:
                for width in range(1, 5) if self._is_byte[ids[run[0]]] else (len(part),):
                    try:
                        out.append(part[:width].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    width = 1
                    out.append("�")
                part = part[width:]
        return "".join(out)


@lru_cache(maxsize=2)
def _codec(model_path: str) -> PieceCodec:
    return PieceCodec(model_path)


def encoded_texts(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, the ids (little-endian unsigned 32-bit integers, begin and end included) and the decoded text."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_path)
        for batch in batches:
            for rows, texts in text_slices(batch):
                ids = codec.encode(texts)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": rows.column("doc_id"),
                        "ids": pa.array(ids, pa.binary()),
                        "decoded": pa.array([codec.decode(x) for x in ids], pa.string()),
                    }
                )

    given = shipped(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return given.mapInArrow(code, "doc_id long, ids binary, decoded string")


def encode_and_decode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the text they decode to."""
    return encoded_texts(docs, model_path).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
