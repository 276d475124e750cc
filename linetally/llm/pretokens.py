"""Cutting texts into chunks that tokenize on their own, and caches of what chunks give.

The patterns and merges of the tokenizers used here never reach across a single space or line
end that has something else than white space on both sides.  Cutting there turns a text into
chunks (a word with its punctuation and the space before it), most of which occur again and
again, so that a tokenizer has to see each chunk once per worker.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A control character to cut at; texts that hold it take the slow cut.
MARK = "\x01"
# All white space but space and line end, single characters that Python or Unicode call so.
OTHER_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_BEFORE_WORD = re.compile(r"(?<=\S)(?= \S)")
CHARS_AT_ONCE = 8_000_000
LONG_CHUNK = 512
ENTRY_BYTES = 180
STOPS = (".", ",")


def holds(texts: pa.Array, pattern: str) -> np.ndarray:
    """For each text whether a regular expression is found in it."""
    return pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False).astype(bool)


def plain_texts(texts: pa.Array) -> np.ndarray:
    """For each text whether it has any characters, and its white space is only spaces and line ends
    that stand alone between other characters."""
    return ~holds(texts, f"^$|[ \n][ \n]|^[ \n]|[ \n]$|[{MARK}{''.join(OTHER_SPACES)}]")


@dataclass
class Chunks:
    """The chunks of some texts: text i has distinct[index[k]] for k from bounds[i] to bounds[i + 1]."""

    distinct: list[bytes]
    index: np.ndarray
    bounds: np.ndarray

    def join(self, values: list[bytes], width: int) -> list[bytes]:
        """For each text the values of its chunks, given per distinct chunk, in one.

        Values are numbers of ``width`` bytes.
        """
        lengths = np.fromiter(map(len, values), np.int64, len(values)) // width
        numbers = np.frombuffer(b"".join(values), f"<u{width}")
        starts = np.cumsum(lengths) - lengths
        own = lengths[self.index]
        ends = np.concatenate([[0], np.cumsum(own)])
        shift = np.repeat(starts[self.index] - ends[:-1], own)
        raw = numbers[np.arange(ends[-1]) + shift].tobytes()
        cuts = (ends[self.bounds] * width).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def sum(self, values: list[int]) -> np.ndarray:
        """For each text the sum of its chunks' values, given per distinct chunk."""
        sums = np.concatenate([[0], np.cumsum(np.array(values, np.int64)[self.index])])
        return np.diff(sums[self.bounds])


def _plain_lists(texts: pa.Array, stops: bool) -> pa.ListArray:
    """The chunks of plain texts: line ends, and words with the space before them."""
    marked = pc.replace_substring(texts, "\n", f"{MARK}\n{MARK}")
    marked = pc.replace_substring(marked, " ", f"{MARK} ")
    for stop in STOPS if stops else ():
        marked = pc.replace_substring(marked, f"{stop}{MARK}", f"{MARK}{stop}{MARK}")
    return pc.split_pattern(marked, MARK)


def stops_follow_words(texts: pa.Array) -> np.ndarray:
    """For each text whether every stop before a space or line end stands behind a letter or digit."""
    return ~holds(texts, r"(?:^|[^\pL\pN])[.,][ \n]")


def chunks_of(texts: pa.Array, plain: np.ndarray, others: Callable[[str], list[str]], stops: bool = False) -> Chunks:
    """The chunks of texts; ``others`` cuts those that are not marked as plain.

    With ``stops``, a full stop or comma at the end of a plain text's word is a chunk of its own.
    """
    lists = _plain_lists(texts.filter(pa.array(plain)), stops)
    if not plain.all():
        slow = [others(text) for text in texts.filter(pa.array(~plain)).to_pylist()]
        lists = pa.concat_arrays([lists, pa.array(slow, pa.list_(pa.string()))])
        lists = lists.take(pa.array(np.argsort(np.argsort(~plain, kind="stable"))))
    flat = lists.flatten().dictionary_encode()
    words = flat.dictionary
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].tolist()
    data = words.buffers()[2].to_pybytes() if words.buffers()[2] else b""
    distinct = [data[a:b] for a, b in zip(ends, ends[1:])]
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    return Chunks(distinct, flat.indices.to_numpy(), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64))


def cut(text: str) -> list[str]:
    """The chunks of any text; joined they give the text again."""
    return _BEFORE_WORD.split(text) if text else []


def all_chunks(texts: pa.Array) -> Chunks:
    """The chunks of any texts."""
    return chunks_of(texts, plain_texts(texts), cut)


class Memo(dict):
    """What chunks give (never None), up to ``capacity`` of them and ``capacity_bytes`` beside the fixed ones.

    ``make`` gets a list of new chunks and returns what each gives.  A full memo goes back to
    the fixed entries and the older half of the others, as frequent chunks come early; chunks of
    more than ``LONG_CHUNK`` bytes are not kept, as they hardly come again.  So its memory is bounded
    whatever the texts look like, and no result depends on what it holds.
    """

    def __init__(
        self,
        make: Callable[[list[bytes]], list],
        capacity: int = 1_000_000,
        fixed: dict | None = None,
        capacity_bytes: int = 128_000_000,
    ):
        super().__init__(fixed or {})
        self._make, self._fixed, self._capacity = make, dict(fixed or {}), capacity
        self._capacity_bytes, self._bytes = capacity_bytes, 0

    def _shrink(self) -> None:
        kept = dict(islice(self.items(), len(self._fixed) + (len(self) - len(self._fixed)) // 2))
        self.clear()
        self.update(kept)
        self._bytes = self._weight(kept.keys() - self._fixed.keys(), kept)

    @staticmethod
    def _weight(chunks: Iterable[bytes], values: dict[bytes, object]) -> int:
        """About the bytes that entries take, with those of their objects and places."""
        chunks = list(chunks)
        own = [value for value in map(values.__getitem__, chunks) if type(value) is bytes]
        return ENTRY_BYTES * len(chunks) + sum(map(len, chunks)) + sum(map(len, own))

    def values_of(self, distinct: list[bytes]) -> list:
        """What each of some distinct chunks gives."""
        while len(self) > len(self._fixed) + self._capacity or self._bytes > self._capacity_bytes:
            self._shrink()
        found = list(map(self.get, distinct))
        gaps = [k for k, value in enumerate(found) if value is None]
        if gaps:
            new = list(map(distinct.__getitem__, gaps))
            made = self._make(new)
            for k, value in zip(gaps, made, strict=True):
                found[k] = value
            if max(map(len, new)) > LONG_CHUNK:
                some = {chunk: value for chunk, value in zip(new, made, strict=True) if len(chunk) <= LONG_CHUNK}
            else:
                some = dict(zip(new, made, strict=True))
            self.update(some)
            self._bytes += self._weight(some, some)
        return found


def text_slices(batch: pa.RecordBatch, chars: int = CHARS_AT_ONCE) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """A batch in parts of about so many bytes of text each, with their texts, null as empty."""
    texts = pc.fill_null(batch.column("text"), "")
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + chars, "right")))
        yield batch.slice(start, end - start), texts.slice(start, end - start)
        start = end
