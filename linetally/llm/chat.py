"""Formatting conversations with any chat template, turn by turn.

The template is a function from a list of turns to a text; nothing else is known of it.  Each
conversation is rendered for its first turn, its first two, and so on.  Where a rendering begins
with the one before, the rest is the new turn's span; where it does not, the template rewrites
history, and the turn is marked.  Rendering a turn with two different one-letter texts shows
where inside the span its text stands, which gives the loss mask of assistant turns.

A conversation is read as a stream.  Every turn is rendered after the whole prefix, whose turns
are held; the work grows with the square of the turns, and memory with the conversation's text.
As a turn's span depends on its prefix alone, the turns of a long conversation are dealt over tasks
in blocks of ``BLOCK_TURNS``, each with all turns before it.
``conversation_digests`` renders whole prefixes at any length.  For a template that looks at no more than
the first ``HEAD_TURNS`` and the last ``TAIL_TURNS`` turns, callers may declare so with a
``window``: after so many turns the prefix is shortened to those, provided that the next turn
renders to the same span after the short prefix as after the long one, and memory and work per
turn stay bounded.  That one turn proves nothing about later ones, so the window is the caller's
word; nothing in this package gives it.

Defined cases: a null text or role is empty.  Turns with equal number follow each other by role
and text; null turn numbers come first.  Rows without conv_id form one conversation.  Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linetally.llm.workers import shipped

Turn = tuple[str, str]  # role, text
Template = Callable[[list[Turn]], str]

HEAD_TURNS, TAIL_TURNS = 2, 4
BLOCK_TURNS = 2_000
TRAINED_ROLE = "assistant"
CACHED_TURNS, CACHED_CHARS = 16_384, 2_000  # written turns that a worker keeps, and the longest text among them

# Control strings of common templates; fixed values.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>")
_STARTS = {"\\", *(control[0] for control in CONTROL)}
BEGIN, END = "<s>", "</s>\n"
_TURN = re.compile(re.escape(BEGIN) + r"(.*?)\n(.*?)" + re.escape(END), re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """The text without any control string; ``unescape`` gives it back.

    A backslash is doubled, and one is put after the first character of each control string.
    """
    if not any(start in text for start in _STARTS):
        return text
    text = text.replace("\\", "\\\\")
    for control in CONTROL:
        text = text.replace(control, f"{control[0]}\\{control[1:]}")
    return text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def escape_role(role: str) -> str:
    """A role is one line; a line end in it is written as a backslash and n."""
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


def marked_turn(turn: Turn) -> str:
    role, text = turn
    return f"{BEGIN}{escape_role(role)}\n{escape(text)}{END}"


_kept_turn = lru_cache(CACHED_TURNS)(marked_turn)


def marked_turns(turns: list[Turn]) -> str:
    """The production template: each turn between markers, its role on the first line.

    All turns are written again for every prefix, so short ones come from a cache; no more than
    it holds are looked for in it, or each would drive out the next.
    """
    first, rest = turns[:CACHED_TURNS], turns[CACHED_TURNS:]
    parts = [_kept_turn(t) if len(t[0]) + len(t[1]) <= CACHED_CHARS else marked_turn(t) for t in first]
    return "".join(parts + [marked_turn(t) for t in rest])


@dataclass
class Rendered:
    """One turn's part of the output: ``mask`` is where its text stands if it is trained on."""

    role: str
    part: str
    mask: tuple[int, int] | None
    rewrites: bool


class Renderer:
    """Renders the turns of one conversation as they come.

    Without a window every prefix is whole.
    """

    def __init__(self, template: Template, trained_role: str = TRAINED_ROLE, window: int | None = None):
        self._template, self._trained, self._window = template, trained_role, window
        self._turns: list[Turn] = []
        self._so_far: str | None = "" if window == 0 else template([])
        self._next_cut = window

    def _span(self, turns: list[Turn], before: str, turn: Turn) -> tuple[str, bool]:
        after = self._template([*turns, turn])
        if after.startswith(before):
            return after[len(before) :], False
        same = next(i for i, (a, b) in enumerate(zip(before + "\0", after + "\1")) if a != b)
        return after[same:], True

    def _text_place(self, turn: Turn, part: str) -> tuple[int, int]:
        a, b = (self._span(self._turns, self._so_far, (turn[0], letter))[0] for letter in "AB")
        head = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return head, len(part) - max(0, len(a) - head - 1)

    def _shorten(self, turn: Turn, part: str) -> None:
        short = [*self._turns[:HEAD_TURNS], *self._turns[HEAD_TURNS:][-TAIL_TURNS:]]
        before = self._template(short)
        if self._span(short, before, turn) == (part, False):
            self._turns, self._so_far = short, before
        self._next_cut = len(self._turns) + self._window

    def follow(self, turn: Turn) -> None:
        """Takes a turn of the prefix that is rendered elsewhere."""
        self._turns.append(turn)
        self._so_far = None

    def add(self, turn: Turn) -> Rendered:
        if self._so_far is None:
            self._so_far = self._template(self._turns)
        part, rewrites = self._span(self._turns, self._so_far, turn)
        mask = self._text_place(turn, part) if turn[0] == self._trained and not rewrites else None
        if self._window is not None and len(self._turns) >= self._next_cut and not rewrites:
            self._shorten(turn, part)
        self._turns.append(turn)
        self._so_far = self._template(self._turns) if rewrites else self._so_far + part
        return Rendered(turn[0], part, mask, rewrites)


RENDERED = "conv_id long, place long, part string, mask_start int, mask_end int, rewrites boolean"


def rendered_turns(
    conversations: DataFrame,
    template: Template = marked_turns,
    window: int | None = None,
    block_turns: int = BLOCK_TURNS,
) -> DataFrame:
    """One row per turn, in order within each conversation: its part of the output and its mask.

    A ``window`` declares that the template looks back a bounded way, as the module says; then no
    conversation is dealt over tasks.
    """

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, renderer = object(), Renderer(template, window=window)
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if (row["conv_id"], row["block"]) != current:
                    current, renderer = (row["conv_id"], row["block"]), Renderer(template, window=window)
                if row["place"] < row["block"] * block_turns:
                    renderer.follow((row["role"], row["text"]))
                    continue
                turn = renderer.add((row["role"], row["text"]))
                start, end = turn.mask or (None, None)
                rows.append((row["conv_id"], row["place"], turn.part, start, end, turn.rewrites))
            names = ["conv_id", "place", "part", "mask_start", "mask_end", "rewrites"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.bool_()]
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

    order = ["turn", "role", "text"]
    own = Window.partitionBy("conv_id")
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    placed = shipped(turns).withColumn("place", F.row_number().over(own.orderBy(*order)).cast("long") - 1)
    if window is not None:
        one = placed.withColumn("block", F.lit(0).cast("long"))
        return one.sortWithinPartitions("conv_id", *order).mapInArrow(render, RENDERED)

    placed = placed.withColumn("last", F.count(F.lit(1)).over(own) - 1)
    short = placed.where(F.col("last") < block_turns).withColumn("block", F.lit(0).cast("long"))
    blocks = F.sequence(F.floor(F.col("place") / block_turns), F.floor(F.col("last") / block_turns))
    # A number of partitions, as blocks are small for the work that they make.
    partitions = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (
        placed.where(F.col("last") >= block_turns)
        .select("conv_id", "role", "text", "place", F.explode(blocks).alias("block"))
        .repartition(partitions, "conv_id", "block")
        .sortWithinPartitions("conv_id", "block", "place")
        .mapInArrow(render, RENDERED)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "place")
    )
    return short.sortWithinPartitions("conv_id", *order).mapInArrow(render, RENDERED).unionByName(dealt)


class Reader:
    """Reads the production template's output of one conversation back, part by part."""

    def __init__(self) -> None:
        self._turns, self._loss = hashlib.sha256(), hashlib.sha256()
        self._rest = ""
        self.n_turns = self.loss_chars = self.formatted_chars = self.rewrites = 0

    def add(self, part: str, mask: tuple[int, int] | None, rewrites: bool) -> None:
        self.formatted_chars += len(part)
        self.rewrites += rewrites
        self._rest += part
        at = 0
        for found in _TURN.finditer(self._rest):
            role, text = unescape_role(found[1]), unescape(found[2])
            self._turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
            at = found.end()
        self._rest = self._rest[at:]
        if mask:
            trained = unescape(part[mask[0] : mask[1]])
            self._loss.update(trained.encode())
            self.loss_chars += len(trained)

    def row(self, conv_id: int | None) -> tuple:
        return (
            conv_id,
            self.n_turns,
            self._turns.hexdigest(),
            self.loss_chars,
            self._loss.hexdigest(),
            self.formatted_chars,
            self.rewrites,
        )


def conversation_digests(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Per conversation what its formatted output, read back, holds.

    Every turn is rendered after its whole prefix, so a rewritten turn is found wherever it stands.
    Digests of a whole conversation are sequential by nature; they are taken from the stream of
    its turns.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_rewrites"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

        current, reader = None, None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if row["place"] == 0:
                    if reader:
                        done.append(reader.row(current))
                    current, reader = row["conv_id"], Reader()
                mask = None if row["mask_start"] is None else (row["mask_start"], row["mask_end"])
                reader.add(row["part"], mask, row["rewrites"])
            yield table(done)
        if reader:
            yield table([reader.row(current)])

    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, n_rewrites long"
    )
    return rendered_turns(conversations, marked_turns, block_turns=block_turns).mapInArrow(read, schema)
