"""Repairing the turn structure of conversations at the least cost.

A repaired conversation has the roles ``(s?(ua)+)?`` by their initials: system, user, assistant.
Every row is kept (cost 0), given the role that fits (2), or deleted (3; blank and repeated rows
have to go), and empty turns of user and assistant may be inserted anywhere (2).  Rows that stay
though their text is cut off add 1.  Of all cheapest repairs the one is taken whose edit initials,
in order, come first in ASCII.

The search is depth-first branch and bound over nodes (rows read, last role) with an explicit
stack.  A lower bound of what the remaining rows cost at least, and the best repair found so far,
cut branches; a table with the best (cost, audit) that reached each node cuts prefixes that are
no better.  The search ends when the stack is empty: the incumbent is then optimal.  No audit of a
node is the beginning of another of the same cost, so a better prefix stays better whatever follows.

Conversations are read as a stream, sorted, in blocks of at most ``BLOCK_ROWS`` rows or
``BLOCK_CHARS`` characters.  After a block at most one prefix for each last role lives on; what
all of them have in common is handed out.  So memory does not grow with a conversation, and
all but the longest are one block.  Repeated rows are found beforehand by a group-by over their
digests, which spreads one conversation over all tasks; the stream of one conversation is
sequential by nature, as is the digest of its text.

Defined cases: a null role or text is one space.  Rows follow each other by turn, then role and
text; null turns come first.  Rows without conv_id form one conversation.  A conversation with no
rows has no edits and an empty result.  Rows are equal if the MD5 sums of role and text are.
Empty texts are blank; texts of any length are taken whole.  An empty table gives an empty
result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linetally.llm.workers import shipped

START, SYSTEM, USER, ASSISTANT = range(4)
ROLE_NAMES = {USER: "user", ASSISTANT: "assistant"}
DELETE, INSERT, KEEP, REROLE = "DIKR"
DELETE_COST, INSERT_COST, REROLE_COST, CUT_OFF_COST = 3, 2, 2, 1
# What any prefix needs at most to continue like any other: two inserted turns.
CATCH_UP = 2 * INSERT_COST
LEGAL = {"su", "ua", "au"}
BLOCK_ROWS, BLOCK_CHARS = 64, 4_000_000

_VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
LONG_MAX = 2**63 - 1


@dataclass(frozen=True)
class Turn:
    role: str
    text: str
    initial: str
    fault: str | None

    @classmethod
    def of(cls, role: str, text: str, repeated: bool) -> Turn:
        if not _VISIBLE.search(text):
            fault = "blank"
        elif repeated:
            fault = "duplicate"
        else:
            last = text.rstrip(" \t\n\x0b\x0c\r")[-1]
            fault = None if last in ".!?" else "truncated"
        return cls(role, text, role[:1], fault)

    @property
    def must_go(self) -> bool:
        return self.fault in ("blank", "duplicate")

    @property
    def if_kept(self) -> int:
        return CUT_OFF_COST if self.fault == "truncated" else 0


def follower(state: int) -> int:
    """The role that an inserted or renamed turn takes."""
    return ASSISTANT if state == USER else USER


def kept_state(state: int, initial: str) -> int | None:
    """The state after keeping a turn, None where it does not fit."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    return ASSISTANT if initial == "a" and state == USER else None


def lower_bounds(turns: list[Turn]) -> list[int]:
    """For each place, a cost that no repair of the turns from there on undercuts.

    Each turn costs its cheapest edit; two turns that would meet and do not fit cost an edit more.
    """
    bounds = [0] * (len(turns) + 1)
    usable: tuple[int, int] | None = None  # the next turn that can stay: its place, the cost of turns before it
    for place in reversed(range(len(turns))):
        turn = turns[place]
        if turn.must_go:
            bounds[place] = bounds[place + 1] + DELETE_COST
            usable = usable and (usable[0], usable[1] + DELETE_COST)
        elif turn.initial not in ("s", "u", "a"):
            bounds[place] = bounds[place + 1] + min(DELETE_COST, REROLE_COST + turn.if_kept)
            usable = None
        else:
            bounds[place] = bounds[place + 1] + turn.if_kept
            if usable and turn.initial + turns[usable[0]].initial not in LEGAL:
                both = turn.if_kept + INSERT_COST + usable[1] + turns[usable[0]].if_kept
                bounds[place] = max(bounds[place], both + bounds[usable[0] + 1])
            usable = (place, 0)
    return bounds


Found = tuple[int, int, str]  # cost, index of the entry it comes from, audit within the block


def search(turns: list[Turn], entries: list[tuple[int, int]], last: bool) -> dict[int, Found]:
    """The best (cost, entry, audit) for each state after the turns; with ``last`` the best of all.

    ``entries`` are (state, cost) of the prefixes before, in the order of their audits.
    """
    bounds, end = lower_bounds(turns), len(turns)
    reached: dict[tuple[int, int], Found] = {}
    done: dict[int, Found] = {}
    incumbent: Found | None = None

    def hopeless(cost: int, entry: int, audit: str, place: int) -> bool:
        if incumbent is None:
            return False
        least = cost + bounds[place]
        if not last:
            return least > incumbent[0] + CATCH_UP
        return least > incumbent[0] or (
            least == incumbent[0] and (entry, audit) > (incumbent[1], incumbent[2][: len(audit)])
        )

    starts = sorted(((cost, n, state) for n, (state, cost) in enumerate(entries)), reverse=True)
    stack = [(cost, n, "", 0, state) for cost, n, state in starts]
    while stack:
        cost, entry, audit, place, state = stack.pop()
        found, node = (cost, entry, audit), (place, state)
        if hopeless(cost, entry, audit, place) or (node in reached and reached[node] <= found):
            continue
        reached[node] = found
        if place == end:
            if not last:
                done[state] = found
            if (not last or state in (START, ASSISTANT)) and (incumbent is None or found < incumbent):
                incumbent = found
            if not last:
                continue  # turns are inserted at the start of the next block
        after = follower(state)
        branches = [(cost + INSERT_COST, entry, audit + INSERT, place, after)]
        if place < end:
            turn = turns[place]
            branches.append((cost + DELETE_COST, entry, audit + DELETE, place + 1, state))
            if not turn.must_go:
                branches.append((cost + REROLE_COST + turn.if_kept, entry, audit + REROLE, place + 1, after))
                kept = kept_state(state, turn.initial)
                if kept is not None:
                    branches.append((cost + turn.if_kept, entry, audit + KEEP, place + 1, kept))
        branches.sort(key=lambda b: (b[0] + bounds[b[3]], b[2]), reverse=True)  # the most promising is popped first
        stack.extend(branches)
    if not last:
        return {state: found for state, found in done.items() if found[0] <= incumbent[0] + CATCH_UP}
    return {ASSISTANT: incumbent}


Edit = tuple[str, str, str]  # initial of the edit, role, text


def edits(turns: list[Turn], audit: str, state: int) -> Iterator[Edit]:
    """What an audit makes of turns after a state: deleted turns as they were, others as they become."""
    place = 0
    for edit in audit:
        turn = None if edit == INSERT else turns[place]
        if edit == INSERT:
            state = follower(state)
            yield edit, ROLE_NAMES[state], ""
            continue
        if edit == REROLE:
            state = follower(state)
        elif edit == KEEP:
            state = kept_state(state, turn.initial)
        yield edit, ROLE_NAMES[state] if edit == REROLE else turn.role, turn.text
        place += 1


@dataclass
class Prefix:
    """A repair of all turns before a block; ``since`` holds its edits that are not handed out yet."""

    state: int
    cost: int
    since: list[tuple[int, list[Edit]]]  # number of the block, its edits


class Repair:
    """Repairs the turns of one conversation as they come; ``add`` and ``end`` give out settled edits."""

    def __init__(self, block_rows: int = BLOCK_ROWS):
        self._block_rows = block_rows
        self._prefixes = [Prefix(START, 0, [])]
        self._turns: list[Turn] = []
        self._chars = 0
        self._min_turn = self._max_turn = self._last_turn = None
        self._distinct = 0
        self._last_initial: str | None = None
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}

    def add(self, number: int | None, turn: Turn) -> list[Edit]:
        if number is not None:
            self._min_turn = number if self._min_turn is None else self._min_turn
            self._distinct += number != self._max_turn
            self._max_turn = number
        if turn.fault:
            self.counts[turn.fault] += 1
        if self._last_initial is not None:
            self.counts["illegal"] += self._last_initial + turn.initial not in LEGAL
        self._last_initial = turn.initial
        settled = []
        if len(self._turns) >= self._block_rows or (self._turns and self._chars + len(turn.text) > BLOCK_CHARS):
            settled = self._solve(last=False)
        self._turns.append(turn)
        self._chars += len(turn.text)
        return settled

    def end(self) -> list[Edit]:
        return self._solve(last=True)

    @property
    def gaps(self) -> int:
        if self._min_turn is None:
            return 0
        return min(self._max_turn - self._min_turn + 1 - self._distinct, LONG_MAX)

    @property
    def cost(self) -> int:
        return self._prefixes[0].cost

    def _solve(self, last: bool) -> list[Edit]:
        """Extends the prefixes over the turns held, and returns the edits that all of them share now."""
        found = search(self._turns, [(p.state, p.cost) for p in self._prefixes], last)
        grown = []
        # In the order of audits, which is that of their entries and then of their own edits.
        for state, (cost, entry, audit) in sorted(found.items(), key=lambda f: f[1][1:]):
            before = self._prefixes[entry]
            own = list(edits(self._turns, audit, before.state))
            grown.append(Prefix(state, cost, [*before.since, own]))
        self._prefixes, self._turns, self._chars = grown, [], 0
        settled: list[Edit] = []
        while grown[0].since and all(p.since and p.since[0] is grown[0].since[0] for p in grown):
            settled += grown[0].since[0]
            for p in grown:
                del p.since[0]
        return settled


REPAIRED = (
    "conv_id long, edit string, role string, text string, "
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
)
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_REPAIRED_TYPES = [pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.int64()] * len(COUNTS)]
REPORT = "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
_REPORT_TYPES = [*[pa.int64()] * (1 + len(COUNTS)), pa.string(), pa.string()]


def _batch(rows: list[tuple], schema: str, types: list[pa.DataType]) -> pa.RecordBatch:
    names = [column.split()[0] for column in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _later_repeats(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, digest) of rows seen on an earlier turn of their conversation.

    First turns combine where they are read; a row that fills a conversation is a skewed key of a plain
    join, which adaptive execution splits.
    """
    each = rows.where("present").select("conv_id", "turn", "digest").distinct()
    at = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")  # null turns come first
    firsts = each.groupBy(F.col("conv_id").alias("of_conv"), F.col("digest").alias("of_digest")).agg(
        F.min(at)["turn"].alias("first_turn"), F.count(F.lit(1)).alias("n")
    )
    same = F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("digest") == F.col("of_digest"))
    later = ~F.col("turn").eqNullSafe(F.col("first_turn"))
    return each.join(firsts.where("n > 1"), same).where(later).select("conv_id", "turn", "digest")


def repaired_turns(conversations: DataFrame, present: Column | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The edits of each conversation's cheapest repair, in order, then a row with its counts.

    A row with an ``edit`` (D, I, K or R) has the role and text that result; a deleted one those
    it had.  The last row of a conversation has no edit but its number of gaps, faults by kind and illegal
    neighbours, and the cost.  Rows of a conversation stand together in one partition.

    Rows that are not ``present`` say no more than that there is such a conversation.
    """
    text_of = {name: F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text")}
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[value.alias(name) for name, value in text_of.items()],
        F.coalesce(F.lit(True) if present is None else present, F.lit(False)).alias("present"),
    ).withColumn("digest", F.unhex(F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text"))))
    gone = ~F.col("present")
    stream = rows.select(
        "conv_id",
        "turn",
        F.when(gone, 0).otherwise(2).alias("kind"),
        *[F.when(~gone, F.col(name)).alias(name) for name in ("role", "text", "digest")],
    ).unionByName(_later_repeats(rows).withColumn("kind", F.lit(1)), allowMissingColumns=True)

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, work = object(), None
        turn_now, repeats, digest_before = None, set(), None

        def ended() -> list[tuple]:
            if work is None:
                return []
            none = (None,) * len(COUNTS)
            out = [(current, *edit, *none) for edit in work.end()]
            counts = {**work.counts, "gaps": work.gaps, "cost": work.cost}
            return [*out, (current, None, None, None, *[counts[c] for c in COUNTS])]

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["conv_id"] != current:
                    out += ended()
                    current, work, turn_now = row["conv_id"], Repair(block_rows), object()
                if row["turn"] != turn_now:
                    turn_now, repeats, digest_before = row["turn"], set(), None
                if row["kind"] == 1:
                    repeats.add(row["digest"])
                elif row["kind"] == 2:
                    repeated = row["digest"] in repeats or row["digest"] == digest_before
                    digest_before = row["digest"]
                    settled = work.add(row["turn"], Turn.of(row["role"], row["text"], repeated))
                    out += [(current, *edit, *(None,) * len(COUNTS)) for edit in settled]
            yield _batch(out, REPAIRED, _REPAIRED_TYPES)
        yield _batch(ended(), REPAIRED, _REPAIRED_TYPES)

    order = ["conv_id", "turn", "kind", "role", "text"]
    return shipped(stream).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(repair, REPAIRED)


def repair_report(conversations: DataFrame, present: Column | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per conversation its counts, cost and audit, and the digest of its repaired ``role:text`` lines."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, digest, lines = [], hashlib.sha256(), 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["edit"] is None:
                    counts = [row[name] for name in COUNTS]
                    out.append((row["conv_id"], *counts, "".join(audit), digest.hexdigest()))
                    audit, digest, lines = [], hashlib.sha256(), 0
                    continue
                audit.append(row["edit"])
                if row["edit"] != DELETE:
                    line = f"{row['role']}:{row['text']}"
                    digest.update((f"\n{line}" if lines else line).encode())
                    lines += 1
            yield _batch(out, REPORT, _REPORT_TYPES)

    return repaired_turns(conversations, present, block_rows).mapInArrow(read, REPORT)


def damaged(conversations: DataFrame) -> tuple[DataFrame, Column]:
    """Conversations with known faults, by the CRC-32 of ``conv_id:turn``, and which rows are left.

    Of 20 values 0 drops a row, 1 empties its text, 2 removes its sentence ends, 3 repeats it and 4
    makes it the user's.  Nulls count as one space.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("long").cast("string"), space) for c in ("conv_id", "turn")])
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    fault = F.col("fault")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("fault"),
    )
    return rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        "fault",
        F.explode(F.sequence(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("again"),
    ).drop("again"), fault != 0
