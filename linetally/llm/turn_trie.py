"""The prefix trie of conversations, rolled up by centroid decomposition.

Every distinct sequence of first turns is a node; the textless root is above all.  A node is named
by a 128-bit hash of its parent's name and its last turn, so that equal prefixes meet without
comparing texts.  Texts move once; afterwards rows hold names and numbers only.

Sums over subtrees come from the parent edges: a component is cut at its centroid, the node that
leaves no part with more than half of it; what the centroid's subtree holds within the component
is added to each node on the path from the centroid to the component's top; the parts go on by
themselves.  So every node takes part in a number of rounds that grows with the logarithm
of the nodes only, however deep or wide the trie is.

* Components of more than ``component_nodes`` nodes are cut by Spark, all of them in one round.
  The sizes of subtrees follow from the conversations, without a pass by depth: a node belongs
  to its smallest member, which owns one stretch of nodes down to its end.  Later rounds take the
  size of what was cut off from the nodes above.
* Smaller components are handed to tasks whole, many at a time, and cut there in the same way.

Names follow from one turn to the next, so a conversation, and a family that is rebuilt, is one stream, in bounded
memory; so are the ids that end at a node, for their digest.

Defined cases: a null role or text is empty.  Turns follow each other by number, then role and
text; null numbers come first.  Rows without conv_id belong to no conversation and are left
out.  Repeated rows are turns of their own; equal conversations share their nodes.  Empty texts are
turns, and texts of any length are hashed whole.  An empty table gives no nodes.  Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linetally.llm.store import stored
from linetally.llm.workers import shipped

ROOT = bytes(16)
COMPONENT_NODES = 1_000
FAMILY, MOST_SHARED = 5, 9
ROWS_AT_ONCE, CHARS_AT_ONCE = 10_000, 4_000_000
PIECE_BYTES = 1 << 16

TURNS = "conv_id long, depth int, role string, text string"
_TURN_TYPES = [pa.int64(), pa.int32(), pa.string(), pa.string()]
PLACES = "conv_id long, depth int, node binary, parent binary, child binary, bytes long"
_PLACE_TYPES = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
SUMS = "node binary, n_leaves long, saved_tokens long"
_SUM_TYPES = [pa.binary(), pa.int64(), pa.int64()]


def _batch(rows: list[tuple], schema: str, types: list[pa.DataType]) -> pa.RecordBatch:
    names = [column.split()[0] for column in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _clean(conversations: DataFrame) -> DataFrame:
    text_of = {name: F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text")}
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[value.alias(name) for name, value in text_of.items()],
    ).where("conv_id is not null")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """The turns of each conversation as they are, as a stream for ``trie_places``."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, depth = None, 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["conv_id"] != current:
                    current, depth = row["conv_id"], 0
                    out.append((current, 0, None, None))
                depth += 1
                out.append((current, depth, row["role"], row["text"]))
            yield _batch(out, TURNS, _TURN_TYPES)

    order = ["conv_id", "turn", "role", "text"]
    rows = shipped(_clean(conversations)).repartition("conv_id")
    return rows.sortWithinPartitions(*order).mapInArrow(number, TURNS)


def shared_turns(conv_id: int) -> int:
    """How many first turns a conversation takes from the first of its family."""
    return zlib.crc32(str(conv_id).encode()) % MOST_SHARED


def rebuilt_turns(conversations: DataFrame) -> DataFrame:
    """Conversations whose first turns are those of their family's first, as a stream for ``trie_places``.

    Conversation c takes its first h = ``shared_turns(c)`` turns from conversation c - c % 5, and
    keeps its own after its first h.  A family stands together, its first conversation in front;
    no more than that one's first eight turns are held.
    """

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, shared, current, skip, seen, depth = None, [], None, 0, 0, 0
        out, chars = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                turn = (row["role"], row["text"])
                if row["family"] != family:
                    family, shared = row["family"], []
                if row["conv_id"] != current:
                    current = row["conv_id"]
                    skip, seen = (0 if current == family else shared_turns(current)), 0
                    taken = shared[:skip]
                    out.append((current, 0, None, None))
                    out += [(current, k + 1, *t) for k, t in enumerate(taken)]
                    chars += sum(len(t[1]) for t in taken)
                    depth = len(taken)
                if current == family and len(shared) < MOST_SHARED - 1:
                    shared.append(turn)
                if seen >= skip:
                    depth += 1
                    out.append((current, depth, *turn))
                    chars += len(turn[1])
                seen += 1
                if len(out) >= ROWS_AT_ONCE or chars >= CHARS_AT_ONCE:
                    yield _batch(out, TURNS, _TURN_TYPES)
                    out, chars = [], 0
        yield _batch(out, TURNS, _TURN_TYPES)

    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    rows = _clean(conversations).withColumn("family", family).withColumn("other", F.col("family") != F.col("conv_id"))
    order = ["family", "other", "conv_id", "turn", "role", "text"]
    return shipped(rows).repartition("family").sortWithinPartitions(*order).mapInArrow(rebuild, TURNS)


def node_name(parent: bytes, role: str, text: str) -> bytes:
    role_bytes = role.encode()
    return hashlib.blake2b(b"%s%d:%s%s" % (parent, len(role_bytes), role_bytes, text.encode()), digest_size=16).digest()


def trie_places(turns: DataFrame) -> DataFrame:
    """One row per conversation and depth from 0: its node, parent and child there, the bytes of its last text.

    ``turns`` is a stream: the rows of a conversation stand together and in order, from a row of depth 0.
    """

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last place, until its child is known
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["depth"] == 0:
                    place = (row["conv_id"], 0, ROOT, None, None, 0)
                    child = None
                else:
                    parent = held[2]
                    child = node_name(parent, row["role"], row["text"])
                    place = (row["conv_id"], row["depth"], child, parent, None, len(row["text"].encode()))
                if held:
                    out.append((*held[:4], child, held[5]))
                held = place
            yield _batch(out, PLACES, _PLACE_TYPES)
        yield _batch([held] if held else [], PLACES, _PLACE_TYPES)

    return turns.mapInArrow(name, PLACES)


def roll_up(parents: list[int], values: np.ndarray) -> np.ndarray:
    """Sums over subtrees of a tree whose node 0 is its top and whose parents come before their children."""
    n = len(parents)
    sums, own = [[0] * n for _ in values], values.tolist()
    children: list[list[int]] = [[] for _ in range(n)]
    for node in range(1, n):
        children[parents[node]].append(node)
    gone, size = [False] * n, [0] * n
    tops = [0] if n else []
    while tops:
        top = tops.pop()
        members = [top]
        for node in members:
            members += [c for c in children[node] if not gone[c]]
        for node in members:
            size[node] = 1
        for node in reversed(members[1:]):
            size[parents[node]] += size[node]
        centroid = top
        while True:
            heavy = [c for c in children[centroid] if not gone[c] and 2 * size[c] > len(members)]
            if not heavy:
                break
            centroid = heavy[0]
        below = [centroid]
        for node in below:
            below += [c for c in children[node] if not gone[c]]
        path = [centroid]
        while path[-1] != top:
            path.append(parents[path[-1]])
        for value, total in zip(own, sums, strict=True):
            part = sum(value[node] for node in below)
            for node in path:
                total[node] += part
        gone[centroid] = True
        tops += [c for c in children[centroid] if not gone[c]]
        if centroid != top:
            tops.append(top)
    return np.array(sums, np.int64).reshape(len(values), n)


def _component_sums(nodes: DataFrame) -> DataFrame:
    """Sums over subtrees within components that fit a task, in a stream sorted by component and depth."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []

        def done() -> list[tuple]:
            place = {row["node"]: i for i, row in enumerate(rows)}
            parents = [place.get(row["parent"], -1) for row in rows]
            values = np.array([[row["leaf"] for row in rows], [row["saved"] for row in rows]], np.int64)
            return list(zip(place, *roll_up(parents, values).tolist(), strict=True))

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["component"] != current:
                    out += done()
                    current, rows = row["component"], []
                rows.append(row)
            yield _batch(out, SUMS, _SUM_TYPES)
        yield _batch(done(), SUMS, _SUM_TYPES)

    columns = ["component", "depth", "node", "parent", "leaf", "saved"]
    return shipped(nodes.select(*columns)).repartition("component").sortWithinPartitions("component", "depth").mapInArrow(summed, SUMS)


def _cut_large(nodes: DataFrame, paths: DataFrame, component_nodes: int) -> tuple[DataFrame, list[DataFrame]]:
    """Cuts components of more than ``component_nodes`` nodes at their centroids until there are none.

    Returns the nodes left, with their components, and what the cuts add to nodes' sums.  Nodes of small
    components take no part in further rounds.
    """
    settled, added = [], []
    while True:
        large = nodes.groupBy("component").agg(F.max("size").alias("n")).where(F.col("n") > component_nodes)
        large = stored(large, "trie-components")
        if large.isEmpty():
            return reduce(DataFrame.unionByName, [*settled, nodes]), added
        settled.append(nodes.join(large, "component", "left_anti"))
        inside = nodes.join(large, "component")
        # Nodes with more than half of a component form a path from its top; the centroid ends it.
        at = F.struct("node", "conv_id", "depth", "size")
        heavy = inside.where(F.col("size") * 2 > F.col("n")).groupBy("component")
        cuts = stored(
            heavy.agg(F.min_by(at, "size").alias("c"), F.min("depth").alias("top_depth")).select(
                "component", "top_depth", *[F.col(f"c.{x}").alias(f"cut_{x}") for x in ("node", "conv_id", "depth", "size")]
            ),
            "trie-cuts",
        )
        # Owners whose conversations pass through the centroid have the rest of their nodes below it.
        owners = inside.select("component", "conv_id").distinct().join(cuts.select("component", "cut_node"), "component")
        through = paths.select("conv_id", F.col("node").alias("cut_node"), F.col("child").alias("part"))
        below = owners.join(through, ["conv_id", "cut_node"]).select(
            "component", "conv_id", "part", F.lit(True).alias("through")
        )
        above = (
            paths.select(F.col("conv_id").alias("cut_conv_id"), F.col("depth").alias("at"), F.col("node"))
            .join(cuts, "cut_conv_id")
            .where((F.col("at") < F.col("cut_depth")) & (F.col("at") >= F.col("top_depth")))
            .select("component", "node", F.lit(True).alias("above"))
        )
        is_cut, is_below = F.col("node") == F.col("cut_node"), F.col("through") & (F.col("depth") > F.col("cut_depth"))
        sorted_out = stored(
            inside.drop("n")
            .join(cuts, "component")
            .join(below, ["component", "conv_id"], "left")
            .join(above, ["component", "node"], "left")
            .withColumn("is_cut", F.coalesce(is_cut, F.lit(False)))
            .withColumn("is_below", F.coalesce(is_below & ~F.col("is_cut"), F.lit(False)))
            .withColumn("above", F.coalesce("above", F.lit(False))),
            "trie-parts",
        )
        totals = (
            sorted_out.where("is_cut or is_below")
            .groupBy("component")
            .agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
        )
        raised = sorted_out.where("is_cut or above").select("component", "node")
        added.append(raised.join(totals, "component").select("node", "n_leaves", "saved_tokens"))
        nodes = sorted_out.where("not is_cut").select(
            "node",
            "parent",
            "conv_id",
            "depth",
            "leaf",
            "saved",
            F.when(F.col("is_below"), F.col("part")).otherwise(F.col("component")).alias("component"),
            F.when(F.col("above"), F.col("size") - F.col("cut_size")).otherwise(F.col("size")).alias("size"),
        )


def _ends(places: DataFrame) -> DataFrame:
    """The digest of the ids of the conversations that end at each node.

    Ids are first joined by ranges of them, so that a node where very many conversations end
    sends few long pieces; the digest itself is sequential and takes them as a stream.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids, size = None, None, [], 0
        for batch in batches:
            out = []
            for of, conv_id in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if of != node or size >= PIECE_BYTES:
                    if ids:
                        out.append((node, first, ",".join(ids)))
                    node, first, ids, size = of, conv_id, [], 0
                ids.append(str(conv_id))
                size += len(ids[-1]) + 1
            yield _batch(out, "node binary, first long, ids string", [pa.binary(), pa.int64(), pa.string()])
        last = [(node, first, ",".join(ids))] if ids else []
        yield _batch(last, "node binary, first long, ids string", [pa.binary(), pa.int64(), pa.string()])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for of, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if of != node:
                    if state:
                        out.append((node, state.hexdigest()))
                    node, state = of, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _batch(out, "node binary, ends_sha256 string", [pa.binary(), pa.string()])
        last = [(node, state.hexdigest())] if state else []
        yield _batch(last, "node binary, ends_sha256 string", [pa.binary(), pa.string()])

    ended = places.where("child is null").select("node", "conv_id").repartitionByRange("conv_id")
    pieces = ended.sortWithinPartitions("node", "conv_id").mapInArrow(join, "node binary, first long, ids string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, component_nodes: int = COMPONENT_NODES) -> DataFrame:
    """One row per node of the trie of a stream of turns.

    conv_id is the smallest member, parent_conv_id the parent's; n_convs counts members, n_children
    children, n_leaves childless nodes in the subtree; saved_tokens sums, over the subtree, the bytes of a
    node's last text for every member but one; ends_sha256 is the digest of the ids of the conversations
    that end there.
    """
    places = stored(trie_places(turns), "trie-places")
    nodes = places.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.max("parent").alias("parent"),
        F.count(F.lit(1)).alias("n_convs"),
        (F.count("child") == 0).cast("long").alias("leaf"),
        ((F.count(F.lit(1)) - 1) * F.max("bytes")).alias("saved"),
    )
    nodes = stored(nodes, "trie-nodes")
    owned = nodes.groupBy("conv_id").agg(F.min("depth").alias("first"), F.max("depth").alias("last"))
    paths = stored(places.join(owned, "conv_id").select("conv_id", "depth", "node", "child", "first", "last"), "trie-paths")
    stretch = F.col("last") - F.greatest("first", "depth") + 1
    sizes = paths.groupBy("node").agg(F.sum(stretch).alias("size"))
    whole = nodes.join(sizes, "node").select(
        "node", "parent", "conv_id", "depth", "leaf", "saved", F.lit(ROOT).alias("component"), "size"
    )
    left, added = _cut_large(whole, paths, component_nodes)
    facts = [
        nodes.select("node", "parent", "conv_id", "depth", "n_convs"),
        nodes.where("parent is not null").select(F.col("parent").alias("node"), F.lit(1).alias("n_children")),
        _component_sums(left),
        _ends(places),
        *added,
    ]
    together = facts[0]
    for more in facts[1:]:
        together = together.unionByName(more, allowMissingColumns=True)

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name)

    rolled = together.groupBy("node").agg(
        *[F.max(name).alias(name) for name in ("parent", "conv_id", "depth", "n_convs")],
        *[total(name) for name in ("n_children", "n_leaves", "saved_tokens")],
        F.coalesce(F.max("ends_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return rolled.join(parents, "parent", "left").select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        "ends_sha256",
    )
