"""The trie of conversation prefixes.

A conversation's prefix of d turns is named by 128 bits: the exclusive or of
hashes of its turns with their places. That is a running sum, so even one very
long conversation is summed by blocks. A count-min sketch of all prefixes says
which ones can be shared: its estimate is never too low, so an estimate of one
proves a prefix that one conversation has alone. Nodes of such tails are written
where they stand. Only prefixes that may be shared, whether they are or not, are
shuffled and grouped exactly. The sketch has a bounded size; a fuller one proves
less and groups more, with the same rows.

Sums over subtrees double their reach in every round: a node adds what nodes
2**k below it have summed, and those look 2**k further up. So long shared
chains take few rounds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratedig.llm._util import in_order, save

#: Cells of a sketch's row at most (a byte each), and its rows: all that is broadcast.
CELLS, ROWS = 1 << 22, 3
#: Cells that are sent together; bits of the places of a block of turns; characters of ids that are sent together.
PIECE, BLOCK, IDS = 1 << 16, 10, 1 << 16
NODE = ("pos", "d1", "d2")
_EMPTY = hashlib.sha256(b"").hexdigest()


def ordered_items(conversations: DataFrame) -> DataFrame:
    """(conv_id, idx, h1, h2, bytes) of each turn: its place from 0, 128 bits of its role and text, and its text's UTF-8 bytes.

    Turns go by ``turn``, null first, ties by those bits; null roles and texts
    are empty, and rows without a conv_id belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    half = lambda i: F.conv(F.substring(digest, i, 16), 16, -10).cast("long")
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), half(1).alias("h1"), half(17).alias("h2"), F.octet_length(text).cast("long").alias("bytes"))
    placed = in_order(rows, [F.col(c) for c in ("conv_id", "turn", "h1", "h2")], "place").drop("turn").withColumn("part", F.call_function("shiftright", F.col("place"), F.lit(33)))
    counts = placed.groupBy("conv_id", "part").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("conv_id", "part", (before - F.col("first")).alias("start"))
    return save(placed.join(starts, ["conv_id", "part"]).select("conv_id", (F.col("place") + F.col("start")).alias("idx"), "h1", "h2", "bytes"), "items")


def lengths(items: DataFrame) -> DataFrame:
    """(conv_id, len)."""
    return items.groupBy("conv_id").agg(F.count("*").alias("len"))


def branched(items: DataFrame, family: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that borrow their beginning: (items, lengths) of the rebuilt ones, turnless ones in the lengths.

    Conversation c begins with the first h turns of conversation c - c % family
    (as many as that has) and goes on with its own after its first h; h is the
    crc32 of c in decimal, modulo ``most``. A beginning has fewer than ``most``
    turns and goes to the few conversations of a family.
    """
    own = lengths(items)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("long")
    convs = own.select("conv_id", "len", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    convs = convs.join(own.select(F.col("conv_id").alias("base"), F.col("len").alias("there")), "base", "left")
    convs = convs.withColumn("m", F.least("h", F.coalesce("there", F.lit(0).cast("long"))))
    convs = save(convs.withColumn("total", F.col("m") + F.greatest(F.col("len") - F.col("h"), F.lit(0))).drop("there", "len"), "families")
    rest = items.join(convs.select("conv_id", "h", "m"), "conv_id").where("idx >= h").select("conv_id", (F.col("idx") - F.col("h") + F.col("m")).alias("idx"), "h1", "h2", "bytes")
    start = items.where(F.col("idx") < most - 1).withColumnRenamed("conv_id", "base").join(convs.select("base", "conv_id", "m"), "base").where("idx < m")
    return rest.unionByName(start.select("conv_id", "idx", "h1", "h2", "bytes")), convs.select("conv_id", F.col("total").alias("len"))


def prefixes(items: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, len, pos, d1, d2, p1, p2, bytes): each conversation's prefix of pos turns, named by d1 and d2, its parent by p1 and p2."""
    rows = items.join(convs, "conv_id").withColumn("pos", F.col("idx") + 1)
    rows = rows.withColumns({"g1": F.xxhash64("pos", "h1", "h2"), "g2": F.xxhash64("h2", "pos", "h1", F.lit(1)), "block": F.call_function("shiftright", F.col("pos"), F.lit(BLOCK))})
    rows = rows.drop("idx", "h1", "h2")
    sums = rows.groupBy("conv_id", "block").agg(*(F.bit_xor(g).alias(b) for g, b in (("g1", "b1"), ("g2", "b2"))))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("conv_id", "block", *(F.coalesce(F.bit_xor(b).over(earlier), F.lit(0)).alias(b) for b in ("b1", "b2")))
    within = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"r1": F.bit_xor("g1").over(within), "r2": F.bit_xor("g2").over(within)}).join(sums, ["conv_id", "block"])
    d1, d2 = (F.col(f"r{i}").bitwiseXOR(F.col(f"b{i}")) for i in (1, 2))
    return save(rows.select("conv_id", "len", "pos", d1.alias("d1"), d2.alias("d2"), d1.bitwiseXOR(F.col("g1")).alias("p1"), d2.bitwiseXOR(F.col("g2")).alias("p2"), "bytes"), "prefixes")


def _cells(batch: pa.RecordBatch, names: tuple[str, str], width: int) -> Iterator[np.ndarray]:
    """The cell of every prefix in each row of a sketch."""
    a, b = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in names)
    for r in range(ROWS):
        yield ((a + np.uint64(r) * (b | np.uint64(1))) & np.uint64(width - 1)).astype(np.int64)


def _sketched(width: int):
    """Counts up to two; more need not be told apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros((ROWS, width), np.uint8)
        for batch in batches:
            for r, cell in enumerate(_cells(batch, ("d1", "d2"), width)):
                some, n = np.unique(cell, return_counts=True)
                sketch[r, some] = np.minimum(2, sketch[r, some] + np.minimum(n, 2))
        pieces = sketch.reshape(-1, min(PIECE, width))
        some = np.flatnonzero(pieces.any(axis=1))
        for i in some:
            yield pa.RecordBatch.from_pydict({"piece": pa.array([i], pa.int32()), "cells": pa.array([pieces[i].tobytes()], pa.binary())})

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up pieces, sorted by number, one at a time."""
    held, total = None, None
    row = lambda: pa.RecordBatch.from_pydict({"piece": pa.array([held], pa.int32()), "cells": pa.array([total.tobytes()], pa.binary())})
    for batch in batches:
        for piece, cells in zip(batch.column("piece").to_pylist(), batch.column("cells").to_pylist(), strict=True):
            cells = np.frombuffer(cells, np.uint8)
            if piece == held:
                total = np.minimum(2, total + cells)
            else:
                if held is not None:
                    yield row()
                held, total = piece, cells
    if held is not None:
        yield row()


def count_min(rows: DataFrame, cells: int = CELLS) -> np.ndarray:
    """A sketch of the names (d1, d2), each row a power of two of at most ``cells``, about twice the names; counts stop at two."""
    n = rows.count()
    width = 1 << max(6, min(cells.bit_length() - 1, (2 * n).bit_length()))
    schema = "piece int, cells binary"
    parts = rows.select("d1", "d2").mapInArrow(_sketched(width), schema)
    merged = parts.repartition("piece").sortWithinPartitions("piece").mapInArrow(_merged, schema)
    sketch = np.zeros((ROWS * width // min(PIECE, width), min(PIECE, width)), np.uint8)
    for r in merged.toLocalIterator():
        sketch[r["piece"]] = np.frombuffer(r["cells"], np.uint8)
    return sketch.reshape(ROWS, width)


def _screened(sketch):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        for batch in batches:
            flags = []
            for names in (("d1", "d2"), ("p1", "p2")):
                many = np.ones(batch.num_rows, bool)
                for r, cell in enumerate(_cells(batch, names, counts.shape[1])):
                    many &= counts[r, cell] > 1
                flags.append(many)
            first = batch.column("pos").to_numpy() == 1  # the root is shared by all
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(flags[0]), pa.array(flags[1] | first)], names=[*batch.schema.names, "shared", "below"])

    return run


def _id_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id) to texts of ids of a node, of bounded length, each with its first id."""
    schema = pa.schema([("pos", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
    for batch in batches:
        keys = [batch.column(c).to_numpy() for c in NODE]
        ids = batch.column("conv_id").to_pylist()
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            change[1:] |= k[1:] != k[:-1]
        # an id has at most 20 characters
        edges, out = [*np.flatnonzero(change).tolist(), batch.num_rows], []
        at = 0
        for edge in edges:
            while at < edge:
                to = min(edge, at + IDS // 21)
                out.append((*(int(k[at]) for k in keys), ids[at], ",".join(map(str, ids[at:to]))))
                at = to
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in out], schema)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted texts of ids to one digest for each node; only the digest's state is held."""
    schema = pa.schema([("pos", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("ends_sha256", pa.string())])
    held, state = None, None
    for batch in batches:
        out = []
        for *node, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids")), strict=True):
            if node == held:
                state.update(b",")
            else:
                if held is not None:
                    out.append((*held, state.hexdigest()))
                held, state = node, hashlib.sha256()
            state.update(ids.encode())
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x, strict=True)) for x in out], schema)
    if held is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*held, state.hexdigest()), strict=True))], schema)


def _ends(members: DataFrame) -> DataFrame:
    """(pos, d1, d2, ends_sha256) of the members (pos, d1, d2, conv_id) that end at a node; many are joined in several tasks, hashed in one."""
    keys = [F.col(c) for c in NODE]
    sorted_ = members.repartitionByRange(*keys, "conv_id").sortWithinPartitions(*keys, "conv_id")
    texts = sorted_.mapInArrow(_id_texts, "pos long, d1 long, d2 long, first long, ids string")
    return texts.repartition(*keys).sortWithinPartitions(*keys, "first").mapInArrow(_hashed, "pos long, d1 long, d2 long, ends_sha256 string")


def _subtrees(nodes: DataFrame) -> DataFrame:
    """``nodes`` (pos, d1, d2, p1, p2, leaves, saved) with leaves and saved summed over their subtrees."""
    up = ("u0", "u1", "u2")
    parent = F.struct((F.col("pos") - 1).alias("u0"), F.col("p1").alias("u1"), F.col("p2").alias("u2"))
    state = nodes.select(*NODE, F.when(F.col("pos") > 0, parent).alias("up"), "leaves", "saved").select(*NODE, *(F.col(f"up.{c}").alias(c) for c in up), "leaves", "saved")
    while True:
        state = save(state, "reach")
        climbing = state.where("u0 is not null")
        if climbing.isEmpty():
            return state.select(*NODE, F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
        gains = climbing.groupBy(*(F.col(u).alias(c) for u, c in zip(up, NODE, strict=True))).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        higher = state.select(*(F.col(c).alias(u) for c, u in zip(NODE, up, strict=True)), *(F.col(u).alias(f"next{u}") for u in up))
        state = state.join(gains, list(NODE), "left").join(higher, list(up), "left")
        total = lambda c: (F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c)
        state = state.select(*NODE, *(F.col(f"next{u}").alias(u) for u in up), total("leaves"), total("saved"))


def trie_of(items: DataFrame, convs: DataFrame, cells: int = CELLS) -> DataFrame:
    """The nodes of conversations (conv_id, len) with the turns ``items``; see ``prefix_trie``."""
    rows = prefixes(items, convs)
    sketch = rows.sparkSession.sparkContext.broadcast(count_min(rows, cells))
    schema = "conv_id long, len long, pos long, d1 long, d2 long, p1 long, p2 long, bytes long, shared boolean, below boolean"
    rows = save(rows.mapInArrow(_screened(sketch), schema), "screened")
    tails, edge = rows.where("not shared"), F.col("below")
    groups = rows.where("shared").groupBy(*NODE).agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("bytes").alias("bytes"))
    zero = F.lit(0).cast("long")
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    groups = save(groups.unionByName(root.select(*(zero.alias(c) for c in (*NODE, "p1", "p2", "bytes")), "n_convs", "conv_id")), "groups")
    above = [(F.col("pos") - 1).alias("pos"), F.col("p1").alias("d1"), F.col("p2").alias("d2")]
    kids = groups.where("pos > 0").groupBy(*above).agg(F.count("*").alias("kids"))
    ends = tails.where(edge).groupBy(*above).agg(F.count("*").alias("tails"))
    nodes = groups.join(kids, list(NODE), "left").join(ends, list(NODE), "left").fillna(0, ["kids", "tails"])
    own = F.col("tails") + F.when((F.col("kids") == 0) & (F.col("tails") == 0), 1).otherwise(0)
    nodes = save(nodes.withColumns({"leaves": own, "saved": (F.col("n_convs") - 1) * F.col("bytes")}), "nodes")
    names = groups.select(*(F.col(c).alias(x) for c, x in zip(NODE, ("q", "p1", "p2"), strict=True)), F.col("conv_id").alias("parent_conv_id"))
    members = rows.where("shared and pos = len").select(*NODE, "conv_id").unionByName(convs.where("len = 0").select(*(zero.alias(c) for c in NODE), "conv_id"))
    full = nodes.join(_subtrees(nodes), list(NODE)).join(_ends(members), list(NODE), "left")
    full = full.withColumn("q", F.col("pos") - 1).join(names, ["q", "p1", "p2"], "left")
    # a prefix that only seemed shared can stand below a proven tail of the same conversation
    parent = F.when(F.col("pos") > 0, F.coalesce("parent_conv_id", "conv_id"))
    out = full.select("conv_id", F.col("pos").alias("depth"), parent.alias("parent_conv_id"), "n_convs", (F.col("kids") + F.col("tails")).alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))

    def tail(part: DataFrame, parent: Column) -> DataFrame:
        last = F.col("pos") == F.col("len")
        one = F.lit(1).cast("long")
        sha = F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(_EMPTY))
        return part.select("conv_id", F.col("pos").alias("depth"), parent.alias("parent_conv_id"), one.alias("n_convs"), F.when(last, 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"), sha.alias("ends_sha256"))

    first = root.first()
    out = out.unionByName(tail(tails.where(~edge), F.col("conv_id")))
    # all of them hang on the root, whose name is one number
    out = out.unionByName(tail(tails.where("pos = 1"), F.lit(first["conv_id"] if first else None).cast("long")))
    hanging = tails.where(edge & (F.col("pos") > 1)).withColumn("q", F.col("pos") - 1).join(names, ["q", "p1", "p2"])
    return out.unionByName(tail(hanging, F.col("parent_conv_id")))


def prefix_trie(conversations: DataFrame, cells: int = CELLS) -> DataFrame:
    """A row per distinct prefix of the conversations (conv_id, turn, role, text), from the textless root on.

    conv_id is the smallest member, a conversation that begins so; depth the
    number of turns; parent_conv_id the parent's conv_id (root: null); n_convs the
    members; n_children the children; n_leaves and saved_tokens sums over the
    subtree, of childless nodes and of (n_convs - 1) * bytes of the last text;
    ends_sha256 the digest of the members that end here, ascending, joined by
    commas. Turns go by ``turn``, null first, ties in a fixed order; null roles
    and texts are empty, repeated rows turns of their own, rows without a conv_id
    left out, other columns ignored. An empty table has no root.
    """
    items = ordered_items(conversations)
    return trie_of(items, lengths(items), cells)


def branched_trie(conversations: DataFrame, family: int = 5, most: int = 9, cells: int = CELLS) -> DataFrame:
    """``prefix_trie`` of conversations whose beginnings are borrowed within families; see ``branched``."""
    items, convs = branched(ordered_items(conversations), family, most)
    return trie_of(items, convs, cells)
