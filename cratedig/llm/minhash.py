"""Near-duplicate classes by MinHash with tensored banding, and exact verification.

A table key of classic banding needs its own minhashes. Here two collections of
``groups`` short minhash tuples are computed, and each *pair* of a tuple from
the first and one from the second forms the key of a table: groups ** 2 tables
from 2 * groups tuples, so the hashes computed grow with the square root of
those used. With 12 groups of 3 a pair at similarity 0.8 misses all 144 tables
with probability 2 * 0.488 ** 12, under 0.0004, one at 0.9 under 1e-6; a pair
at 0.3 meets in some table with probability 0.08, one at 0.1 with 0.0002.

Documents with equal shingle sets, by 128 bits of hash, are one node. Of a bucket,
only the pairs with its lead are verified at first. Once these links have made
classes, the buckets of one lead that still hold several classes compare the
nodes outside the largest with all those of other classes, blocks with blocks.
Copies that are linked already are never compared with each other, so a group
costs its size times the nodes that stay apart, not its square, and no cap
drops a candidate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratedig.llm._util import LOWER, NO_ID, NOT_BLANK, column_bytes, connected_components, mix, prefix_hash, row_chunks, save, span_hash, unused, word_spans

SIMILARITY = 0.8
WORDS = 2
GROUPS = 12
_TUPLE = 3
#: Tasks that one lead's nodes are dealt to at most, and nodes whose keys one task makes.
_SALTS = 64
_NODES = 20_000
_CHUNK = 1 << 19
_rng = np.random.default_rng(7)
_ODD = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_SALT = _rng.integers(1, 2**63, 256, dtype=np.uint64)


def shingle_sets(buf: np.ndarray, offs: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each row's distinct shingles, in that order; fewer words than ``words`` make one shingle."""
    buf = LOWER[buf]
    starts, ends, row = word_spans(buf, offs, NOT_BLANK)
    word = span_hash(prefix_hash(buf), starts, ends)
    counts = np.bincount(row, minlength=len(offs) - 1)
    first = np.cumsum(counts) - counts
    rank = np.arange(len(row)) - first[row]
    takes = np.minimum(counts, words)[row]
    head = rank + takes <= counts[row]
    head &= (counts[row] >= words) | (rank == 0)
    at = np.flatnonzero(head)
    out = mix(takes[at].astype(np.uint64) + _SALT[0])
    for k in range(words):
        more = k < takes[at]
        out = np.where(more, mix(out * np.uint64(3) + word[np.minimum(at + k, len(word) - 1)]), out)
    row = row[at]
    order = np.lexsort((out, row))
    row, out = row[order], out[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (out[1:] != out[:-1])
    return row[new], out[new]


def _sketch(words: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, offsets = column_bytes(batch.column("text"))
            for lo, hi in row_chunks(offsets, _CHUNK):
                row, hashed = shingle_sets(whole[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], words)
                size = np.bincount(row, minlength=hi - lo)
                full = np.flatnonzero(size)
                first = (np.cumsum(size) - size)[full]
                node, check = np.zeros(hi - lo, np.uint64), np.zeros(hi - lo, np.uint64)
                tuples = np.zeros((hi - lo, 2 * groups), np.uint64)
                if len(full):
                    node[full] = mix(np.add.reduceat(mix(hashed ^ _SALT[1]), first) + size[full].astype(np.uint64))
                    check[full] = np.add.reduceat(mix(hashed ^ _SALT[2]), first)
                    for k in range(2 * groups):
                        for turn in range(_TUPLE * k, _TUPLE * (k + 1)):
                            least = np.minimum.reduceat(((hashed ^ _SALT[3 + turn]) * _ODD[turn]) >> np.uint64(32), first)
                            tuples[full, k] = mix(tuples[full, k] * np.uint64(3) + least)
                lists = [pa.FixedSizeListArray.from_arrays(pa.array(tuples[:, s].copy().view(np.int64).ravel()), groups).cast(pa.list_(pa.int64())) for s in (slice(0, groups), slice(groups, None))]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "_id", "th")), pa.array(size.astype(np.int64)), pa.array(node.view(np.int64)), pa.array(check.view(np.int64)), *lists],
                    names=["doc_id", "_id", "th", "n_shingles", "set", "check", "one", "two"],
                )

    return run


def _confirm(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, left_offs = column_bytes(batch.column("text_a"))
            right, right_offs = column_bytes(batch.column("text_b"))
            keep = []
            for lo, hi in row_chunks(left_offs + right_offs, 2 * _CHUNK):
                sides = [shingle_sets(x[o[lo] : o[hi]], o[lo : hi + 1] - o[lo], words) for x, o in ((left, left_offs), (right, right_offs))]
                row, hashed = (np.concatenate(x) for x in zip(*sides, strict=True))
                order = np.lexsort((hashed, row))
                row, hashed = row[order], hashed[order]
                twice = (row[1:] == row[:-1]) & (hashed[1:] == hashed[:-1])
                both = np.bincount(row[1:][twice], minlength=hi - lo)
                union = np.bincount(row, minlength=hi - lo) - both
                keep.append((100 * both >= percent * union) & (both > 0))
            mask = pa.array(np.concatenate(keep)) if keep else pa.array([], pa.bool_())
            yield batch.select(["a", "b"]).filter(mask)

    return run


def _side(items: list[dict], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw = [(x["text"] or "").encode() for x in items]
    offs = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    row, hashed = shingle_sets(np.frombuffer(b"".join(raw), np.uint8), offs, words)
    node, comp = (np.array([x[k] for x in items], np.int64) for k in ("node", "comp"))
    return row, hashed, np.bincount(row, minlength=len(items)), node, comp


def _cross(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[np.ndarray] = []
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                row_a, hash_a, size_a, node_a, comp_a = _side(left.as_py(), words)
                row_b, hash_b, size_b, node_b, comp_b = _side(right.as_py(), words)
                shared = np.intersect1d(hash_a, hash_b)
                both = np.zeros((len(node_a), len(node_b)), np.int64)
                for lo in range(0, len(shared), 8192):
                    part = shared[lo : lo + 8192]
                    grids = []
                    for row, hashed, n in ((row_a, hash_a, len(node_a)), (row_b, hash_b, len(node_b))):
                        at = np.minimum(np.searchsorted(part, hashed), len(part) - 1)
                        hit = part[at] == hashed
                        grid = np.zeros((n, len(part)), np.float32)
                        grid[row[hit], at[hit]] = 1
                        grids.append(grid)
                    both += np.rint(grids[0] @ grids[1].T).astype(np.int64)
                union = size_a[:, None] + size_b[None, :] - both
                i, j = np.nonzero((100 * both >= percent * union) & (both > 0) & (comp_a[:, None] != comp_b[None, :]))
                found.append(np.stack([node_a[i], node_b[j]]))
            out = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(*out)), pa.array(np.maximum(*out))], names=["a", "b"])

    return run


def _salted(leads: DataFrame) -> DataFrame:
    return leads.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))


class _Verifier:
    """Verifies pairs of nodes on the full shingle sets of their texts."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, words: int, similarity: float):
        self.docs, self.nodes, self.words, self.percent = docs, nodes, words, round(100 * similarity)

    def texts(self, nodes: DataFrame) -> DataFrame:
        where = nodes.distinct().join(self.nodes, "node").select("node", "one_doc.*")
        return save(self.docs.join(where, ["_id", "th"]).groupBy("node").agg(F.first("text").alias("text")), "texts")

    def stars(self, groups: DataFrame) -> DataFrame:
        """The links (a, b) among pairs of lead and node."""
        side = lambda s: self.nodes.select(F.col("node").alias(s), F.col("n_shingles").alias(f"n_{s}"))
        near = groups.select(F.col("lead").alias("a"), F.col("node").alias("b")).join(side("a"), "a").join(side("b"), "b")
        # sets of too different a size can't be that similar
        near = save(near.where(100 * F.least("n_a", "n_b") >= self.percent * F.greatest("n_a", "n_b")).select("a", "b"), "pairs")
        texts = self.texts(near.select(F.col("a").alias("node")).union(near.select("b")))
        full = near.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        return save(full.select("a", "b", "text_a", "text_b").mapInArrow(_confirm(self.words, self.percent), "a long, b long"), "links")

    def blocks(self, live: DataFrame) -> DataFrame:
        """The links between classes within each lead's group; ``live``: lead, salt, node, comp, n_shingles, top.

        Nodes outside the largest class ``top`` are compared with all of other
        classes, blocks with blocks, so no pair is a row and no group is one task.
        """
        count = lambda size, words: F.ceil(F.greatest(F.count("*") / size, F.sum("n_shingles") / words)).cast("int")
        outside = live.where("comp <> top")
        counts = live.groupBy("lead").agg(count(256, 1 << 16).alias("blocks")).join(outside.groupBy("lead").agg(count(64, 1 << 14).alias("parts")), "lead")
        counts = _salted(counts)
        texts = self.texts(live.select("node"))
        item = F.collect_list(F.struct("node", "comp", "text"))
        deal = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
        right = live.join(counts, ["lead", "salt"]).join(texts, "node").groupBy("lead", deal("blocks").alias("block")).agg(item.alias("right"))
        left = outside.join(counts, ["lead", "salt"]).join(texts, "node").groupBy("lead", "blocks", deal("parts").alias("part")).agg(item.alias("left"))
        left = left.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        pairs = left.join(right, ["lead", "block"]).select("left", "right")
        return save(pairs.mapInArrow(_cross(self.words, self.percent), "a long, b long"), "links")


def _classes(buckets: DataFrame, nodes: DataFrame, verify: _Verifier) -> DataFrame:
    """(node, comp) of all nodes that some bucket links; ``buckets``: key, node, n of all buckets of several nodes.

    A bucket's lead is the node that meets most others in all its buckets: of
    edited copies, likely the one that is nearest to all.
    """
    weight = buckets.groupBy("node").agg(F.sum("n").alias("weight"))
    leads = buckets.join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", "node"))["node"].alias("lead"))
    groups = save(buckets.join(leads, "key").where("node <> lead").select("lead", "node").distinct(), "groups")
    comps = save(connected_components(verify.stars(groups)), "classes")
    live = groups.join(comps, "node", "left").select("lead", "node", F.coalesce("comp", "node").alias("comp"))
    sizes = live.groupBy("lead", "comp").agg(F.count("*").alias("c"))
    mixed = sizes.groupBy("lead").agg(F.max(F.struct("c", "comp"))["comp"].alias("top"), F.count("*").alias("k")).where("k > 1").select("lead", "top")
    # a lead of very many nodes is dealt to several tasks
    live = live.withColumn("salt", F.pmod(F.hash("node"), F.lit(_SALTS))).join(_salted(mixed), ["lead", "salt"])
    live = save(live.join(nodes.select("node", "n_shingles"), "node"), "live")
    links = verify.blocks(live)
    # classes are nodes of their own graph now
    of = lambda s: comps.select(F.col("node").alias(s), F.col("comp").alias(f"c{s}"))
    edges = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    merged = save(connected_components(edges).select(F.col("node").alias("comp"), F.col("comp").alias("into")), "merged")
    known = comps.join(merged, "comp", "left").select("node", F.coalesce("into", "comp").alias("comp"))
    new = merged.join(comps, merged["comp"] == comps["node"], "left_anti").select(F.col("comp").alias("node"), F.col("into").alias("comp"))
    return known.union(new).distinct()


def _classified(documents: DataFrame, similarity: float = SIMILARITY, words: int = WORDS, groups: int = GROUPS) -> DataFrame:
    """``near_duplicates`` and ``survives``: the row stands for its class, that of the smallest (doc_id, th), null ids last."""
    if not 0 < similarity <= 1 or words < 1 or groups < 1 or 2 * groups * _TUPLE > 250:
        raise ValueError("similarity lies in (0, 1], words and groups are at least 1, groups at most 41")
    docs = with_row_key(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    sets = save(docs.mapInArrow(_sketch(words, groups), "doc_id long, _id long, th long, n_shingles long, set long, check long, one array<long>, two array<long>"), "sets")
    nodes = save(
        sets.where("n_shingles > 0").groupBy("set", "check").agg(F.min("doc_id").alias("least"), F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "_id", "th")).alias("one_doc"), F.first("n_shingles").alias("n_shingles"), F.first("one").alias("one"), F.first("two").alias("two")).withColumn("node", F.monotonically_increasing_id()), "nodes"
    )
    # a node makes many keys, so tasks are measured by those
    dealt = nodes.repartition(max(1, -(-nodes.count() // _NODES)), "node")
    keys = dealt.select("node", "two", F.posexplode("one").alias("i", "x")).select("node", "i", "x", F.posexplode("two").alias("j", "y")).select("node", F.xxhash64("i", "j", "x", "y").alias("key"))
    full = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = save(keys.join(full, "key"), "buckets")
    classes = save(_classes(buckets, nodes, _Verifier(docs, nodes, words, similarity)), "classes")
    least = nodes.select("node", "set", "check", "least", "one_doc").join(classes, "node", "left").select("set", "check", "least", "one_doc", F.coalesce("comp", "node").alias("comp"))
    least = save(least, "least")
    per = least.groupBy("comp").agg(F.min("least").alias("component_id"), F.min("one_doc").alias("survivor"))
    named = least.join(per, "comp").select("set", "check", "component_id", "survivor")
    rows = sets.select("doc_id", "_id", "th", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("set")).alias("set"), "check").join(named, ["set", "check"], "left")
    own = F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    survives = F.col("set").isNull() | ((F.col("survivor._id") == F.col("_id")) & (F.col("survivor.th") == F.col("th")))
    return rows.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"), "_id", "th", survives.alias("survives"))


def near_duplicates(documents: DataFrame, **parameters) -> DataFrame:
    """Per row of ``documents``: doc_id, n_shingles, component_id, kept, and the row key (_id, th).

    Rows are linked at ``similarity`` of their sets of distinct ``words``-word
    shingles (lower-cased, split at ASCII blanks). A null, empty or blank text
    has no shingle and is linked with nothing. component_id is the smallest
    non-null doc_id of the class (null if none); kept tells that it is the
    row's own. Equal texts, repeated rows included, are one class. Other
    columns are ignored; an empty table gives an empty result.
    """
    return _classified(documents, **parameters).drop("survives")


def with_row_key(documents: DataFrame) -> DataFrame:
    """Adds (_id, th): equal for repeated rows alone."""
    return documents.withColumns({"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "th": F.xxhash64("text")})


def drop_near_duplicates(documents: DataFrame, **parameters) -> DataFrame:
    """One row of each class: that of the smallest (doc_id, text hash), null ids last, of repeated rows one. Columns stay as they are."""
    key = unused(documents, "__id", "__th")
    gone = _classified(documents, **parameters).where(~F.col("survives")).select(F.col("_id").alias(key[0]), F.col("th").alias(key[1])).distinct()
    keyed = documents.withColumns({key[0]: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), key[1]: F.xxhash64("text")})
    return keyed.join(gone, key, "left_anti").dropDuplicates(key).select(*documents.columns)
