"""Exact substring removal with a sparse, range-partitioned suffix array.

Every byte covered by a string of ``length`` bytes that also starts elsewhere
is removed. Sorting all suffixes of a corpus moves many times its bytes, so
the array holds only suffixes at *anchors*: in each window of ``length`` bytes
the rightmost smallest hash of its ``gram``-byte strings marks the anchor.
Which one that is depends on the window's bytes alone, so equal windows have
their anchors at the same offset and are compared through those.

1. Each document yields its anchors with the run of window starts that own
   it (a *block*), as hashes only. An anchor seen once has no repeat.
2. Of the other anchors, each distinct block and a copy of it, if it has any,
   go on; further copies follow what becomes of these two, as their 128 bits
   of hash are the same. Suffixes are dealt out by sampled splitters over their leading bytes
   (``repartitionByRange``); a bucket sorts them by multikey quicksort, sorts
   the reversed left contexts likewise, and classes of both orders at each
   depth tell exactly which windows are equal.
3. An anchor string with more blocks than a bucket holds is split by the rest
   of its suffixes. Windows of it whose class touches a bucket's first or last
   suffix may continue in the next bucket; their digests are compared across
   the boundaries. So even a third of all rows at one anchor fits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratedig.llm._util import NO_ID, column_bytes, prefix_hash, ragged, row_chunks, save, span_hash, unused

LENGTH = 400
GRAM = 100
#: Distinct blocks per bucket; about 1 kB each in memory.
BUCKET = 8_000
_CHUNK = 1 << 19
#: Bits of a place within a chunk, which has at most 2 * _CHUNK bytes.
_PLACE_BITS = 21


def window_anchors(prefix: np.ndarray, offs: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """All window starts that stay within a row, and the anchor of each."""
    n, wide = int(offs[-1]), length - gram + 1
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(n - gram + 1)
    if len(at) > 1 << _PLACE_BITS:
        raise ValueError("too many bytes at once")
    # the number of hash bits is the same everywhere, so that equal windows choose alike; the later of two equal hashes is the smaller key
    low = np.uint64((1 << _PLACE_BITS) - 1)
    keys = (span_hash(prefix, at, at + gram) & ~low) | (low - at.astype(np.uint64))
    pad = -len(keys) % wide
    rows = np.concatenate([keys, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, wide)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    m = len(keys) - wide + 1
    least = np.minimum(back[:m], ahead[wide - 1 : wide - 1 + m])
    counts = np.maximum(0, np.diff(offs) - length + 1)
    owner, step = ragged(counts)
    starts = offs[:-1][owner] + step
    return starts, (low - (least[starts] & low)).astype(np.int64)


def _pieces(start: int, end: int, rows: int, length: int) -> list[tuple[int, int]]:
    """[start, end) as it is, or for one very long row pieces that share length - 1 bytes, so that none is missed."""
    if rows > 1 or end - start <= 2 * _CHUNK:
        return [(start, end)]
    return [(at, min(end, at + _CHUNK + length - 1)) for at in range(start, end - length + 1, _CHUNK)]


def _blocks(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id, text_hash = batch.column("id"), batch.column("th")
            whole, offsets = column_bytes(batch.column("text"))
            for lo, hi in row_chunks(offsets, _CHUNK):
                for start, end in _pieces(int(offsets[lo]), int(offsets[hi]), hi - lo, length):
                    offs = np.clip(offsets[lo : hi + 1], start, end) - start
                    prefix, second = prefix_hash(whole[start:end]), prefix_hash(whole[start:end], 1)
                    starts, anchor = window_anchors(prefix, offs, length, gram)
                    if not len(starts):
                        continue
                    row = np.searchsorted(offs, starts, "right") - 1
                    new = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(row) != 0)]))
                    first, last, at, row = starts[new], starts[np.append(new[1:], len(starts)) - 1], anchor[new], row[new]
                    key = span_hash(prefix, at, at + gram)
                    block = span_hash(second, first, last + length, 1) ^ (at - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    base = offsets[lo + row] - start
                    take = pa.array(row + lo)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(block.view(np.int64)), doc_id.take(take), text_hash.take(take), *(pa.array((x - base).astype(np.int32)) for x in (first, last, at))],
                        names=["key", "block", "id", "th", "lo", "hi", "at"],
                    )

    return run


def multikey_order(tokens: np.ndarray) -> np.ndarray:
    """Rows of ``tokens`` in order, by multikey quicksort over one token at a time.

    All segments are split three ways at once: rows below and above the pivot
    stay at their depth, rows equal to it go on to the next token.
    """
    m, deep = tokens.shape
    order = np.arange(m)
    first, size, depth = np.array([0]), np.array([m]), np.array([0])
    while True:
        live = (size > 1) & (depth < deep)
        first, size, depth = first[live], size[live], depth[live]
        if not len(first):
            return order
        seg, step = ragged(size)
        at = first[seg] + step
        rows = order[at]
        token = tokens[rows, depth[seg]]
        three = [tokens[order[first + (size - 1) * k // 2], depth] for k in range(3)]
        pivot = np.sort(np.stack(three), axis=0)[1][seg]
        key = seg * 3 + (token == pivot) + 2 * (token > pivot)
        order[at] = rows[np.argsort(key, kind="stable")]
        counts = np.bincount(key, minlength=3 * len(first))
        starts = np.cumsum(counts) - counts
        shift = np.repeat(first - (np.cumsum(size) - size), 3)
        first, size, depth = starts + shift, counts, np.repeat(depth, 3) + np.tile([0, 1, 0], len(depth))


def _matrix(pieces: list[bytes], wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Zero-padded rows of bytes, and their big-endian 8-byte tokens with the length as the last."""
    wide = max(8, -(-wide // 8) * 8)
    flat = np.frombuffer(b"".join(x.ljust(wide, b"\0") for x in pieces), np.uint8).reshape(len(pieces), wide)
    size = np.array([len(x) for x in pieces], np.uint64)
    return flat, np.concatenate([flat.view(">u8").astype(np.uint64), size[:, None]], axis=1)


def _common(flat: np.ndarray, size: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row with the one before it in order; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    for lo in range(1, len(order), 4096):
        a, b = order[lo - 1 : min(lo + 4095, len(order) - 1)], order[lo : min(lo + 4096, len(order))]
        differ = flat[a] != flat[b]
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), flat.shape[1])
        out[lo : lo + len(b)] = np.minimum(same, np.minimum(size[a], size[b]))
    return out


def equal_windows(before: list[bytes], after: list[bytes], low: np.ndarray, split: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, back) of windows that occur twice in this bucket, and of those open at its boundaries.

    In rows of ``split`` anchors, a class of equal windows that touches a
    boundary is open: each window that has no equal here, or else one of the class.

    Row i has windows that start low[i] to len(before[i]) bytes before its
    anchor. Two windows at d are equal if the suffixes share length - d bytes
    and the left contexts share d.
    """
    high = np.array([len(x) for x in before])
    flat, tokens = _matrix(after, max(map(len, after)))
    order = multikey_order(tokens)
    common = _common(flat, np.array([len(x) for x in after]), order)
    left, tokens = _matrix([x[::-1] for x in before], int(high.max()))
    order_left = multikey_order(tokens)
    common_left = _common(left, high, order_left)
    rows: list[list[np.ndarray]] = [[], [], [], []]
    klass, klass_left = np.empty(len(after), np.int64), np.empty(len(after), np.int64)
    for d in range(int(low.min()), int(high.max()) + 1):
        valid = np.flatnonzero((low <= d) & (d <= high))
        if not len(valid):
            continue
        klass[order] = np.cumsum(common < length - d)
        klass_left[order_left] = np.cumsum(common_left < d)
        edge = (klass[order[0]], klass[order[-1]])
        both = klass[valid] * (len(after) + 1) + klass_left[valid]
        _, one, inverse = np.unique(both, return_index=True, return_inverse=True)
        twice = np.bincount(inverse)[inverse] >= 2
        at_edge = split[valid] & ((klass[valid] == edge[0]) | (klass[valid] == edge[1]))
        is_one = np.zeros(len(valid), bool)
        is_one[one] = True
        is_open = at_edge & (~twice | is_one)  # one of a class tells the other buckets
        for k, which in ((0, twice), (2, is_open)):
            rows[k].append(valid[which])
            rows[k + 1].append(np.full(int(which.sum()), d))
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in rows)


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"id": pa.int64(), "th": pa.int64(), "at": pa.int32(), "lo": pa.int32(), "split": pa.bool_(), "suffix": pa.binary(), "left": pa.binary()}
        for batch in batches:
            out: dict[str, list] = {k: [] for k in types}
            for id, th, text, needs in zip(*(batch.column(c) for c in ("id", "th", "text", "needs")), strict=True):
                raw = text.as_py().encode()
                for x in needs.as_py():
                    at, lo, hi = x["at"], x["lo"], x["hi"]
                    for k, v in (("id", id.as_py()), ("th", th.as_py()), ("at", at), ("lo", at - hi), ("split", x["split"]), ("suffix", raw[at : hi + length]), ("left", raw[lo:at])):
                        out[k].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, types[k]) for k, v in out.items()], names=list(out))

    return run


def _compare(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(got) if (got := list(batches)) else None
        if table is None or not table.num_rows:
            return
        before, after, id = table["left"].to_pylist(), table["suffix"].to_pylist(), table["id"].combine_chunks()
        at, th = table["at"].to_numpy(), table["th"].to_numpy()
        row, back, open_row, open_back = equal_windows(before, after, table["lo"].to_numpy(), table["split"].to_numpy(), length)
        start = at[row] - back
        order = np.lexsort((start, row))
        row, start = row[order], start[order]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(row) != 0) | (np.diff(start) != 1)])) if len(row) else row
        digest = [hashlib.blake2b(before[r][len(before[r]) - d :] + after[r][: length - d], digest_size=16).digest() for r, d in zip(open_row, open_back, strict=True)]
        settled = set(zip(row.tolist(), start.tolist(), strict=True))
        rows, edge = np.concatenate([row[new], open_row]), at[open_row] - open_back
        lonely = np.array([x not in settled for x in zip(open_row.tolist(), edge.tolist(), strict=True)], bool)
        first, last = np.concatenate([start[new], edge]), np.concatenate([start[np.append(new[1:], len(row)) - 1] if len(row) else start, edge])
        # a window that has its equal here counts twice, so that it tells other buckets
        weight = np.concatenate([np.ones(len(new), np.int64), np.where(lonely, 1, 2)]).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [id.take(pa.array(rows)), *(pa.array(x.astype(t)) for x, t in ((th[rows], np.int64), (at[rows], np.int32), (first, np.int32), (last, np.int32))), pa.array(weight), pa.array([None] * len(new) + digest, pa.binary())],
            names=["id", "th", "at", "first", "last", "weight", "digest"],
        )

    return run


def _kept(raw: bytes, runs, length: int) -> tuple[list[bytes], list[dict]]:
    """What stays of ``raw``, in pieces, and the maximal removed spans."""
    spans: list[dict] = []
    for a, b in sorted((x["first"], x["last"] + length) for x in (runs if runs is not None else ())):
        if spans and a <= spans[-1]["end"]:
            spans[-1]["end"] = max(spans[-1]["end"], b)
        else:
            spans.append({"start": a, "end": b})
    cuts = [0, *(x[k] for x in spans for k in ("start", "end")), len(raw)]
    return [raw[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True)], spans


def _remove(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))}
        for batch in batches:
            out = []
            for text, runs in zip(batch.column("text"), batch.column("runs"), strict=True):
                raw = text.as_py().encode()
                kept, spans = _kept(raw, runs.as_py(), length)
                out.append((len(raw), len(raw) - sum(map(len, kept)), len(spans), hashlib.sha256(b"".join(kept)).hexdigest(), spans))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([x[k] for x in out], t) for k, t in enumerate(kinds.values()))], names=["doc_id", *kinds])

    return run


def _keyed(documents: DataFrame) -> DataFrame:
    """(doc_id, id, th, text): a row's key is its id, for which a number stands where it is null, and its text's hash."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return docs.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("th"), "text")


def _repeats(docs: DataFrame, length: int, gram: int, bucket: int) -> DataFrame:
    """Runs (first, last) of repeated window starts by (id, th) of ``_keyed`` documents."""
    if not 8 <= gram < length:
        raise ValueError("gram must be at least 8 and below length")
    slim = docs.where(F.octet_length("text") >= length).select("id", "th", "text")
    blocks = save(slim.mapInArrow(_blocks(length, gram), "key long, block long, id long, th long, lo int, hi int, at int"), "blocks")
    place = F.struct("id", "th", "lo", "hi", "at")
    distinct = blocks.groupBy("key", "block").agg(F.count("*").alias("copies"), F.min(place).alias("one"), F.max(place).alias("other"))
    distinct = save(distinct.withColumn("other", F.when(F.col("copies") > 1, F.col("other"))), "distinct")
    # an anchor seen once has no repeat; of a block seen more often two are sorted, so that bytes tell whether they are equal
    several = distinct.groupBy("key").agg(F.sum(F.least("copies", F.lit(2))).alias("n")).where("n > 1").select("key", (F.col("n") > bucket).alias("split"))
    both = F.explode(F.when(F.col("copies") > 1, F.array("one", "other")).otherwise(F.array("one")))
    needs = distinct.join(several, "key").select("split", both.alias("x")).groupBy("x.id", "x.th").agg(F.collect_list(F.struct("x.at", "x.lo", "x.hi", "split")).alias("needs"))
    texts = slim.join(needs, ["id", "th"]).dropDuplicates(["id", "th"]).select("id", "th", "text", "needs")
    cut = save(texts.mapInArrow(_cut(length), "id long, th long, at int, lo int, split boolean, suffix binary, left binary"), "suffixes")
    buckets = max(1, -(-cut.count() // bucket))
    deep = [F.when(F.col("split"), F.col(c)) for c in ("suffix", "left")]
    found = cut.repartitionByRange(buckets, F.substring("suffix", 1, gram), *deep).mapInArrow(_compare(length), "id long, th long, at int, first int, last int, weight long, digest binary")
    found = save(found, "windows")
    across = found.where("digest is not null").groupBy("digest").agg(F.sum("weight").alias("n")).where("n > 1").select("digest")
    edges = found.where("weight = 1 and digest is not null").join(across, "digest", "left_semi")
    runs = found.where("digest is null").select("id", "th", "at", "first", "last").union(edges.select("id", "th", "at", "first", "last")).distinct()
    # where both of a block repeat whole, so do its other copies
    sure = runs.groupBy("id", "th", "at").agg(F.sum(F.col("last") - F.col("first") + 1).alias("n"))
    many = distinct.where("copies > 2").select("key", "block", "one.*").join(sure, ["id", "th", "at"]).where("n >= hi - lo + 1").select("key", "block")
    copies = blocks.join(many, ["key", "block"]).select("id", "th", F.col("lo").alias("first"), F.col("hi").alias("last"))
    return runs.select("id", "th", "first", "last").union(copies).distinct().groupBy("id", "th").agg(F.collect_list(F.struct("first", "last")).alias("runs"))


def repeated_spans(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """Per document: bytes, removed bytes and runs, the digest of what is kept, and the removed spans.

    Null and empty texts have no bytes; a text shorter than ``length`` keeps
    all. Repeated rows are copies of each other, so both lose all they share.
    A null doc_id is a document like any other. Other columns are ignored.
    An empty table gives an empty result.
    """
    docs = _keyed(documents)
    return docs.join(_repeats(docs, length, gram, bucket), ["id", "th"], "left").select("doc_id", "text", "runs").mapInArrow(
        _remove(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"
    )


def remaining_text(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """``documents`` with ``text`` cut to what ``repeated_spans`` keeps of it.

    A cut within a character drops its remaining bytes. Null texts become empty.
    """

    @F.pandas_udf("string")
    def cut(texts: pd.Series, runs: pd.Series) -> pd.Series:
        return pd.Series([b"".join(_kept((t or "").encode(), r, length)[0]).decode("utf-8", "ignore") for t, r in zip(texts, runs, strict=True)])

    id, th, spans = unused(documents, "__id", "__th", "__runs")
    runs = _repeats(_keyed(documents), length, gram, bucket).select(F.col("id").alias(id), F.col("th").alias(th), F.col("runs").alias(spans))
    keyed = documents.withColumns({id: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), th: F.xxhash64(F.coalesce("text", F.lit("")))})
    return keyed.join(runs, [id, th], "left").withColumn("text", cut("text", spans)).select(*documents.columns)
