"""Benchmark passages in documents, by Wu-Manber search over words.

The patterns are all windows of ``window`` consecutive words of the benchmark
items (an item of fewer words is one window). Words, as hashes, are the
letters of the search; a block is a pair of them. For patterns of one length
a shift table tells from the block that ends at a position how far the next
possible end is; where it says 0, the block's bucket of patterns is looked up
and each pattern is compared directly. All documents of a batch are searched
in lockstep, in pieces that overlap by a pattern's length.

The tables of at most ``block_words`` benchmark words are sent to the tasks at
once; a larger benchmark is cut into runs that overlap by a window less one
word, and the runs are searched for in several passes over the documents.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratedig.llm._util import ALNUM, LOWER, column_bytes, mix, prefix_hash, ragged, row_chunks, save, span_hash, word_spans

WINDOW = 10
#: Benchmark words whose windows are held in memory at once (about 60 bytes each with their texts, in each Python worker).
BLOCK_WORDS = 1_000_000
_CHUNK = 1 << 20
_PIECE = 256
_HITS = "hits array<struct<first:int,last:int>>, items array<string>"


def hashed_words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of the lower-cased rows, and the words' starts and ends per row as an offset array."""
    low = LOWER[buf]
    starts, ends, row = word_spans(low, offs, ALNUM)
    counts = np.bincount(row, minlength=len(offs) - 1)
    return span_hash(prefix_hash(low), starts, ends), np.concatenate([[0], np.cumsum(counts)]), np.stack([starts, ends])


def _block(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(3) + b)


class Items:
    """The lower-cased bytes of all items, and their words' hashes and spans."""

    def __init__(self, ids: list[str], texts: list[str]):
        raw = [t.encode() for t in texts]
        offs = np.concatenate([[0], np.cumsum([len(x) for x in raw], dtype=np.int64)]).astype(np.int64)
        buf = np.frombuffer(b"".join(raw), np.uint8)
        self.ids, self.low = ids, LOWER[buf].tobytes()
        self.word, self.first, spans = hashed_words(buf, offs) if len(buf) else (np.zeros(0, np.uint64), offs, np.zeros((2, 0), np.int64))
        self.spans = spans.astype(np.int64 if len(buf) > 1 << 31 else np.int32)

    def text(self, at: int, size: int) -> bytes:
        return b" ".join(self.low[a:b] for a, b in self.spans[:, at : at + size].T)


class Patterns:
    """Wu-Manber tables of all windows of ``size`` words of the items numbered ``own``; about 50 bytes a word."""

    def __init__(self, size: int, source: Items, own: np.ndarray):
        self.size, self.source = size, source
        self.width = min(2, size)
        begin, counts = source.first[own], source.first[own + 1] - source.first[own]
        which, step = ragged(counts - size + 1)
        at = begin[which] + step
        # equal windows are one pattern, with all the items that have it
        sums = [np.zeros(len(at), np.uint64) for _ in range(2)]
        for j in range(size):
            sums = [mix(x * np.uint64(3) + source.word[at + j] + np.uint64(k)) for k, x in enumerate(sums)]
        order = np.lexsort((which, *sums))
        new = np.concatenate([[True], (np.diff(sums[0][order]) != 0) | (np.diff(sums[1][order]) != 0)])
        self.at = at[order[new]]
        fresh = new | np.concatenate([[True], np.diff(which[order]) != 0])
        self.item = own[which[order[fresh]]].astype(np.int32)
        self.of = np.concatenate([np.flatnonzero(new[fresh]), [int(fresh.sum())]])
        # of the windows that hold a block, the first ends nearest before it
        word, place = ragged(counts)
        _, place = ragged(counts)
        place = place[place >= self.width - 1]
        word = np.repeat(np.arange(len(counts)), np.maximum(0, counts - self.width + 1))
        last = begin[word] + place
        bits = max(12, int(8 * len(last)).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.shift = np.full(1 << bits, size - self.width + 1, np.uint8)
        slot = (self.ending(source.word[last - 1] if self.width > 1 else None, source.word[last]) & self.mask).astype(np.int64)
        np.minimum.at(self.shift, slot, np.maximum(0, size - 1 - place).astype(np.uint8))
        end = self.at + size - 1
        suffix = self.ending(source.word[end - 1] if self.width > 1 else None, source.word[end])
        self.order = np.argsort(suffix, kind="stable")
        self.suffix = suffix[self.order]

    def items(self, pattern: int) -> list[str]:
        return [self.source.ids[i] for i in self.item[self.of[pattern] : self.of[pattern + 1]]]

    def ending(self, before: np.ndarray | None, last: np.ndarray) -> np.ndarray:
        return mix(last) if before is None else _block(before, last)

    def find(self, word: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, pattern) of every occurrence among the words, whose rows begin at ``offs``."""
        counts = np.diff(offs)
        pieces = np.maximum(0, -(-(counts - self.size + 1) // _PIECE))
        owner, step = ragged(pieces)
        at = offs[:-1][owner] + step * _PIECE + self.size - 1  # the last word of the first possible window
        end = np.minimum(at + _PIECE, offs[1:][owner])
        starts, which = [], []
        while len(at):
            block = self.ending(word[at - 1] if self.width > 1 else None, word[at])
            jump = self.shift[(block & self.mask).astype(np.int64)]
            stop = np.flatnonzero(jump == 0)
            if len(stop):
                lo, hi = (np.searchsorted(self.suffix, block[stop], side) for side in ("left", "right"))
                bucket, k = ragged(hi - lo)
                pattern, first = self.order[lo[bucket] + k], at[stop][bucket] - self.size + 1
                same = np.ones(len(pattern), bool)
                for j in range(self.size):
                    same &= word[first + j] == self.source.word[self.at[pattern] + j]
                starts.append(first[same])
                which.append(pattern[same])
            at = at + np.maximum(jump, 1)
            live = at < end
            at, end = at[live], end[live]
        none = np.zeros(0, np.int64)
        return (np.concatenate(starts), np.concatenate(which)) if starts else (none, none)


def build_patterns(item_ids: list[str], texts: list[str], window: int) -> list[Patterns]:
    """The tables for each length of pattern."""
    source = Items(item_ids, texts)
    size = np.minimum(np.diff(source.first), window)
    return [Patterns(n, source, np.flatnonzero(size == n)) for n in np.unique(size).tolist() if n]


def _search(tables):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, offsets = column_bytes(batch.column("text"))
            counts, hits, items = [], [], []
            for lo, hi in row_chunks(offsets, _CHUNK):
                buf = whole[offsets[lo] : offsets[hi]]
                word, first, spans = hashed_words(buf, offsets[lo : hi + 1] - offsets[lo])
                low = None
                runs: dict[int, list] = defaultdict(list)
                named: dict[int, set] = defaultdict(set)
                for table in tables.value:
                    start, pattern = table.find(word, first)
                    low = LOWER[buf].tobytes() if len(start) and low is None else low
                    row = np.searchsorted(first, start, "right") - 1
                    for s, p, r in zip(start.tolist(), pattern.tolist(), row.tolist(), strict=True):
                        # hashes found it; the words themselves decide
                        if b" ".join(low[a:b] for a, b in spans[:, s : s + table.size].T) == table.source.text(int(table.at[p]), table.size):
                            at = s - int(first[r])
                            runs[r].append((at, at + table.size))
                            named[r].update(table.items(p))
                counts.append(np.diff(first))
                for r in range(hi - lo):
                    hits.append([{"first": a, "last": b} for a, b in _merge(runs.get(r, ()))])
                    items.append(sorted(named.get(r, ())))
            kinds = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in batch.schema.names if c != "text"), pa.array(np.concatenate(counts) if counts else [], pa.int64()), pa.array(hits, kinds), pa.array(items, pa.list_(pa.string()))],
                names=[*(c for c in batch.schema.names if c != "text"), "n_words", "hits", "items"],
            )

    return run


def _merge(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hits = [[{"first": a, "last": b} for a, b in _merge((x["first"], x["last"]) for part in row for x in part)] for row in batch.column("hits").to_pylist()]
        items = [sorted({x for part in row for x in part}) for row in batch.column("items").to_pylist()]
        kinds = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
        rest = [c for c in batch.schema.names if c not in ("hits", "items")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(hits, kinds), pa.array(items, pa.list_(pa.string()))], names=[*rest, "hits", "items"])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hits, items = batch.column("hits").to_pylist(), batch.column("items").to_pylist()
        n_hit = [sum(x["last"] - x["first"] for x in h) for h in hits]
        sha = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array(sha), pa.array([n > 0 for n in n_hit], pa.bool_())],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )


def _cut(window: int, most: int):
    """Cuts items into runs of at most ``most`` words that hold each window once, and packs them into blocks of at most ``most`` words."""
    step = most - window + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, filled, task = 0, 0, TaskContext.get().partitionId()
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                raw = text.encode()
                if not raw:
                    continue
                _, first, (starts, ends) = hashed_words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                total = int(first[1])
                for lo in range(0, max(1, total - window + 1), step) if total else ():
                    hi = min(lo + most, total)
                    if filled + hi - lo > most:
                        block, filled = block + 1, 0
                    filled += hi - lo
                    row = [[task], [block], [item], [raw[starts[lo] : ends[hi - 1]].decode()], [hi - lo]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)], names=["task", "block", "item", "text", "words"])

    return run


def _passes(items: DataFrame, window: int, block_words: int) -> Iterator[list]:
    """The rows (item, text) of each pass, of at most ``block_words`` words (but room for two windows) in all."""
    most = max(2 * window, block_words // 4)
    runs = save(items.mapInArrow(_cut(window, most), "task long, block long, item string, text string, words long"), "runs")
    chosen: list = []
    filled = 0
    for r in [*runs.groupBy("task", "block").agg(F.sum("words").alias("words")).orderBy("task", "block").collect(), None]:
        if chosen and (r is None or filled + r["words"] > max(most, block_words)):
            (first, last), chosen, filled = (chosen[0], chosen[-1]), [], 0
            key = F.struct("task", "block")
            ends = [F.struct(*(F.lit(x[c]).cast("long").alias(c) for c in ("task", "block"))) for x in (first, last)]
            yield runs.where((key >= ends[0]) & (key <= ends[1])).select("item", "text").collect()
        if r is not None:
            chosen.append(r)
            filled += r["words"]


def benchmark_hits(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row of ``documents``: doc_id, th, n_words, the hit word ranges and the items found, sorted as strings.

    Words are runs of digits, letters a to z (A-Z lower-cased) and characters
    beyond ASCII. Null and empty texts have no words and no hits; an item
    without words, or with a null item_id, is never found. Items of one text
    are all named. Every row gives a row, repeated ones too, whatever the number
    of passes. Other columns are ignored; empty tables give no hits or no rows.
    """
    if window < 1 or window > 200:
        raise ValueError("window must be 1 to 200 words")
    spark = documents.sparkSession
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item"), "text")
    # every second character at most begins a word
    size = items.agg(F.sum((F.length("text") + 1) / 2)).first()[0] or 0
    several = size > block_words
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("th", F.xxhash64("text"))

    def searched(rows: list) -> DataFrame:
        tables = spark.sparkContext.broadcast(build_patterns([r["item"] for r in rows], [r["text"] for r in rows], window))
        return docs.mapInArrow(_search(tables), f"doc_id long, th long, n_words long, {_HITS}")

    if not several:
        return searched(items.collect())
    every = searched([])
    found = every.where("false").select("doc_id", "th", "hits", "items")
    for rows in _passes(items, window, block_words):
        # written pass by pass, so that a worker holds the tables of one
        found = found.union(save(searched(rows).where(F.size("hits") > 0).select("doc_id", "th", "hits", "items"), "hits"))
    parts = found.groupBy("doc_id", "th").agg(F.collect_set("hits").alias("hits"), F.collect_set("items").alias("items"))
    parts = parts.mapInArrow(_join, f"doc_id long, th long, {_HITS}").select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), F.col("hits").alias("__hits"), F.col("items").alias("__items"))
    # the merged hits go back to every row that has them
    out = every.join(parts, every["doc_id"].eqNullSafe(parts["__id"]) & (every["th"] == parts["__th"]), "left")
    return out.select("doc_id", "th", "n_words", F.coalesce("__hits", "hits").alias("hits"), F.coalesce("__items", "items").alias("items"))


def contamination_report(documents: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated; see ``benchmark_hits``."""
    return benchmark_hits(documents, benchmark, **parameters).mapInArrow(_digest, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """``documents`` without the rows in which a benchmark window occurs."""
    bad = benchmark_hits(documents, benchmark, **parameters).where(F.size("hits") > 0).select(F.col("doc_id").alias("__id"), F.col("th").alias("__th")).distinct()
    same = documents["doc_id"].cast("long").eqNullSafe(bad["__id"]) & (F.xxhash64(documents["text"]) == bad["__th"])
    return documents.join(bad, same, "left_anti")
