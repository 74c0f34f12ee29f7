"""Importance resampling towards a target distribution.

Texts are bags of features (runs of words), dealt into a fixed number of
buckets by crc32. The gain of a bucket, the logarithm of its share among the
target's features by its share among the documents', stands in one array; a
document's weight is the mean of its features' gains, so that scoring is one
lookup per feature. A Gumbel term drawn from the id makes the highest scores a
sample without replacement.

Scores are ranked by a distributed LSD radix sort. The key's fields are cut
into digits, least significant first; each pass is a stable counting sort.
Blocks of consecutive places count their digits; prefix sums over digits and
then blocks say where the rows of a block with a digit go, and each row adds
its turn among them. No pass gathers more than one block's rows of a digit, so
equal scores or ids, however many, make no hot task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratedig.llm._util import ALNUM, LOWER, column_bytes, numbered, ragged, row_chunks, save, unused, word_spans

RUNS = (1, 1)
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
#: Bits of a digit at most, and of the places of a block: a pass has at most 2**DIGIT totals in one task.
DIGIT, BLOCK = 16, 16
#: Bytes of text whose features are held at once; longer words than LONG are hashed one by one.
CHUNK, LONG = 1 << 21, 48


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def span_crc32(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The unsigned crc32 of each span's bytes: byte by byte for all spans at once, the longest first so that those left stand in front."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    at, size = starts[order], size[order]
    crc = np.full(len(at), 0xFFFFFFFF, np.uint32)
    first = int(np.searchsorted(-size, -LONG, "left"))  # spans before are longer than LONG
    left = len(at) - np.searchsorted(size[::-1], np.arange(LONG), "right")
    for j in range(LONG):
        n = int(left[j])
        if n <= first:
            break
        part = crc[first:n]
        crc[first:n] = _CRC[(part ^ buf[at[first:n] + j]) & np.uint32(0xFF)] ^ (part >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for i in range(first):
        crc[i] = zlib.crc32(buf[at[i] : at[i] + size[i]])
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _features(col: pa.Array, runs: tuple[int, int], buckets: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Row ranges lo, hi of bounded bytes with the words of each row, each feature's row (from lo) and bucket."""
    every, offs = column_bytes(col)
    for lo, hi in row_chunks(offs, CHUNK):
        buf, own = LOWER[every[offs[lo] : offs[hi]]], offs[lo : hi + 1] - offs[lo]
        starts, ends, row = word_spans(buf, own, ALNUM)
        words = np.bincount(row, minlength=hi - lo)
        if runs[1] > 1:
            # words joined by one space: a run of words is then a span
            size = ends - starts
            place = np.cumsum(size + 1) - size - 1
            joined = np.full(int(size.sum()) + len(size), 0x20, np.uint8)
            word, k = ragged(size)
            joined[place[word] + k] = buf[starts[word] + k]
            buf, starts, ends = joined, place, place + size
        rows, crcs = [], []
        for n in range(runs[0], runs[1] + 1):
            first = np.arange(max(0, len(row) - n + 1))
            first = first[row[first] == row[first + n - 1]]
            rows.append(row[first])
            crcs.append(span_crc32(buf, starts[first], ends[first + n - 1]))
        yield lo, hi, words, np.concatenate(rows), (np.concatenate(crcs) % np.uint32(buckets)).astype(np.int64)


def _counts(runs: tuple[int, int], buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for *_, bucket in _features(batch.column("text"), runs, buckets):
                total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int32()), "n": pa.array(total[some], pa.int64())})

    return run


def bucket_counts(texts: DataFrame, runs: tuple[int, int] = RUNS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all features of ``text``: a task sends at most one row for each bucket."""
    return texts.select("text").mapInArrow(_counts(runs, buckets), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(documents: DataFrame, target: DataFrame, runs: tuple[int, int] = RUNS, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket in thousandths, floored; ``buckets`` numbers reach the driver."""
    both = documents.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    for name, texts in (("s", documents), ("t", target)):
        both = both.join(bucket_counts(texts, runs, buckets).withColumnRenamed("n", name), "bucket", "left").fillna(0, [name])
    every = Window.partitionBy()
    total = lambda c: F.sum(c).over(every).cast("double")
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    gain = F.floor(1000 * F.log(((t + 1) * (total("s") + buckets)) / ((s + 1) * (total("t") + buckets))))
    return np.array([r["gain"] for r in both.select("bucket", gain.alias("gain")).orderBy("bucket").collect()], np.int64)


def _weights(runs: tuple[int, int], gains: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.zeros((3, 0), np.int64)]
            for lo, hi, words, row, bucket in _features(batch.column("text"), runs, len(gains)):
                n = np.bincount(row, minlength=hi - lo)
                order = np.argsort(row, kind="stable") if runs[1] > runs[0] else slice(None)
                sums = np.concatenate([[0], np.cumsum(gains[bucket[order]])])
                ends = np.cumsum(n)
                parts.append(np.stack([words, n, (sums[ends] - sums[ends - n]) // np.maximum(n, 1)]))
            words, n, weight = np.concatenate(parts, axis=1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names if c != "text"), *(pa.array(x, pa.int64()) for x in (words, n, weight))], names=[*(c for c in batch.schema.names if c != "text"), "n_words", "n_features", "weight"])

    return run


def importance_scores(documents: DataFrame, target: DataFrame, runs: tuple[int, int] = RUNS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Per row of ``documents``: doc_id, th (hash of the text), n_words, n_features, weight and score.

    A null or empty text has no features and weight 0. A null id draws from the
    empty text. Repeated rows get equal scores; other columns are ignored.
    """
    if not 1 <= runs[0] <= runs[1] or buckets < 1:
        raise ValueError("runs are from 1 word on, buckets at least 1")
    gains = bucket_gains(documents, target, runs, buckets)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    rows = docs.mapInArrow(_weights(runs, gains), "doc_id long, th long, n_words long, n_features long, weight long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return rows.withColumn("score", F.col("weight") + gumbel)


def _pass(rows: DataFrame, place: str, digit: Column) -> DataFrame:
    """Rows at new places, ordered by digit and then by old place, 0 first."""
    block, value, n, to = unused(rows, "_block", "_digit", "_n", "_to")
    keyed = rows.withColumns({block: F.call_function("shiftright", F.col(place), F.lit(BLOCK)), value: digit.cast("int")})
    counts = keyed.groupBy(block, value).agg(F.count("*").alias(n))
    totals = counts.groupBy(value).agg(F.sum(n).alias(to))
    totals = totals.withColumn(to, F.coalesce(F.sum(to).over(Window.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    within = F.coalesce(F.sum(n).over(Window.partitionBy(value).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.withColumn(n, within).join(totals, value).select(block, value, (F.col(n) + F.col(to)).alias(to))
    turn = F.row_number().over(Window.partitionBy(block, value).orderBy(place)) - 1
    return save(keyed.join(offsets, [block, value]).withColumn(place, F.col(to) + turn).drop(block, value, to), "pass")


def radix_rank(rows: DataFrame, fields: list[tuple[str, bool]], rank: str = "rank") -> DataFrame:
    """``rows`` with ``rank``, 1 first, by long columns (name, descending), the most significant first; nulls last.

    A field takes the bits of its range alone. Full ties keep the order in
    which the rows are stored.
    """
    (place,) = unused(rows, "_place")
    parts: list[tuple[Column, bool]] = []
    for name, descending in fields:
        parts += [(F.col(name).isNull().cast("long"), False), (F.coalesce(F.col(name).cast("long"), F.lit(0)), descending)]
    keyed = save(rows.withColumn(place, F.monotonically_increasing_id()), "places")
    ends = keyed.agg(F.count("*"), *(f(x) for x, _ in parts for f in (F.min, F.max))).first()
    passes = 0
    for i, (value, descending) in reversed(list(enumerate(parts))):
        low, high = ends[2 * i + 1] or 0, ends[2 * i + 2] or 0
        if high - low < 2**63:
            key = F.lit(high) - value if descending else value - F.lit(low)
        else:  # a difference would overflow; with its first bit turned, a long orders as an unsigned number
            key = value.bitwiseXOR(F.lit(2**63 - 1)) if descending else value.bitwiseXOR(F.lit(-(2**63)))
        width = min(64, (high - low).bit_length())
        digits = -(-width // DIGIT)
        step = -(-width // digits) if digits else 0
        for shift in range(0, width, step or 1):
            bits = min(step, width - shift)
            keyed = _pass(keyed, place, F.call_function("shiftrightunsigned", key, F.lit(shift)).bitwiseAND(F.lit(2**bits - 1)))
            passes += 1
    if ends[0] and not passes:  # all rows tie; one pass makes their places dense
        keyed = _pass(keyed, place, F.lit(0))
    return keyed.withColumn(rank, F.col(place) + 1).drop(place)


def importance_ranks(documents: DataFrame, target: DataFrame, runs: tuple[int, int] = RUNS, buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """``importance_scores`` with rank: 1, 2, ... for the rows that are drawn, null for the others.

    Of the N rows with ``least_words`` words the floor(percent * N / 100) highest
    scores are drawn; ties go to the smaller doc_id (null last), then to fewer
    features. Repeated rows are rows of their own. Empty tables give no rows; an
    empty target gives weights by the documents' counts alone.
    """
    if not 0 <= percent <= 100:
        raise ValueError("percent is from 0 to 100")
    scored = save(importance_scores(documents, target, runs, buckets, seed), "scored")
    ranked = radix_rank(scored.where(F.col("n_words") >= least_words), [("score", True), ("doc_id", False), ("n_features", False)])
    drawn = F.floor(scored.where(F.col("n_words") >= least_words).count() * F.lit(percent) / 100)
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).unionByName(rest)


def resampled(documents: DataFrame, target: DataFrame, **parameters) -> DataFrame:
    """The rows of ``documents`` that are drawn, with all their columns; of equal (doc_id, text) as many as were drawn."""
    id_, th, place, many = unused(documents, "_id", "_th", "_turn", "_many")
    null_safe = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    drawn = importance_ranks(documents, target, **parameters).where("rank is not null")
    drawn = drawn.groupBy(null_safe(F.col("doc_id")).alias(id_), F.col("th").alias(th)).agg(F.count("*").alias(many))
    keyed = documents.withColumns({id_: null_safe(F.col("doc_id").cast("long")), th: F.xxhash64("text")}).join(drawn, [id_, th])
    return numbered(keyed, [id_, th], place).where(F.col(place) < F.col(many)).select(*documents.columns)
