"""Helpers shared by the operators: shared tables, Arrow text buffers, rolling hashes, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Stands for a null doc_id in joins.
NO_ID = -(2**63)
_own_dir: dict[str, str] = {}
_saved: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a folder of its own only in local mode (tests), where none is named."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
    return _own_dir.setdefault("dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))


def save(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _saved.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Deletes all that ``save`` has written in this process; results read from it must have been stored before."""
    jvm = spark.sparkContext._jvm
    while _saved:
        path = jvm.org.apache.hadoop.fs.Path(_saved.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until ``df`` has no column of it in any case."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name += "_"
        have.add(name.lower())
        out.append(name)
    return out


def numbered(rows: DataFrame, keys: list[str], place: str) -> DataFrame:
    """Numbers the rows of each key from 0: within each partition, after those of the partitions before.

    So no key's rows pass through one task. Partitions are stored first, as all steps must see the same ones.
    """
    part, n = unused(rows, "__part", "__n")
    rows = save(rows.withColumn(part, F.spark_partition_id()), "parts")
    counts = rows.groupBy(*keys, part).agg(F.count("*").alias(n))
    before = F.coalesce(F.sum(n).over(Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = F.row_number().over(Window.partitionBy(*keys, part).orderBy(F.lit(1))) - 1
    return rows.withColumn(place, own).join(counts.withColumn(n, before), [*keys, part]).withColumn(place, F.col(place) + F.col(n)).drop(part, n)


def in_order(rows: DataFrame, keys: list[Column], place: str) -> DataFrame:
    """``rows`` stored in the order of ``keys``, nulls first, with a growing number ``place``.

    Ranges end on a row's number too, so that equal keys, however many, part.
    The number's upper bits, from 33 on, name the stored partition.
    """
    (tie,) = unused(rows, "_tie")
    rows = rows.withColumn(tie, F.monotonically_increasing_id())
    dealt = rows.repartitionByRange(*keys, tie).sortWithinPartitions(*keys, tie)
    return save(dealt.drop(tie).withColumn(place, F.monotonically_increasing_id()), "in-order")


def doc_fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out. A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's UTF-8 bytes as one buffer, and the row offsets in it; nulls are empty."""
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, np.int64)[col.offset : col.offset + len(col) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offs[0] : offs[-1]], offs - offs[0]


def row_chunks(offs: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes; a longer row comes alone."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def text_chunks(col: pa.Array, limit: int) -> Iterator[tuple[int, list[str | None]]]:
    """A string column's values in row ranges of at most ``limit`` bytes, a longer row alone, each with its first row."""
    for lo, hi in row_chunks(column_bytes(col)[1], limit):
        yield lo, col.slice(lo, hi - lo).to_pylist()


_rng = np.random.default_rng(20240229)
#: Random 64-bit values for each byte, and odd bases with their inverses modulo 2**64, of two independent hashes.
_BYTES = [_rng.integers(1, 2**63, 256, dtype=np.uint64) for _ in range(2)]
_BASES = [int(_rng.integers(1, 2**63)) | 1 for _ in range(2)]
_INVERSES = [pow(b, -1, 2**64) for b in _BASES]
_BASE, _INVERSE = _BASES[0], _INVERSES[0]
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(buf: np.ndarray, which: int = 0) -> np.ndarray:
    """Polynomial prefix sums modulo 2**64, from which ``span_hash`` takes any span's hash."""
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTES[which][buf] * _power(_BASES[which], len(buf)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """64-bit hashes of the bytes of [start, end), equal for equal bytes wherever they stand."""
    raw = (prefix[end] - prefix[start]) * _power(_INVERSES[which], len(prefix))[start]
    return mix(raw + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def word_spans(buf: np.ndarray, offs: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of word bytes that stay in a row, and each run's row."""
    inside = is_word[buf]
    if not inside.any():
        none = np.zeros(0, np.int64)
        return none, none, none
    edge = np.zeros(len(buf) + 1, bool)
    edge[offs] = True
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def byte_table(pred) -> np.ndarray:
    return np.array([bool(pred(b)) for b in range(256)])


LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: Bytes of words between ASCII blanks: all but 0x20 and 0x09 to 0x0D.
NOT_BLANK = byte_table(lambda b: b != 0x20 and not 9 <= b <= 13)
#: Bytes of words of digits, lower-case letters and everything beyond ASCII.
ALNUM = byte_table(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)


def ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i, counts[i] times: i itself, and 0, 1, ... within i."""
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return owner, np.arange(len(owner)) - first[owner]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, comp) of the graph ``edges(a, b)``; comp is the smallest node reachable.

    Alternating large-star and small-star steps (Kiveris et al., 2014): every
    step is a min per node and a join back, so no neighbourhood is gathered,
    and the number of steps grows with the logarithm of the longest chain. Steps
    go on until one changes nothing.
    """
    edges = save(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        edges = save(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("comp"))
