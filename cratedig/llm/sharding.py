"""Shards by extendible hashing.

The directory is indexed by the leading bits of a document's hash. A bucket
that holds more bytes than ``limit`` splits on one more bit, and only such a
bucket: so each shard is the shortest prefix that fits while its parent does
not. Only sums per prefix are shuffled: documents are summed once, by the
finest prefix, and the directory is found on those sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cratedig.llm._util import numbered, save, unused

LIMIT = 1 << 20
#: Bits taken from the hash; the directory deepens by STEP bits a round.
BITS = 60
STEP = 8


def _prefix(column: str, bits: int, depth: int | F.Column) -> F.Column:
    """The first ``depth`` of the ``bits`` of a number."""
    return F.call_function("shiftright", F.col(column), (F.lit(bits) - depth).cast("int"))


def _directory(leaves: DataFrame, above: int, depth: int, limit: int) -> DataFrame:
    """(leaf, depth, prefix, shard_bytes) of the leaves, prefixes of ``depth`` bits, that some prefix makes fit.

    From the top down, STEP bits a round: early rounds have few prefixes, and
    only leaves in buckets that are too large go on to the next. At ``above``
    (-1: none) all buckets are known to be too large.
    """
    found, rest, top = None, leaves, above
    while top < depth:
        low = min(depth, max(top, 0) + STEP)
        tips = rest.groupBy(_prefix("leaf", depth, low).alias("tip")).agg(F.sum("bytes").alias("bytes"))
        levels = F.explode(F.sequence(F.lit(max(top, 0)), F.lit(low))).alias("depth")
        spread = save(tips.select("tip", "bytes", levels).withColumn("prefix", _prefix("tip", low, F.col("depth"))), "tips")
        sums = save(spread.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes")), "prefixes")
        large = sums.where(F.col("shard_bytes") > limit).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        fit = sums.where(F.col("shard_bytes") <= limit)
        whole = fit.where("depth = 0")
        split = fit.withColumn("parent", F.call_function("shiftright", F.col("prefix"), F.lit(1))).join(large, ["depth", "parent"], "left_semi").where("depth > 0").drop("parent")
        shards = spread.select("tip", "depth", "prefix").join(whole.unionByName(split), ["depth", "prefix"])
        keyed = rest.withColumn("tip", _prefix("leaf", depth, low))
        part = keyed.join(shards, "tip").select("leaf", "depth", "prefix", "shard_bytes")
        found = part if found is None else found.unionByName(part)
        rest, top = save(keyed.join(shards.select("tip"), "tip", "left_anti").drop("tip"), "rest"), low
    return found


def _hashed(documents: DataFrame, **names: str) -> DataFrame:
    """``documents`` with size (UTF-8 bytes), hash (60 bits of md5 over doc_id and text) and text hash under ``names``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(text)))
    return documents.withColumns({names["size"]: F.octet_length(text).cast("long"), names["hash"]: F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), names["th"]: F.xxhash64(text)})


def _placed(documents: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Per hash its shard and shard_bytes; and per (hash, th) that bits can't part the rows that go to one of its shards (``per``), and their number."""
    if limit < 1:
        raise ValueError("limit must be positive")
    docs = save(_hashed(documents.select("doc_id", "text"), size="n_bytes", hash="hash", th="th").select("n_bytes", "hash", "th"), "hashes")
    total = docs.agg(F.sum("n_bytes")).first()[0] or 0
    depth = min(BITS, max(0, int(total // limit).bit_length()) + STEP)
    found, above = None, -1
    rest = docs.groupBy("hash").agg(F.sum("n_bytes").alias("bytes"))
    while True:
        keyed = rest.withColumn("leaf", _prefix("hash", BITS, depth))
        leaves = save(keyed.groupBy("leaf").agg(F.sum("bytes").alias("bytes")), "leaves")
        directory = save(_directory(leaves, above, depth, limit), "directory")
        part = keyed.join(directory, "leaf").drop("leaf", "bytes")
        found = part if found is None else found.unionByName(part)
        # only buckets that no prefix so far could fit go deeper
        rest = save(keyed.join(directory, "leaf", "left_anti").drop("leaf"), "large")
        if depth == BITS or rest.isEmpty():
            break
        above, depth = depth, min(BITS, depth + STEP)
    name = F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth").cast("int"), F.lit("0"))
    shards = found.select("hash", F.col("depth").cast("int").alias("depth"), F.when(F.col("depth") > 0, name).otherwise("").alias("shard"), "shard_bytes")
    classes = docs.join(rest.select("hash"), "hash", "left_semi").groupBy("hash", "th").agg(F.max("n_bytes").alias("each"), F.count("*").alias("n"))
    return save(shards, "shards"), save(classes.withColumn("per", F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("each", F.lit(1)))).cast("long")), "classes")


def sharded_documents(documents: DataFrame, limit: int = LIMIT, details: bool = False) -> DataFrame:
    """``documents`` with their ``shard``, which replaces a column of that name; see ``assign_shards``.

    ``details`` adds depth, n_bytes, shard_bytes and fits in the same way.
    """
    names = dict(zip(("size", "hash", "th", "place", "of"), unused(documents, "__size", "__hash", "__th", "__place", "__of"), strict=True))
    shards, classes = _placed(documents, limit)
    keyed = _hashed(documents, **names)
    size, key, th, place = (F.col(names[k]) for k in ("size", "hash", "th", "place"))
    more = ("depth", "n_bytes", "shard_bytes", "fits") if details else ()
    kept = [c for c in documents.columns if c not in ("shard", *more)]
    # repeated rows that exceed the limit together fill numbered shards in turn
    classes = classes.select(F.col("hash").alias(names["hash"]), F.col("th").alias(names["th"]), F.struct("n", "per").alias(names["of"]))
    own = [names["hash"], names["th"]]
    crowd = numbered(keyed.select(*(F.col(c) for c in kept), size, key, th).join(classes.select(*own), own, "left_semi"), own, names["place"]).join(classes, own)
    number, per = F.col(names["of"])["n"], F.col(names["of"])["per"]
    turn = F.floor(place / per)
    prefix = F.lpad(F.conv(key.cast("string"), 10, 2), BITS, "0")
    rows = F.least(per, number - turn * per)
    columns = {"depth": F.lit(BITS), "n_bytes": size, "shard_bytes": (rows * size).cast("long"), "fits": rows * size <= limit, "shard": F.concat_ws(".", prefix, F.hex(th), turn.cast("string"))}
    crowded = crowd.select(*kept, *(columns[c].alias(c) for c in (*more, "shard")))
    slim = shards.select(F.col("hash").alias(names["hash"]), F.struct("depth", "shard", "shard_bytes").alias(names["of"]))
    at = F.col(names["of"])
    columns = {"depth": at["depth"], "n_bytes": size, "shard_bytes": at["shard_bytes"], "fits": F.lit(True), "shard": at["shard"]}
    plain = keyed.select(*(F.col(c) for c in kept), size, key).join(slim, names["hash"]).select(*kept, *(columns[c].alias(c) for c in (*more, "shard")))
    return plain.unionByName(crowded)


def assign_shards(documents: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Per row: doc_id, n_bytes, depth, shard (the prefix as a bit string), shard_bytes and fits.

    A document's size is its UTF-8 bytes (null: 0), its hash 60 bits of md5 over
    doc_id and text (null as empty), so that rows of a common or null id part
    too. Only repeated rows have one hash: where they exceed the limit together,
    they fill shards of their own (the hash, the text's hash and a number, joined by
    dots). fits is false only for a document that exceeds the limit alone. An
    empty table has no shards. Other columns are ignored.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return sharded_documents(docs, limit, details=True).select("doc_id", "n_bytes", "depth", "shard", "shard_bytes", "fits")


def write_shards(documents: DataFrame, path: str, limit: int = LIMIT) -> None:
    """One folder of Parquet per shard, its rows in one task each."""
    sharded_documents(documents, limit).repartition("shard").write.partitionBy("shard").parquet(path)
