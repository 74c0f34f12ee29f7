"""Mixing sources to target weights, in DataFrame expressions alone.

Targets are a water level: every source gets its weight's share of all words,
at most ``most`` times its own size, and what exceeds that is shared anew by
weight among the others. A source's words are first taken in complete epochs;
the rest of its target is an Efraimidis-Spirakis sample: each document has an
exponential key -ln(u) / quality, the source is sorted by it, and the prefix
sums of the sizes are cut at the budget.

The prefix sums never sort a source whole. Keys are dealt into ``CELLS`` cells
a source, cells are summed, and only the one in which the budget runs out is
sorted by its keys; cells below it are taken and cells above it are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratedig.llm._util import NO_ID, in_order, numbered, save, unused

MOST = 3
CELLS = 4096
WEIGHTS = (1, 2, 3)
SEED = 0
#: The quality of a text is its share of letters, at least this.
LEAST_QUALITY = 0.05


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def letter_share(text: Column) -> Column:
    """Letters among the bytes that are no blanks: a cheap quality of prose, from LEAST_QUALITY to 1."""
    other = F.regexp_count(text, F.lit(r"[^\p{L}\x09-\x0D\x20]"))
    return F.greatest(F.lit(LEAST_QUALITY), F.coalesce(1 - other / F.greatest(F.length(text), F.lit(1)), F.lit(1.0)))


def _before(rows: DataFrame, order: list[Column], values: dict[str, Column]) -> DataFrame:
    """``rows`` with the sums of ``values`` over all rows before each in ``order``.

    Ranges of the order are summed apart; only their totals, one row a range, are summed in one task.
    """
    placed = in_order(rows, order, "_place").withColumn("_range", F.shiftrightunsigned("_place", 33))
    total = {k: f"_{k}" for k in values}
    ranges = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("_range").agg(*(F.sum(v).alias(total[k]) for k, v in values.items()))
    starts = sums.select("_range", *(F.coalesce(F.sum(c).over(ranges), F.lit(0)).alias(c) for c in total.values()))
    own = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumns({k: F.coalesce(F.sum(v).over(own), F.lit(0)) for k, v in values.items()})
    return inside.join(starts, "_range").withColumns({k: F.col(k) + F.col(c) for k, c in total.items()}).drop("_range", "_place", *total.values())


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """``sizes(source, source_size)``, one row per source, with the words to take of each.

    Sources by code point, null last, weigh ``weights`` in turn. A source is
    capped at ``most`` times its size if the water level lies above that; the
    level follows from prefix sums in the order of that ratio. Sources may be
    many: they are numbered and summed in ranges, and the driver sees three numbers.
    """
    by_name = [F.col("source").isNull(), F.col("source")]
    turn = F.col("turn") % len(weights)
    weighed = _before(sizes, by_name, {"turn": F.lit(1)})
    weighed = weighed.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (turn + 1).cast("int"))).drop("turn")
    weighed = weighed.withColumn("cap", (most * F.col("source_size")).cast("double")).withColumn("ratio", F.col("cap") / F.col("weight"))
    ordered = _before(weighed, [F.col("ratio"), *by_name], {"caps": F.col("cap"), "weights": F.col("weight")})
    size, weight = ordered.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    level = (F.lit(size) - F.col("caps")) / (F.lit(weight) - F.col("weights"))
    # the first source that reaches its level sets it; from there on the levels fall
    (highest,) = ordered.withColumn("level", level).agg(F.max(F.when(F.col("ratio") >= F.col("level"), F.col("level")))).first()
    return ordered.select("source", "source_size", F.least(F.col("cap"), F.coalesce(F.lit(highest).cast("double") * F.col("weight"), F.col("cap"))).alias("target"))


def _copies_numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``copy``: 0, 1, ... among rows of one id, source and text, 0 for all others. Hot copies are numbered in parallel."""
    same = ["null_id", "id", "named", "name", "md5"]
    many = save(docs.groupBy(*same).agg(F.count("*").alias("copies")).where("copies > 1").drop("copies"), "repeated")
    once = docs.join(many, same, "left_anti").withColumn("copy", F.lit(0).cast("long"))
    return once.unionByName(numbered(docs.join(many, same, "left_semi"), same, "copy").withColumn("copy", F.col("copy").cast("long")))


def mix_sources(documents: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST, seed: int = SEED, quality: Column | None = None) -> DataFrame:
    """Per row of ``documents``: doc_id, source, th, size, source_size, target, copies and taken.

    size is the number of words between ASCII blanks (null and blank texts: 0);
    copies is how often the mix takes the document (complete epochs, and once
    more if it is selected), taken the words that makes; never above ``most``
    times. A selected document may cross the budget if that ends nearer to it.
    The key is drawn from ``seed``, doc_id, the text and, among rows that agree
    in these and the source, a number, so reruns agree and each row has a step of
    its own; ties go by doc_id. A null source is a source, the last. A source
    without words has target 0.
    Other columns are ignored; an empty table gives an empty result.
    """
    if most < 1 or not weights or min(weights) <= 0:
        raise ValueError("most is at least 1 and weights are positive")
    worth = letter_share(F.col("text")) if quality is None else F.greatest(quality.cast("double"), F.lit(1e-6))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("th"), F.md5(F.coalesce("text", F.lit(""))).alias("md5"), worth.alias("worth"))
    docs = _copies_numbered(save(docs.withColumns({"named": F.col("source").isNotNull(), "name": F.coalesce("source", F.lit("")), "null_id": F.col("doc_id").isNull(), "id": F.coalesce("doc_id", F.lit(0))}), "sizes"))
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "md5", F.col("copy").cast("string")))
    # 52 bits, so that u is exact and within (0, 1)
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)
    docs = docs.withColumn("key", -F.log(u) / F.col("worth")).drop("md5", "worth", "null_id", "id")
    cell = F.least(F.floor((1 - F.exp(-F.col("key"))) * CELLS).cast("int"), F.lit(CELLS - 1))
    docs = save(docs.withColumn("cell", cell), "keys")
    source = ["named", "name"]
    cells = save(docs.groupBy(*source, "cell").agg(F.sum("size").alias("cell_size")), "cells")
    sizes = cells.groupBy(*source).agg(F.sum("cell_size").alias("source_size")).select(F.when(F.col("named"), F.col("name")).alias("source"), "source_size")
    targets = source_targets(sizes, weights, most)
    targets = targets.withColumns({"named": F.col("source").isNotNull(), "name": F.coalesce("source", F.lit(""))}).drop("source")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = save(targets.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "targets")
    before = F.coalesce(F.sum("cell_size").over(Window.partitionBy(*source).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    state = cells.withColumn("before", before).join(targets, source)
    # a cell whose sum stays within the rest is taken whole; the one in which the rest runs out is sorted
    state = state.withColumn("edge", (F.col("before") < F.col("rest")) & (F.col("before") + F.col("cell_size") > F.col("rest")))
    state = state.withColumn("below", F.col("before") + F.col("cell_size") <= F.col("rest"))
    state = save(state.select(*source, "cell", "before", "source_size", "target", "epochs", "rest", "edge", "below"), "state")
    rows = docs.join(state, [*source, "cell"])
    ordered = Window.partitionBy(*source).orderBy("key", "doc_id", "th", "copy").rowsBetween(Window.unboundedPreceding, 0)
    at_edge = rows.where("edge").withColumn("upto", F.col("before") + F.sum("size").over(ordered))
    start, end, rest = F.col("upto") - F.col("size"), F.col("upto"), F.col("rest")
    chosen = (end <= rest) | ((start < rest) & (end - rest <= rest - start))
    both = at_edge.withColumn("chosen", chosen).drop("upto").unionByName(rows.where("not edge").withColumn("chosen", F.col("below") & (F.col("rest") > 0)))
    copies = F.col("epochs") + F.when(F.col("chosen"), 1).otherwise(0)
    return both.select("doc_id", F.when(F.col("named"), F.col("name")).alias("source"), "th", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed_documents(documents: DataFrame, **parameters) -> DataFrame:
    """``documents`` as often as the mix takes them; rows without words that it never takes go.

    Of rows that agree in doc_id, source and text, the first ones stand for the
    copies that are taken once more.
    """
    *key, copies, rows, place = unused(documents, "__id", "__source", "__none", "__th", "__copies", "__rows", "__place")
    parts = lambda th: (F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.coalesce("source", F.lit("")), F.col("source").isNull(), th)
    taken = mix_sources(documents, **parameters)
    taken = taken.groupBy(*(c.alias(k) for k, c in zip(key, parts(F.col("th")), strict=True))).agg(F.sum("copies").alias(copies), F.count("*").alias(rows))
    taken = save(taken.where(F.col(copies) > 0), "taken")
    keyed = documents.withColumns(dict(zip(key, parts(F.xxhash64("text")), strict=True))).join(taken, key)
    alike = F.col(copies) % F.col(rows) == 0
    each = F.floor(F.col(copies) / F.col(rows))
    uneven = numbered(keyed.where(~alike), key, place)
    uneven = uneven.withColumn(copies, each + F.when(F.col(place) < F.col(copies) % F.col(rows), 1).otherwise(0))
    many = keyed.where(alike).withColumn(copies, each).select(*documents.columns, copies).unionByName(uneven.select(*documents.columns, copies))
    return many.select(*documents.columns, F.explode(F.array_repeat(F.lit(1), F.col(copies).cast("int"))).alias(copies)).drop(copies)
