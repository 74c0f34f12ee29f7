"""Keys: strict tables, and first wins in a defined order."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratedig.schemas import Table

#: The order of arrival: rank of the source, line, and positions within the document.
ORDER = ("source_rank", "line_no", "at")
#: Items whose keys are compared each with each.
FEW = 16


class RepeatedKey(ValueError):
    pass


def array_first_wins(items: Column, key: Callable[[Column], Column]) -> Column:
    """The items whose key no item before them has; no shuffle.

    Keys are computed once, sorted with their places, and the first of each put
    back in order. Each step is bound to a lambda's argument, as what a lambda
    takes from outside is evaluated anew for every element. Few items are
    compared first, and stay as they are if no key is repeated.
    """
    bound = lambda x, f: F.get(F.transform(F.array(x), f), F.lit(0))

    def sifted(items: Column) -> Column:
        keyed = F.sort_array(F.transform(items, lambda x, i: F.struct(key(x).alias("key"), i.alias("at"), x.alias("item"))))
        kept = bound(keyed, lambda s: F.filter(s, lambda x, j: (j == 0) | ~x["key"].eqNullSafe(F.get(s, j - 1)["key"])))
        placed = F.sort_array(F.transform(kept, lambda x: F.struct(x["at"].alias("at"), x["item"].alias("item"))))
        return F.transform(placed, lambda x: x["item"])

    # comparing each with each is quick for few alone
    alone = lambda a: (F.size(a) <= FEW) & (F.size(F.array_distinct(F.transform(a, key))) == F.size(a))
    return bound(items, lambda a: F.when((F.size(a) <= 1) | alone(a), a).otherwise(sifted(a)))


def first_wins(rows: DataFrame, key: Sequence[str], order: Sequence[str | Column] = ORDER) -> DataFrame:
    """Of the rows of a key the first in ``order``; losers are pruned before the shuffle too."""
    best = Window.partitionBy(*key).orderBy(*order)
    return rows.withColumn("_turn", F.row_number().over(best)).where("_turn = 1").drop("_turn")


def firsts(rows: DataFrame, t: Table, alone: bool = False) -> DataFrame:
    """Of the rows of a table's key the first. ``alone``: no two of the documents that they are made of have the same id.

    A window shuffles and sorts every row whole. It is needed only where rows of a key differ and may meet: those of a
    table without other columns are the same, and those of ``parent``'s documents meet only if an id is repeated.
    """
    if alone and t.parent:
        return rows.select(*t.names)
    return rows.select(*t.names).distinct() if set(t.names) == set(t.key) else first_wins(rows, t.key).select(*t.names)


def key_violations(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """The keys that several rows have, with the number of rows."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def strict_key(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """``rows``, or an error that names some repeated keys."""
    if found := key_violations(rows, key).limit(5).collect():
        raise RepeatedKey(f"repeated {', '.join(key)}: {[tuple(r)[:-1] for r in found]}")
    return rows
