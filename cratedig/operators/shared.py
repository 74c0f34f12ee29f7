"""Child rows that many parents have in common: kept once for a list, with the parents that have it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Shared:
    """``rows`` of a table with the list's name in ``foreign``, and ``members``: (foreign, shared), each parent with its list."""

    rows: DataFrame
    members: DataFrame
    foreign: str

    def per_list(self, f: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """(foreign, ...): ``f(rows)``, which has one row for a list, for each of its parents.

        The lists are hashed and the parents pass by; parents times rows are never there.
        """
        lists = f(self.rows).withColumnRenamed(self.foreign, "shared")
        return self.members.join(lists.hint("shuffle_hash"), "shared").drop("shared")

    def table(self, names: Sequence[str]) -> DataFrame:
        """The rows of every parent, which are as many as parents times rows: made by an explode, behind all shuffles."""
        others, spark = [n for n in names if n != self.foreign], self.members.sparkSession
        # a number of partitions that stays: by the bytes that are shuffled a few would do
        dealt = replace(self, members=self.members.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shared"))
        lists = dealt.per_list(lambda rows: rows.groupBy(self.foreign).agg(F.collect_list(F.struct(*others)).alias("_rows")))
        return lists.select(self.foreign, F.explode("_rows").alias("_row")).select(*(F.col(n) if n == self.foreign else F.col(f"_row.{n}").alias(n) for n in names))


def _shared(t: Mapping[str, DataFrame], name: str) -> Shared | None:
    return t.shared(name) if hasattr(t, "shared") else None


def per_parent(t: Mapping[str, DataFrame], name: str, foreign: str, f: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``f(t[name])``, which has one row for each value of ``foreign``; worked out once for a list where ``t`` has lists."""
    found = _shared(t, name)
    return found.per_list(f) if found else f(t[name])


def with_children(parents: DataFrame, t: Mapping[str, DataFrame], name: str, foreign: str, f: Callable[[DataFrame], DataFrame], on: str = "mbid") -> DataFrame:
    """``parents`` with the columns of ``per_parent``; a list's row is added behind the shuffles of parents."""
    found = _shared(t, name)
    if not found:
        return parents.join(f(t[name]).withColumnRenamed(foreign, on), on, "left")
    lists = f(found.rows).withColumnRenamed(foreign, "shared")
    return parents.join(found.members.withColumnRenamed(foreign, on), on, "left").join(lists.hint("shuffle_hash"), "shared", "left").drop("shared")
