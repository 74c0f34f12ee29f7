"""Point lookups: entities by id, barcode or ISRC, without a pattern and without reading what can't hold the value.

The equalities reach the scans. Published tables have bloom filters on these
columns, so row groups that don't hold the value are skipped though their
smallest and greatest values enclose it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: By entity its table, the title's column and the columns that a value may equal.
EXACT = {
    "artist": ("artists", "name", ("mbid",)),
    "release_group": ("release_groups", "title", ("mbid",)),
    "release": ("releases", "title", ("mbid", "barcode")),
    "recording": ("recordings", "title", ("mbid",)),
    "track": ("tracks", "title", ("mbid",)),
}
#: Recordings of one ISRC that are looked up by their ids; more are joined.
PUSHED = 400


def equal_to_any(pairs: Sequence[tuple[str, str]]) -> Column:
    """Some column of the (column, value) pairs equals its value.

    Single equalities, as a long IN is pushed as a range only, which no bloom
    filter answers; halved again and again, as a chain of some hundred overflows the stack.
    """
    parts = [F.col(c) == value for c, value in pairs]
    while len(parts) > 1:
        parts = [a | b for a, b in zip(parts[::2], parts[1::2], strict=False)] + parts[len(parts) & ~1 :]
    return parts[0]


def _of_isrc(t: Mapping[str, DataFrame], value: str) -> DataFrame:
    """The recordings that have the ISRC or the id ``value``."""
    keys = t["recording_isrcs"].where(F.col("isrc") == value).select(F.col("recording_mbid").alias("mbid")).distinct()
    few = [r["mbid"] for r in keys.limit(PUSHED + 1).collect()]
    own = F.col("mbid") == value
    if len(few) <= PUSHED:
        return t["recordings"].where(equal_to_any([("mbid", k) for k in (value, *few)]))
    found = t["recordings"].join(keys.where(~own), "mbid", "left_semi")
    return found.unionByName(t["recordings"].where(own))


def lookup(t: Mapping[str, DataFrame], value: str) -> DataFrame:
    """(entity_type, matched, mbid, title): every entity whose id, barcode or ISRC is exactly ``value``.

    ``matched`` names the column that does, the id if it is among several. Case
    and blanks count. An empty value is an error, since barcodes may be empty.
    """
    if not value:
        raise ValueError("the value is empty")
    out = None
    for kind, (table, title, columns) in EXACT.items():
        if kind == "recording":
            rows, matched = _of_isrc(t, value), F.when(F.col("mbid") == value, "mbid").otherwise("isrc")
        else:
            rows = t[table].where(equal_to_any([(c, value) for c in columns]))
            matched = F.coalesce(*(F.when(F.col(c) == value, c) for c in columns))
        part = rows.select(F.lit(kind).alias("entity_type"), matched.alias("matched"), "mbid", F.col(title).alias("title"))
        out = part if out is None else out.unionByName(part)
    return out
