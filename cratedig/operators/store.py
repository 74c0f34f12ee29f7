"""The stored catalogue: built aside, published as a whole.

A published folder holds immutable versions and pointers to them, small files
that are numbered and never changed. The one with the greatest number counts,
once it is whole. Publishing adds a version and then a pointer, so it needs no
rename and no overwriting, which object stores don't do at once.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from cratedig.operators.merge import firsts, strict_key
from cratedig.schemas import TABLES

#: Pointers that stay with their versions, for readers of the one before.
KEEP, POINTER = 2, "CURRENT-"
#: Tables that a search needs.
NEEDED = ("artists", "release_groups", "releases", "recordings", "tracks")
#: Jobs that run at the same time: a table's last tasks, and what the driver plans, leave cores free.
JOBS = 4
_own: dict[str, str] = {}
_saved: list[str] = []


class MissingTable(LookupError):
    pass


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a folder of its own only in local mode (tests), where none is named."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
    return _own.setdefault("dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at, jvm.org.apache.hadoop.fs.Path


def delete(spark: SparkSession, path: str) -> None:
    fs, at, _ = _fs(spark, path)
    fs.delete(at, True)


def fingerprint(spark: SparkSession, path: str) -> str:
    """Of the files under ``path``: names, sizes and times of change."""
    fs, at, _ = _fs(spark, path)
    files, seen = fs.listFiles(at, True), []
    while files.hasNext():
        x = files.next()
        seen.append(f"{x.getPath()} {x.getLen()} {x.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()


def exists(spark: SparkSession, path: str) -> bool:
    fs, at, _ = _fs(spark, path)
    return fs.exists(at)


def save(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _saved.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Deletes all that ``save`` has written in this process; results that read it must have been stored before."""
    while _saved:
        delete(spark, _saved.pop())


@dataclass(frozen=True)
class Catalog:
    """Tables as Parquet under one folder, the version that ``root`` points to when it is opened; it stays with that one.

    ``parsed`` has the counts of lines by entity where a build has just made it.
    """

    spark: SparkSession
    path: str
    parsed: dict[str, dict[str, int]] | None = None
    root: str | None = None

    def __post_init__(self) -> None:
        if self.root is None:
            object.__setattr__(self, "root", self.path)
            object.__setattr__(self, "path", current(self.spark, self.path) or self.path)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name].columns).parquet(f"{self.path}/{name}") if name in TABLES else self.spark.read.parquet(f"{self.path}/{name}")

    __getitem__ = table

    def has(self, name: str) -> bool:
        return exists(self.spark, f"{self.path}/{name}")


def together(spark: SparkSession, f: Callable, items: Iterable) -> list:
    """``f`` of each item, some at the same time; of errors the first item's is raised, once nothing runs any more."""
    with ThreadPoolExecutor(JOBS) as pool:
        return list(pool.map(inheritable_thread_target(spark)(f), items))


def resolve(rows: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Flattened rows to tables: repeated keys are an error in strict tables, else the first wins."""

    def one(name: str) -> DataFrame:
        t = TABLES[name]
        # a repeated id is an error of the parent's
        return strict_key(rows[name], t.key).select(*t.names) if t.strict else firsts(rows[name], t, t.parent in rows)

    spark = next(iter(rows.values())).sparkSession
    return dict(zip(rows, together(spark, one, rows), strict=True))


def catalog_check(catalog: Catalog, needed: tuple[str, ...] = NEEDED) -> Catalog:
    """``catalog``, or an error that names the first table it lacks."""
    for name in needed:
        if not catalog.has(name):
            raise MissingTable(f"table {name} is missing")
    return catalog


def _pointers(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version) of the whole pointers of a folder, the newest first."""
    fs, at, _ = _fs(spark, path)
    if not fs.exists(at):
        return []
    jvm, out = spark.sparkContext._jvm, []
    for status in fs.listStatus(at):
        name = status.getPath().getName()
        if name.startswith(POINTER):
            stream = fs.open(status.getPath())
            try:
                said = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if said.endswith("\n"):  # else it is being written
                out.append((int(name.removeprefix(POINTER)), said.strip()))
    return sorted(out, reverse=True)


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the version that counts."""
    found = _pointers(spark, path)
    return f"{path}/{found[0][1]}" if found else None


def point(fs, at, version: str) -> None:
    """Writes a new pointer; fails if it is there already."""
    stream = fs.create(at, False)
    stream.write(bytearray(f"{version}\n".encode()))
    stream.close()


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> Catalog:
    """Runs ``write`` on the folder of a new version and points to it.

    If anything fails, what counted before still does, and the new version is
    gone. Of two that publish at once one fails, at its pointer. Versions older
    than the one before are deleted.
    """
    version = f"v-{uuid.uuid4().hex}"
    fs, root, hadoop_path = _fs(spark, path)
    before = _pointers(spark, path)
    try:
        write(f"{path}/{version}")
        fs.mkdirs(root)
        point(fs, hadoop_path(root, f"{POINTER}{before[0][0] + 1 if before else 1:012d}"), version)
    except BaseException:
        fs.delete(hadoop_path(root, version), True)
        raise
    for number, old in before[KEEP - 1 :]:
        fs.delete(hadoop_path(root, f"{POINTER}{number:012d}"), False)
        fs.delete(hadoop_path(root, old), True)
    return Catalog(spark, f"{path}/{version}", root=path)


#: What files are sorted by, for statistics to prune on.
LAYOUT = {"releases": "barcode", "recording_isrcs": "isrc"}
#: Columns that are looked up by equality, for bloom filters on them.
LOOKED_UP = {"artists": ["mbid"], "release_groups": ["mbid"], "releases": ["mbid", "barcode"], "recordings": ["mbid"], "tracks": ["mbid"], "recording_isrcs": ["isrc"]}


def write_table(name: str, df: DataFrame, path: str) -> None:
    """A table in its layout; its bloom filters are as large as the values of a row group need."""
    out = (df.sortWithinPartitions(LAYOUT[name]) if name in LAYOUT else df).write
    for c in LOOKED_UP.get(name, ()):
        out = out.option(f"parquet.bloom.filter.enabled#{c}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
    out.parquet(path)


def write_catalog(tables: dict[str, DataFrame], path: str, meta: DataFrame | None = None) -> Catalog:
    """All tables or none; the metadata is written last."""
    spark = next(iter(tables.values())).sparkSession

    def write(staging: str) -> None:
        together(spark, lambda name: write_table(name, tables[name], f"{staging}/{name}"), tables)
        if meta is not None:
            meta.write.parquet(f"{staging}/_meta")

    return publish(spark, path, write)
