"""Dumps: archives of JSON lines with metadata members, or lines that were unpacked already."""

from __future__ import annotations

import lzma
import tarfile
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cratedig.functions.text import text
from cratedig.operators.meta import MEMBERS
from cratedig.schemas import ENTITIES

SCHEMA = "entity string, member string, line_no bigint, line string"
#: The largest metadata member that is read.
META_BYTES = 1 << 20
SUFFIX = ".tar.xz"
#: Bytes of a row group of stored lines.
ROW_GROUP = 16 << 20


class UnknownEntity(ValueError):
    pass


def select_entities(raw: str) -> list[str]:
    """The entities of a comma-separated list in their fixed order; a blank one selects all."""
    if not raw.strip():
        return list(ENTITIES)
    asked = {part.strip() for part in raw.split(",")} - {""}
    if unknown := asked - set(ENTITIES):
        raise UnknownEntity(f"unsupported entity {sorted(unknown)[0]!r}")
    if not asked:
        raise UnknownEntity("no entities selected")
    return [e for e in ENTITIES if e in asked]


def latest_dump(spark: SparkSession, root: str, entities: list[str]) -> list[str]:
    """The archives of the newest landed dump, which the file LATEST names."""
    row = spark.read.text(f"{root}/LATEST", wholetext=True).select(text(F.col("value")).alias("name")).first()
    if row is None or not row["name"]:
        raise FileNotFoundError(f"{root}/LATEST names no dump")
    return [f"{root}/{row['name']}/{e}{SUFFIX}" for e in entities]


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI (local, hdfs, s3, gs, abfs) and the path in it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


class _Archive(InputPartition):
    """An archive and the names of the members to read from it."""

    def __init__(self, path: str, wanted: frozenset[str]):
        self.path, self.wanted = path, wanted


def entity_of(path: str) -> str:
    return path.rsplit("/", 1)[-1].removesuffix(SUFFIX)


class _Reader(DataSourceReader):
    """Reads chosen members; an archive with none of them isn't opened."""

    def __init__(self, paths: list[str], entities: list[str] | None, members: list[str] | None, heads: bool):
        self.paths, self.entities, self.members, self.heads = paths, entities, members, heads

    def partitions(self) -> list[InputPartition]:
        out = []
        for path in self.paths:
            entity = entity_of(path)
            known = (*MEMBERS, *(() if self.heads else (f"mbdump/{entity}",)))
            wanted = frozenset(m for m in known if self.members is None or m in self.members)
            if wanted and (self.entities is None or entity in self.entities):
                out.append(_Archive(path, wanted))
        return out or [_Archive("", frozenset())]

    def read(self, partition: _Archive) -> Iterator[tuple]:
        if not partition.path:
            return
        entity, left = entity_of(partition.path), set(partition.wanted)
        document = f"mbdump/{entity}"
        where, path = file_system(partition.path)
        try:
            # tarfile's own xz mode ends with the first of several streams, which parallel packers write
            with where.open_input_stream(path, compression=None) as stream, lzma.LZMAFile(stream) as plain, tarfile.open(fileobj=plain, mode="r|") as tar:
                for info in tar:
                    name = "/".join(x for x in info.name.split("/") if x not in ("", "."))
                    if self.heads and name.startswith("mbdump/"):
                        break
                    if name not in left:
                        continue
                    left.discard(name)
                    if name == document:
                        for n, line in enumerate(tar.extractfile(info)):
                            yield entity, name, n, line.decode(errors="replace").removesuffix("\n")
                    else:
                        yield entity, name, 0, tar.extractfile(info).read(META_BYTES).decode(errors="replace")
                    if not left:  # what follows need not be decompressed
                        break
        except (tarfile.TarError, lzma.LZMAError, EOFError) as e:
            raise ValueError(f"{partition.path} can't be read: {e}") from e
        if document in left:
            raise ValueError(f"{partition.path} has no member {document}")


class DumpSource(DataSource):
    """``spark.read.format("dumparchive").option("paths", ...)``; lists are separated by line feeds.

    Options ``entities`` and ``members`` choose what is opened and read; with
    ``heads``, only members before the document member are. They are options, not
    pushed filters: Spark 4.1 keeps the filters that it pushed last for all scans
    of a frame, so that a union of two filtered reads would give wrong rows.
    """

    @classmethod
    def name(cls) -> str:
        return "dumparchive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        listed = lambda k: self.options[k].split("\n") if k in self.options else None
        return _Reader([p for p in listed("paths") if p], listed("entities"), listed("members"), self.options.get("heads") == "true")


def read_archives(spark: SparkSession, paths: list[str], entities: list[str] | None = None, members: list[str] | None = None, heads: bool = False) -> DataFrame:
    """Rows (entity, member, line_no, line) of archives, one task for each, of all or the named entities and members.

    One task streams each archive, from any file system that pyarrow opens by
    its URI, up to the last member that is asked for; other archives aren't opened.
    ``heads``: no further than the documents. Bytes that are no UTF-8 become
    replacement characters.
    """
    spark.dataSource.register(DumpSource)
    source = spark.read.format("dumparchive").option("paths", "\n".join(paths)).option("heads", str(heads).lower())
    for name, some in (("entities", entities), ("members", members)):
        if some is not None:
            source = source.option(name, "\n".join(some))
    return source.load()


def read_dump(spark: SparkSession, paths: list[str], partitions: int | None = None) -> DataFrame:
    """``read_archives`` dealt out anew, as an archive can't be split."""
    return read_archives(spark, paths).repartition(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))


def stage_dump(spark: SparkSession, paths: list[str], folder: str) -> DataFrame:
    """``read_archives`` stored under ``folder``: every archive is opened once, in one job, and what is stored can be split.

    A file holds rows of one archive, so filters on entity and member skip the files of others by their statistics.
    """
    rows = read_archives(spark, paths)
    # one task writes all of an archive, and a row group is what a later task reads at least
    rows.write.option("parquet.block.size", ROW_GROUP).parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def read_lines(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """The same rows from unpacked JSON lines by entity, of any size and splittable; line_no grows within a file."""
    out = None
    for entity, path in paths.items():
        rows = spark.read.text(path).select(F.lit(entity).alias("entity"), F.lit(f"mbdump/{entity}").alias("member"), F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"))
        out = rows if out is None else out.unionByName(rows)
    return out


def entity_lines(dump: DataFrame, entity: str, rank: int) -> DataFrame:
    """The document lines of one entity with their place in the order of arrival."""
    return dump.where((F.col("entity") == entity) & (F.col("member") == f"mbdump/{entity}")).select("line", F.lit(rank).alias("source_rank"), "line_no")


def metadata_members(dump: DataFrame) -> DataFrame:
    return dump.where(F.col("member").isin(*MEMBERS)).select("entity", "member", F.col("line").alias("content"))
