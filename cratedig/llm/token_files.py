"""Token ids in files, entropy-coded for parallel reading.

A folder holds ``frequencies`` (one table, shared by all files), files of
blocks, and ``manifest``, which is written last: what it doesn't name, files of
lost attempts, is never read. A file is

    magic, crc32 of the table | blocks | index | length and crc32 of the index, magic

The index has a checkpoint for each block (place, length, symbols, crc32) and,
for each document, its id, its number of ids and their crc32. Documents stand
in ascending order of their ids over the files of the manifest. Blocks come in
groups that begin with a document; a task reads any run of groups.
"""

from __future__ import annotations

import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, chain
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from tokenizers import Tokenizer

from cratedig.llm._util import column_bytes, row_chunks, save
from cratedig.llm.rans import BITS, BLOCK, Coder, quantised
from cratedig.sources.dump import file_system

MAGIC = b"TOKENS01"
#: Symbols of a group, but for a longer document; bytes of a file after which another begins; bytes that a task reads.
GROUP, FILE, TASK = 32 * BLOCK, 1 << 27, 1 << 24
#: Bytes of text that are tokenized together, and words whose ids are remembered in a worker.
CHUNK, WORDS = 1 << 21, 1 << 20
#: How a tokenizer takes texts apart, and the same for words of printable ASCII and letters up to U+017F made small.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile("[!-~À-ÖØ-öø-įı-ſ]+").fullmatch
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-z0-9ß-öø-ſ]+").findall
#: Bytes that are no printable Latin-1, and the characters that stand for them in a byte-level model.
_BYTES = {b: 256 + i for i, b in enumerate((*range(0x21), *range(0x7F, 0xA1), 0xAD))}
_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


# -- tokenizing -----------------------------------------------------------------------------------------------------


class _Words:
    """Ids of texts by their words, for a tokenizer that drops blanks and joins no piece across them.

    Each distinct word is encoded once. A word of letters is one piece, which
    ends with the tokenizer's mark of word ends; many of them are encoded as one
    text and taken apart at these marks, if there are as many marks as words.
    With a tokenizer that takes words apart by PIECES, ``split``, a word of
    plain characters is taken apart here and its pieces go to the model itself.
    """

    def __init__(self, tokenizer: Tokenizer, suffix: str, kind: str, split: bool = False):
        self.tokenizer, self.kind, self.split = tokenizer, kind, split
        self.model = tokenizer.model
        self.ends = np.zeros(tokenizer.get_vocab_size(), bool)
        for token, i in tokenizer.get_vocab().items():
            self.ends[i] = token.endswith(suffix)
        self.clear()

    def clear(self) -> None:
        # the ids as bytes, so that a text's are those of its words, joined; a word is a core and a tail, both pieces
        self.word: dict[str, bytes] = {"": b""}
        self.piece: dict[str, bytes] = {"": b""}

    def _encoded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, and how many each has."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        return np.array(list(chain.from_iterable(ids)), np.uint32), np.array([len(x) for x in ids], np.int64)

    def _add(self, pieces: list[str], letters: bool) -> None:
        for lo in range(0, len(pieces), 512):
            part = pieces[lo : lo + 512]
            if letters:
                ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
                n = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
            if not letters or len(n) != len(part) or n.sum() != len(ids):
                ids, n = self._encoded(part)
            data, ends = ids.astype(self.kind).tobytes(), (np.cumsum(n) * np.dtype(self.kind).itemsize).tolist()
            self.piece.update(zip(part, (data[a:b] for a, b in zip([0, *ends], ends, strict=False)), strict=True))

    def _learn(self, words: list[str]) -> None:
        if self.split:
            known, tokenize, code = self.piece, self.model.tokenize, "H" if self.kind == "<u2" else "I"
            for w in words:
                if not _PLAIN(w) or "<|" in w:
                    continue
                low, ids = w.lower(), []
                for p in (low,) if low.isalpha() else _PIECES(low):
                    if (x := known.get(p)) is None:
                        found = tokenize(p if p.isascii() else p.encode().decode("latin-1").translate(_BYTES))
                        x = known[p] = struct.pack(f"<{len(found)}{code}", *(t.id for t in found))
                    ids.append(x)
                self.word[w] = ids[0] if len(ids) == 1 else b"".join(ids)
            words = [w for w in words if w not in self.word]
        cores = [w.rstrip(_PUNCTUATION) for w in words]
        # letters that stay letters: a mark that comes out of one, as of U+0130 in lower case, is a piece with what follows
        plain = [c.isalpha() and (c.isascii() or normalize("NFC", c).lower().isalpha()) for c in cores]
        cores = [c if ok else w for w, c, ok in zip(words, cores, plain, strict=True)]
        tails = [w[len(c) :] for w, c in zip(words, cores, strict=True)]
        fresh = dict.fromkeys(c for c, ok in zip(cores, plain, strict=True) if ok)
        self._add([c for c in fresh if c not in self.piece], True)
        others = dict.fromkeys(chain(tails, (c for c, ok in zip(cores, plain, strict=True) if not ok)))
        self._add([c for c in others if c not in self.piece], False)
        self.word.update((w, self.piece[c] + self.piece[t]) for w, c, t in zip(words, cores, tails, strict=True))

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.word) > WORDS:
            self.clear()
        lists = [t.replace("\n", " ").replace("\t", " ").split(" ") for t in texts]
        words = list(chain.from_iterable(lists))
        ids = list(map(self.word.get, words))
        if None in ids:
            unknown = [i for i, x in enumerate(ids) if x is None]
            self._learn(list(dict.fromkeys(words[i] for i in unknown)))
            for i in unknown:
                ids[i] = self.word[words[i]]
        ends = list(accumulate(map(len, lists), initial=0))
        return [b"".join(ids[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def _splits(js: dict) -> bool:
    """Whether a tokenizer makes letters small and takes words apart by PIECES, and does no more to plain characters."""
    normal = (js.get("normalizer") or {}).get("normalizers", [])
    first, *bytes_ = (js.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return (
        [x["type"] for x in normal] == ["NFC", "Replace", "Lowercase"]
        and (normal[1]["pattern"], normal[1]["content"]) == ({"Regex": r"\s+"}, " ")
        and first.get("pattern") == {"Regex": PIECES}
        and [(x["type"], x["add_prefix_space"], x["use_regex"]) for x in bytes_] == [("ByteLevel", False, False)]
        and (js["model"]["type"], js["model"].get("dropout")) == ("BPE", None)
        and js.get("post_processor") is None
        and all(t["content"].startswith("<|") for t in js["added_tokens"])
    )


_held: dict[int, object] = {}


def _encoder(spec: str, kind: str):
    """What turns texts into ids, as bytes of ``kind``; one for each worker, as it remembers words."""
    key = zlib.crc32(f"{kind} {spec}".encode())
    if key not in _held:
        _held.clear()
        js, tokenizer = json.loads(spec), Tokenizer.from_str(spec)
        pre = js.get("pre_tokenizer") or {}
        first = (pre.get("pretokenizers") or [pre])[0]
        suffix = js["model"].get("end_of_word_suffix")
        apart = suffix and first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and not any(c.isspace() for t in js["added_tokens"] for c in t["content"])
        probe = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
        if apart and probe("Ab, c\n\td.") == probe("Ab,") + probe("c") + probe("d."):
            _held[key] = _Words(tokenizer, suffix, kind, _splits(js))
        else:
            _held[key] = lambda texts: [np.array(e.ids, kind).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    return _held[key]


def _tokenize(spec, end: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, press = _encoder(spec.value, kind), zstandard.ZstdCompressor(level=1)
        tail = np.array([end], kind).tobytes()
        for batch in batches:
            text = batch.column("text")
            for lo, hi in row_chunks(column_bytes(text)[1], CHUNK):
                packed = [press.compress(x + tail) for x in encode([t or "" for t in text.slice(lo, hi - lo).to_pylist()])]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), batch.column("th").slice(lo, hi - lo), pa.array(packed, pa.binary())], names=["doc_id", "th", "ids"])

    return run


def _unpacked(packed: list[bytes], kind: str) -> list[np.ndarray]:
    press = zstandard.ZstdDecompressor()
    return [np.frombuffer(press.decompress(x), kind) for x in packed]


def _counted(vocabulary: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, n = np.zeros(vocabulary, np.int64), [], 0
        for batch in batches:
            for x in _unpacked(batch.column("ids").to_pylist(), kind):
                held.append(x)
                n += len(x)
                if n > vocabulary:
                    total += np.bincount(np.concatenate(held), minlength=vocabulary)
                    held, n = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=vocabulary)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(some, pa.int32()), "n": pa.array(total[some], pa.int64())})

    return run


# -- files ----------------------------------------------------------------------------------------------------------


def _put(path: str, data: bytes) -> None:
    where, at = file_system(path)
    where.create_dir(at.rsplit("/", 1)[0])
    with where.open_output_stream(at, compression=None) as out:
        out.write(data)


def _get(path: str) -> bytes:
    where, at = file_system(path)
    with where.open_input_stream(at, compression=None) as stream:
        return stream.read()


def _table(data: bytes) -> np.ndarray:
    body, crc = data[:-4], int.from_bytes(data[-4:], "little")
    if not body.startswith(MAGIC) or zlib.crc32(body) != crc:
        raise ValueError("the frequencies are damaged")
    return np.frombuffer(body, "<u4", offset=len(MAGIC)).astype(np.int64)


class _File:
    """A file in the making; only its index is held."""

    def __init__(self, folder: str, coder: Coder, table_crc: int):
        self.name, self.coder = f"{uuid.uuid4().hex}.tok", coder
        where, at = file_system(f"{folder}/{self.name}")
        self.out = where.open_output_stream(at, compression=None)
        self.size = 0
        self.blocks: list[tuple] = []  # place, length, symbols, crc32
        self.groups: list[tuple] = []  # first document, first block
        self.ids: list[pa.Array] = []
        self.docs: list[tuple] = []  # ids, crc32
        self._write(MAGIC + table_crc.to_bytes(4, "little"))

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def group(self, doc_ids: pa.Array, ids: list[np.ndarray]) -> None:
        self.groups.append((len(self.docs), len(self.blocks)))
        self.ids.append(doc_ids)
        self.docs += [(len(x), zlib.crc32(x.astype("<u4").tobytes())) for x in ids]
        every = np.concatenate(ids)
        for lo in range(0, len(every), GROUP):  # a document longer than a group is coded part by part
            part = every[lo : lo + GROUP]
            for i, data in enumerate(self.coder.encode(part)):
                self.blocks.append((self.size, len(data), min(BLOCK, len(part) - i * BLOCK), zlib.crc32(data)))
                self._write(data)

    def close(self) -> dict:
        column = lambda rows, i, t: pa.array([r[i] for r in rows], t)
        sink = io.BytesIO()
        tables = {
            "blocks": {n: column(self.blocks, i, pa.int64()) for i, n in enumerate(("place", "length", "symbols", "crc"))},
            "groups": {n: column(self.groups, i, pa.int64()) for i, n in enumerate(("doc", "block"))},
            "docs": {"doc_id": pa.concat_arrays(self.ids), "n": column(self.docs, 0, pa.int64()), "crc": column(self.docs, 1, pa.int64())},
        }
        sizes = []
        for t in tables.values():
            before = sink.tell()
            rows = pa.RecordBatch.from_pydict(t)
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_batch(rows)
            sizes.append(sink.tell() - before)
        index = b"".join(x.to_bytes(8, "little") for x in sizes) + sink.getvalue()
        self._write(index + len(index).to_bytes(8, "little") + zlib.crc32(index).to_bytes(4, "little") + MAGIC)
        self.out.close()
        return {"name": self.name, "bytes": self.size, "docs": len(self.docs), "tokens": sum(n for n, _ in self.docs)}


def _index(stream) -> list[pa.Table]:
    """blocks, groups and docs of an open file."""
    size = stream.size()
    tail = 12 + len(MAGIC)
    end = stream.read_at(tail, size - tail)
    length, crc = int.from_bytes(end[:8], "little"), int.from_bytes(end[8:12], "little")
    index = stream.read_at(length, size - tail - length)
    if end[12:] != MAGIC or zlib.crc32(index) != crc:
        raise ValueError("a file is damaged")
    out, at = [], 24
    for i in range(3):
        n = int.from_bytes(index[8 * i : 8 * i + 8], "little")
        out.append(pa.ipc.open_stream(index[at : at + n]).read_all())
        at += n
    return out


@dataclass
class _Files(WriterCommitMessage):
    partition: int
    files: list[dict]


class _Writer(DataSourceArrowWriter):
    """Sorted (doc_id, th, ids) to files, some for each partition; the manifest names those of the attempts that count."""

    def __init__(self, folder: str, kind: str):
        self.folder, self.kind = folder, kind

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Files:
        table = _get(f"{self.folder}/frequencies")
        coder, crc = Coder(_table(table)), zlib.crc32(table)
        file, done, held, docs, symbols = None, [], [], [], 0

        def flush() -> None:
            nonlocal file, held, docs, symbols
            if held:
                file = file or _File(self.folder, coder, crc)
                file.group(pa.array(docs, pa.int64()), held)
                held, docs, symbols = [], [], 0
                if file.size >= FILE:
                    done.append(file.close())
                    file = None

        for batch in batches:
            packed = batch.column("ids")
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                x = _unpacked([packed[i].as_py()], self.kind)[0]
                if symbols + len(x) > GROUP:
                    flush()
                held.append(x)
                docs.append(doc)
                symbols += len(x)
        flush()
        if file:
            done.append(file.close())
        return _Files(TaskContext.get().partitionId(), done)

    def commit(self, messages: list[_Files | None]) -> None:
        files = [f for m in sorted((m for m in messages if m), key=lambda m: m.partition) for f in m.files]
        _put(f"{self.folder}/manifest", json.dumps({"files": files}).encode())

    def abort(self, messages: list[_Files | None]) -> None:
        for m in messages:
            for f in m.files if m else ():
                where, at = file_system(f"{self.folder}/{f['name']}")
                where.delete_file(at)


@dataclass
class _Run(InputPartition):
    """The groups of a file that fall into part ``turn`` of ``of``; ``start`` ids stand before the file."""

    name: str
    turn: int
    of: int
    start: int


class _Reader(DataSourceReader):
    def __init__(self, folder: str, with_ids: bool):
        self.folder, self.with_ids = folder, with_ids

    def partitions(self) -> list[InputPartition]:
        out, start = [], 0
        for f in json.loads(_get(f"{self.folder}/manifest"))["files"]:
            parts = -(-f["bytes"] // TASK)
            out += [_Run(f["name"], i, parts, start) for i in range(parts)]
            start += f["tokens"]
        return out or [_Run("", 0, 1, 0)]

    def read(self, run: _Run) -> Iterator[pa.RecordBatch]:
        if not run.name:
            return
        table = _get(f"{self.folder}/frequencies")
        coder = Coder(_table(table))
        where, at = file_system(f"{self.folder}/{run.name}")
        with where.open_input_file(at) as stream:
            if stream.read_at(len(MAGIC) + 4, 0) != MAGIC + zlib.crc32(table).to_bytes(4, "little"):
                raise ValueError(f"{run.name} was coded by another table")
            blocks, groups, docs = _index(stream)
            first, block = (groups.column(c).to_numpy() for c in ("doc", "block"))
            n, crc = docs.column("n").to_numpy(), docs.column("crc").to_numpy()
            before = run.start + np.cumsum(n) - n
            lo, hi = (len(first) * k // run.of for k in (run.turn, run.turn + 1))
            for g in range(lo, hi):
                last = g + 1 == len(first)
                d0, d1 = first[g], docs.num_rows if last else first[g + 1]
                mine = blocks.slice(block[g], (blocks.num_rows if last else block[g + 1]) - block[g]).to_pylist()
                data = [stream.read_at(b["length"], b["place"]) for b in mine]
                if any(zlib.crc32(x) != b["crc"] for x, b in zip(data, mine, strict=True)):
                    raise ValueError(f"a block of {run.name} is damaged")
                step = GROUP // BLOCK
                ids = np.concatenate([coder.decode(data[i : i + step], [b["symbols"] for b in mine[i : i + step]]) for i in range(0, len(mine), step)])
                ends = np.cumsum(n[d0:d1])
                got = [zlib.crc32(ids[e - k : e].astype("<u4").tobytes()) for e, k in zip(ends, n[d0:d1], strict=True)]
                if got != crc[d0:d1].tolist():
                    raise ValueError(f"a document of {run.name} is damaged")
                out = [docs.column("doc_id").slice(d0, d1 - d0).combine_chunks(), *(pa.array(x, pa.int64()) for x in (before[d0:d1], n[d0:d1], got))]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if self.with_ids:
                    offsets = np.concatenate([[0], ends]).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)


class TokenFiles(DataSource):
    """``spark.read.format("tokenfiles").option("path", ...)``; option ``ids`` adds them. Written by ``write_token_files``."""

    @classmethod
    def name(cls) -> str:
        return "tokenfiles"

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if self.options.get("ids") == "true" else "")

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], self.options.get("ids") == "true")

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"], self.options["kind"])


def write_token_files(documents: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """The ids of every whole text, ``end_id`` behind each, in files under the new folder ``path``, by doc_id.

    ``tokenizer`` is the file of a tokenizer of the tokenizers library; its
    content is what tasks get. A null text is empty; a null id comes first, rows
    of one id by a hash of their texts. Repeated rows are documents of their own,
    and other columns are ignored. An empty table gives a manifest of no files.
    """
    spark = documents.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    vocabulary = max(Tokenizer.from_str(spec).get_vocab_size(), end_id + 1)
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    told = spark.sparkContext.broadcast(spec)
    tokens = save(docs.mapInArrow(_tokenize(told, end_id, kind), "doc_id long, th long, ids binary"), "tokens")
    counts = tokens.select("ids").mapInArrow(_counted(vocabulary, kind), "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(vocabulary, np.int64)
    for r in counts:
        total[r["id"]] = r["n"]
    body = MAGIC + quantised(total, BITS).astype("<u4").tobytes()
    _put(f"{path}/frequencies", body + zlib.crc32(body).to_bytes(4, "little"))
    spark.dataSource.register(TokenFiles)
    # rows of one id and text part too; they are alike, so their order is of no matter
    keys = ("doc_id", "th", "tie")
    dealt = tokens.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "ids")
    dealt.write.format("tokenfiles").option("path", path).option("kind", kind).mode("append").save()


def read_token_files(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids_crc32 of each document, computed from the decoded ids; and those.

    Checksums of blocks, indexes and documents are compared; a mismatch is an error.
    """
    spark.dataSource.register(TokenFiles)
    return spark.read.format("tokenfiles").option("path", path).option("ids", str(ids).lower()).load()
