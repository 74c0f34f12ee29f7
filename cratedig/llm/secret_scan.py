"""Secrets in texts: fixed patterns, and novelty under a primed zstandard compressor.

The patterns are searched as they are. Beyond them, a string is a candidate
where a word like ``key`` or ``auth`` stands shortly before it. The candidate's
novelty is what it adds to the compressed size of its surroundings, with a
dictionary of identifiers primed, by the byte: names, paths and prose repeat
what is known there, keys do not.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "novel")
#: Marginal compressed bytes of a candidate by its characters, at least. Measured in tests/llm/test_secret_recall.py:
#: at 0.85 nearly all keys of seven shapes pass and few paths and names do; lower adds names, higher loses short keys.
NOVELTY = 0.85
#: Characters of surroundings on each side, and before a candidate in which a sensitive word must stand.
AROUND = 256
CONTEXT = 48

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
_LONG_HEX = re.compile(r"[0-9a-f]{24}")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
SENSITIVE = re.compile(r"key|secret|token|passw|credential|auth|bearer|private|signature", re.IGNORECASE | re.ASCII)
_HINTS = ("key", "secret", "token", "passw", "credential", "auth", "bearer", "private", "signature")

#: Words that identifiers and configuration are made of; the compressor's dictionary.
IDENTIFIERS = """
access account admin algorithm api application args array async auth authorization await base64 bearer body bool
bucket buffer build cache callback certificate class client cloud code config connection const content context
cookie count create credential credentials database debug decode def default delete deploy description digest
document domain dump element else email encode encoding endpoint engine entry env environment error event example
exception export extends false field file filter float format from func function generate getattr global group
handler hash header headers host hostname html http https id if image import index init input insert instance int
interface item json key keys lambda language length level library list load local localhost log logger login map
message method model module name namespace null number object option options output package page param parameter
parse passphrase passwd password path pattern pem pipeline plugin port prefix print private process profile
property protected proxy public query queue read record region register request require resource response result
return role root route salt schema secret select self server service session set settings signature size source
ssh start state static status stream string struct super switch table target template test text this throw time
timeout timestamp title token true type undefined update upload uri url user username uuid value var variable
vector version view void while window worker write xml yaml ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz
0123456789 = "" : '' { } [ ] ( ) ; , -> => == != && || // /* */ # <!-- --> ://www. .com/ .org/ .json .yaml .py
"""


class Novelty:
    def __init__(self, dictionary: str = IDENTIFIERS, level: int = 9):
        primed = zstandard.ZstdCompressionDict(dictionary.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.press = zstandard.ZstdCompressor(level=level, dict_data=primed, write_content_size=False, write_checksum=False)

    def __call__(self, before: str, candidate: str, after: str) -> float:
        """Compressed bytes that the candidate adds to its surroundings, by its characters."""
        # its own copies nearby don't make it known
        around = (after + "\n" + before).replace(candidate, "").encode()
        added = len(self.press.compress(around + candidate.encode())) - len(self.press.compress(around))
        return added / len(candidate)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and non-overlapping per kind, short matches dropped."""
    out = []
    low = text.lower()
    if any(x in low for x in ("passw", "secret", "token", "api")):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    at = 0
    while m := _LONG_HEX.search(text, at):
        run = HEX.match(text, m.start())  # the search stops at a run's first character
        out.append((run.start(), 2, run.end()))
        at = run.end()
    return sorted(out)


def novel_spans(text: str, base: list[tuple[int, int, int]], novelty: Novelty, least: float) -> list[tuple[int, int, int]]:
    """Incompressible candidates in sensitive context that no base span touches."""
    low = text.lower()
    if not any(x in low for x in _HINTS):
        return []
    out = []
    spots = [m.end() for m in SENSITIVE.finditer(text)]
    starts, ends = [a for a, _, _ in base], list(accumulate((b for _, _, b in base), max))
    taken = 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while taken < len(spots) and spots[taken] + CONTEXT < start:
            taken += 1
        if taken == len(spots) or spots[taken] > start:
            continue
        word = m[0]
        if not (any(c.isdigit() for c in word) and any(c.isalpha() for c in word)):
            continue
        # of the base spans that begin before its end, does the one that ends last reach into it?
        if (before := bisect_left(starts, end)) and ends[before - 1] > start:
            continue
        if novelty(text[max(0, start - AROUND) : start], word, text[end : end + AROUND]) >= least:
            out.append((start, 3, end))
    return out


def _scan(least: float, dictionary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(dictionary)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            spans = []
            for text in batch.column("text"):
                text = text.as_py() or ""
                base = base_spans(text)
                every = sorted(base + novel_spans(text, base, novelty, least))
                spans.append([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in every])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("th"), pa.array(spans, kind)], names=["doc_id", "th", "spans"])

    return run


def find_secrets(documents: DataFrame, least: float = NOVELTY, dictionary: str = IDENTIFIERS) -> DataFrame:
    """Per row: doc_id, th and spans (kind, start, end; code points, end exclusive) by start, then kind as in KINDS.

    A null text is empty. Spans of different kinds may overlap; novel ones
    touch no other. Only the text is read, so repeated rows get equal results;
    an empty table gives none.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    return docs.mapInArrow(_scan(least, dictionary), "doc_id long, th long, spans array<struct<kind:string,start:int,end:int>>")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column("spans").to_pylist()
        said = lambda spans: ",".join(f"{x['kind']}:{x['start']}:{x['end']}" for x in spans)
        counts = [pa.array([sum(x["kind"] == k for x in r) for r in rows], pa.int64()) for k in KINDS]
        sha = [hashlib.sha256(said(x for x in r if x["kind"] != "novel").encode()).hexdigest() for r in rows]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts[:3], pa.array(sha), pa.array([said(r) for r in rows], pa.string()), counts[3]], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"])


def secret_report(documents: DataFrame, **parameters) -> DataFrame:
    """Per row: doc_id, the number of spans of each kind, the digest of the base spans, and all spans as text."""
    return find_secrets(documents, **parameters).mapInArrow(_digest, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long")


def redact(documents: DataFrame, mask: str = "[SECRET]", **parameters) -> DataFrame:
    """``documents`` with every span of ``text`` replaced by ``mask``; null texts stay null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(parameters.get("dictionary", IDENTIFIERS))
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                if text is not None:
                    base = base_spans(text)
                    end, parts = 0, []
                    for a, _, b in sorted(base + novel_spans(text, base, novelty, parameters.get("least", NOVELTY))):
                        if b > end:
                            parts += [text[end : max(a, end)], mask if a >= end else ""]
                            end = b
                    text = "".join([*parts, text[end:]])
                out.append(text)
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(out, pa.string()))

    return documents.mapInArrow(run, documents.schema)
