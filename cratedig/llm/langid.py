"""Language identification: script ranges, per-word scores, and Viterbi over words.

A word's script narrows the languages to those that use it in training; its
score for each of these is the log-likelihood of its character n-grams and of
the word itself. The most likely sequence of languages under a penalty for
each switch labels the words, so a text of several languages falls into spans.
A document's language is the one that labels most of its letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratedig.llm._letters import SCRIPTS, Words, tables
from cratedig.llm._util import doc_fold, ragged, text_chunks

#: Documents of each language that training reads, as expected number: a draw by hash of the id.
TRAINING_DOCUMENTS = 4000
BITS = 16
GRAMS = range(1, 5)
#: What a change of language costs, in units of a word's log-likelihood.
SWITCH = 8.0
#: Weight of the n-grams' log-likelihoods, which overlap.
TEMPER = 0.3
UNKNOWN = "und"
#: Bytes of text and distinct words worked on at once; a longer text is worked on whole, at some 80 bytes of memory a character.
_BYTES = 1 << 18
_WORDS = 1 << 14
#: Words of a row that are labelled one after another.
_BLOCK = 256


@dataclass(frozen=True)
class Model:
    languages: list[str]
    #: log-likelihoods, 2**BITS by language
    gram: np.ndarray
    #: whether a language uses a script, script by language
    uses: np.ndarray


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    script = tables()[2]
    for batch in batches:
        column = batch.column("lang")
        for lang in sorted(column.unique().to_pylist()):
            for _, texts in text_chunks(batch.column("text").filter(pc.equal(column, lang)), _BYTES):
                words = Words(texts)
                first, inverse = words.distinct()
                often = np.bincount(inverse, minlength=len(first))
                sums = np.zeros(1 << BITS)
                for lo in range(0, len(first), _WORDS):
                    of, bucket = words.grams(first[lo : lo + _WORDS], GRAMS, BITS)
                    sums += np.bincount(bucket, weights=often[lo + of], minlength=1 << BITS)
                scripts = np.bincount(script[words.low[words.start]], minlength=len(SCRIPTS) + 1)
                keys = np.concatenate([np.flatnonzero(sums), -1 - np.flatnonzero(scripts)])
                n = np.concatenate([sums[sums > 0], scripts[scripts > 0]]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys), pa.array(n)], names=["lang", "feature", "n"])


def train(documents: DataFrame, most: int = TRAINING_DOCUMENTS) -> Model:
    """Counts n-grams over about ``most`` different texts of each non-null language (all, if fewer).

    A text counts once a language, however often it is repeated, so neither a hot
    id nor a hot text fills the sample. What reaches the driver is bounded by
    languages times 2**BITS counts.
    """
    labelled = documents.where("lang is not null and text is not null").select(F.col("lang"), "text", F.xxhash64("text").alias("th"))
    share = labelled.groupBy("lang").agg((F.lit(float(most)) / F.count_distinct("th")).alias("share"))
    draw = F.pmod(F.xxhash64("th"), F.lit(1 << 30)) / float(1 << 30)
    drawn = labelled.withColumn("draw", draw).join(F.broadcast(share), "lang").where("draw < share").groupBy("lang", "th").agg(F.first("text").alias("text"))
    sums = drawn.select("lang", "text").mapInArrow(_count, "lang string, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    table = sums.toArrow()
    languages = sorted(set(table["lang"].to_pylist()))
    index = {x: i for i, x in enumerate(languages)}
    lang = np.array([index[x] for x in table["lang"].to_pylist()], np.int64)
    feature, n = table["feature"].to_numpy(), table["n"].to_numpy()
    counts = np.zeros((1 << BITS, len(languages)))
    scripts = np.zeros((len(SCRIPTS) + 1, len(languages)))
    gram = feature >= 0
    np.add.at(counts, (feature[gram], lang[gram]), n[gram])
    np.add.at(scripts, (-1 - feature[~gram], lang[~gram]), n[~gram])
    smooth = counts + 0.5
    return Model(languages, np.log(smooth / smooth.sum(axis=0)).astype(np.float32), scripts >= 0.01 * np.maximum(1, scripts.sum(axis=0)))


def word_scores(words: Words, model: Model) -> np.ndarray:
    """Log-likelihood of every word in every language; far below for languages that do not use its script."""
    first, inverse = words.distinct()
    sums = np.zeros((len(first), len(model.languages)), np.float32)
    for lo in range(0, len(first), _WORDS):
        part = first[lo : lo + _WORDS]
        of, bucket = words.grams(part, GRAMS, BITS)
        order = np.argsort(of, kind="stable")
        sums[lo : lo + len(part)] = np.add.reduceat(model.gram[bucket[order]], np.searchsorted(of[order], np.arange(len(part)))) * TEMPER
    uses = model.uses[tables()[2][words.low[words.start[first]]]]
    none = ~uses.any(axis=1)
    sums = np.where(uses, sums, sums.min(axis=1, keepdims=True) - 25.0)
    sums[none] = 0.0  # a script that no language uses tells nothing
    return (sums - sums.max(axis=1, keepdims=True))[inverse]


def _settled(scores: np.ndarray, first: np.ndarray, row: np.ndarray, best: np.ndarray, penalty: float) -> np.ndarray:
    """Rows whose best path never leaves the language best overall.

    That is so if no run of words gains more than one switch costs by any other
    language, and no run from the start and one to the end gain more than that
    together: j runs elsewhere make j switches at least, or j - 1 if they are
    the whole text, in which case the first and the last are such runs.
    """
    out = np.ones(len(first), bool)
    head, tail = np.zeros(len(first)), np.zeros(len(first))
    last = np.append(first[1:], len(row)) - 1
    shift = row * (50.0 * scores.shape[0] + 1e6)
    for k in range(scores.shape[1]):
        gain = np.cumsum(scores[:, k].astype(np.float64) - scores[np.arange(len(row)), best[row]])
        before = np.concatenate([[0.0], gain[:-1]])
        # rows are shifted down one after another, so that the running minimum never reaches back
        low = np.minimum.accumulate(before - shift) + shift
        own = best == k
        out &= (np.maximum.reduceat(gain - low, first) <= penalty) | own
        head = np.maximum(head, np.where(own, 0, np.maximum.reduceat(gain, first) - before[first]))
        tail = np.maximum(tail, np.where(own, 0, gain[last] - np.minimum.reduceat(before, first)))
    return out & (head + tail <= penalty)


def _alive(size: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """An order of falling size, and for each step how many of it are longer than that."""
    order = np.argsort(-size, kind="stable")
    return order, [int(np.searchsorted(-size[order], -t)) for t in range(int(size.max(initial=0)))]


def _transfers(scores: np.ndarray, start: np.ndarray, size: np.ndarray, penalty: float) -> np.ndarray:
    """For each block of words the best score by the language before it and that of its last word."""
    order, alive = _alive(size)
    at = start[order]
    value = np.where(np.eye(scores.shape[1], dtype=bool), 0.0, -penalty) + scores[at].astype(np.float64)[:, None, :]
    for t in range(1, len(alive)):
        now = value[: alive[t]]
        value[: alive[t]] = np.maximum(now, now.max(axis=2, keepdims=True) - penalty) + scores[at[: alive[t]] + t][:, None, :]
    out = np.empty_like(value)
    out[order] = value
    return out


def _ends(step: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The languages before and at the end of each block on the best path of its row (-1: none before the first)."""
    first = np.cumsum(blocks) - blocks
    order, alive = _alive(blocks)
    value = step[first[order]].max(axis=1)
    back = np.full(step.shape[::2], -1)
    for k in range(1, len(alive)):
        at = first[order[: alive[k]]] + k
        ways = value[: alive[k], :, None] + step[at]
        back[at], value[: alive[k]] = ways.argmax(axis=1), ways.max(axis=1)
    leave = np.full(len(step), -1)
    leave[first[order] + blocks[order] - 1] = value.argmax(axis=1)
    for k in range(len(alive) - 1, 0, -1):
        at = first[order[: alive[k]]] + k
        leave[at - 1] = back[at, leave[at]]
    enter = np.concatenate([[-1], leave[:-1]])
    enter[first] = -1
    return enter, leave


def _walk(scores: np.ndarray, start: np.ndarray, size: np.ndarray, enter: np.ndarray, leave: np.ndarray, penalty: float, labels: np.ndarray) -> None:
    """Writes the best path of each block between its ends to ``labels``; blocks are stepped in lockstep."""
    order, alive = _alive(size)
    at, own = start[order], np.arange(scores.shape[1])
    free = (enter[order] < 0)[:, None] | (own == enter[order][:, None])
    value = scores[at].astype(np.float64) - np.where(free, 0.0, penalty)
    back = np.zeros((len(alive), len(at), len(own)), np.int8 if len(own) < 128 else np.int16)
    for t in range(1, len(alive)):
        n = alive[t]
        top = value[:n].argmax(axis=1)
        switch = value[np.arange(n), top] - penalty
        stay = value[:n] >= switch[:, None]
        back[t, :n] = np.where(stay, own, top[:, None])
        value[:n] = np.where(stay, value[:n], switch[:, None]) + scores[at[:n] + t]
    state = np.where(leave[order] < 0, value.argmax(axis=1), leave[order])
    for t in range(len(alive) - 1, -1, -1):
        n = alive[t]
        labels[at[:n] + t] = state[:n]
        state[:n] = back[t, np.arange(n), state[:n]]


def best_labels(scores: np.ndarray, counts: np.ndarray, penalty: float = SWITCH, block: int = _BLOCK) -> np.ndarray:
    """The most likely language of each word; ``counts`` words per row, none of them 0.

    Rows are cut into blocks, all of which are stepped at once, first for the best
    score between any two languages at a block's ends, then, with the ends known,
    for the path. So a very long row takes as few steps as many short ones.
    """
    if not len(counts):
        return np.zeros(0, np.int16)
    first = np.cumsum(counts) - counts
    row = np.repeat(np.arange(len(counts)), counts)
    best = np.add.reduceat(scores.astype(np.float64), first).argmax(axis=1)
    labels = best[row].astype(np.int16)
    rest = np.flatnonzero(~_settled(scores, first, row, best, penalty))
    if not len(rest):
        return labels
    blocks = -(-counts[rest] // block)
    of, step = ragged(blocks)
    start = first[rest][of] + step * block
    size = np.minimum(block, (first + counts)[rest][of] - start)
    enter = leave = np.full(len(of), -1)
    if (blocks > 1).any():
        many = blocks[of] > 1
        ends = _ends(_transfers(scores, start[many], size[many], penalty), blocks[blocks > 1])
        enter, leave = np.full((2, len(of)), -1)
        enter[many], leave[many] = ends
    _walk(scores, start, size, enter, leave, penalty, labels)
    return labels


def _predict(shared, penalty: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = [*model.languages, UNKNOWN]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
        for batch in batches:
            for lo, texts in text_chunks(batch.column("text"), _BYTES):
                words = Words(texts)
                rows = len(texts)
                lang, score = np.full(rows, len(names) - 1), np.zeros(rows)
                spans: list[list[dict]] = [[] for _ in range(rows)]
                if len(words.hash) and model.languages:
                    scores = word_scores(words, model)
                    full = np.flatnonzero(words.counts)
                    label = best_labels(scores, words.counts[full], penalty)
                    width = (words.end - words.start).astype(np.float64)
                    mass = np.bincount(words.row * len(model.languages) + label, weights=width, minlength=rows * len(model.languages)).reshape(rows, -1)
                    lang[full] = mass[full].argmax(axis=1)
                    odds = np.exp(scores)
                    sure = (odds / odds.sum(axis=1, keepdims=True))[np.arange(len(label)), label] * (label == lang[words.row])
                    score = np.minimum(1.0, np.bincount(words.row, weights=sure * width, minlength=rows) / np.maximum(1.0, mass.sum(axis=1)))
                    new = np.flatnonzero(np.concatenate([[True], (np.diff(label) != 0) | (np.diff(words.row) != 0)]))
                    last = np.append(new[1:], len(label)) - 1
                    base = words.offs[words.row[new]]
                    for r, a, b, k in zip(words.row[new].tolist(), (words.start[new] - base).tolist(), (words.end[last] - base).tolist(), label[new].tolist(), strict=True):
                        spans[r].append({"start": a, "end": b, "lang": names[k]})
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(lo, rows) for c in ("doc_id", "th")), pa.array([names[k] for k in lang], pa.string()), pa.array(score), pa.array(spans, kind)], names=["doc_id", "th", "lang_pred", "score", "spans"]
                )

    return run


def identify(documents: DataFrame, model: Model, penalty: float = SWITCH) -> DataFrame:
    """Per row: doc_id, th, lang_pred, score, and spans (start, end, lang; code points, end exclusive).

    A text that is null or has no letter is ``und`` with score 0 and no span, as
    is every text if the model knows no language. The score is the letters
    labelled lang_pred, each weighed with its word's posterior, over all
    letters. Ties go to the language first in code point order. Only the text
    is read; repeated rows get equal results and an empty table none.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    return docs.mapInArrow(_predict(shared, penalty), "doc_id long, th long, lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>")


def train_and_identify(documents: DataFrame) -> DataFrame:
    """Learns from the rows outside fold 0 and labels all; held_out tells which were not learned from."""
    model = train(documents.where(doc_fold(F.col("doc_id")) != 0))
    return identify(documents, model).withColumn("held_out", doc_fold(F.col("doc_id")) == 0)


def drop_unknown(documents: DataFrame) -> DataFrame:
    """``documents`` without rows of no known language: null texts and texts without a letter."""
    bad = train_and_identify(documents).where(F.col("lang_pred") == UNKNOWN).select(F.col("doc_id").alias("__id"), F.col("th").alias("__th")).distinct()
    same = documents["doc_id"].cast("long").eqNullSafe(bad["__id"]) & (F.xxhash64(documents["text"]) == bad["__th"])
    return documents.join(bad, same, "left_anti")
