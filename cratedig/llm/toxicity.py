"""Toxicity by weak supervision.

Voters: lexicons of words and word beginnings, a fixed one and several learned
from labelled rows, and patterns of style; each says toxic, clean or nothing.
A generative label model of a hidden class and a forest of dependent voters is
fitted to the votes of all training rows by expectation maximisation: how each
voter votes in either class (its accuracy), and, for pairs that agree beyond
the class, how one votes given the other (their correlation). No label enters
it; labels only put the posterior on the scale of toxic shares afterwards. The
posterior labels of a bounded sample of labelled rows train a linear
classifier on the presence of lexicon entries and votes, which scores the
documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratedig.llm._letters import Words
from cratedig.llm._util import doc_fold, mix, save, text_chunks

#: Labelled documents whose posterior labels train the classifier; an expected number, drawn by hash.
LABELLED = 12_000
#: Learned lexicon entries in all, and voters they are dealt to.
ENTRIES = 4096
VOTERS = 8
#: Toxic documents that must hold an entry, at any corpus size, and the least log-likelihood ratio against equal rates in toxic and clean ones.
SUPPORT = 5
SIGNIFICANCE = 30
#: The least share of toxic documents among those with an entry, smoothed.
PRECISION = 0.85
#: Bytes of text worked on at once (a longer text is worked on whole), and distinct entries counted before they are passed on.
_BYTES = 1 << 19
_KEYS = 1 << 19

#: Insults of four languages, lower case.
INSULTS = """
idiot stupid moron loser pathetic worthless disgusting scum trash clown fool dumb jerk filthy garbage vermin imbecile
idiota estúpido estúpida imbécil basura asqueroso asquerosa payaso patético inútil tonto escoria
idiote stupide imbécile crétin débile ordure pathétique minable abruti raclure
dumm dummkopf trottel abschaum widerlich erbärmlich wertlos müll vollidiot ekelhaft versager
""".split()
#: Letters of a word beginning, and occurrences in a text that make a word or beginning an entry of its own.
_BEGINNINGS = range(4, 7)
_TIMES = (2, 3)


def _entries(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all distinct words and word beginnings of the rows, and again of those that a row holds several times."""
    first, inverse = words.distinct()
    keys = [words.hash]
    rows = [words.row]
    size = words.end[first] - words.start[first]
    for n in _BEGINNINGS:
        has = (size > n)[inverse]
        head = np.zeros(len(first), np.uint64)
        fit = np.flatnonzero(size > n)
        head[fit] = mix(words.span(words.start[first[fit]], words.start[first[fit]] + n) + np.uint64(n))
        keys.append(head[inverse][has])
        rows.append(words.row[has])
    key, row = np.concatenate(keys), np.concatenate(rows)
    order = np.lexsort((key, row))
    key, row = key[order], row[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    times = np.diff(np.append(np.flatnonzero(new), len(key)))
    row, key = row[new], key[new]
    often = [(row[times >= n], mix(key[times >= n] + np.uint64(n))) for n in _TIMES]
    return np.concatenate([row, *(r for r, _ in often)]), np.concatenate([key, *(k for _, k in often)])


_FIXED = np.sort(Words(INSULTS).hash)


def _patterns(texts: list[str | None], words: Words) -> np.ndarray:
    """Rows by votes of the fixed voters: 1 toxic, -1 clean, 0 nothing."""
    n = len(texts)
    letters = np.bincount(words.row, weights=words.end - words.start, minlength=n)
    upper = words.code != words.low
    shout = np.add.reduceat(np.append(upper, False).astype(np.int64), np.minimum(words.offs[:-1], len(upper)))
    shout[np.diff(words.offs) == 0] = 0
    marks = np.array([0 if t is None else t.count("!") + t.count("?!") for t in texts])
    insult = np.bincount(words.row, weights=np.isin(words.hash, _FIXED), minlength=n)
    out = np.zeros((n, 4), np.int8)
    out[:, 0] = insult > 0
    out[:, 1] = np.where(insult >= 3, 1, np.where(insult == 0, -1, 0))
    out[:, 2] = np.where((letters >= 20) & (shout > 0.5 * letters), 1, 0)
    out[:, 3] = np.where(marks > 0.05 * np.maximum(1, words.counts), 1, np.where(marks == 0, -1, 0))
    return out


def _merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    keys, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, *(np.bincount(inverse, weights=np.concatenate([p[k] for p in parts]), minlength=len(keys)) for k in (1, 2))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per entry, the weights of toxic and of all texts that hold it; summed in the task as far as ``_KEYS`` entries allow."""
    held: list[tuple[np.ndarray, ...]] = []
    rows = lambda x: pa.RecordBatch.from_arrays([pa.array(x[0].view(np.int64)), pa.array(x[1]), pa.array(x[2])], names=["key", "bad", "n"])
    for batch in batches:
        toxic, weight = (batch.column(c).to_numpy() for c in ("toxic", "weight"))
        for lo, texts in text_chunks(batch.column("text"), _BYTES):
            row, key = _entries(Words(texts))
            held.append(_merged([(key, (toxic * weight)[lo + row], weight[lo + row])]))
            if sum(len(x[0]) for x in held) > _KEYS:
                held = [_merged(held)]
                if len(held[0][0]) > _KEYS // 2:
                    yield rows(held.pop())
    if held:
        yield rows(_merged(held))


class Lexicon:
    """Learned entries, sorted; a voter votes toxic if the text holds one of its entries."""

    def __init__(self, keys: np.ndarray, voters: int):
        self.keys = np.sort(keys)
        self.voters = voters
        self.voter = (mix(self.keys) % np.uint64(voters)).astype(np.int64)

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, entry) of entries present, and the votes of all voters."""
        words = Words(texts)
        row, key = _entries(words)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            row, entry = row[hit], at[hit]
        else:
            row, entry = row[:0], np.zeros(0, np.int64)
        learned = np.zeros((len(texts), self.voters), np.int8)
        learned[row, self.voter[entry]] = 1
        return row, entry, np.concatenate([learned, _patterns(texts, words)], axis=1)


@dataclass(frozen=True)
class LabelModel:
    """P(class) and, for each voter, P(vote | class) or, below a parent in the forest, P(vote | parent's vote, class)."""

    toxic: float
    #: by voter, class and vote (clean, nothing, toxic)
    accuracy: np.ndarray
    #: by voter its parent or -1, and by voter, class, parent's vote and vote what that makes likely
    parent: np.ndarray
    given: np.ndarray
    likelihood: float

    def joint(self, votes: np.ndarray) -> np.ndarray:
        """Rows by class: log P(class, votes)."""
        out = np.tile(np.log([1 - self.toxic, self.toxic]), (len(votes), 1))
        at = votes.astype(np.int64) + 1
        for j, p in enumerate(self.parent):
            for y in (0, 1):
                out[:, y] += np.log(self.accuracy[j, y, at[:, j]] if p < 0 else self.given[j, y, at[:, p], at[:, j]])
        return out

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        joint = self.joint(votes)
        return 1 / (1 + np.exp(np.clip(joint[:, 0] - joint[:, 1], -50, 50)))


def _forest(pairs: np.ndarray, least: float) -> np.ndarray:
    """By voter its parent, -1 for roots: the forest of most conditional information (Chow and Liu), edges below ``least`` left out."""
    n = pairs.shape[1]
    p = pairs / pairs.sum(axis=(0, 3, 4), keepdims=True).clip(1e-9)
    y = p.sum(axis=(3, 4), keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        part = p * np.log(p * y / (p.sum(axis=4, keepdims=True) * p.sum(axis=3, keepdims=True)))
    info = np.nan_to_num(part, posinf=0, neginf=0).sum(axis=(0, 3, 4))
    np.fill_diagonal(info, -1)
    parent, done, best, via = np.full(n, -1), np.zeros(n, bool), np.full(n, -1.0), np.full(n, -1)
    for _ in range(n):
        j = int(np.argmax(np.where(done, -2, best)))
        parent[j], done[j] = via[j] if best[j] >= least else -1, True
        closer = ~done & (info[j] > best)
        best[closer], via[closer] = info[j][closer], j
    return parent


def label_model(votes: np.ndarray, weight: np.ndarray, rounds: int = 200, least: float = 0.002) -> LabelModel:
    """Fits the label model to distinct rows of ``votes``, each seen ``weight`` times.

    Expectation maximisation from two starts: votes summed up, and summed up
    with copies of a voter counted once (by the inverse of their correlations);
    the likelier end is taken. The toxic class is the one with more toxic votes.
    """
    n, voters = votes.shape
    share = weight / weight.sum()
    center = votes - share @ votes
    scale = np.sqrt(share @ center**2).clip(1e-6)
    unit = center / scale
    corr = (unit * share[:, None]).T @ unit
    says = np.zeros((n, voters, 3))
    says[np.arange(n)[:, None], np.arange(voters), votes.astype(np.int64) + 1] = 1
    flat = says.reshape(n, -1)
    found = []
    for start in (np.ones(voters), np.linalg.solve(corr + 0.05 * np.eye(voters), np.ones(voters))):
        score = unit @ start.clip(0)
        post = 1 / (1 + np.exp(-np.clip(4 * score / max(1e-6, np.sqrt(share @ score**2)) - 2, -20, 20)))
        parent, before = np.full(voters, -1), -np.inf
        for k in range(rounds):
            tables = []
            for p in (1 - post, post):
                tables.append(((flat * (weight * p)[:, None]).T @ flat).reshape(voters, 3, voters, 3).transpose(0, 2, 1, 3))
            pairs = np.stack(tables)  # class, voter, voter, vote, vote
            if k in (1, 3, 6, 10, 20, 40, 60, 80, 100):
                parent = _forest(pairs, least)
            own = pairs[:, np.arange(voters), np.arange(voters)].diagonal(axis1=2, axis2=3).transpose(1, 0, 2) + 0.5
            given = np.full((voters, 2, 3, 3), 1 / 3)
            for j, p in enumerate(parent):
                if p >= 0:
                    # seen seldom, a parent's vote tells what the class alone would
                    alone = own[j] / own[j].sum(axis=1, keepdims=True)
                    table = pairs[:, p, j] + 2 * alone[:, None, :]
                    given[j] = table / table.sum(axis=2, keepdims=True)
            model = LabelModel(float(np.clip(share @ post, 1e-4, 1 - 1e-4)), own / own.sum(axis=2, keepdims=True), parent, given, 0.0)
            joint = model.joint(votes)
            post = 1 / (1 + np.exp(np.clip(joint[:, 0] - joint[:, 1], -50, 50)))
            now = float(share @ np.logaddexp(joint[:, 0], joint[:, 1]))
            if k > 100 and abs(now - before) < 1e-9:
                break
            before = now
        rate = lambda p: (share * p) @ votes.sum(axis=1) / max(1e-9, share @ p)
        if rate(post) < rate(1 - post):
            model = LabelModel(1 - model.toxic, model.accuracy[:, ::-1], model.parent, model.given[:, ::-1], 0.0)
        found.append(replace(model, likelihood=now))
    return max(found, key=lambda m: m.likelihood)


def calibrated(post: np.ndarray, bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    """The posteriors on the scale of the toxic shares among ``bad`` and ``good`` labelled rows: logistic in their log-odds, its slope not below 0.1."""
    x = np.log(post.clip(1e-6, 1 - 1e-6) / (1 - post).clip(1e-6, 1 - 1e-6))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        err, w = (bad + good) * p - bad, (bad + good) * p * (1 - p)
        # a weak pull to the identity keeps few labels from moving it far
        grad = np.array([err @ x + (a - 1), err.sum() + 0.1 * b])
        hess = np.array([[w @ x**2 + 1, w @ x], [w @ x, w.sum() + 0.1]])
        a, b = np.array([a, b]) - np.linalg.solve(hess, grad).clip(-1, 1)
    return 1 / (1 + np.exp(-np.clip(max(a, 0.1) * x + b, -30, 30)))


def linear_classifier(row: np.ndarray, column: np.ndarray, rows: int, columns: int, target: np.ndarray, rounds: int = 300, ridge: float = 1e-4, rate: float = 0.5) -> np.ndarray:
    """Weights of a logistic regression on presence features, the last for the intercept; Adam on the full batch."""
    w = np.zeros(columns + 1)
    w[-1] = np.log(np.clip(target.mean(), 1e-3, 1 - 1e-3) / (1 - np.clip(target.mean(), 1e-3, 1 - 1e-3)))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        z = np.bincount(row, weights=w[column], minlength=rows) + w[-1]
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / rows
        grad = np.append(np.bincount(column, weights=err[row], minlength=columns), err.sum()) + ridge * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= rate * (0.99**t + 0.02) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return w


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    #: by entry, then by voter and vote (clean, nothing, toxic), then the intercept
    weights: np.ndarray


def _significant(docs: DataFrame, gold: DataFrame) -> DataFrame:
    """(key, ratio) of the entries that toxic documents hold significantly more often, counted over all labelled texts.

    Of equal texts one counts, as toxic if any of them is.
    """
    keyed = docs.withColumn("th", F.xxhash64("text"))
    ids = keyed.select("id", "th").join(gold, F.col("id") == F.col("_label")).groupBy("th", "id").agg(F.count("*").alias("rows"), F.max("toxic").alias("toxic"))
    once = save(ids.groupBy("th").agg(F.min(F.struct("id", "rows")).alias("one"), F.max("toxic").cast("double").alias("toxic")).select("th", "one.*", "toxic"), "labelled")
    toxic, known = once.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    # labels grow with the documents, so they meet by a shuffle at every size; repeated rows share the weight of one
    texts = keyed.join(once.hint("merge"), ["id", "th"]).select("text", "toxic", (1 / F.col("rows")).alias("weight"))
    sums = texts.mapInArrow(_count, "key long, bad double, n double").groupBy("key").agg(F.round(F.sum("bad")).alias("bad"), F.round(F.sum("n")).alias("n"))
    rate = (toxic + 0.5) / (known + 1)
    part = lambda seen, share: F.when(seen > 0, seen * F.log(seen / (F.col("n") * share))).otherwise(0.0)
    ratio = 2 * (part(F.col("bad"), rate) + part(F.col("n") - F.col("bad"), 1 - rate))
    odds = (F.col("bad") + 0.5) / (F.col("n") + 1)
    return sums.where((F.col("bad") >= SUPPORT) & (odds >= PRECISION)).select("key", ratio.alias("ratio")).where(F.col("ratio") >= SIGNIFICANCE)


def _gold(labels: DataFrame) -> DataFrame:
    return labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_label")).agg(F.max("toxic").cast("int").alias("toxic"))


def learn_lexicon(documents: DataFrame, labels: DataFrame) -> Lexicon:
    """The entries counted over all labelled documents; at most ENTRIES, the most significant."""
    docs = documents.where("text is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("id"), "text")
    top = _significant(docs, _gold(labels)).orderBy(F.desc("ratio"), "key").limit(ENTRIES).select("key").toArrow()
    return Lexicon(top["key"].to_numpy().view(np.uint64), VOTERS)


_FEATURES = "doc_id long, th long, pattern int, columns array<int>"


def read_features(documents: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Per row: doc_id, text hash th, the votes as one number (base 3, first voter last) and the classifier's columns that are set."""
    shared = documents.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = shared.value
        for batch in batches:
            for lo, texts in text_chunks(batch.column("text"), _BYTES):
                row, entry, votes = lexicon.read(texts)
                i, j = np.nonzero(votes)
                row, column = np.concatenate([row, i]), np.concatenate([entry, len(lexicon.keys) + 3 * j + votes[i, j] + 1])
                offs = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(texts)))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offs), pa.array(column[np.argsort(row, kind="stable")].astype(np.int32)))
                pattern = (votes.astype(np.int64) + 1) @ 3 ** np.arange(votes.shape[1])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, len(texts)) for c in ("doc_id", "th")), pa.array(pattern.astype(np.int32)), lists], names=["doc_id", "th", "pattern", "columns"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th")).mapInArrow(run, _FEATURES)


def _votes(pattern: np.ndarray, voters: int) -> np.ndarray:
    return (pattern[:, None] // 3 ** np.arange(voters) % 3 - 1).astype(np.int8)


def fit(features: DataFrame, labels: DataFrame, lexicon: Lexicon, labelled: int = LABELLED) -> Model:
    """Label model over the votes of all rows of ``features``; classifier on about ``labelled`` rows with a label, by their posteriors.

    What reaches the driver: patterns of votes with their counts, of which there
    are at most 2 ** (VOTERS + 2) * 9, and the sample. Without labelled rows every
    document scores as clean.
    """
    voters = VOTERS + 4
    known = features.join(_gold(labels), F.col("doc_id") == F.col("_label"), "left").select("th", "doc_id", "pattern", "columns", F.coalesce("toxic", F.lit(-1)).alias("toxic"))
    seen = known.groupBy("pattern", "toxic").agg(F.count("*").alias("n")).toArrow()
    columns = len(lexicon.keys) + 3 * voters
    pattern, inverse = np.unique(seen["pattern"].to_numpy(), return_inverse=True)
    gold, n = seen["toxic"].to_numpy(), seen["n"].to_numpy().astype(float)
    count = lambda which: np.bincount(inverse, weights=n * which, minlength=len(pattern))
    bad, good = count(gold > 0), count(gold == 0)
    if not (bad + good).sum():
        return Model(lexicon, np.append(np.zeros(columns), -2.0))
    votes = _votes(pattern, voters)
    post = calibrated(label_model(votes, count(gold > -2)).posterior(votes), bad, good)
    draw = F.pmod(F.xxhash64("doc_id", "th"), F.lit(1 << 30)) / float(1 << 30)
    drawn = known.where((F.col("toxic") >= 0) & (draw < labelled / float((bad + good).sum())))
    sample = drawn.groupBy("th").agg(F.first("pattern").alias("pattern"), F.first("columns").alias("columns")).toArrow().sort_by("th")
    if not sample.num_rows:
        return Model(lexicon, np.append(np.zeros(columns), -2.0))
    lists = sample["columns"].combine_chunks()
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    target = post[np.searchsorted(pattern, sample["pattern"].to_numpy())]
    return Model(lexicon, linear_classifier(row, lists.flatten().to_numpy().astype(np.int64), len(lists), columns, target))


def train(documents: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Model:
    """Lexicon, label model and classifier.

    A doc_id that ``labels`` has several times counts as toxic if any label says
    so, and as unlabelled if none is given. The lexicon is counted over all
    labelled documents and the label model over the votes of all documents; only
    the classifier is fitted on a sample, of ``labelled`` rows. Without labels of
    both classes there are no learned entries.
    """
    lexicon = learn_lexicon(documents, labels)
    return fit(save(read_features(documents, lexicon), "features"), labels, lexicon, labelled)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            lists = batch.column("columns")
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            z = np.bincount(row, weights=weights[lists.flatten().to_numpy()], minlength=len(lists)) + weights[-1]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], names=["doc_id", "score"])

    return run


def score_features(features: DataFrame, model: Model) -> DataFrame:
    shared = features.sparkSession.sparkContext.broadcast(model.weights)
    out = features.select("doc_id", "columns").mapInArrow(_score(shared), "doc_id long, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def score_toxicity(documents: DataFrame, model: Model) -> DataFrame:
    """Per row: doc_id, score (0 to 1, higher: toxic likelier) and predicted (1 if the score is 0.5 or more).

    Null and empty texts score as a text without words. Only the text is read;
    repeated rows get equal results, an empty table none. A text is held whole,
    at some 80 bytes of memory a character.
    """
    return score_features(read_features(documents, model.lexicon), model)


def train_and_score(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns from rows outside fold 0 and scores all; held_out tells which were not learned from."""
    outside = lambda df: df.where(doc_fold(F.col("doc_id")) != 0)
    lexicon = learn_lexicon(outside(documents), outside(labels))
    features = save(read_features(documents, lexicon), "features")
    model = fit(outside(features), outside(labels), lexicon)
    return score_features(features, model).withColumn("held_out", doc_fold(F.col("doc_id")) == 0)
