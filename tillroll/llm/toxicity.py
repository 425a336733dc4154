"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

1. Voters: word lists, patterns, and single words or beginnings of words that stand out in
   labelled rows. Each either fires on a text or does not.
2. Label model: ``P(class) * P(vote | vote of its parent voter, class)``. The chances for each
   class are the voters' accuracies; the parents, a tree of the strongest dependences
   within the classes, are their correlations, so that two voters that say the same are
   not counted twice. It is fitted by expectation and maximisation over the votes of all
   rows, grouped by equal votes; a known label is one more voter of fixed accuracy.
3. Classifier: logistic regression on terms and votes, trained on the posterior labels of a
   bounded sample of labelled rows. It alone scores texts.

Held-out rows give neither labels, nor words to vote on, nor training rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import columns_free_of, stored
from tillroll.llm.decontaminate import words_of

#: Rows the classifier is trained on, at most: the labelled rows with the least hashes.
TRAIN_ROWS = 20_000
#: Terms (words and beginnings of words) that vote on their own, and that the classifier weighs.
TERM_VOTERS, TERM_WEIGHTS = 40, 4_000
#: Beginnings of so many bytes are terms too, so that inflected forms count together.
STEMS = (3, 4, 5, 6)
#: A term votes or is weighed if it has so many rows and so many standard deviations.
LEAST_ROWS, LEAST_Z = 6, 4.0
#: A term that votes has at least this share of the toxic rows.
VOTER_SHARE = 0.02
#: How far a known label is trusted.
LABEL_ACCURACY = 0.999
EM_ROUNDS = 8
#: Rows whose terms a task counts in memory before it gives the counts on.
COUNTED_ROWS = 1_000
THRESHOLD = 0.3

#: Word lists, one voter each.
LEXICONS = {
    "stupidity": "stupid idiot idiots idiotic moron morons moronic imbecile dumb dumbass fool fools dimwit brainless",
    "contempt": "pathetic worthless loser losers useless lame sad joke clown clowns failure nobody coward",
    "dirt": "scum trash garbage filth filthy vermin pig pigs dirty parasite",
    "disgust": "disgusting disgrace disgraceful vile gross repulsive revolting sickening ugly hideous",
    "hatred": "hate hates hated despise loathe kill hell",
    "swearing": "damn crap bastard bastards bitch ass asshole shit bullshit fuck fucking wtf stfu",
    "german": "idiot dumm trottel abschaum versager ekelhaft dreck wertlos erbärmlich schwachkopf",
    "french": "idiot idiote imbécile crétin minable ordure dégoûtant stupide nul connard",
    "spanish": "idiota estúpido imbécil basura asqueroso perdedor inútil patético escoria payaso",
}
#: Patterns, one voter each, over the whole text in UTF-8. Before a pattern is
#: searched for, one of the strings beside it must be in the text in lower case.
PATTERNS = {
    "commands": (
        (b"shut up", b"get lost", b"go to hell", b"drop dead", b"go away", b"kill yourself"),
        rb"(?i)\b(?:shut up|get lost|go to hell|drop dead|go away|kill yourself)\b",
    ),
    "address": ((b"you ", b"you'"), rb"(?i)\byou(?:'re| are)? (?:an? |such an? |so |all |a bunch of )"),
    "shouting": ((), rb"[A-Z]{4}(?<!\w[A-Z]{4})[A-Z]*[ ,!]+(?:[A-Z]{4,}[ ,!]+){2}"),
    "exclaiming": ((b"!!",), rb"!!"),
    "masked": ((b"*", b"@", b"#", b"$"), rb"\b[a-zA-Z]{1,3}[*@#$]{2,}[a-zA-Z]{0,3}\b"),
}


def is_held_out(doc_id: Column) -> Column:
    """CRC-32 of the id as text leaves 2 when divided by 4; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def terms_of(words: set[bytes]) -> set[bytes]:
    """Words, and their beginnings marked with a star."""
    terms = set(words)
    for n in STEMS:
        terms.update([w[:n] + b"*" for w in words if len(w) > n])
    return terms


class Finder:
    """Which of some terms the words of a text hold."""

    def __init__(self, terms: Iterable[bytes]):
        self.terms = frozenset(terms)
        self.starts = frozenset([t[: min(STEMS)] for t in self.terms])

    def found(self, words: list[bytes]) -> set[bytes]:
        n, starts = min(STEMS), self.starts
        return self.terms & terms_of({w for w in set(words) if w[:n] in starts})


@dataclass
class Voters:
    """Lists, patterns and single terms; the position is the voter's bit."""

    terms: list[bytes]

    def __post_init__(self) -> None:
        self.lists = [frozenset(w.encode() for w in text.split()) for text in LEXICONS.values()]
        self.patterns = [(needed, re.compile(p).search) for needed, p in PATTERNS.values()]
        self.single = {t: k for k, t in enumerate(self.terms, len(self.lists) + len(self.patterns))}
        self.listed = frozenset().union(*self.lists)
        self.finder = Finder(self.listed | self.single.keys())

    def votes_of(self, data: bytes) -> int:
        return self.votes(data, self.finder.found(words_of(data)))

    def __len__(self) -> int:
        return len(self.lists) + len(self.patterns) + len(self.single)

    def votes(self, data: bytes, terms: set[bytes]) -> int:
        bits = 0
        if hits := self.listed & terms:
            for k, words_of_list in enumerate(self.lists):
                if not words_of_list.isdisjoint(hits):
                    bits |= 1 << k
        lower = data.lower()
        for k, (needed, search) in enumerate(self.patterns, len(self.lists)):
            if (not needed or any(n in lower for n in needed)) and search(data):
                bits |= 1 << k
        for term in self.single.keys() & terms:
            bits |= 1 << self.single[term]
        return bits


def _texts(batch: pa.RecordBatch, text: str) -> Iterator[bytes]:
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.string()).cast(pa.binary())
    for value in column:
        yield value.as_py() or b""


def known_labels(labels: DataFrame, doc_id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """One label per id that is not held out; of several the largest, nulls left out."""
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
    return known.where(~is_held_out(F.col("doc_id"))).dropna().groupBy("doc_id").agg(F.max("label").alias("label"))


def telling_terms(sample: DataFrame) -> list[tuple[bytes, int, int]]:
    """``(term, rows, toxic rows)``, the terms furthest from what chance brings about first.

    Rows of equal text count once, so a group of copies is no evidence of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, COUNTED_ROWS) for b in batches for at in range(0, b.num_rows, COUNTED_ROWS)):
            rows, toxic = Counter(), Counter()
            for data, label in zip(_texts(batch, "text"), batch.column("label").to_pylist(), strict=True):
                terms = terms_of(set(words_of(data)))
                rows.update(terms)
                if label:
                    toxic.update(terms)
            terms = [t for t in rows if len(t) <= 64]
            columns = [
                pa.array(terms, pa.binary()),
                pa.array([rows[t] for t in terms], pa.int64()),
                pa.array([toxic[t] for t in terms], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["term", "n", "t"])

    # Both bounded by the sample.
    once = sample.groupBy(F.xxhash64("text")).agg(F.first("text").alias("text"), F.max("label").alias("label"))
    once = stored(once.select("text", "label"), "distinct_sample")
    total, toxic = once.agg(F.count(F.lit(1)), F.sum("label")).first()
    share = (toxic or 0) / max(total, 1)
    if not 0 < share < 1:
        return []
    counted = once.mapInArrow(run, "term binary, n long, t long")
    counted = counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    z = (F.col("t") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share))
    found = counted.where(F.col("n") >= LEAST_ROWS).withColumn("z", z).where(F.abs("z") >= LEAST_Z)
    rows = found.orderBy(F.abs("z").desc(), "term").limit(TERM_WEIGHTS).collect()
    return apart([(bytes(r["term"]), r["n"], r["t"]) for r in rows])


def apart(terms: list[tuple[bytes, int, int]]) -> list[tuple[bytes, int, int]]:
    """Of a word and its beginnings that the same number of rows have, the shortest."""
    kept: dict[tuple[bytes, int, int], tuple[bytes, int, int]] = {}
    for term, n, t in terms:
        start = (term[: min(STEMS)], n, t)
        if start not in kept or len(term) < len(kept[start][0]):
            kept[start] = (term, n, t)
    return list(kept.values())


@dataclass
class LabelModel:
    """Class prior; ``parent`` of each voter (-1: none); ``log_p[class, voter, parent's vote, vote]``."""

    prior: float
    parent: list[int]
    log_p: np.ndarray

    def log_odds(self, votes: np.ndarray) -> np.ndarray:
        """Of the toxic class, for a row of 0 and 1 for each text."""
        odds = np.full(len(votes), np.log(self.prior) - np.log1p(-self.prior))
        for j, p in enumerate(self.parent):
            above = votes[:, p] if p >= 0 else np.zeros(len(votes), np.int64)
            odds += self.log_p[1, j, above, votes[:, j]] - self.log_p[0, j, above, votes[:, j]]
        return odds


def unpack(bits: np.ndarray, n: int) -> np.ndarray:
    return (bits[:, None] >> np.arange(n)) & 1


def posterior(model: LabelModel | None, votes: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Chance of the toxic class; ``label`` is -1 where it isn't known."""
    if model is None:  # to begin with: two lists or patterns that fire, or the label
        odds = 3.0 * votes.sum(axis=1) - 4.5
    else:
        odds = model.log_odds(votes)
    trust = np.log(LABEL_ACCURACY / (1 - LABEL_ACCURACY))
    odds = odds + np.where(label < 0, 0.0, np.where(label > 0, trust, -trust))
    return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def class_counts(patterns: DataFrame, model: LabelModel | None, n: int) -> np.ndarray:
    """``[class, voter, voter]`` expected rows in which both fire; voter ``n`` always does.

    Summed in whole millionths, so the result doesn't depend on the order of the rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, n + 1, n + 1))
        for batch in batches:
            votes = unpack(batch.column("votes").to_numpy(), n)
            p = posterior(model, votes, batch.column("label").to_numpy())
            full = np.hstack([votes, np.ones((len(votes), 1))]).astype(float)
            rows = batch.column("rows").to_numpy()
            for k, w in enumerate((1 - p, p)):
                total[k] += full.T @ (full * (w * rows)[:, None])
        units = np.rint(total.ravel() * 1e6).astype(np.int64)
        cell = np.flatnonzero(units)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(units[cell])], names=["cell", "units"])

    sums = patterns.mapInArrow(run, "cell long, units long").groupBy("cell").agg(
        F.sum(F.col("units").cast("decimal(38,0)")).alias("units")
    )
    counts = np.zeros(2 * (n + 1) ** 2)
    for row in sums.collect():  # as many rows as the model has cells
        counts[row["cell"]] = float(row["units"]) / 1e6
    return counts.reshape(2, n + 1, n + 1)


def fit_step(counts: np.ndarray) -> LabelModel:
    """Accuracies, and the tree of the strongest dependences, from expected counts."""
    n = counts.shape[1] - 1
    size = counts[:, n, n]
    alone = counts[:, :n, n]
    joint = np.zeros((2, n, n, 2, 2))  # [class, j, k, vote of j, vote of k], one row added
    joint[..., 1, 1] = counts[:, :n, :n]
    joint[..., 1, 0] = alone[:, :, None] - counts[:, :n, :n]
    joint[..., 0, 1] = alone[:, None, :] - counts[:, :n, :n]
    joint[..., 0, 0] = size[:, None, None] - joint[..., 1, 1] - joint[..., 1, 0] - joint[..., 0, 1]
    joint = np.maximum(joint, 0) + 0.25
    share = joint / joint.sum(axis=(3, 4), keepdims=True)
    apart = share.sum(axis=4, keepdims=True) * share.sum(axis=3, keepdims=True)
    weight = (size / max(size.sum(), 1e-9))[:, None, None]
    shared = (share * np.log(share / apart)).sum(axis=(3, 4)) * weight
    strength = shared.sum(axis=0)
    # Less than what chance brings about is no dependence.
    strength[strength < 3.0 / max(size.sum(), 1.0)] = 0
    np.fill_diagonal(strength, 0)
    parent, inside = [-1] * n, set()
    while len(inside) < n:
        best, j, p = 0.0, -1, -1
        for a in inside:
            row = strength[a].copy()
            row[list(inside)] = 0
            if row.max(initial=0) > best:
                best, j, p = float(row.max()), int(row.argmax()), a
        if j < 0:
            j = next(k for k in range(n) if k not in inside)
        parent[j] = p
        inside.add(j)
    log_p = np.zeros((2, n, 2, 2))
    for j, p in enumerate(parent):
        for k in range(2):
            if p < 0:
                fires = (alone[k, j] + 0.5) / (size[k] + 1)
                log_p[k, j, :, 1], log_p[k, j, :, 0] = np.log(fires), np.log1p(-fires)
            else:
                given = joint[k, p, j] / joint[k, p, j].sum(axis=1, keepdims=True)
                log_p[k, j] = np.log(given)
    prior = float(np.clip((size[1] + 1) / (size.sum() + 2), 1e-4, 1 - 1e-4))
    return LabelModel(prior, parent, log_p)


def fit_label_model(votes: DataFrame, labels: DataFrame, n: int, rounds: int = EM_ROUNDS) -> LabelModel:
    """From stored ``votes (doc_id, votes)`` of all rows and one label for some ids."""
    patterns = votes.join(labels, "doc_id", "left").groupBy("votes", F.coalesce("label", F.lit(-1)).alias("label"))
    patterns = stored(patterns.agg(F.count(F.lit(1)).alias("rows")), "patterns")
    model = None
    for _ in range(rounds):
        model = fit_step(class_counts(patterns, model, n))
    return model


@dataclass
class Classifier:
    """Weights of words and voters; the score of a text is the logistic of their sum."""

    voters: Voters
    terms: dict[bytes, float]
    of_voters: np.ndarray
    bias: float

    def __post_init__(self) -> None:
        self.finder = Finder(self.terms.keys() | self.voters.finder.terms)

    def score(self, data: bytes) -> float:
        terms = self.finder.found(words_of(data))
        own, votes = self.terms, self.voters.votes(data, terms)
        logit = self.bias + sum([own[t] for t in sorted(own.keys() & terms)])
        for k, w in enumerate(self.of_voters.tolist()):
            if votes >> k & 1:
                logit += w
        return 1 / (1 + float(np.exp(-np.clip(logit, -50, 50))))


def logistic(features: list[np.ndarray], target: np.ndarray, n: int, l2: float = 0.2, steps: int = 1500) -> np.ndarray:
    """Weights of ``n`` features and a bias for soft targets, by accelerated gradient steps."""
    rows = np.repeat(np.arange(len(features)), [len(f) for f in features])
    column = np.concatenate(features) if features else np.empty(0, np.int64)
    w = before = np.zeros(n + 1)
    longest = np.bincount(rows, minlength=1).max(initial=0) + 1
    rate = 1 / (0.25 * longest + l2 / max(len(target), 1))
    for k in range(steps):
        ahead = w + (k / (k + 3)) * (w - before)
        logit = ahead[n] + np.bincount(rows, ahead[column], minlength=len(target))
        miss = 1 / (1 + np.exp(-np.clip(logit, -50, 50))) - target
        slope = np.append(np.bincount(column, miss[rows], minlength=n), miss.sum())
        slope[:n] += l2 * ahead[:n]
        before, w = w, ahead - rate * slope / max(len(target), 1)
    return w


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> Classifier:
    """Fit voters, label model and classifier; see the module's text."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    known = known_labels(labels)
    # Bounded by TRAIN_ROWS, so it is broadcast. Rows that repeat an id come with it.
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    chosen = stored(chosen, "chosen_labels")
    sample = stored(rows.join(F.broadcast(chosen), "doc_id"), "toxicity_sample")
    counted = telling_terms(sample)
    toxic_rows = sample.agg(F.sum("label")).first()[0] or 0
    voters = Voters([w for w, n, t in counted if 2 * t >= n and t >= VOTER_SHARE * toxic_rows][:TERM_VOTERS])

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [voters.votes_of(data) for data in _texts(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits, pa.int64())], names=["doc_id", "votes"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    votes = stored(rows.mapInArrow(vote, f"doc_id {id_type}, votes long"), "votes")
    model = fit_label_model(votes, known, len(voters))

    # The classifier's terms: those that tell most, for or against.
    weighed = {t: k for k, (t, _, _) in enumerate(counted)}
    n, m = len(weighed), len(voters)
    finder = Finder(weighed.keys() | voters.finder.terms)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, bits = [], []
            for data in _texts(batch, "text"):
                terms = finder.found(words_of(data))
                bits.append(voters.votes(data, terms))
                found = sorted(weighed[t] for t in weighed.keys() & terms)
                ids.append(np.array(found, "<i4").tobytes())
            p = posterior(model, unpack(np.array(bits, np.int64), m), batch.column("label").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.binary()), pa.array(bits, pa.int64()), pa.array(p)], names=["terms", "votes", "p"]
            )

    made = sample.select("text", "label").mapInArrow(features, "terms binary, votes long, p double")
    # Bounded by TRAIN_ROWS; in a fixed order, as sums of floats depend on it.
    got = sorted(made.collect(), key=lambda r: (r["votes"], bytes(r["terms"]), r["p"]))
    lists = [
        np.concatenate([np.frombuffer(r["terms"], "<i4"), n + np.flatnonzero(unpack(np.array([r["votes"]]), m)[0])])
        for r in got
    ]
    if not got:  # no label at all: the label model's odds, voter by voter
        fires = model.log_p[1, :, 0, :] - model.log_p[0, :, 0, :]
        bias = float(np.log(model.prior) - np.log1p(-model.prior) + fires[:, 0].sum())
        return Classifier(voters, {}, fires[:, 1] - fires[:, 0], bias)
    w = logistic([x.astype(np.int64) for x in lists], np.array([r["p"] for r in got]), n + m)
    return Classifier(voters, {t: float(w[k]) for t, k in weighed.items()}, w[n : n + m], float(w[n + m]))


def add_score(docs: DataFrame, model: Classifier, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the chance in [0, 1] that each whole text is toxic.

    Null and empty texts have no words and get the score of that. Equal texts get equal
    scores. A column already named so keeps its name and the new one gets ``_`` added.
    """
    (name,) = columns_free_of(docs, name)
    schema = T.StructType([*docs.schema, T.StructField(name, T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([model.score(data) for data in _texts(batch, text)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with a score below ``threshold``, all columns as they were."""
    (name,) = columns_free_of(docs, "score")
    scored = add_score(docs, train(docs, labels))
    return scored.where(F.col(name) < threshold).select(*docs.columns)
