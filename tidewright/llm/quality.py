"""Quality by weak labels: heuristic labellers, an EM model of their accuracies, and a
hashed linear scorer trained on the posterior labels.

Eight labellers vote good, bad or nothing on each document. Spark counts the
combinations of votes over all documents (at most 3**8 of them), and expectation
maximisation estimates from these counts the share of good documents and, for
each labeller, how often it votes what for good and for bad ones. No given label
is used. The posterior of a document's votes is its soft label.

The scorer is linear in hashed features of words (the words, their neighbours'
repetition, their shapes) and is trained on the posteriors of at most ``SAMPLE``
documents, those of the smallest hashes of their texts; it then scores all, also
those on which every labeller abstained.

Cases: null and empty texts get votes of no labeller but that for length, and the
scorer's score without features. Each row is judged alone, whatever its id.
Where all votes agree the posterior follows the labellers' assumed accuracy. An
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import id_and_text, written
from tidewright.llm.text import SPACE, Words, chunks, mixed, whole_windows

SAMPLE = 8000
BUCKETS = 1 << 15
# Assumed at the start: the share of good documents, and how often a labeller that
# votes calls bad documents bad (each sees one kind of them) and good ones bad.
# What is assumed weighs as much as this share of the documents.
GOOD_SHARE = 0.75
FINDS, ERRS = 0.35, 0.02
ASSUMED = 0.05

GOOD, BAD, NOTHING = 1, 0, 2

# Frequent short words of four languages.
STOP_WORDS = (
    "the of and to in is that it for was on are with as at be this by from or an a "
    "le la les de des et un une du en que qui est pour dans sur au par il ne "
    "der die das und ist nicht ein eine zu mit von den auf für im sich auch "
    "el los las y por con para una su es se lo más o no como"
)

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SENTENCE_MARK = np.zeros(256, bool)
_SENTENCE_MARK[[ord(c) for c in ".,;:'\"-?()"]] = True


def _hashes_of(words: list[str]) -> np.ndarray:
    data = " ".join(words).encode()
    return np.sort(Words(np.frombuffer(data, np.uint8), np.array([0, len(data)])).hashes())


_STOP = _hashes_of(STOP_WORDS.split())


class Block:
    """Numbers about the texts of a block, one row for each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words = words = Words(data, offsets)
        self.hashes = hashes = words.hashes()
        self.texts = texts = words.texts()
        n = len(offsets) - 1
        self.count = np.diff(words.first)
        many = np.maximum(self.count, 1)
        sizes = np.maximum(np.diff(offsets), 1)
        below = np.concatenate([[0], np.cumsum(_UPPER[data])])
        self.upper = (below[offsets[1:]] - below[offsets[:-1]]) / sizes
        odd = ~(_LETTER | _DIGIT | SPACE | _SENTENCE_MARK)[data]
        below = np.concatenate([[0], np.cumsum(odd)])
        self.odd = (below[offsets[1:]] - below[offsets[:-1]]) / sizes
        self.length = sizes / many
        self.stop = np.bincount(texts, np.isin(hashes, _STOP), n) / many
        self.distinct = self._distinct(texts, hashes, n) / many
        places, threes = whole_windows(words, hashes, 3)
        owner = texts[places]
        self.threes = self._distinct(owner, threes, n) / np.maximum(np.bincount(owner, minlength=n), 1)
        again = np.zeros(len(hashes), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (texts[1:] == texts[:-1])
        self.again, self.twice = again, np.bincount(texts, again, n) / many
        length = words.end - words.start
        self.marks = np.bincount(texts, (length == 1) & ~(_LETTER | _DIGIT)[data[words.start]], n) / many if len(length) else np.zeros(n)

    @staticmethod
    def _distinct(texts: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        order = np.lexsort((values, texts))
        texts, values = texts[order], values[order]
        new = np.append(True, (texts[1:] != texts[:-1]) | (values[1:] != values[:-1]))[: len(texts)]
        return np.bincount(texts[new], minlength=n)

    def votes(self) -> np.ndarray:
        """One column for each labeller."""
        some = self.count > 0
        enough = self.count >= 30

        def vote(good, bad, when):
            return np.where(when & bad, BAD, np.where(when & good, GOOD, NOTHING))

        return np.stack(
            [
                vote(self.count >= 5, self.count < 1, np.ones_like(some)),
                vote(self.odd < 0.01, self.odd > 0.04, some),
                vote(self.upper < 0.08, self.upper > 0.3, some),
                vote(self.twice < 0.02, self.twice > 0.1, enough),
                vote(self.threes > 0.95, self.threes < 0.7, enough),
                vote(self.marks < 0.01, self.marks > 0.1, some),
                vote(self.stop > 0.12, self.stop < 0.03, enough),
                vote((self.length > 4) & (self.length < 10), (self.length < 3) | (self.length > 15), some),
            ],
            axis=1,
        )

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """(text, bucket) of each feature of each word: itself, whether it repeats the
        word before, and its shape."""
        words, data = self.words, self.words.data
        if not len(self.texts):
            return self.texts, self.texts
        half = np.uint64(BUCKETS // 2 - 1)
        word = (mixed(self.hashes) & half).astype(np.int64)
        counts = [
            np.concatenate([[0], np.cumsum(kind[data])]) for kind in (_UPPER, _DIGIT, ~(_LETTER | _DIGIT))
        ]
        inside = [np.minimum(c[words.end] - c[words.start], 3) for c in counts]
        length = np.minimum(words.end - words.start, 15)
        shape = ((inside[0] * 4 + inside[1]) * 4 + inside[2]) * 16 + length
        shape = BUCKETS // 2 + (shape * 2 + self.again) % (BUCKETS // 2)
        return np.concatenate([self.texts, self.texts]), np.concatenate([word, shape])


N_LABELLERS = 8


def fit_labellers(votes: np.ndarray, counts: np.ndarray, rounds: int = 300) -> tuple[float, np.ndarray]:
    """(share of good documents, tables[labeller, class, vote]) by expectation
    maximisation over combinations of votes and how often they occur. A labeller
    that does not vote on a document says nothing about it."""
    assumed = np.tile([[FINDS, 1 - FINDS], [ERRS, 1 - ERRS]], (votes.shape[1], 1, 1))
    good, tables = GOOD_SHARE, assumed
    prior = max(1.0, ASSUMED * counts.sum())
    for _ in range(rounds):
        p = posterior(votes, good, tables)
        weight = np.stack([counts * (1 - p), counts * p])
        new = prior * assumed
        for v in (BAD, GOOD):
            new[:, :, v] += ((votes == v).T @ weight.T)
        new /= new.sum(axis=2, keepdims=True)
        share = (weight[GOOD].sum() + prior * GOOD_SHARE) / (counts.sum() + prior)
        done = abs(share - good) < 1e-9 and np.abs(new - tables).max() < 1e-9
        good, tables = share, new
        if done:
            break
    return good, tables


def posterior(votes: np.ndarray, good: float, tables: np.ndarray) -> np.ndarray:
    """The probability of good for rows of votes."""
    odds = np.full(len(votes), np.log(good / (1 - good)))
    for v in (BAD, GOOD):
        odds += (votes == v) @ np.log(tables[:, GOOD, v] / tables[:, BAD, v])
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


@dataclass
class Model:
    good: float
    tables: np.ndarray
    weights: np.ndarray
    bias: float

    def judge(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """(posteriors, scores) of a block's texts."""
        texts, buckets = block.features()
        total = np.bincount(texts, self.weights[buckets], len(block.count)) if len(texts) else np.zeros(len(block.count))
        z = self.bias + total / np.maximum(block.count, 1)
        return posterior(block.votes(), self.good, self.tables), 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _blocks(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for row, end, data, offsets in chunks(batch.column("text")):
            yield batch.slice(row, end - row), Block(data, offsets)


def _vote_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, block in _blocks(batches):
        codes, counts = np.unique(block.votes() @ 3 ** np.arange(N_LABELLERS), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(counts, pa.int64())], ["code", "n"])


def _trained(rows: list[tuple[np.ndarray, np.ndarray, float]], rounds: int = 40) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model on soft labels; classes weigh the same."""
    weights, bias = np.zeros(BUCKETS), 0.0
    if not rows:
        return weights, bias
    y = np.array([r[2] for r in rows])
    where = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    buckets = np.concatenate([r[0] for r in rows])
    values = np.concatenate([r[1] for r in rows])
    importance = 0.5 * (y / max(y.sum(), 1e-9) + (1 - y) / max((1 - y).sum(), 1e-9))
    squares, bias_square = np.full(BUCKETS, 1e-10), 1e-10
    for _ in range(rounds):
        z = np.bincount(where, values * weights[buckets], len(rows)) + bias
        error = importance * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        gradient = np.bincount(buckets, values * error[where], BUCKETS) + 1e-7 * weights
        squares += gradient**2
        weights -= 2.0 * gradient / np.sqrt(squares)
        bias_square += error.sum() ** 2
        bias -= 0.1 * error.sum() / np.sqrt(bias_square)
    return weights, bias


def train(source: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits the labellers on all rows of ``source`` (doc_id, text) and the scorer on at
    most ``sample`` different texts."""
    counted = source.select("text").mapInArrow(_vote_counts, "code bigint, n bigint")
    rows = counted.groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").collect()
    codes = np.array([r.code for r in rows], np.int64)
    votes = codes[:, None] // 3 ** np.arange(N_LABELLERS) % 3
    good, tables = fit_labellers(votes, np.array([r.n for r in rows], float))

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block in _blocks(batches):
            p = posterior(block.votes(), good, tables)
            texts, buckets = block.features()
            for t in range(len(p)):
                found, times = np.unique(buckets[texts == t], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([found.astype(np.int32).tobytes()], pa.binary()),
                        pa.array([(times / max(block.count[t], 1)).astype(np.float32).tobytes()], pa.binary()),
                        pa.array([p[t]], pa.float64()),
                    ],
                    ["buckets", "values", "y"],
                )

    # The hashes are chosen first, so that no text is sorted.
    order = F.xxhash64("text")
    hashes = source.select(order.alias("order")).distinct()  # copies count once
    limit = hashes.orderBy("order").limit(sample).agg(F.max("order")).first()[0]
    chosen = source.select("text").where(order <= limit) if limit is not None else source.limit(0)
    chosen = chosen.dropDuplicates(["text"])  # at most ``sample`` texts
    taught = chosen.select("text").mapInArrow(sampled, "buckets binary, values binary, y double").collect()
    rows = sorted((bytes(r["buckets"]), bytes(r["values"]), r["y"]) for r in taught)
    weights, bias = _trained([(np.frombuffer(b, np.int32), np.frombuffer(v, np.float32), y) for b, v, y in rows])
    return Model(good, tables, weights, bias)


def classify(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, sample: int = SAMPLE
) -> DataFrame:
    """Per row: doc_id, posterior (of the labellers), score (of the scorer) and
    predicted (1: good, where their mean reaches a half)."""
    source = id_and_text(docs, id_column, text_column)
    model = train(source, sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred kilobytes

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, block in _blocks(batches):
            p, score = shared.value.judge(block)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(p), pa.array(score), pa.array(((p + score) / 2 >= 0.5).astype(np.int32))],
                ["doc_id", "posterior", "score", "predicted"],
            )

    return source.mapInArrow(judged, "doc_id bigint, posterior double, score double, predicted int")
