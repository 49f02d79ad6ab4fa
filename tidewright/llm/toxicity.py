"""Toxicity by a weighted finite-state grammar over clauses.

Three transducers are composed, each a table of weighted arcs:

* the lexicon maps a word to a symbol and a weight: insult, threat, target,
  negation, reported speech, or other. Insult weights are log-odds of words and
  word beginnings, learned from labelled texts; the other symbols are word lists;
* the scope transducer reads a clause and rewrites symbols in the reach of a
  negation or of reported speech;
* the scorer sums the weights of insults and threats and adds a bonus where a
  target stands in the same clause.

A document is scored by its matched clauses (their number, strength and density),
through a logistic model of these four numbers. Words outside a matched clause
count for nothing.

The lexicon and the logistic model are fitted on at most ``SAMPLE_TOXIC`` and
``SAMPLE_CLEAN`` labelled texts (those of the smallest hashes of their ids), never
on those whose crc32 of the id is divisible by 5.

Cases: null and empty texts have no clause and get the score of a text without
matches. A row with a null id is never trained on and counts as held out. Where
labels of either kind are missing, the word lists alone are used. Repeated rows
get equal scores; repeated labels of an id count as toxic if one of them is. An
empty table gives an empty result; only the id, the text and the labels are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import id_and_text, written
from tidewright.llm.text import binary, returning

SAMPLE_TOXIC, SAMPLE_CLEAN = 4000, 8000
PREFIXES = (4, 5, 6, 7)
LEAST_WEIGHT = 2.5  # log-odds of a learned entry
LEAST_SHARE, LEAST_TEXTS = 0.01, 3  # of the toxic texts, for a learned entry
# Log-likelihood ratio a learned entry needs: chance among a million keys gives less.
EVIDENCE = 14.0
TIMES = 5  # occurrences in a text that count at most
KEPT_WORDS = 150_000

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)

# Words of the grammar in four languages.
WORD_LISTS = {
    INSULT: "idiot moron stupid loser scum trash worthless pathetic disgusting clown fool imbecile",
    THREAT: "kill hurt destroy burn hang tuer töten matar",
    TARGET: "you your yours u he she they him her them tu te toi vous il elle ils du dich dir ihr sie er usted tú él ella ellos",
    NEGATION: "not never no isn't aren't wasn't don't doesn't pas jamais nicht kein keine nie nunca jamás",
    REPORT: "said says quoted reported wrote dit écrit sagte schrieb dijo escribió",
}
LIST_WEIGHT = 4.0

# The scope transducer: in each state, what a symbol leads to, and the part of its
# weight that an insult or threat keeps there. A negation reaches three words on.
SCOPE = {
    "plain": {NEGATION: "negated3", REPORT: "reported"},
    "negated3": {OTHER: "negated2", TARGET: "negated2", REPORT: "reported"},
    "negated2": {OTHER: "negated1", TARGET: "negated1", NEGATION: "negated3", REPORT: "reported"},
    "negated1": {OTHER: "plain", TARGET: "plain", NEGATION: "negated3", REPORT: "reported"},
    "reported": {NEGATION: "reported"},
}
KEEPS = {"plain": 1.0, "negated3": 0.4, "negated2": 0.4, "negated1": 0.4, "reported": 0.6}
TARGET_BONUS = 0.5

_EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")
_CLAUSE_ENDS = b".!?;:"


def held_out(column: Column) -> Column:
    """True for ids whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))


def bare(word: str) -> str:
    """A word in lower case without marks and digits at its ends."""
    return _EDGE.sub("", word.lower())


def keys(word: str) -> list[str]:
    """The lexicon keys a word can match: itself, and its beginnings with a '*'."""
    return [word] + [f"{word[:k]}*" for k in PREFIXES if len(word) >= k]


@dataclass
class Model:
    """Learned insults (key to weight) and the logistic model of a document."""

    insults: dict[str, float]
    weights: tuple[float, ...]

    def __post_init__(self):
        self.listed = {w: s for s, words in WORD_LISTS.items() for w in words.split()}
        self.symbols: list[tuple[int, float, bool]] = []
        self.codes: dict[bytes, int] = {}
        self.known: dict[tuple, int] = {}

    def symbol(self, word: bytes) -> tuple[int, float, bool]:
        """(symbol, weight, whether a clause ends here) of a word."""
        end = word[-1] in _CLAUSE_ENDS
        text = bare(word.decode("utf-8", "replace"))
        listed = self.listed.get(text, OTHER)
        weight = max((self.insults.get(k, 0.0) for k in keys(text)), default=0.0) if text else 0.0
        if listed in (INSULT, THREAT):
            weight = max(weight, LIST_WEIGHT)
        elif weight > 0:
            listed = INSULT
        return listed, weight, end

    def code(self, word: bytes) -> int:
        found = self.codes.get(word)
        if found is None:
            if len(self.codes) >= KEPT_WORDS:
                self.codes.clear()
            symbol = self.symbol(word)
            found = self.known.setdefault(symbol, len(self.known))
            if found == len(self.symbols):
                self.symbols.append(symbol)
            self.codes[word] = found
        return found

    def clauses(self, text: bytes) -> tuple[int, list[float]]:
        """(number of words, weights of the matched clauses)."""
        words = text.split()
        codes = np.fromiter(map(self.code, words), np.int32, len(words))
        strong = np.array([s in (INSULT, THREAT) for s, _, _ in self.symbols] or [False])
        hits = np.flatnonzero(strong[codes]) if len(codes) else codes
        if not len(hits):
            return len(words), []
        ends = np.flatnonzero(np.array([e for _, _, e in self.symbols])[codes])
        bounds = np.concatenate([[0], ends + 1, [len(codes)]])
        return len(words), [
            clause_weight([self.symbols[c] for c in codes[bounds[k] : bounds[k + 1]]])
            for k in np.unique(np.searchsorted(bounds, hits, "right") - 1)
        ]

    def score(self, text: bytes) -> tuple[float, list[float]]:
        """(score from 0 to 1, weights of the matched clauses)."""
        words, clauses = self.clauses(text)
        z = float(np.dot(self.weights, features(words, clauses)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), clauses


def clause_weight(symbols: list[tuple[int, float, bool]]) -> float:
    """The weight of a clause: its symbols through the scope transducer and the scorer."""
    state, total, target = "plain", 0.0, False
    for symbol, weight, _ in symbols:
        if symbol in (INSULT, THREAT):
            total += weight * KEEPS[state]
        elif symbol == TARGET:
            target = True
        state = SCOPE[state].get(symbol, state)
    return total * (1 + TARGET_BONUS * target)


def features(words: int, clauses: list[float]) -> np.ndarray:
    """Constant, matched clauses, the strongest, their sum and their density."""
    total = sum(clauses)
    return np.array(
        [
            1.0,
            math.log1p(len(clauses)),
            max(clauses, default=0.0) / 10,
            math.log1p(total),
            math.log1p(100 * total / (words + 20)),
        ]
    )


DEFAULT = Model({}, (-4.0, 2.0, 1.0, 1.0, 1.0))


# Learning


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A written table of the texts that are learned from: text, toxic."""
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("toxic in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .where(~held_out(F.col("doc_id")))
    )
    # Only labelled ids that have a text, so that the sample is of full size.
    present = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [
        present.where(F.col("toxic") == value).orderBy(*order).limit(most)
        for value, most in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))
    ]
    chosen = written(parts[0].unionByName(parts[1]), "toxicity-sample-ids")
    # At most SAMPLE_TOXIC + SAMPLE_CLEAN rows of two numbers. Of the rows of one id one
    # is taken, by its text's hash, in each task before they are shuffled.
    rows = docs.join(F.broadcast(chosen), "doc_id")
    one = rows.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("first"))
    return written(one.select("first.text", "toxic"), "toxicity-sample")


def _key_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        times: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for text, toxic in zip(binary(batch.column("text")), batch.column("toxic")):
            words = Counter(bare(w.decode("utf-8", "replace")) for w in text.as_py().split())
            found = Counter()
            for word, n in words.items():
                for k in keys(word) if word else ():
                    found[k] += n
            texts[toxic.as_py()].update(found.keys())
            # A text that repeats a word without end counts as a few of it.
            times[toxic.as_py()].update({k: min(n, TIMES) for k, n in found.items()})
        both = list(texts[1])  # keys of clean texts alone are never learned
        yield pa.RecordBatch.from_arrays(
            [pa.array(both, pa.string())]
            + [pa.array([c[v][k] for k in both], pa.int64()) for c in (texts, times) for v in (1, 0)],
            ["key", "toxic", "clean", "toxic_times", "clean_times"],
        )


def _contexts(wanted: set[str]):
    """(key, the words around it) in toxic texts, and each key's clean counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean, times, contexts = Counter(), Counter(), set()
            for text, toxic in zip(binary(batch.column("text")), batch.column("toxic")):
                words = [bare(w.decode("utf-8", "replace")) for w in text.as_py().split()]
                if toxic.as_py():
                    for before, word, after in zip([""] + words, words, words[1:] + [""]):
                        contexts.update((k, f"{before} {after}") for k in keys(word) if k in wanted)
                else:
                    found = Counter(k for w in words for k in keys(w) if k in wanted)
                    clean.update(found.keys())
                    times.update({k: min(n, TIMES) for k, n in found.items()})
            rows = [(k, c, 0, 0) for k, c in contexts] + [(k, None, n, times[k]) for k, n in clean.items()]
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                ["key", "context", "clean", "clean_times"],
            )

    return count


def evidence(toxic: int, clean: int, share: float) -> float:
    """Log-likelihood ratio of a key's own share of toxic texts to that of all texts."""
    n = toxic + clean
    other = clean * math.log(clean / (n * (1 - share))) if clean else 0.0
    return toxic * math.log(toxic / (n * share)) + other


def _narrowed(found: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Without a beginning that a longer one, or a word, stands for as well."""
    longer: dict[str, int] = defaultdict(int)
    for key, (toxic, _) in found.items():
        body = key.rstrip("*")
        for k in PREFIXES:
            short = f"{body[:k]}*"
            if len(body) >= k and short != key and short in found:
                longer[short] = max(longer[short], toxic)
    return {k: w for k, (toxic, w) in found.items() if longer[k] < 0.95 * toxic}


def _fitted(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression with balanced classes, by Newton's method."""
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    ridge = np.full(x.shape[1], 1.0)
    ridge[0] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (p - y)) + ridge * w
        hessian = (x * (share * p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(map(float, w))


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Model:
    """Learns the insults and the logistic model from a bounded labelled sample."""
    sample = _sample(id_and_text(docs, id_column, text_column), labels)
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return DEFAULT
    least = max(LEAST_TEXTS, LEAST_SHARE * sizes[1])
    share = sizes[1] / (sizes[0] + sizes[1])
    # Keys that are frequent in toxic texts and much more often there than in clean
    # ones: as a hundredth of the toxic texts must have a key, a sample has few.
    odds = F.log((F.col("toxic_times") + 0.5) / sizes[1]) - F.log((F.col("clean_times") + 0.5) / sizes[0])
    counted = (
        sample.mapInArrow(
            returning(_key_counts), "key string, toxic bigint, clean bigint, toxic_times bigint, clean_times bigint"
        )
        .groupBy("key")
        .agg(*(F.sum(c).alias(c) for c in ("toxic", "clean", "toxic_times", "clean_times")))
        .where(F.col("toxic") >= least)
        .withColumn("weight", odds)
        .where(F.col("weight") >= LEAST_WEIGHT)
        .collect()
    )
    toxic = {r.key: r for r in counted}
    # A key must stand between different words: what comes from copies of one text
    # does not. Its clean texts are now counted in full.
    seen = (
        sample.mapInArrow(returning(_contexts(set(toxic))), "key string, context string, clean bigint, clean_times bigint")
        .groupBy("key")
        .agg(
            F.countDistinct("context").alias("contexts"),
            F.sum("clean").alias("clean"),
            F.sum("clean_times").alias("clean_times"),
        )
        .collect()
    )
    found = {}
    for r in seen:
        texts = toxic[r.key].toxic
        weight = math.log((toxic[r.key].toxic_times + 0.5) / sizes[1]) - math.log((r.clean_times + 0.5) / sizes[0])
        telling = evidence(texts, r.clean, share) >= EVIDENCE and weight >= LEAST_WEIGHT
        if telling and r.contexts >= 0.5 * texts:
            found[r.key] = (texts, min(weight, 8.0))
    model = Model(_narrowed(found), DEFAULT.weights)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(*model.clauses(t.as_py())).tolist() for t in binary(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(rows, pa.list_(pa.float64()))], ["toxic", "x"]
            )

    rows = sample.mapInArrow(returning(measured), "toxic int, x array<double>").collect()
    rows.sort(key=lambda r: (r.toxic, r.x))
    return Model(model.insults, _fitted(np.array([r.x for r in rows]), np.array([r.toxic for r in rows])))


# Scoring


def score_documents(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: doc_id, score, predicted, n_clauses, top_clause."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.score(t.as_py()) for t in binary(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([s for s, _ in found], pa.float64()),
                    pa.array([int(s >= 0.5) for s, _ in found], pa.int32()),
                    pa.array([len(c) for _, c in found], pa.int64()),
                    pa.array([max(c, default=0.0) for _, c in found], pa.float64()),
                ],
                ["doc_id", "score", "predicted", "n_clauses", "top_clause"],
            )

    return id_and_text(docs, id_column, text_column).mapInArrow(
        returning(scored), "doc_id bigint, score double, predicted int, n_clauses bigint, top_clause double"
    )


def without_toxic(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    model = train(docs, labels, id_column, text_column)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t.as_py())[0] for t in binary(batch.column(text_column))]
            yield batch.filter(pa.array([s < 0.5 for s in scores], pa.bool_()))

    return docs.mapInArrow(returning(kept), docs.schema)
