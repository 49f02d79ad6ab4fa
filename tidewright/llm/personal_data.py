"""Personal data by patterns and a skip-chain conditional random field.

Patterns find emails, IP addresses, card numbers and phone numbers. The field
then labels the tokens that hold a digit or an at sign (others are outside):

* a token's own potential is the log share of each label among all tokens of its
  shape in the corpus (digits as 9, letters as a), where the labels counted are
  those of the patterns; tokens inside a pattern's match carry strong evidence;
* neighbouring tokens share a potential from the counts of label pairs;
* distant tokens that are equal, have the same digits, or repeat the local part
  or host of an address share a potential that favours equal labels.

Loopy message passing over both kinds of edges gives every token a marginal, so
that an entity found once is labelled wherever the document repeats it. A token
outside all matches becomes a span of its own where a label is likely enough.
Spans of the patterns always stay.

Only parts of a document's graph that join a matched and an unmatched token have
anything to decide; messages are passed there alone. Tokens of one form are
joined in a row, not in all pairs, so edges grow with the tokens.

Cases: a null text counts as empty and has no span. Ids may be null or repeated;
each row is judged alone. An empty table gives an empty result. Shapes are
counted over all rows and all kept, as a table; it is joined to the shapes of the
rows that have something to decide.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import id_and_text, small_side, written

KINDS = ("email", "ip", "card", "phone")
OUTSIDE = len(KINDS)
LABELS = len(KINDS) + 1
SURE = 0.9  # marginal from which an unmatched token becomes a span
EVIDENCE = 8.0  # of a pattern's match for its label
SKIP = 9.0  # for equal labels of similar tokens, beside what the corpus shows
ROUNDS, DAMPING = 30, 0.5

# The patterns of the four kinds.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_OPEN = re.compile(r"[0-9@]")
_CORE = re.compile(r"[^\W_](?:.*[^\W_])?", re.S)


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(map(int, reversed(digits))):
        total += d if place % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # From each at sign outwards, which is linear: the run of local characters to
    # its left, as far as the last match, and the host to its right.
    last = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            last = at = host.end()
        else:
            last = at = at + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all matches of the patterns, by kind and place."""
    spans = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    for m in _IP.finditer(text):
        # A part of over 3 digits is compared without its zeros in front.
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                spans.append((3, *m.span()))
    return spans


def as_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


# Tokens of the field


def shape(token: str) -> str:
    """Digits as 9, letters as a (three at most in a row), other characters as they
    are; without marks at the ends but for a plus sign in front. A long one is told
    by its digest."""
    core = _CORE.search(token)
    body = re.sub(r"[^\W\d_]+", lambda m: "a" * min(3, len(m[0])), core[0] if core else token)
    body = "+" * token.startswith("+") + re.sub(r"[0-9]", "9", body)
    if len(body) <= 64:
        return body
    return "#" + hashlib.blake2b(body.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


class Tokens:
    """The tokens of a text that hold a digit or an at sign, with the patterns' labels."""

    def __init__(self, text: str, spans: list[tuple[int, int, int]]):
        self.words, self.at, self.place = [], [], []
        for place, m in enumerate(_TOKEN.finditer(text)):
            if _OPEN.search(m[0]):
                self.words.append(m[0])
                self.at.append(m.start())
                self.place.append(place)
        self.labels = [OUTSIDE] * len(self.words)
        starts = np.array(self.at)
        ends = starts + np.array([len(w) for w in self.words], int) if self.words else starts
        for kind, a, b in reversed(spans):  # of overlapping kinds, the first listed counts
            for k in np.flatnonzero((starts < b) & (ends > a)):
                self.labels[k] = kind

    def bounds(self, k: int) -> tuple[int, int]:
        """Start and end of a token without marks at its ends; equal if it is all marks."""
        core = _CORE.search(self.words[k])
        return (self.at[k] + core.start(), self.at[k] + core.end()) if core else (self.at[k],) * 2

    def forms(self, k: int) -> set[str]:
        """What a distant token must share to be similar."""
        core = _CORE.search(self.words[k])
        core = core[0].lower() if core else ""
        digits = "".join(_DIGIT.findall(core))
        found = {f"={core}"} if len(core) >= 5 else set()
        if len(digits) >= 6:
            found.add(f"#{digits}")
        found.update(f"={part}" for part in core.split("@") if "@" in core and len(part) >= 5)
        return found

    def chain(self) -> list[tuple[int, int]]:
        """Pairs of neighbouring tokens."""
        return [(k, k + 1) for k in range(len(self.place) - 1) if self.place[k] + 1 == self.place[k + 1]]

    def skips(self) -> list[tuple[int, int]]:
        """Pairs of similar distant tokens: each with the next of its form."""
        last: dict[str, int] = {}
        pairs = set()
        for k in range(len(self.words)):
            for form in self.forms(k):
                if form in last and self.place[last[form]] + 1 < self.place[k]:
                    pairs.add((last[form], k))
                last[form] = k
        return sorted(pairs)


# Potentials, counted over the whole corpus


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = Counter()
        for text in batch.column("text"):
            text = text.as_py() or ""
            if not _OPEN.search(text):
                continue
            tokens = Tokens(text, base_spans(text))
            counts.update(("shape", shape(w), y, 0) for w, y in zip(tokens.words, tokens.labels))
            counts.update(("chain", "", tokens.labels[a], tokens.labels[b]) for a, b in tokens.chain())
            counts.update(("skip", "", tokens.labels[a], tokens.labels[b]) for a, b in tokens.skips())
        keys = list(counts)
        columns = [[k[i] for k in keys] for i in range(4)] + [[counts[k] for k in keys]]
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], ["what", "shape", "a", "b", "n"]
        )


class Field:
    """The potentials of the field. ``total`` counts the labels of all shapes, where
    ``shapes`` has not all of them."""

    def __init__(self, shapes: dict[str, list[int]], chain: np.ndarray, skip: np.ndarray, total=None):
        if total is None:
            total = np.sum([v for v in shapes.values()], axis=0) if shapes else np.zeros(LABELS)
        self.prior = (total + 1) / (total + 1).sum()
        self.rest = np.log(self.prior)
        self.own = {s: self.potential(v) for s, v in shapes.items()}
        # Neighbours: log of how much more often a pair occurs than by its labels alone.
        joint = (chain + 1) / (chain + 1).sum()
        self.chain = np.log(joint / (joint.sum(1, keepdims=True) * joint.sum(0, keepdims=True)))
        # Similar tokens: log odds of equal to different labels among pairs with an entity.
        entity = skip.copy()
        entity[OUTSIDE, OUTSIDE] = 0
        same = np.trace(entity)
        self.skip = np.eye(LABELS) * (math.log((same + 5) / (entity.sum() - same + 1)) + SKIP)

    def potential(self, counts: list[int]) -> np.ndarray:
        """A shape's own potential from the counts of its labels."""
        return np.log((np.array(counts) + self.prior) / (sum(counts) + 1))

    def marginals(self, tokens: Tokens, nodes: list[int], edges: list[tuple[int, int, bool]]) -> np.ndarray:
        """Of some tokens; edges are (a, b, whether a skip)."""
        number = {k: i for i, k in enumerate(nodes)}
        own = [self.own.get(shape(tokens.words[k]), self.rest) for k in nodes]
        return self.passed(own, [tokens.labels[k] for k in nodes], [(number[a], number[b], s) for a, b, s in edges])

    def passed(self, own: list[np.ndarray], labels: list[int], edges: list[tuple[int, int, bool]]) -> np.ndarray:
        """Marginals by loopy belief propagation over nodes of these own potentials and labels."""
        own = np.array(own)
        for i, label in enumerate(labels):
            if label != OUTSIDE:
                own[i, label] += EVIDENCE
        a = np.array([e[0] for e in edges])
        b = np.array([e[1] for e in edges])
        pair = np.array([self.skip if e[2] else self.chain for e in edges])
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        pair = np.concatenate([pair, pair.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
        messages = np.zeros((len(source), LABELS))
        for _ in range(ROUNDS):
            belief = own.copy()
            np.add.at(belief, target, messages)
            out = belief[source] - messages[back]
            new = np.logaddexp.reduce(out[:, :, None] + pair, axis=1)
            new -= new.max(axis=1, keepdims=True)
            change = np.abs(new - messages).max()
            messages = DAMPING * messages + (1 - DAMPING) * new
            if change < 1e-4:
                break
        belief = own.copy()
        np.add.at(belief, target, messages)
        belief = np.exp(belief - belief.max(axis=1, keepdims=True))
        return belief / belief.sum(axis=1, keepdims=True)


def open_parts(tokens: Tokens) -> Iterator[tuple[list[int], list[tuple[int, int, bool]]]]:
    """The nodes and edges of each part that joins a matched and an unmatched token."""
    skips = tokens.skips()
    if not any((tokens.labels[a] == OUTSIDE) != (tokens.labels[b] == OUTSIDE) for a, b in skips):
        return
    edges = [(a, b, False) for a, b in tokens.chain()] + [(a, b, True) for a, b in skips]
    parent = list(range(len(tokens.words)))

    def top(k: int) -> int:
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    for a, b, _ in edges:
        parent[top(a)] = top(b)
    parts, by_part = defaultdict(list), defaultdict(list)
    for k in range(len(parent)):
        parts[top(k)].append(k)
    for e in edges:
        by_part[top(e[0])].append(e)
    for part, nodes in parts.items():
        if len({tokens.labels[k] == OUTSIDE for k in nodes}) > 1:
            yield nodes, by_part[part]


def train(source: DataFrame) -> tuple[Field, DataFrame]:
    """The field without own potentials, from the counts of all rows (a column
    ``text``), and the table of all shapes and the counts of their labels. What comes
    to the driver are the counts of labels and of label pairs."""
    counts = source.select("text").mapInArrow(_counted, "what string, shape string, a int, b int, n bigint")
    labels = [F.sum(F.when(F.col("a") == y, F.col("n")).otherwise(0)) for y in range(LABELS)]
    table = written(counts.groupBy("what", "shape", "b").agg(F.array(*labels).alias("counts")), "shape-counts")
    sums = [F.sum(F.col("counts")[y]) for y in range(LABELS)]
    of = {"chain": np.zeros((LABELS, LABELS)), "skip": np.zeros((LABELS, LABELS)), "shape": np.zeros((LABELS, 1))}
    for r in table.groupBy("what", "b").agg(F.array(*sums).alias("counts")).collect():
        of[r.what][:, r.b] = r.counts
    return Field({}, of["chain"], of["skip"], of["shape"][:, 0]), table.where("what = 'shape'").select("shape", "counts")


_COUNTS = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_spans string"
_PARTS = pa.list_(pa.struct([("shapes", pa.list_(pa.string())), ("nodes", pa.list_(pa.int32())), ("edges", pa.list_(pa.int32()))]))


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The patterns' spans of each row, and its parts with something to decide: per
    node its shape and (label, start, end), per edge (a, b, whether a skip)."""
    for batch in batches:
        counts: list[list[int]] = [[] for _ in KINDS]
        base, every, keys = [], [], []
        for text in batch.column("text"):
            text = text.as_py() or ""
            spans = base_spans(text)
            parts = []
            if spans:
                tokens = Tokens(text, spans)
                for nodes, edges in open_parts(tokens):
                    number = {k: i for i, k in enumerate(nodes)}
                    parts.append(
                        {
                            "shapes": [shape(tokens.words[k]) for k in nodes],
                            "nodes": [x for k in nodes for x in (tokens.labels[k], *tokens.bounds(k))],
                            "edges": [x for a, b, skip in edges for x in (number[a], number[b], int(skip))],
                        }
                    )
            for kind, column in enumerate(counts):
                column.append(sum(s[0] == kind for s in spans))
            base.append(as_text(spans))
            every.append(parts or None)
            keys.append(uuid.uuid4().hex if parts else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id")]
            + [pa.array(c, pa.int64()) for c in counts]
            + [pa.array(base, pa.string()), pa.array(keys, pa.string()), pa.array(every, _PARTS)],
            ["doc_id", *(f"n_{k}" for k in KINDS), "base_spans", "row", "parts"],
        )


def _decided(field: Field):
    """The spans of rows with parts, whose shapes' counts are in ``own``."""

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every, more = [], []
            for base, parts, own in zip(*(batch.column(c).to_pylist() for c in ("base_spans", "parts", "own"))):
                known = {r["shape"]: field.potential(r["counts"]) for r in own or ()}
                added = []
                for part in parts:
                    nodes = np.array(part["nodes"]).reshape(-1, 3).tolist()
                    edges = np.array(part["edges"]).reshape(-1, 3).tolist()
                    potentials = [known.get(s, field.rest) for s in part["shapes"]]
                    marginals = field.passed(potentials, [n[0] for n in nodes], edges)
                    for (label, start, end), m in zip(nodes, marginals):
                        kind = int(m.argmax())
                        if label == OUTSIDE and kind != OUTSIDE and m[kind] >= SURE and start < end:
                            added.append((kind, start, end))
                kinds = (s.split(":") for s in base.split(","))
                spans = {(KINDS.index(k), int(a), int(b)) for k, a, b in kinds}
                every.append(as_text(sorted(spans.union(added))))
                more.append(len(added))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", *(f"n_{k}" for k in KINDS), "base_spans")]
                + [pa.array(every, pa.string()), pa.array(more, pa.int64())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_spans", "spans", "n_added"],
            )

    return decide


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, counts of the patterns' matches by kind, base_spans and
    spans (kind:start:end in code points, end exclusive, by kind and start)."""
    source = id_and_text(docs, id_column, text_column)
    field, shapes = train(source)
    parts = "array<struct<shapes: array<string>, nodes: array<int>, edges: array<int>>>"
    # Written, as the keys of rows are drawn at random.
    rows = written(source.mapInArrow(_matched, f"{_COUNTS}, row string, parts {parts}"), "personal-data")
    undecided = rows.where("row is not null")
    wanted = undecided.select("row", F.explode(F.array_distinct(F.flatten("parts.shapes"))).alias("shape"))
    own = wanted.join(small_side(shapes), "shape").groupBy("row").agg(F.collect_list(F.struct("shape", "counts")).alias("own"))
    decided = undecided.join(own, "row", "left").mapInArrow(
        _decided(field), f"{_COUNTS}, spans string, n_added bigint"
    )
    plain = rows.where("row is null").drop("row", "parts")
    return plain.select("*", F.col("base_spans").alias("spans"), F.lit(0).cast("bigint").alias("n_added")).unionByName(decided)


def digest(found: DataFrame) -> DataFrame:
    sha = F.sha2(F.col("base_spans").cast("binary"), 256)
    return found.select("doc_id", *(f"n_{k}" for k in KINDS), sha.alias("base_sha256"), "spans", "n_added")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind; overlapping spans as one."""
    out, last = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= last:
            out += [text[last:a], f"[{KINDS[kind].upper()}]"]
        last = max(last, b)
    return "".join([*out, text[last:]])
