import numpy as np
from helpers import docs

from tidewright.llm import quality as op
from tidewright.llm.queries import op9_quality

import random


def simulated(n=20_000, seed=1):
    """Votes of labellers with known tables, as (votes, counts, truth share)."""
    rng = np.random.default_rng(seed)
    good = rng.random(n) < 0.8
    finds, errs = rng.uniform(0.3, 0.6, 8), rng.uniform(0.005, 0.04, 8)
    bad_vote = np.where(good[:, None], rng.random((n, 8)) < errs, rng.random((n, 8)) < finds)
    votes = np.where(rng.random((n, 8)) < 0.1, op.NOTHING, np.where(bad_vote, op.BAD, op.GOOD))
    return votes, good, finds, errs


def test_em_recovers_the_labellers():
    votes, good, finds, errs = simulated()
    rows, counts = np.unique(votes, axis=0, return_counts=True)
    share, tables = op.fit_labellers(rows, counts.astype(float))
    assert abs(share - good.mean()) < 0.03
    # What is assumed draws the rates of the rarer class by about a fifth.
    assert np.abs(tables[:, op.BAD, op.BAD] - finds).max() < 0.1
    assert np.abs(tables[:, op.GOOD, op.BAD] - errs).max() < 0.02
    p = op.posterior(votes, share, tables)
    true = np.stack([np.stack([finds, 1 - finds], 1), np.stack([errs, 1 - errs], 1)], axis=1)
    best = op.posterior(votes, 0.8, true)  # what the true rates can tell
    assert ((p > 0.5) == good).mean() > ((best > 0.5) == good).mean() - 0.003


def test_posterior_by_hand():
    tables = np.array([[[0.6, 0.4], [0.1, 0.9]], [[0.5, 0.5], [0.2, 0.8]]])
    got = op.posterior(np.array([[0, 1], [2, 2]]), 0.7, tables)
    a, b = 0.7 * 0.1 * 0.8, 0.3 * 0.6 * 0.5
    assert np.allclose(got, [a / (a + b), 0.7])


def block(texts):
    parts = [t.encode() for t in texts]
    return op.Block(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0] + [len(p) for p in parts]))


def test_numbers_of_a_block_against_plain_python():
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["the", "The", "é|", "|", "word", "%%x"], k=rng.randint(0, 60))) for _ in range(30)]
    got = block(texts)
    for t, text in enumerate(texts):
        w = text.encode().split()
        n = max(1, len(w))
        assert got.count[t] == len(w)
        assert np.isclose(got.distinct[t], len(set(w)) / n)
        assert np.isclose(got.twice[t], sum(a == b for a, b in zip(w, w[1:])) / n)
        threes = list(zip(w, w[1:], w[2:]))
        assert np.isclose(got.threes[t], len(set(threes)) / max(1, len(threes)))
        assert np.isclose(got.upper[t], sum(c.isupper() for c in text) / max(1, len(text.encode())))
        assert np.isclose(got.marks[t], sum(x == b"|" for x in w) / n)
        assert np.isclose(got.stop[t], sum(x == b"the" for x in w) / n)


def test_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "the word of the day"), (4, "x" * 200_000), (5, "the cat is on the mat. " * 2000), (5, "same"), (5, "same")]
    df = docs(spark, rows).selectExpr("*", "1 AS score", "2 AS posterior", "3 AS code")
    out = op.classify(df).collect()
    assert len(out) == 8 and all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 for r in out)
    assert len({(r.score, r.posterior) for r in out if r.doc_id in (1, 2, 3)}) == 1
    assert op.classify(docs(spark, [])).collect() == []


def test_query_agrees_with_labels_it_never_saw(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = op9_quality(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    known = [r for r in rows if r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in known]) > 0.95
    good, bad = (np.array([r.score for r in known if truth[r.doc_id] == v]) for v in (1, 0))
    assert np.mean([(good > b).mean() + (good == b).mean() / 2 for b in bad]) > 0.95


def test_sample_counts_a_repeated_text_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(op, "_trained", lambda rows: seen.append(len(rows)) or (op.np.zeros(op.BUCKETS), 0.0))
    rows = [(i, f"text number {i} of its own") for i in range(60)] + [(100 + i, "the same text again") for i in range(900)]
    op.classify(docs(spark, rows), sample=50).collect()
    assert seen == [50]
