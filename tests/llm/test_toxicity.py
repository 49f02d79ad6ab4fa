import random
import zlib

import pytest
from helpers import docs

from tidewright.llm import toxicity as op
from tidewright.llm.queries import op10_toxicity

I, T, N, R, O = (op.INSULT, 2.0, False), (op.TARGET, 0.0, False), (op.NEGATION, 0.0, False), (op.REPORT, 0.0, False), (op.OTHER, 0.0, False)


@pytest.mark.parametrize(
    "clause, weight",
    [
        ([O, O], 0.0), ([I], 2.0), ([I, I], 4.0), ([T, O, I], 3.0), ([T, N, O, I], 1.2), ([N, O, O, O, I], 2.0),
        ([R, O, I], 1.2), ([R, T, O, O, O, O, I], 1.8), ([N, I, N, N, I], 1.6), ([I, N], 2.0), ([N, R, I], 1.2),
    ],
)
def test_grammar(clause, weight):
    assert op.clause_weight(clause) == pytest.approx(weight)


def corpus(n=300):
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "work"]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) + rng.choice(["", "", ".", ","]) for _ in range(rng.randint(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["grobnik", "zilzan", "vequ" + rng.choice(words)]))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_learns_words_and_beginnings(spark):
    rows, labels = corpus()
    model = op.train(docs(spark, rows), labelled(spark, labels))
    assert {"grobnik", "zilzan", "vequ*"} <= set(model.insults)
    scores = {r.doc_id: r for r in op.score_documents(docs(spark, rows), model).collect()}
    truth = {i: t for i, _, t in labels}
    assert all(scores[i].predicted == truth[i] for i in truth if zlib.crc32(str(i).encode()) % 5 == 0)
    assert model.score("vequnever seen, zilzan!".encode())[0] > 0.5
    kept = op.without_toxic(docs(spark, rows), labelled(spark, labels))
    assert kept.columns == docs(spark, rows).columns
    assert {r.doc_id for r in kept.collect()} == {i for i in truth if not scores[i].predicted}


def test_held_out_labels_change_nothing(spark):
    rows, labels = corpus(120)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    a, b = (op.train(docs(spark, rows), labelled(spark, x)) for x in (labels, turned))
    assert a == b


def test_copies_of_one_text_teach_nothing(spark):
    rows, labels = corpus(200)
    rows += [(1000 + i, "a copied text with rareword inside of it") for i in range(50)]
    labels += [(1000 + i, 1, 1) for i in range(50)]
    assert "rareword" not in op.train(docs(spark, rows), labelled(spark, labels)).insults


def test_cases(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "you idiot"), (5, "x" * 300_000), (6, "you idiot moron " * 3000), (7, "%%% ... \x00")]
    df = docs(spark, rows + rows[-2:]).selectExpr("*", "1 AS score", "2 AS toxic", "3 AS predicted")
    assert op.train(df, labelled(spark, [])) == op.DEFAULT
    assert op.train(docs(spark, []), labelled(spark, [(1, 1, 1)])) == op.DEFAULT
    odd = spark.createDataFrame([(None, 1, 1), (1, 0, None), (1, 1, 0), (1, 1, 1), (3, 1, 0)], "doc_id bigint, quality int, toxic int")
    model = op.train(df, odd)
    out = op.score_documents(df, model).collect()
    assert len(out) == 9 and all(0 <= r.score <= 1 for r in out)
    empty = {r.score for r in out if r.doc_id in (1, 2, 3)}
    assert len(empty) == 1
    assert op.score_documents(docs(spark, []), model).collect() == []
    assert op.without_toxic(df, odd).columns == df.columns


def test_query_finds_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = op10_toxicity(spark, sf_dir).collect()
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    good = sum(r.predicted == truth[r.doc_id] for r in held)
    assert good / len(held) > 0.95
    toxic, clean = ([r.score for r in held if truth[r.doc_id] == v] for v in (1, 0))
    # Some texts labelled toxic there are repeated lines or rows of a table only.
    auc = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert auc > 0.94


def test_sample_has_one_row_for_each_id(spark):
    """An id on very many rows neither fills the sample nor outweighs the others."""
    rows = [(7, f"repeated text {k % 5}") for k in range(3000)] + [(8, "another text")]
    labels = spark.createDataFrame([(7, 1), (8, 0)], "doc_id bigint, toxic int")
    sample = op._sample(docs(spark, rows).select("doc_id", "text"), labels)
    assert sorted(r.toxic for r in sample.collect()) == [0, 1]
