from collections import Counter

from helpers import docs

from tidewright.llm import token_counts as op
from tidewright.llm import tokens
from tidewright.llm.queries import op7_token_counts

ENCODER = tokens.encoder(tokens.default_path())


def totals(df):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in df.collect()}


def brute(rows):
    n, size = Counter(), Counter()
    for r in rows:
        count = len(ENCODER.tokenizer.encode(r.text or "", add_special_tokens=False).ids)
        if count:
            n[r.source, r.lang, op.BPE] += 1
            size[r.source, r.lang, op.BPE] += count
    return {k: (n[k], size[k]) for k in n}


ROWS = [(1, "a b c"), (2, "d"), (3, None), (4, ""), (5, "long " * 30_000), (None, "x y"), (5, "d")]


def test_life_of_a_corpus(spark, tmp_path):
    df = docs(spark, ROWS).selectExpr("doc_id", "text", "if(doc_id = 2, null, lang) lang", "source", "1 n_docs", "2 tokenizer")
    assert totals(op.maintained_counts(df, f"{tmp_path}/r")) == brute(df.collect())


def test_batches_are_idempotent_and_additive(spark, tmp_path):
    counts = op.document_counts(docs(spark, ROWS)).cache()
    rollup = op.Rollup(spark, f"{tmp_path}/r")
    assert totals(rollup.totals()) == {}
    load = op.inserted(counts, op.WORDS, "n_words")
    assert rollup.commit("a", load) and not rollup.commit("a", load)
    once = totals(rollup.totals())
    assert sum(n for n, _ in once.values()) == len(ROWS)
    rollup.compact()
    assert totals(rollup.totals()) == once and not rollup.commit("a", load)
    # another writer object over the same folder sees the same state
    again = op.Rollup(spark, f"{tmp_path}/r")
    assert not again.commit("a", load) and totals(again.totals()) == once
    again.commit("b", op.deleted(counts, op.WORDS, "n_words"))
    assert totals(again.totals()) == {}
    again.commit("c", load)
    again.compact()
    assert totals(again.totals()) == once


def test_interrupted_batch_does_not_count(spark, tmp_path):
    counts = op.document_counts(docs(spark, ROWS))
    rollup = op.Rollup(spark, f"{tmp_path}/r")
    op.summed(op.inserted(counts, op.WORDS, "n_words")).write.parquet(f"{tmp_path}/r/deltas/lost")
    assert totals(rollup.totals()) == {}


def test_empty_table(spark, tmp_path):
    assert totals(op.maintained_counts(docs(spark, []), f"{tmp_path}/r")) == {}


def test_query_on_the_whole_table(spark, table):
    assert totals(op7_token_counts(spark, "/root/testdata/sf0.001")) == brute(table(spark, "documents").collect())
