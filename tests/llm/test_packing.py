import random
from collections import defaultdict

import pytest
from helpers import docs

from tidewright.llm import packing as op
from tidewright.llm.queries import op8_packing


def naive(pieces, capacity):
    bins, out = [], []
    for size, source, cluster in pieces:
        fits = [k for k, b in enumerate(bins)
                if b[0] >= size and not any(s & source or c & cluster for s, c in b[1])]
        if fits:
            k = min(fits, key=lambda k: (bins[k][0], k))
        else:
            k = len(bins)
            bins.append([capacity, []])
        out.append((k, capacity - bins[k][0]))
        bins[k][0] -= size
        bins[k][1].append((source, cluster))
    return out


@pytest.mark.parametrize("seed", range(30))
def test_best_fit_is_the_tightest_compatible_bin(seed):
    rng = random.Random(seed)
    pieces = sorted(
        ((rng.randint(1, 40), rng.choice([0, 1, 2, 4]), rng.choice([0, 0, 1, 2])) for _ in range(120)),
        key=lambda p: -p[0],
    )
    # full bins are closed in one and open in the other, which no piece can use
    assert op.best_fit(pieces, 64) == naive(pieces, 64)


def check(spark, df, one_per_source=True, **options):
    sized = op.sizes(df).collect()
    rows = op.pack_documents(df, one_per_source=one_per_source, **options).collect()
    capacity = options.get("capacity", op.CAPACITY)
    assert sum(r["size"] for r in sized) == sum(r.n_tokens for r in rows)
    bins = defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
    about = {r.doc_id: r for r in sized}
    for pieces in bins.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.n_tokens
        assert at <= capacity
        sources = [about[r.doc_id].source for r in pieces if about[r.doc_id].source is not None]
        clusters = [about[r.doc_id].cluster for r in pieces]
        assert len(set(clusters)) == len(clusters)
        assert not one_per_source or len(set(sources)) == len(sources)
    starts = defaultdict(list)
    for r in rows:
        starts[r.doc_id].append((r.start, r.n_tokens))
    return rows, starts, about


def sample(n):
    rng = random.Random(4)
    rows = [(i, "word " * rng.randint(0, 90)) for i in range(n)] + [(1000 + i, "same text here") for i in range(40)]
    return rows + [(5000, "w " * 1000), (5001, None)]


@pytest.mark.parametrize("one_per_source", [True, False])
@pytest.mark.parametrize("group_tokens", [500, 1 << 20])
def test_bins_hold_their_conditions(spark, one_per_source, group_tokens):
    df = docs(spark, sample(150)).selectExpr("doc_id", "text", "if(doc_id = 3, null, source) AS source", "1 AS row", "2 AS size")
    _, starts, about = check(spark, df, one_per_source, capacity=128, group_tokens=group_tokens)
    for doc, parts in starts.items():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == about[doc].size


def test_repeated_rows_are_packed_each(spark):
    rows = op.pack_documents(docs(spark, [(1, "a b"), (1, "a b"), (None, "c")])).collect()
    assert len(rows) == 3 and len({r.bin_id for r in rows if r.doc_id == 1}) == 2


def test_empty_table(spark):
    assert op.pack_documents(docs(spark, [])).collect() == []


def test_query_on_the_whole_table(spark, table):
    df = table(spark, "documents")
    rows, _, about = check(spark, df)
    assert {r.doc_id for r in rows} == set(about)
    got = op8_packing(spark, "/root/testdata/sf0.001")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows))
