import random
import re

import numpy as np
import pytest
from helpers import docs

from tidewright.llm import decontamination as op
from tidewright.llm.queries import op3_decontamination

WORD = re.compile(r"[^\W_]+")


def tiling(a, b, least):
    """Textbook greedy string tiling of two word lists: marked words of ``b``."""
    marked_a, marked_b, tiles = set(), set(), []
    while True:
        best = (least - 1, 0, 0)
        for p in range(len(b)):
            for d in range(len(a)):
                k = 0
                while (p + k < len(b) and d + k < len(a) and a[d + k] == b[p + k]
                       and d + k not in marked_a and p + k not in marked_b):
                    k += 1
                if k > best[0]:
                    best = (k, p, d)
        if best[0] < least:
            return tiles
        n, p, d = best
        tiles.append(best)
        marked_a.update(range(d, d + n))
        marked_b.update(range(p, p + n))


def words(text):
    return [w.lower() for w in WORD.findall(text or "")]


def brute(rows, items, least=op.LEAST):
    out = {}
    for i, t in rows:
        best = (0.0, None)
        for k, body in sorted(items, key=lambda x: (x[0] is None, x[0])):
            b = words(body)
            tiles = tiling(words(t), b, least)
            covered = sum(n for n, _, _ in tiles) / max(1, len(b))
            if covered > best[0]:
                best = (covered, k)
        out[i] = best
    return out


def bench(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def found(df):
    return {r.doc_id: (r.coverage, r.item_id) for r in df.collect()}


def cases(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for k in range(8)]
    rows = []
    for i in range(40):
        text = rng.choices(vocabulary, k=rng.randint(0, 30))
        source = items[i % 8][1].split()
        cut = rng.randint(0, len(source))
        pieces = [source[:cut], source[cut:], rng.choices(vocabulary, k=3)]
        rng.shuffle(pieces)
        for p in pieces[: i % 4]:
            text += p
        rows.append((i, ", ".join(text).upper() if i % 5 == 0 else " ".join(text)))
    return rows, items


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block_words", [op.BLOCK_WORDS, 60])
def test_against_textbook_tiling(spark, seed, block_words):
    rows, items = cases(seed)
    got = found(op.contamination(docs(spark, rows), bench(spark, items), least=3, block_words=block_words))
    assert got == brute(rows, items, 3)


def test_reordered_passage(spark):
    item = " ".join(f"w{k}" for k in range(40))
    parts = [" ".join(f"w{k}" for k in range(a, a + 10)) for a in (20, 0, 30, 10)]
    rows = [(1, "before. " + "; and then ".join(parts) + " after"), (2, "w1 w2 w3 w4 w5 w6 w7 only"), (3, "other words altogether")]
    out = {r.doc_id: r for r in op.contamination(docs(spark, rows), bench(spark, [(7, item)])).collect()}
    assert (out[1].contaminated, out[1].coverage, out[1].item_id, out[1].n_tiles) == (True, 1.0, 7, 4)
    assert not out[2].contaminated and out[2].coverage == 7 / 40
    assert not out[3].contaminated and out[3].item_id is None
    kept = op.without_contaminated(docs(spark, rows), bench(spark, [(7, item)]))
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3] and kept.columns == docs(spark, rows).columns


def test_cases(spark):
    item = " ".join(f"É{k}" for k in range(12))
    rows = [(1, None), (2, ""), (3, item.lower()), (None, item), (3, "x " * 50_000), (4, "word" * 100_000)]
    items = [(5, item), (4, item), (None, item), (6, None), (7, ""), (8, "too short")]
    df = docs(spark, rows).selectExpr("*", "1 AS item", "2 AS covered", "3 AS tiles")
    out = [(r.doc_id, r.contaminated, r.item_id) for r in op.contamination(df, bench(spark, items)).collect()]
    assert sorted(out, key=str) == sorted(
        [(1, False, None), (2, False, None), (3, True, 4), (None, True, 4), (3, False, None), (4, False, None)], key=str
    )
    assert not any(r.contaminated for r in op.contamination(df, bench(spark, [])).collect())
    assert op.contamination(docs(spark, []), bench(spark, items)).collect() == []
    assert op.without_contaminated(df, bench(spark, items)).columns == df.columns


def test_query_on_the_whole_table(spark, table):
    rows = {r.doc_id: words(r.text) for r in table(spark, "documents").collect()}
    items = {r.item_id: words(r.text) for r in table(spark, "benchmark").collect()}
    out = {r.doc_id: r for r in op3_decontamination(spark, "/root/testdata/sf0.001").collect()}
    assert set(out) == set(rows)
    for i, text in rows.items():
        joined = " " + " ".join(text) + " "
        holds = any(len(b) >= op.LEAST and f" {' '.join(b)} " in joined for b in items.values())
        assert out[i].contaminated or not holds
        if out[i].contaminated:
            assert sum(n for n, _, _ in tiling(text, items[out[i].item_id], op.LEAST)) / len(items[out[i].item_id]) == out[i].coverage
