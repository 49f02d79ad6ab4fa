import hashlib
import zlib

import pytest
from helpers import DOCS, docs
from pyspark.sql import functions as F

from tidewright.llm import merkle as op
from tidewright.llm.queries import op12_merkle_manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return sha("".join(parts))


def tree(leaves):
    """(root, for each leaf its runs' hashes and its place in them)."""
    level, paths, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        runs = [level[i : i + 3] for i in range(0, len(level), 3)]
        for path, n in zip(paths, range(len(paths))):
            path.append((runs[at[n] // 3], at[n] % 3))
            at[n] //= 3
        level = [sha("".join(r)) for r in runs]
    return level[0] if level else None, paths


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text); a Counter-like sorted list of results."""
    first = lambda v: (v is not None, v or 0)
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    groups = [sorted((r for r in rows if r[1] == s), key=lambda r: (first(r[0]), leaf(r))) for s in sources]
    trees = [tree([leaf(r) for r in g]) for g in groups]
    root, tops = tree([t[0] for t in trees])
    out = []
    for group, (subroot, paths), top in zip(groups, trees, tops):
        for r, path in zip(group, paths):
            shown = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                shown = (*r[:4], r[4].replace("\n", ""))
            folded, siblings = leaf(shown), []
            for run, place in path + top:
                siblings += run[:place] + run[place + 1 :]
                folded = sha("".join([*run[:place], folded, *run[place + 1 :]]))
            out.append((r[0], leaf(r), subroot, root, sha("".join(siblings)), folded, folded == root))
    return sorted(out, key=str)


def found(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def proven(df, **kw):
    return op.proofs(op.build(df, presented={"text": op.without_line_ends(df)}, **kw))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, la, s, n) for i, s, la, n, t in rows], DOCS).repartition(3)


def some(n, source="a", first=0):
    return [(first + i, source, "en", i % 7, f"line {i}\nline {'x' * (i % 5)}") for i in range(n)]


@pytest.mark.parametrize("n", [1, 4, 9, 28])
def test_sizes_of_one_source(spark, n):
    assert found(proven(frame(spark, some(n)))) == brute(some(n))


def test_several_bands(spark):
    """Narrow bands, so that small trees have several, the tree of sources too."""
    rows = some(83) + some(1, "b", 200) + some(10, "c", 300) + some(28, "d", 400) + some(4, None, 500)
    rows += [r for i in range(11) for r in some(1, f"s{i}", 1000 + i)]
    for band in (1, 2):
        assert found(proven(frame(spark, rows), band=band)) == brute(rows)


def test_more_than_a_run(spark):
    rows = some(1500, "hot") + some(5, "cold", 5000)
    assert found(proven(frame(spark, rows))) == brute(rows)


def test_nulls_ties_repeats_and_odd_texts(spark):
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (1, "a", None, 3, None), (1, "a", None, 3, ""),
        (1, "a", "de", None, "é\n\n"), (1, "a", "de", None, "é\n\n"), (-7, "", "x", 0, "\n"), (2, "é", "x", 1, "z" * 300_000),
        (3, "Z", "x", 1, "1:a"), (4, "z", None, None, "-"), (None, "a", "b", 1, "c\n"),
    ]
    assert found(proven(frame(spark, rows))) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert proven(docs(spark, [])).collect() == []
    rows = some(12)
    df = frame(spark, rows).selectExpr("*", "1 AS rank", "2 AS tree", "3 AS digest", "'x' AS path", "4 AS members", "5 AS tie")
    assert found(proven(df)) == brute(rows)


def test_nodes_cover_each_level(spark):
    manifest = op.build(frame(spark, some(30) + some(5, "b", 100)))
    nodes = manifest.nodes().where("source = 'a'").orderBy("level", "lo").collect()
    by_level = {}
    for r in nodes:
        by_level.setdefault(r.level, []).append((r.lo, r.hi))
    assert [len(by_level[k]) for k in sorted(by_level)] == [30, 10, 4, 2, 1]
    for spans in by_level.values():
        assert spans[0][0] == 0 and spans[-1][1] == 30 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    subroots = {r.source: r.subroot for r in manifest.subroots().collect()}
    assert subroots["a"] == nodes[-1].digest and set(subroots) == {"a", "b"}


def test_untampered_rows_verify(spark):
    out = op.proofs(op.build(frame(spark, some(40))))
    assert out.where(F.col("verified")).count() == 40


def test_query_on_the_whole_table(spark, table):
    rows = [tuple(r) for r in table(spark, "documents").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = found(op12_merkle_manifest(spark, "/root/testdata/sf0.001"))
    assert got == brute(rows)
    assert {r[6] for r in got} == {True, False}
