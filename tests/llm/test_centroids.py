import hashlib
import math
import random

import pytest

from tidewright.llm import centroids as op
from tidewright.llm.queries import op11_centroids

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, clusters, rounds, size, scale=1024, seed="3:"):
    kept = [
        (i, tuple(math.floor(scale * x) for x in v))
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    digest = lambda i: hashlib.sha256(f"{seed}{i}".encode()).hexdigest()
    first = sorted(kept, key=lambda r: (r[0] is None, digest(r[0]), r[1]))[:clusters]
    centers = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centers))

    for _ in range(rounds):
        members = [[] for _ in centers]
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        centers = [tuple(sum(c) // len(m) for c in zip(*m)) if m else c for c, m in zip(centers, members)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = [sum(d for _, d, k in found if k == c) for c in range(len(centers))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((i, k, d, inertia[k], sum(inertia), sha[k]) for i, d, k in found), key=str)


def found(df):
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(3)


def test_random_vectors_ties_and_repeats(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.7501]) for _ in range(3)]) for i in range(60)]
    rows += rows[:9] + [(None, [0.1, 0.2, 0.3]), (None, [0.0, -0.1, 9.0])]
    for clusters, rounds in [(4, 3), (8, 1), (2, 0)]:
        out = op.cluster_vectors(frame(spark, rows), clusters=clusters, rounds=rounds, size=3)
        assert found(out) == brute(rows, clusters, rounds, 3)


def test_what_is_not_kept(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [1.0, -inf]), (7, [1.0, 2.0, 3.0])]
    good = [(8, [-0.0001, 0.0]), (9, [1.0, 1.0]), (10, [1.0, 1.5])]
    out = op.cluster_vectors(frame(spark, bad + good), clusters=5, rounds=2, size=2)
    assert found(out) == brute(bad + good, 5, 2, 2)
    assert op.cluster_vectors(frame(spark, bad), size=2).collect() == []
    empty = op.cluster_vectors(frame(spark, []))
    assert empty.collect() == [] and empty.columns == out.columns


def test_one_point_leaves_the_other_clusters_empty(spark):
    rows = [(i, [0.5, 0.5]) for i in range(10)]
    assert found(op.cluster_vectors(frame(spark, rows), clusters=3, rounds=2, size=2)) == brute(rows, 3, 2, 2)


def test_clashing_columns(spark):
    rows = [(i, [i / 7, 1.0]) for i in range(6)]
    df = frame(spark, rows).selectExpr("*", "1 AS v", "2 AS cluster", "3 AS distance", "'x' AS nearest")
    assert found(op.cluster_vectors(df, clusters=2, rounds=3, size=2)) == brute(rows, 2, 3, 2)


def test_numbers_too_large_for_long_distances(spark):
    with pytest.raises(ValueError, match="1 vectors"):
        op.cluster_vectors(frame(spark, [(1, [1e30, 0.0]), (2, [1.0, 1.0])]), size=2)


def test_no_python_and_no_shuffle_of_vectors(spark, table):
    kept = op._integers(table(spark, "embeddings"), "vec_id", "embedding", 64, 1024)
    plan = op._assigned(kept, [[0] * 64, [1] * 64])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_query_on_the_whole_table(spark, table):
    rows = [(r.vec_id, r.embedding) for r in table(spark, "embeddings").collect()]
    assert found(op11_centroids(spark, "/root/testdata/sf0.001")) == brute(rows, 8, 10, 64)
