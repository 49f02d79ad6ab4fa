"""Centroid clustering on integers, with nothing but expressions of the JVM.

Components become integers, floor(scale * x). ``zip_with`` and ``aggregate`` give
the squared distance of a vector to each centroid, a literal array; ``array_min``
over (distance, number) chooses the cluster, so that ties go to the smaller number.
One aggregate with a sum for each component then moves the centroids: it is
partial in each task, which sends one row per cluster, so a hot cluster is no hot
task. The new centroid is the exact floor of sum / count.

The vectors kept are written once, as integers; a round reads them and brings
(clusters x components) sums to the driver, whatever the number of vectors. No
vector is shuffled.

Cases: vectors that are null, of another length, or with a null or non-finite
component are not kept; with none kept the result is empty. Fewer vectors than
clusters start as many clusters as there are. Repeated rows each count; of equal
centroids the first gets all vectors. Empty clusters keep their centroid. The
vectors that clusters start from are taken in the order of their ids' hashes, null
ids last, then of their components. Other columns, whatever their names, are not
read; there is no text. Integers beyond ``LARGEST`` are refused with an error, as
their distances are no 64-bit integers.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import written

# Integers up to here, of which 64 squared differences add up to less than 2**63.
LARGEST = 1 << 27


def _integers(vectors: DataFrame, id_column: str, vector_column: str, size: int, scale: int) -> DataFrame:
    """(vec_id, v) of the vectors that are kept."""
    vector = F.col(f"`{vector_column}`").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.where(vector.isNotNull() & (F.size(vector) == size) & finite)
    return kept.select(
        F.col(f"`{id_column}`").alias("vec_id"),
        F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x)).alias("v"),
    )


def _refuse_beyond(kept: DataFrame) -> None:
    beyond = F.exists("v", lambda x: F.abs(x) > F.lit(LARGEST))
    n = kept.agg(F.count_if(beyond)).first()[0]
    if n:
        raise ValueError(f"{n} vectors have integers beyond {LARGEST}; use a smaller scale.")


def _first_centroids(kept: DataFrame, clusters: int, seed: str) -> list[list[int]]:
    """The vectors whose ids have the smallest hashes: a top-k, no sort of all."""
    order = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = kept.select(order.alias("at"), "v").orderBy(F.col("at").asc_nulls_last(), "v").limit(clusters)
    return [list(r["v"]) for r in first.collect()]


def _squared_distance(centroid: list[int]) -> str:
    literal = f"array({', '.join(f'{c}L' for c in centroid)})"
    return f"aggregate(zip_with(v, {literal}, (x, c) -> (x - c) * (x - c)), 0L, (total, x) -> total + x)"


def _assigned(kept: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """The kept vectors with ``cluster`` and ``distance`` of the nearest centroid."""
    # As text, which is one call to the JVM rather than one for each component.
    choices = [f"named_struct('distance', {_squared_distance(c)}, 'cluster', {k})" for k, c in enumerate(centroids)]
    nearest = kept.selectExpr("vec_id", "v", f"array_min(array({', '.join(choices)})) AS nearest")
    return nearest.select("vec_id", "v", "nearest.cluster", "nearest.distance")


def _moved(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: a row for each cluster comes to the driver."""
    size = len(centroids[0])
    sums = [F.expr(f"sum(v[{i}]) AS s{i}") for i in range(size)]
    rows = _assigned(kept, centroids).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect()
    after = list(centroids)
    for r in rows:
        after[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(size)]
    return after


def cluster_vectors(
    vectors: DataFrame,
    *,
    clusters: int = 8,
    rounds: int = 10,
    size: int = 64,
    scale: int = 1024,
    seed: str = "3:",
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """Per kept vector: vec_id, cluster, distance (squared, to its cluster's final
    centroid), cluster_inertia and inertia (distances summed over its cluster and
    over all), centroid_sha256 (of the centroid's components, joined by commas),
    cluster_size."""
    kept = written(_integers(vectors, id_column, vector_column, size, scale), "vectors")
    _refuse_beyond(kept)
    centroids = _first_centroids(kept, clusters, seed)
    if not centroids:
        return _described(kept.select("vec_id", "v", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), {}, [])
    for _ in range(rounds):
        moved = _moved(kept, centroids)
        if moved == centroids:
            break  # so would every further round
        centroids = moved
    found = written(_assigned(kept, centroids).drop("v"), "assigned")
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("inertia"), F.count(F.lit(1)).alias("n")).collect()
    return _described(found, {r["cluster"]: (r["inertia"], r["n"]) for r in sums}, centroids)


def _described(found: DataFrame, sums: dict[int, tuple[int, int]], centroids: list[list[int]]) -> DataFrame:
    """Joins the clusters' facts as literal arrays: one entry for each cluster."""
    facts = [sums.get(k, (0, 0)) for k in range(len(centroids))]

    def of_cluster(values: list, kind: str) -> Column:
        listed = F.array(*[F.lit(x) for x in values]).cast(f"array<{kind}>")
        return F.get(listed, F.col("cluster"))

    return found.select(
        "vec_id",
        "cluster",
        "distance",
        of_cluster([s for s, _ in facts], "bigint").alias("cluster_inertia"),
        F.lit(sum(s for s, _ in facts)).cast("bigint").alias("inertia"),
        of_cluster([_digest(c) for c in centroids], "string").alias("centroid_sha256"),
        of_cluster([n for _, n in facts], "bigint").alias("cluster_size"),
    )


def _digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
