"""Operator 13: centroid clustering of embeddings in integers, by Spark's own expressions alone.

A vector becomes whole numbers, ``floor(SCALE * x)`` of every component. A centroid is a literal array:
``zip_with`` and ``aggregate`` give its squared distance from the vector, and ``array_min`` over structs
of distance and number chooses the cluster, so that ties go to the smaller number. A round is one
aggregation of column sums, added up in each task before anything is shuffled: a cluster is a row for
each task however many vectors it holds, and the driver gets a row for each cluster. New centroids are
exact quotients of those sums, rounded down. All numbers are integers, so that no result depends on the
order of addition or on the number of partitions.

The whole numbers are written once to the shared folder, as every round reads them, and so is the last
assignment, from which the sums of distances are taken.

Edge cases. Vectors that are null, of another length, or that hold a null, a NaN or an infinity give no
row; an empty table gives none. Equal vectors all count. A repeated id gives a row for each time; a null
id is kept, but starts a centroid only where fewer ids than centroids are there. With fewer vectors than
centroids there are as many centroids as vectors. Equal hashes of ids are ordered by vector. Components
beyond ``LIMIT`` in size are set to it, so that a distance fits a long; sums of distances beyond a
long are null. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.session import settle

CLUSTERS = 16
ROUNDS = 3
DIMENSIONS = 64
SCALE = 64
SEED = 1
#: Largest size of a component in whole numbers. 64 squares of twice that stay below 2**63.
LIMIT = 2**27
LONG = 2**63

Centroid = tuple[int, ...]


def whole_vectors(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    dimensions: int = DIMENSIONS, scale: int = SCALE,
) -> DataFrame:
    """``id``, the whole numbers ``v`` of each vector of ``dimensions`` finite components, and their ``squares``' sum."""
    boxed = df.select(df[id_col].alias("id"), df[vector_col].cast("array<double>").alias("x"))
    finite = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    whole = F.transform("x", lambda e: F.floor(F.greatest(F.least(e * scale, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))))
    kept = boxed.where((F.size("x") == dimensions) & finite).select("id", whole.alias("v"))
    return kept.withColumn("squares", F.aggregate("v", F.lit(0).cast("bigint"), lambda s, e: s + e * e))


def starts(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> list[Centroid]:
    """The vectors whose ``seed:id`` has the least SHA-256, in that order."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    chosen = vectors.select("v", name.alias("h")).orderBy(F.col("h").asc_nulls_last(), "v").limit(clusters)
    return [tuple(r["v"]) for r in chosen.collect()]


def distance(centroid: Centroid) -> Column:
    """Squared Euclidean distance of ``v`` from a literal array, as v*v - 2*v*c + c*c."""
    literal = F.expr(f"array({', '.join(f'{-2 * x}L' for x in centroid)})")
    own = F.lit(sum(x * x for x in centroid)).cast("bigint")
    return F.col("squares") + F.aggregate(F.zip_with("v", literal, lambda a, b: a * b), own, lambda s, x: s + x)


def nearest(centroids: list[Centroid]) -> Column:
    """The struct (distance, cluster) of the nearest centroid, and the smaller number of equally near ones."""
    each = [F.struct(distance(c).alias("distance"), F.lit(k).alias("cluster")) for k, c in enumerate(centroids)]
    return F.array_min(F.array(*each))


def moved(vectors: DataFrame, centroids: list[Centroid]) -> list[Centroid]:
    """One round: every centroid becomes the mean of its vectors, rounded down; one without vectors stays."""
    dims = range(len(centroids[0]))
    sums = vectors.select(nearest(centroids)["cluster"].alias("cluster"), "v").groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col("v")[i]).alias(f"s{i}") for i in dims]
    )
    out = list(centroids)
    for r in sums.collect():
        out[r["cluster"]] = tuple(r[f"s{i}"] // r["n"] for i in dims)
    return out


def centroid_digest(centroid: Centroid) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def clustered(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS,
    rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED,
) -> tuple[DataFrame, list[Centroid]]:
    """``id``, ``cluster`` and ``distance`` of each vector after ``rounds`` moves, and the centroids."""
    vectors = settle(whole_vectors(df, id_col, vector_col, dimensions, scale), "whole-vectors")
    centroids = starts(vectors, clusters, seed)
    if not centroids:
        return vectors.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance")), []
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    found = vectors.select("id", nearest(centroids).alias("nearest"))
    return settle(found.select("id", "nearest.cluster", "nearest.distance"), "clusters"), centroids


def cluster_report(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", **options) -> DataFrame:
    """``clustered`` with the sum of distances of the cluster and of all, and a digest of its centroid."""
    found, centroids = clustered(df, id_col, vector_col, **options)
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()
    own = {r["cluster"]: int(r["s"]) for r in sums}
    total = sum(own.values())
    held = lambda x: x if x < LONG else None
    rows = [(k, held(s), held(total), centroid_digest(centroids[k])) for k, s in own.items()]
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    figures = df.sparkSession.createDataFrame(rows, schema)  # a row for each cluster
    return found.join(F.broadcast(figures), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
