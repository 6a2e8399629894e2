"""Lloyd's clustering with the dimensions in shards, in exact integers.

A vector is cut into blocks of ``BLOCK`` components, and a row ``(block, row, xs)`` is one of
them.  A round goes so:

* A task holds rows of one block after another with the slice of every centroid for them, and
  gives the squared distances within the block.  Summed by the row of the vector they are exact
  distances; the least one, and among equal ones the smallest number, is the cluster.
* The clusters go back to the blocks, which stay where they are: the table of blocks is placed
  by ``(block, row)`` once.  Each block sums its own components by cluster, which gives its
  slice of the new centroids.

On the driver are the centroids, ``k`` times the dimensions, and one sum for each.  A cluster
with most of the vectors is as many partial sums as there are tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from topicpulse.llm.common import cut
from topicpulse.operators.lineage import fixed_layout, partitions_for

DIMENSIONS = 64
SCALE = 64
K = 16
ROUNDS = 3
BLOCK = 16
ROWS_PER_PARTITION = 200_000

RESULT = (
    "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, "
    "centroid_sha256 string"
)


def whole_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """``vec_id, xs``: vectors of so many finite components, as integers ``floor(64 * x)``.

    Vectors that are null, of another length, or hold a null, a NaN or an infinity are left
    out.  Rows stay rows: a repeated ``vec_id`` is a vector each time, and it may be null.
    """
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < float("inf")))
    kept = vectors.filter((F.size(x) == dimensions) & finite)
    scaled = F.transform(x, lambda v: F.floor(v * float(SCALE)).cast("bigint"))
    return kept.select(F.col("vec_id").cast("bigint").alias("vec_id"), scaled.alias("xs"))


def first_centroids(vectors: DataFrame, k: int = K) -> list[list[int]]:
    """The vectors with the smallest hashes of their ids, those of null ids last."""
    mark = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    chosen = vectors.orderBy(mark.asc_nulls_last(), "xs").limit(k)
    return [list(r.xs) for r in chosen.collect()]


def block_distances(blocks: DataFrame, centroids: list[list[int]], width: int) -> DataFrame:
    """``row, vec_id, d``: the squared distances of a block to its slice of each centroid."""
    whole = np.array(centroids, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("block").to_numpy(zero_copy_only=False)
            lists = batch.column("xs")
            flat = lists.flatten().to_numpy()
            starts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            out = np.empty((batch.num_rows, len(whole)), dtype=np.int64)
            for block in np.unique(places):
                own = np.flatnonzero(places == block)
                part = whole[:, block * width : (block + 1) * width]
                xs = flat[starts[own][:, None] + np.arange(part.shape[1])]
                for j, centre in enumerate(part):
                    apart = xs - centre
                    out[own, j] = np.einsum("ij,ij->i", apart, apart)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * len(whole)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("vec_id"),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel())),
                ],
                names=["row", "vec_id", "d"],
            )

    return blocks.mapInArrow(run, "row bigint, vec_id bigint, d array<bigint>")


def assigned(blocks: DataFrame, centroids: list[list[int]], width: int) -> DataFrame:
    """``row, vec_id, cluster, distance``: the blocks of a vector added up, and the least."""
    parts = block_distances(blocks, centroids, width)
    sums = parts.groupBy("row", "vec_id").agg(
        *[F.sum(F.get("d", F.lit(j))).alias(f"_{j}") for j in range(len(centroids))]
    )
    whole = F.array(*[f"_{j}" for j in range(len(centroids))])
    least = sums.select("row", "vec_id", whole.alias("_d"), F.array_min(whole).alias("distance"))
    first = F.array_position("_d", F.col("distance")) - 1
    return least.select("row", "vec_id", first.cast("int").alias("cluster"), "distance")


def moved(blocks: DataFrame, clusters: DataFrame, centroids: list, width: int) -> list[list[int]]:
    """The exact floored means of the clusters; a centroid without vectors stays."""
    numbers = range(-(-len(centroids[0]) // width))
    sent = clusters.select(
        "row", "cluster", F.explode(F.array(*[F.lit(b) for b in numbers])).alias("block")
    )
    sums = blocks.join(sent, ["block", "row"]).groupBy("block", "cluster").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.get("xs", F.lit(i))).alias(f"_{i}") for i in range(width)]
    )
    after = [list(c) for c in centroids]
    for r in sums.collect():
        for i in range(width):
            at = r.block * width + i
            if at < len(after[r.cluster]):
                after[r.cluster][at] = r[f"_{i}"] // r.n
    return after


def cluster(
    vectors: DataFrame,
    k: int = K,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    block: int = BLOCK,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of each vector.

    With fewer than ``k`` vectors each is a centroid; equal ones among them leave clusters
    empty, as ties go to the smaller number.  Without a vector the result is empty.  Only the
    columns ``vec_id`` and ``embedding`` are read.  Distances are exact while components stay
    below ``2 ** 27`` after scaling; sums of distances beyond 64 bits raise an error.
    """
    spark = vectors.sparkSession
    # The number of a row must not change when a task runs again.
    kept = cut(whole_vectors(vectors, dimensions).withColumn("row", F.monotonically_increasing_id()))
    centroids = first_centroids(kept, k)
    if not centroids:
        return spark.createDataFrame([], RESULT)
    numbers = range(-(-dimensions // block))
    parts = F.array(
        *[F.struct(F.lit(b).alias("block"), F.slice("xs", b * block + 1, block).alias("xs")) for b in numbers]
    )
    width = len(numbers)
    partitions = partitions_for(kept.count() * width, ROWS_PER_PARTITION, least=2 * width)
    with fixed_layout(spark, partitions):
        long = kept.select("row", "vec_id", F.explode(parts).alias("_p"))
        placed = long.select("_p.block", "row", "vec_id", "_p.xs").repartition("block", "row")
        blocks = cut(placed)
        for _ in range(rounds):
            clusters = assigned(blocks, centroids, block)
            centroids = moved(blocks, clusters, centroids, block)
        found = cut(assigned(blocks, centroids, block))
    inertia = {r.cluster: r.s for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    told = spark.createDataFrame(
        [
            (j, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
            for j, c in enumerate(centroids)
            if j in inertia
        ],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return found.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
