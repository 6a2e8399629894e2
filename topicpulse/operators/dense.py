"""Searches of many sources at once, where a topic has few nodes that can be reached.

A task holds a block of sources of one topic as the rows of a matrix with a column for each node
that has incoming links.  A level is its product with the links, without the nodes seen before;
going back is the product with their transpose.  What a source gives is added up in the task.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# Tasks get these functions by value, executors needn't have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Sources in a matrix.
SOURCES = 512


class _Block:
    """Levels of a block of sources: their places in the matrix and the paths to them."""

    def __init__(self, first: np.ndarray, own: np.ndarray, links: np.ndarray):
        self.shape, self.links, self.levels = first.shape, links, []
        seen, newest = own, first
        while len(at := np.flatnonzero(newest)):
            self.levels.append((at, newest.ravel()[at]))
            seen |= newest > 0
            left = np.flatnonzero(newest.any(axis=0))
            newest = newest[:, left] @ links[left]
            newest[seen] = 0.0

    def met(self, axis: int) -> tuple[np.ndarray, np.ndarray]:
        """How many ends of paths are met and their distances, by source (0) or node (1)."""
        reached, distance = (np.zeros(self.shape[axis], dtype=np.int64) for _ in range(2))
        for step, (at, _) in enumerate(self.levels, start=1):
            count = np.bincount(np.unravel_index(at, self.shape)[axis], minlength=len(reached))
            reached += count
            distance += step * count
        return reached, distance

    def dependencies(self, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By node the dependencies, and the variance that they have in a sample."""
        total, variance = np.zeros(self.shape[1]), np.zeros(self.shape[1])
        dependency = np.zeros(self.shape)
        for (below, paths), (above, parts) in zip(self.levels[-2::-1], self.levels[:0:-1]):
            share = np.zeros(self.shape)
            share.ravel()[above] = (weight[above // self.shape[1]] + dependency.ravel()[above]) / parts
            taken = np.flatnonzero(share.any(axis=0))
            passed = share[:, taken] @ self.links[:, taken].T
            dependency = np.zeros(self.shape)
            dependency.ravel()[below] = paths * passed.ravel()[below]
            total += dependency.sum(axis=0)
            variance += ((1.0 - 1.0 / weight)[:, None] * dependency**2).sum(axis=0)
        return total, variance


class _Core:
    """The nodes with incoming links, in the order of topics, and the links among them."""

    def __init__(self, keys: np.ndarray, topics: np.ndarray, src: np.ndarray, dst: np.ndarray):
        topics = np.unique(topics, return_inverse=True)[1]
        order = np.lexsort((keys, topics))
        self.keys, self.topics = keys[order], topics[order]
        self.by_key = np.argsort(self.keys)
        self.sorted = self.keys[self.by_key]
        self.starts = np.searchsorted(self.topics, np.arange(self.topics[-1] + 2 if len(keys) else 1))
        self.src, self.dst = self.place(src)[0], self.place(dst)[0]
        self.made: tuple[int, np.ndarray] | None = None

    def place(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each key, and whether it is one of the nodes."""
        at = np.minimum(np.searchsorted(self.sorted, keys), len(self.sorted) - 1)
        return self.by_key[at], self.sorted[at] == keys

    def links(self, topic: int) -> np.ndarray:
        if self.made is None or self.made[0] != topic:
            start, end = self.starts[topic : topic + 2]
            own = self.topics[self.src] == topic
            matrix = np.zeros((end - start, end - start))
            np.add.at(matrix, (self.src[own] - start, self.dst[own] - start), 1.0)
            self.made = topic, matrix
        return self.made[1]

    def blocks(self, source, node, paths, weight) -> Iterator[tuple[np.ndarray, slice, np.ndarray, _Block]]:
        """Sources, columns, weights and searches; the rows of a source are all given."""
        at, _ = self.place(node)
        for topic in np.unique(self.topics[at]):
            start, end = self.starts[topic : topic + 2]
            mine = self.topics[at] == topic
            sources, first, rows = np.unique(source[mine], return_index=True, return_inverse=True)
            for k in range(0, len(sources), SOURCES):
                held = (rows >= k) & (rows < k + SOURCES)
                own = sources[k : k + SOURCES]
                matrix = np.zeros((len(own), end - start))
                np.add.at(matrix, (rows[held] - k, at[mine][held] - start), paths[mine][held])
                seen = np.zeros(matrix.shape, dtype=bool)
                place, known = self.place(own)
                known &= self.topics[place] == topic
                seen[np.flatnonzero(known), place[known] - start] = True
                weights = weight[mine][first[k : k + SOURCES]]
                yield own, slice(start, end), weights, _Block(matrix, seen, self.links(topic))


def _whole_sources(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns in parts that end with a source."""
    left: list[np.ndarray] | None = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if left is not None:
            columns = [np.concatenate(both) for both in zip(left, columns)]
        if len(columns[0]):
            last = np.searchsorted(columns[0], columns[0][-1])
            yield [c[:last] for c in columns]
            left = [c[last:] for c in columns]
    if left is not None:
        yield left


def dense_sums(
    first: DataFrame, nodes: DataFrame, links: DataFrame, end: str | None, with_betweenness: bool
) -> DataFrame:
    """``key, reached, distance, betweenness, variance``: parts of the sums of all searches.

    ``first`` has the first level as ``source, node, paths, weight``, all rows of a source in one
    partition; ``nodes`` are those with incoming links as ``key, Category``; ``links`` has the
    links among them as ``src, dst``.  Both are few and go to each task.
    """
    core = [c.to_numpy() for c in nodes.select("key", "Category").toArrow().columns]
    core += [c.to_numpy() for c in links.select("src", "dst").toArrow().columns]
    shared = first.sparkSession.sparkContext.broadcast(core)
    types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    names = ["key", "reached", "distance", "betweenness", "variance"]

    def rows(*columns) -> pa.RecordBatch:
        size = len(columns[0])
        arrays = [pa.nulls(size, t) if c is None else pa.array(c, t) for c, t in zip(columns, types)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core = _Core(*shared.value)
        size = len(core.keys)
        reached, distance = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        between, variance = np.zeros(size), np.zeros(size)
        met = np.zeros(size, dtype=bool)
        for columns in _whole_sources(batches):
            for sources, own, weight, block in core.blocks(*columns):
                count, total = block.met(1)
                met[own] |= count > 0
                reached[own] += count
                distance[own] += total
                if end == "source":
                    yield rows(sources, *block.met(0), None, None)
                if with_betweenness:
                    found = block.dependencies(weight)
                    between[own] += found[0]
                    variance[own] += found[1]
        near = (reached[met], distance[met]) if end == "node" else (None, None)
        far = (between[met], variance[met]) if with_betweenness else (None, None)
        if end == "node" or with_betweenness:
            yield rows(core.keys[met], *near, *far)

    ordered = first.select("source", "node", "paths", "weight").sortWithinPartitions("source")
    return ordered.mapInArrow(
        search, "key bigint, reached bigint, distance bigint, betweenness double, variance double"
    )
