"""Connected components of a graph of integer ids, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillscope.llm.scratch import Scratch
from skillscope.llm.shipping import ship

CHUNK = 200_000  # edges that a task contracts at a time


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of each chunk as stars around its smallest ids, which keeps what is connected."""
    def stars(pairs: list[tuple[list, list]]) -> pa.RecordBatch:
        up: dict[int, int] = {}

        def root(x: int) -> int:
            up.setdefault(x, x)
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        for left, right in pairs:
            for a, b in zip(left, right, strict=True):
                low, high = sorted((root(a), root(b)))
                up[high] = low
        ends = [(x, root(x)) for x in up]
        ends = [e for e in ends if e[0] != e[1]]
        return pa.RecordBatch.from_arrays(
            [pa.array([e[i] for e in ends], pa.int64()) for i in (0, 1)], ["a", "b"])

    held, n = [], 0
    for batch in batches:
        held.append((batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        n += len(batch)
        if n >= CHUNK:
            yield stars(held)
            held, n = [], 0
    if held:
        yield stars(held)


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _fingerprint(edges: DataFrame) -> tuple:
    """Number of edges and an order-free sum of their hashes."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(scratch: Scratch, edges: DataFrame, label: str) -> DataFrame:
    """(id, component) of every id in ``edges`` (a, b): the smallest id that it reaches.

    Each step hangs neighbours below smaller ones and keeps the number of edges; minima are combined
    before the shuffle, so no neighbourhood is held in memory. Chunks of at most ``CHUNK`` edges are
    contracted first, without a shuffle. It ends when a step changes nothing or all edges that are
    left make one chunk.
    """
    ship()
    schema = "a long, b long"
    edges = edges.where("a <> b").select("a", "b")
    edges, step = scratch.keep(edges.mapInArrow(_contracted, schema), f"{label}-0"), 0
    before = None
    while True:
        now = _fingerprint(edges)
        if now[0] <= CHUNK:  # one chunk holds all edges, so contracting it is all there is to do
            edges = scratch.keep(edges.coalesce(1).mapInArrow(_contracted, schema), f"{label}-all")
            break
        if now == before:
            break
        before = now
        # Large star: every neighbour above u moves to the smallest neighbour of u (or u).
        both = _both(edges)
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        # Small star: u and every neighbour below it move to the smallest of them.
        lower = moved.where("a > b")
        least = lower.groupBy("a").agg(F.min("b").alias("m"))
        joined = lower.join(least, "a")
        hung = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            joined.select("a", F.col("m").alias("b"))).where("a > b").distinct()
        step += 1
        edges = scratch.keep(hung, f"{label}-{step}")
        scratch.drop(f"{label}-{step - 1}")
    stars = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.unionAll(edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
