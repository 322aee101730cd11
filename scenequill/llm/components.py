"""Connected components of an edge table by alternating large-star and small-star steps (Kiveris et al., 2014).

Neighbour minima are aggregated with map-side combine, so no adjacency list is ever collected; each round is written to
the shared folder, which cuts the lineage and gives the change test a stable table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import python_ready, stage

EDGES_A_FILE = 100_000


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's edges those that join two nodes it has not connected yet: they connect the same, and of many edges among few
    nodes few are left."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := parent.setdefault(x, x)) != x:
            parent[x] = parent[y]
            x = parent[y]
        return x

    for b in batches:
        keep = []
        for u, v in zip(b.column("u").to_pylist(), b.column("v").to_pylist(), strict=True):
            x, y = top(u), top(v)
            keep.append(x != y)
            parent[max(x, y)] = min(x, y)
        yield b.filter(pa.array(keep, pa.bool_()))


def _large(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``u``, ``v`` (long, any order) to ``node``, ``root``: the smallest node of its component, for every node but the
    roots. Loops and repeated edges do not matter; no edges, no rows."""
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    python_ready(edges.sparkSession)
    seen, e = None, stage(e, "edges")
    e = stage(e.coalesce(1 + e.count() // EDGES_A_FILE).mapInArrow(_thin, "u long, v long"), "forest")
    while True:
        mark = e.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))).alias("h")).first()
        if mark == seen or not mark["n"]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
        # one file for every so many edges, so that rounds on a small table do not write a file for each shuffle partition
        e = stage(_small(_large(e)).coalesce(1 + mark["n"] // EDGES_A_FILE), "stars")
