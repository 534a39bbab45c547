"""Connected components of links that live in Spark, by alternating large and small stars.

Links are first contracted by union-find inside each task (bounded groups of
rows); a round then hangs every node's larger neighbours on the smallest one it sees.
Each round is a written table, so the plan stays short and a lost executor costs one
round at most. Nothing but two numbers for each round comes to the driver.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.runtime import cut_lineage

_GROUP = 200_000  # links that a task contracts at a time


def roots(a: list, b: list) -> dict:
    """The smallest node of each node's component, by union-find with path halving."""
    up: dict = {}

    def find(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for x, y in zip(a, b):
        x, y = find(x), find(y)
        if x != y:
            up[max(x, y)] = min(x, y)
    return {x: find(x) for x in up}


def contract(links: DataFrame) -> DataFrame:
    """Links (a, b) with the same components: in each group of rows, every node hangs on its smallest."""

    def run(batches):
        a, b = [], []

        def flush():
            root = roots(a, b)
            pairs = [(r, x) for x, r in root.items() if r != x]
            a.clear()
            b.clear()
            return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"])

        for batch in batches:
            for start in range(0, batch.num_rows, _GROUP):
                part = batch.slice(start, _GROUP)
                a += part.column(0).to_pylist()
                b += part.column(1).to_pylist()
                if len(a) >= _GROUP:
                    yield flush()
        if a:
            yield flush()

    return links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").mapInArrow(run, "a long, b long")


def _star(links: DataFrame) -> DataFrame:
    """One large star and one small star; links are (smaller, larger)."""
    both = links.union(links.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
    low = large.groupBy("b").agg(F.min("a").alias("m"))
    met = large.join(low, "b")
    return met.where("a <> m").select("m", "a").toDF("a", "b").union(met.select(F.col("m").alias("a"), "b")).distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node that has a link; component is the smallest node reachable.

    ``links`` has long columns a and b in any direction; nulls must not occur.
    """
    current = cut_lineage(contract(links).distinct())
    state = _state(current)
    while state[0]:
        following = cut_lineage(_star(current))
        new = _state(following)
        if new == state:
            break
        current, state = following, new
    return current.select(F.col("b").alias("node"), F.col("a").alias("component")).union(current.select("a", "a").distinct())
