"""Near duplicates among embeddings by spherical-cap filters.

Filter directions form random product codes: after a random rotation a vector is
cut into blocks, each block has its own set of random code words, and a direction is one code word
from each block. Its inner product is the sum of the blocks' products, so all
directions above the cap height are list-decoded block by block, without
visiting the others. Vectors meet where they share a label and a filter; every pair that meets
is verified by its cosine in double precision. A link counts in its first common
filter only.

A filter's vectors are compared in blocks of bounded size: a filter with more than
``BLOCK`` vectors is dealt over pairs of blocks. Links are counted and contracted where they are
found; only counts and a spanning forest leave the task.

Defined results: vectors that are null, empty, zero or hold a null or non-finite
component, and those with a null label, link with nothing; so do vectors of different length. Each row
is a vector of its own, also when its id repeats; component_id is the smallest id of
the component.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import components, roots
from starloom.runtime import cut_lineage

#: Independent product codes, and filters of each that a vector exceeds on average.
CODES, FILTERS = 3, 8
#: Vectors that share a filter by chance; it sets the caps' height, so that filters stay as full however many vectors there are.
BUCKET = 500
#: Vectors that are compared at once.
BLOCK = 1_000


class ProductCode:
    """Directions [c1, c2] / sqrt(2) with c1 and c2 from two sets of random unit vectors, behind a random rotation."""

    def __init__(self, dim: int, size: int, height: float, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        self.cut = (dim + 1) // 2
        # the inner product of a random unit vector that is as rare as ``height`` standard deviations of a normal one
        self.size, self.height = size, math.sqrt(1 - math.exp(-height * height / max(dim - 1.5, 0.5)))
        self.codes = []
        for width in (self.cut, dim - self.cut):
            code = rng.normal(size=(size, width))
            self.codes.append(code / np.maximum(np.linalg.norm(code, axis=1, keepdims=True), 1e-12) / np.sqrt(2))

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """All filters that each unit vector exceeds, ascending.

        The second block's products are sorted; for each first code word the suffix that still reaches the height is read off.
        A vector that exceeds none takes its best filter.
        """
        turned = unit @ self.rotation
        left, right = turned[:, : self.cut] @ self.codes[0].T, turned[:, self.cut :] @ self.codes[1].T
        order = np.argsort(-right, axis=1)
        out = []
        for x, y, o in zip(left, right, order):
            many = np.searchsorted(-y[o], x - self.height, side="right")
            total = int(many.sum())
            if total:
                first = np.repeat(np.arange(self.size), many)
                rank = np.arange(total) - np.repeat(np.cumsum(many) - many, many)
                out.append(np.sort(first * self.size + o[rank]))
            else:
                out.append(np.array([int(x.argmax()) * self.size + int(y.argmax())]))
        return out


def _units(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Indexes and unit vectors of the rows that can link."""
    index, vectors = [], []
    for i, value in enumerate(column.to_pylist()):
        if value and None not in value:
            v = np.array(value, float)
            norm = np.linalg.norm(v)
            if np.isfinite(v).all() and norm > 0:
                if not np.isfinite(norm):
                    v = v / np.abs(v).max()
                    norm = np.linalg.norm(v)
                index.append(i)
                vectors.append(v / norm)
    return np.array(index, int), vectors


def cap_shape(most: int, filters: int, bucket: int) -> tuple[int, float]:
    """Code words in a block and the height of the caps, for up to ``most`` vectors of a label."""
    share = min(0.05, max(bucket / max(most, 1), 1e-9))
    return max(2, math.ceil(math.sqrt(filters / share))), NormalDist().inv_cdf(1 - share)


def filtered(rows: DataFrame, size: int, height: float, count: int) -> DataFrame:
    """(row, kind, filter, filters, vector): a row for each filter that a vector exceeds. kind is label and length."""
    codes: dict[int, list[ProductCode]] = {}
    single = rows.schema["embedding"].dataType.elementType.typeName() == "float"

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                index, vectors = _units(part.column("embedding"))
                out = {k: [] for k in ("row", "kind", "filter", "filters", "vector")}
                raw = [np.array(v or [], "<f4" if single else "<f8").tobytes() if v and None not in v else b"" for v in part.column("embedding").to_pylist()]
                ids, labels = part.column("row").to_pylist(), part.column("label").to_pylist()
                for dim in {len(v) for v in vectors}:
                    own = [k for k, v in enumerate(vectors) if len(v) == dim]
                    if dim not in codes:
                        codes[dim] = [ProductCode(dim, size, height, seed) for seed in range(count)]
                    unit = np.stack([vectors[k] for k in own])
                    lists = zip(*(code.decode(unit) for code in codes[dim]))
                    for k, found in zip(own, lists):
                        found = np.concatenate([f + c * size * size for c, f in enumerate(found)])
                        n = len(found)
                        out["row"] += [ids[index[k]]] * n
                        out["kind"] += [f"{labels[index[k]]}/{dim}"] * n
                        out["filter"] += found.tolist()
                        out["filters"] += [found.astype("<i4").tobytes()] * n
                        out["vector"] += [raw[index[k]]] * n
                kinds = {"row": pa.int64(), "kind": pa.string(), "filter": pa.int32(), "filters": pa.binary(), "vector": pa.binary()}
                yield pa.RecordBatch.from_arrays([pa.array(out[k], kinds[k]) for k in kinds], list(kinds))

    return rows.mapInArrow(run, "row long, kind string, filter int, filters binary, vector binary")


def dealt(entries: DataFrame, block: int) -> DataFrame:
    """Entries with the group they are compared in: the filter, or a pair of blocks of a filter with many vectors."""
    many = cut_lineage(entries.groupBy("kind", "filter").agg(F.count("*").alias("n")).where(F.col("n") > block))
    side = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (
        entries.join(many, ["kind", "filter"], "left")
        .withColumn("blocks", F.coalesce(F.ceil(F.col("n") * 2 / block).cast("int"), F.lit(1)))
        .withColumn("side", side)
        .withColumn("other", other)
        .withColumn("lo", F.least("side", "other"))
        .withColumn("hi", F.greatest("side", "other"))
        .select("kind", "filter", "lo", "hi", "side", "row", "filters", "vector")
    )


def _compare(group: list, least: float, kind: str):
    """Links of one group: counts by row, and a spanning forest. group: (filter, lo, hi, rows, sides, filters, vectors)."""
    here, lo, hi, row, side, filters, vectors = group
    if len(row) < 2:
        return [], []
    x = np.stack([np.frombuffer(v, kind) for v in vectors]).astype(float)
    size = np.linalg.norm(x, axis=1, keepdims=True)
    if not np.isfinite(size).all():
        x = x / np.abs(x).max(axis=1, keepdims=True)
        size = np.linalg.norm(x, axis=1, keepdims=True)
    x /= size
    side = np.array(side)
    a = np.flatnonzero(side == lo)
    b = np.flatnonzero(side == hi)
    i, j = np.nonzero(x[a] @ x[b].T >= least)
    i, j = a[i], b[j]
    if lo == hi:
        i, j = i[i < j], j[i < j]
    if not len(i):
        return [], []
    # a link belongs to the first filter that both exceed
    width = max(len(f) for f in filters) // 4
    lists = np.full((len(row), width), -1, np.int32)
    for k, f in enumerate(filters):
        f = np.frombuffer(f, "<i4")
        lists[k, : len(f)] = f
    before = [set(lists[k][(lists[k] >= 0) & (lists[k] < here)].tolist()) for k in range(len(row))]
    own = np.array([before[p].isdisjoint(before[q]) for p, q in zip(i.tolist(), j.tolist())], bool)
    i, j = i[own], j[own]
    counts = np.bincount(i, minlength=len(row)) + np.bincount(j, minlength=len(row))
    up = roots([row[k] for k in i.tolist()], [row[k] for k in j.tolist()])
    return [(row[k], int(c)) for k, c in enumerate(counts) if c], [(r, n) for n, r in up.items() if r != n]


def links(groups: DataFrame, least: float, kind: str) -> DataFrame:
    """(a, b, n): a's number of links in a group where b is null, else an edge of a group's spanning forest."""
    keys = ["kind", "filter", "lo", "hi"]

    def run(batches):
        key, group = None, None

        def flush():
            counts, forest = _compare(group, least, kind)
            rows = [(a, None, n) for a, n in counts] + [(a, b, None) for a, b in forest]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], ["a", "b", "n"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*keys, "row", "side", "filters", "vector")]
            for *at, row, side, filters, vector in zip(*columns):
                if at != key:
                    if group:
                        yield flush()
                    key, group = at, [at[1], at[2], at[3], [], [], [], []]
                for k, value in enumerate((row, side, filters, vector)):
                    group[3 + k].append(value)
        if group:
            yield flush()

    return groups.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long, n long")


def deduplicate(vectors: DataFrame, least: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label", codes: int = CODES, filters: int = FILTERS, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """One row per row of ``vectors``: the key, n_links, component_id and kept."""
    rows = cut_lineage(vectors.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(vector).alias("embedding"), F.col(label).alias("label")))
    able = rows.where("label is not null and embedding is not null").select("row", "embedding", "label")
    most = able.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    entries = cut_lineage(filtered(able, *cap_shape(most, filters, bucket), codes))
    single = rows.schema["embedding"].dataType.elementType.typeName() == "float"
    found = cut_lineage(links(dealt(entries, block), least, "<f4" if single else "<f8"))
    counts = found.where("b is null").groupBy(F.col("a").alias("row")).agg(F.sum("n").alias("n_links"))
    member = cut_lineage(components(found.where("b is not null").select("a", "b")))
    known = rows.select("row", "key").join(member, F.col("row") == F.col("node"), "left").withColumn("component", F.coalesce("component", "row"))
    smallest = cut_lineage(known.where("node is not null").groupBy("component").agg(F.min("key").alias("component_id")))
    return (
        known.join(smallest, "component", "left").join(counts, "row", "left")
        .withColumn("component_id", F.coalesce("component_id", "key").cast("long"))
        .select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", (F.col("key") == F.col("component_id")).alias("kept"))
    )
