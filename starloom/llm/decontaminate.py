"""Benchmark decontamination by SimHash of item-sized windows.

Texts and items become lower-case runs of letters and digits. Window lengths form a ladder
(each step ``STEP`` times the last); an item belongs to the longest length that fits into it and
is indexed by the fingerprints of its windows of that length. Every text is covered by windows of each length that
has items, a twelfth of the length apart; sums of bit votes over word pairs give all fingerprints of a text
from one running sum. A 64-bit fingerprint is cut into ``BLOCKS`` blocks: two within
``RADIUS`` differ by at most RADIUS // BLOCKS bits in some block, and the tables list each item
under every block value so near, so all fingerprints within the radius are found.

Fingerprints of edited or cut items may lie farther apart. So each item also lists its heaviest
shingles, as many as weigh more than 1 - ``least`` of it: a stretch that lacks all of them
cannot reach ``least``, so each place of a text that has one is a candidate too, and none is lost.

A candidate is verified exactly: the share of the item's five-word shingles, by weight, that occur in
the stretch of the text where the item would lie. A shingle weighs log(1 + items /
items that have it). From ``least`` on it is a hit.

Benchmark items are read in passes of at most ``ITEMS`` items, which bounds what a task holds.

Defined results: null and empty texts and items hit nothing; an item of fewer than five words is one
shingle, its whole sequence. Repeated item ids are items of their own with one id; a text is reported once for each
id, by its best stretch (the first of equals). Texts of any length are read whole. A text
shorter than a window is one window.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.words import NOT_ALNUM, extended, grams, pieces, words

SHINGLE, LEAST = 5, 0.8
STEP, STRIDE = 1.2, 12
RADIUS, BLOCKS = 11, 4
#: Items that one pass over the texts looks for.
ITEMS = 20_000
_WIDTH = 64 // BLOCKS


@dataclass
class Rung:
    """The items of one window length: fingerprints, and for each block the entries near a block value."""

    length: int
    prints: np.ndarray
    item: np.ndarray
    offset: np.ndarray  # of the window in the item
    starts: list[np.ndarray]  # by block: where a value's entries begin
    entries: list[np.ndarray]


@dataclass
class Anchors:
    """The shingles of which a hit has one at least: ascending, with their item and place in it."""

    shingle: np.ndarray
    item: np.ndarray
    offset: np.ndarray


@dataclass
class Index:
    rungs: list[Rung]
    ids: list
    lengths: np.ndarray
    shingles: list[dict[int, float]]  # weight of each shingle of an item
    anchors: dict[int, Anchors]  # by words in a shingle


def _ladder(shortest: int, longest: int) -> list[int]:
    out = [max(shortest, 1)]
    while out[-1] < longest:
        out.append(max(out[-1] + 1, int(out[-1] * STEP)))
    return out


def _votes(hashes: np.ndarray, wide: int) -> np.ndarray:
    """Running sums of the 64 bit votes of all word pairs; row p has the pairs before p."""
    bits = np.unpackbits(grams(hashes, 2).view(np.uint8).reshape(-1, 8), axis=1)
    kind = np.uint8 if wide < 256 else np.uint32
    sums = np.zeros((len(bits) + 1, 64), kind)
    np.cumsum(bits, axis=0, dtype=kind, out=sums[1:])
    return sums


def prints(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Fingerprints of the words from start to stop; a single word has fingerprint 0."""
    last = np.maximum(stop - 1, start)
    many = sums[last] - sums[start]
    bits = many > ((last - start) // 2).astype(sums.dtype)[:, None]
    return np.packbits(bits, axis=1).view(np.uint64).ravel()


def _windows(n: int, length: int, stride: int) -> np.ndarray:
    """Starts of the windows of a sequence of n; the last one ends with it."""
    if n <= length:
        return np.zeros(1, np.int64)
    return np.unique(np.concatenate([np.arange(0, n - length, stride), [n - length]]))


def _near(width: int, radius: int) -> np.ndarray:
    """All differences of at most ``radius`` bits."""
    return np.array([sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)], np.int64)


def build(ids: list, texts: list[str], least: float = LEAST) -> Index:
    w = words(pa.array(texts, pa.large_string()), NOT_ALNUM, lower=True)
    counts = w.counts
    used = np.flatnonzero(counts > 0)
    sequences = [w.hashes[w.first[k] : w.first[k + 1]] for k in used]
    sets = [set(_shingles(s).tolist()) for s in sequences]
    having: dict[int, int] = {}
    for s in sets:
        for g in s:
            having[g] = having.get(g, 0) + 1
    weights = [{g: float(np.log1p(len(sets) / having[g])) for g in s} for s in sets]
    lengths = counts[used]
    rungs = []
    ladder = _ladder(int(lengths.min()), int(lengths.max())) if len(used) else []
    near = _near(_WIDTH, RADIUS // BLOCKS)
    for k, length in enumerate(ladder):
        top = ladder[k + 1] if k + 1 < len(ladder) else lengths.max() + 1
        own = np.flatnonzero((lengths >= length) & (lengths < top))
        found, item, offset = [], [], []
        for i in own:
            at = _windows(int(lengths[i]), length, max(1, length // STRIDE))
            found.append(prints(_votes(sequences[i], int(length)), at, at + length))
            item.append(np.full(len(at), i))
            offset.append(at)
        if not found:
            continue
        fingerprint = np.concatenate(found)
        starts, entries = [], []
        for b in range(BLOCKS):
            value = ((fingerprint >> np.uint64(b * _WIDTH)) & np.uint64((1 << _WIDTH) - 1)).astype(np.int64)
            around = (value[:, None] ^ near[None, :]).ravel()
            entry = np.repeat(np.arange(len(value), dtype=np.int32), len(near))
            order = np.argsort(around, kind="stable")
            starts.append(np.searchsorted(around[order], np.arange((1 << _WIDTH) + 1)))
            entries.append(entry[order])
        rungs.append(Rung(int(length), fingerprint, np.concatenate(item), np.concatenate(offset), starts, entries))
    return Index(rungs, [ids[k] for k in used], lengths, weights, _anchors(sequences, weights, least))


def _anchors(sequences: list[np.ndarray], weights: list[dict[int, float]], least: float) -> dict[int, Anchors]:
    found: dict[int, list[tuple[int, int, int]]] = {}
    for i, (s, own) in enumerate(zip(sequences, weights)):
        spare, chosen = (1 - least + 1e-9) * sum(own.values()), set()
        for g, v in sorted(own.items(), key=lambda x: (-x[1], x[0])):
            chosen.add(g)
            spare -= v
            if spare < 0:
                break
        found.setdefault(min(SHINGLE, len(s)), []).extend((g, i, k) for k, g in enumerate(_shingles(s).tolist()) if g in chosen)
    out = {}
    for size, rows in found.items():
        rows.sort()
        out[size] = Anchors(np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
    return out


def _shingles(hashes: np.ndarray) -> np.ndarray:
    return grams(hashes, min(SHINGLE, max(len(hashes), 1)))


def _near_entries(found: np.ndarray, rung: Rung) -> tuple[np.ndarray, np.ndarray]:
    """All (window, entry) within the radius."""
    pairs = []
    for b in range(BLOCKS):
        value = ((found >> np.uint64(b * _WIDTH)) & np.uint64((1 << _WIDTH) - 1)).astype(np.int64)
        begin = rung.starts[b][value]
        many = rung.starts[b][value + 1] - begin
        hit = np.flatnonzero(many)
        many, begin = many[hit], begin[hit]
        window = np.repeat(hit, many)
        ends = np.cumsum(many)
        entry = rung.entries[b][np.repeat(begin - (ends - many), many) + np.arange(len(window))]
        close = np.bitwise_count(found[window] ^ rung.prints[entry]) <= RADIUS
        pairs.append(window[close] * len(rung.prints) + entry[close])
    both = np.unique(np.concatenate(pairs))
    return both // len(rung.prints), both % len(rung.prints)


def hits(column: pa.Array, index: Index, least: float) -> list[tuple[int, int, int, int, float]]:
    """(row, item, first word, words, similarity) of the best stretch of each text and item."""
    w = words(column, NOT_ALNUM, lower=True)
    if not index.rungs or len(w.hashes) < 1:
        return []
    sums = _votes(w.hashes, index.rungs[-1].length)
    counts, best = w.counts, {}
    rows = np.flatnonzero(counts)
    done = set()

    def verify(r: int, i: int, start: int, stride: int) -> None:
        """Take the stretch of text r where item i would lie that begins about ``start``."""
        low = max(0, start - stride)
        high = min(int(counts[r]), start + int(index.lengths[i]) + stride)
        if (r, i, low, high) in done:
            return
        done.add((r, i, low, high))
        base = int(w.first[r])
        wanted = index.shingles[i]
        size = min(SHINGLE, int(index.lengths[i]))
        there = set(grams(w.hashes[base + low : base + high], size).tolist())
        # rounded, so that a share of just ``least`` counts however its sum was rounded
        share = round(sum(v for g, v in wanted.items() if g in there) / sum(wanted.values()), 12)
        if share >= least and ((r, i) not in best or (share, -low) > (best[r, i][2], -best[r, i][0])):
            best[r, i] = (low, high - low, share)

    for rung in index.rungs:
        length, stride = rung.length, max(1, rung.length // STRIDE)
        n = counts[rows]
        many = np.where(n <= length, 1, -(-(n - length) // stride) + 1)
        row = np.repeat(rows, many)
        start = (np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)) * stride
        start = np.minimum(start, np.maximum(counts[row] - length, 0))
        first = w.first[row] + start
        window, entry = _near_entries(prints(sums, first, first + np.minimum(length, counts[row])), rung)
        for k, e in zip(window.tolist(), entry.tolist()):
            verify(int(row[k]), int(rung.item[e]), int(start[k]) - int(rung.offset[e]), stride)
    for size, anchors in index.anchors.items():
        there = grams(w.hashes, size)
        begin = np.searchsorted(anchors.shingle, there)
        at = np.flatnonzero(anchors.shingle[np.minimum(begin, len(anchors.shingle) - 1)] == there)
        text = np.searchsorted(w.first, at, side="right") - 1
        inside = at + size <= w.first[text + 1]
        at, text, begin = at[inside], text[inside], begin[at[inside]]
        many = np.searchsorted(anchors.shingle, there[at], side="right") - begin
        ends = np.cumsum(many)
        entry = np.repeat(begin - (ends - many), many) + np.arange(many.sum())
        begins = np.repeat(at - w.first[text], many) - anchors.offset[entry]
        for r, i, start in zip(np.repeat(text, many).tolist(), anchors.item[entry].tolist(), begins.tolist()):
            verify(r, i, start, max(1, int(index.lengths[i]) // STRIDE))
    return [(r, i, *v) for (r, i), v in sorted(best.items())]


def find_leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", items: int = ITEMS) -> DataFrame:
    """(key, item_id, first_word, n_words, similarity): the stretches of texts that hold a benchmark item."""
    known = benchmark.select(F.col(item).alias("item_id"), F.col(item_text).alias("text")).where("text is not null")
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    item_type = known.schema["item_id"].dataType
    schema = extended(T.StructType([T.StructField(key, source.schema["key"].dataType), T.StructField("item_id", item_type)]), "first_word int, n_words int, similarity double")
    passes = max(1, -(-known.count() // items))
    out = None
    for k in range(passes):
        # a hash deals items a little unevenly; half a pass to spare keeps within the bound in practice
        part = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).orderBy("item_id", "text").toPandas()
        found = _pass(source, build(list(part["item_id"]), list(part["text"]), least), least, key, schema)
        out = found if out is None else out.union(found)
    if passes == 1:
        return out
    first = F.struct(-F.col("similarity"), "first_word", "n_words")
    return out.groupBy(key, "item_id").agg(F.min_by(F.struct("first_word", "n_words", "similarity"), first).alias("best")).select(key, "item_id", "best.*")


def _pass(source: DataFrame, index: Index, least: float, key: str, schema: T.StructType) -> DataFrame:
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                best: dict = {}
                for r, i, low, n, share in hits(piece.column(1), index, least):
                    at = (r, index.ids[i])
                    if at not in best or (share, -low) > (best[at][2], -best[at][0]):
                        best[at] = (low, n, share)
                rows = list(best.items())
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0).take(pa.array([a[0] for a, _ in rows], pa.int64())),
                        pa.array([a[1] for a, _ in rows], _arrow(schema[1].dataType)),
                        pa.array([v[0] for _, v in rows], pa.int32()),
                        pa.array([v[1] for _, v in rows], pa.int32()),
                        pa.array([v[2] for _, v in rows], pa.float64()),
                    ],
                    schema.names,
                )

    return source.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    return pa.string() if isinstance(kind, T.StringType) else pa.int32() if isinstance(kind, T.IntegerType) else pa.int64()


def without_leaks(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, found by the whole text, so that a null or repeated key does no harm."""
    marked = docs.withColumn("_mark", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    leaks = find_leaks(marked, benchmark, least, "_mark", text).select("_mark").distinct()
    return marked.join(leaks, "_mark", "left_anti").select(*docs.columns)
