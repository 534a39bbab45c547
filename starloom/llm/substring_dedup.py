"""Substring deduplication over word windows, by prefix-partitioned suffix trees.

A window is ``size`` consecutive words. Not every suffix is indexed: each window
picks one anchor inside it (the position whose ``prefix``-word run has the smallest hash), so equal
windows pick equal anchors. Anchors are the suffixes of the trees; the words before them,
back to the first window of the anchor, are their left contexts.

1. Anchors are partitioned by their prefix and counted. A prefix that occurs once
   has no inner node and is left out.
2. The subtree of a prefix is built where its suffixes meet: sorted suffixes with
   the lengths of common prefixes give the node of each suffix at any depth, and the mirrored tree of
   left contexts gives the node on the left. Two windows are equal when
   they lie equally far before their anchors and share both nodes, which together
   are ``size`` words deep. All but the earliest window of such a node pair are repeats.
3. A prefix with more than ``group`` suffixes is dealt over subtrees by salt. Windows that are
   first there are decided by the longest prefix of all, the whole window, of which each
   subtree sends at most one. So no task gets a group that grows with the corpus but by its salts.

Equal texts are one text from the start: the one with the smallest id stands for all, and all windows
of the others are repeats. Words travel as 40-bit hashes; a false repeat needs 20 of them to agree.

Defined results: null text has no words. A window is earlier by smaller id, then by smaller start; a null id counts as the
largest. Rows that repeat id and text are one document and get equal results; windows at
the same start of different texts under one id do not remove each other. Documents with fewer words than a
window keep all. Texts are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.words import extended, grams, pieces, words
from starloom.runtime import cut_lineage

WINDOW, PREFIX = 20, 6
#: Suffixes of a prefix that one subtree takes.
GROUP = 2_000
_LAST = (1 << 63) - 1
_ROWS = 20_000  # suffixes whose subtrees are built in one go


def anchors_of(hashes: np.ndarray, first: np.ndarray, size: int, prefix: int):
    """Row, prefix hash, position, first and last window of each anchor; positions count words within the row."""
    none = np.zeros(0, np.int64)
    n, wide = len(hashes), size - prefix + 1
    if n < size:
        return none, np.zeros(0, np.uint64), none, none, none
    value = grams(hashes, prefix)
    place = np.arange(len(value))
    width = 1
    while width < wide:  # least value and its leftmost place in runs of growing width
        step = min(width, wide - width)
        left = value[:-step] <= value[step:]
        value, place = np.where(left, value[:-step], value[step:]), np.where(left, place[:-step], place[step:])
        width += step
    counts = np.diff(first)
    row = np.repeat(np.arange(len(counts)), counts)[: n - size + 1]
    window = np.arange(n - size + 1)
    inside = window + size <= first[1:][row]
    row, window, place, value = row[inside], window[inside], place[: n - size + 1][inside], value[: n - size + 1][inside]
    if not len(row):
        return none, np.zeros(0, np.uint64), none, none, none
    begins = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])]))
    ends = np.concatenate([begins[1:], [len(row)]]) - 1
    base = first[:-1][row[begins]]
    return row[begins], value[begins], place[begins] - base, window[begins] - base, window[ends] - base


def _ids(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, doc, text); doc is a hash of id and text."""
    ident = F.coalesce(F.col(key).cast("long"), F.lit(_LAST))
    return docs.where(F.col(text).isNotNull()).select(ident.alias("id"), F.xxhash64(ident, text).alias("doc"), F.col(text).alias("text"))


def leaders(texts: DataFrame) -> DataFrame:
    """(doc) of the smallest id of every distinct text."""
    same = [F.xxhash64("text").alias("h"), F.hash("text").alias("g"), F.length("text").alias("n")]
    return texts.select(*same, "id", "doc").groupBy("h", "g", "n").agg(F.min_by("doc", "id").alias("doc")).select("doc")


def anchors(texts: DataFrame, size: int, prefix: int) -> DataFrame:
    """(anchor, doc, place) of all texts. place holds the position and, in 8 bits each, how far before it the first and the last window begin."""

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                w = words(piece.column(2))
                row, value, at, lo, hi = anchors_of(w.hashes, w.first, size, prefix)
                place = at << 16 | (at - lo) << 8 | (at - hi)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), piece.column(1).take(pa.array(row)), pa.array(place)], ["anchor", "doc", "place"])

    return texts.mapInArrow(run, "anchor long, doc long, place long")


def _places(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position, first and last window."""
    at = place >> 16
    return at, at - (place >> 8 & 255), at - (place & 255)


def _contexts(joined: DataFrame, size: int, group: int) -> DataFrame:
    """The suffixes with their words from the first to the end of the last window. joined: id, doc, text, found. salt is -1 but for parts of a hot prefix."""

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                w = words(piece.column(2))
                found = piece.column(3)
                row = np.repeat(np.arange(piece.num_rows), np.diff(np.asarray(found.offsets)))
                anchor, place, n = (np.asarray(x) for x in found.flatten().flatten())
                at, lo, hi = _places(place)
                many = hi + size - lo
                stop = np.cumsum(many)
                flat = np.repeat(w.first[row] + lo - (stop - many), many) + np.arange(stop[-1] if len(stop) else 0)
                packed = np.ascontiguousarray(w.hashes[flat].view(np.uint8).reshape(-1, 8)[:, :5])
                offsets = np.concatenate([[0], stop * 5]).astype(np.int32)
                context = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])
                ids, docs = piece.column(0).take(pa.array(row)), piece.column(1).take(pa.array(row))
                spread = (np.asarray(ids).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + at.astype(np.uint64)) * np.uint64(0xD1342543DE82EF95) >> np.uint64(33)
                salt = np.where(n > group, (spread % (n // group + 1).astype(np.uint64)).astype(np.int64), -1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(salt), ids, docs, pa.array(place), context], ["anchor", "salt", "id", "doc", "place", "context"]
                )

    return joined.mapInArrow(run, "anchor long, salt int, id long, doc long, place long, context binary")


def _nodes(groups: np.ndarray, table: np.ndarray) -> list[np.ndarray]:
    """The node of every row at depths 0, 1, ..: rows of a group share one where their first words agree.

    Sorted rows and the lengths of the prefixes that neighbours share describe the tree.
    """
    order = np.lexsort((*table.T[::-1], groups))
    rows, group = table[order], groups[order]
    same = np.concatenate([[False], group[1:] == group[:-1]])
    shared = np.zeros(len(order), int)
    if table.shape[1]:
        shared[1:] = np.cumprod(rows[1:] == rows[:-1], axis=1).sum(axis=1)
    out = []
    for depth in range(table.shape[1] + 1):
        node = np.empty(len(order), np.int64)
        node[order] = np.cumsum(~(same & (shared >= depth)))
        out.append(node)
    return out


def repeats(groups, ids, at, lo, hi, flat, offset, size: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each group: (suffix, window) of repeats and of first windows. Suffixes of a group come by ascending id and position."""
    n, reach = len(groups), size - prefix
    missing = np.uint64(1 << 41)

    def column(position):
        k = position - lo
        ok = (k >= 0) & (k < hi + size - lo)
        return np.where(ok, flat[np.where(ok, offset + k, 0)], missing)

    right = _nodes(groups, np.stack([column(at + j) for j in range(size)], axis=1))
    left = _nodes(groups, np.stack([column(at - d) for d in range(1, reach + 1)], axis=1))
    out = [[], [], [], []]
    for d in range(reach + 1):
        own = np.flatnonzero((at - d >= lo) & (at - d <= hi))
        if not len(own):
            continue
        _, one, which = np.unique(left[d][own] * (n + 1) + right[size - d][own], return_index=True, return_inverse=True)
        lead = own[one][which]
        again = (ids[own] != ids[lead]) | (at[own] != at[lead])
        for k, part in ((0, own[again]), (2, own[one])):
            out[k].append(part)
            out[k + 1].append(at[part] - d)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)


def _runs(suffix: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix, first and last window of each run of consecutive windows of a suffix."""
    order = np.lexsort((window, suffix))
    suffix, window = suffix[order], window[order]
    if not len(order):
        return suffix, window, window
    begins = np.flatnonzero(np.concatenate([[True], (suffix[1:] != suffix[:-1]) | (window[1:] != window[:-1] + 1)]))
    return suffix[begins], window[begins], window[np.concatenate([begins[1:], [len(order)]]) - 1]


def _subtrees(contexts: DataFrame, size: int, prefix: int) -> DataFrame:
    """(key, open, id, doc, span): runs of repeats by their first and last window, and with open = 1 the first windows of the parts of a hot prefix, keyed by the whole window."""
    order = ["anchor", "salt", "id", "place"]

    def run(batches):
        held: list[pa.RecordBatch] = []

        def build(table: pa.Table):
            col = {k: np.asarray(table.column(k).combine_chunks()) for k in ("anchor", "salt", "id", "doc", "place")}
            hot = col["salt"] >= 0
            joined = table.column("context").combine_chunks()
            raw = np.frombuffer(b"".join(joined.to_pylist()), np.uint8).reshape(-1, 5)
            wide = np.zeros((len(raw), 8), np.uint8)
            wide[:, :5] = raw
            flat = wide.view(np.uint64).ravel()
            at, lo, hi = _places(col["place"])
            many = hi + size - lo
            offset = np.cumsum(many) - many
            change = (col["anchor"][1:] != col["anchor"][:-1]) | (col["salt"][1:] != col["salt"][:-1])
            groups = np.concatenate([[0], np.cumsum(change)])
            again, start, lead, begin = repeats(groups, col["id"], at, lo, hi, flat, offset, size, prefix)
            go = hot[lead]
            lead, begin = lead[go], begin[go]
            key = np.zeros(len(lead), np.uint64)
            for j in range(size):
                key = (key + flat[offset[lead] + begin - lo[lead] + j]) * np.uint64(0xD1342543DE82EF95)
                key ^= key >> np.uint64(29)
            again, start, stop = _runs(again, start)
            rows, starts, stops = np.concatenate([again, lead]), np.concatenate([start, begin]), np.concatenate([stop, begin])
            keys = np.concatenate([col["doc"][again], key.view(np.int64)])
            kind = np.concatenate([np.zeros(len(again), np.int8), np.ones(len(lead), np.int8)])
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(kind), pa.array(col["id"][rows]), pa.array(col["doc"][rows]), pa.array(starts << 32 | stops)], ["key", "open", "id", "doc", "span"])

        count = 0
        for batch in batches:
            for a in range(0, batch.num_rows, _ROWS):
                part = batch.slice(a, _ROWS)
                held.append(part)
                count += part.num_rows
                if count < _ROWS:
                    continue
                table = pa.Table.from_batches(held)
                anchor, salt = (np.asarray(table.column(k).combine_chunks()) for k in ("anchor", "salt"))
                cut = np.flatnonzero((anchor != anchor[-1]) | (salt != salt[-1]))
                if len(cut):  # the last group may go on in the next batch
                    yield build(table.slice(0, int(cut[-1]) + 1))
                    held = table.slice(int(cut[-1]) + 1).to_batches()
                    count = sum(x.num_rows for x in held)
        if count:
            yield build(pa.Table.from_batches(held))

    return contexts.repartition("anchor", "salt").sortWithinPartitions(*order).mapInArrow(run, "key long, open byte, id long, doc long, span long")


def _decide(found: DataFrame) -> DataFrame:
    """(doc, span) of all repeats: of the open windows of a key all but the first."""

    def run(batches):
        last = (None, None, None)
        for batch in batches:
            key, kind, ids, start = (np.asarray(batch.column(k)) for k in ("key", "open", "id", "span"))
            again = kind == 0
            for i in np.flatnonzero(kind == 1):
                k = int(key[i])
                if last[0] == k:
                    again[i] = (last[1], last[2]) != (int(ids[i]), int(start[i]))
                else:
                    last = (k, int(ids[i]), int(start[i]))
            chosen = pa.array(np.flatnonzero(again))
            yield pa.RecordBatch.from_arrays([batch.column(k).take(chosen) for k in ("doc", "span")], ["doc", "span"])

    return found.repartition("key").sortWithinPartitions("key", "open", "id", "span").mapInArrow(run, "doc long, span long")


def repeated_windows(texts: DataFrame, first: DataFrame, size: int, prefix: int, group: int) -> DataFrame:
    """(doc, span) of the runs of windows of the documents in ``first`` whose words also start earlier."""
    found = anchors(texts, size, prefix)
    counts = cut_lineage(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"))
    alive = found.join(counts, "anchor").groupBy("doc").agg(F.collect_list(F.struct("anchor", "place", "n")).alias("found")).join(first, "doc", "left_semi")
    contexts = _contexts(texts.join(alive, "doc").select("id", "doc", "text", "found"), size, group)
    return _decide(_subtrees(contexts, size, prefix))


def remove_repeats(docs: DataFrame, size: int = WINDOW, prefix: int = PREFIX, group: int = GROUP, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key of every row with n_words, n_removed and kept_text, the words left joined by one space. Other columns are not read."""
    new = ("n_words", "n_removed", "kept_text")
    texts = _ids(docs, key, text)
    first = cut_lineage(leaders(texts))
    spans = repeated_windows(texts, first, size, prefix, group).groupBy("doc").agg(F.collect_list("span").alias("spans"))
    # the texts are joined in the form in which the trees read them, so that one exchange of them serves both
    whole = texts.join(spans, "doc", "left").join(first.select("doc", F.lit(True).alias("first")), "doc", "left")

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                n, removed, kept = [], [], []
                for value, found, leads in zip(piece.column(1), piece.column(2), piece.column(3).to_pylist()):
                    parts = value.as_py().encode().split()
                    n.append(len(parts))
                    gone = None
                    if not leads:
                        gone = np.full(len(parts), len(parts) >= size)
                    elif found.is_valid and len(found):
                        edge = np.zeros(len(parts) + 1, np.int64)
                        span = np.asarray(found.values)
                        np.add.at(edge, span >> 32, 1)
                        np.add.at(edge, (span & (1 << 32) - 1) + size, -1)
                        gone = np.cumsum(edge[:-1]) > 0
                    removed.append(0 if gone is None else int(gone.sum()))
                    kept.append(b" ".join(parts if gone is None else [p for p, g in zip(parts, gone.tolist()) if not g]).decode())
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], [key, *new])

    schema = extended(docs.select(F.col(key).cast("long")).schema, "n_words long, n_removed long, kept_text string")
    done = whole.select(F.when(F.col("id") != _LAST, F.col("id")).alias(key), "text", "spans", "first").mapInArrow(run, schema)
    none = docs.where(F.col(text).isNull()).select(F.col(key).cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit("")).toDF(key, *new)
    return done.union(none)
