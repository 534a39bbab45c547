"""Token ids in packed binary rows, by best-fit decreasing.

Texts are encoded, an end mark is put after each, and what is longer than a row
is split into consecutive segments without loss. Each task packs the segments of
its own input, a pool of at most ``pool_tokens`` at a time: longest first, each into the
open row with the least room that suffices, found by descending a segment tree
over free capacities. Nothing is shuffled; rows are numbered within the task's shard.

A packed row holds ``input_ids`` (little-endian unsigned 16 bit, 32 where the
vocabulary needs it, filled up with the end mark), ``position_ids`` in the same
layout (restarting at 0 in each segment), ``cu_seqlens`` (0 and the end of each
segment), and for each segment the document and its first token's place there.

Defined results: null and empty texts have no segment. Repeated rows are packed
as often as they occur; equal lengths are packed in input order. Other columns
are ignored. A run of over ``LONGEST_RUN`` characters all of which are white space, or none, is
encoded in pieces of that size, which keeps the bytes and bounds the encoder's time and stack.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from starloom.llm.words import pieces

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the split pattern that belongs to this vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONGEST_RUN = 4_096
#: Fixed value: white space of the split pattern, which does not count the separators 1C to 1F.
_BLANK, _SOLID = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]"
#: A match starts where a run starts, so a text is scanned once.
_LONG = re.compile("|".join(rf"(?<!{c}){c}{{{LONGEST_RUN + 1},}}" for c in (_BLANK, _SOLID)))
_encoders: dict[int, tiktoken.Encoding] = {}

SCHEMA = (
    "shard int, row long, n_tokens int, n_segments int, doc_ids array<long>, doc_offsets array<long>,"
    " cu_seqlens array<int>, input_ids binary, position_ids binary"
)


def encoder(vocabulary: bytes) -> tiktoken.Encoding:
    """The encoder of a file of ranks; built once in each worker."""
    key = hash(vocabulary)
    if key not in _encoders:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
        _encoders[key] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[key]


def encode(text: str, enc: tiktoken.Encoding) -> np.ndarray:
    if not _LONG.search(text):
        return enc.encode_to_numpy(text, disallowed_special=())
    parts, done = [], 0
    for m in _LONG.finditer(text):
        cuts = range(m.start(), m.end(), LONGEST_RUN)
        parts.append(text[done : m.start()])
        parts += [text[i : i + LONGEST_RUN] for i in cuts[:-1]]
        # the rest of a run stays with what follows, as a blank belongs to the word behind it
        done = cuts[-1]
    parts.append(text[done:])
    return np.concatenate([enc.encode_to_numpy(p, disallowed_special=()) for p in parts if p])


class Capacities:
    """Open rows by free capacity; the least capacity from a given one on is found in log(size) steps."""

    def __init__(self, size: int):
        self.leaf = 1 << size.bit_length()
        self.any = [False] * (2 * self.leaf)
        self.rows: list[list[int]] = [[] for _ in range(self.leaf)]

    def add(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        i = capacity + self.leaf
        while i and not self.any[i]:
            self.any[i] = True
            i >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Removes a row with the smallest capacity that is at least ``least``."""
        i = least + self.leaf
        if not self.any[i]:
            while i > 1 and (i & 1 or not self.any[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaf:
                i = 2 * i if self.any[2 * i] else 2 * i + 1
        capacity = i - self.leaf
        row = self.rows[capacity].pop()
        if not self.rows[capacity]:
            while i and not (self.any[2 * i] or self.any[2 * i + 1] if i < self.leaf else False):
                self.any[i] = False
                i >>= 1
        return capacity, row


def best_fit_decreasing(lengths: np.ndarray, size: int) -> list[list[int]]:
    """The indexes of the lengths in each row of ``size``. Every length is from 1 to ``size``."""
    free, rows = Capacities(size), []
    for k in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[k])
        found = free.take(n)
        if found is None:
            rows.append([k])
            left, at = size - n, len(rows) - 1
        else:
            left, at = found[0] - n, found[1]
            rows[at].append(k)
        if left:
            free.add(left, at)
    return rows


def _pack(segments: list[tuple[int | None, int, np.ndarray]], size: int, end: int, kind: str, shard: int, first: int) -> pa.RecordBatch:
    rows = best_fit_decreasing(np.array([len(s[2]) for s in segments]), size)
    ids = np.full((len(rows), size), end, kind)
    positions = np.zeros((len(rows), size), kind)
    ramp, cuts = np.arange(size).astype(kind), []
    for i, row in enumerate(rows):
        at = 0
        cuts.append([0])
        for k in row:
            n = len(segments[k][2])
            ids[i, at : at + n] = segments[k][2]
            positions[i, at : at + n] = ramp[:n]
            at += n
            cuts[-1].append(at)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(rows), shard, np.int32)),
            pa.array(np.arange(first, first + len(rows))),
            pa.array([c[-1] for c in cuts], pa.int32()),
            pa.array([len(r) for r in rows], pa.int32()),
            pa.array([[segments[k][0] for k in r] for r in rows], pa.list_(pa.int64())),
            pa.array([[segments[k][1] for k in r] for r in rows], pa.list_(pa.int64())),
            pa.array(cuts, pa.list_(pa.int32())),
            pa.array([x.tobytes() for x in ids], pa.binary()),
            pa.array([x.tobytes() for x in positions], pa.binary()),
        ],
        ["shard", "row", "n_tokens", "n_segments", "doc_ids", "doc_offsets", "cu_seqlens", "input_ids", "position_ids"],
    )


def pack(
    docs: DataFrame, vocabulary: str = VOCABULARY, row_tokens: int = 2_048, end_token: int = 50_256, pool_tokens: int = 2_000_000, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Packed rows of all texts. The vocabulary file is read where this is called and travels with the tasks."""
    with open(vocabulary, "rb") as file:
        ranks = file.read()
    wide = max(end_token, len(ranks.splitlines()), row_tokens) >= 1 << 16
    kind = "<u4" if wide else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, context = encoder(ranks), TaskContext.get()
        shard = context.partitionId() if context else 0
        pool, tokens, done = [], 0, 0
        for batch in batches:
            for piece in pieces(batch, "text"):
                for key_value, value in zip(piece.column(0).to_pylist(), piece.column(1)):
                    value = value.as_py()
                    if not value:
                        continue
                    ids = np.append(encode(value, enc), end_token).astype(kind)
                    pool += [(key_value, a, ids[a : a + row_tokens]) for a in range(0, len(ids), row_tokens)]
                    tokens += len(ids)
                    if tokens >= pool_tokens:
                        out = _pack(pool, row_tokens, end_token, kind, shard, done)
                        pool, tokens, done = [], 0, done + out.num_rows
                        yield out
        if pool:
            yield _pack(pool, row_tokens, end_token, kind, shard, done)

    return docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text")).mapInArrow(run, SCHEMA)


def write(packed: DataFrame, path: str) -> None:
    """The packed rows as Parquet, one folder for each shard's rows in order."""
    packed.sortWithinPartitions("shard", "row").write.mode("overwrite").parquet(path)
