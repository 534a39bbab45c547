"""The prefix trie of conversations: one row for each distinct sequence of first turns.

A turn travels as a 128-bit hash and its number of code points, never as text. Conversations are dealt to tasks
in ranges of their ids and cut into shards of at most ``SHARD`` conversations (a new shard also begins after
``TURNS`` turns). A shard holds vertical bitmaps: for each (position, turn) the bitset of its
conversations. Depth first, the bitset of a node meets the postings of the next position; every meeting that is
not empty is a child, its popcount the number of members, and what is as long as the node is deep ends there. A shard gives
one row for each of its nodes, so a turn that all conversations share is one row a shard. The rows of a node, told by a
hash of its path, are then added up.

Sums over subtrees need no level by level descent. The smallest member of a node owns it; what a conversation owns is the end of
its path, since every node below an owned one has no smaller member. The values of owned nodes are added from below along
each conversation, and its total is handed to the nodes above, again shard by shard over bitmaps. End lists of a node are
hashed as a stream of the shards' lists in id order.

Defined results: rows without a conversation id are left out. A null role or text counts as empty. Turns are ordered by number, null
first, turns of one number by the MD5 of role and text; repeated rows are turns of their own. A conversation
without turns is a member of the root only. Without conversations there is no row. The turns of one conversation (as hashes)
are sorted and held by one task, whatever their number; everything else is bounded by a shard.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.runtime import cut_lineage

SHARD, TURNS = 4096, 200_000
ROOT = bytes(16)
_PACKED = 16  # end lists of more ids are compressed
_BATCH = 20_000


def ordered_turns(convs: DataFrame) -> DataFrame:
    """(conv_id, pos, turn, chars): the turns of each conversation, numbered from 0; turn is a hash of role and text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    hashed = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)))
    rows = convs.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("_at"), hashed.alias("turn"), F.char_length(text).cast("long").alias("chars"))
    order = Window.partitionBy("conv_id").orderBy(F.col("_at").asc_nulls_first(), "turn")
    return rows.select("conv_id", (F.row_number().over(order) - 1).alias("pos"), "turn", "chars")


def rebuilt(turns: DataFrame, block: int, heads: int) -> DataFrame:
    """Each conversation c with its first turns taken from c - c % block; (conv_id, pos, turn, chars), and a row with pos -1 for each conversation.

    How many, is crc32 of c as text modulo ``heads``: so many of its own first turns go, and as many of the other come,
    if there are so many. ``turns`` must be stored, it is read several times.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    many = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads)).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % block
    lent = turns.where((F.col("conv_id") % block == 0) & (F.col("pos") < heads - 1)).select(F.col("conv_id").alias("base"), "pos", "turn", "chars")
    each = sizes.select("conv_id", base.alias("base"), many.alias("many"))
    borrowed = each.where("many > 0").join(lent, "base").where("pos < many").select("conv_id", "pos", "turn", "chars")
    lengths = sizes.where(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("lent"))
    own = turns.withColumns({"base": base, "many": many}).where("pos >= many").join(lengths, "base", "left")
    at = F.col("pos") - F.col("many") + F.least(F.col("many"), F.coalesce(F.col("lent"), F.lit(0)))
    rest = own.select("conv_id", at.cast("int").alias("pos"), "turn", "chars")
    return borrowed.select("conv_id", F.col("pos").cast("int"), "turn", "chars").union(rest).union(_markers(sizes))


def _markers(convs: DataFrame) -> DataFrame:
    return convs.select("conv_id", F.lit(-1).alias("pos"), F.lit(None).cast("binary").alias("turn"), F.lit(0).cast("long").alias("chars"))


def with_markers(turns: DataFrame) -> DataFrame:
    """``turns`` and a row with pos -1 for each conversation."""
    return turns.select("conv_id", F.col("pos").cast("int"), "turn", "chars").union(_markers(turns.select("conv_id").distinct()))


class Shard:
    """Vertical bitmaps of some conversations, whose ids ascend."""

    def __init__(self, ids: list[int], turns: list[list[bytes]], chars: list[list[int]]):
        self.ids, self.turns, self.chars = ids, turns, chars
        self.postings: list[dict[bytes, int]] = []
        self.ends: dict[int, int] = {}
        for k, own in enumerate(turns):
            bit = 1 << k
            self.ends[len(own)] = self.ends.get(len(own), 0) | bit
            while len(self.postings) < len(own):
                self.postings.append({})
            for at, turn in enumerate(own):
                posting = self.postings[at]
                posting[turn] = posting.get(turn, 0) | bit

    def nodes(self) -> Iterator[tuple]:
        """(node, parent, depth, members, chars) depth first; members is a bitset."""
        if not self.ids:
            return
        stack = [(ROOT, None, 0, (1 << len(self.ids)) - 1, 0)]
        while stack:
            found = stack.pop()
            yield found
            node, _, depth, members, _ = found
            left = members & ~self.ends.get(depth, 0)
            while left:
                first = (left & -left).bit_length() - 1
                turn = self.turns[first][depth]
                child = left & self.postings[depth][turn]
                left ^= child
                stack.append((hashlib.md5(node + turn).digest(), node, depth + 1, child, self.chars[first][depth]))


def places(members: int, n: int) -> np.ndarray:
    """The positions of the set bits, ascending."""
    return np.flatnonzero(np.unpackbits(np.frombuffer(members.to_bytes(-(-n // 8), "little"), np.uint8), bitorder="little"))


def pack_ids(ids: np.ndarray) -> bytes:
    """Ascending ids as bytes, long lists as compressed differences."""
    if len(ids) <= _PACKED:
        return b"\0" + ids.astype("<i8").tobytes()
    return b"\1" + zlib.compress(np.diff(ids.astype("<i8"), prepend=np.int64(0)).tobytes())


def unpack_ids(packed: bytes) -> np.ndarray:
    if packed[:1] == b"\0":
        return np.frombuffer(packed, "<i8", offset=1)
    return np.cumsum(np.frombuffer(zlib.decompress(packed[1:]), "<i8"))


def _shards(batches, extra: list[str], shard: int, turns: int) -> Iterator[tuple[Shard, list[tuple]]]:
    """Shards of rows that come sorted by conversation and position, and the extra columns of each conversation's first row."""
    ids: list[int] = []
    own: list[list[bytes]] = []
    chars: list[list[int]] = []
    more: list[tuple] = []
    held = 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "pos", "turn", "chars", *extra)]
        for conv, pos, turn, n, *rest in zip(*columns):
            if not ids or conv != ids[-1]:
                if len(ids) >= shard or held >= turns:
                    yield Shard(ids, own, chars), more
                    ids, own, chars, more, held = [], [], [], [], 0
                ids.append(conv)
                own.append([])
                chars.append([])
                more.append(tuple(rest))
            if pos >= 0:
                own[-1].append(turn)
                chars[-1].append(n)
                held += 1
    if ids:
        yield Shard(ids, own, chars), more


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == _BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _in_ranges(turns: DataFrame) -> DataFrame:
    return turns.repartitionByRange("conv_id").sortWithinPartitions("conv_id", "pos")


def shard_nodes(turns: DataFrame, shard: int = SHARD, most: int = TURNS) -> DataFrame:
    """The nodes of each shard: (node, parent, depth, conv_id, n_convs, chars, first, ends); first is the shard's smallest id."""
    schema = pa.schema([("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int32()), ("conv_id", pa.int64()), ("n_convs", pa.int64()), ("chars", pa.int64()), ("first", pa.int64()), ("ends", pa.binary())])

    def rows(batches):
        for s, _ in _shards(batches, [], shard, most):
            ids = np.array(s.ids, np.int64)
            for node, parent, depth, members, chars in s.nodes():
                ending = members & s.ends.get(depth, 0)
                ends = pack_ids(ids[places(ending, len(ids))]) if ending else None
                yield node, parent, depth, s.ids[(members & -members).bit_length() - 1], members.bit_count(), chars, s.ids[0], ends

    ddl = "node binary, parent binary, depth int, conv_id long, n_convs long, chars long, first long, ends binary"
    return _in_ranges(turns).mapInArrow(lambda batches: _batches(rows(batches), schema), ddl)


def shard_sums(turns: DataFrame, values: list[str], shard: int = SHARD, most: int = TURNS) -> DataFrame:
    """(node, values): for each node of each shard the sum over its members of what their first row has in ``values``."""
    schema = pa.schema([("node", pa.binary()), *[(v, pa.int64()) for v in values]])

    def rows(batches):
        for s, own in _shards(batches, values, shard, most):
            weights = np.array(own, np.int64)
            for node, _, _, members, _ in s.nodes():
                yield (node, *weights[places(members, len(s.ids))].sum(axis=0).tolist())

    return _in_ranges(turns).mapInArrow(lambda batches: _batches(rows(batches), schema), "node binary, " + ", ".join(f"{v} long" for v in values))


def end_hashes(local: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes at which conversations end; the lists of a node's shards stream by in id order."""
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])

    def rows(batches):
        node, running = None, None
        for batch in batches:
            for own, ends in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
                if own != node:
                    if running is not None:
                        yield node, running.hexdigest()
                    node, running, comma = own, hashlib.sha256(), b""
                running.update(comma + ",".join(map(str, unpack_ids(ends).tolist())).encode())
                comma = b","
        if running is not None:
            yield node, running.hexdigest()

    lists = local.where("ends is not null").select("node", "first", "ends")
    return lists.repartition("node").sortWithinPartitions("node", "first").mapInArrow(lambda batches: _batches(rows(batches), schema), "node binary, ends_sha256 string")


def _with_parents(nodes: DataFrame, total: int) -> DataFrame:
    """``nodes`` with parent_conv_id. Parents of at least a thousandth of all nodes, a thousand at most, are broadcast."""
    parents = nodes.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    large = F.col("n_children") * 1000 >= total
    met = nodes.join(F.broadcast(parents.where(large).drop("n_children")), "parent", "left")
    rest = met.where("parent_conv_id is null").drop("parent_conv_id").join(parents.where(~large).drop("n_children"), "parent", "left")
    return met.where("parent_conv_id is not null").unionByName(rest)


def trie(turns: DataFrame, shard: int = SHARD, most: int = TURNS) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has conv_id, pos from 0 without gaps, turn (binary) and chars, and a row with pos -1 for each conversation (``with_markers``).
    n_leaves counts the childless nodes of the subtree; saved_tokens adds up (n_convs - 1) * chars over it.
    """
    turns = cut_lineage(turns)
    local = cut_lineage(shard_nodes(turns, shard, most))
    merged = local.groupBy("node").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.max("chars").alias("chars")
    )
    merged = cut_lineage(merged)
    children = merged.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = cut_lineage(merged.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))))
    below = Window.partitionBy("conv_id").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    value = {"leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("chars")}
    own = nodes.select("node", *[F.sum(v).over(below).alias(f"own_{name}") for name, v in value.items()])
    tops = nodes.groupBy("conv_id").agg(F.min("depth").alias("top"), *[F.sum(v).alias(name) for name, v in value.items()]).where("top > 0")
    above = turns.join(tops, "conv_id").where(F.col("pos") < F.col("top") - 1).select(*turns.columns, *value)
    handed = shard_sums(cut_lineage(above), list(value), shard, most).groupBy("node").agg(*[F.sum(name).alias(name) for name in value])
    sums = own.join(handed, "node", "left").select("node", *[(F.col(f"own_{name}") + F.coalesce(F.col(name), F.lit(0))).alias(name) for name in value])
    ended = _with_parents(nodes, nodes.count()).join(sums, "node").join(end_hashes(local), "node", "left")
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    return ended.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )


def conversation_trie(convs: DataFrame, **options) -> DataFrame:
    """The trie of ``convs`` (conv_id, turn, role, text) as it stands; see ``trie``. Other columns are not read."""
    return trie(with_markers(cut_lineage(ordered_turns(convs))), **options)
