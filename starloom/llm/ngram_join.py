"""Jaccard self-join on word n-grams by token-combination prefixes.

A text's set holds its distinct ``size``-word shingles (a shorter text is one
shingle). Tokens are ordered by frequency class, rare ones first; within a class by hash. A set
indexes a prefix of this order: single tokens of the rare class, combinations of k
tokens of a frequent class, formed inside hashed subclasses. The prefix is extended until it
holds one token more than can be missing from a partner plus what may stay without a
combination (one rare token, k - 1 tokens of each subclass). Of two linked
sets, the prefix that ends first then has two rare tokens or one combination in both.
The number of subclasses follows the size of the larger set, so a set whose
partners may lie in two size bands indexes combinations for both.

Equal sets are one class from the start: a 64-bit fingerprint of the set takes
their place, so groups of copies meet nowhere. Two sets whose prefixes are all rare must share as many
rare tokens as their sizes demand, others two; such pairs, and pairs that meet in a small combination, are verified
with their neighbours. The members of combinations with many sets, and of rare tokens that turn out common, are put in
blocks; pairs of blocks that share a signature are verified as a matrix product, so no
pair within such a group is ever a row. A set enters a pair of blocks only if it has as many crowded tokens as a link would take;
pairs with a token outside the crowd are counted with what the crowd may add. Before any text moves, the sets of a pair of blocks
show sketches, counts of tokens over hash buckets, which bound what two sets share; only sets with a possible partner are
verified. Verified links are contracted to components.

Frequent tokens are those that a share of all texts has (and at least ``FLOOR``
texts); counts come from all texts, chunk by chunk, copies in a chunk once, leaving out what a chunk has
once or twice. The list holds at most (tokens per text) / share entries. It
only steers the order: any list gives the same links.

Defined results: a text that is null or without words has an empty set, links with nothing and is its own
component. Rows with the same id and different texts are texts of their own, and
share the id as a label. A null id is the largest. Texts of any length are read whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.components import components, roots
from starloom.llm.words import Words, grams, mix, pieces, words
from starloom.runtime import cut_lineage, tidy_shuffles

SIZE, PERCENT = 5, 80
#: (share of the texts, tokens in a combination), ascending; what is rarer than the first is rare.
CLASSES = ((0.0005, 2), (0.05, 3))
FLOOR = 64
#: A rare token's texts up to this number are compared pair by pair.
SMALL = 64
#: One token in so many lengthens an all-rare prefix. Without it a set may share two tokens only with one of 0.8 of its size, so few crowded
#: tokens, which texts share by chance, the more texts there are, would bring it into blocks.
SPARE = 64
#: Sets in a block.
BLOCK = 200
SALTS = 32
#: Shingles that are counted together before the rare ones of them are left out.
_CHUNK = 4_000_000
#: Keys up to this number (16 MB) go to all tasks to pick rows before a shuffle; with more, the rows are shuffled once.
SENT_KEYS = 2_000_000
_LAST = (1 << 63) - 1
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(w: Words, size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of every row."""
    runs = grams(w.hashes, size)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(runs[a : b - size + 1]))
        else:
            out.append(grams(w.hashes[a:b], b - a) ^ np.uint64(b - a) if b > a else np.zeros(0, np.uint64))
    return out


def fingerprint(tokens: np.ndarray) -> int:
    """A hash of a set, as a signed 64-bit number."""
    total = mix(tokens).sum(dtype=np.uint64) + np.array([len(tokens)], np.uint64) * _ODD
    return int(mix(total).view(np.int64)[0])


def _missing(n: int, percent: int) -> int:
    """Tokens of a set of ``n`` that a linked partner may lack."""
    return n - -(-percent * n // 100)


def _prefix(n: int, percent: int) -> int:
    """Tokens that a set of ``n`` indexes where they are all rare: those a partner may lack, two more, and one of ``SPARE`` for sets of any size to share."""
    return _missing(n, percent) + 2 + n // SPARE


def bands(n: int, percent: int) -> list[int]:
    """The size bands (powers of two) in which the larger of a linked pair may lie."""
    return sorted({n.bit_length() - 1, (100 * n // percent).bit_length() - 1})


def signatures(tokens: np.ndarray, classes: np.ndarray, sizes: tuple[int, ...], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rare tokens and combinations that a set indexes. classes: 0 for rare, else 1 + the index in ``sizes``."""
    n = len(tokens)
    if n < 4 and percent >= 80:
        return tokens[:0], tokens[:0]  # only equal sets reach 80 % at this size
    rank = mix(tokens * _ODD)
    order = np.lexsort((rank, classes))
    tokens, classes, rank = tokens[order], classes[order], rank[order]
    need = _missing(n, percent) + 1
    rare = int((classes == 0).sum())
    longest, combos = 0, []
    if rare >= _prefix(n, percent):
        return tokens[: _prefix(n, percent)], tokens[:0]
    for band in bands(n, percent):
        # a small band has room for one class of pairs only
        kinds = np.minimum(classes[rare:], 1) if band < 5 else classes[rare:]
        used = sizes[:1] if band < 5 else sizes
        many = [max(1, int(0.4 / len(used) * 2**band / (k - 1))) for k in used]
        length, held = rare, rare - min(rare, 1)
        parts: dict[tuple[int, int], list[int]] = {}
        for i in range(rare, n):
            if held >= need:
                break
            kind = int(kinds[i - rare])
            part = parts.setdefault((kind, int(rank[i] % np.uint64(many[kind - 1]))), [])
            part.append(i)
            held += len(part) >= used[kind - 1]
            length += 1
        longest = max(longest, min(length, rare))
        for (kind, part), own in parts.items():
            k = used[kind - 1]
            if len(own) >= k:
                combos.append(_combinations(tokens[own], k, np.uint64(band * 8 + kind)))
    return tokens[:longest], np.concatenate(combos) if combos else tokens[:0]


#: The largest count of a bucket that a sketch tells; it stands for itself and all above.
_FULL = 15


def sketch(tokens: np.ndarray) -> bytes:
    """How many tokens fall into each of n/4 to n/2 hash buckets, two counts a byte."""
    many = max(2, 1 << max(0, len(tokens).bit_length() - 2))
    at = (mix(tokens) >> np.uint64(32)) & np.uint64(many - 1)
    count = np.minimum(np.bincount(at.astype(np.int64), minlength=many), _FULL).astype(np.uint8)
    return (count[0::2] | count[1::2] << np.uint8(4)).tobytes()


def _unpacked(sketches: list[bytes], many: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of sketches of one length over ``many`` buckets, and where they may be larger."""
    packed = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)
    count = np.stack([packed & np.uint8(15), packed >> np.uint8(4)], axis=2).reshape(len(sketches), -1, many)
    return count.sum(axis=1, dtype=np.uint16), (count == _FULL).any(axis=1)


def at_most_common(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """An upper bound of the tokens that each set of x has in common with each of y: the smaller count of every bucket.

    The sketches of a side have one length. The longer ones are folded to the buckets of the shorter.
    """
    many = 2 * min(len(x[0]), len(y[0]))
    (p, full_p), (q, full_q) = _unpacked(x, many), _unpacked(y, many)
    bound = np.zeros((len(x), len(y)))
    for start in range(0, many, 4_096):
        part = slice(start, start + 4_096)
        bound += np.float64(1 << 40) * (full_p[:, part].astype(np.float32) @ full_q[:, part].T.astype(np.float32))
        highest = max(int(p[:, part][~full_p[:, part]].max(initial=0)), int(q[:, part][~full_q[:, part]].max(initial=0)))
        for least in range(1, highest + 1):
            left, right = (p[:, part] >= least) | full_p[:, part], (q[:, part] >= least) | full_q[:, part]
            met = left.any(axis=0) & right.any(axis=0)
            bound += left[:, met].astype(np.float32) @ right[:, met].T.astype(np.float32)
    return bound


def _classes(tokens: np.ndarray, known: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(tokens), int)
    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
    return np.where(known[at] == tokens, kinds[at], 0)


def _combinations(tokens: np.ndarray, k: int, seed: np.uint64) -> np.ndarray:
    """A hash of each k-combination; tokens come in the global order."""
    value, last = mix(tokens + np.array([seed]) * _ODD), np.arange(len(tokens))
    for _ in range(k - 1):
        many = len(tokens) - 1 - last
        keep = np.repeat(np.arange(len(value)), many)
        following = np.arange(len(keep)) - np.repeat(np.cumsum(many) - many, many) + last[keep] + 1
        value, last = mix(value[keep] * _ODD + tokens[following]), following
    return value


def survey(docs: DataFrame, size: int, share: float) -> DataFrame:
    """One scan for (id, mark, n, fp) of every text and (token, count) of tokens that a chunk of texts has often."""

    def counted(found):
        token, count = np.unique(np.concatenate(found), return_counts=True)
        often = count >= max(3, share * len(found) / 4)
        token, count = token[often].view(np.int64), count[often].astype(np.int64)
        none = pa.nulls(len(token), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none, none, pa.array(token), pa.array(count)], ["id", "mark", "n", "fp", "token", "count"])

    def run(batches):
        found, held = {}, 0  # different sets since the last count, by fingerprint
        for batch in batches:
            for piece in pieces(batch, "text"):
                sets = shingle_sets(words(piece.column(1), lower=True), size)
                fps = [fingerprint(s) for s in sets]
                n = pa.array([len(s) for s in sets], pa.int64())
                none = pa.nulls(len(sets), pa.int64())
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(2), n, pa.array(fps, pa.int64()), none, none], ["id", "mark", "n", "fp", "token", "count"])
                for own, s in zip(fps, sets):
                    if own not in found:
                        found[own] = s
                        held += len(s)
                if held >= _CHUNK:
                    yield counted(list(found.values()))
                    found, held = {}, 0
        if found:
            yield counted(list(found.values()))

    return docs.mapInArrow(run, "id long, mark long, n long, fp long, token long, count long")


def frequent(found: DataFrame, classes, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent tokens, ascending, and their classes."""
    texts = found.where("token is null").count()
    least = max(floor, classes[0][0] * texts)
    rows = found.where("token is not null").groupBy("token").agg(F.sum("count").alias("n")).where(F.col("n") >= least).toPandas()
    token = rows["token"].to_numpy(np.int64).view(np.uint64)
    cuts = [max(floor, share * texts) for share, _ in classes]
    order = np.argsort(token)
    return token[order], np.searchsorted(cuts, rows["n"].to_numpy()[order], side="right")


def index(docs: DataFrame, size: int, percent: int, tokens: np.ndarray, kinds: np.ndarray, ks: tuple[int, ...]) -> DataFrame:
    """(sig, salt, fp, n, combined): the signatures of every text; copies in a batch are indexed once. n is negative where the prefix is not all rare. 48 bits of a signature travel: where two fall together, sets meet once more."""

    def run(batches):
        for batch in batches:
            seen: set[int] = set()
            for piece in pieces(batch, "text"):
                sig, fp, n, combined = [], [], [], []
                for s in shingle_sets(words(piece.column(1), lower=True), size):
                    own = fingerprint(s)
                    if not len(s) or own in seen:
                        continue
                    seen.add(own)
                    found = signatures(s, _classes(s, tokens, kinds), ks, percent)
                    rare = len(found[0]) == _prefix(len(s), percent) and not len(found[1])
                    for part, kind in zip(found, (False, True)):
                        sig.append(part)
                        fp.append(np.full(len(part), own))
                        n.append(np.full(len(part), len(s) if rare else -len(s), np.int32))
                        combined.append(np.full(len(part), kind))
                if sig:
                    fps, kind = np.concatenate(fp), np.concatenate(combined)
                    salt = np.where(kind, fps % SALTS, 0).astype(np.int8)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((np.concatenate(sig) >> np.uint64(16)).view(np.int64)), pa.array(salt), pa.array(fps), pa.array(np.concatenate(n)), pa.array(kind)],
                        ["sig", "salt", "fp", "n", "combined"],
                    )

    return docs.mapInArrow(run, "sig long, salt byte, fp long, n int, combined boolean")


def candidates(indexed: DataFrame, percent: int, small: int) -> DataFrame:
    """(sig, a, b, n): two sets that meet at a rare token, n being how often they must; or with b null a member, of size n (negative as in ``index``), of a combination or of a token with over ``small`` sets."""

    def run(batches):
        held = None  # the last signature's rows so far, and whether they have been seen to be many
        for batch in batches:
            sig, fp, n, combined = (np.asarray(batch.column(k)) for k in ("sig", "fp", "n", "combined"))
            many_before = False
            if held is not None:
                many_before = held[4] and len(sig) > 0 and held[0][-1] == sig[0]
                sig, fp, n, combined = (np.concatenate([h, x]) for h, x in zip(held[:4], (sig, fp, n, combined)))
            fresh = np.ones(len(sig), bool)
            fresh[1:] = (sig[1:] != sig[:-1]) | (fp[1:] != fp[:-1])
            sig, fp, n, combined = sig[fresh], fp[fresh], n[fresh], combined[fresh]
            if not len(sig):
                continue
            before = np.flatnonzero(sig != sig[-1])
            last = int(before[-1]) + 1 if len(before) else 0
            tail = len(sig) - last
            if tail > small or (many_before and last == 0):
                yield _members(sig[last:], fp[last:], n[last:])
                held = (sig[-1:], fp[-1:], n[-1:], combined[-1:], True)  # its last row stays, to tell a repeat
            else:
                held = (sig[last:], fp[last:], n[last:], combined[last:], False)
            yield from _meet(sig[:last], fp[:last], n[:last], combined[:last], percent, small, many_before)
        if held is not None and not held[4]:
            yield from _meet(*held[:4], percent, small, False)

    return indexed.repartition("sig", "salt").sortWithinPartitions("sig", "salt", F.xxhash64("fp"), "fp").mapInArrow(run, "sig long, a long, b long, n long")


def _members(sig, fp, n):
    return pa.RecordBatch.from_arrays([pa.array(sig), pa.array(fp), pa.nulls(len(sig), pa.int64()), pa.array(n.astype(np.int64))], ["sig", "a", "b", "n"])


def least_shared(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Rare tokens that the prefixes of two linked sets of these sizes have in common; 2 where a size is negative.

    Of the tokens in both sets no more than a set has behind its prefix can lie there. Crowded tokens, with over ``SMALL`` sets, are among them.
    """
    x, y = np.abs(n).astype(np.int64), np.abs(m).astype(np.int64)
    both = -(-percent * (x + y) // (100 + percent))
    behind = [-(-percent * z // 100) - 2 - z // SPARE for z in (x, y)]
    return np.where((n > 0) & (m > 0), np.maximum(2, both - np.maximum(*behind)), 2)


def _meet(sig, fp, n, combined, percent, small, first_is_many):
    if not len(sig):
        return
    begins = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    size = np.diff(np.concatenate([begins, [len(sig)]]))
    many = (size > small) | combined[begins]
    many[0] |= first_is_many
    many, size = np.repeat(many, size), np.repeat(size, size)
    if many.any():
        yield _members(sig[many], fp[many], n[many])
    few = np.flatnonzero(~many & (size > 1))
    sig, fp, n = sig[few], fp[few], n[few].astype(np.int64)
    for lag in range(1, min(small, int(size[few].max()) if len(few) else 0)):
        i = np.flatnonzero(sig[lag:] == sig[:-lag])
        if not len(i):
            break
        j = i + lag
        x, y = np.abs(n[i]), np.abs(n[j])
        near = 100 * np.minimum(x, y) >= percent * np.maximum(x, y)
        i, j = i[near], j[near]
        pair = [np.minimum(fp[i], fp[j]), np.maximum(fp[i], fp[j]), least_shared(n[i], n[j], percent)]
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(i), np.int64)), *(pa.array(p) for p in pair)], ["sig", "a", "b", "n"])


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _sets(column, size: int) -> list[np.ndarray]:
    return shingle_sets(words(column, lower=True), size)


def pair_rows(pairs: DataFrame, block: int) -> DataFrame:
    """(block, other, side, fp): the sets of pairs (a, b), put together so that a set travels once for its neighbours.

    A set's home is the smallest fingerprint among itself and its partners; the sets of a home are dealt over blocks.
    """
    both = pairs.union(pairs.select("b", "a")).toDF("fp", "partner")
    home = cut_lineage(both.groupBy("fp").agg(F.least(F.min("partner"), F.col("fp")).alias("home")))
    counts = home.groupBy("home").agg(F.ceil(F.count("*") / block).alias("parts"))
    number = F.xxhash64(F.lit(3), "home", F.pmod(F.xxhash64("fp"), F.col("parts")))
    blocks = cut_lineage(home.join(counts, "home").select("fp", number.alias("block")))
    placed = pairs.join(blocks.toDF("a", "of_a"), "a").join(blocks.toDF("b", "of_b"), "b")
    low, high = F.least("of_a", "of_b"), F.greatest("of_a", "of_b")
    rows = [placed.select(low.alias("block"), high.alias("other"), (F.col(own) > low).cast("int").alias("side"), F.col(x).alias("fp")) for x, own in (("a", "of_a"), ("b", "of_b"))]
    return rows[0].union(rows[1]).distinct()


def _common(tokens: list[np.ndarray], a: list[int], b: list[int]) -> np.ndarray:
    """How many tokens each of a's sets has in common with each of b's, as a matrix product over the tokens of both sides."""
    shared = np.intersect1d(np.concatenate([tokens[k] for k in a]), np.concatenate([tokens[k] for k in b]))
    both = np.zeros((len(a), len(b)))
    for start in range(0, len(shared), 2_000):
        part = shared[start : start + 2_000]
        grid = []
        for side in (a, b):
            m = np.zeros((len(side), len(part)), np.float32)
            for r, k in enumerate(side):
                t = tokens[k]
                at = np.minimum(np.searchsorted(part, t), len(part) - 1)
                m[r, at[part[at] == t]] = 1
            grid.append(m)
        both += grid[0] @ grid[1].T
    return both


def _sides(sides: list[int]) -> tuple[list[int], list[int]]:
    a = [k for k, s in enumerate(sides) if s == 0]
    b = [k for k, s in enumerate(sides) if s == 1]
    return a, b


def may_link(sizes: list[int], sketches: list[bytes], a: list[int], b: list[int], percent: int) -> np.ndarray:
    """Pairs of sets whose sizes and sketches leave a link possible."""
    n = np.array(sizes, np.int64)
    x, y = n[a][:, None], n[b][None, :]
    may = 100 * np.minimum(x, y) >= percent * np.maximum(x, y)
    length = np.array([len(s) for s in sketches])
    for one in np.unique(length[a]).tolist():
        for two in np.unique(length[b]).tolist():
            i, j = np.flatnonzero(length[a] == one), np.flatnonzero(length[b] == two)
            near = np.ix_(i, j)
            if may[near].any():
                bound = at_most_common([sketches[a[k]] for k in i], [sketches[b[k]] for k in j])
                may[near] &= (100 + percent) * bound >= percent * (n[a][i][:, None] + n[b][j][None, :])
    return may


def _block_links(fps, sides, tokens, percent):
    """A spanning forest of the links between the two sides (within the side if the block is paired with itself)."""
    a, b = _sides(sides)
    b = b or a
    if not a:
        return []
    both = _common(tokens, a, b)
    na, nb = (np.array([len(tokens[k]) for k in side]) for side in (a, b))
    i, j = np.nonzero(100 * both >= percent * (na[:, None] + nb[None, :] - both))
    up = roots([fps[a[k]] for k in i.tolist()], [fps[b[k]] for k in j.tolist()])
    return [(r, x) for x, r in up.items() if r != x]


def _by_pair(batches, text: bool, size: int):
    """The rows of each pair of blocks: keys, sides, fingerprints and the rest; rows of a pair come together."""
    key, rows = None, []
    for batch in batches:
        for piece in pieces(batch, "text") if text else [batch]:
            last = _sets(piece.column("text"), size) if text else zip(piece.column("n").to_pylist(), piece.column("sketch").to_pylist())
            for x, y, side, fp, value in zip(*(piece.column(c).to_pylist() for c in ("block", "other", "side", "fp")), last):
                if (x, y) != key:
                    if rows:
                        yield key, rows
                    key, rows = (x, y), []
                rows.append((side, fp, value))
    if rows:
        yield key, rows


def hopeful(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Of the sets of each pair of blocks those with a possible link there; rows: block, other, side, fp, n, sketch."""

    def run(batches):
        for (x, y), own in _by_pair(batches, False, size):
            a, b = _sides([r[0] for r in own])
            if not a or x != y and not b:
                continue
            may = may_link([r[2][0] for r in own], [r[2][1] for r in own], a, b or a, percent)
            if x == y:
                np.fill_diagonal(may, False)
            keep = {a[k] for k in np.flatnonzero(may.any(axis=1))} | {(b or a)[k] for k in np.flatnonzero(may.any(axis=0))}
            found = [own[k] for k in sorted(keep)]
            columns = [[x] * len(found), [y] * len(found), [r[0] for r in found], [r[1] for r in found]]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["block", "other", "side", "fp"])

    return rows.repartition("block", "other").sortWithinPartitions("block", "other").mapInArrow(run, "block long, other long, side int, fp long")


def block_rows(members: DataFrame, percent: int, block: int) -> DataFrame:
    """(block, other, side, fp): the members of signatures in pairs of blocks, where a link is possible; members: sig, a, n, held.

    A set's home is the signature with most members among its own (of equal ones the largest, so that sets of one passage agree),
    so that sets which meet often lie in one block.
    Blocks hold sets of about one size, and only blocks of neighbouring sizes are compared: linked sizes differ by
    less than one step. ``held`` says how many crowded tokens a set's prefix has: where neither that number nor the largest of the other
    block reaches what a link with any size there demands, the set stays away (a pair that links all the same has another token in common).
    """
    step = math.log(101 / percent)
    sizes = members.groupBy("sig").agg(F.count("*").alias("many"))
    home = members.join(sizes, "sig").groupBy(F.col("a").alias("fp")).agg(F.max(F.struct("many", "sig"))["sig"].alias("home"), F.first("n").alias("n"), F.first("held").alias("held"))
    placed = cut_lineage(home.withColumn("size", F.floor(F.log(F.col("n")) / step)))
    counts = placed.groupBy("home", "size").agg(F.ceil(F.count("*") / block).alias("parts"))
    number = F.xxhash64("home", "size", F.pmod(F.xxhash64("fp"), F.col("parts")))
    blocks = cut_lineage(placed.join(counts, ["home", "size"]).select("fp", "size", "n", "held", number.alias("block")))
    holds = cut_lineage(members.select("sig", F.col("a").alias("fp")).join(blocks, "fp").select("sig", "block", "size").distinct())
    other = holds.select("sig", F.col("block").alias("other"), F.col("size").alias("other_size"))
    near = (F.col("block") <= F.col("other")) & (F.abs(F.col("size") - F.col("other_size")) <= 1)
    pairs = cut_lineage(holds.join(other, "sig").where(near).select("block", "other").distinct())
    reach = cut_lineage(blocks.groupBy("block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("held").alias("most")))
    rows = []
    for side, own, its in ((0, "block", "other"), (1, "other", "block")):
        wanted = pairs if side == 0 else pairs.where("block < other")
        met = wanted.join(reach.withColumnRenamed("block", its), its).join(blocks.select(F.col("block").alias(own), "fp", "n", "held"), own)
        rows.append(met.where(_reaches(percent)).select("block", "other", F.lit(side).alias("side"), "fp"))
    return rows[0].union(rows[1])


def _reaches(percent: int):
    """Whether a set (n, held) may link with one of a block (lo, hi, most) by crowded tokens alone.

    What two sizes demand (``least_shared``) is smallest at one of the ends of the sizes that can link, for a small ``percent`` at equal sizes, and two at least: with a single
    crowded token in one of two linked prefixes, they have another token in common.
    """
    n = F.col("n")
    ends = [F.greatest("lo", n * percent / 100), F.least("hi", n * 100 / percent)]
    ends.append(F.least(F.greatest(n, ends[0]), ends[1]))
    demand = [(n + m) * percent / (100 + percent) - F.greatest(n, m) * (percent / 100 - 1 / SPARE) for m in ends]
    return (ends[0] <= ends[1]) & (F.least("held", "most") + 1e-6 >= F.greatest(F.lit(2.0), F.least(*demand)))


def only(rows: DataFrame, keys: DataFrame, sent_keys: int = SENT_KEYS) -> DataFrame:
    """The rows whose key is among ``keys``, a stored table of one column."""
    return rows.join(F.broadcast(keys) if keys.count() <= sent_keys else keys, keys.columns[0], "left_semi")


def verify(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between the sets of each pair of blocks, as spanning forests; texts: block, other, side, fp, text."""

    def run(batches):
        for _, own in _by_pair(batches, True, size):
            found = _block_links([r[1] for r in own], [r[0] for r in own], [r[2] for r in own], percent)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return texts.repartition("block", "other").sortWithinPartitions("block", "other").mapInArrow(run, "a long, b long")


def _placed(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, classes=CLASSES, key: str = "doc_id", text: str = "text", floor: int = FLOOR, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """(id, mark, n, component) of every row; component is the smallest fingerprint reachable by links, null without a word."""
    with tidy_shuffles(docs.sparkSession):
        texts = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("mark"))
        found = cut_lineage(survey(texts, size, classes[0][0]))
        known = found.where("token is null").select("id", "mark", "n", "fp")
        tokens, kinds = frequent(found, classes, floor)
        met = cut_lineage(candidates(index(texts, size, percent, tokens, kinds, tuple(k for _, k in classes)), percent, small))
        members = cut_lineage(met.where("b is null").select("sig", "a", "n").distinct())
        counts = cut_lineage(members.groupBy("sig").agg(F.count("*").alias("many")).where("many > 1"))
        few = members.join(counts.where(F.col("many") <= small), "sig").select("sig", "a", F.abs("n").alias("n"))
        near = (F.col("a") < F.col("b")) & (100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
        crowded = cut_lineage(members.join(counts.where(F.col("many") > small), "sig").select("sig", "a", "n"))
        # a set whose prefix is not all rare may meet others in a single combination, so any number of crowded tokens is enough
        held = cut_lineage(crowded.groupBy("a").agg(F.when(F.min("n") < 0, F.lit(_LAST)).otherwise(F.count("*")).alias("held")))
        often = met.where("b is not null").groupBy("a", "b").agg(F.count("*").alias("many"), F.min("n").alias("n"))
        often = often.join(held, "a", "left").join(held.toDF("b", "held_b"), "b", "left")
        common = F.least(F.coalesce("held", F.lit(0)), F.coalesce("held_b", F.lit(0)), "n")
        pairs = often.where(F.col("many") + common >= F.col("n")).select("a", "b")
        pairs = cut_lineage(pairs.union(few.join(few.toDF("sig", "b", "m"), "sig").where(near).select("a", "b")).distinct())
        members = crowded.join(held, "a").select("sig", "a", F.abs("n").alias("n"), "held")
        rows = cut_lineage(block_rows(cut_lineage(members), percent, block))
        rows = cut_lineage(rows.union(pair_rows(pairs, block)))
        shows = only(shown(texts, size), cut_lineage(rows.select("fp").distinct())).groupBy("fp", "n").agg(F.first("sketch").alias("sketch"))
        chosen = cut_lineage(hopeful(rows.join(shows, "fp"), size, percent))
        # a text that several sets of rows wait for travels once, with the list of its pairs of blocks
        waits = chosen.groupBy("fp").agg(F.collect_list(F.struct("block", "other", "side")).alias("waits"))
        waits = cut_lineage(known.where("n > 0").groupBy("fp").agg(F.min("id").alias("id")).join(waits, "fp"))
        found = _of_fingerprint(only(texts, waits.select("id")).join(waits, "id"), size).select(F.inline("waits"), "fp", "text")
        links = verify(found.select("block", "other", "side", "fp", "text"), size, percent)
        member = cut_lineage(components(cut_lineage(links)))
    return known.join(member.where("node is not null"), F.col("fp") == F.col("node"), "left").select(
        "id", "mark", "n", F.when(F.col("n") > 0, F.coalesce("component", "fp")).alias("component")
    )


def similar(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """(key, n_shingles, component_id, text_hash) of every row; component_id is the smallest key reachable by links. Other columns are not read."""
    placed = _placed(docs, key=key, **options)
    least = cut_lineage(placed.where("n > 0").groupBy("component").agg(F.min("id").alias("component_id")))
    return placed.join(least, "component", "left").select(
        _id("id").alias(key), F.col("n").alias("n_shingles"), _id(F.coalesce("component_id", "id")).alias("component_id"), F.col("mark").alias("text_hash")
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component: its smallest key; of rows that share that key the one with the smallest text hash.

    A component is told by its fingerprint, so unlinked texts under one key, or without a key, all stay.
    Rows without a word are components of their own, one for each key and text.
    """
    placed = _placed(docs.select(key, text), key=key, text=text, **options)
    alone = [F.when(F.col("n") == 0, F.col(c)) for c in ("id", "mark")]
    kept = placed.groupBy("component", *[c.alias(f"_alone{k}") for k, c in enumerate(alone)]).agg(F.min(F.struct("id", "mark")).alias("first"))
    kept = kept.select(F.col("first.id").alias("_component_key"), F.col("first.mark").alias("_component_mark"))
    marked = docs.withColumns({"_text_hash": F.xxhash64(text), "_text_key": F.coalesce(F.col(key).cast("long"), F.lit(_LAST))})
    rows = marked.join(kept, (F.col("_text_key") == F.col("_component_key")) & (F.col("_text_hash") == F.col("_component_mark")), "left_semi")
    order = Window.partitionBy("_text_key", "_text_hash").orderBy(*[F.xxhash64(c) for c in docs.columns])
    return rows.withColumn("_copy", F.row_number().over(order)).where("_copy = 1").select(*docs.columns)


def _id(column):
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column != _LAST, column)


def shown(docs: DataFrame, size: int) -> DataFrame:
    """(fp, n, sketch): size and sketch of every text."""

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                sets = [s for s in _sets(piece.column(1), size) if len(s)]
                columns = [pa.array([fingerprint(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([sketch(s) for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["fp", "n", "sketch"])

    return docs.select("id", "text").mapInArrow(run, "fp long, n long, sketch binary")


def _of_fingerprint(rows: DataFrame, size: int) -> DataFrame:
    """(fp, text, waits) of the rows whose text has the fingerprint that is sought; an id may be there with several texts."""
    rows = rows.where("text is not null").select("fp", "text", "waits")

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                good = [fingerprint(s) == fp for s, fp in zip(_sets(piece.column(1), size), piece.column(0).to_pylist())]
                yield piece.filter(pa.array(good, pa.bool_()))

    return rows.mapInArrow(run, rows.schema)
