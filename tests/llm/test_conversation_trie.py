import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from starloom.llm import conversation_trie as ct
from starloom.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"


def sequences(rows):
    """conv_id -> its (role, text) in order."""
    def order(r):
        role, text = r[2] or "", r[3] or ""
        return (r[1] is not None, r[1] or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest())

    out = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=order):
        out[r[0]].append((r[2] or "", r[3] or ""))
    return dict(out)


def rebuild(seq):
    out = {}
    for c, own in seq.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        out[c] = seq.get(base, [])[:h] + own[h:]
    return out


def expected(seq):
    members = defaultdict(list)
    for c, turns in seq.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(own) - 1) * len(p[-1][1]) if p else 0
    return sorted(
        (
            min(own), len(p), min(members[p[:-1]]) if p else None, len(own), children[p], leaves[p], saved[p],
            hashlib.sha256(",".join(str(c) for c in sorted(own) if len(seq[c]) == len(p)).encode()).hexdigest(),
        )
        for p, own in members.items()
    ) if seq else []


def same(df, want):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in df.collect()), key=key) == sorted(want, key=key)


def made(seed, many):
    """Conversations that share openings, with ties, nulls, repeated rows, missing bases and negative ids."""
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-150, 1500), many):
        opening = draw.choice([["s"], ["s", "hello"], ["s", "hello", "wer"], []])
        turns = opening + [draw.choice(["a", "bb", "ccc", "", None]) for _ in range(draw.randrange(4))]
        for k, text in enumerate(turns or ["only"]):
            rows.append((c, draw.choice([k, k, k, None, 0]), draw.choice(["user", "user", None]), text))
            if draw.random() < 0.05:
                rows.append(rows[-1])
    return rows + [(None, 0, "user", "no id"), (100, 0, "user", "base"), (100, 1, "x", "y")]


@pytest.mark.parametrize("shard, most", [(3, 200_000), (4096, 7), (4096, 200_000)])
def test_trie_by_definition_whatever_the_shards(spark, shard, most):
    rows = made(shard, 220)
    same(ct.conversation_trie(spark.createDataFrame(rows, SCHEMA), shard=shard, most=most), expected(sequences(rows)))


def test_rebuilt_conversations_by_definition(spark, tmp_path):
    rows = made(5, 300)
    rows += [(c, 0, "user", "single") for c in (301, 302, 303, 304, 305, 306)]  # their base does not exist, so some have no turns
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    want = rebuild(sequences(rows))
    assert any(not turns for turns in want.values())
    same(queries.QUERIES["op13_conversation_trie"](spark, str(tmp_path)), expected(want))


def test_one_opening_and_copies_shared_by_thousands(spark):
    rows = [(c, 0, "system", "the same prompt") for c in range(3_000)] + [(c, 1, "user", f"q{c % 7}") for c in range(0, 3_000, 2)]
    df = ct.conversation_trie(spark.createDataFrame(rows, SCHEMA), shard=64)
    same(df, expected(sequences(rows)))


def test_shards_send_one_row_for_each_of_their_nodes(spark):
    rows = [(c, k, "user", f"turn {k}") for c in range(500) for k in range(4)]
    turns = ct.with_markers(ct.ordered_turns(spark.createDataFrame(rows, SCHEMA)))
    assert ct.shard_nodes(turns.coalesce(1), shard=1000).count() <= 5 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_end_lists_survive_packing():
    for ids in ([], [5], list(range(-40, 4000, 3)), [-(2**62), 0, 2**62], [7] * 3):
        assert ct.unpack_ids(ct.pack_ids(np.array(ids, np.int64))).tolist() == ids


def test_no_conversations_and_other_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert ct.conversation_trie(none).count() == 0
    assert ct.conversation_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0
    rows = [(1, 0, "user", "x" * 300_000), (2, 0, "user", "x" * 300_000)]
    more = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS node", "2 AS pos", "'c' AS chars", "4 AS depth", "5 AS n_convs")
    same(ct.conversation_trie(more), expected(sequences(rows)))


def test_query_equals_its_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    df = queries.QUERIES["op13_conversation_trie"](spark, sf)
    found = con.sql(queries.ORACLE["op13_conversation_trie"])
    assert df.columns == found.columns
    same(df, found.fetchall())


def test_crc_in_sql():
    import duckdb

    for text in ("", "0", "1234567", "öß€ word"):
        assert duckdb.sql(f"SELECT {queries.crc_sql(repr(text))}").fetchall()[0][0] == zlib.crc32(text.encode())
