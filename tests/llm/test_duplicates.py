import hashlib
import random
import re

import numpy as np
import pytest

from starloom.llm import embedding_dedup, ngram_join, queries, substring_dedup
from starloom.llm.components import components
from starloom.llm.words import words

SF = "/root/testdata/sf0.001"


def same_as_oracle(spark, name, sf=SF):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    expected = con.sql(queries.ORACLE[name]).df()
    got = queries.QUERIES[name](spark, sf).toPandas()
    assert sorted(got.columns) == sorted(expected.columns)
    columns, key = sorted(got.columns), got.columns[0]
    got, expected = (x[columns].sort_values(key).reset_index(drop=True) for x in (got, expected))
    assert got.equals(expected.astype(got.dtypes.to_dict()))


@pytest.mark.parametrize("name", ["op2_substring_dedup", "op4_ngram_join", "op9_embedding_dedup"])
def test_query_equals_its_sql(spark, name):
    same_as_oracle(spark, name)


def smallest_reachable(nodes, links):
    near = {x: {x} for x in nodes}
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for x in sorted(nodes):
        todo = [x]
        while todo:
            y = todo.pop()
            if y not in out:
                out[y] = x
                todo += near[y]
    return out


def test_components_of_chains_stars_and_noise(spark):
    random.seed(1)
    links = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(400, 480)]
    links += [tuple(random.sample(range(1_000, 1_400), 2)) for _ in range(220)] + [(7, 7)]
    nodes = {x for link in links for x in link if link[0] != link[1]}
    frame = spark.createDataFrame(links, "a long, b long").repartition(7)
    found = {r.node: r.component for r in components(frame).collect()}
    assert found == smallest_reachable(nodes, [x for x in links if x[0] != x[1]])
    assert components(frame.where("false")).count() == 0


def repeated_by_definition(texts, size):
    """(id, text) -> (words, removed, kept) by the definition."""
    seen, rows = {}, sorted({(i, t) for i, t in texts}, key=lambda r: r[0])
    split = {r: re.findall("[^\x20\x09-\x0d]+", r[1]) for r in rows}
    for r in rows:
        w = split[r]
        for p in range(len(w) - size + 1):
            seen.setdefault(tuple(w[p : p + size]), []).append((r[0], p))
    out = {}
    for r in rows:
        w, gone = split[r], set()
        for p in range(len(w) - size + 1):
            if min(seen[tuple(w[p : p + size])]) < (r[0], p):
                gone |= set(range(p, p + size))
        out[r] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


@pytest.mark.parametrize("group", [2, 2_000])
def test_removed_windows_by_definition(spark, group):
    random.seed(group)
    letters = [f"w{k}" for k in range(30)]
    base = [random.choices(letters, k=60) for _ in range(6)]
    texts = []
    for i in range(80):
        w = random.choices(letters, k=random.randint(0, 50))
        for _ in range(random.randint(0, 3)):
            b = random.choice(base)
            a = random.randrange(50)
            w += b[a : a + random.randint(5, 30)]
        texts.append((i, " ".join(w)))
    texts += [(200, "z " * 90), (201, texts[3][1]), (202, texts[3][1]), (202, texts[3][1]), (203, "z\t" * 40)]
    texts += [(300 + k, " ".join(base[0])) for k in range(30)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    expected = repeated_by_definition(texts, 8)
    got = substring_dedup.remove_repeats(docs, size=8, prefix=3, group=group).collect()
    assert len(got) == len(texts)
    by_id = {}
    for (i, _), v in expected.items():
        by_id[i] = v
    for r in got:
        assert (r.n_words, r.n_removed, r.kept_text) == by_id[r.doc_id], r.doc_id


def test_every_window_has_one_anchor_and_equal_windows_equal_anchors():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 6, 400).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    first = np.array([0, 0, 5, 130, 400])
    row, value, at, lo, hi = substring_dedup.anchors_of(hashes, first, 10, 4)
    windows = {}
    for r, v, a, x, y in zip(row, value, at, lo, hi):
        for p in range(x, y + 1):
            assert x <= p <= a <= p + 6
            assert (r, p) not in windows
            windows[r, p] = (int(v), a - p)
    assert set(windows) == {(r, p) for r in range(4) for p in range(first[r + 1] - first[r] - 9)}
    by_words = {}
    for (r, p), anchor in windows.items():
        key = tuple(hashes[first[r] + p : first[r] + p + 10].tolist())
        assert by_words.setdefault(key, anchor) == anchor


def test_substrings_of_odd_documents(spark, odd_docs, no_docs):
    rows = {(r.doc_id, r.n_words): r for r in substring_dedup.remove_repeats(odd_docs).collect()}
    assert substring_dedup.remove_repeats(odd_docs).count() == 10
    assert rows[5, 60_001].n_removed > 58_000 and rows[6, 60_001].n_removed == 60_001 and rows[6, 60_001].kept_text == ""
    assert rows[2, 0].kept_text == rows[3, 0].kept_text == rows[4, 0].kept_text == ""
    assert rows[None, 5].n_removed == 0
    assert substring_dedup.remove_repeats(no_docs).count() == 0


def sets_by_definition(text, size=5):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[p : p + size]) for p in range(max(len(w) - size + 1, 1))} if w else set()


def near_copies(seed):
    random.seed(seed)
    letters = [f"w{k}" for k in range(400)]
    base = [random.choices(letters, k=n) for n in (12, 40, 90, 150, 300)]
    texts = []
    for i in range(160):
        w = list(random.choice(base))
        for _ in range(random.randint(0, max(1, len(w) // 25))):
            w[random.randrange(len(w))] = random.choice(letters)
        if random.random() < 0.2:
            w = w[random.randint(0, 5) :] + random.choices(letters, k=random.randint(0, 8))
        texts.append((i, " ".join(w)))
    for k in range(30):
        texts.append((300 + k, " ".join(random.choices(letters, k=random.randint(1, 9)))))
    return texts + [(400, "A b"), (401, "a  B\n"), (402, "a c"), (403, "q"), (404, None), (405, " ")]


@pytest.mark.parametrize("options", [{}, {"floor": 3, "small": 4, "block": 7, "classes": ((0.02, 2), (0.1, 3))}])
def test_join_by_definition(spark, options):
    texts = near_copies(5 + len(options))
    sets = {i: sets_by_definition(t) for i, t in texts}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    expected = smallest_reachable(sets, links)
    assert len(links) > 200
    got = ngram_join.similar(spark.createDataFrame(texts, "doc_id long, text string").repartition(4), **options).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), expected[i]) for i, s in sets.items()}


@pytest.mark.parametrize("frequent_share", [0.0, 0.4, 1.0])
def test_linked_sets_share_what_the_join_needs(frequent_share):
    rng = np.random.default_rng(6)
    for _ in range(300):
        n = int(rng.integers(4, 90))
        x = np.unique(rng.integers(1, 2**62, n).astype(np.uint64))
        n = len(x)
        drop = int(rng.integers(0, max(n // 5, 1) + 1))
        y = np.unique(np.concatenate([x[rng.permutation(n)[drop:]], rng.integers(1, 2**62, int(rng.integers(0, 4))).astype(np.uint64)]))
        if np.array_equal(x, y) or not ngram_join.linked(x, y, 80):
            continue
        kinds = {int(t): int(rng.integers(1, 3)) if rng.random() < frequent_share else 0 for t in np.union1d(x, y)}
        found = [ngram_join.signatures(s, np.array([kinds[int(t)] for t in s]), (2, 3), 80) for s in (x, y)]
        rare = len(np.intersect1d(found[0][0], found[1][0]))
        pure = [len(f[0]) == len(s) - -(-80 * len(s) // 100) + 2 and not len(f[1]) for f, s in zip(found, (x, y))]
        need = ngram_join.least_shared(*(np.array([len(s) if p else -len(s)]) for p, s in zip(pure, (x, y))), 80)[0]
        assert rare >= need or len(np.intersect1d(found[0][1], found[1][1])) >= 1
        assert ngram_join.may_link([len(x), len(y)], [ngram_join.sketch(s) for s in (x, y)], [0], [1], 80).all()


@pytest.mark.parametrize("percent", [5, 50, 80, 100])
def test_sketches_lose_no_link_and_tell_most_strangers(percent):
    rng = np.random.default_rng(percent)
    pool = rng.integers(1, 2**62, 3_000).astype(np.uint64)
    sets = [np.unique(rng.choice(pool[: int(rng.choice([8, 60, 700, 3_000]))], int(rng.integers(1, 900)))) for _ in range(60)]
    sets += [np.sort(rng.permutation(s)[: max(1, int(len(s) * 0.93))]) for s in sets[:20]]
    sizes, sketches, all_sets = [len(s) for s in sets], [ngram_join.sketch(s) for s in sets], list(range(len(sets)))
    may = ngram_join.may_link(sizes, sketches, all_sets[:50], all_sets[50:], percent)
    for i, x in enumerate(sets[:50]):
        for j, y in enumerate(sets[50:]):
            assert may[i, j] or not ngram_join.linked(x, y, percent)
    strangers = [np.sort(rng.integers(1, 2**62, 500).astype(np.uint64)) for _ in range(20)]
    few = ngram_join.may_link([500] * 20, [ngram_join.sketch(s) for s in strangers], list(range(10)), list(range(10, 20)), 80)
    assert not few.any()


def test_a_full_bucket_bounds_nothing():
    """Two sets all of whose tokens lie in one bucket: the sketch cannot tell how many they share."""
    from starloom.llm.words import mix

    tokens = np.arange(1, 40_000, dtype=np.uint64)
    one = tokens[(mix(tokens) >> np.uint64(32)) & np.uint64(31) == 0][:64]
    bound = ngram_join.at_most_common([ngram_join.sketch(one)], [ngram_join.sketch(one)])
    assert len(one) == 64 and bound[0, 0] >= 64
    few = ngram_join.at_most_common([ngram_join.sketch(one)], [ngram_join.sketch(one[:5])])
    assert 5 <= few[0, 0] <= 64


@pytest.mark.parametrize("sent_keys", [1, 100])
def test_keys_pick_the_same_rows_sent_or_not(spark, sent_keys):
    rows = spark.createDataFrame([(k % 7 if k else None, k) for k in range(40)], "id long, v long")
    keys = spark.createDataFrame([(1,), (3,), (3,), (None,)], "id long")
    got = ngram_join.only(rows, keys, sent_keys)
    assert sorted(r.v for r in got.collect()) == [k for k in range(1, 40) if k % 7 in (1, 3)]


def passage_texts(seed, many):
    """Texts of their own round passages that many share, some with a near copy; and texts that are little else than a passage."""
    rng = random.Random(seed)
    passages = [" ".join(f"p{k}w{j}" for j in range(60)) for k in range(3)]
    rows = []
    for k in range(many):
        own = [f"u{rng.randrange(10**9)}" for _ in range(rng.choice((70, 150, 260)))]
        at = rng.randrange(len(own))
        text = own[:at] + rng.choice(passages).split() + own[at:]
        rows.append(" ".join(text))
        if k % 9 == 0:
            text[rng.randrange(len(text))] = "edited"
            rows.append(" ".join(text[rng.randrange(15) :]))
        if k % 15 == 0:
            rows.append(" ".join(own[:5] + passages[k % 3].split()))
    return list(enumerate(rows, start=5))


@pytest.mark.parametrize("small,block,floor", [(3, 7, 10_000), (10, 200, 10_000), (10, 20, 40), (64, 200, 64)])
def test_texts_that_share_a_passage(spark, small, block, floor):
    rows = passage_texts(small, 240)
    sets = [(k, frozenset(sets_by_definition(t))) for k, t in rows]
    links = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i] if 100 * len(x & y) >= 80 * len(x | y)]
    expected = smallest_reachable([k for k, _ in rows], links)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = ngram_join.similar(frame, small=small, block=block, floor=floor).collect()
    assert {r.doc_id: r.component_id for r in got} == expected
    assert len(links) > 30 and len(set(expected.values())) > 200


def test_few_crowded_tokens_keep_a_set_out_of_blocks(spark):
    """Forty texts of 210 shingles share some tokens: with 5 none can link, with 40 any may; two sizes whose link takes few keep them."""
    for held, n, rows in ((5, [210] * 40, 0), (40, [210] * 40, 40), (5, [210] * 20 + [168] * 20, 40)):
        members = spark.createDataFrame([(1, k, n[k], held) for k in range(40)], "sig long, a long, n long, held long")
        assert ngram_join.block_rows(members, 80, 200).select("fp").distinct().count() == rows


@pytest.mark.parametrize("percent", [80, 90])
def test_what_two_sizes_demand_is_least_at_an_end(spark, percent):
    """``_reaches`` lets every set through that has as many crowded tokens as ``least_shared`` demands for some size of the block."""
    rng = random.Random(percent)
    cases = []
    for _ in range(300):
        n, lo = rng.randrange(4, 900), rng.randrange(4, 900)
        cases.append((n, lo, lo + rng.randrange(200), rng.randrange(1, 60), rng.randrange(1, 60)))
    frame = spark.createDataFrame(cases, "n long, lo long, hi long, held long, most long")
    got = [r.may for r in frame.select(ngram_join._reaches(percent).alias("may")).collect()]
    for may, (n, lo, hi, held, most) in zip(got, cases):
        sizes = np.array([m for m in range(lo, hi + 1) if 100 * min(n, m) >= percent * max(n, m)])
        if len(sizes) and (ngram_join.least_shared(np.full(len(sizes), n), sizes, percent) <= min(held, most)).any():
            assert may


def test_fingerprints_ignore_order_and_tell_sets_apart():
    a = np.array([3, 5, 9], np.uint64)
    assert ngram_join.fingerprint(a) == ngram_join.fingerprint(a[::-1].copy()) != ngram_join.fingerprint(a[:2])
    import pyarrow as pa

    sets = ngram_join.shingle_sets(words(pa.array(["a b", "a b c d e", "", "a b c d e a b c d e"])), 5)
    assert [len(s) for s in sets] == [1, 1, 0, 5]


def test_join_of_odd_documents(spark, odd_docs, no_docs):
    rows = ngram_join.similar(odd_docs).collect()
    assert len(rows) == 10
    assert {r.component_id for r in rows if r.doc_id in (5, 6)} == {5}
    assert all(r.component_id == r.doc_id and r.n_shingles == 0 for r in rows if r.doc_id in (2, 3, 4))
    assert ngram_join.similar(no_docs).count() == 0
    kept = ngram_join.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id or 0, len(r.text or "")) for r in kept.collect() if r.doc_id not in (2, 3, 4, 5)) == [(0, 20), (1, 30), (7, 13)] or kept.where("doc_id = 1").count() >= 1
    assert kept.where("doc_id = 6").count() == 0 and kept.where("doc_id = 5").count() == 1
    assert ngram_join.one_of_each(no_docs).count() == 0


def test_unlinked_texts_under_one_id_or_none_all_stay(spark, odd_docs):
    kept = [(r.doc_id, r.text) for r in ngram_join.one_of_each(odd_docs).collect()]
    assert sorted(t for i, t in kept if i == 1) == ["alpha beta gamma delta epsilon zeta eta theta", "another text under the same id"]
    assert sorted(i or 0 for i, _ in kept) == [0, 1, 1, 2, 3, 4, 5, 7]
    texts = [" ".join(f"w{k}x{j}" for j in range(12)) for k in range(30)]
    rows = [(None, t) for t in texts] + [(None, texts[0]), (None, texts[1] + " "), (9, texts[2]), (None, ""), (None, " "), (None, None), (None, None)]
    kept = [(r.doc_id, r.text) for r in ngram_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert {(t or "").strip() for _, t in kept} == {*texts, ""} and (9, texts[2]) in kept and (None, texts[2]) not in kept
    assert sorted(repr(t) for _, t in kept if not (t or "").strip()) == ["' '", "''", "None"] and len(kept) == 33


def links_by_definition(rows, least=0.98):
    ok = {}
    for k, (i, v, label) in enumerate(rows):
        if label is not None and v and None not in v:
            x = np.array(v, float)
            if np.isfinite(x).all() and np.linalg.norm(x) > 0:
                ok[k] = (x / np.linalg.norm(x), label)
    return [(a, b) for a in ok for b in ok if a < b and ok[a][1] == ok[b][1] and len(ok[a][0]) == len(ok[b][0]) and float(ok[a][0] @ ok[b][0]) >= least]


@pytest.mark.parametrize("block", [20, 1_000])
def test_vectors_by_definition(spark, block):
    rng = np.random.default_rng(7)
    hot = rng.normal(size=64)
    rows = []
    for k in range(150):
        rows.append((k, (hot + rng.normal(size=64) * 0.13).tolist(), 1))
    for k in range(150, 260):
        v = rng.normal(size=64)
        rows.append((k, v.tolist(), int(rng.integers(3))))
        rows.append((k + 1_000, (v + rng.normal(size=64) * rng.choice([0.05, 0.15, 0.25])).tolist(), rows[-1][2]))
    rows += [(500, [0.0] * 64, 1), (501, None, 1), (502, [1.0, None], 1), (503, [float("nan")] * 64, 1), (504, hot.tolist(), None), (505, [], 2), (506, [float("inf")] * 64, 1)]
    rows += [(507, [2.0], 1), (507, [3.0], 1), (508, [-1.0], 1)]
    links = links_by_definition(rows)
    assert len(links) > 2_000
    got = embedding_dedup.deduplicate(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4), block=block).toPandas()
    degree = np.zeros(len(rows), int)
    for a, b in links:
        degree[[a, b]] += 1
    reach = smallest_reachable(range(len(rows)), links)
    smallest = {}
    for k, root in reach.items():
        smallest[root] = min(smallest.get(root, 10**9), rows[k][0])
    expected = sorted((rows[k][0], int(degree[k]), smallest[reach[k]], rows[k][0] == smallest[reach[k]]) for k in range(len(rows)))
    found = sorted(got.itertuples(index=False, name=None))
    assert sum(x[1] for x in found) >= 0.99 * 2 * len(links)
    assert sum(x != y for x, y in zip(found, expected)) <= 8 and len(found) == len(expected)
    assert embedding_dedup.deduplicate(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_list_decoding_finds_exactly_the_filters_above_the_height():
    rng = np.random.default_rng(8)
    code = embedding_dedup.ProductCode(10, 12, 1.2)
    unit = rng.normal(size=(40, 10))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    turned = unit @ code.rotation
    for x, found in zip(turned, code.decode(unit)):
        value = (code.codes[0] @ x[: code.cut])[:, None] + (code.codes[1] @ x[code.cut :])[None, :]
        expected = np.flatnonzero(value.ravel() >= code.height)
        assert found.tolist() == (expected if len(expected) else [value.argmax()]).tolist() if len(expected) else len(found) == 1


def test_kept_digest_is_that_of_the_text(spark):
    found = queries.QUERIES["op2_substring_dedup"](spark, SF).where("n_removed = 0").limit(5).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in found:
        assert r.kept_sha256 == hashlib.sha256(" ".join(re.findall("[^\x20\x09-\x0d]+", docs[r.doc_id])).encode()).hexdigest()


def test_long_linked_sets_share_spare_rare_tokens():
    """Sets of any sizes that link have two rare prefix tokens and one of ``SPARE`` in common, as ``least_shared`` says."""
    rng = np.random.default_rng(9)
    for n in (300, 900, 2_000):
        x = np.unique(rng.integers(1, 2**62, n).astype(np.uint64))
        for more in (0, n // 10, n // 4):
            y = np.unique(np.concatenate([x, rng.integers(1, 2**62, more).astype(np.uint64)]))
            found = [ngram_join.signatures(s, np.zeros(len(s), int), (2, 3), 80)[0] for s in (x, y)]
            assert [len(f) for f in found] == [len(s) // 5 + 2 + len(s) // ngram_join.SPARE for s in (x, y)]
            need = ngram_join.least_shared(np.array([len(x)]), np.array([len(y)]), 80)[0]
            assert len(np.intersect1d(*found)) >= need >= 2 + n // ngram_join.SPARE


@pytest.mark.parametrize("held,n,rows", [(1, 30, 0), (1, 200, 0), (4, 500, 0), (9, 500, 40)])
def test_a_few_tokens_shared_by_chance_bring_no_set_into_blocks(spark, held, n, rows):
    """Forty texts of sizes n and n * 0.8, the pair of sizes that a link takes fewest common tokens of."""
    members = spark.createDataFrame([(1, k, n if k % 2 else n * 4 // 5, held) for k in range(40)], "sig long, a long, n long, held long")
    assert ngram_join.block_rows(members, 80, 200).select("fp").distinct().count() == rows


def test_the_join_leaves_no_shuffle_files(spark, tmp_path):
    """Shuffle files of the join's own steps go with their queries; the setting is as before afterwards."""
    from pathlib import Path

    local = Path(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false")
    held = {f.name for f in local.rglob("shuffle_*.data")}
    ngram_join._placed(spark.createDataFrame(passage_texts(1, 60), "doc_id long, text string").repartition(3))
    assert {f.name for f in local.rglob("shuffle_*.data")} <= held
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == before
