import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from starloom.llm import mixing, queries, token_packing
from starloom.runtime import cut_lineage

SF = "/root/testdata/sf0.01"


@given(st.lists(st.integers(1, 16), max_size=60))
def test_best_fit_decreasing_by_definition(lengths):
    rows = token_packing.best_fit_decreasing(np.array(lengths, int), 16)
    left, expected = [], []
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        fits = [(room, r) for r, room in enumerate(left) if room >= lengths[k]]
        expected.append(min(fits)[0] if fits else None)
        if fits:
            left[min(fits)[1]] -= lengths[k]
        else:
            left.append(16 - lengths[k])
    assert sorted(k for r in rows for k in r) == list(range(len(lengths)))
    assert sorted(16 - sum(lengths[k] for k in r) for r in rows) == sorted(left)


def unpacked(packed: pd.DataFrame) -> dict:
    parts = {}
    for r in packed.itertuples():
        ids, positions = np.frombuffer(r.input_ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and len(r.cu_seqlens) == r.n_segments + 1
        for k in range(r.n_segments):
            a, b = r.cu_seqlens[k], r.cu_seqlens[k + 1]
            assert positions[a:b].tolist() == list(range(b - a))
            parts.setdefault(r.doc_ids[k], []).append((r.doc_offsets[k], ids[a:b]))
    return {d: np.concatenate([x for _, x in sorted(p, key=lambda x: x[0])]) for d, p in parts.items()}


def test_round_trip_of_every_document(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").toPandas()
    packed = queries.QUERIES["op1_token_packing"](spark, SF).toPandas()
    enc = token_packing.encoder(open(token_packing.VOCABULARY, "rb").read())
    whole = unpacked(packed)
    assert set(whole) == set(docs["doc_id"])
    for d, t in zip(docs["doc_id"], docs["text"]):
        ids = whole[d].tolist()
        assert ids[-1] == 50_256 and enc.decode(ids[:-1]) == t
    tokens = sum(map(len, whole.values()))
    assert len(packed) <= 1.02 * tokens / 2_048 + packed["shard"].nunique()


def test_odd_texts(spark, odd_docs, no_docs):
    texts = odd_docs.where("doc_id in (2, 3, 5, 7)")
    packed = token_packing.pack(texts, row_tokens=64, pool_tokens=500).toPandas()
    whole = unpacked(packed)
    enc = token_packing.encoder(open(token_packing.VOCABULARY, "rb").read())
    assert set(whole) == {5, 7}
    assert enc.decode(whole[5].tolist()[:-1]) == texts.where("doc_id = 5").first().text
    assert token_packing.pack(no_docs).count() == 0
    assert packed.groupby("shard")["row"].apply(lambda r: sorted(r) == list(range(len(r)))).all()


def test_capacities_find_the_least_that_suffices():
    free = token_packing.Capacities(8)
    for capacity, row in ((5, 0), (3, 1), (8, 2), (3, 3)):
        free.add(capacity, row)
    assert free.take(4) == (5, 0) and free.take(4) == (8, 2) and free.take(4) is None
    assert {free.take(1)[1], free.take(3)[1]} == {1, 3} and free.take(1) is None


def test_rates_reach_targets_and_match_a_local_solution(spark):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.3, 0.3, 0.3], 500)
    tokens = rng.integers(1, 200, 500)
    frame = pd.DataFrame({"doc_id": range(500), "mix_tokens": tokens, "mix_p": p.tolist()})
    members = cut_lineage(spark.createDataFrame(frame, "doc_id long, mix_tokens long, mix_p array<double>"))
    shares = np.array([0.2, 0.5, 0.3])
    rated, moves = mixing.rates(members, shares, rounds=200)
    got = rated.orderBy("doc_id").toPandas()["mix_rate"].to_numpy()
    assert (got >= 0).all() and np.allclose(got, mixing.rate_of(p, moves))
    assert np.abs((got * tokens) @ p / tokens.sum() - shares).max() <= 2e-3
    rate, step = np.ones(500), 1 / np.linalg.eigvalsh((p * tokens[:, None]).T @ p / tokens.sum())[-1]
    for _ in range(len(moves)):
        rate = np.maximum(0, rate - step * p @ ((rate * tokens) @ p / tokens.sum() - shares))
    assert np.allclose(rate, got)
    kept, _ = mixing.rates(members, shares, keep_all=True, rounds=200)
    assert kept.agg({"mix_tokens": "sum"}).first()[0] == tokens.sum() and kept.where("mix_rate < 0.2").count() < 25


def members_of(spark, p, tokens):
    frame = pd.DataFrame({"doc_id": range(len(p)), "mix_tokens": tokens, "mix_p": p.tolist()})
    return cut_lineage(spark.createDataFrame(frame, "doc_id long, mix_tokens long, mix_p array<double>"))


@pytest.mark.parametrize("keep_all", [False, True])
def test_rare_domains_reach_their_targets_by_default(spark, keep_all):
    rng = np.random.default_rng(5)
    goal = np.array([0.4, 0.2, 0.2, 0.2])
    for sharp in (True, False):
        domain = np.repeat(np.arange(4), [900, 60, 30, 10])
        p = np.eye(4)[domain] if sharp else 0.8 * np.eye(4)[domain] + 0.2 * rng.dirichlet([0.5] * 4, 1_000) ** 3
        p /= p.sum(axis=1, keepdims=True)
        rated, moves = mixing.rates(members_of(spark, p, np.full(1_000, 50)), goal, keep_all=keep_all)
        got = rated.orderBy("doc_id").toPandas()["mix_rate"].to_numpy()
        total = got @ p / 1_000
        wanted = goal * (max(p.mean(axis=0) / goal) if keep_all else 1)
        assert (np.abs(total - wanted) <= 0.01 * wanted).all() and np.allclose(got, mixing.rate_of(p, moves))


def test_targets_out_of_reach_give_the_nearest_totals_and_a_warning(spark):
    rng = np.random.default_rng(6)
    p = 0.5 * rng.dirichlet([1.0] * 3, 200) + np.array([0.3, 0.15, 0.05])
    goal, rate = np.array([0.05, 0.05, 0.9]), np.ones(200)
    for _ in range(50_000):
        rate = np.maximum(0, rate - p @ (rate @ p / 200 - goal))
    with pytest.warns(UserWarning, match="no rates meet the targets"):
        rated, _ = mixing.rates(members_of(spark, p, np.full(200, 10)), goal)
    got = rated.orderBy("doc_id").toPandas()["mix_rate"].to_numpy()
    distance = [np.linalg.norm(r @ p / 200 - goal) for r in (got, rate)]
    assert distance[0] <= distance[1] + 1e-3 and distance[1] > 0.1


def test_memberships_of_odd_documents(spark, odd_docs, no_docs):
    model = mixing.train(["the and of"] * 4 + ["der und die"] * 4, ["en"] * 4 + ["de"] * 4)
    rows = mixing.memberships(odd_docs, model).collect()
    assert len(rows) == 10
    for r in rows:
        assert abs(sum(r.mix_p) - (r.mix_tokens > 0)) < 1e-9
    members = cut_lineage(mixing.memberships(no_docs, model, keep=["doc_id"]))
    assert mixing.rates(members, np.array([0.5, 0.5]))[0].count() == 0
    p, _ = mixing.posteriors(pa.array(["the of and", "die und der"]), model)
    assert p[0, 1] > 0.5 > p[1, 1]
    assert mixing.train([], []).domains == ["all"]
    assert mixing.spread({"en": 0.3, "xx": 0.7}, ["de", "en"]).tolist() == [0, 1] and mixing.spread({}, ["a", "b"]).tolist() == [0.5, 0.5]


def test_mixing_query_moves_the_corpus_to_its_targets(spark):
    found = queries.QUERIES["op10_mixing"](spark, SF).toPandas()
    total = np.sum(np.stack(found["membership"]) * (found["rate"] * found["n_tokens"]).to_numpy()[:, None], axis=0) / found["n_tokens"].sum()
    assert np.allclose(total, [0.2, 0.4, 0.2, 0.2], atol=2e-3)
    assert found["copies"].mean() == pytest.approx(found["rate"].mean(), abs=0.06)


@pytest.mark.parametrize(
    "text",
    [" " * 2_000_000, "\n" * 2_000_000, "a" + "\t" * 2_000_000 + "word", " " * 50_000, "\x1c" * 50_000, ("x" * 5_000 + " " * 5_000) * 3, "!" * 4_096 + "\x1d" * 4_096],
    ids=["blanks", "newlines", "tabs", "wide", "separators", "mixed", "joined"],
)
def test_long_runs_come_back_whole(text):
    with open(token_packing.VOCABULARY, "rb") as file:
        enc = token_packing.encoder(file.read())
    ids = token_packing.encode(text, enc)
    assert enc.decode_bytes(ids.tolist()) == text.encode()


def test_short_runs_are_encoded_as_before():
    with open(token_packing.VOCABULARY, "rb") as file:
        enc = token_packing.encoder(file.read())
    n = token_packing.LONGEST_RUN
    for text in (" " * n + "word", "x" * n + " word", "a  b\n\n c\x1c d's"):
        assert token_packing.encode(text, enc).tolist() == enc.encode(text, disallowed_special=())
    # the last piece of a long run stays with the word behind it
    assert token_packing.encode(" " * (n + 1) + "word", enc).tolist() == enc.encode(" " * n) + enc.encode(" word")
