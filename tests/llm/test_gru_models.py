import zlib

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import gru, language_id, quality, queries, toxicity

SF = "/root/testdata/sf0.01"


def test_backpropagation_matches_differences():
    rng = np.random.default_rng(0)
    ids, mask = rng.integers(0, 5, (4, 3)), np.array([[1, 1, 1], [1, 1, 1], [1, 1, 0], [1, 0, 0]], bool)
    params = gru.init(2, rng)
    tables = [rng.normal(0, 0.3, (5, 6)).astype(np.float32) for _ in "fb"]
    goal = rng.normal(size=(4, 4, 3)).astype(np.float32)

    def loss():
        return float((gru.forward(ids, tables, params, mask) * goal * mask[:, None, :]).sum())

    cache = {}
    gru.forward(ids, tables, params, mask, cache)
    grads, dx = gru.backward(goal * mask[:, None, :], params, cache, mask)
    for d, k in (("f", 0), ("b", 1)):
        for target, grad in ((params[f"u{d}"], grads[f"u{d}"]), (tables[k], gru.gather_rows(ids, dx[k], 5))):
            for at in np.ndindex(target.shape):
                kept = target[at]
                target[at] = kept + 1e-2
                up = loss()
                target[at] = kept - 1e-2
                down = loss()
                target[at] = kept
                # the slope is that of tanh, the activation a rational form of it
                assert abs((up - down) / 2e-2 - grad[at]) < 0.12 + 0.1 * abs(grad[at])


def test_segments_cover_every_byte_once():
    start, length, row = language_id.segments(np.zeros(250, np.uint8), np.array([0, 0, 96, 193, 250]), 96)
    seen = np.concatenate([np.arange(a, a + n) for a, n in zip(start, length)])
    assert sorted(seen) == list(range(250)) and row.tolist() == [1, 2, 2, 3]


def test_windows_cover_every_word_and_overlap():
    counts = np.array([0, 1, 48, 49, 200])
    first = np.concatenate([[0], np.cumsum(counts)])
    start, length, row = toxicity.windows(counts, first)
    for r, n in enumerate(counts):
        own = [(a - first[r], m) for a, m, k in zip(start, length, row) if k == r]
        assert sorted({w for a, m in own for w in range(a, a + m)}) == list(range(n))
    assert (length <= toxicity.WINDOW).all()


def test_language_accuracy_on_held_out_documents(spark):
    found = queries.QUERIES["op3_language_id"](spark, SF).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas().set_index("doc_id")
    assert len(found) == len(docs)
    assert [zlib.crc32(str(i).encode()) % 3 == 1 for i in found.index] == found["held_out"].tolist()
    held = found[found["held_out"]]
    assert (held["lang_pred"] == docs.loc[held.index, "lang"]).mean() > 0.97
    assert found["score"].between(0, 1).all()


def test_quality_and_toxicity_on_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id")
    good = queries.QUERIES["op6_quality"](spark, SF).toPandas().set_index("doc_id")
    good = good[good["held_out"]].join(labels, how="inner")
    assert ((good["tail_prob"] >= 0.5) == (good["quality"] == 1)).mean() > 0.95
    more = SF.replace("0.01", "0.1")  # rare words take more labels than the small tables have
    labels = spark.read.parquet(f"{more}/labels.parquet").toPandas().set_index("doc_id")
    toxic = queries.QUERIES["op7_toxicity"](spark, more).toPandas().set_index("doc_id")
    assert ((toxic["score"] >= 0.5) == (toxic["predicted"] == 1)).all()
    toxic = toxic[toxic["held_out"]].join(labels, how="inner")
    assert toxic[toxic["toxic"] == 1]["predicted"].mean() > 0.65
    assert toxic[toxic["toxic"] == 0]["predicted"].mean() < 0.03


@pytest.mark.parametrize("grades", [2, 4])
def test_ordinal_regression_orders_grades(grades):
    rng = np.random.default_rng(2)
    texts, y = [], []
    for _ in range(400):
        g = int(rng.integers(grades))
        texts.append(" ".join(rng.choice(["bad", "fine"], p=[1 - g / (grades - 1), g / (grades - 1)]) if rng.random() < 0.6 else f"w{rng.integers(50)}" for _ in range(60)))
        y.append(g)
    model = quality.train(texts, y)
    assert (np.diff(model.thresholds) > 0).all() and len(model.thresholds) == grades - 1
    f, _ = quality.f_values(pa.array(texts), model.weights)
    above = model.at_least(f)
    assert (np.diff(above, axis=1) <= 1e-12).all()
    assert np.corrcoef(above.sum(axis=1), y)[0, 1] > 0.9


def test_share_slots_stay_in_range():
    w_values, counts = quality.f_values(pa.array(["A A A A", None, "", "é!", "a b c d a b c d"]), np.ones(quality.SIZE))
    assert counts.tolist() == [4, 0, 0, 1, 8] and w_values[1] == w_values[2] == 0


def test_odd_documents(spark, odd_docs, no_docs):
    model = language_id.train([b"the and of that with"] * 5 + [b"der und die nicht mit"] * 5, ["en"] * 5 + ["de"] * 5, epochs=2)
    rows = language_id.identify(odd_docs, model).collect()
    assert len(rows) == 10 and {r.lang_pred for r in rows if r.doc_id in (2, 3, 4, 7)} == {"und"}
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    assert language_id.identify(odd_docs, None).where("lang_pred <> 'und'").count() == 0
    ordinal = quality.train(["good text here", "bad"], [1, 0], rounds=5)
    rows = quality.score(odd_docs, ordinal).collect()
    assert len(rows) == 10 and all(not r.keep and r.tail_prob == 0 for r in rows if r.doc_id in (2, 3, 4))
    net = toxicity.train(["you idiot"] * 4 + ["a nice day"] * 4, [1] * 4 + [0] * 4, rounds=1)
    rows = toxicity.score(odd_docs, net).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows) and all(r.score == 0 for r in rows if r.doc_id in (2, 3, 4))
    for frame in (language_id.identify(no_docs, model), quality.score(no_docs, ordinal), toxicity.score(no_docs, net)):
        assert frame.count() == 0


def test_nothing_to_learn_from(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert language_id.fit(no_docs) is None
    assert quality.fit(no_docs, labels.withColumnRenamed("quality", "grade")) is None
    assert toxicity.fit(no_docs, labels) is None
