"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Every text is read as overlapping windows of ``WINDOW`` words, ``STRIDE`` apart,
so that each word but those at the ends is seen in two of them. A word enters as its hashed
embedding beside the mean embedding of its character runs. Both directions run
over the window, attention weighs its positions, and the pooled state gives the
window's probability; a text's score is its largest window score.

The network is trained in numpy. Labels belong to texts, not to windows, so each
round picks a text's highest window and backpropagates through that one.

Defined results: null text and text without a word score 0. Texts of any length
are scored whole, each row by itself; nothing but the text enters a score.
Without a labelled row there is no model and every score is 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starloom.llm import gru
from starloom.llm.sampling import joined_sample
from starloom.llm.words import NOT_ALNUM, extended, pieces, words

WINDOW, STRIDE = 48, 24
HIDDEN, ATTENTION, DIM = 6, 6, 6
WORD_SLOTS, RUN_SLOTS, RUN = 1 << 14, 1 << 15, 6
#: Bound of the fitting sample, in labelled rows.
SAMPLE_ROWS = 4_000
#: A small sample is gone through more often, to this many steps.
LEAST_STEPS = 150
_BATCH = 2_048


@dataclass
class ToxicityModel:
    params: gru.Params


def _vocabulary(w):
    """Distinct words: the slot of each, its character runs' slots with offsets; and the number of each word of the text.

    A run is ``RUN`` bytes of the word between two blanks; a shorter word is one run.
    """
    distinct, at, number = np.unique(w.hashes, return_index=True, return_inverse=True)
    slot = (distinct >> np.uint64(64 - 14)).astype(np.int64)
    start, length = w.starts[at], (w.ends - w.starts)[at]
    size = np.maximum(length + 3 - RUN, 1)
    offset = np.concatenate([[0], np.cumsum(size)])
    word = np.repeat(np.arange(len(distinct)), size)
    first = np.arange(offset[-1]) - offset[:-1][word] - 1  # -1 is the blank before the word
    data = w.data.astype(np.uint32)
    code = np.zeros(len(word), np.uint32)
    for j in range(RUN):
        place = first + j
        inside = (place >= 0) & (place < length[word])
        code = code * np.uint32(0x85EBCA6B) + np.where(inside, data[np.where(inside, start[word] + place, 0)], 32).astype(np.uint32) + np.uint32(1)
        code ^= code >> np.uint32(15)
    code *= np.uint32(0x9E3779B1)
    return slot, (code >> np.uint32(32 - 15)).astype(np.int64), offset, number


def _subset(vocabulary, number):
    """The vocabulary of the given words only, which are numbered anew."""
    slot, runs, offset, _ = vocabulary
    used, number = np.unique(number, return_inverse=True)
    size = np.diff(offset)[used]
    ends = np.cumsum(size)
    flat = np.repeat(offset[used] - (ends - size), size) + np.arange(size.sum())
    return slot[used], runs[flat], np.concatenate([[0], ends]), number


def _vectors(vocabulary, params):
    slot, runs, offset, _ = vocabulary
    if not len(slot):
        return np.zeros((0, 2 * DIM), np.float32)
    mean = np.add.reduceat(params["runs"][runs], offset[:-1], axis=0) / np.diff(offset)[:, None].astype(np.float32)
    return np.concatenate([params["words"][slot], mean], axis=1)


def windows(counts: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, length and row of each window; together they cover every word."""
    many = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - WINDOW) // STRIDE)), 0)
    row = np.repeat(np.arange(len(counts)), many)
    start = (np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)) * STRIDE
    return first[:-1][row] + start, np.minimum(WINDOW, counts[row] - start), row


def _pool(states, mask, params):
    """Attention over positions: weights, squashed keys and pooled states."""
    keys = np.matmul(params["keys"].T, states)
    gru.squash(keys, np.empty_like(keys))
    e = np.einsum("tab,a->tb", keys, params["query"])
    np.clip(e, -30, 30, out=e)
    np.exp(e, out=e)
    if mask is not None:
        e *= mask
    e /= e.sum(axis=0)
    return e, keys, np.einsum("tb,thb->hb", e, states)


def _logits(ids, mask, tables, params, cache=None):
    states = gru.forward(ids, tables, params, mask, cache)
    alpha, keys, pooled = _pool(states, mask, params)
    return params["out"] @ pooled + params["bias"][0], (states, alpha, keys, pooled)


def _tables(vectors, params):
    return tuple(vectors @ params[f"in_{d}"] + params[f"shift_{d}"] for d in "fb")


def _grid(number, start, length):
    size = int(length.max())
    step = np.arange(size)[:, None]
    mask = step < length[None, :]
    return number[np.where(mask, start[None, :] + step, 0)], (None if mask.all() else mask)


def window_logits(w, params) -> tuple[np.ndarray, np.ndarray]:
    """The logit and the row of each window of all texts."""
    start, length, row = windows(w.counts, w.first)
    out = np.zeros(len(row))
    if len(row):
        vocabulary = _vocabulary(w)
        tables = _tables(_vectors(vocabulary, params), params)
        order = np.argsort(-length, kind="stable")
        for a in range(0, len(order), _BATCH):
            part = order[a : a + _BATCH]
            ids, mask = _grid(vocabulary[3], start[part], length[part])
            out[part] = _logits(ids, mask, tables, params)[0]
    return out, row


def predict(column: pa.Array, model: ToxicityModel) -> np.ndarray:
    w = words(column, NOT_ALNUM, lower=True)
    logit, row = window_logits(w, model.params)
    best = np.full(len(w.first) - 1, -np.inf)
    np.maximum.at(best, row, logit)
    return 1 / (1 + np.exp(-np.clip(best, -700, 700))) * np.isfinite(best)


def _odds(docs, slot, slots, label) -> np.ndarray:
    """Log odds of a positive text by slot, from the texts that have it, drawn to 0 where few have."""
    pair = np.unique(docs.astype(np.int64) * slots + slot)
    no, yes = (np.bincount(pair[label[pair // slots] == y] % slots, minlength=slots) for y in (0, 1))
    odds = np.log((yes + 0.5) / (max(label.sum(), 1) + 1)) - np.log((no + 0.5) / (max((1 - label).sum(), 1) + 1))
    return np.clip(odds, -2, 2) * (yes + no) / (yes + no + 4)


def _first_params(w, vocabulary, label, rng) -> gru.Params:
    """Random weights; the first dimension of words and runs starts at the smoothed log odds in the training texts."""
    params = gru.init(HIDDEN, rng)
    small = lambda *shape, s=0.1: rng.normal(0, s, shape).astype(np.float32)
    params |= {"words": small(WORD_SLOTS, DIM), "runs": small(RUN_SLOTS, DIM), "keys": small(2 * HIDDEN, ATTENTION, s=0.4), "query": small(ATTENTION, s=0.4), "out": small(2 * HIDDEN, s=0.4), "bias": np.full(1, -1.0, np.float32)}
    params |= {f"in_{d}": small(2 * DIM, 3 * HIDDEN, s=0.4) for d in "fb"} | {f"shift_{d}": np.zeros(3 * HIDDEN, np.float32) for d in "fb"}
    slot, runs, offset, number = vocabulary
    size = np.diff(offset)[number]
    flat = np.repeat(offset[number], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    for name, slots, owner, found in (("words", WORD_SLOTS, w.docs, slot[number]), ("runs", RUN_SLOTS, np.repeat(w.docs, size), runs[flat])):
        params[name][:, 0] = _odds(owner, found, slots, label)
    return params


def _step(w, vocabulary, start, length, target, weight, params) -> gru.Params:
    """Gradients of the weighted log loss of the given windows."""
    ids, mask = _grid(vocabulary[3], start, length)
    slot, runs, offset, number = vocabulary = _subset(vocabulary, ids.ravel())
    ids, vectors = number.reshape(ids.shape), _vectors(vocabulary, params)
    cache: dict = {}
    logit, (states, alpha, keys, pooled) = _logits(ids, mask, _tables(vectors, params), params, cache)
    g = ((1 / (1 + np.exp(-np.clip(logit, -60, 60))) - target) * weight / weight.sum()).astype(np.float32)
    grads = {"out": pooled @ g, "bias": np.array([g.sum()], np.float32)}
    dpooled = params["out"][:, None] * g
    dalpha = np.einsum("hb,thb->tb", dpooled, states)
    de = alpha * (dalpha - (alpha * dalpha).sum(axis=0))
    grads["query"] = np.einsum("tb,tab->a", de, keys)
    dkeys = params["query"][None, :, None] * de[:, None, :] * (1 - keys * keys)
    grads["keys"] = np.einsum("thb,tab->ha", states, dkeys, optimize=True)
    dstates = alpha[:, None, :] * dpooled + np.matmul(params["keys"], dkeys)
    more, dx = gru.backward(dstates, params, cache, mask)
    grads |= more
    dvec = np.zeros_like(vectors)
    for d, part in zip("fb", dx):
        dtable = gru.gather_rows(ids, part, len(vectors))
        grads[f"in_{d}"], grads[f"shift_{d}"] = vectors.T @ dtable, dtable.sum(axis=0)
        dvec += dtable @ params[f"in_{d}"].T
    grads["words"], grads["runs"] = np.zeros_like(params["words"]), np.zeros_like(params["runs"])
    np.add.at(grads["words"], slot, dvec[:, :DIM])
    size = np.diff(offset)
    np.add.at(grads["runs"], runs, np.repeat(dvec[:, DIM:] / size[:, None], size, axis=0))
    return grads


def train(texts: list[str], labels: list[int], rounds: int = 8, seed: int = 3, rate: float = 0.01) -> ToxicityModel | None:
    label = np.asarray(labels, int)
    if not len(label):
        return None
    rng = np.random.default_rng(seed)
    w = words(pa.array(texts, pa.large_string()), NOT_ALNUM, lower=True)
    vocabulary = _vocabulary(w)
    params = _first_params(w, vocabulary, label, rng)
    start, length, row = windows(w.counts, w.first)
    if not len(row):
        return ToxicityModel(params)
    positive = max(label.mean(), 1e-3)
    weight = np.where(label == 1, min(0.5 / positive, 4.0), 1.0)
    adam = gru.Adam(params, rate)
    batches = max(1, len(texts) // 128)
    rounds = max(rounds, -(-LEAST_STEPS // batches))
    for turn in range(rounds):
        logit, _ = window_logits(w, params)
        order = np.lexsort((-logit, row))
        top = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
        adam.rate = rate * (1 - turn / rounds)
        for part in np.array_split(rng.permutation(top), batches):
            adam.update(_step(w, vocabulary, start[part], length[part], label[row[part]], weight[row[part]], params))
    return ToxicityModel(params)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "toxic", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> ToxicityModel | None:
    """A model from at most ``sample_rows`` labelled rows; rows without a label or a text teach nothing."""
    sample = joined_sample(docs, labels.where(f"{label} is not null"), key, [label], sample_rows, text)
    return train(list(sample[text]), [int(x) for x in sample[label]])


def score(docs: DataFrame, model: ToxicityModel | None, text: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` with score and predicted (1 from ``least`` on) instead of the text. These names win over clashing columns."""
    keep = [c for c in docs.columns if c not in (text, "score", "predicted")]
    source = docs.select(*keep, text)
    schema = extended(docs.select(*keep).schema, "score double, predicted int")

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, text, 1 << 20):
                column = piece.column(piece.schema.get_field_index(text))
                found = np.zeros(len(column)) if model is None else predict(column, model)
                rest = [piece.column(piece.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(found), pa.array((found >= least).astype(np.int32))], [*keep, "score", "predicted"])

    return source.mapInArrow(run, schema)
