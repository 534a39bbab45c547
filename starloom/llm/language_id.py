"""Language identification by a bidirectional gated recurrent network over bytes.

Every byte of every text is labelled: a text is cut into segments of
``SEGMENT`` bytes, both directions run over each, and a softmax gives language
probabilities at every position. A document's probabilities are the mean over
its positions.

Defined results: null text, or text without a letter, gives ``und`` and score 0.
Texts of any length are labelled whole. Rows are judged one by one, so repeated
ids and copies each get a row; equal probabilities go to the first language in
sorted order. Without a labelled row there is no model and all is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import gru
from starloom.llm.sampling import labelled_sample
from starloom.llm.words import extended, pieces, text_bytes

SEGMENT = 96
HIDDEN = 6
#: Bound of the fitting sample: rows, and segments of each row.
SAMPLE_ROWS, SAMPLE_SEGMENTS = 2_000, 3
UNKNOWN = "und"
_BATCH = 2_048  # segments that one step of the network works on


@dataclass
class LanguageModel:
    langs: list[str]
    params: gru.Params  # xf, xb: a byte's three gates; uf, ub; out, bias


def segments(data: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and row of each segment; no segment crosses a text."""
    lengths = np.diff(at)
    many = -(-lengths // size)
    row = np.repeat(np.arange(len(lengths)), many)
    rank = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    start = at[:-1][row] + rank * size
    return start, np.minimum(size, at[1:][row] - start), row


def _grid(data, start, length, size):
    """Byte ids [steps, segments] and where they are real."""
    step = np.arange(size)[:, None]
    mask = step < length[None, :]
    return data[np.where(mask, start[None, :] + step, 0)], mask


def _probabilities(states, params):
    """Softmax over languages at every position, [steps, languages, batch]."""
    logits = np.matmul(params["out"].T, states)
    logits += params["bias"][:, None]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def train(texts: list[bytes], langs: list[str], epochs: int = 6, seed: int = 1, rate: float = 0.01) -> LanguageModel | None:
    """Backpropagation through time on segments of the given texts; each language counts alike."""
    names = sorted(set(langs))
    if not names:
        return None
    rng = np.random.default_rng(seed)
    column = pa.array(texts, pa.large_binary()).cast(pa.large_string())
    data, at = text_bytes(column)
    start, length, row = segments(data, at, SEGMENT)
    order = rng.permutation(len(start))
    rank = np.zeros(len(texts), int)
    chosen = []
    for i in order:
        if rank[row[i]] < SAMPLE_SEGMENTS:
            rank[row[i]] += 1
            chosen.append(i)
    chosen = np.array(chosen, int)
    label = np.array([names.index(x) for x in langs])[row[chosen]] if len(chosen) else np.zeros(0, int)
    params = gru.init(HIDDEN, rng) | {f"x{d}": rng.normal(0, 0.3, (256, 3 * HIDDEN)).astype(np.float32) for d in "fb"}
    params |= {"out": rng.normal(0, 0.3, (2 * HIDDEN, len(names))).astype(np.float32), "bias": np.zeros(len(names), np.float32)}
    share = np.bincount(label, minlength=len(names))
    weight = (len(label) / np.maximum(share, 1) / len(names)).astype(np.float32)
    adam = gru.Adam(params, rate)
    for epoch in range(epochs):
        adam.rate = rate * (1 - epoch / epochs)
        for part in np.array_split(rng.permutation(len(chosen)), max(1, len(chosen) // 128)):
            if not len(part):
                continue
            ids, mask = _grid(data, start[chosen[part]], length[chosen[part]], SEGMENT)
            cache: dict = {}
            states = gru.forward(ids, (params["xf"], params["xb"]), params, mask, cache)
            grad = _probabilities(states, params)
            grad[:, label[part], np.arange(len(part))] -= 1
            grad *= (mask * (weight[label[part]] / np.float32(mask.sum())))[:, None, :]
            grads = {"out": np.einsum("thb,tlb->hl", states, grad, optimize=True), "bias": grad.sum(axis=(0, 2))}
            dstates = np.matmul(params["out"], grad)
            more, dx = gru.backward(dstates, params, cache, mask)
            grads |= more | {f"x{d}": gru.gather_rows(ids, g, 256) for d, g in zip("fb", dx)}
            adam.update(grads)
    return LanguageModel(names, params)


def predict(column: pa.Array, model: LanguageModel) -> np.ndarray:
    """Mean language probabilities of each text; zeros for an empty one."""
    data, at = text_bytes(column)
    start, length, row = segments(data, at, SEGMENT)
    out = np.zeros((len(at) - 1, len(model.langs)))
    order = np.argsort(-length, kind="stable")  # full segments together: their steps need no mask
    for a in range(0, len(order), _BATCH):
        part = order[a : a + _BATCH]
        size = int(length[part[0]])
        ids, mask = _grid(data, start[part], length[part], size)
        states = gru.forward(ids, (model.params["xf"], model.params["xb"]), model.params, None if mask.all() else mask)
        probabilities = _probabilities(states, model.params)
        if not mask.all():
            probabilities *= mask[:, None, :]
        sums = probabilities.sum(axis=0, dtype=np.float64)
        for j in range(len(sums)):
            out[:, j] += np.bincount(row[part], sums[j], len(out))
    return out / np.maximum(np.diff(at), 1)[:, None]


def fit(rows: DataFrame, key: str = "doc_id", lang: str = "lang", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> LanguageModel | None:
    """A model from rows with a text and a language; at most ``sample_rows`` of them are fetched."""
    sample = labelled_sample(rows.where(F.col(text).isNotNull() & F.col(lang).isNotNull()), key, [lang], sample_rows, text)
    return train([x.encode() for x in sample[text]], list(sample[lang]))


def identify(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score instead of the text. The result's own names win over clashing columns."""
    keep = [c for c in docs.columns if c not in (text, "lang_pred", "score")]
    source = docs.select(*keep, F.when(F.col(text).rlike("\\p{L}"), F.col(text)).alias("_text"))
    schema = extended(source.drop("_text").schema, "lang_pred string, score double")

    def score(batches):
        for batch in batches:
            for piece in pieces(batch, "_text", 1 << 20):
                column = piece.column(piece.schema.get_field_index("_text"))
                known = np.asarray(column.is_valid())
                if model is None:
                    best, top = np.full(len(column), UNKNOWN, object), np.zeros(len(column))
                else:
                    found = predict(column, model)
                    best, top = np.array(model.langs, object)[found.argmax(1)], found.max(1)
                best, top = np.where(known, best, UNKNOWN), np.where(known, top, 0.0)
                rest = [piece.column(piece.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(best, pa.string()), pa.array(np.clip(top, 0, 1))], [*keep, "lang_pred", "score"])

    return source.mapInArrow(score, schema)
