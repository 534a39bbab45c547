"""Quality by ordinal cumulative-link regression on graded ratings.

P(grade <= k) = sigmoid(threshold_k - f(text)). One set of hashed weights gives
f for all grades: the mean weight of the words, the mean weight of the byte
trigrams, and weights of binned shares (repetition, capitals, symbols, word
length). Thresholds are ordered by construction. A text gets its expected grade
and the tail probability P(grade >= cut); texts below the minimum tail go.

Defined results: null text and text without a word have expected grade and tail
0 and are rejected. Texts are scored whole, rows one by one. Without any rating
there is no model: everything with a word gets tail 1 and is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starloom.llm.sampling import joined_sample
from starloom.llm.words import extended, grams, pieces, words

WORD_BITS, GRAM_BITS, BINS = 17, 17, 16
SHARES = 5
#: Bound of the fitting sample, in rated rows.
SAMPLE_ROWS = 4_000
_WORDS, _GRAMS = 1 << WORD_BITS, 1 << GRAM_BITS
SIZE = _WORDS + _GRAMS + SHARES * BINS


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades

    def at_least(self, f: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1.. , [texts, grades - 1]."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - f[:, None], -60, 60)))


def _word_slots(w) -> np.ndarray:
    return (w.hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)


def _gram_slots(data: np.ndarray) -> np.ndarray:
    """A slot for each byte and the two after it."""
    x = data.astype(np.uint32)
    code = x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77) + x[2:] * np.uint32(0xC2B2AE3D)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x2C1B3C6D)
    return _WORDS + (code >> np.uint32(32 - GRAM_BITS)).astype(np.int64)


def _bytes_of_rows(w, rows: int) -> np.ndarray:
    """Offsets of the rows in the bytes, from the first to the last word of each."""
    return w.starts[np.minimum(w.first[:-1], len(w.starts) - 1)], w.ends[np.maximum(w.first[1:] - 1, 0)]


def _shares(w, rows: int) -> np.ndarray:
    """Slots of the binned shares, [rows, SHARES]."""
    n = np.maximum(w.counts, 1)
    same = np.zeros(len(w.hashes))
    same[1:] = (w.hashes[1:] == w.hashes[:-1]) & (w.docs[1:] == w.docs[:-1])
    three = grams(w.hashes, 3)
    inside = w.docs[2:] == w.docs[:-2] if len(w.docs) > 2 else np.zeros(0, bool)
    # a text's three-word runs that it already had
    owner = w.docs[: len(three)][inside].astype(np.uint64)
    keys = np.sort((owner << np.uint64(44)) | (three[inside] >> np.uint64(20)))
    again = keys[1:][keys[1:] == keys[:-1]] >> np.uint64(44)
    seen = np.bincount(again.astype(np.int64), minlength=rows) / np.maximum(n - 2, 1)
    length = w.ends - w.starts
    upper = np.concatenate([[0], np.cumsum((w.data >= 65) & (w.data <= 90))])
    letter = np.concatenate([[0], np.cumsum((w.data >= 128) | ((w.data | 32) >= 97) & ((w.data | 32) <= 122))])
    by = lambda x: np.bincount(w.docs, x, rows)
    total = np.maximum(by(length), 1)
    letters = by(letter[w.ends] - letter[w.starts])
    parts = [by(same) / n, seen, by(upper[w.ends] - upper[w.starts]) / np.maximum(letters, 1), 1 - letters / total, np.minimum(total / n / 20, 1)]
    slots = [np.minimum((np.clip(p, 0, 1) * BINS).astype(int), BINS - 1) + k * BINS for k, p in enumerate(parts)]
    return _WORDS + _GRAMS + np.stack(slots, axis=1)


def f_values(column: pa.Array, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """f of each text, and its number of words."""
    w = words(column)
    rows = len(w.first) - 1
    if not len(w.starts):
        return np.zeros(rows), w.counts
    out = np.bincount(w.docs, weights[_word_slots(w)], rows) / np.maximum(w.counts, 1)
    lo, hi = _bytes_of_rows(w, rows)
    sums = np.concatenate([[0.0], np.cumsum(weights[_gram_slots(w.data)])]) if len(w.data) > 2 else np.zeros(1)
    hi = np.maximum(np.minimum(hi - 2, len(sums) - 1), 0)
    lo = np.minimum(lo, hi)
    out += np.where(hi > lo, (sums[hi] - sums[lo]) / np.maximum(hi - lo, 1), 0)
    out += weights[_shares(w, rows)].sum(axis=1)
    return np.where(w.counts > 0, out, 0), w.counts


def _rows_as_counts(texts: list[str]):
    """Slots, values and rows of the sample's features."""
    slots, values, rows = [], [], []
    for i, text in enumerate(texts):
        w = words(pa.array([text]))
        if not len(w.starts):
            continue
        lo, hi = _bytes_of_rows(w, 1)
        gram = _gram_slots(w.data[lo[0] : hi[0]]) if hi[0] - lo[0] > 2 else np.zeros(0, np.int64)
        for found, size in ((_word_slots(w), len(w.starts)), (gram, len(gram)), (_shares(w, 1)[0], 1)):
            s, c = np.unique(found, return_counts=True)
            slots.append(s)
            values.append(c / max(size, 1))
            rows.append(np.full(len(s), i))
    join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
    return join(slots, np.int64), join(values, np.float64), join(rows, np.int64)


def train(texts: list[str], grades: list[int], rounds: int = 150, rate: float = 0.2, ridge: float = 1e-7) -> OrdinalModel | None:
    """Full-batch Adam on the cumulative-link likelihood. Grades are whole numbers from 0."""
    y = np.asarray(grades, int)
    if not len(y):
        return None
    slots, values, rows = _rows_as_counts(texts)
    used, at = np.unique(slots, return_inverse=True)
    n, k = len(y), max(int(y.max()) + 1, 2)
    share = np.clip(np.array([(y <= j).mean() for j in range(k - 1)]), 0.5 / n, 1 - 0.5 / n)
    start = np.maximum.accumulate(np.log(share / (1 - share)) + 1e-3 * np.arange(k - 1))
    low, gap = start[0], np.log(np.maximum(np.diff(start), 1e-3))
    theta = np.concatenate([[low], gap])
    w = np.zeros(len(used))
    state = [(np.zeros_like(x), np.zeros_like(x)) for x in (w, theta)]
    for step in range(1, rounds + 1):
        cuts = np.concatenate([[-np.inf], theta[0] + np.concatenate([[0], np.cumsum(np.exp(theta[1:]))]), [np.inf]])
        f = np.bincount(rows, w[at] * values, n)
        below = [1 / (1 + np.exp(-np.clip(cuts[y + j] - f, -60, 60))) for j in (0, 1)]
        slope = [b * (1 - b) * np.isfinite(cuts[y + j]) for j, b in enumerate(below)]
        p = np.maximum(below[1] - below[0], 1e-9)
        df = (slope[1] - slope[0]) / p / n
        dcut = np.bincount(y, -slope[1] / p / n, k)[: k - 1] + np.bincount(y, slope[0] / p / n, k)[1:]
        dtheta = np.concatenate([[dcut.sum()], np.exp(theta[1:]) * np.cumsum(dcut[::-1])[::-1][1:]])
        grads = (np.bincount(at, values * df[rows], len(used)) + ridge * w, dtheta)
        for x, g, (m, v) in zip((w, theta), grads, state):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= rate * (1 - step / (rounds + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    weights = np.zeros(SIZE)
    weights[used] = w
    return OrdinalModel(weights, theta[0] + np.concatenate([[0], np.cumsum(np.exp(theta[1:]))]))


def fit(docs: DataFrame, ratings: DataFrame, key: str = "doc_id", grade: str = "grade", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> OrdinalModel | None:
    """A model from at most ``sample_rows`` rated rows; rows without a grade or a text teach nothing."""
    sample = joined_sample(docs, ratings.where(f"{grade} is not null"), key, [grade], sample_rows, text)
    return train(list(sample[text]), [int(g) for g in sample[grade]])


def score(docs: DataFrame, model: OrdinalModel | None, cut: int = 1, least: float = 0.5, text: str = "text") -> DataFrame:
    """``docs`` with expected_grade, tail_prob = P(grade >= cut) and keep. These names win over clashing columns."""
    new = ("expected_grade", "tail_prob", "keep")
    source = docs.select(*[c for c in docs.columns if c not in new])
    schema = extended(source.schema, "expected_grade double, tail_prob double, keep boolean")
    names = source.columns

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, text):
                column = piece.column(piece.schema.get_field_index(text))
                if model is None:
                    counts = words(column).counts
                    expected = tail = (counts > 0).astype(float)
                else:
                    f, counts = f_values(column, model.weights)
                    above = model.at_least(f) * (counts > 0)[:, None]
                    expected = above.sum(axis=1)
                    tail = above[:, min(max(cut, 1), above.shape[1]) - 1]
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(expected), pa.array(tail), pa.array((tail >= least) & (counts > 0))], [*names, *new])

    return source.mapInArrow(run, schema)
