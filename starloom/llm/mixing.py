"""Mixing by soft membership: document rates whose expected domain token totals match targets.

A softmax regression on hashed words and byte trigrams, fitted on labelled
documents, gives each document's probability p of each domain. With t tokens, a
document used r times adds r * t * p to the domains' totals. The rates minimise the squared
distance of the totals to the targets by projected gradient from r = 1, in the metric
that weighs documents by their tokens:

    rate <- max(0, rate - step * p . (totals - targets) / tokens of the corpus)

Only the totals (one number for each domain) come to the driver in each round; the
step is the inverse of the largest eigenvalue of the domains' second moments. A domain with a small
part of the tokens moves slowly by such steps. So where a step leaves more than ``SLOW`` of the distance,
proximal steps of the same objective follow, each found by Newton's method on totals and second moments, until the tolerance
is met or, with a warning, nothing is gained.

Defined results: a text that is null or without a word has no tokens and no
membership, and keeps rate 1. Repeated rows are rated alike. Copies are
floor(rate + u) with u hashed from the key, so that they average the rate. Domains
without a target get the target 0; targets of unknown domains are spread over the known ones.
Without labelled rows there is one domain, "all". An empty table gives an empty table.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.quality import SIZE, _bytes_of_rows, _gram_slots, _rows_as_counts, _word_slots
from starloom.llm.sampling import joined_sample
from starloom.llm.words import extended, pieces, words
from starloom.runtime import cut_lineage

#: Bound of the fitting sample, in labelled rows.
SAMPLE_ROWS = 2_000
#: Gradient steps go on while each leaves at most this part of the distance.
SLOW = 0.75
#: Bound of the Newton rounds of a proximal step; reaching it is an error.
NEWTON = 200
#: Rounds between written copies of the rates, so that plans stay short.
_WRITE_EVERY = 8


@dataclass
class DomainModel:
    domains: list[str]
    weights: np.ndarray  # [slots, domains]
    bias: np.ndarray


def train(texts: list[str], labels: list[str], rounds: int = 60, rate: float = 0.3) -> DomainModel:
    """Full-batch softmax regression; each domain counts alike."""
    domains = sorted(set(labels)) or ["all"]
    y = np.array([domains.index(x) for x in labels], int)
    slots, values, rows = _rows_as_counts(texts)
    used, at = np.unique(slots, return_inverse=True)
    w, bias = np.zeros((len(used), len(domains))), np.zeros(len(domains))
    m, v = np.zeros_like(w), np.zeros_like(w)
    weight = 1 / np.maximum(np.bincount(y, minlength=len(domains)), 1)[y] / len(domains)
    for step in range(1, rounds + 1 if len(y) else 1):
        f = np.stack([np.bincount(rows, w[at, k] * values, len(y)) for k in range(len(domains))], axis=1) + bias
        p = np.exp(f - f.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        p *= weight[:, None]
        g = np.stack([np.bincount(at, values * p[rows, k], len(used)) for k in range(len(domains))], axis=1)
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        bias -= rate * p.sum(axis=0)
    weights = np.zeros((SIZE, len(domains)), np.float32)
    weights[used] = w
    return DomainModel(domains, weights, bias)


def posteriors(column: pa.Array, model: DomainModel) -> tuple[np.ndarray, np.ndarray]:
    """Domain probabilities of each text (zeros without words) and its number of words."""
    w = words(column)
    rows = len(w.first) - 1
    f = np.tile(model.bias, (rows, 1))
    if len(w.starts):
        lo, hi = _bytes_of_rows(w, rows)
        slot, gram = _word_slots(w), _gram_slots(w.data) if len(w.data) > 2 else np.zeros(0, np.int64)
        hi = np.maximum(np.minimum(hi - 2, len(gram)), 0)
        lo = np.minimum(lo, hi)
        for k in range(len(model.domains)):
            sums = np.concatenate([[0.0], np.cumsum(model.weights[gram, k], dtype=np.float64)])
            f[:, k] += np.bincount(w.docs, model.weights[slot, k], rows) / np.maximum(w.counts, 1) + (sums[hi] - sums[lo]) / np.maximum(hi - lo, 1)
    p = np.exp(f - f.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    return p * (w.counts > 0)[:, None], w.counts


def fit(docs: DataFrame, labels: DataFrame, domain: str, key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DomainModel:
    """A model from at most ``sample_rows`` rows of ``labels`` (key, domain)."""
    sample = joined_sample(docs, labels.where(F.col(domain).isNotNull()), key, [domain], sample_rows, text)
    return train(list(sample[text]), [str(x) for x in sample[domain]])


def memberships(docs: DataFrame, model: DomainModel, text: str = "text", keep: list[str] | None = None, moves: list[np.ndarray] | None = None) -> DataFrame:
    """The columns ``keep`` of every row with mix_tokens, mix_p (the domain probabilities) and, given the moves of a fit, mix_rate."""
    new = ["mix_tokens", "mix_p"] + ([] if moves is None else ["mix_rate"])
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    source = docs.select(*keep, F.col(text).alias("_mix_text"))
    schema = extended(source.drop("_mix_text").schema, "mix_tokens long, mix_p array<double>" + ("" if moves is None else ", mix_rate double"))

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "_mix_text"):
                p, n = posteriors(piece.column(piece.num_columns - 1), model)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * len(model.domains), pa.int32()), pa.array(p.ravel()))
                rest = [] if moves is None else [pa.array(rate_of(p, moves))]
                yield pa.RecordBatch.from_arrays([*piece.columns[:-1], pa.array(n), lists, *rest], [*keep, *new])

    return source.mapInArrow(run, schema)


def rate_of(p: np.ndarray, moves: list[np.ndarray]) -> np.ndarray:
    """The rates of documents with domain probabilities ``p`` [documents, domains]: a rate depends on them alone."""
    rate = np.ones(len(p))
    for move in moves:
        rate = np.maximum(0, rate - p @ move)
    return rate


def spread(targets: dict[str, float], domains: list[str]) -> np.ndarray:
    """Target shares in the order of the domains, adding up to 1."""
    share = np.array([max(0.0, targets.get(d, 0.0)) for d in domains])
    return share / share.sum() if share.sum() > 0 else np.full(len(domains), 1 / len(domains))


def rates(members: DataFrame, shares: np.ndarray, keep_all: bool = False, rounds: int = 60, tolerance: float = 1e-3) -> tuple[DataFrame, list[np.ndarray]]:
    """``members`` with mix_rate, and the moves that lead there. ``members`` must be a written table: it is read once a round.

    The mixture holds as many tokens as the corpus, or with ``keep_all`` so many that no domain has to be cut.
    At most ``rounds`` rounds are gradient steps; what they leave, or would need many rounds for, proximal steps finish.
    Targets that no rates meet give the nearest totals and a warning that names the distances.
    """
    k = len(shares)
    p = [F.col("mix_p")[i] for i in range(k)]
    tokens = F.col("mix_tokens")
    products = [(i, j) for i in range(k) for j in range(i, k)]
    sums = [F.sum(tokens).alias("n")] + [F.sum(tokens * p[i] * p[j]).alias(f"m{i}_{j}") for i, j in products]
    sums += [F.sum(tokens * p[i]).alias(f"t{i}") for i in range(k)]
    first = members.agg(*sums).first()
    size = float(first["n"] or 0)
    current = members.withColumn("mix_rate", F.lit(1.0))
    moves: list[np.ndarray] = []
    if size == 0:
        return current, moves

    def matrix(row) -> np.ndarray:
        out = np.zeros((k, k))
        for i, j in products:
            out[i, j] = out[j, i] = (row[f"m{i}_{j}"] or 0.0) / size
        return out

    def moved(move: np.ndarray):
        return F.greatest(F.lit(0.0), F.col("mix_rate") - sum((p[i] * float(move[i]) for i in range(k)), F.lit(0.0)))

    def look(move: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """After a move: distances to the goal, moments of what has a rate above 0, mean square of the rates."""
        rate, on = F.col("_rate"), F.col("_rate") > 0
        asked = [F.sum(rate * tokens * p[i]).alias(f"t{i}") for i in range(k)] + [F.sum(F.when(on, tokens * p[i] * p[j])).alias(f"m{i}_{j}") for i, j in products]
        row = current.withColumn("_rate", moved(move)).agg(*asked, F.sum(rate * rate * tokens).alias("square")).first()
        return np.array([(row[f"t{i}"] or 0.0) / size for i in range(k)]) - goal, matrix(row), (row["square"] or 0.0) / size

    moments = matrix(first)
    values = np.linalg.eigvalsh(moments)
    step = 1 / max(float(values[-1]), 1e-9)
    goal = shares.copy()
    if keep_all:
        goal *= max(first[f"t{i}"] / size / shares[i] for i in range(k) if shares[i] > 0)
    gap = np.array([first[f"t{i}"] / size for i in range(k)]) - goal
    for turn in range(1, rounds + 1):
        if np.abs(gap).max() <= tolerance * goal.max():
            return current, moves
        moves.append(step * gap)
        current, before = current.withColumn("mix_rate", moved(moves[-1])), gap
        if turn % _WRITE_EVERY == 0:
            current = cut_lineage(current)
        found = current.agg(*[F.sum(F.col("mix_rate") * tokens * p[i]).alias(f"t{i}") for i in range(k)]).first()
        gap = np.array([(found[f"t{i}"] or 0.0) / size for i in range(k)]) - goal
        if np.linalg.norm(gap) > SLOW * np.linalg.norm(before):
            break
    near, floor = (max(part * float(values[0]), least) for part, least in ((1e-3, 1e-7), (1e-6, 1e-9)))
    while np.abs(gap).max() > tolerance * goal.max():
        current, before = cut_lineage(current), gap
        move, gap = _proximal(look, goal, near)
        moves.append(move)
        current = current.withColumn("mix_rate", moved(move))
        if near <= floor and np.linalg.norm(gap) > 0.99 * np.linalg.norm(before):
            warnings.warn(f"no rates meet the targets; totals - targets, as shares of the corpus: {np.round(gap, 6).tolist()}", stacklevel=2)
            break
        near = max(near / 30, floor)
    return current, moves


def _proximal(look, goal: np.ndarray, near: float) -> tuple[np.ndarray, np.ndarray]:
    """The move x after which the distances to the goal are ``near`` * x, the proximal step of the squared distance, and these distances.

    x minimises half the mean square of the rates after the move + goal . x + near / 2 * x . x, which is convex with the
    gradient near * x - distances: Newton's method on the moments of the rates above 0, steps halved until they go down.
    """
    x = np.zeros(len(goal))
    gap, moments, square = look(x)
    value = square / 2
    for _ in range(NEWTON):
        slope = near * x - gap
        if np.abs(slope).max() <= 1e-9 * max(1.0, goal.max()):
            return x, gap
        way, length = -np.linalg.solve(moments + near * np.eye(len(goal)), slope), 1.0
        while True:
            y = x + length * way
            new_gap, new_moments, square = look(y)
            new = square / 2 + goal @ y + near / 2 * y @ y
            if new <= value + 1e-4 * length * (slope @ way) or np.abs(near * y - new_gap).max() <= 1e-9 * max(1.0, goal.max()):
                break
            if length < 1e-6:  # at the limit of the sums' precision
                return x, gap
            length /= 2
        x, value, gap, moments = y, new, new_gap, new_moments
    raise RuntimeError(f"the rates did not converge in {NEWTON} Newton rounds; distances to the targets {gap.tolist()}")


def copies(rate: str, *keys: str):
    """Whole copies of a document: the rate rounded up or down by a hash of its keys."""
    u = F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in keys], F.lit(11)), F.lit(1 << 40)) / float(1 << 40)
    return F.floor(F.col(rate) + u).cast("int")
