"""Quality classifier: naive Bayes features in a support vector machine.

Word unigrams and bigrams of a document, hashed to 2^18 indicators, are scaled
by the log ratio of their (smoothed) document counts in the two classes. On the
scaled vectors, of length 1, dual coordinate descent fits a linear machine with
hinge loss; its weights are drawn towards their mean magnitude by ``beta`` as
in the usual interpolation. A logistic curve, fitted on a fifth of the sample
that the machine has not seen, turns margins into scores from 0 to 1.

Defined results: NULL, empty and blank texts have no indicator and score as the
curve's value at margin 0. With labels of one class or none, every score is the
smoothed share of label 1. Equal texts get equal scores; extra columns are
carried along, those named as a result are replaced. Texts are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import labelled_sample, mix64, prefix_hash, row_slices, span_hash, text_bytes, with_arrow_columns, word_spans

BITS = 18


@dataclass(frozen=True)
class MarginModel:
    """``weights`` x ``ratios`` by indicator, the squared ratios for the length, bias and the logistic curve."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    shift: float


def indicators(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct indicators of each row, concatenated, and the rows' offsets."""
    starts, ends, at = word_spans(data, off)
    h = span_hash(prefix_hash(data), starts, ends)
    row = np.repeat(np.arange(len(off) - 1), np.diff(at))
    shift = np.uint64(64 - BITS)
    with np.errstate(over="ignore"):
        pairs = mix64(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:])[row[:-1] == row[1:]]
    keys = np.concatenate([(row << BITS) | (h >> shift).astype(np.int64),
                           (row[:-1][row[:-1] == row[1:]] << BITS) | (pairs >> shift).astype(np.int64)])
    keys = np.unique(keys)
    return (keys & ((1 << BITS) - 1)).astype(np.int32), np.searchsorted(keys >> BITS, np.arange(len(off)))


def dual_descent(first: np.ndarray, index: np.ndarray, value: np.ndarray, y: np.ndarray, size: int, c: float,
                 rounds: int, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear machine with hinge loss (rows of length 1, and a constant 1 as the bias input)."""
    w, b = np.zeros(size), 0.0
    alpha, sign = np.zeros(len(y)), np.where(y > 0, 1.0, -1.0)
    norm = np.add.reduceat(value * value, first[:-1]) + 1.0 if len(value) else np.ones(len(y))
    share = np.where(y > 0, (y == 0).mean(), (y > 0).mean()) * 2  # both classes weigh alike
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(y)):
            lo, hi = first[i], first[i + 1]
            ix, v = index[lo:hi], value[lo:hi]
            gradient = sign[i] * (w[ix] @ v + b) - 1.0
            new = min(max(alpha[i] - gradient / norm[i], 0.0), c * share[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                w[ix] += step * v
                b += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3 * c:
            break
    return w, b


def _logistic(margin: np.ndarray, y: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """Slope and shift of the logistic curve through (margin, label), by damped Newton steps."""
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - y) * margin).sum() + 1e-3 * a, (p - y).sum()])
        s = p * (1 - p) + 1e-9
        hess = np.array([[(s * margin * margin).sum() + 1e-3, (s * margin).sum()], [(s * margin).sum(), s.sum()]])
        step = np.linalg.solve(hess, g)
        step /= max(1.0, np.abs(step).max())
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame, most: int = 8_000, smoothing: float = 1.0, c: float = 1.0,
        rounds: int = 15, beta: float = 0.9) -> MarginModel:
    """Learns from at most ``most`` labelled documents (the documented bound), half good and half bad where there are so many."""
    def features(batches):
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            for lo, hi in row_slices(off):
                ix, first = indicators(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ix))],
                    names=["y", "ix"])

    sample = labelled_sample(docs, labels, "quality", most, balance=True)
    share = labels.where("quality IS NOT NULL").agg(F.avg(F.col("quality").cast("int"))).first()[0]
    got = sample.select("_label", "text").mapInArrow(
        features, "y int, ix array<int>").toArrow()
    size = 1 << BITS
    lists = got.column("ix").combine_chunks()
    y = got.column("y").to_numpy().astype(np.int64)
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 1) / (len(y) + 2)
        return MarginModel(np.zeros(size, np.float32), np.zeros(size, np.float32), 0.0, 1.0, float(np.log(rate / (1 - rate))))
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    first, index = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy()
    order = np.lexsort([np.add.reduceat(np.append(index, 0).astype(np.int64), np.minimum(first[:-1], len(index))), np.diff(first), y])
    parts = [index[first[i]:first[i + 1]] for i in order]  # the same order whatever the tasks
    y, first = y[order], np.append(0, np.cumsum([len(p) for p in parts]))
    index = np.concatenate(parts)
    owner = np.repeat(y, np.diff(first))
    good = np.bincount(index[owner == 1], minlength=size) + smoothing
    bad = np.bincount(index[owner == 0], minlength=size) + smoothing
    ratio = np.where(good + bad > 2 * smoothing, np.log(good / (y == 1).sum()) - np.log(bad / (y == 0).sum()), 0.0)
    value = ratio[index]
    length = np.sqrt(np.add.reduceat(np.append(value * value, 0.0), np.minimum(first[:-1], len(index))) * (np.diff(first) > 0))
    value = value / np.repeat(np.maximum(length, 1e-12), np.diff(first))

    def margins(w, b, rows):
        return np.array([w[index[first[i]:first[i + 1]]] @ value[first[i]:first[i + 1]] + b for i in rows])

    def machine(rows):
        lens = np.diff(first)[rows]
        at = np.append(0, np.cumsum(lens))
        flat = np.concatenate([np.arange(first[i], first[i + 1]) for i in rows]) if len(rows) else np.zeros(0, int)
        keep = lens > 0
        w, b = dual_descent(np.append(at[:-1][keep], at[-1]), index[flat], value[flat], y[rows][keep], size, c, rounds)
        used = w != 0
        mean = np.abs(w[used]).mean() if used.any() else 0.0
        return np.where(used, (1 - beta) * mean * np.sign(w) + beta * w, 0.0), b

    fold = np.arange(len(y)) % 5 == 0
    seen, unseen = np.flatnonzero(~fold), np.flatnonzero(fold)
    w, b = machine(seen)
    slope, shift = _logistic(margins(w, b, unseen), y[unseen])
    # the sample is balanced: move the curve to the labels' own share
    shift += float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)) - np.log((y == 1).mean() / (y == 0).mean()))
    w, b = machine(np.arange(len(y)))
    return MarginModel((w * ratio).astype(np.float32), (ratio * ratio).astype(np.float32), b, slope, shift)


def score(docs: DataFrame, model: MarginModel, threshold: float = 0.3) -> DataFrame:
    """``docs`` plus ``score`` and ``predicted`` (1 if the score reaches ``threshold``)."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain values: two tables of 2^18 numbers

    def make(batch):
        m = MarginModel(**shared.value)
        data, off = text_bytes(batch.column(batch.schema.get_field_index("text")))
        margin = np.full(batch.num_rows, m.bias)
        for lo, hi in row_slices(off):
            ix, first = indicators(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            some = np.flatnonzero(np.diff(first))
            if len(some):
                at = first[:-1][some]
                dot = np.add.reduceat(m.weights[ix].astype(np.float64), at)
                margin[lo + some] += dot / np.sqrt(np.maximum(np.add.reduceat(m.squares[ix].astype(np.float64), at), 1e-12))
        p = 1 / (1 + np.exp(-np.clip(m.slope * margin + m.shift, -30, 30)))
        return [pa.array(p), pa.array((p >= threshold).astype(np.int32))]
    return with_arrow_columns(docs, make, "score double, predicted int")
