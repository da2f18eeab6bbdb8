"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word's input is an embedding of the word joined with the mean embedding of its
byte 3- to 5-grams (word edges included), so that inflected and unseen words are
read by their characters. Two gated recurrent layers read a window of words, one
from each end; attention pools their states, and a linear unit gives the
window's logit. All overlapping windows of a document are scored; the largest
logit, through a logistic curve fitted on documents that the net has not
learnt from, is the document's score.

Training sees document labels only: a toxic document's windows share the loss by
a soft maximum, each window of a clean document is an example of its own.

Defined results: a text without a letter or digit (NULL, empty, blank) scores 0.
With labels of one class or none, every score is the smoothed share of label 1.
Equal texts get equal scores; extra columns are carried along, those named as a
result are replaced. Texts are scored whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import (labelled_sample, lower_table, mix64, prefix_hash, row_slices, span_hash, text_bytes,
                                with_arrow_columns, word_spans)

WORD_BITS, GRAM_BITS = 14, 15
WORD_DIMS, GRAM_DIMS, STATES = 4, 12, 8


def plain_table() -> np.ndarray:
    """Byte table: lower case for A-Z, and a space for every ASCII byte that is no letter or digit."""
    t = lower_table()
    inside = np.zeros(128, bool)
    for first, last in (b"09", b"AZ", b"az"):
        inside[first:last + 1] = True
    t[:128][~inside] = 32
    return t


@dataclass
class Net:
    """Parameters by name; ``slope`` and ``shift`` are of the logistic curve."""

    weights: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None


def new_net(seed: int = 3) -> Net:
    rng = np.random.default_rng(seed)
    d = WORD_DIMS + GRAM_DIMS
    w = {"words": rng.normal(0, 0.05, (1 << WORD_BITS, WORD_DIMS)), "grams": rng.normal(0, 0.3, (1 << GRAM_BITS, GRAM_DIMS))}
    for side in "fb":
        w[f"in_{side}"] = rng.normal(0, d ** -0.5, (d, 3 * STATES))
        w[f"state_{side}"] = rng.normal(0, STATES ** -0.5, (STATES, 3 * STATES))
        w[f"bias_{side}"] = np.zeros(3 * STATES)
    w["attend"] = rng.normal(0, 0.3, 2 * STATES)
    w["out"] = rng.normal(0, 0.3, 2 * STATES)
    w["base"] = np.zeros(1)
    return Net({k: v.astype(np.float32) for k, v in w.items()})


# ------------------------------------------------------------------ inputs
def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray):
    """Word bucket, gram buckets and their offsets, of the words at the given spans."""
    length = ends - starts
    padded = length + 4  # three spaces before, one after
    at = np.append(0, np.cumsum(padded))
    buffer = np.full(int(at[-1]), 32, np.uint64)
    inner = np.repeat(at[:-1] + 3 - np.append(0, np.cumsum(length)[:-1]), length) + np.arange(length.sum())
    buffer[inner] = data[np.repeat(starts - np.append(0, np.cumsum(length)[:-1]), length) + np.arange(length.sum())]
    spot = np.ones(len(buffer), bool)
    for k in range(3):
        spot[at[:-1] + k] = False
    spot = np.flatnonzero(spot)  # grams end on the word's bytes and on the space after it
    with np.errstate(over="ignore"):
        three = buffer[spot] | buffer[spot - 1] << np.uint64(8) | buffer[spot - 2] << np.uint64(16)
        four = three | buffer[spot - 3] << np.uint64(24)
        five = four | np.where(spot >= 4, buffer[spot - 4], 32).astype(np.uint64) << np.uint64(32)
    first = np.zeros(len(spot), bool)
    first[np.append(0, np.cumsum(length + 1)[:-1])] = True
    five = np.where(first, four, five)  # the byte before a word's own padding is not its own
    grams = np.stack([mix64(three), mix64(four | np.uint64(1 << 40)), mix64(five | np.uint64(1 << 41))], axis=1).ravel()
    return ((hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64), (grams >> np.uint64(64 - GRAM_BITS)).astype(np.int64),
            3 * np.append(0, np.cumsum(length + 1)))


def word_inputs(net: Net, words, grams, first) -> np.ndarray:
    count = np.diff(first)[:, None].astype(np.float32)
    chars = np.add.reduceat(net.weights["grams"][grams], first[:-1], axis=0) / np.sqrt(count)
    return np.concatenate([net.weights["words"][words], chars], axis=1)


def windows_of(counts: np.ndarray, width: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words, lengths and owners of the windows of texts with so many words; the last window ends with the text."""
    first = np.append(0, np.cumsum(counts)[:-1])
    number = np.where(counts > width, -(-(counts - width) // stride) + 1, (counts > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(counts)), number)
    k = np.arange(len(owner)) - np.repeat(np.append(0, np.cumsum(number)[:-1]), number)
    start = np.minimum(k * stride, np.maximum(counts[owner] - width, 0))
    return first[owner] + start, np.minimum(counts[owner], width), owner


# ------------------------------------------------------------------ the net
def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)


def run_gru(inputs, steps: int, state: np.ndarray, keep: bool):
    """States after each step, from ``inputs(t)`` (rows x 3 STATES: update, reset, candidate); ``keep`` for training."""
    h, all_h, cache = None, [], []
    s = STATES
    for t in range(steps):
        a = inputs(t)
        if h is None:
            h = np.zeros((len(a), s), np.float32)
        u = h @ state
        gates = _sigmoid(a[:, :2 * s] + u[:, :2 * s])
        z, r = gates[:, :s], gates[:, s:]
        n = np.tanh(a[:, 2 * s:] + r * u[:, 2 * s:])
        if keep:
            cache.append((h, z, r, n, u[:, 2 * s:]))
        h = n + z * (h - n)
        all_h.append(h)
    return all_h, cache


def back_gru(dh_all, cache, state: np.ndarray):
    """Gradients of the inputs by step and of ``state``."""
    d_state, after, d_in = np.zeros_like(state), 0.0, [None] * len(cache)
    for t in range(len(cache) - 1, -1, -1):
        h, z, r, n, q = cache[t]
        dh = dh_all[t] + after
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * z * (1 - z)
        dr = dn * q * r * (1 - r)
        d_in[t] = np.concatenate([dz, dr, dn], axis=1)
        du = np.concatenate([dz, dr, dn * r], axis=1)
        d_state += h.T @ du
        after = dh * z + du @ state.T
    return d_in, d_state


def _pool(net: Net, ahead, behind):
    """Attention over the steps: states (steps, rows, 2 STATES), weights, pooled rows, logits."""
    states = np.concatenate([np.stack(ahead), np.stack(behind)], axis=2)
    e = states @ net.weights["attend"]
    e = np.exp(e - e.max(0))
    e /= e.sum(0)
    pooled = np.einsum("tb,tbd->bd", e, states)
    return states, e, pooled, pooled @ net.weights["out"] + net.weights["base"][0]


def window_logits(net: Net, table: tuple[np.ndarray, np.ndarray], ids: np.ndarray, batch: int = 8192) -> np.ndarray:
    """Logits of windows; ``ids`` (windows x words) point into the projected inputs of each direction."""
    out = np.empty(len(ids), np.float32)
    for lo in range(0, len(ids), batch):
        part = np.ascontiguousarray(ids[lo:lo + batch].T)
        steps = len(part)
        ahead, _ = run_gru(lambda t: table[0].take(part[t], axis=0), steps, net.weights["state_f"], False)
        behind, _ = run_gru(lambda t: table[1].take(part[steps - 1 - t], axis=0), steps, net.weights["state_b"], False)
        out[lo:lo + batch] = _pool(net, ahead, behind[::-1])[3]
    return out


def project(net: Net, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w = net.weights
    return x @ w["in_f"] + w["bias_f"], x @ w["in_b"] + w["bias_b"]


def _split(data: np.ndarray, off: np.ndarray):
    """Plain bytes, word spans, row offsets in words, word hashes."""
    data = plain_table()[data]
    starts, ends, at = word_spans(data, off)
    return data, starts, ends, at, span_hash(prefix_hash(data), starts, ends)


# ------------------------------------------------------------------ training
def _scatter(grad: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(index, kind="stable")
    rows, at = np.unique(index[order], return_index=True)
    return rows, np.add.reduceat(grad[order], at, axis=0)


def _gradients(net: Net, words, grams, first, ids):
    """Logits of equally long windows, and a function from their gradients to the parameters'."""
    w = net.weights
    x = word_inputs(net, words, grams, first)
    table = project(net, x)
    steps = ids.shape[1]
    part = np.ascontiguousarray(ids.T)
    ahead, cache_f = run_gru(lambda t: table[0].take(part[t], axis=0), steps, w["state_f"], True)
    behind, cache_b = run_gru(lambda t: table[1].take(part[steps - 1 - t], axis=0), steps, w["state_b"], True)
    states, e, pooled, logits = _pool(net, ahead, behind[::-1])

    def back(d: np.ndarray) -> dict:
        g = {"out": pooled.T @ d, "base": np.array([d.sum()], np.float32)}
        d_pool = d[:, None] * w["out"]
        d_e = np.einsum("tbd,bd->tb", states, d_pool)
        d_e = e * (d_e - (e * d_e).sum(0))
        g["attend"] = np.einsum("tb,tbd->d", d_e, states)
        d_states = e[:, :, None] * d_pool + d_e[:, :, None] * w["attend"]
        d_x = np.zeros_like(x)
        for side, s, cache, order in (("f", slice(0, STATES), cache_f, range(steps)), ("b", slice(STATES, None), cache_b, range(steps - 1, -1, -1))):
            d_in, g[f"state_{side}"] = back_gru([d_states[t][:, s] for t in order], cache, w[f"state_{side}"])
            flat = np.concatenate(d_in)
            at = np.concatenate([part[t] for t in order])
            rows, total = _scatter(flat, at)
            g[f"in_{side}"] = x[rows].T @ total
            g[f"bias_{side}"] = flat.sum(0)
            d_x[rows] += total @ w[f"in_{side}"].T
        g["words"] = _scatter(d_x[:, :WORD_DIMS], words)
        count = np.diff(first)
        per = d_x[:, WORD_DIMS:] / np.sqrt(count)[:, None].astype(np.float32)
        g["grams"] = _scatter(np.repeat(per, count, axis=0), grams)
        return g
    return logits, back


class Adam:
    def __init__(self, net: Net, rate: float):
        self.net, self.rate, self.t = net, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in net.weights.items()}
        self.v = {k: np.zeros_like(v) for k, v in net.weights.items()}

    def step(self, grads: dict) -> None:
        self.t += 1
        rate = self.rate * np.sqrt(1 - 0.999 ** self.t) / (1 - 0.9 ** self.t)
        for k, g in grads.items():
            at, g = g if isinstance(g, tuple) else (slice(None), g)
            self.m[k][at] = 0.9 * self.m[k][at] + 0.1 * g
            self.v[k][at] = 0.999 * self.v[k][at] + 0.001 * g * g
            self.net.weights[k][at] -= (rate * self.m[k][at] / (np.sqrt(self.v[k][at]) + 1e-7)).astype(np.float32)


def train(texts: list[bytes], y: np.ndarray, width: int, epochs: int, rate: float = 0.01, seed: int = 11) -> Net:
    """A net learnt from whole texts and their labels (windows that do not overlap), about 40 steps an epoch."""
    net, rng = new_net(), np.random.default_rng(seed)
    adam = Adam(net, rate)
    off = np.append(0, np.cumsum([len(t) for t in texts]))
    data, starts, ends, at, h = _split(np.frombuffer(b"".join(texts), np.uint8), off)
    size = np.diff(at)
    batch_words = int(np.clip(size.sum() // 40, 500, 24_000))
    for epoch in range(epochs):
        order = rng.permutation(np.flatnonzero(size >= 1))
        cuts = np.searchsorted(np.cumsum(size[order]), np.arange(batch_words, size[order].sum() + batch_words, batch_words))
        for part in np.split(order, np.unique(cuts[cuts < len(order)])):
            if not len(part):
                continue
            local = np.concatenate([np.arange(at[i], at[i + 1]) for i in part])
            kinds, index, where = np.unique(h[local], return_index=True, return_inverse=True)
            chosen = local[index]
            feats = word_features(data, starts[chosen], ends[chosen], h[chosen])
            shift = rng.integers(0, width) if epoch % 2 else 0
            begin, length, owner = windows_of(np.maximum(size[part] - (shift if shift else 0) * (size[part] > 2 * width), 0), width, width)
            skip = (shift * (size[part] > 2 * width)).astype(np.int64)
            base = np.append(0, np.cumsum(size[part])[:-1])
            rel = begin - np.append(0, np.cumsum(size[part] - skip)[:-1])[owner]
            begin = base[owner] + skip[owner] + rel
            grads: dict = {}
            logits, backs = np.zeros(len(begin), np.float32), []
            for n in np.unique(length):
                rows = np.flatnonzero(length == n)
                ids = where[begin[rows][:, None] + np.arange(n)]
                logits[rows], back = _gradients(net, *feats, ids)
                backs.append((rows, back))
            # a soft maximum shares a toxic text's loss among its windows; a clean text's windows count each
            top = np.full(len(part), -np.inf, np.float32)
            np.maximum.at(top, owner, logits)
            share = np.exp(2 * (logits - top[owner]))
            share /= np.bincount(owner, share, len(part))[owner]
            p = 1 / (1 + np.exp(-np.clip(logits, -20, 20)))
            number = np.bincount(owner, minlength=len(part))[owner]
            toxic = y[part][owner] == 1
            d = np.where(toxic, (p - 1) * share, p * np.maximum(share, 1 / np.sqrt(number))) / len(part)
            for rows, back in backs:
                for k, g in back(d[rows].astype(np.float32)).items():
                    if k not in grads:
                        grads[k] = g
                    elif isinstance(g, tuple):
                        both = np.concatenate([grads[k][0], g[0]])
                        grads[k] = _scatter(np.concatenate([grads[k][1], g[1]]), both)
                    else:
                        grads[k] = grads[k] + g
            adam.step(grads)
    return net


def document_logits(net: Net, data: np.ndarray, off: np.ndarray, width: int, stride: int) -> np.ndarray:
    """The largest window logit of each row (-inf without words)."""
    out = np.full(len(off) - 1, -np.inf, np.float32)
    data, starts, ends, at, h = _split(data, off)
    if not len(starts):
        return out
    kinds, index, where = np.unique(h, return_index=True, return_inverse=True)
    table = [np.empty((len(kinds), 3 * STATES), np.float32) for _ in range(2)]
    for lo in range(0, len(kinds), 1 << 15):
        at_words = index[lo:lo + (1 << 15)]
        x = word_inputs(net, *word_features(data, starts[at_words], ends[at_words], h[at_words]))
        for side, t in enumerate(project(net, x)):
            table[side][lo:lo + len(at_words)] = t
    begin, length, owner = windows_of(np.diff(at), width, stride)
    for n in np.unique(length):
        rows = np.flatnonzero(length == n)
        for lo in range(0, len(rows), 1 << 16):
            some = rows[lo:lo + (1 << 16)]
            got = window_logits(net, table, where[begin[some][:, None] + np.arange(n)])
            np.maximum.at(out, owner[some], got)
    return out


def fit(docs: DataFrame, labels: DataFrame, most: int = 2_000, width: int = 32, stride: int = 16, epochs: int = 8) -> Net:
    """Learns from at most ``most`` labelled documents (the documented bound), half of them toxic where there are so many."""
    share = labels.where("toxic IS NOT NULL").agg(F.avg(F.col("toxic").cast("int"))).first()[0]
    got = (labelled_sample(docs, labels, "toxic", most, balance=True).where("text IS NOT NULL")
           .orderBy(F.xxhash64("text"), "text").select("text", "_label").toArrow())
    y = got.column("_label").to_numpy().astype(np.int64)
    texts = [t.encode() for t in got.column("text").to_pylist()]
    if not len(y) or y.min() == y.max():
        return Net(new_net().weights, constant=float((y.sum() + 1) / (len(y) + 2)))
    fold = np.arange(len(y)) % 5 == 0
    net = train([t for t, f in zip(texts, fold) if not f], y[~fold], width, epochs)
    held = [t for t, f in zip(texts, fold) if f]
    logits = np.nan_to_num(document_logits(net, np.frombuffer(b"".join(held), np.uint8), np.append(0, np.cumsum([len(t) for t in held])), width, stride), neginf=-10.0)
    a, b, target = 1.0, 0.0, y[fold]
    for _ in range(500):  # the logistic curve, by gradient steps with a pull to slope 1
        p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
        a -= 0.05 * float(((p - target) * logits).mean() + 0.01 * (a - 1))
        b -= 0.2 * float((p - target).mean() + 0.01 * b)
    # the sample is balanced: move the curve to the labels' own share
    b += float(np.log(max(share, 1e-4) / max(1 - share, 1e-4)) - np.log((y == 1).mean() / (y == 0).mean()))
    net.slope, net.shift = max(a, 0.05), b
    return net


def score(docs: DataFrame, net: Net, width: int = 32, stride: int = 16) -> DataFrame:
    """``docs`` plus ``score`` and ``predicted`` (1 if the score reaches a half)."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(net))  # plain arrays and numbers; 2 MB, whatever the corpus

    def make(batch):
        net = Net(**shared.value)
        data, off = text_bytes(batch.column(batch.schema.get_field_index("text")))
        logits = np.full(batch.num_rows, -np.inf)
        for lo, hi in row_slices(off, 1 << 22):
            logits[lo:hi] = document_logits(net, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], width, stride)
        with np.errstate(over="ignore"):
            p = 1 / (1 + np.exp(-(net.slope * logits + net.shift)))
        if net.constant is not None:
            p = np.full(batch.num_rows, net.constant)
        return [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]
    return with_arrow_columns(docs, make, "score double, predicted int")
