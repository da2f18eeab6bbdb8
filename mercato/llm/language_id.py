"""Language ID: multilingual mixtures by expectation-maximisation.

Each language is a multinomial over hashed byte trigrams. A word's likelihood
under a language is the product of its trigrams'; a document is a mixture of
languages whose proportions EM estimates from its words. The language set
grows from the best single language, adding the next most probable one while
the penalised log-likelihood (penalty x log(words) for each language) rises.

Defined results: NULL text and text without a letter are ``und`` with score 0
and no proportions; with no training rows every document is. Ties go to the
first language in code-point order. Repeated rows get equal results; extra
columns are carried along, those named as a result are replaced. A text is
read whole, in pieces of about 2 MB at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import apart, lower_table, row_slices, text_bytes, with_arrow_columns, word_spans

BITS = 16


@dataclass(frozen=True)
class LanguageModel:
    """Languages in code-point order and the log-probability of each trigram bucket (2^16 x languages)."""

    languages: tuple[str, ...]
    table: np.ndarray


def _letters() -> np.ndarray:
    """Byte table: A-Z to lower case, digits to 0, everything else below 128 that is no letter to a space."""
    t = lower_table()
    t[:128][~np.isin(np.arange(128), np.frombuffer(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", np.uint8))] = 32
    t[48:58] = 48
    return t


def _buckets(data: np.ndarray) -> np.ndarray:
    """Trigram bucket at each byte: it and the two before (spaces before the first)."""
    b = np.full(len(data) + 2, 32, np.uint32)
    b[2:] = _letters()[data]
    code = (b[2:] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[:-2]
    with np.errstate(over="ignore"):
        return ((code + np.uint32(1)) * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def word_likelihoods(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray,
                     piece: int = 1 << 21) -> np.ndarray:
    """Log-likelihood of each word under each language; the byte before a word counts as a space."""
    out = np.zeros((len(starts), table.shape[1]), np.float32)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + piece, "right")))
        part = np.ascontiguousarray(data[starts[lo]:ends[hi - 1]])
        s, e = starts[lo:hi] - starts[lo], ends[lo:hi] - starts[lo]
        at = _buckets(part)
        inside = np.zeros(len(part) + 1, np.int8)
        inside[s] += 1
        inside[e] -= 1
        keep = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        length = e - s
        out[lo:hi] = np.add.reduceat(table[at[keep]], np.concatenate([[0], np.cumsum(length)[:-1]]), axis=0)
        lo = hi
    return out


def _em(like: np.ndarray, first: np.ndarray, start: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and mixture log-likelihoods of documents whose words begin at ``first`` (each has some).

    ``like`` holds words' likelihoods scaled to a maximum of 1.
    """
    count = np.diff(np.append(first, len(like)))
    pi = start
    for _ in range(rounds):
        share = like * np.repeat(pi, count, axis=0)
        share /= share.sum(1, keepdims=True) + np.float32(1e-30)
        pi = np.add.reduceat(share, first, axis=0) / count[:, None].astype(np.float32)
    total = (like * np.repeat(pi, count, axis=0)).sum(1)
    return pi, np.add.reduceat(np.log(total + 1e-30, dtype=np.float64), first)


def mixtures(scores: np.ndarray, first: np.ndarray, rounds: int = 6, penalty: float = 1.0) -> np.ndarray:
    """Proportions (documents x languages) on the language set that the penalised likelihood selects."""
    count = np.diff(np.append(first, len(scores)))
    like = np.exp(scores - scores.max(1, keepdims=True))
    n, langs = len(first), scores.shape[1]
    full, _ = _em(like, first, np.full((n, langs), 1 / langs, np.float32), rounds)
    one = np.add.reduceat(np.log(like + 1e-30, dtype=np.float64), first, axis=0)
    best = one.argmax(1)
    chosen = np.zeros((n, langs), bool)
    chosen[np.arange(n), best] = True
    pi, value = chosen.astype(np.float32), one[np.arange(n), best]
    active = np.arange(n)
    cost = penalty * np.log(count + 1)
    for _ in range(langs - 1):
        if not len(active):
            break
        nxt = np.where(chosen[active], -1, full[active]).argmax(1)
        trial = chosen[active]
        trial[np.arange(len(active)), nxt] = True
        begin = np.where(trial, full[active] + np.float32(0.01), 0)
        begin /= begin.sum(1, keepdims=True)
        if len(active) == n:
            own, at = like, first
        else:
            rows = np.repeat(first[active] - np.append(0, np.cumsum(count[active])[:-1]), count[active]) + np.arange(count[active].sum())
            own, at = like[rows], np.append(0, np.cumsum(count[active])[:-1])
        got, worth = _em(own, at, begin.astype(np.float32), max(2, rounds - 2))
        better = worth - cost[active] > value[active]
        active, trial, got, worth = active[better], trial[better], got[better], worth[better]
        chosen[active], pi[active] = trial, got
        value[active] = worth  # without penalty: each further language pays its own
    return pi


def fit(docs: DataFrame, per_language: int = 4_000, smoothing: float = 0.5) -> LanguageModel:
    """Learns trigram multinomials from ``text`` and non-NULL ``lang``.

    A language with more than ``per_language`` rows is learnt from about that
    many (a documented bound), chosen by a hash of the id.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    langs = sorted(sizes)
    if not langs:
        return LanguageModel((), np.zeros((1 << BITS, 0), np.float32))
    number = F.create_map(*[F.lit(x) for k, lang in enumerate(langs) for x in (lang, k)])[F.col("lang")]
    share = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, per_language / sizes[lang]))])[F.col("lang")]
    spot = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(0))), F.lit(1_000_000)) / 1e6
    n = len(langs)

    def count(batches):
        total = np.zeros((n, 1 << BITS), np.int64)
        for batch in batches:
            data, off = text_bytes(batch.column(1))
            kinds = batch.column(0).to_numpy()
            for lo, hi in row_slices(off):
                part = data[off[lo]:off[hi]]
                starts, ends, at = word_spans(part, off[lo:hi + 1] - off[lo])
                inside = np.zeros(len(part) + 1, np.int8)
                inside[starts] += 1
                inside[ends] -= 1  # a word may end where the next row's begins
                keep = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
                key = _buckets(part).astype(np.int64) + (np.repeat(kinds[lo:hi], np.diff(off[lo:hi + 1])).astype(np.int64) << BITS)
                total += np.bincount(key[keep], minlength=n << BITS).reshape(n, -1)
        lang, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(bucket), pa.array(total[lang, bucket])], names=["lang", "bucket", "n"])

    got = (rows.where(spot < share).select(number.cast("int").alias("k"), "text").repartition(8)
           .mapInArrow(count, "lang long, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    counts = np.full((n, 1 << BITS), smoothing)
    counts[got.column("lang").to_numpy(), got.column("bucket").to_numpy()] += got.column("n").to_numpy()
    table = np.log(counts) - np.log(counts.sum(1, keepdims=True))
    return LanguageModel(tuple(langs), np.ascontiguousarray(table.T.astype(np.float32)))


def detect(docs: DataFrame, model: LanguageModel, rounds: int = 6, penalty: float = 1.0) -> DataFrame:
    """``docs`` plus ``lang_pred``, ``score`` (that language's proportion) and ``languages`` (proportions by language)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.table))  # plain values; 256 kB a language, whatever the corpus

    def make(batch):
        model = LanguageModel(*shared.value)
        n = batch.num_rows
        letters = batch.column(batch.schema.get_field_index("_letter")).to_numpy(zero_copy_only=False)
        data, off = text_bytes(batch.column(batch.schema.get_field_index("text")))
        pi = np.zeros((n, len(model.languages)), np.float32)
        for lo, hi in row_slices(off) if model.languages else ():
            part = data[off[lo]:off[hi]]
            starts, ends, at = word_spans(part, off[lo:hi + 1] - off[lo])
            some = np.flatnonzero(np.diff(at))
            if len(some):
                pi[lo + some] = mixtures(word_likelihoods(part, starts, ends, model.table), at[some], rounds, penalty)
        pi[~letters.astype(bool)] = 0
        best = pi.argmax(1) if pi.shape[1] else np.zeros(n, int)
        top = pi[np.arange(n), best] if pi.shape[1] else np.zeros(n)
        names = [model.languages[b] if t > 0 else "und" for b, t in zip(best, top)]
        spread = [[(model.languages[k], float(row[k])) for k in np.flatnonzero(row)] for row in pi]
        return [pa.array(names, pa.string()), pa.array(np.clip(top, 0, 1).astype(float)),
                pa.array(spread, pa.map_(pa.string(), pa.float64()))]

    docs, named_back = apart(docs, "_letter")
    flagged = docs.withColumn("_letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    return named_back(with_arrow_columns(flagged, make, "lang_pred string, score double, languages map<string,double>").drop("_letter"))
