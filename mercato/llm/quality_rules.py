"""Quality rules: fixed base rules, then a hashed n-gram log-likelihood ratio of trusted against raw text.

Unigrams and bigrams of words are hashed to buckets. Two multinomials with
add-``smoothing`` estimates, one of all trusted documents and one of the whole
corpus, give each bucket a log ratio; a document's ratio is the mean over its
n-grams, and one fixed cut decides every document.

One scan counts both: a trusted id is a bit of a bitmap (a row for 32,768 ids,
4 KB), and documents meet the bitmaps, not the ids, so no text is shuffled while
the bitmaps stay below ``most_bitmaps`` (beyond, documents are shuffled by
bitmap). Tasks add up their n-grams before the shuffle. Vocabularies grow about
as the square root of the text, and so do the buckets: 4 sqrt(bytes), a power of
two, 2^15 at least: 2^20 at 50 GB of text, 2^26 at 170 TB. That bounds the
counts a task sends and the model, which scoring reads as one array literal of 2
bytes a bucket. All of it is DataFrame functions, no Python on executors.

Defined results: NULL, empty or blank text has no words, fails the base rules
and gets ratio 0. Without trusted rows the ratio is 0 for all, so that the base
rules alone decide; an empty table gives an empty result. Repeated rows are
judged row by row, and each counts in the multinomials; an id labelled twice is
trusted if one label is good. Other input columns are carried along, and those
with the name of a result are replaced.
"""

from __future__ import annotations

from math import isqrt, log

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import apart, words_column, written

BASE_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def _grams(buckets: int):
    """Buckets of the unigrams and bigrams of ``_w``."""
    def gram(w, i):
        pair = F.when(i + 1 < F.size("_w"), F.pmod(F.xxhash64(w, F.get("_w", i + 1)), F.lit(buckets)))
        return F.array(F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"), pair.cast("int"))
    return F.transform("_w", gram)


def _bit(bitmap, place):
    """Whether a bit of a bitmap (bytes, lowest bit first) is set; false for NULL."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.pmod(F.floor(byte / F.pow(F.lit(2), place.bitwiseAND(7))), F.lit(2)) == 1, F.lit(False))


def with_trusted(docs: DataFrame, labels: DataFrame, most_bitmaps: int = 1 << 14) -> DataFrame:
    """``docs`` plus ``_trusted``: whether its id is labelled good. Bitmaps of ids up to ``most_bitmaps`` (64 MB) are broadcast."""
    key = F.col("doc_id").cast("long")
    good = labels.where((F.col("quality") == 1) & key.isNotNull())
    bitmaps = written(good.groupBy(F.bitmap_bucket_number(key).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("_bits")), "trusted")
    side = F.broadcast(bitmaps) if bitmaps.count() <= most_bitmaps else bitmaps
    flag = _bit(F.col("_bits"), F.bitmap_bit_position(key))
    return (docs.withColumn("_own", F.bitmap_bucket_number(key)).join(side, F.col("_own") == F.col("_bucket"), "left")
            .withColumn("_trusted", flag).drop("_own", "_bucket", "_bits"))


def gram_counts(docs: DataFrame, labels: DataFrame, buckets: int, **sizes) -> DataFrame:
    """(id, raw, trusted): n-grams of all documents and of all those labelled good, by bucket; a written table."""
    grams = (with_trusted(docs.select("doc_id", "text"), labels, **sizes).select("_trusted", words_column(F.col("text")).alias("_w"))
             .select("_trusted", F.explode(F.flatten(_grams(buckets))).alias("id")).where("id IS NOT NULL"))
    return written(grams.groupBy("id").agg(F.count(F.lit(1)).alias("raw"), F.count(F.when(F.col("_trusted"), 1)).alias("trusted")), "grams")


def bucket_count(docs: DataFrame) -> int:
    """4 sqrt(bytes of text), up to a power of two, 2^15 at least."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return 1 << max(15, (4 * isqrt(size) - 1).bit_length())


def fit(docs: DataFrame, labels: DataFrame, buckets: int | None = None, smoothing: float = 1.0) -> np.ndarray:
    """The log ratio of each bucket in hundredths of a nat, from all documents and all those labelled good."""
    buckets = buckets or bucket_count(docs)
    counts = gram_counts(docs, labels, buckets)
    raw, trusted = (n or 0 for n in counts.agg(F.sum("raw"), F.sum("trusted")).first())
    if not trusted:
        return np.zeros(buckets, np.int16)
    shift = log((raw + smoothing * buckets) / (trusted + smoothing * buckets))
    weight = F.bround(100 * (F.log((F.col("trusted") + smoothing) / (F.col("raw") + smoothing)) + shift)).cast("short")
    model = np.full(buckets, round(100 * shift), np.int16)
    lists = counts.groupBy(F.shiftright("id", 15).alias("part")).agg(F.sort_array(F.collect_list(F.struct("id", weight.alias("w")))).alias("l"))
    got = written(lists.select(F.transform("l", lambda x: x["id"]).alias("id"), F.transform("l", lambda x: x["w"]).alias("w")), "ratios")
    for batch in got.toArrow().to_batches():
        model[batch.column(0).flatten().to_numpy()] = batch.column(1).flatten().to_numpy()
    return model


def rules(docs: DataFrame, model: np.ndarray | list[int], cut: float = -0.08, min_words: int = 50,
          max_repeat_percent: int = 50) -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``ratio`` and ``kept``.

    ``n_repeat_words`` sorts the 3-word windows by the high bits of their hashes,
    each with its place in the low bits, so that equal windows are neighbours;
    those that have such a neighbour are sorted again by their whole hashes.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    made = [*BASE_COLUMNS, "ratio", "kept"]
    docs, named_back = apart(docs.drop(*made), "_w", "_bits", "_s", "_p", "_l")
    # never deterministic to the optimiser: a filter on a result must not carry the splitting into the loops over its words
    w = docs.withColumn("_w", F.when(F.monotonically_increasing_id() >= 0, words_column(F.col("text"))))
    w = w.withColumn("_bits", F.length(F.bin(F.size("_w"))))
    w = w.withColumn("_s", F.expr("""
        CASE WHEN size(_w) < 3 THEN cast(array() AS array<bigint>)
        ELSE sort_array(transform(slice(_w, 1, size(_w) - 2), (x, i) ->
          shiftleft(xxhash64(x, get(_w, i + 1), get(_w, i + 2)), _bits) | i)) END"""))
    w = w.withColumn("_s", F.expr("""
        sort_array(transform(filter(_s, (x, i) ->
            coalesce(shiftright(x, _bits) = shiftright(get(_s, i + 1), _bits), false)
            OR coalesce(shiftright(x, _bits) = shiftright(get(_s, i - 1), _bits), false)),
          x -> named_struct('h', xxhash64(get(_w, cast(x & (shiftleft(1L, _bits) - 1L) AS int)),
              get(_w, cast(x & (shiftleft(1L, _bits) - 1L) AS int) + 1), get(_w, cast(x & (shiftleft(1L, _bits) - 1L) AS int) + 2)),
            'p', x & (shiftleft(1L, _bits) - 1L))))"""))
    w = w.withColumn("_p", F.expr("""
        sort_array(transform(filter(_s, (x, i) ->
            coalesce(x.h = get(_s, i + 1).h, false) OR coalesce(x.h = get(_s, i - 1).h, false)), x -> x.p))"""))
    w = w.withColumn("_l", F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<int>")  # folded to one literal
    w = w.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.char_length(F.array_join("_w", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "n_repeat_words": F.expr("""
            aggregate(_p, named_struct('last', -3L, 'n', 0L), (a, x) ->
              named_struct('last', x, 'n', a.n + least(3L, x - a.last)), a -> a.n)"""),
        "ratio": F.aggregate(
            _grams(len(model)), F.lit(0).cast("long"),
            lambda a, g: a + F.get(table, g[0]) + F.coalesce(F.get(table, g[1]), F.lit(0))
        ) / (100 * F.greatest(2 * F.size("_w") - 1, F.lit(1))),
    })
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    w = w.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("ratio") >= cut))
    return named_back(w.drop("_w", "_bits", "_s", "_p", "_l"))
