import math
import random
import re
from collections import Counter

from mercato.llm.quality_rules import bucket_count, fit, gram_counts, rules, with_trusted
from mercato.llm.queries import QUERIES

from .odd import documents, texts, with_repeats

LABELS = "doc_id long, quality int"


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    repeat = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeat),
            n < 50 or 100 * len(repeat) > 50 * n)


def test_base_counts_match_brute_force(spark):
    r = random.Random(5)
    rows = {100 + k: " ".join(r.choice("a b c d e f g h i j".split()) + r.choice(["", "", "#", "\n"]) for _ in range(r.randint(0, 400)))
            for k in range(60)} | texts()
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(0, 1), (16, 1), (3, 0), (None, 1), (4, None)], LABELS)
    out = rules(docs, fit(docs, labels, buckets=1 << 10))
    got = {x["doc_id"]: x for x in out.collect()}
    assert len(got) == len(rows)
    for k, t in rows.items():
        x = got[k]
        assert (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"], x["base_failed"]) == base(t), k
        assert not (x["base_failed"] and x["kept"])


def test_ratio_is_that_of_the_model(spark):
    docs = documents(spark, {1: "good words here", 2: "bad bad"})
    model = fit(docs, spark.createDataFrame([(1, 1)], LABELS), buckets=1 << 10, smoothing=0.01)
    out = {x["doc_id"]: x["ratio"] for x in rules(docs, model).collect()}
    assert out[1] > 0 > out[2]
    again = {x["doc_id"]: x["ratio"] for x in rules(docs, model).collect()}
    assert out == again


def test_odd_inputs(spark):
    labels = spark.createDataFrame([], LABELS)
    docs = with_repeats(spark)
    out = rules(docs, fit(docs, labels, buckets=64))
    assert out.count() == docs.count() and set(docs.columns) <= set(out.columns)
    assert out.where("ratio <> 0").count() == 0  # no trusted rows
    none = documents(spark, {})
    assert rules(none, fit(none, labels, buckets=64)).count() == 0


def test_no_python_in_plan(spark):
    docs = documents(spark)
    plan = rules(docs, [0] * 64)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_all_trusted_documents_are_counted(spark):
    n = 20_500
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('w', id % 7, ' v') AS text")
    counts = gram_counts(docs, docs.selectExpr("doc_id", "1 AS quality"), 1 << 10)
    assert tuple(counts.agg({"raw": "sum", "trusted": "sum"}).first()) == (3 * n, 3 * n)


def test_repeats_of_a_million_words(spark):
    r = random.Random(6)
    words = [f"{r.randrange(150)}" for _ in range(1_000_000)]
    out = rules(documents(spark, {1: " ".join(words)}), [0] * 64).first()
    assert out["n_repeat_words"] == base(" ".join(words))[4]


def test_trusted_bits_equal_the_labels(spark):
    ids = [0, 1, 7, 8, 32767, 32768, 32769, 65536, -1, -5, 2 ** 40, None]
    docs = spark.createDataFrame([(k, "x") for k in ids] + [(3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, q) for k, q in zip(ids, (1, 0, 1, 1, 1, 0, 1, 1, 1, 0, 1, 1))] + [(1, 1), (5, 1)], LABELS)
    for most in (1 << 14, 0):  # broadcast, and shuffled
        got = {r["doc_id"] for r in with_trusted(docs, labels, most_bitmaps=most).where("_trusted").collect()}
        assert got == {0, 1, 7, 8, 32767, 32769, 65536, -1, 2 ** 40}


def test_bucket_number_follows_the_square_root(spark):
    docs = spark.range(130).selectExpr("id AS doc_id", "repeat('x', 1000000) AS text")
    assert bucket_count(docs) == 1 << 16 and bucket_count(docs.limit(1)) == 1 << 15 == bucket_count(documents(spark, {}))


def test_model_of_a_whole_corpus(spark):
    r = random.Random(8)
    rows = {k: " ".join(r.choice("abcdefgh") + str(r.randint(0, 30)) for _ in range(r.randint(1, 90))) for k in range(500)}
    docs, good = documents(spark, rows), [k for k in rows if k % 3]
    model = fit(docs, spark.createDataFrame([(k, 1) for k in good], LABELS), buckets=1 << 17)

    def grams(text):
        w = text.split()
        return [*w, *zip(w, w[1:])]
    raw, trusted = Counter(g for t in rows.values() for g in grams(t)), Counter(g for k in good for g in grams(rows[k]))
    shift = math.log((raw.total() + len(model)) / (trusted.total() + len(model)))
    close = 0
    for x in rules(docs, model).collect():
        each = [math.log((trusted[g] + 1) / (raw[g] + 1)) + shift for g in grams(rows[x["doc_id"]])]
        close += abs(x["ratio"] - sum(each) / len(each)) < 0.03
    assert close > 475  # the others hold grams that share a bucket


def test_kept_follows_the_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    got = QUERIES["op10_quality_rules"](spark, sf).join(labels, "doc_id").selectExpr("quality", "if(base_failed, NULL, int(kept)) AS kept")
    share = {r[0]: r[1] for r in got.groupBy("quality").avg("kept").collect()}
    assert share[1] > 0.99 and share[0] < 0.01


def test_words_are_split_without_a_translate(spark):
    from mercato.llm.common import words_column
    rows = {**texts(), 50: " \t a\x0bb\x0c\r\n c d ", 51: "x", 52: "\n"}
    made = documents(spark, rows).select("doc_id", words_column(_col("text")).alias("found"))
    assert {r["doc_id"]: r["found"] for r in made.collect()} == {k: re.findall(r"[^\x20\x09-\x0D]+", t or "") for k, t in rows.items()}
    assert "translate" not in made._jdf.queryExecution().optimizedPlan().toString().lower()


def test_ascii_words_are_lowered_without_a_translate(spark):
    from mercato.llm.license_scan import _lowered_words, template_words
    rows = {1: "All Rights RESERVED.", 2: "ÉTÉ Été İx AİB ß Straße ABC", 3: None, 4: "", 5: "KKK"}
    made = documents(spark, rows).select("doc_id", _lowered_words(_col("text")).alias("found"))
    assert {r["doc_id"]: r["found"] for r in made.collect()} == {k: template_words(t or "") for k, t in rows.items()}
    assert "lower(" in made._jdf.queryExecution().optimizedPlan().toString().lower()


def _col(name):
    from pyspark.sql import functions as F
    return F.col(name)
