"""Language ID, toxicity and quality: held-out accuracy, the numerics against plain versions, odd inputs."""

import random

import numpy as np
import pytest

from mercato.llm import language_id as L
from mercato.llm import quality_classifier as Q
from mercato.llm import toxicity as T
from mercato.llm.queries import QUERIES

from .odd import documents, texts, with_repeats, words

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


# ------------------------------------------------------------------ language
def mixed_words(seed, alphabet, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice(alphabet) for _ in range(r.randint(3, 8))) for _ in range(n))


def language_rows(spark):
    data = [(k, mixed_words(k, ("abcde", "vwxyz", "mnopq")[k % 3], 80), ("aa", "vv", "mm")[k % 3]) for k in range(60)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string")


def test_mixtures_find_proportions_and_sets(spark):
    model = L.fit(language_rows(spark))
    assert model.languages == ("aa", "mm", "vv")
    halves = mixed_words(900, "abcde", 75) + " " + mixed_words(901, "vwxyz", 25)
    rows = {0: mixed_words(902, "vwxyz", 50), 1: halves, 2: None, 3: "12 34", 4: "", 5: "é"}
    got = {r["doc_id"]: r for r in L.detect(documents(spark, rows), model).collect()}
    assert got[0]["lang_pred"] == "vv" and set(got[0]["languages"]) == {"vv"} and got[0]["score"] == pytest.approx(1)
    assert got[1]["lang_pred"] == "aa" and set(got[1]["languages"]) == {"aa", "vv"} and got[1]["score"] == pytest.approx(0.75, abs=0.03)
    assert all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 and not got[k]["languages"] for k in (2, 3, 4))
    assert got[5]["lang_pred"] in model.languages


def test_each_further_language_pays_its_penalty():
    # 40 words each surely of language 0 or 1; language 2 is a little better on a few, by less than a penalty
    scores = np.full((80, 4), -12, np.float32)
    scores[:40, 0] = scores[40:, 1] = 0
    scores[:6, 2] = scores[40:46, 2] = 1.5
    got = L.mixtures(scores, np.array([0]))[0]
    assert set(np.flatnonzero(got)) == {0, 1} and got[0] == pytest.approx(0.5, abs=0.02)
    scores[:8, 2] = scores[40:48, 2] = 6  # worth its penalty
    assert set(np.flatnonzero(L.mixtures(scores, np.array([0]))[0])) == {0, 1, 2}


def test_word_likelihoods_match_a_loop():
    r = np.random.default_rng(0)
    table = r.normal(size=(1 << L.BITS, 3)).astype(np.float32)
    data = np.frombuffer(b"ab  cde\nf", np.uint8)
    starts, ends = np.array([0, 4, 8]), np.array([2, 7, 9])
    at = L._buckets(data)
    want = [table[at[s:e]].sum(0) for s, e in zip(starts, ends)]
    assert np.allclose(L.word_likelihoods(data, starts, ends, table), want, atol=1e-5)
    assert np.allclose(L.word_likelihoods(data, starts, ends, table, piece=3)[0], want[0], atol=1e-5)


def test_mixtures_equal_a_plain_version():
    """Expectation-maximisation in loops over words, and the choice of the set by the penalised likelihood."""
    r = np.random.default_rng(3)
    sizes = [1, 7, 30, 60, 60, 25]
    scores = np.concatenate([r.normal(0, 2, (n, 4)) + np.eye(4)[r.integers(0, 2 + k % 3, n)] * 9 for k, n in enumerate(sizes)]).astype(np.float32)
    first = np.append(0, np.cumsum(sizes)[:-1])

    def em(like, pi, rounds):
        for _ in range(rounds):
            total = np.zeros(len(pi))
            for row in like:
                part = pi * row
                total += part / part.sum()
            pi = total / len(like)
        return pi, sum(np.log((pi * row).sum() + 1e-30) for row in like)

    def plain(own, penalty, rounds=6):
        like = np.exp(own - own.max(1, keepdims=True)).astype(float)
        full, _ = em(like, np.full(4, 0.25), rounds)
        value = np.log(like + 1e-30).sum(0)
        chosen = [int(value.argmax())]
        pi, value = np.eye(4)[chosen[0]], value.max()
        while len(chosen) < 4:
            more = max((k for k in range(4) if k not in chosen), key=lambda k: full[k])
            begin = np.array([full[k] + 0.01 if k in (*chosen, more) else 0 for k in range(4)])
            got, worth = em(like, begin / begin.sum(), rounds - 2)
            if worth - penalty * np.log(len(own) + 1) <= value:
                break
            chosen, pi, value = [*chosen, more], got, worth
        return pi
    for penalty in (0.3, 1.0, 3.0):
        got = L.mixtures(scores, first, penalty=penalty)
        for k, n in enumerate(sizes):
            assert np.allclose(got[k], plain(scores[first[k]:first[k] + n], penalty), atol=2e-3), (penalty, k)


def test_language_odd_inputs(spark):
    model = L.fit(documents(spark))
    out = L.detect(with_repeats(spark), model)
    assert out.count() == len(texts()) + 3 and "component" in out.columns
    assert L.detect(documents(spark, {}), model).count() == 0
    nothing = L.fit(documents(spark, {}))
    assert {r["lang_pred"] for r in L.detect(documents(spark), nothing).collect()} == {"und"}


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op1_language_mixtures"](spark, SF).join(docs, "doc_id").where("held_out").collect()
    assert len(got) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.98


# ------------------------------------------------------------------ toxicity
def test_gradients_match_finite_differences():
    net = T.new_net()
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    off = np.array([0, 36])
    data, starts, ends, at, h = T._split(np.frombuffer(b"some words stand here, and more follow", np.uint8)[:36], off)
    feats = T.word_features(data, starts, ends, h)
    ids = np.array([[0, 1, 2], [2, 3, 4], [4, 5, 0]])
    d = np.array([0.3, -1.0, 0.5])
    _, back = T._gradients(net, *feats, ids)
    grads = back(d)

    def loss():
        return float(T._gradients(net, *feats, ids)[0] @ d)
    r = np.random.default_rng(1)
    for name, g in grads.items():
        rows, g = g if isinstance(g, tuple) else (None, g)
        for _ in range(4):
            spot = tuple(r.integers(0, n) for n in g.shape)
            real = (rows[spot[0]], *spot[1:]) if rows is not None else spot
            keep, w = net.weights[name][real], net.weights[name]
            w[real] = keep + 1e-4
            up = loss()
            w[real] = keep - 1e-4
            down = loss()
            w[real] = keep
            assert g[spot] == pytest.approx((up - down) / 2e-4, rel=0.02, abs=2e-4), name


def test_windows_cover_every_word():
    counts = np.array([0, 1, 31, 32, 33, 48, 100])
    first, length, owner = T.windows_of(counts, 32, 16)
    base = np.append(0, np.cumsum(counts))
    for k, n in enumerate(counts):
        seen = {w for f, x, o in zip(first, length, owner) if o == k for w in range(f, f + x)}
        assert seen == set(range(base[k], base[k + 1]))
        assert all(x == min(n, 32) for x, o in zip(length, owner) if o == k)


def test_word_inputs_do_not_depend_on_neighbours():
    def inputs(text):
        data, starts, ends, _, h = T._split(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        return T.word_inputs(T.new_net(), *T.word_features(data, starts, ends, h))
    one, two = inputs(b"alpha beta"), inputs(b"gamma, BETA.")
    assert np.allclose(one[1], two[1])


def toxic_rows(spark, n=120):
    rows = {k: words(k, 60) + (f" vile{k % 7}st " + words(k + 500, 30) if k % 2 else "") for k in range(n)}
    return documents(spark, rows), spark.createDataFrame([(k, 1 - k % 2, k % 2) for k in rows if k % 5], LABELS), rows


def test_toxicity_learns_words_by_their_characters(spark):
    docs, labels, rows = toxic_rows(spark)
    net = T.fit(docs, labels, epochs=12)
    got = {r["doc_id"]: r["score"] for r in T.score(docs, net).collect()}
    held = [k for k in rows if not k % 5]
    assert np.mean([(got[k] >= 0.5) == bool(k % 2) for k in held]) > 0.85
    odd = {r["doc_id"]: r for r in T.score(with_repeats(spark), net).collect()}
    assert odd[5]["score"] == odd[6]["score"] == odd[7]["score"] == 0 and odd[5]["predicted"] == 0
    assert all(0 <= r["score"] <= 1 for r in odd.values())
    assert T.score(documents(spark, {}), net).count() == 0


def test_toxicity_held_out_labels(spark):
    """The registered query, on labels that it does not learn from."""
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op2_recurrent_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    toxic, clean = [r["predicted"] for r in got if r["toxic"]], [r["predicted"] for r in got if not r["toxic"]]
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.04


def test_toxicity_without_two_classes(spark):
    docs, labels, _ = toxic_rows(spark, 10)
    for some in (labels.where("toxic = 1"), labels.where("false")):
        got = {r["score"] for r in T.score(docs, T.fit(docs, some)).collect()}
        assert len(got) == 1 and 0 < got.pop() < 1


# ------------------------------------------------------------------ quality
def test_indicators_are_the_distinct_grams():
    data = b"a b a b c" + b"" + b"a" + b"b a b"
    ix, first = Q.indicators(np.frombuffer(data, np.uint8), np.array([0, 9, 9, 10, 15]))
    assert np.diff(first).tolist() == [3 + 3, 0, 1, 2 + 2]  # a b c, ab ba bc; nothing; a; a b, ba ab
    assert set(ix[first[3]:]) <= set(ix[:first[1]])


def test_dual_descent_solves_the_machine():
    r = np.random.default_rng(2)
    x = r.normal(size=(60, 4))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = (x @ [1, -2, 0.5, 0] > 0.1).astype(int)
    first, index = np.arange(0, 241, 4), np.tile(np.arange(4), 60)
    w, b = Q.dual_descent(first, index, x.ravel(), y, 4, 1.0, 400)
    share = np.where(y > 0, (y == 0).mean(), (y > 0).mean()) * 2

    def primal(v):
        return 0.5 * v @ v + (share * np.maximum(0, 1 - np.where(y > 0, 1, -1) * (x @ v[:4] + v[4]))).sum()
    best = primal(np.append(w, b))
    for _ in range(300):
        assert primal(np.append(w, b) + r.normal(scale=0.05, size=5)) > best - 1e-2


def test_quality_learns_and_takes_odd_inputs(spark):
    rows = {k: (words(k, 40) if k % 2 else " ".join(w + "&&&" for w in words(k, 40).split())) + " the the" for k in range(80)}
    rows = {k: t if k % 2 else t + " junk&&& junk&&&" for k, t in rows.items()}
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(k, k % 2, 0) for k in rows if k % 5] + [(None, 1, 0), (1, None, 0), (1, 1, 0)], LABELS)
    model = Q.fit(docs, labels)
    got = {r["doc_id"]: r for r in Q.score(docs, model).collect()}
    assert np.mean([got[k]["predicted"] == k % 2 for k in rows if not k % 5]) > 0.85
    odd = Q.score(with_repeats(spark), model).collect()
    assert len(odd) == len(texts()) + 3 and all(0 <= r["score"] <= 1 for r in odd)
    assert len({r["score"] for r in odd if r["doc_id"] in (5, 6, 7)}) == 1
    for some in (labels.where("quality = 1"), labels.where("false")):
        assert len({r["score"] for r in Q.score(docs, Q.fit(docs, some)).collect()}) == 1
    assert Q.score(documents(spark, {}), model).count() == 0


def test_quality_held_out_accuracy(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = QUERIES["op7_naive_bayes_margin"](spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").collect()
    good = [r["predicted"] for r in got if r["quality"]]
    bad = [r["predicted"] for r in got if not r["quality"]]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.35


# ------------------------------------------------------------------ executors without the package
def test_workers_need_no_copy_of_the_package(tmp_path):
    """All three models score in Python workers that cannot import the package: started elsewhere, and only the driver's path has it."""
    import subprocess
    import sys
    from pathlib import Path
    code = f"""
import os, sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
def probe(batches):
    import importlib.util
    assert importlib.util.find_spec("mercato") is None
    yield from batches
spark.range(1).mapInArrow(probe, "id long").collect()
sys.path.insert(0, {str(Path(__file__).resolve().parents[2])!r})
from mercato.llm.queries import QUERIES
for name in ("op1_language_mixtures", "op2_recurrent_toxicity", "op7_naive_bayes_margin"):
    print(name, QUERIES[name](spark, "/root/testdata/sf0.001").count())
"""
    import os
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split() for line in done.stdout.splitlines() if line.startswith("op")] == [
        [n, "200"] for n in ("op1_language_mixtures", "op2_recurrent_toxicity", "op7_naive_bayes_margin")]


def test_labelled_sample_takes_one_row_an_id(spark):
    from mercato.llm.common import labelled_sample
    docs = spark.createDataFrame([(1, f"t{k}") for k in range(50)] + [(2, "b"), (None, "n"), (3, None), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 0, 0), (3, 0, 1), (None, 1, 1)], LABELS)
    got = {r["doc_id"]: r for r in labelled_sample(docs, labels, "quality", 10).collect()}
    assert set(got) == {1, 2, 3} and got[1]["_label"] == 1 and got[3]["text"] is None
    again = labelled_sample(docs.repartition(7), labels, "quality", 10).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, got.values()), key=str)
