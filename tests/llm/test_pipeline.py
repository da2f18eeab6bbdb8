from collections import Counter

import public_tokenizers

import corpus_pipeline as p
from mercato.llm.common import written
from mercato.llm.mixing import targets

from .odd import documents, texts, with_repeats, words
from .test_classifiers import language_rows, mixed_words
from .test_jaccard_join import brute
from .test_suffix_dedup import brute as brute_repeats


def test_stages_keep_the_columns_and_their_decisions(spark):
    rows = {k: t for k, t in texts().items() if k != 10}
    docs = documents(spark, rows)
    docs = docs.fillna({"lang": "de"})
    one = p.known_language(spark, docs, "")
    assert tuple(one.columns) == p.COLUMNS
    kept = {r["doc_id"] for r in one.collect()}
    assert not {5, 6, 7, 12} & kept and {3, 4, 16, 17} <= kept

    two = {r["doc_id"] for r in p.without_near_copies(spark, docs, "").collect()}
    assert two == {k for k, (n, c) in brute(rows).items() if c == k}

    three = {r["doc_id"]: r for r in p.without_repeats(spark, docs, "").collect()}
    for k, (n, gone, _, _) in brute_repeats(rows, 400).items():
        assert (three[k]["text"] is None) == (rows[k] is None)
        assert n - gone - 3 <= len((three[k]["text"] or "").encode()) <= n - gone

    four = p.mixed(spark, docs, "")
    assert tuple(four.columns) == p.COLUMNS
    five = p.packed(spark, four, "")
    assert five.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


def test_run_packs_what_the_stages_keep(spark):
    """The pieces of ``run`` are those of the stages in turn: the same ids of the same documents, none lost and none twice."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    counts = []
    for name, stage in p.STAGES[:-1]:
        docs = written(stage(spark, docs, sf), name)
        counts.append(docs.count())
    assert counts[0] > counts[1] > 0 and counts[1] == counts[2]
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, drawn = {}, Counter()
    for r in docs.collect():
        want[r["doc_id"]] = t.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        drawn[r["doc_id"]] += 1
    got, filled = {k: Counter() for k in want}, Counter()
    for r in p.run(spark, sf).collect():
        assert r["ids"] == want[r["doc_id"]][r["start"]:r["start"] + r["length"]] and r["doc_tokens"] == len(want[r["doc_id"]])
        got[r["doc_id"]].update(range(r["start"], r["start"] + r["length"]))
        filled[r["sequence_id"]] += r["length"]
    for k, ids in want.items():
        assert got[k] == Counter({i: drawn[k] for i in range(len(ids))}), k
    assert max(filled.values()) <= 2048 and sum(n < 2048 for n in filled.values()) <= 1


def test_mixing_stage_draws_to_the_targets(spark):
    rows = {k: words(k, 30 + k % 50) for k in range(400)}
    docs = documents(spark, rows).select(*p.COLUMNS)
    want = {s.name: s for s in targets({s: sum(len(t.split()) for k, t in rows.items() if (f"s{k % 2}" if k % 5 else None) == s) for s in ("s0", "s1", None)})}
    got, taken = p.mixed(spark, docs, "").collect(), Counter()
    for r in got:
        assert r["text"] == rows[r["doc_id"]]
        taken[r["source"]] += len(r["text"].split())
    assert all(abs(taken[s] - want[s].target) <= 40 for s in want)
    assert max(Counter(r["doc_id"] for r in got).values()) <= 3


def test_stages_take_odd_and_empty_tables(spark):
    for docs in (documents(spark, {}), with_repeats(spark)):
        for _, stage in p.STAGES:
            docs = stage(spark, docs, "")
            docs.count()


def test_clean_documents_pass_the_filtering_stages(spark):
    clean = documents(spark, {k: words(k, 80) for k in range(30)})
    for _, stage in p.STAGES[:3]:
        clean = stage(spark, clean, "")
    assert clean.count() == 30


def test_language_stage_keeps_clean_mixtures(spark):
    import pyspark.sql.functions as F
    parts = {"even": (40, 40, 0), "three": (40, 35, 25)}
    rows = {1000 + k: " ".join(mixed_words(2000 + 3 * k + j, a, n) for j, (a, n) in enumerate(zip(("abcde", "vwxyz", "mnopq"), p_)) if n)
            for k, p_ in enumerate([*parts.values()] * 5)} | {2000: "12 34"}
    plain = language_rows(spark).withColumns({"source": F.lit("s"), "n_chars": F.lit(1).cast("long")}).select(*p.COLUMNS)
    mixtures = documents(spark, rows).select(*p.COLUMNS).withColumn("lang", F.lit(None).cast("string"))
    kept = {r["doc_id"] for r in p.known_language(spark, plain.unionByName(mixtures), "").select("doc_id").collect()}
    assert kept == set(range(60)) | set(rows) - {2000}


def test_repeats_of_over_50_words_go_even_below_400_bytes(spark):
    passage, short = words(50, 55), "-".join(words(51, 60).split()[:50]).replace("-", "", 25)
    assert 240 < len(passage) < 400 and 240 < len(short) < 400 and len(short.split()) < 50
    rows = {1: f"{words(52, 90)}\n{passage}\n{words(53, 20)}", 2: f"{words(54, 30)}\n{passage}\n{words(55, 70)}",
            3: f"{words(56, 90)}\n{short}\n{words(57, 20)}", 4: f"{words(58, 30)}\n{short}\n{words(59, 70)}", 5: words(60, 200)}
    got = {r["doc_id"]: r["text"] for r in p.without_repeats(spark, documents(spark, rows).select(*p.COLUMNS), "").collect()}
    for k in (1, 2):  # a byte beside the passage may be equal too
        assert passage[1:-1] not in got[k] and len(rows[k]) - len(passage) - 4 <= len(got[k]) <= len(rows[k]) - len(passage)
    assert {k: got[k] for k in (3, 4, 5)} == {k: rows[k] for k in (3, 4, 5)}
