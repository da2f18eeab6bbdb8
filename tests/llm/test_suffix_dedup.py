import hashlib
import os

import pytest

from mercato.llm.suffix_dedup import BlindTrie, common_prefix, deep_shallow, reaches, remove_repeats

from .odd import documents, texts, with_repeats, words


def brute(rows, length):
    seen, twice = set(), set()
    for t in rows.values():
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            (twice if b[k:k + length] in seen else seen).add(b[k:k + length])
    out = {}
    for doc, t in rows.items():
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if b[k:k + length] in twice:
                gone[k:k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[doc] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def result(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in df.collect()}


@pytest.mark.parametrize("most", [20_000, 1])
def test_removed_bytes_match_brute_force(spark, most):
    passage = words(50, 120)
    rows = {100 + k: words(60 + k, 40) + " " + passage[k * 7:k * 7 + 410 + 11 * k] + " " + words(90 + k, 30) for k in range(20)}
    rows |= {200: passage + passage, 201: "ab" * 700, 202: passage[:399], 203: passage[:400], 204: passage[100:500] + "x" + passage[100:499]}
    rows |= texts()
    del rows[10]  # 180 kB: too slow for brute force
    assert result(remove_repeats(documents(spark, rows), 400, most)) == brute(rows, 400)


def test_long_text_in_pieces(spark):
    long = words(7, 800_000)  # over 4 MB: read in pieces
    rows = {1: long + " " + words(8, 200), 2: words(9, 100) + long[4_194_000:4_195_000]}
    got = result(remove_repeats(documents(spark, rows)))
    assert got[1][1:3] == got[2][1:3] and got[1][1] in (1000, 1001, 1002)


def test_blind_trie_sorts_with_common_prefixes():
    strings = [b"", b"a", b"ab", b"abc", b"abd", b"abc", b"b" * 40, b"b" * 40 + b"a", b"b" * 39, *(os.urandom(1) * 20 for _ in range(50))]
    order = [m for trie in deep_shallow(strings) for kind, value, _ in trie.walk() if kind == "leaf" for m in value]
    assert sorted(order) == list(range(len(strings))) and len(set(order)) == len(order)
    assert sorted(strings, key=lambda s: (s[:16].ljust(16, b"\0"), s)) == [strings[m] for m in order]
    trie = BlindTrie(strings, list(range(len(strings))))
    assert [strings[m] for kind, v, _ in trie.walk() if kind == "leaf" for m in v] == sorted(strings)
    assert common_prefix(b"x" * 100 + b"a", b"x" * 100 + b"b") == 100


def test_reaches_need_both_sides():
    core = b"c" * 20
    lefts, rights = [b"lll", b"llx", b"yyy"], [core + b"rr", core + b"r", core + b"rr"]
    left, right = reaches(lefts, rights, 23)
    assert left.tolist() == [2, 2, 0] and right.tolist() == [21, 21, 0]


@pytest.mark.parametrize("most", [20_000, 1])
def test_rows_without_id_and_of_one_id(spark, most):
    """Every row counts: NULL ids, one id with two texts, and rows equal in both."""
    passage = words(70, 100)
    rows = [(None, words(71, 60) + passage), (None, passage + words(72, 90)), (500, words(73, 30) + passage), (7, words(74, 80)), (7, passage[:450]),
            (8, words(75, 120)), (8, words(75, 120)), (None, words(76, 150)), (None, words(76, 150)), (9, None), (None, ""), (None, None)]
    want = brute(dict(enumerate(t for _, t in rows)), 400)
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 400, most).collect()
    key = lambda x: str(x)
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in got), key=key) == sorted(
        ((rows[k][0], *v) for k, v in want.items()), key=key)
    assert sum(r["n_removed"] > 0 for r in got) == 8


def test_odd_inputs(spark):
    assert remove_repeats(documents(spark, {})).count() == 0
    docs = with_repeats(spark).where("NOT doc_id <=> 10")
    out = remove_repeats(docs, as_text=True)
    assert out.count() == docs.count()
    assert {"score", "component", "copy"} <= set(out.columns)
    cut = remove_repeats(documents(spark, {1: "x" + "é" * 500, 2: "y" + "é" * 500}), as_text=True).collect()
    assert [r["kept"] for r in cut] == ["x", "y"]
