import hashlib
import re

import numpy as np

from mercato.llm.decontamination import FmIndex, build, contaminated, index_shards, merged_spans, suffix_array
from mercato.llm.queries import op13_benchmark_index

from .odd import documents, texts, with_repeats, words

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(bytes((text or "").encode()).lower()) if text else []  # bytes.lower() changes A-Z only


def plain(docs, items, width=10):
    out = []
    for doc, text in docs:
        w, hit, ids = split(text), set(), set()
        for item, test in items:
            t = split(test)
            k = min(width, len(t))
            wanted = {tuple(t[i:i + k]) for i in range(len(t) - k + 1)} if k else set()
            for i in range(len(w) - k + 1 if k else 0):
                if tuple(w[i:i + k]) in wanted:
                    hit.update(range(i, i + k))
                    ids.add(item)
        out.append((doc, len(w), len(hit), sorted(str(i) for i in ids if i is not None)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in df.collect()), key=repr)


def test_query_equals_a_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = [(d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in plain(docs, items)]
    out = op13_benchmark_index(spark, sf)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == want
    assert out.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"] and any(w[5] for w in want)


def test_index_finds_and_locates_every_word_sequence():
    rng = np.random.default_rng(5)
    sizes = np.array([40, 0, 3, 60, 1, 40])
    hashes = rng.integers(0, 4, sizes.sum()).astype(np.uint64)
    hashes[-40:] = hashes[:40]  # a copy
    made = build(hashes, sizes)
    index = FmIndex(**made)
    rows, at = [], 0
    for n in sizes:
        rows.append(tuple(hashes[at:at + n].tolist()))
        at += n
    first = np.cumsum(sizes + 1) - sizes - 1
    for k in (1, 2, 3, 7, 10):
        phrases = list({r[i:i + k] for r in rows for i in range(len(r) - k + 1)}) + [(9,) * k]
        symbols = np.zeros((len(phrases), 10), np.int64)
        symbols[:, 10 - k:] = [index.symbols(np.array(p, np.uint64)) for p in phrases]
        lo, hi = index.search(symbols, np.full(len(phrases), k))
        for p, a, b in zip(phrases, lo, hi):
            want = [first[d] + i for d, r in enumerate(rows) for i in range(len(r) - k + 1) if r[i:i + k] == p]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_suffix_array_against_sorting():
    rng = np.random.default_rng(6)
    for text in (rng.integers(0, 3, 300), np.array([1] * 50 + [0] + [1] * 50 + [0]), np.zeros(4, int), np.array([0])):
        text = np.append(text, 0)
        ends = np.cumsum(text == 0)
        key = [tuple((1, int(s)) if s else (0, int(e)) for s, e in zip(text[i:i + 1 + int(np.argmax(text[i:] == 0))], ends[i:])) for i in range(len(text))]
        assert suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: key[i])


def test_merged_spans():
    g, a, b = merged_spans(np.array([1, 0, 0, 0, 1]), np.array([5, 4, 0, 9, 0]), np.array([8, 6, 4, 12, 30]))
    assert list(zip(g.tolist(), a.tolist(), b.tolist())) == [(0, 0, 6), (0, 9, 12), (1, 0, 30)]


def test_awkward_texts_blocks_and_pieces(spark):
    base = texts()
    items = [(1, " ".join(base[0].split()[20:60]).upper()), (2, "One"), (3, None), (4, ""), (5, base[10][5000:9000]), (None, "one two"), (5, "naïve été naïve"),
             (6, words(77, 30)), (10, "日本語の文章 日本語の文章"), (7, "two three"), (7, "two three")]
    test = spark.createDataFrame(items, "item_id long, text string")
    docs = with_repeats(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = plain(rows, items)
    assert got(contaminated(docs, test)) == want
    # long texts in overlapping pieces, and a block of phrases at a time
    assert got(contaminated(docs.repartition(3), test, shard_bytes=3000, block_words=500)) == want
    assert index_shards(docs, shard_bytes=3000).count() > 10
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in contaminated(documents(spark), test).collect()}
    assert spans[9] == [(0, 3)] and spans[0] == [(20, 60)] and spans[5] == []


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert got(contaminated(documents(spark), none)) == plain([(k, t) for k, t in texts().items()], [])
    assert contaminated(documents(spark, {}), none.unionByName(spark.createDataFrame([(1, "a b")], none.schema))).count() == 0
