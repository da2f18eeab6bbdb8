import hashlib
from collections import Counter

import public_tokenizers as P
import pytest

from mercato.llm.queries import op12_token_alignment
from mercato.llm.token_alignment import align_documents
from mercato.llm.vocabularies import byte_letters

from .odd import documents, texts, with_repeats

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.tiktoken")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    one = Tokenizer.from_file(PATHS[0])
    one.encode_special_tokens = True
    return one, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def plain(rows, libraries):
    """Results of (doc_id, text) rows, token by token."""
    one, two = libraries
    letters = byte_letters()
    found, held = [], Counter()
    for doc, text in rows:
        a = one.encode(" " + text, add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        spell_a = [bytes(letters[c] for c in one.id_to_token(t)) for t in a]
        spell_b = [bytes([int(two.id_to_piece(t)[3:5], 16)]) if two.is_byte(t) else two.id_to_piece(t).replace("▁", " ").encode() for t in b]
        if not text or not (b"".join(spell_a) == b"".join(spell_b) == (" " + text).encode()):
            a, b, spell_a, spell_b = [], [], [], []
        ends = []
        for spelt in (spell_a, spell_b):
            at, here = 0, []
            for s in spelt:
                at += len(s)
                here.append(at)
            ends.append(here)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, i, j = [], 0, 0
        for cut in cuts:
            x, y = ends[0].index(cut, i) + 1, ends[1].index(cut, j) + 1
            groups.append((a[i:x], b[j:y]))
            i, j = x, y
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        held.update(links.keys())
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        found.append((doc, len(a), len(b), len(groups), links, hashlib.sha256(text.encode()).hexdigest() if a else ""))
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return sorted(((doc, n, m, g, sum(links.values()), sum(c for p, c in links.items() if held[p] == most[p[0]]),
                    sum(c * held[p] for p, c in links.items()), sha) for doc, n, m, g, links, sha in found), key=repr)


def got(df):
    return sorted(((r["doc_id"], *(r[c] for c in COLUMNS)) for r in df.collect()), key=repr)


def test_query_equals_a_plain_version(spark, libraries):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(op12_token_alignment(spark, sf)) == plain(rows, libraries)


def test_awkward_texts(spark, libraries):
    more = texts() | {20: "<|endoftext|> and <s> </s> <unk>", 21: "▁ stands for a space", 22: "a\x00b\x01", 23: "  two  spaces \r\n\t tabs ",
                      24: "<0x41> A", 25: "🙂🙃 ﬁne ½ Å Å İi", 26: "x" * 5000, 27: "日本語" * 300 + " word", 28: " ", 29: "​ 　 z"}
    rows = list(more.items())
    for docs in (documents(spark, more), documents(spark, more).repartition(5)):
        out, pairs = align_documents(docs, *PATHS, bundle_bytes=1 << 14, memo_bytes=1 << 14)
        assert got(out) == plain(rows, libraries)
    assert pairs.where("best").select("a").distinct().count() == pairs.select("a").distinct().count()
    out, _ = align_documents(documents(spark, more), PATHS[0], PATHS[1])  # without the faster form of the vocabulary
    assert got(out) == plain(rows, libraries)


def test_repeated_rows_null_ids_and_empty_tables(spark, libraries):
    docs = with_repeats(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(align_documents(docs, *PATHS)[0]) == plain(rows, libraries)
    empty = align_documents(documents(spark, {}), *PATHS)[0]
    assert empty.count() == 0 and empty.columns == ["doc_id", *COLUMNS]
    nothing = align_documents(documents(spark, {1: None, 2: ""}), *PATHS)[0]
    assert got(nothing) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_pairs_and_spelling_by_whole_columns():
    import numpy as np

    from mercato.llm.token_alignment import Aligner, _distinct_pairs
    r = np.random.default_rng(3)
    for wide in (1 << 15, 1 << 31):  # places fit beside the ids, and do not
        pairs = (r.integers(0, wide, 3000) << 32 | r.integers(0, wide, 3000))[r.integers(0, 700, 3000)]
        keys, place = _distinct_pairs(pairs)
        want, inverse = np.unique(pairs, return_inverse=True)
        assert (keys == want).all() and (place == inverse).all()
    assert all(len(x) == 0 for x in _distinct_pairs(np.zeros(0, np.int64)))
    known = Aligner([b" ", b"a", b"bc"], [b" a", b"bc"], 1 << 20)
    got = known.spelt(0, np.array([0, 1, 2, 0, 2, 1], np.uint32), np.array([3, 0, 2, 1]), [b" abc", b"", b" b", b"a"])
    assert got.tolist() == [True, True, False, True]
    assert known.spelt(1, np.zeros(0, np.uint32), np.zeros(1, np.int64), [b"x"]).tolist() == [False]


def test_rows_do_not_grow_with_a_bundle(spark, libraries):
    """A bundle's documents and pairs are many small rows, in the order of its slices; all rows see the counts of the whole corpus."""
    import random

    from pyspark.sql import functions as F

    from mercato.llm.token_alignment import link_bundles
    r = random.Random(5)
    words = ["".join(r.choices("etaoinshrdlu", k=r.randint(2, 9))) for _ in range(3000)]
    more = {k: " ".join(r.choices(words, k=500)) for k in range(400)}  # over 1 MB, a bundle
    docs = documents(spark, more).coalesce(1)
    rows = link_bundles(docs, *PATHS)
    assert rows.select("bundle").distinct().count() == 1
    assert rows.select(F.max(F.length(F.to_json(F.struct("*"))))).first()[0] < 400_000
    some = documents(spark, {k: more[k] for k in range(40)} | {40: None, 41: "", 42: "x" * 5000}).coalesce(1)
    out, pairs = align_documents(some, *PATHS, slice_bytes=1 << 13, bundle_bytes=1 << 15)  # slices of two documents, four in a bundle
    assert got(out) == plain([(d["doc_id"], d["text"]) for d in some.collect()], libraries)
    assert pairs.count() == pairs.select("key").distinct().count()


def test_pairs_of_slices_share_a_list():
    import numpy as np
    import pyarrow as pa

    from mercato.llm.token_alignment import PairList, _by_value, _packed, _unpacked
    r = np.random.default_rng(7)
    pairs, seen = PairList(), Counter()
    for _ in range(20):
        keys, docs = np.unique(r.integers(0, 500, 60)), 1 + r.integers(0, 9)
        place = pairs.add(keys, np.full(len(keys), docs))
        seen.update({k: docs for k in keys.tolist()})
        assert (pairs.keys()[place] == keys).all()
    assert dict(zip(pairs.keys().tolist(), pairs.docs.tolist())) == seen
    assert len(pairs.add(np.zeros(0, np.int64), np.zeros(0, np.int64))) == 0
    lists = [[1, 255], [], [256, 65535], [1 << 33, 0, 7], [3], [1 << 20]]
    got = _unpacked(pa.array([_packed(np.array(x, np.int64)) for x in lists], pa.binary()), np.array([len(x) for x in lists]))
    assert got.tolist() == [v for x in lists for v in x]
    for most in (1 << 20, (1 << 62) - 1):  # places fit beside the values, and do not
        x = r.integers(0, most, 300)[r.integers(0, 90, 900)]
        order, begin = _by_value(x, most)
        assert (x[order] == np.sort(x)).all() and (np.sort(x)[begin] == np.unique(x)).all()
