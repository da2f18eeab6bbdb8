import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from mercato.llm.packing import Packer, pack
from mercato.llm.vocabularies import ByteBpe

from mercato.llm.queries import QUERIES

from .odd import documents, texts, with_repeats

PATH, RANKS = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)  # as it comes: a text may hold the added token
    return lambda s: t.encode(s or "", add_special_tokens=False).ids + [1]


def test_encoder_equals_tokenizer(plain):
    odd = [*(t or "" for t in texts().values()), "it's  'll x ½ ² \x1c\x85 y\r\n\n z", "<|endoftext|> a", "﻿ a b", "x <|endoftext|>"]
    assert [list(x) + [1] for x in ByteBpe(PATH, RANKS, special_as_text=False)(odd)] == [plain(s) for s in odd]
    assert plain("a <|endoftext|>")[-2] == 50256
    assert 50256 not in ByteBpe(PATH, RANKS)(["a <|endoftext|>"])[0]


def test_ids_of_random_texts(plain):
    r = random.Random(9)
    kinds = ["abc XYZ", "0123 ", " \t\n\r", "'s'll'", "éßÀÿɏĀ", ".,;!?<|>", "endoftext|>"]
    texts = ["".join(r.choice(r.choice(kinds)) for _ in range(r.randint(0, 80))) for _ in range(3000)]
    assert [list(x) + [1] for x in ByteBpe(PATH, RANKS, special_as_text=False)(texts)] == [plain(t) for t in texts]


def test_pieces_are_a_partition_of_all_ids(spark, plain):
    docs = documents(spark).repartition(5, "doc_id")
    rows = pack(docs, PATH, size=256, space=3, merge=2, ranks=RANKS).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["length"] == len(r["ids"]) > 0
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for k, t in texts().items():
        own = sorted(by_doc[k], key=lambda r: r["start"])
        assert [x for r in own for x in r["ids"]] == plain(t)
        assert [r["start"] for r in own] == list(np.cumsum([0] + [r["length"] for r in own])[:-1])
        assert {r["doc_tokens"] for r in own} == {len(plain(t))}
    short = 0
    for own in by_seq.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == list(np.cumsum([0] + [r["length"] for r in own])[:-1])
        total = sum(r["length"] for r in own)
        assert total <= 256
        short += total < 256
    assert short <= 3  # one for each task of the merge


def test_best_fit_and_fullest():
    p = Packer(10, 2, 0)
    for doc, n in enumerate((6, 8, 2, 3)):
        p.place(doc, 0, np.arange(n, dtype=np.int32), n)
    # 2 fits best after 8; 3 fits after 6
    assert [(r[0], r[4]) for r in p.ready] == [(1, 1), (2, 1)] and [w[1] for w in p.open] == [9]
    p.place(4, 0, np.arange(5, dtype=np.int32), 5)
    p.place(5, 0, np.arange(7, dtype=np.int32), 7)  # fits nowhere: the fullest (9) takes one id and goes
    assert sorted(r[0] for r in p.ready) == [0, 1, 2, 3, 5] and len(p.open) == 2


def test_query_packs_every_id_once(spark, plain):
    sf = "/root/testdata/sf0.001"
    docs = {r[0]: plain(r[1]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    found, filled = {k: [] for k in docs}, defaultdict(int)
    for r in QUERIES["op3_bounded_space_packing"](spark, sf).collect():
        ids = docs[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes()) and r["doc_tokens"] == len(docs[r["doc_id"]])
        found[r["doc_id"]] += range(r["start"], r["start"] + r["length"])
        filled[r["sequence_id"]] += r["length"]
    assert all(sorted(v) == list(range(len(docs[k]))) for k, v in found.items())
    assert max(filled.values()) == 2048 and sum(n < 2048 for n in filled.values()) <= 1


def test_odd_inputs(spark):
    assert pack(documents(spark, {}), PATH).count() == 0
    rows = pack(with_repeats(spark), PATH, size=128, space=2).groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in rows}[5] == 1 and None in {r[0] for r in rows}
