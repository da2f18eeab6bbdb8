import re
from collections import Counter

import numpy as np
import pytest

from mercato.llm.mixing import mix, split_tree, targets
from mercato.llm.queries import QUERIES

from .odd import documents, texts, with_repeats, words


def test_targets_cap_and_share_again():
    got = {s.name: s for s in targets({"b": 100, "a": 10, None: 50, "c": 0})}
    assert list(got) == ["a", "b", "c", None]
    assert got["a"].target == 30 and got["c"].target == 0  # weight 5 is capped, an empty source takes nothing
    assert got["b"].target == pytest.approx(130 * 2 / 7) and got[None].target == pytest.approx(130 * 5 / 7)
    assert sum(s.target for s in got.values()) == pytest.approx(160)
    assert targets({}) == [] and [s.target for s in targets({"x": 7})] == [7]


def test_tree_splits_quotas_exactly():
    quotas = np.array([1000, 10, 0, 333])
    for shards in (1, 3, 8):
        got = split_tree(quotas, shards, 4)
        assert got.sum(0).tolist() == quotas.tolist() and (got >= 0).all()
        assert got.sum(1).max() - got.sum(1).min() <= shards
        assert (got == split_tree(quotas, shards, 4)).all()


def test_taken_words_are_near_the_targets(spark):
    rows = {k: words(k, 20 + k % 60) for k in range(3000)}
    docs = documents(spark, rows)
    mixed, sources = mix(docs, shards=4)
    taken = {r[0]: r[1] for r in mixed.groupBy("source").sum("size").collect()}
    for s in sources.collect():
        assert abs(taken[s["source"]] - s["target"]) <= 10
        assert s["source_size"] == sum(len(t.split()) for k, t in rows.items() if (f"s{k % 2}" if k % 5 else None) == s["source"])
    times = mixed.groupBy("doc_id").count().agg({"count": "max"}).first()[0]
    assert times <= 3
    again, _ = mix(docs.repartition(3), shards=4)
    key = ["doc_id", "copy", "shard", "place"]
    assert sorted(map(tuple, mixed.select(*key).collect())) == sorted(map(tuple, again.select(*key).collect()))
    counts = [r["count"] for r in mixed.groupBy("shard").count().collect()]
    assert len(counts) == 4 and max(counts) < 1.3 * min(counts)


def test_shards_lie_in_order_of_place(spark):
    import pyspark.sql.functions as F
    mixed, _ = mix(documents(spark, {k: words(k, 10) for k in range(300)}), shards=3)
    rows = mixed.withColumn("part", F.spark_partition_id()).select("part", "shard", "place").collect()
    for shard in range(3):
        places = [r["place"] for r in rows if r["shard"] == shard]
        assert places == sorted(places) and len({r["part"] for r in rows if r["shard"] == shard}) == 1


def test_odd_inputs(spark):
    mixed, sources = mix(documents(spark, {}))
    assert mixed.count() == 0 and sources.count() == 0
    docs = with_repeats(spark)
    mixed, sources = mix(docs, shards=2)
    assert set(docs.columns) <= set(mixed.columns)
    total = sum(len((t or "").split()) for t in texts().values())
    assert sources.agg({"target": "sum"}).first()[0] == pytest.approx(
        total + sum(len(texts()[k].split()) for k in (3, 4, 16)))


def test_null_and_repeated_ids_are_drawn_row_by_row(spark, tmp_path):
    rows = [(None, words(k, 300), "n") for k in range(60)] + [(7, words(100 + k, 200), "r") for k in range(60)] + [(k, words(300 + k, 100), "o") for k in range(50)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op5_source_mix"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    by = {s: [r for r in got if r["source_size"] == n] for s, n in (("n", 18_000), ("r", 12_000), ("o", 5_000))}
    for rows in by.values():
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= rows[0]["size"]
        assert all(r["taken"] == r["size"] * len(r["shards"]) and len(r["shards"]) <= 3 for r in rows)
    assert len({r["taken"] for r in by["n"]}) == 2  # some of the rows without id once more than others


def test_query_equals_a_plain_version(spark):
    """Targets by hand, whole documents drawn to them, and the shards that the splitting tree deals."""
    sf = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    sizes, names = Counter(), sorted({s for _, s, _ in docs if s is not None}) + [None] * any(s is None for _, s, _ in docs)
    for _, s, n in docs:
        sizes[s] += n
    weight, target, left, free = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, {}, sum(sizes.values()), set(names)
    while True:
        over = {s for s in free if weight[s] * left / sum(weight[x] for x in free) > 3 * sizes[s]}
        if not over:
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        left, free = left - sum(3 * sizes[s] for s in over), free - over
    target |= {s: weight[s] * left / sum(weight[x] for x in free) for s in free}
    source, size = {d: s for d, s, _ in docs}, {d: n for d, _, n in docs}
    got = QUERIES["op5_source_mix"](spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(size)
    taken, per_shard = Counter(), Counter()
    for r in got:
        s = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], sizes[s]) and r["target"] == pytest.approx(target[s])
        assert r["taken"] == r["size"] * len(r["shards"]) and len(r["shards"]) <= 3
        taken[s] += r["taken"]
        per_shard.update(r["shards"])
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] + 5 for s in names)
    assert set(per_shard) == set(range(32)) and max(per_shard.values()) < 3 * min(per_shard.values())


def test_query_over_the_table(spark):
    got = QUERIES["op5_source_mix"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 200 and all(r["taken"] <= 3 * r["size"] for r in got)
    assert {r["taken"] % max(1, r["size"]) for r in got} == {0}
