"""License scans and Hamming search against brute force; components."""

import random

from mercato.llm.common import components
from mercato.llm.hamming_search import top_k
from mercato.llm.license_scan import NOTICES, scan, template_words

from .odd import documents, texts, with_repeats, words


def test_licenses_match_brute_force(spark):
    r = random.Random(3)
    rows = dict(texts())
    for k, (name, notice) in enumerate(sorted(NOTICES.items())):
        rows[100 + k] = words(k, 30) + "\n" + notice + "\n" + words(k + 50, 20)
        w = notice.split()
        for _ in range(max(1, len(w) // 40)):
            w[r.randrange(len(w))] = "changed"
        rows[200 + k] = words(k, 3) + " " + " ".join(w)
        rows[300 + k] = notice.upper()
        rows[400 + k] = " ".join(notice.split()[: len(notice.split()) // 2])
    got = {(x["doc_id"], x["license"]): (x["n_shared"], x["containment"]) for x in scan(documents(spark, rows)).collect()}
    want = {}
    for name, notice in NOTICES.items():
        t = template_words(notice)
        size = min(5, len(t))
        wanted = {tuple(t[i:i + size]) for i in range(len(t) - size + 1)}
        for k, text in rows.items():
            w = template_words(text or "")
            n = len(wanted & {tuple(w[i:i + size]) for i in range(len(w) - size + 1)})
            if 100 * n >= 75 * len(wanted):
                want[k, name] = (n, n / len(wanted))
    assert got == want and len(want) > 3 * len(NOTICES) - 8


def test_license_odd_inputs(spark):
    assert scan(documents(spark, {})).count() == 0
    assert scan(documents(spark), {}).count() == 0 and scan(documents(spark), {"blank": " "}).count() == 0
    got = scan(with_repeats(spark)).collect()
    assert [(r["doc_id"], r["license"]) for r in got] == [(17, "mit-line")]
    plan = scan(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


VECTORS = "vec_id long, embedding array<float>, label int"


def sign_code(v, bits):
    return [i < len(v) and v[i] is not None and v[i] == v[i] and v[i] > 0 for i in range(bits)]


def test_top_k_matches_brute_force(spark):
    r = random.Random(9)
    base = [[r.gauss(0, 1) for _ in range(12)] for _ in range(5)]
    rows = [(k, [x + r.gauss(0, 0.7) for x in r.choice(base)], 0) for k in range(300)]
    rows += [(300 + k, base[0], 0) for k in range(40)]  # a hot code
    rows += [(400, None, 0), (None, base[0], 0), (401, [], 1), (402, [None, float("nan"), 1.0], 1), (403, [1.0] * 20, 1)]
    df = spark.createDataFrame(rows, VECTORS)
    for k, bits, segment in ((5, 12, 4), (50, 12, 5), (500, 8, 8)):
        got = sorted(map(tuple, top_k(df, df.where("vec_id % 100 = 0"), k, bits, segment).collect()))
        want = []
        codes = {i: sign_code(v, bits) for i, v, _ in rows if i is not None and v is not None}
        for q in (i for i in codes if i % 100 == 0):
            near = sorted((sum(a != b for a, b in zip(codes[q], c)), i) for i, c in codes.items() if i != q)[:k]
            want += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
        if k < 340:
            assert got == sorted(want)
        else:  # of equal codes, only the k + 1 smallest ids are kept, which are all here
            assert len(got) == len(want)


def test_top_k_of_nothing(spark):
    none = spark.createDataFrame([], VECTORS)
    assert top_k(none, none).count() == 0
    one = spark.createDataFrame([(0, [1.0], 0)], VECTORS)
    assert top_k(one, one).count() == 0


def test_components(spark):
    edges = [(k, k + 1) for k in range(50)] + [(100, 200 + k) for k in range(30)] + [(300, 300), (400, 401), (401, 400)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(51)}, 100: 100, **{200 + k: 100 for k in range(30)}, 400: 400, 401: 400}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
