import random

import numpy as np
import pyarrow as pa

from mercato.llm.jaccard_join import _near, jaccard_components, need, overlap_bound, parity, parity_bits

from .odd import documents, texts, with_repeats, words


def brute(rows):
    sets = {}
    for k, t in rows.items():
        w = (t or "").translate({c: c + 32 for c in range(65, 91)}).split()
        sets[k] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    comp = {k: k for k in rows}
    for a in rows:
        for b in rows:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = comp[a], comp[b]
                comp = {k: min(x, y) if v in (x, y) else v for k, v in comp.items()}
    return {k: (len(sets[k]), comp[k]) for k in rows}


def near_copies(seed, n):
    """Copies of a few texts with one to ten edits, chains of them, and shared passages."""
    r, rows = random.Random(seed), {}
    bases = [words(seed * 100 + k, r.randint(8, 150)) for k in range(4)]
    shared = words(seed, 30)
    for k in range(n):
        w = r.choice(bases).split() if k % 3 else words(seed * 1000 + k, r.randint(3, 80)).split()
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = f"edit{r.randint(0, 50)}"
        rows[k] = " ".join(w) + (" " + shared if k % 4 == 0 else "")
    for k in range(n, n + 20):  # a chain: each a word further
        rows[k] = " ".join(bases[0].split() + [f"tail{j}" for j in range(k - n)])
    return rows


def test_components_match_brute_force(spark):
    rows = near_copies(3, 120) | {1000 + k: t for k, t in texts().items()}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(documents(spark, rows)).collect()}
    assert got == brute(rows)


def test_cost_settings_do_not_change_the_result(spark):
    rows = near_copies(4, 60)
    out = jaccard_components(documents(spark, rows), sample_percent=100, frequent_at=2, most_frequent=50)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out.collect()} == brute(rows)


def test_bitmaps_bound_the_overlap():
    r = np.random.default_rng(1)
    for _ in range(200):
        a, b = (np.unique(r.integers(0, 400, r.integers(1, 300)).astype(np.uint64) << np.uint64(33)) for _ in range(2))
        assert overlap_bound(parity(parity_bits(a)), parity(parity_bits(b)), len(a), len(b)) >= len(np.intersect1d(a, b))
    for a in range(1, 40):
        for b in range(1, 40):
            assert need(a, b, 75) == min(o for o in range(a + b + 1) if 100 * o >= 75 * (a + b - o))


def test_first_round_tries_more_than_the_neighbour():
    """A row whose neighbour in size is too far still meets those before; another key starts anew."""
    one, far = (np.sort(np.random.default_rng(k).integers(0, 1 << 63, 100).astype(np.uint64)) for k in (1, 2))
    rows = [(7, 100, 1, parity_bits(far)), (7, 100, 2, parity_bits(one)), (7, 100, 3, parity_bits(far)), (7, 100, 4, parity_bits(one)),
            (8, 100, 5, parity_bits(one))]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.binary()))],
                                       names=["key", "n", "rep", "bits"])
    found = {(r["a"], r["b"]) for out in _near(75)([batch]) for r in out.to_pylist()}
    assert found == {(1, 3), (2, 4)}


def test_odd_inputs(spark):
    assert jaccard_components(documents(spark, {})).count() == 0
    got = jaccard_components(with_repeats(spark)).collect()
    assert len(got) == len(texts()) + 3
    assert all(r["component_id"] is None for r in got if r["doc_id"] is None)
    one = {r["doc_id"]: r for r in got}
    assert one[5]["n_shingles"] == one[6]["n_shingles"] == one[7]["n_shingles"] == 0 and one[7]["component_id"] == 7
    assert one[15]["component_id"] == 9 and one[2]["component_id"] == 0
