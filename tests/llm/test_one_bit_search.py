import numpy as np

from marketbars.llm import one_bit_search as search

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, queries, k):
    ok = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v):
            ok.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    out = {}
    for q in queries:
        best = {}
        for v in ok.get(q, []):
            for i, others in ok.items():
                for o in others:
                    if i != q and len(o) == len(v):
                        s = float((v * o).sum() / np.sqrt((v * v).sum()) / np.sqrt((o * o).sum()))
                        best[i] = max(best.get(i, -2), s)
        out[q] = sorted(best.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k]
    return out


def run(spark, rows, queries, k=5):
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    hits = search.nearest(table, table.where(table.vec_id.isin(queries)), k).collect()
    got = {}
    for r in sorted(hits, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    return got


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((20, 64))
    rows = [(i, (centres[i % 20] + rng.standard_normal(64)).tolist()) for i in range(3000)]
    queries = list(range(0, 3000, 50))
    expected, got = brute(rows, queries, 5), run(spark, rows, queries)
    same = sum(len({i for i, _ in expected[q]} & {i for i, _ in got[q]}) for q in queries)
    assert same >= 0.98 * 5 * len(queries)
    for q in queries:
        scores = dict(expected[q])
        for i, s in got[q]:
            assert i not in scores or abs(s - scores[i]) < 1e-12


def test_the_error_bound_holds():
    rng = np.random.default_rng(5)
    rows, queries = rng.standard_normal((2000, 64)), rng.standard_normal((50, 64))
    codes, corrections = search.encode(rows)
    guess, error = search.estimate(codes, corrections, search._unit(queries) @ search.rotation(64))
    true = search._unit(queries) @ search._unit(rows).T
    assert (np.abs(guess - true) <= error).mean() > 0.98
    assert abs((guess - true).mean()) < 0.005


def test_ties_copies_and_unusable_vectors(spark):
    rng = np.random.default_rng(7)
    base = rng.standard_normal(8).astype(np.float32).tolist()
    rows = [(i, base) for i in range(40)]
    rows += [(100 + i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(20)]
    rows += [(200, None), (201, [0.0] * 8), (202, [float("nan")] * 8), (203, [1.0, None] * 4),
             (204, [float("inf")] + [1.0] * 7), (205, []), (None, base), (206, [1.0, 2.0]),
             (207, [2.0, 4.0]), (100, base), (300, [x * 1e30 for x in base]), (301, [-x for x in base])]
    queries = [0, 7, 39, 100, 200, 201, 203, 205, 206, 301]
    expected, got = brute(rows, queries, 5), run(spark, rows, queries)
    for q in queries:
        assert [i for i, _ in got.get(q, [])] == [i for i, _ in expected[q]], q
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[206]] == [207]


def test_blocks_of_queries_and_empty_tables(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(i, rng.standard_normal(16).astype(np.float32).tolist()) for i in range(120)]
    one = run(spark, rows, list(range(0, 120, 10)))
    monkeypatch.setattr(search, "QUERY_BLOCK_BYTES", 500)
    assert run(spark, rows, list(range(0, 120, 10))) == one
    assert run(spark, rows[:3], [0]) and len(run(spark, rows[:3], [0])[0]) == 2
    assert run(spark, [], []) == {}


def test_an_id_with_several_near_vectors_takes_one_place(spark):
    rng = np.random.default_rng(11)
    base = rng.standard_normal(16)
    near = [(9, (base + 0.01 * rng.standard_normal(16)).tolist()) for _ in range(30)]
    near += [(8, (base + 0.02 * rng.standard_normal(16)).tolist()) for _ in range(30)]
    far = [(100 + i, rng.standard_normal(16).tolist()) for i in range(30)]
    rows = [(1, base.tolist()), *near, *far]
    expected, got = brute(rows, [1, 8], 5), run(spark, rows, [1, 8])
    for q in (1, 8):
        assert len(got[q]) == 5 and [i for i, _ in got[q]] == [i for i, _ in expected[q]]
