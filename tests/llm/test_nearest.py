import numpy as np

from streamloom.llm.nearest_time import LearnedIndex, nearest_in_time

L, R = "k string, t long, name string", "k string, t long, o long, name string"


def brute(left, right, tol):
    out = []
    for k, t, name in left:
        near = [(abs(t - u), o, u) for q, u, o, _ in right if q == k and k is not None and t is not None and u is not None and o is not None and abs(t - u) <= tol]
        if near:
            _, o, u = min(near)
            out.append((k, t, name, o, u))
    return sorted(out, key=str)


def run(spark, left, right, tol, shard=600_000):
    a, b = spark.createDataFrame(left, L), spark.createDataFrame(right, R)
    return sorted((tuple(r) for r in nearest_in_time(a, b, ["k"], "t", "t", "o", tol, "order", "time", shard).collect()), key=str)


def test_index_error_is_bounded_and_search_exact():
    rng = np.random.default_rng(2)
    for _ in range(20):
        parts = [np.unique(np.cumsum(rng.integers(1, rng.choice([2, 500]), int(rng.integers(1, 400))))) for _ in range(4)]
        g = np.repeat(np.arange(4), [len(p) for p in parts])
        v = np.concatenate(parts)
        ix = LearnedIndex(g, v, 4)
        size = ix.last - ix.first + 1
        at = np.arange(len(v))
        seg = np.repeat(np.arange(len(size)), size)
        assert np.abs(ix._line(ix.first[seg], ix.last[seg], v) - at).max() <= 4
        qg, x = rng.integers(0, 5, 200), rng.integers(-5, int(v.max()) + 5, 200)
        pos, lo, hi = ix.lower_bound(qg, x)
        for n in range(200):
            own = np.flatnonzero(g == qg[n])
            if not len(own):
                assert lo[n] > hi[n]
            else:
                assert (lo[n], hi[n]) == (own[0], own[-1]) and pos[n] == own[0] + np.searchsorted(v[own], x[n])


def test_random_tables_match_brute_force_for_any_shard(spark):
    rng = np.random.default_rng(5)
    key = lambda: [None, "a", "b"][int(rng.choice(3, p=[0.1, 0.6, 0.3]))]
    left = [(key(), None if rng.random() < 0.05 else int(rng.integers(3000)), "l") for _ in range(150)]
    right = [(key(), None if rng.random() < 0.05 else int(rng.integers(3000)), None if rng.random() < 0.05 else n, "r") for n in range(200)]
    right += right[:30]
    for shard in (37, 500, 10**9):
        assert run(spark, left, right, 25, shard) == brute(left, right, 25)


def test_ties_take_the_lowest_order_and_tolerance_is_included(spark):
    right = [("a", 90, 5, "r"), ("a", 110, 3, "r"), ("a", 110, 2, "r"), ("a", 300, 0, "r")]
    assert run(spark, [("a", 100, "x"), ("a", 290, "y"), ("a", 289, "z"), ("a", 100, "x")], right, 10) == [("a", 100, "x", 2, 110), ("a", 100, "x", 2, 110), ("a", 290, "y", 0, 300)]


def test_empty_sides(spark):
    assert run(spark, [], [("a", 1, 1, "r")], 5) == [] and run(spark, [("a", 1, "l")], [], 5) == []
