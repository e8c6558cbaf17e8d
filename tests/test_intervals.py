import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs

from streamloom.operators.intervals import periods_and_gaps
from streamloom.operators.sessions import SessionTable, sessions

IV = "k string, start long, end long, piece string"


def brute(rows, gap=0):
    by = {}
    for k, s, e in rows:
        if s is not None and e is not None and e > s:
            by.setdefault(k, []).append((s, e))
    out = set()
    for k, iv in by.items():
        merged = []
        for s, e in sorted(iv):
            if merged and s <= merged[-1][1] + gap:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        out |= {(k, "period", s, e) for s, e in merged}
        out |= {(k, "gap", a[1], b[0]) for a, b in zip(merged, merged[1:])}
    return out


def run(spark, rows, block):
    df = spark.createDataFrame([(k, s, e, "x") for k, s, e in rows], IV)
    return [tuple(r) for r in periods_and_gaps(df, ["k"], "start", "end", block).collect()]


def test_nested_touching_and_gapped_intervals(spark):
    rows = [("a", 0, 100), ("a", 10, 20), ("a", 100, 120), ("a", 121, 130), ("a", 121, 130), ("a", 5, 5), ("a", 9, 3), ("a", None, 7), (None, 1, 2), (None, 2, 3)]
    got = run(spark, rows, 50)
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_long_interval_over_many_blocks(spark):
    rows = [("a", 0, 1000)] + [("a", t, t + 3) for t in range(10, 1100, 7)] + [("a", 5000, 5001)]
    assert set(run(spark, rows, 20)) == brute(rows)


def test_empty_table(spark):
    assert run(spark, [], 50) == []


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(hs.lists(hs.tuples(hs.sampled_from(["a", "b", None]), hs.integers(0, 300), hs.integers(0, 40)), max_size=40), hs.sampled_from([7, 64, 10_000]))
def test_any_intervals_match_brute_force(spark, rows, block):
    rows = [(k, s, s + d) for k, s, d in rows]
    assert set(run(spark, rows, block)) == brute(rows)


SES = "k string, s long, e long, n long"


def session_brute(rows, gap):
    by = {}
    for k, s, e, n in rows:
        if s is not None and e is not None and e >= s:
            by.setdefault(k, []).append((s, e, n))
    out = []
    for k, ev in by.items():
        cur = None
        for s, e, n in sorted(ev):
            if cur and s <= cur[1] + gap:
                cur[1], cur[2] = max(cur[1], e), cur[2] + n
            else:
                cur = [s, e, n]
                out.append((k, cur))
    return sorted(((k, *c) for k, c in out), key=str)


def test_sessions_match_brute_force_for_any_block(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), t := rng.randrange(5000), t + rng.randrange(60), 1) for _ in range(400)] + [("a", None, 3, 1), ("a", 9, 2, 1)]
    df = spark.createDataFrame(rows, SES)
    for block in (50, 100_000):
        got = sorted(map(tuple, sessions(df, ["k"], "s", "e", 20, {"n": "sum"}, block).collect()), key=str)
        assert got == session_brute(rows, 20)


def test_late_rows_bridge_stored_sessions(spark):
    table = SessionTable.create(spark, ["k"], "s", "e", 10, {"n": "sum"})
    table.merge(spark.createDataFrame([("a", 0, 5, 1), ("a", 30, 35, 1), ("b", 0, 1, 1)], SES))
    assert table.read().count() == 3
    table.merge(spark.createDataFrame([("a", 12, 22, 1)], SES))
    assert sorted(map(tuple, table.read().collect())) == [("a", 0, 35, 3), ("b", 0, 1, 1)]
    table.merge(spark.createDataFrame([], SES))
    assert sorted(map(tuple, table.read().collect())) == [("a", 0, 35, 3), ("b", 0, 1, 1)]


def test_batches_in_any_order_give_the_same_table(spark):
    rng = random.Random(5)
    rows = [("a", t := rng.randrange(2000), t + rng.randrange(9), 1) for _ in range(90)]
    table = SessionTable.create(spark, ["k"], "s", "e", 15, {"n": "sum"})
    for part in (rows[60:], rows[:30], rows[30:60]):
        table.merge(spark.createDataFrame(part, SES))
    assert sorted(map(tuple, table.read().collect()), key=str) == session_brute(rows, 15)


def test_a_merge_that_dies_leaves_the_table(spark):
    table = SessionTable.create(spark, ["k"], "s", "e", 10, {"n": "sum"})
    table.merge(spark.createDataFrame([("a", 0, 5, 1)], SES))
    try:
        table.merge(spark.createDataFrame([("a", 0, 5, 1)], SES).selectExpr("k", "s", "raise_error('lost') as e", "n"))
    except Exception:
        pass
    assert [tuple(r) for r in table.read().collect()] == [("a", 0, 5, 1)]


def _bucket_files(table):
    return dict(table._manifest()["files"])


def test_a_merge_touches_its_own_buckets_only(spark):
    table = SessionTable.create(spark, ["k"], "s", "e", 10, {"n": "sum"}, buckets=8)
    table.merge(spark.createDataFrame([(f"k{n}", 0, 5, 1) for n in range(40)], SES))
    before = _bucket_files(table)
    table.merge(spark.createDataFrame([("k3", 7, 9, 1)], SES))
    after = _bucket_files(table)
    changed = [b for b in after if after[b] != before.get(b)]
    assert len(before) > 4 and set(after) == set(before) and len(changed) == 1
    assert sorted(map(tuple, table.read().collect())) == sorted([("k3", 0, 9, 2)] + [(f"k{n}", 0, 5, 1) for n in range(40) if n != 3])


def test_a_table_opens_again_and_a_batch_counts_once(spark, tmp_path):
    path = str(tmp_path / "table")
    SessionTable.create(spark, ["k"], "s", "e", 10, {"n": "sum"}, path=path).merge(spark.createDataFrame([("a", 0, 5, 1), ("b", 0, 5, 1)], SES), 0, "x")
    table = SessionTable.open(spark, path)
    assert sorted(map(tuple, table.read().collect())) == [("a", 0, 5, 1), ("b", 0, 5, 1)]
    late = spark.createDataFrame([("a", 12, 14, 1)], SES)
    for batch_id in (1, 1, 0):
        SessionTable.open(spark, path).merge(late, batch_id, "x")
    assert sorted(map(tuple, table.read().collect())) == [("a", 0, 14, 2), ("b", 0, 5, 1)]
    table.merge(late, 0, "another stream")
    assert sorted(map(tuple, table.read().collect())) == [("a", 0, 14, 3), ("b", 0, 5, 1)]


def test_old_versions_go_and_a_second_writer_is_refused(spark, tmp_path):
    import os

    import pytest

    path = str(tmp_path / "table")
    table = SessionTable.create(spark, ["k"], "s", "e", 10, {"n": "sum"}, path=path, buckets=1)
    with pytest.raises(ValueError):
        table.read()
    for n in range(4):
        table.merge(spark.createDataFrame([("a", 100 * n, 100 * n + 5, 1)], SES))
    assert sorted(f for f in os.listdir(f"{path}/manifest") if f.startswith("v")) == ["v3", "v4"]
    assert len([d for d in os.listdir(f"{path}/data") if os.path.isdir(f"{path}/data/{d}") and any(x.startswith("__sl_") for x in os.listdir(f"{path}/data/{d}"))]) == 2
    stale = table._manifest()
    table._manifest = lambda version=None: {**stale, "version": 3}
    with pytest.raises(RuntimeError):
        table.merge(spark.createDataFrame([("a", 900, 905, 1)], SES))
    with pytest.raises(FileNotFoundError):
        SessionTable.open(spark, str(tmp_path / "nothing"))
