"""Queries with SQL twins over the smallest tables, row for row."""

import os

import pytest

import __spark_entry__ as entry

D = "/root/testdata/sf0.001"
CHEAP = ["p2_found", "p5_found", "txt_flags", "join_assign_smooth", "win_sentences", "dis_events", "txt_fluent_view", "win_unrolled", "agg_raw_accounting", "dq_breaches", "eval_share_map", "cand_v1", "cand_v2", "dq_documents", "join_course", "plan_rename", "plan_capabilities", "eval_match", "src_records_round_trip", "arms_bars", "eval_near_misses", "join_nearest_window", "win_tagged_segments"]


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(D):
        con.execute(f"create view {f.split('.')[0]} as select * from '{D}/{f}'")
    return con


def rows(df):
    plain = lambda x: None if x is None or x != x else (round(float(x), 9) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x))
    return sorted((tuple(plain(v) for v in r) for r in df), key=str)


@pytest.mark.parametrize("name", CHEAP)
def test_spark_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, D)
    cols = sorted(got.columns)
    want = duck.execute(f"select {', '.join(chr(34) + c + chr(34) for c in cols)} from ({entry.oracle_sql()[name]}) q").fetchall()
    assert rows(map(tuple, got.select(*cols).collect())) == rows(want)


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
