"""Candidate windows in one reading: the same as from the labelled stream, by plans that stay small."""

import random

import pytest
from pyspark.sql import functions as F

from streamloom.operators import candidates as cd
from streamloom.operators import stream as st
from streamloom.plans import reference

QUERIES = ["cand_sites", "cand_v2", "cand_volume", "agg_site_lengths"]


@pytest.mark.parametrize("name", QUERIES)
def test_words_are_shuffled_and_sorted_once(spark, monkeypatch, name):
    written = []
    monkeypatch.setattr(reference, "write_and_read", lambda df, purpose: written.append(df) or df)
    reference.QUERIES[name](spark, "/root/testdata/sf0.001")
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in written]
    assert len(plans) == 1
    assert plans[0].count("Exchange hashpartitioning(") <= 2  # words and turns
    assert plans[0].count("- Window ") <= 5
    assert plans[0].count("Join") == 1


def tables(spark):
    r = random.Random(7)
    words, turns, nan = [], [], float("nan")
    texts = "yes no? Right. okay, um you your anyone? go ahead. i I'm cat dog, Well so. what? Mr. then; mm-hmm".split()
    for k in range(60):
        t, u = 0.0, 0.0
        for i in range(r.choice([1, 2, 9, 70])):
            a, b = t, t + r.choice([0.1, 0.3])
            t = b + r.choice([0, 0, 0.004, 0.31, 0.6, 2.0])
            if k % 3 == 0:
                a, b = r.choice([(a, b)] * 9 + [(None, b), (a, None), (nan, b), (a, nan), (nan, nan), (b, a), (a, b + 70)])
            words.append((f"r{k}", i, r.choice(texts), a, b, ["silence"] if r.random() < 0.03 else None, None))
        for n in range(30 if k % 10 else 0):
            d = r.choice([0.0, 0.1, 0.5, 2.0, 40.0])
            turns.append((f"r{k}", n, u, u + d, r.choice("ABC")))
            u += r.choice([0.2, 1.0, 3.0])
    words = spark.createDataFrame(words, "rec_id string, i int, text string, start_s double, end_s double, flags array<string>, speaker string").selectExpr("*", "cast(null as timestamp) as loaded_at")
    return words, spark.createDataFrame(turns, "rec_id string, turn_ord int, start_s double, end_s double, speaker string").selectExpr("*", "cast(null as timestamp) as loaded_at")


@pytest.mark.parametrize("version", [1, 2])
def test_windows_of_words_are_those_of_the_stream(spark, monkeypatch, version):
    monkeypatch.setattr(cd, "GROUP_ROWS", 100)
    words, turns = tables(spark)
    own = st.turns_once(turns)
    w = cd.windows_of(st.words_once(words), own, version).cache()
    got = sorted(map(str, cd.found_windows(w, version).collect()))
    stream = st.stream(words, turns).cache()
    want = sorted(map(str, cd.candidates(stream, own, version).collect()))
    assert got == want and len(got) > 300
    counts = {r.rec_id: (r.n_words, r.n_boundaries) for r in w.where("class is null").collect()}
    assert counts == {r.rec_id: (r.n, r.c) for r in stream.groupBy("rec_id").agg(F.count("*").alias("n"), F.count_if("change").alias("c")).collect()}
