"""Wrong transitions in the one reading of the words: the same as from the judged stream, and nothing else is written."""

import pytest
from pyspark.sql import functions as F
from test_windows import tables

from streamloom.operators import candidates as cd
from streamloom.operators import evaluate as ev
from streamloom.operators import stream as st
from streamloom.operators.shared import write_and_read
from streamloom.plans import reference


@pytest.mark.parametrize("name", ["eval_class_stats", "eval_recall", "eval_class_report"])
def test_words_are_shuffled_and_sorted_once(spark, monkeypatch, name):
    written = []
    monkeypatch.setattr(reference, "write_and_read", lambda df, purpose: written.append(df) or df)
    reference.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert len(written) == 1
    plan = written[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") <= 2  # words and turns
    assert plan.count("Join") == 1


@pytest.mark.parametrize("stays", [1, 4, 15])
def test_errors_of_words_are_those_of_the_judged_stream(spark, monkeypatch, stays):
    monkeypatch.setattr(cd, "GROUP_ROWS", 100)
    words, turns = tables(spark)
    said = F.array(*[F.lit(x) for x in ("SPEAKER_00", "SPEAKER_01", "SPEAKER_02", "SPEAKER_09", "SPEAKER_00", "SPEAKER_12", "none", None)])
    words = words.withColumn("speaker", F.get(said, F.pmod(F.xxhash64("rec_id", F.floor(F.col("i") / stays)), F.lit(8)).cast("int"))).cache()
    who = ev.identity(F.col("asr_speaker"))
    s = write_and_read(st.stream(words, turns), "stream")
    labels, markers = write_and_read(reference.sheet_in_work(s), "gold"), write_and_read(ev.gold_markers(s, who), "markers")
    names = write_and_read(ev.share_map(s, labels, markers), "map")
    j = write_and_read(ev.judged(ev.truth(s, labels, names, markers), names), "judged")
    want = sorted(map(str, ev.errors(j, labels).collect()))
    w = cd.windows_of(st.words_once(words), st.turns_once(turns), 1, ev.identity(F.col("speaker")), reference.BLANK, reference.UNNAMED).cache()
    got = cd.wrong(w).collect()
    assert sorted(map(str, got)) == want
    assert {r.kind for r in got} == {"missed", "spurious"} and any(r.high_harm for r in got) and any(r.misattributed > 1 for r in got)
    plain = cd.windows_of(st.words_once(words), st.turns_once(turns), 1)
    assert sorted(map(str, w.where("kind is null").drop("kind", "misattributed", "high_harm").collect())) == sorted(map(str, plain.collect()))


def test_hours_count_recordings_of_silence_alone(spark, tmp_path):
    words, turns = tables(spark)
    words = words.withColumn("flags", F.when(F.col("rec_id").like("r4%"), F.array(F.lit("silence"))))
    words.write.parquet(f"{tmp_path}/words.parquet")
    turns.write.parquet(f"{tmp_path}/speaker_turns.parquet")
    spark.range(70).selectExpr("'r' || id as rec_id", "3600d as duration_s").write.parquet(f"{tmp_path}/recordings.parquet")
    r = reference.QUERIES["eval_class_stats"](spark, str(tmp_path)).where("level = 'class' and name = 'shift'").first()
    assert r.windows > 0 and r.per_hour_tenths == int(r.windows / 60 * 10 + 0.5)  # 60 recordings have words
