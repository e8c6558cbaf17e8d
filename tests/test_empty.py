"""Empty tables, recordings without turns and words without times through the window and score operators."""

from pyspark.sql import functions as F

from streamloom.operators import candidates as cd
from streamloom.operators import evaluate as ev
from streamloom.operators import stream as st

W = "rec_id string, i int, text string, start_s double, end_s double, flags array<string>, speaker string, loaded_at timestamp"
T = "rec_id string, turn_ord int, start_s double, end_s double, speaker string, loaded_at timestamp"


def test_empty_streams_give_no_windows_and_no_scores(spark):
    s = st.stream(spark.createDataFrame([], W), spark.createDataFrame([], T))
    turns = st.turns_once(spark.createDataFrame([], T))
    for version in (1, 2):
        assert cd.candidates(s, turns, version).count() == 0
    g = ev.gold(s, ev.identity(F.col("asr_speaker")))
    assert ev.near_misses(g, s.select("rec_id", "pos").limit(0)).count() == 0


def test_streams_without_turns_or_times(spark):
    rows = [("a", n, t, None, None, None, None, None) for n, t in enumerate(["Is", "it?", "Yes.", None, ""])]
    rows += [("b", n, t, float(n), n + 0.5, [], "SPEAKER_01", None) for n, t in enumerate(["well", "so", "on."])] + [("b", 0, "well", 0.0, 0.5, [], "SPEAKER_01", None), (None, 1, "x", None, None, None, None, None)]
    turns = spark.createDataFrame([("b", 0, 0.0, 1.2, "A", None), ("b", 1, 1.2, 3.0, "B", None), ("b", 1, 1.2, 3.0, "B", None), ("c", 0, 0.0, 1.0, "A", None), ("b", 2, None, 3.0, "B", None)], T)
    s = st.stream(spark.createDataFrame(rows, W), turns)
    got = {(r.rec_id, r.i): r.speaker for r in s.collect()}
    assert got == {**{("a", n): None for n in range(5)}, ("b", 0): "A", ("b", 1): "B", ("b", 2): "B"}
    t = st.turns_once(turns)
    for version in (1, 2):
        found = cd.candidates(s, t, version).collect()
        # A question and its answer stand in the recording without speakers, too.
        assert {(r.rec_id, r["class"]) for r in found} >= {("a", "question_answer"), ("b", "shift")} and {r.rec_id for r in found} == {"a", "b"}
        assert all(0 <= r.a < r.b <= {"a": 4, "b": 2}[r.rec_id] and r.first_i == r.a and r.last_i == r.b for r in found)
