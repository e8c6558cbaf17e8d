import pytest
from pyspark.sql import functions as F

from streamloom.functions import times as tm
from streamloom.functions import tokens as tk
from streamloom.operators import disfluency as dis
from streamloom.operators import stream as st

TOK = "rec_id string, pos int, i int, text string, start_s double, end_s double, flags array<string>, speaker_raw string"


def words(spark, texts, rec="r", labels=None, times=None, flags=None):
    rows = [(rec, n, n, t, *([None if x is None else float(x) for x in times[n]] if times else (n * 0.3, n * 0.3 + 0.3)), (flags or {}).get(n, []), labels[n] if labels else None) for n, t in enumerate(texts)]
    return spark.createDataFrame(rows, TOK).withColumn("flags", F.array_union("flags", tk.flags_of(F.col("text"))))


def col(spark, texts, f):
    return [r[0] for r in spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, text string").orderBy("n").select(f(F.col("text"))).collect()]


def test_flags_of_tokens(spark):
    texts = ["_", "[UH]", "(um)", "[laughter]", "[Throat clearing]", "[beep]", "p-", "“de-”", "word", "20-", "", None, "<yawn>"]
    want = [["silence"], ["filled_pause"], ["filled_pause"], ["vocalization"], ["vocalization"], ["unknown_marker"], ["partial_word"], ["partial_word"], [], [], [], [], ["vocalization"]]
    assert col(spark, texts, tk.flags_of) == want


def test_terminals(spark):
    texts = ["end.", "Dr.", "e.g.", "J.", "j.", "why?", "no!”", "[laughs.]", "word", "Ph.D.", "3."]
    assert col(spark, texts, tk.is_terminal) == [True, False, False, False, True, True, True, False, False, False, True]


def test_fluent_view_vectors(spark):
    v = dis.fluent_view(words(spark, "So [UM] the the p- process is 2005 twenty years.".split())).orderBy("fpos").collect()
    assert " ".join(r.piece for r in v) == "so the process is <num> years"
    assert [r.pos for r in v] == [0, 2, 5, 6, 7, 9]
    v = dis.fluent_view(words(spark, "gonna them's self-report don't".split())).orderBy("fpos").collect()
    assert " ".join(r.piece for r in v) == "going to them is self report dont"


def events(spark, text, **kw):
    e = dis.events(words(spark, text.split()), **kw)
    return sorted((r.i, r.kind, r.shape, r.n_abandoned) for r in e.collect())


def test_greedy_restatements(spark):
    assert [e[0] for e in events(spark, "as as as a as a")] == [0, 1, 2] and sum(e[3] for e in events(spark, "as as as a as a")) == 4


def test_partials_and_repairs(spark):
    assert events(spark, "de- developmental")[0][1:3] == ("repair", "completed_partial")
    assert [e[1] for e in events(spark, "d- d- what")] == ["repetition"]
    assert events(spark, "I went I drove home")[0][2] == "substitution"
    assert events(spark, "I came. I saw it") == []
    assert events(spark, "You're [UH] you are right")[0][1:] == ("repetition", "restatement", 1)
    assert events(spark, "I went I drove home", shapes=("restatement",)) == []
    with pytest.raises(ValueError):
        dis.events(words(spark, ["a"]), shapes=("other",))


def test_repetition_adds_flags_and_keeps_text(spark):
    w = words(spark, "not not mirror".split())
    f = dis.flagged(w, dis.events(w)).orderBy("pos").collect()
    assert [r.text for r in f] == ["not", "not", "mirror"] and [r.flags for r in f] == [["repetition"], [], []]


def smooth(spark, labels, times=None):
    return [r.speaker for r in st.smoothed(words(spark, ["w"] * len(labels), labels=labels, times=times)).orderBy("pos").collect()]


def test_smoothing_flips_short_islands_without_cascade(spark):
    assert smooth(spark, list("AAABAAA")) == list("AAAAAAA")
    # Each inner island is judged by its neighbours' labels before any flip: all three swap.
    assert smooth(spark, list("ABABA")) == ["A", "A", "B", "A", "A"]
    assert smooth(spark, list("AABBBAA")) == list("AABBBAA")
    assert smooth(spark, list("ABC")) == list("ABC")
    assert smooth(spark, ["A", None, "A"]) == ["A", "A", "A"]


def test_islands_beside_a_pause_stay(spark):
    times = [(0, 0.3), (0.3, 0.6), (2.0, 2.3), (2.3, 2.6), (2.6, 2.9)]
    assert smooth(spark, list("AABAA"), times) == list("AABAA")
    assert smooth(spark, list("AABAA"), [(0.0, 0.25), (0.25, 0.5), (1.0, 1.25), (1.25, 1.5), (1.5, 1.75)]) == list("AAAAA")


def test_assignment_prefers_overlap_then_first_then_nearest(spark):
    turns = spark.createDataFrame([("r", 0, 0.0, 1.0, "A", 0), ("r", 1, 0.5, 2.0, "B", 1), ("r", 2, 5.0, 6.0, "C", 2)], "rec_id string, turn_ord int, start_s double, end_s double, speaker string, ord int")
    times = [(0.1, 0.3), (0.6, 0.9), (0.9, 1.4), (3.0, 3.2), (3.9, 4.1), (1.8, 1.8), (None, 2.0), (9.0, 9.5)]
    w = words(spark, ["w"] * len(times), times=times).drop("speaker_raw")
    got = [r.speaker_raw for r in st.assigned(w, turns).orderBy("pos").collect()]
    assert got == ["A", "A", "B", "B", "C", "B", None, "C"]
    assert {r.speaker_raw for r in st.assigned(w, turns.where("rec_id = 'x'")).collect()} == {None}


def test_sentences_break_in_order_of_precedence(spark):
    labels = list("AAAAAB")
    times = [(0, 0.3), (0.3, 0.6), (0.6, 0.9), (1.5, 1.8), (1.8, 2.1), (2.1, 2.4)]
    w = st.smoothed(words(spark, ["Hi.", "Dr.", "Who", "came", "in", "yes"], labels=labels, times=times))
    assert [r.boundary for r in st.sentences(w).orderBy("pos").collect()] == ["punct", None, "pause", None, "speaker", "end"]


def test_a_recording_alone_and_among_others_gives_the_same(spark):
    a, b = words(spark, "So so it is. Yes!".split(), labels=list("AABAA"), rec="a"), words(spark, "No no".split(), labels=list("AB"), rec="b")
    one = [tuple(r) for r in st.sentences(st.smoothed(a)).orderBy("pos").collect()]
    both = [tuple(r) for r in st.sentences(st.smoothed(a.unionByName(b))).where("rec_id = 'a'").orderBy("pos").collect()]
    assert one == both


def test_times(spark):
    row = spark.sql("select 3725.9D a, 59.97D b, '1:02:03.5' c, 'x:1' d, date'2026-09-01' e, date'2026-08-24' f, '20260901' g, '2026.09.01' h, 'soon' i, 0.0015D j")
    r = row.select(tm.clock(F.col("a")), tm.tenths(F.col("b")), tm.clock_seconds(F.col("c")), tm.clock_seconds(F.col("d")), tm.week_number(F.col("e"), F.col("f")), tm.weekday(F.col("e")), tm.any_date(F.col("g")).cast("string"), tm.any_date(F.col("h")).cast("string"), tm.any_date(F.col("i")), tm.hour_minute(F.col("a")), tm.clock(F.col("j"), True)).first()
    assert list(r) == ["01:02:05", "00:00:60.0", 3723.5, None, 2, "Tue", "2026-09-01", "2026-09-01", None, "01:02", "00:00:00.002"]
