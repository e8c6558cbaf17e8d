import struct

import pytest
from pyspark.sql import functions as F

from streamloom.operators import align as al
from streamloom.operators import evaluate as ev
from streamloom.operators import quality as ql
from streamloom.operators import timeline as tl
from streamloom.operators.calendar import rename_plan
from streamloom.sources import headers as hd
from streamloom.sources import intervals as si
from streamloom.sources import records as sr


def test_derived_starts(spark):
    w = spark.createDataFrame([("r", n, None, e) for n, e in enumerate([1.0, 2.5, 3.0])], "rec_id string, pos int, start_s double, end_s double")
    assert [r.start_s for r in tl.derived_starts(w).orderBy("pos").collect()] == [0.0, 1.0, 2.5]


def test_clock_tags_roll_over(spark):
    text = " ".join(f"w{n} [T:{t}]" for n, t in enumerate([980, 30, 120, 50, 150])) + " tail"
    t = spark.createDataFrame([("r", text)], "rec_id string, text string")
    assert [r.end_s for r in tl.unrolled(t).orderBy("k").collect()] == [9.8, 10.3, 11.2, 20.5, 21.5]
    assert t.select(tl.untagged(F.col("text"))).first()[0] == "tail"


def test_speaker_tags(spark):
    t = spark.createDataFrame([("r", "lead [Speaker 1]: hello there [Speaker 2]: hi"), ("s", None)], "rec_id string, text string")
    assert [tuple(r)[1:] for r in tl.tagged_segments(t).orderBy("seg").collect()] == [(0, None, "lead"), (1, "Speaker 1", "hello there"), (2, "Speaker 2", "hi")]


def test_turns_from_labels(spark):
    rows = [("r", 0, 0.3, True, "S1"), ("r", 1, 0.6, False, "S1"), ("r", 2, 0.9, False, "S1"), ("r", 3, 1.4, True, "S2"), ("r", 4, 2.2, False, "S2")]
    w = spark.createDataFrame(rows, "rec_id string, pos int, end_s double, silence boolean, label string")
    assert sorted((r.start_s, r.end_s, r.speaker) for r in tl.turns_from_labels(w).collect()) == [(0.3, 0.9, "S1"), (1.4, 2.2, "S2")]


def test_failing_windows_are_halved_to_a_depth(spark):
    r = spark.createDataFrame([("r", 300.0), ("s", 100.0), ("n", None)], "rec_id string, duration_s double")
    w = tl.retried_windows(tl.fixed_windows(r), F.col("start_s") == 0)
    got = sorted((x.rec_id, x.start_s, x.end_s, x.depth, x.lost) for x in w.collect())
    assert got == [("r", 0.0, 37.5, 3, True), ("r", 37.5, 75.0, 3, False), ("r", 75.0, 150.0, 2, False), ("r", 150.0, 300.0, 1, False), ("s", 0.0, 50.0, 1, True), ("s", 50.0, 100.0, 1, False)]


def test_anchors_snap_to_sentences_then_words(spark):
    rows = [("r", n, n, n // 10, float(n * 3), n * 3 + 3.0, 0) for n in range(40)]
    st = spark.createDataFrame(rows, "rec_id string, pos int, i int, sent int, start_s double, end_s double, stretch long")
    got = sorted((r.i, r.kind) for r in tl.anchors(st, 30.0).collect())
    assert got == [(10, "sentence"), (20, "sentence"), (30, "sentence")]
    got = sorted((r.i, r.kind) for r in tl.anchors(st.withColumn("sent", F.lit(0)), 30.0).collect())
    assert got == [(10, "word"), (20, "word"), (30, "word")]


def test_unmatched_follows_the_longest_block(spark):
    a = spark.createDataFrame([("r", n, p, n) for n, p in enumerate("the cat sat on the mat".split())], "rec_id string, fpos int, piece string, pos int")
    b = spark.createDataFrame([("r", "x", n, p) for n, p in enumerate("the cat sad on the mat".split())], "rec_id string, dissenter string, fpos int, piece string")
    assert [r.fpos for r in al.unmatched(a, b, ["x"]).collect()] == [2]


def test_one_to_one_maximises_shared_words(spark):
    c = spark.createDataFrame([("r", "A", "L", 10), ("r", "A", "S", 8), ("r", "B", "L", 9), ("r", "C", None, None), ("r", "D", "S", 1)], "rec_id string, label string, who string, n long")
    got = {r.label: (r.who, r.paired) for r in al.one_to_one(c).collect()}
    assert got == {"A": ("S", True), "B": ("L", True), "C": ("L", False), "D": ("S", False)}


def test_transferred_labels_fill_forward(spark):
    w = spark.createDataFrame([("r", n, k) for n, k in enumerate(["", "hello", "uh", "there", "hi"])], "rec_id string, pos int, key string")
    s = spark.createDataFrame([("r", 0, "hello", "S1"), ("r", 1, "there", "S1"), ("r", 2, "hi", "S2")], "rec_id string, k int, key string, label string")
    assert [r.label for r in al.transferred(w, s).orderBy("pos").collect()] == ["S1", "S1", "S1", "S1", "S2"]


def lecture(spark, labels, verdicts):
    rows = [("r", n, n, lab, n > 0 and lab != labels[n - 1]) for n, lab in enumerate(labels)]
    st = spark.createDataFrame(rows, "rec_id string, pos int, i int, speaker string, change boolean")
    b = [("r", p, k, labels[p - 1], labels[p], v, w) for k, (p, v, w) in enumerate(verdicts)]
    return st, spark.createDataFrame(b, "rec_id string, pos int, bno int, frm string, to string, verdict string, who string")


def test_truth_carries_on_and_unknown_is_an_event(spark):
    st, gold = lecture(spark, list("AABBAABB"), [(2, "real", "S"), (4, None, None), (6, "spurious", None)])
    names = spark.createDataFrame([("r", "A", "L"), ("r", "B", "S")], "rec_id string, label string, who string")
    assert [r.truth for r in ev.truth(st, gold, names).orderBy("pos").collect()] == ["L", "L", "S", "S", None, None, None, None]


def test_causes_misses_and_harm(spark):
    st, gold = lecture(spark, list("AAAAAABB"), [(6, "spurious", None)])
    names = spark.createDataFrame([("r", "A", "L"), ("r", "B", "S")], "rec_id string, label string, who string")
    marks = spark.createDataFrame([("r", 2, 0, "S"), ("r", 4, 0, "L")], "rec_id string, pos int, ord int, who string")
    j = ev.judged(ev.truth(st, gold, names, marks), names)
    runs = {(r.first_i, r.n_words, r.cause, r.direction) for r in ev.error_runs(j).collect()}
    assert runs == {(2, 2, "missed_change", "student_as_instructor"), (6, 2, "spurious_split", "instructor_as_student")}
    assert sorted((r.pos, r.misattributed, r.nearest_boundary) for r in ev.missed_changes(j).collect()) == [(2, 2, 4), (4, 0, 2)]
    s = ev.score(j, gold).first()
    assert (s.scored, s.wrong, s.student_words, s.student_as_instructor, s.missed, s.precision_e4, s.high_harm_runs) == (8, 4, 2, 2, 2, 0.0, 1)


def test_near_misses_are_one_to_one(spark):
    gold = spark.createDataFrame([("r", p, "spurious") for p in (5, 6, 20)], "rec_id string, pos int, verdict string")
    missed = spark.createDataFrame([("r", p) for p in (4, 7, 24)], "rec_id string, pos int")
    got = sorted((r.words, r.pos, r.missed_pos) for r in ev.near_misses(gold, missed, 4).collect())
    assert [sum(w == n for w, _, _ in got) for n in (1, 3, 4)] == [2, 2, 3]
    assert [g for g in got if g[0] == 4] == [(4, 5, 4), (4, 6, 7), (4, 20, 24)]


LINES = "rec_id string, n int, line string"


def test_rttm_is_strict(spark):
    ok = "SPEAKER f 1 0.5 1.25 <NA> <NA> A <NA> <NA>"
    bad = ["SPEAKER f 1 0.5 1.25 <NA> <NA> A <NA>", "LEXEME f 1 0.5 1.25 <NA> <NA> A <NA> <NA>", "SPEAKER f 1 0.5 -1 <NA> <NA> A <NA> <NA>", "SPEAKER f 1 x 1 <NA> <NA> A <NA> <NA>"]
    t, b = si.convert(spark.createDataFrame([("r", n, x) for n, x in enumerate([ok, "", "# note", *bad])], LINES), "rttm")
    assert [(r.start_s, r.end_s, r.speaker) for r in t.collect()] == [(0.5, 1.75, "A")]
    assert sorted(r.why for r in b.collect()) == ["fields", "fields", "negative_duration", "not_a_number"]
    _, b = si.convert(spark.createDataFrame([("r", 0, ok), ("r", 1, ok.replace(" f ", " g "))], LINES), "rttm")
    assert {r.why for r in b.collect()} == {"several_files"}


def test_segments_and_json(spark):
    t, b = si.convert(spark.createDataFrame([("r", 0, "0.080 2.400 speaker_0"), ("r", 1, "0,08 2.400 speaker_0"), ("r", 2, "3.000 2.400 speaker_0")], LINES), "segments")
    assert t.count() == 1 and sorted(r.why for r in b.collect()) == ["bad_interval", "form"]
    j = [("a", '[{"start": 0.5, "end": 1, "speaker": "x"}, {"start": 1, "end": 2}]'), ("b", "{"), ("c", "[]")]
    t, b = si.convert(spark.createDataFrame(j, "rec_id string, text string"), "turns-json")
    assert t.count() == 1 and sorted((r.rec_id, r.why) for r in b.collect()) == [("a", "keys"), ("b", "not_a_list")]
    with pytest.raises(ValueError):
        si.convert(t, "other")


def test_speaker_maps(spark):
    m, b = si.speaker_map(spark.createDataFrame([("r", 1, "A: 'Dr. X' # note"), ("r", 2, "A: Y"), ("r", 3, "# c"), ("r", 4, "B"), ("r", 5, "C:")], LINES))
    assert [tuple(r) for r in m.collect()] == [("r", "A", "Y")] and sorted(r.why for r in b.collect()) == ["empty", "no_colon"]
    assert si.label_spec("A=l, B=S2") == {"A": "L", "B": "S2"}
    for bad in ("A=L,A=S", "A", "", "A=T"):
        with pytest.raises(ValueError):
            si.label_spec(bad)


def wav(day, time, samples, seconds):
    bext = bytes(320) + day.encode() + time.encode() + struct.pack("<Q", samples) + bytes(256)
    chunk = lambda name, body: name + struct.pack("<I", len(body)) + body + bytes(len(body) % 2)
    body = chunk(b"bext", bext) + chunk(b"odd ", b"abc") + chunk(b"fmt ", struct.pack("<HHIIHH", 1, 1, 48000, 96000, 2, 16)) + b"data" + struct.pack("<I", 96000 * seconds)
    return b"RIFF" + struct.pack("<I", len(body) + 4) + b"WAVE" + body


def mp4(text):
    box = lambda name, body: struct.pack(">I4s", len(body) + 8, name) + body
    return box(b"ftyp", b"M4A ") + box(b"free", b"") + box(b"moov", box(b"udta", box(b"date", text.encode())))


def test_headers_tell_when_a_recording_began(spark, tmp_path):
    files = {"a.wav": wav("2026-09-29", "11:22:04", 48000 * 3600 * 10, 60), "b.wav": wav("2026:09:30", "00:10:00", 48000 * 3600 * 23, 60), "c.m4a": mp4("2026-09-29T06:00:00Z"), "d.m4a": mp4("2026-09-29"), "e.bin": b"\0\0", "f.wav": wav("someday...", "11:22:04", 1, 1)}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    h = hd.headers(spark.read.format("binaryFile").load(str(tmp_path)))
    got = {r.path.rsplit("/", 1)[1]: (str(r.date), r.start, r.origin, r.why) for r in hd.recorded(h).collect()}
    assert got["a.wav"] == ("2026-09-29", "10:00:00", "bext", None)
    assert got["b.wav"] == ("2026-09-29", "23:00:00", "bext", None)
    assert got["c.m4a"] == ("2026-09-28", "23:00:00", "mp4", None)
    assert got["d.m4a"][2:] == (None, "mp4_date_without_offset")
    assert got["e.bin"][3] == "no_header" and got["f.wav"][3] == "bext_day_is_no_date"


def test_records_are_read_or_refused(spark, tmp_path):
    (tmp_path / "x_raw.json").write_text('{"schema_version": "1.0",\n "words": [{"i": 0, "text": "a", "flags": []}], "speaker_turns": [{"start": 0, "end": 1, "speaker": "A"}], "errors": [], "secondary_stream": {"mode": "intended", "words": [{"i": 0, "text": "b"}]}, "annotation": {"k": 1}}')
    (tmp_path / "y.json").write_text('{"schema_version": "2.0", "words": []}')
    (tmp_path / "z.json").write_text("{nope")
    good, bad = sr.read_records(spark, str(tmp_path))
    assert [r.rec_id for r in good.collect()] == ["x"] and sorted(r.why for r in bad.collect()) == ["not_json", "version"]
    assert sorted((r.stream, r.text) for r in sr.words_of(good).collect()) == [("primary", "a"), ("secondary", "b")]
    assert sr.selected_stream(good, "intended").first().stream == "secondary"
    assert sr.selected_stream(good, "other").first().warning is not None


def test_rename_plan(spark):
    sem = spark.sql("select 'F26' as term, date'2026-08-24' as start, date'2026-12-11' as end")
    courses = spark.createDataFrame([("F26", "777", ["Mon", "Wed"], "14:00", "15:40"), ("F26", "498", ["Wed"], "09:00", "11:45"), ("F26", "896", ["Fri"], None, None)], "term string, course_code string, weekdays array<string>, t0 string, t1 string").withColumn("t0", F.concat("t0", F.lit(":00"))).withColumn("t1", F.concat("t1", F.lit(":00")))
    files = spark.createDataFrame([("260831_0001.WAV", None, None), ("260902_0001.WAV", 50400.0, 54000.0), ("260902_0002.WAV", None, None), ("260904_0001.wav", None, None), ("260905_0001.wav", None, None), ("notes.txt", None, None), ("250101_0001.wav", None, None)], "name string, span_start double, span_end double")
    got = {r.name: (r.target, r.why) for r in rename_plan(files, sem, courses, "LEC").collect()}
    assert got["260831_0001.WAV"] == ("LEC777-F26-WK2-Mon-2026-08-31.wav", None)
    assert got["260902_0001.WAV"] == ("LEC777-F26-WK2-Wed-1-2026-09-02.wav", None)
    assert got["260902_0002.WAV"][1] == "no_span" and got["260905_0001.wav"][1] == "no_class"
    assert got["notes.txt"][1] == "no_recorder_name" and got["250101_0001.wav"][1] == "no_semester"


def test_capability_conflicts(spark):
    m = spark.createDataFrame([("m", "end_only", False, "no", "no", "needs_chunking", False)], "model string, word_timestamps string, silence_tokens boolean, verbatim string, hotwords string, longform string, speaker_labels boolean")
    r = spark.createDataFrame([("q", "m", True, "verbatim", True, True)], "request string, model string, diarize boolean, mode string, hotwords_given boolean, dual_stream boolean")
    x = ql.capability_plan(m, r).first()
    assert (x.timing_source, x.chunking, x.needs_diarizer) == ("derived", True, True)
    assert x.errors == "verbatim_not_possible,two_streams_not_possible,hotwords_not_possible" and x.warnings == "pauses_fold_into_next_word"


def test_bars_and_decisions(spark):
    from streamloom.operators import arms as ar

    h = spark.createDataFrame([("base", "r", 100, 10, 9000.0, 100), ("good", "r", 40, 5, 9100.0, 50), ("near", "r", 44, 4, 8950.0, 44), ("bad", "r", 51, 5, 9900.0, 51), ("folded", "r", 10, 1, 9900.0, 51)], "arm string, run string, harm_words long, harm_runs long, accuracy_e4 double, pessimistic_words long")
    b = ar.bars(h, "base")
    assert {r.arm: r.passes for r in b.collect()} == {"good": True, "near": True, "bad": False, "folded": False}
    assert ar.decision(b).first().decision == "close: good, near"
    assert ar.decision(b.where("arm <> 'near'")).first().decision == "switch: good"
    assert ar.decision(b.where("arm = 'bad'")).first().decision == "keep"
    runs = spark.createDataFrame([("a", "r1", 5, 1, 9000.0), ("a", "r2", 5, 2, 9900.0)], "arm string, run string, harm_words long, harm_runs long, accuracy_e4 double")
    assert ar.worse_runs(runs).first().run == "r2"


def test_comparisons(spark):
    from streamloom.operators import compare as cp

    a = spark.createDataFrame([(1, "x", [1, 2]), (2, None, []), (3, "z", [1])], "k int, s string, l array<int>")
    b = spark.createDataFrame([(1, "y", [1, 2]), (2, None, [])], "k int, s string, l array<int>")
    assert sorted((r.k, r.path) for r in cp.differences(a, b, ["k"]).collect()) == [(1, "s"), (3, "l"), (3, "s")]
    assert cp.differences(a, a, ["k"]).count() == 0
    w = spark.createDataFrame([("r", 0, 4, "x"), ("r", 3, 6, "y"), ("r", 10, 11, "z")], "rec_id string, a int, b int, class string")
    assert cp.union_size(w, ["rec_id"]).first().covered == 9
    e = spark.createDataFrame([("r", "missed", 8, []), ("r", "missed", 2, ["x"]), ("s", "missed", 1, [])], "rec_id string, kind string, t int, classes array<string>")
    assert sorted((r.rec_id, r.t, r.distance, r["class"]) for r in cp.nearest_windows(e, w).collect()) == [("r", 8, 2, "y"), ("s", 1, None, None)]
    g = spark.createDataFrame([("r", 5, "spurious"), ("r", 9, "real"), ("r", 20, "spurious")], "rec_id string, pos int, verdict string")
    n = spark.createDataFrame([("r", 30)], "rec_id string, n int")
    assert [tuple(r) for r in cp.unanchored(g, spark.createDataFrame([("r", 6)], "rec_id string, pos int"), 3, n).collect()] == [("r", 20, 10)]
    arms = spark.createDataFrame([("a", "1", "r", "s1", "p1", "h1", "rttm"), ("b", "1", "r", "s2", "p1", "h1", "rttm"), ("c", "1", "r", "s1", "p1", "h2", "rttm"), ("d", "1", "r", "s1", "p9", "h1", "rttm"), ("e", "1", "r", "s1", "p1", "h1", "odd")], "arm string, run string, rec_id string, audio_sha256 string, native_path string, native_sha256 string, native_format string")
    got = cp.provenance_breaches(arms, spark.createDataFrame([("r", "s1")], "rec_id string, audio_sha256 string"), spark.createDataFrame([("p1", "h1")], "path string, sha256 string"))
    assert {r.arm: r.why for r in got.collect()} == {"b": "other_audio", "c": "changed_output", "d": "no_output", "e": "unknown_format"}


def test_model_sources(spark):
    from streamloom.sources import models as md

    reg = spark.createDataFrame([("A/b", "x", None), ("c", None, "too old"), (" a/B", "y", None)], "model_id string, adapter string, reason string")
    req = spark.createDataFrame([(" a/b ",), ("C",), ("d",)], "model_id string")
    assert {(r.model_id, r.status) for r in md.resolved(req, reg).collect()} == {(" a/b ", "ok"), ("C", "unsupported"), ("d", "unknown")}
    assert [r.key for r in md.twice(reg).collect()] == ["a/b"]
    c = spark.createDataFrame([("r", 0, " hi ", 0.5, None, 30.0), ("r", 1, " ", 1.0, 2.0, 30.0)], "rec_id string, k int, text string, start_s double, end_s double, window_start double")
    assert [tuple(r) for r in md.chunk_words(c).collect()] == [("r", 0, "hi", 30.5, None)]
    t = spark.createDataFrame([("r", " a\u00a0b  c"), ("s", None)], "rec_id string, text string")
    assert [r.text for r in md.untimed_words(t).orderBy("k").collect()] == ["a", "b", "c"]
    w = spark.createDataFrame([("r", n, n * 1.0) for n in range(5)], "rec_id string, i int, start_s double")
    kept, bad = md.failing(w, 1.0, 3.0)
    assert [r.i for r in kept.orderBy("i").collect()] == [0, 3, 4] and bad.count() == 1
    x = spark.sql("select map('a', 1, 'b', 2) m, 'x, y,,z' h, 'Speaker 1' l, 3 k, 2 n, 1 o")
    r = x.select(md.accepted(F.col("m"), ["b"]), md.hotwords(F.col("h")), md.window_labels(F.col("l"), F.col("k"), F.col("n")), md.window_labels(F.col("l"), F.col("k"), F.col("o"))).first()
    assert list(r) == [{"b": 2}, ["x", "y", "z"], "w3:Speaker 1", "Speaker 1"]
    with pytest.raises(ValueError):
        md.steps(w, ["nope"])


def test_votes_are_refused_for_few_same_or_short_transcripts(spark):
    from streamloom.operators import disfluency as dis

    p = spark.createDataFrame([(r, 100) for r in "abcd"], "rec_id string, n_tokens int")
    o = [("a", "x", "m1", 90), ("a", "y", "m2", 90), ("a", "z", "m3", 90), ("b", "x", "m1", 90), ("b", "y", "m1", 90), ("b", "z", "m3", 90), ("c", "x", "m1", 90), ("c", "y", "m2", 20), ("c", "z", "m3", 90)]
    got = {(r.rec_id, r.why) for r in dis.refused(p, spark.createDataFrame(o, "rec_id string, dissenter string, model_id string, n_tokens int")).collect()}
    assert got == {("b", "same_model"), ("c", "too_short"), ("d", "too_few")}


def test_given_maps_win_over_sidecars(spark):
    stems = spark.createDataFrame([("r1", "a"), ("r2", "b")], "rec_id string, stem string")
    side = spark.createDataFrame([("a", "S0", "Ann"), ("b", "S0", "Bob")], "stem string, speaker string, display_name string")
    given = spark.createDataFrame([("r1", "S0", "Cy")], "rec_id string, speaker string, display_name string")
    assert {tuple(r) for r in si.chosen_map(stems, side, given).collect()} == {("r1", "S0", "Cy"), ("r2", "S0", "Bob")}
    assert si.chosen_map(stems, side, given, use=False).count() == 0
    assert hd.valid_tag("v1.2") == "v1.2" and hd.given_day("2026-01-02") == "2026-01-02"
    for bad in (lambda: hd.valid_tag("a/b"), lambda: hd.given_day("1/2/26")):
        with pytest.raises(ValueError):
            bad()


def test_preview_lines_pack_and_break(spark):
    rows = [("r", n, n * 1.0, t, s) for n, (t, s) in enumerate([("aaaa", "A"), ("bbbb.", "A"), ("cccc", "A"), ("dd", "B"), ("ee", None)])]
    w = spark.createDataFrame(rows, "rec_id string, pos int, start_s double, text string, speaker string")
    got = [(r.line, r.speaker, r.text) for r in tl.preview_lines(w, 10).orderBy("line").collect()]
    assert got == [(0, "A", "aaaa bbbb."), (1, "A", "cccc"), (2, "B", "dd"), (3, None, "ee")]
