"""Rules of records and outputs, pages, header ranges, and unions under Spark's own settings."""

import hashlib
import struct

from pyspark.sql import functions as F

from streamloom.operators import quality as ql
from streamloom.operators import render as rd
from streamloom.operators import stream as st
from streamloom.operators.compare import match_breaches, nearest_windows, returns, sha256
from streamloom.operators.shared import mixed
from streamloom.sources import headers as hd
from streamloom.sources import records as sr


def test_unions_are_exchanged_whatever_the_settings(spark):
    for own in ("true", "false"):
        spark.conf.set("spark.sql.unionOutputPartitioning", own)
        a = spark.range(5000).select((F.col("id") % 97).cast("string").alias("k"), "id").repartition("k")
        b = spark.range(10).select(F.col("id").cast("string").alias("k"), "id").repartition("k")
        got = mixed([a, b], "k").groupBy("k").agg(F.count("*").alias("n"))
        assert got.count() == 97 and got.agg(F.sum("n")).first()[0] == 5010
    spark.conf.unset("spark.sql.unionOutputPartitioning")


def test_a_flawed_record_is_written_and_told(spark, tmp_path):
    w = "array<struct<i:int,text:string,start:double,end:double,timing_source:string,speaker:string,speaker_source:string,conf:double,flags:array<string>>>"
    doc = spark.sql(f"""select 'r' as rec_id, '1.0' as schema_version, named_struct('audio_path', 'a.wav', 'audio_sha256', 's', 'duration_s', 2.0d) as source,
      from_json('[{{"i":0,"text":"a","start":1.0,"end":0.5,"timing_source":"native"}},{{"i":2,"text":"b","timing_source":"guess"}}]', '{w}') as words,
      from_json('[{{"start":0.0,"end":1.0}}]', 'array<struct<start:double,end:double,speaker:string>>') as speaker_turns, cast(array() as array<struct<start:double,end:double,message:string>>) as errors, array('w') as warnings,
      named_struct('mode', 'clean', 'text', 't', 'words', from_json('[{{"i":1,"text":"b"}}]', '{w}')) as secondary_stream,
      named_struct('model_id', 'm', 'granularity', 'word', 'params', named_struct('mode', 'clean', 'hotwords', array('x', 'y'))) as asr""")
    got = {(r.rule, r.place) for r in sr.write_records(doc, str(tmp_path / "out")).collect()}
    assert {("turn_without_speaker", "0"), ("end_before_start", "0"), ("word_index", "2"), ("timing_source", "2"), ("second_stream_same_mode", None), ("second_word_index", "1"), ("missing_asr.revision", None), ("missing_run.device", None)} <= got
    assert not any(r.startswith(("missing_source", "missing_asr.params", "schema")) for r, _ in got)
    back, refused = sr.read_records(spark, str(tmp_path / "out"), lines=True)
    assert back.first().rec_id == "r" and refused.count() == 0
    assert [tuple(r) for r in sr.hotwords_of(back).select("n", "term").orderBy("n").collect()] == [(0, "x"), (1, "y")]


def test_pages_escape_and_number(spark):
    rows = [("r", 0, 0, "<b>", ["partial_word"], 0.0, 0.4, "A & B"), ("r", 1, 1, "no", ["repair"], 0.5, 0.9, "A & B"), ("r", 2, 2, "no.", ["repetition"], 1.0, 1.4, "A & B"), ("r", 3, 3, "Ann?", ["proper_noun_candidate"], 2.0, 2.5, None)]
    s = st.stretches(st.sentences(spark.createDataFrame(rows, "rec_id string, i int, pos int, text string, flags array<string>, start_s double, end_s double, speaker string")))
    stats = spark.createDataFrame([("r", 2, 2, 2, 0)], "rec_id string, turns int, sentences int, boundaries int, words_reassigned int")
    recs = spark.createDataFrame([("r", "x<y.wav", "ab" * 32, "m", None)], "rec_id string, audio_path string, audio_sha256 string, model_id string, diar_model string")
    stamps = rd.stamped(recs, stats, rd.content_hash(s), {"pause_s": "0.5"})
    page = rd.html_documents(s, stamps, style="p{}").first().html
    assert '<title>x&lt;y.wav</title>' in page and "<dt>pause_s</dt><dd>0.5</dd>" in page and "diarizer" not in page
    assert '<li value="1" data-t="00:00:00.0"><span class="partial">&lt;b&gt;</span> <span class="reparandum">no</span> no.</li>' in page
    assert '<h2><time>00:00:02.0</time> UNKNOWN</h2>' in page and '<span class="candidate">Ann?</span><sup class="cand-mark">[NAME?]</sup>' in page
    assert stamps.select(rd.header_lines(F.col("stamp")).alias("t")).first().t.startswith("# source: x<y.wav\n# audio: abababababab\n# model: m\n")


def test_declarations_and_private_values(spark):
    m = spark.createDataFrame([("a", "start_end", "yes", "no", "native"), ("b", "ends", None, "no", "native"), ("a", "none", "no", "yes", "native")], "model string, word_timestamps string, verbatim string, hotwords string, longform string")
    assert {(r.model, r.rule) for r in ql.declaration_breaches(m).collect()} == {("b", "word_timestamps"), ("b", "verbatim"), ("a", "model_twice")}
    out = spark.createDataFrame([("o1", "We heard Ann Lee speak"), ("o2", "annlee and Lee Ann"), ("o3", None), ("o4", "see /data/raw/ann_01.wav")], "path string, text string")
    private = spark.createDataFrame([("person", "ann  lee"), ("file", "ann_01.wav"), ("file", ""), ("person", None)], "kind string, value string")
    assert {tuple(r) for r in ql.private_in_outputs(out, private).collect()} == {("o1", "person"), ("o4", "file")}


def test_headers_are_read_by_range(spark, tmp_path):
    bext = bytearray(346)
    bext[320:338] = b"2025-09-0109:30:00"
    chunk = lambda n, b: n + struct.pack("<I", len(b)) + bytes(b) + b"\0" * (len(b) % 2)
    fmt = struct.pack("<HHIIHH", 1, 1, 48000, 96000, 2, 16)
    body = b"WAVE" + chunk(b"JUNK", b"x" * 5001) + chunk(b"data", b"\1" * 96000) + chunk(b"fmt ", fmt) + chunk(b"bext", bext)
    (tmp_path / "a.wav").write_bytes(b"RIFF" + struct.pack("<I", len(body)) + body)
    paths = spark.createDataFrame([(str(tmp_path / "a.wav"),), (str(tmp_path / "none.wav"),), (None,)], "path string")
    got = {r.path: r for r in hd.headers(paths).collect()}
    a = got[str(tmp_path / "a.wav")]
    assert (a.day, a.time, a.rate, a.bytes) == ("2025-09-01", "09:30:00", 48000, 96000) and got[str(tmp_path / "none.wav")].day is None
    h = {r.path: r.sha256 for r in hd.file_hashes(paths).collect()}
    assert h[str(tmp_path / "a.wav")] == hashlib.sha256((tmp_path / "a.wav").read_bytes()).hexdigest() and h[None] is None
    d = {r.path: (str(r.date), r.origin) for r in hd.dated(hd.recorded(hd.headers(paths.limit(1))), spark.createDataFrame([(a.path, "2025-09-02")], "path string, day string")).collect()}
    assert d == {a.path: ("2025-09-02", "given")}


def test_windows_near_errors_and_ways_back(spark):
    import random

    rng = random.Random(3)
    found = [("r", a := rng.randrange(200), a + rng.randrange(1, 9), rng.choice("xyz")) for _ in range(40)]
    errs = [("r", "missed", t) for t in rng.sample(range(1, 260), 60)] + [("s", "missed", 5)]
    w = spark.createDataFrame(found, "rec_id string, a int, b int, class string")
    held = {t: sorted({c for _, a, b, c in found if a < t <= b}) for _, _, t in errs[:-1]}
    s = spark.createDataFrame([(*e, held.get(e[2], []) if e[0] == "r" else []) for e in errs], "rec_id string, kind string, t int, classes array<string>")
    dist = lambda t, a, b: a + 1 - t if t <= a else t - b
    want = {(r, t): min((dist(t, a, b), a, b, c) for _, a, b, c in found) if r == "r" else None for r, _, t in errs if r == "s" or not held[t]}
    got = {(r.rec_id, r.t): (r.distance, r["class"]) for r in nearest_windows(s, w).collect()}
    assert got == {k: (v[0], v[3]) if v else (None, None) for k, v in want.items()}
    h = spark.createDataFrame([("r", t, m) for t, m in ((10, 5), (150, 30), (190, 90))], "rec_id string, t int, misattributed int")
    inside = lambda p: any(a < p <= b for _, a, b, _ in found)
    back = {r.t: (r.back, r.surfaced, r.back_surfaced) for r in returns(h, w, spark.createDataFrame([("r", 200)], "rec_id string, n int")).collect()}
    assert back == {t: (b, inside(t), b is not None and inside(b)) for t, b in ((10, 15), (150, 180), (190, None))}


def test_labels_meet_their_own_windows_only(spark):
    kinds = "rec_id string, source_sha256 string, render string, stream string, boundaries array<int>"
    a = spark.createDataFrame([("r", "s", "x", None, [1, 2]), ("q", None, "x", "p", [])], kinds)
    b = a.withColumns({"params": F.lit("{}"), "params_sha256": F.lit(sha256("{}"))})
    assert match_breaches(a, b).count() == 0
    bad = b.withColumn("boundaries", F.array(F.lit(1))).withColumn("params", F.lit("{1}"))
    assert {(r.rec_id, r.why) for r in match_breaches(a, bad).collect()} == {(k, w) for k in "rq" for w in ("other_boundaries", "other_params")}
