"""Flags of the votes in the words of both streams."""

from streamloom.operators import align, render
from streamloom.operators.stream import words_once


def test_flagged_tokens_reach_the_words_of_both_streams(spark):
    said = {"primary": "we [UH] met brenby _ at noon".split(), "secondary": "we met brenbie at noon".split()}
    words = [(s, r, n, t) for s, ts in said.items() for r in ("r1", "r2") for n, t in enumerate(ts) if (s, r) != ("secondary", "r2")]
    raw = spark.createDataFrame(words, "stream string, rec_id string, i int, text string").selectExpr("*", "double(null) start_s", "double(null) end_s", "cast(null as array<string>) flags", "string(null) speaker", "timestamp(null) loaded_at")
    parts = [words_once(raw.where(f"stream = '{s}'")).selectExpr("*", f"'{s}' stream") for s in said]
    heard = {"r1": "we met brennby at noon".split(), "r2": "we met brenby at noon".split()}
    others = spark.createDataFrame([(r, d, n, t) for r, ts in heard.items() for d in "abc" for n, t in enumerate(ts)], "rec_id string, dissenter string, fpos long, piece string")
    out, found = align.annotate(parts[0].unionByName(parts[1]), others, ["a", "b", "c"])
    rows = [tuple(r) for r in out.select("stream", "rec_id", "i", "flags", render.html_word(), render.named_word()).collect()]
    assert len(rows) == len(words)
    marked = sorted(r for r in rows if "proper_noun_candidate" in r[3])
    flag = ["proper_noun_candidate"]
    assert marked == [
        ("primary", "r1", 3, flag, '<span class="candidate">brenby</span><sup class="cand-mark">[NAME?]</sup>', "brenby [NAME?]"),
        ("secondary", "r1", 2, flag, '<span class="candidate">brenbie</span><sup class="cand-mark">[NAME?]</sup>', "brenbie [NAME?]"),
    ]
    assert sorted((r.stream, r.rec_id, r.i, r.flagged) for r in found.collect()) == [("primary", "r1", 3, True), ("secondary", "r1", 2, True)]
