import pytest
from pyspark.sql import functions as F

from streamloom.operators import sheets as sh

ST = "rec_id string, pos int, i int, sent long, stretch long, speaker string, text string, start_s double"


@pytest.fixture(scope="module")
def made(spark):
    rows = []
    for n, (sent, stretch, who, text) in enumerate([(0, 0, "A", "So here we go."), (1, 0, "A", "Is that the one?"), (2, 1, "B", "Yes it is."), (3, 2, "A", "Good and good again.")]):
        rows += [("r", n * 10 + k, n * 10 + k, sent, stretch, who, t, n + k / 10) for k, t in enumerate(text.split())]
    s = sh.sheet(spark.createDataFrame(rows, ST)).orderBy("ord")
    return s, [r.line for r in s.collect()]


def check(spark, made, lines):
    df = spark.createDataFrame([("r", n, x) for n, x in enumerate(lines, 1)], "rec_id string, n int, line string")
    return [(r.line, r.what, r.key, r.value, r.detail) for r in sh.checked(made[0], df).collect()]


def edit(lines, at, *new, drop=0):
    k = next(n for n, x in enumerate(lines) if at in x)
    return lines[:k] + list(new) + lines[k + drop :]


def errors(spark, made, lines):
    return {k for _, what, k, _, _ in check(spark, made, lines) if what == "error"}


def test_sheet_has_blocks_and_numbered_lines(made):
    assert made[1][:3] == ["#### START  A", "T0001 [00:00:00.0] So here we go.", "T0002 [00:00:01.0] Is that the one?"]
    assert made[1][3:6] == ["#### B-001  00:00:02.0  A -> B", "boundary:", "who:"] and len(made[1]) == 11


def test_a_filled_sheet_is_read_back(spark, made):
    x = edit(made[1], "B-001", "#### B-001  00:00:02.0  A -> B", "boundary: Real", "who: s", drop=3)
    x = edit(x, "T0002", '>> change: S2 "is that"')
    got = check(spark, made, x)
    assert (("verdict", "B-001", "real") in {g[1:4] for g in got}) and (("who", "B-001", "S") in {g[1:4] for g in got})
    assert [g for g in got if g[1] == "change"][0][2:] == ("T0002", "S2", "0") and not [g for g in got if g[1] == "error"]


@pytest.mark.parametrize(
    "at,new,drop,why",
    [
        ("boundary:", ["boundary: maybe"], 1, "unknown_verdict"), ("who:", ["who: X"], 1, "unknown_who"), ("boundary:", ["boundary: spurious", "who: S"], 2, "who_on_spurious"),
        ("T0002", [">> change S"], 0, "malformed_marker"), ("T0002", ["change: S"], 0, "malformed_marker"), ("T0002", [">> change: Q"], 0, "unknown_who"), ("T0002", [">> back: L"], 0, "back_without_change"),
        ("T0002", [">> change: S"], 0, None), ("T0002", ['>> change: S "nowhere"'], 0, "quote_not_found"), ("T0004", ['>> change: S "good"'], 0, "quote_not_unique"), ("T0002", ['>> change: S ""'], 0, "empty_quote"),
        ("T0004", [">> change: S"], 0, "change_never_returns"), ("T0002", [">> change: S", ">> change: S2"], 0, "same_word"), ("T0002", ['>> change: S "one?"', '>> back: L "that"'], 0, "markers_out_of_order"),
        ("B-001", [">> change: S"], 0, "marker_on_boundary"), ("boundary:", ["boundary:", ">> change: S"], 1, "marker_in_block"), ("#### START", [">> change: S"], 0, "marker_above_transcript"),
        ("T0002", ["T0002 [00:00:01.0] Is that it?"], 1, "edited_line"), ("T0002", [], 1, "missing_lines"), ("T0004", [], 1, "missing_lines"), ("T0002", ["what is this"], 0, "unknown_line"),
        ("T0004", ['>> change: S "and"', '>> change: S "again"'], 0, "change_to_open_speaker"), ("T0004", ['>> change: S "and"', '>> back: S "again"'], 0, "back_to_open_speaker"),
    ],
)
def test_malformed_sheets(spark, made, at, new, drop, why):
    got = errors(spark, made, edit(made[1], at, *new, drop=drop))
    assert (why in got) if why else not got


def test_blank_lines_are_free(spark, made):
    assert check(spark, made, [y for x in made[1] for y in (x, "", "  ")]) == []


def test_quotes(spark):
    row = spark.sql("select 'the one' q, 'Is that, “the one” or the one?' l, '' e")
    r = row.select(sh.quote_places(F.col("q"), F.col("l")), sh.quote_places(F.col("e"), F.col("l"))).first()
    assert list(r[0]) == [2, 5] and list(r[1]) == []
