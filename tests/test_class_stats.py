"""Volume and errors surfaced by class and by group, against the reference's counting in plain Python."""

from streamloom.operators import evaluate as ev
from streamloom.operators.candidates import FAMILY, ORDER

FOUND = [
    ("r", "shift", 0, 4), ("r", "zero_gap", 2, 6), ("r", "inside_sentence", 5, 9), ("r", "backchannel", 8, 70), ("r", "zero_gap", 80, 90),
    ("q", "zero_gap", 3, 5), ("q", "question_answer", 3, 9),
]
ERRS = [("r", "missed", 3, 2, True), ("r", "missed", 6, 0, False), ("r", "spurious", 9, 0, False), ("r", "missed", 75, 4, False), ("r", "missed", 66, 1, True), ("q", "spurious", 5, 0, False), ("q", "missed", 8, 3, True)]
KINDS = {"all": lambda e: True, "missed": lambda e: e[1] == "missed", "missed_misattributing": lambda e: e[1] == "missed" and e[3] > 0, "spurious": lambda e: e[1] == "spurious", "high_harm": lambda e: e[4]}


def stats(members):
    mine = [f for f in FOUND if f[1] in members]
    holds = lambda f, e: f[0] == e[0] and f[2] < e[2] <= f[3]
    by = {e: {f[1] for f in FOUND if holds(f, e)} for e in ERRS}
    out = {"windows": len(mine), "words_covered": len({(f[0], n) for f in mine for n in range(f[2], f[3] + 1)}), "with_error": sum(any(holds(f, e) for e in ERRS) for f in mine)}
    for k, is_kind in KINDS.items():
        out[f"surfaced_{k}"] = sum(is_kind(e) and bool(by[e] & set(members)) for e in ERRS)
        out[f"only_{k}"] = sum(is_kind(e) and bool(by[e]) and by[e] <= set(members) for e in ERRS)
    return out


def test_class_stats_by_class_and_group(spark):
    found = spark.createDataFrame([(*f, f[2]) for f in FOUND], "rec_id string, class string, a int, b int, at int")
    errs = spark.createDataFrame(ERRS, "rec_id string, kind string, t int, misattributed long, high_harm boolean")
    hours = spark.createDataFrame([("r", 5400.0), ("q", 1800.0)], "rec_id string, duration_s double")
    got = {(r.level, r["name"]): r.asDict() for r in ev.class_stats(ev.surfaced(errs, found), found, errs, hours, ORDER[1], FAMILY).collect()}
    units = {("class", c): [c] for c in ORDER[1]} | {("group", f): [c for c in ORDER[1] if FAMILY[c] == f] for f in ("split", "merge")} | {("group", "everything but shift"): [c for c in ORDER[1] if c != "shift"]}
    assert set(got) == set(units)
    for u, members in units.items():
        want = stats(members)
        assert {k: got[u][k] for k in want} == want, u
        assert got[u]["per_hour_tenths"] == want["windows"] * 5  # two hours
    assert got["group", "split"]["only_all"] > sum(got["class", c]["only_all"] for c in units["group", "split"])
