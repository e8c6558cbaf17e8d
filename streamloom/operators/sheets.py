"""Label sheets: made from the shared stream, filled by hand, checked strictly.

A sheet is rows of text in order. Making one is relational; checking one is not (a
marker's meaning depends on all lines before it), so each filled sheet is one task.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamloom.functions.times import tenths
from streamloom.operators.shared import mixed

# -- fixed values: the forms of a sheet's lines -------------------------------------------
WHO = r"L|S[2-9]?|\?"
VERDICTS = ("real", "spurious", "unsure")
MARKER = re.compile(r"^>>\s*(change|back)\s*:\s*(\S+)(?:\s+[\"“”]([^\"“”]*)[\"“”])?\s*$", re.I)
LOOKS_LIKE_MARKER = re.compile(r"^(>|(change|back)\s*:)", re.I)
HEAD = re.compile(r"^#### (B-\d+)\b")
TEXT = re.compile(r"^(T\d{4,})\b")
FIELD = re.compile(r"^(boundary|who)\s*:\s*(.*)$", re.I)
# --------------------------------------------------------------------------------------------


def _order(kind: int, sent: Column, part: Column) -> Column:
    """The place of a line: turn, kind of line in it, sentence, part of a block."""
    return F.struct(F.col("stretch").cast("long").alias("turn"), F.lit(kind).alias("kind"), sent.cast("long").alias("sent"), part.cast("int").alias("part"))


def sheet(st: DataFrame, offset: float = 0.0) -> DataFrame:
    """(rec_id, ord, kind, key, line): START, then for each turn a boundary block and its numbered text lines.

    Text lines are the sentences, T0001 on; boundaries are the label changes, B-001 on.
    """
    time = lambda c: tenths(F.coalesce(c, F.lit(0.0)) + offset)
    parts = F.sort_array(F.collect_list(F.struct("pos", "text")))
    t = st.groupBy("rec_id", "sent").agg(F.min("stretch").alias("stretch"), F.min_by("speaker", "pos").alias("speaker"), F.min_by("start_s", F.when(F.col("start_s").isNotNull(), F.col("pos"))).alias("s"), F.array_join(F.transform(parts, lambda p: p["text"]), " ").alias("words"))
    lid = F.concat(F.lit("T"), F.lpad((F.col("sent") + 1).cast("string"), 4, "0"))
    text = t.select("rec_id", _order(2, F.col("sent"), F.lit(0)).alias("o"), F.lit("text").alias("kind"), lid.alias("key"), F.concat(lid, F.lit(" ["), time(F.col("s")), F.lit("] "), F.col("words")).alias("line"))
    w = Window.partitionBy("rec_id").orderBy("stretch")
    h = st.groupBy("rec_id", "stretch").agg(F.min_by("speaker", "pos").alias("to"), F.min_by("start_s", "pos").alias("s"))
    h = h.select("*", F.lag("to").over(w).alias("frm"))
    name = lambda c: F.coalesce(F.col(c), F.lit("None"))
    bid = F.concat(F.lit("B-"), F.lpad(F.col("stretch").cast("string"), 3, "0"))
    block = F.array(
        F.struct(F.lit("head").alias("kind"), F.concat(F.lit("#### "), bid, F.lit("  "), time(F.col("s")), F.lit("  "), name("frm"), F.lit(" -> "), name("to")).alias("line")),
        F.struct(F.lit("boundary").alias("kind"), F.lit("boundary:").alias("line")), F.struct(F.lit("who").alias("kind"), F.lit("who:").alias("line")),
    )
    heads = h.where("stretch > 0").select("rec_id", "stretch", bid.alias("key"), F.posexplode(block).alias("n", "x"))
    heads = heads.select("rec_id", _order(1, F.lit(0), F.col("n")).alias("o"), "x.kind", "key", "x.line")
    start = h.where("stretch = 0").select("rec_id", _order(0, F.lit(0), F.lit(0)).alias("o"), F.lit("start").alias("kind"), F.lit("START").alias("key"), F.concat(F.lit("#### START  "), name("to")).alias("line"))
    rows = mixed([start, mixed([text, heads], "rec_id")], "rec_id")
    return rows.select("rec_id", F.row_number().over(Window.partitionBy("rec_id").orderBy("o")).alias("ord"), "kind", "key", "line")


def progress(labels: DataFrame, markers: DataFrame | None = None) -> DataFrame:
    """Per recording: boundaries, labelled ones by verdict, the last labelled one; with markers (rec_id, kind) also their number by kind."""
    v = lambda x: F.count_if(F.col("verdict") == x).alias(x)
    out = labels.groupBy("rec_id").agg(F.count("*").alias("boundaries"), F.count("verdict").alias("done"), *[v(x) for x in VERDICTS], F.max(F.when(F.col("verdict").isNotNull(), F.col("bno"))).alias("last"))
    if markers is None:
        return out
    m = markers.groupBy("rec_id").agg(*[F.count_if(F.col("kind") == k).alias(f"{k}_markers") for k in ("change", "back")])
    return out.join(m, "rec_id", "left").fillna(0, ["change_markers", "back_markers"])


def quote_places(quote: Column, line: Column) -> Column:
    """Word offsets in a line at which the quote's whole words stand one after the other."""
    words = lambda c: F.filter(F.transform(F.split(F.lower(c), "(?U)\\s+"), lambda t: F.regexp_replace(F.regexp_replace(t, "(?U)[^\\w']", ""), "^'+|'+$", "")), lambda t: t != "")
    q, ws = words(quote), words(line)
    return F.filter(F.sequence(F.lit(0), F.greatest(F.size(ws) - F.size(q), F.lit(0))), lambda k: (F.size(q) > 0) & (F.slice(ws, k + 1, F.greatest(F.size(q), F.lit(1))) == q))


def _plain(token: str) -> str:
    return re.sub(r"[^\w']", "", token.lower()).strip("'")


class _Check:
    """One filled sheet against the expected one."""

    def __init__(self, expected: list[tuple[str, str, str]], filled: list[str]):
        self.out: list[tuple[int, str, str, str | None, str | None]] = []  # line, what, key, value, detail
        self.text = {key: line for kind, key, line in expected if kind == "text"}
        self.heads = {key: line for kind, key, line in expected if kind == "head"}
        self.rank = {(kind, key): n for n, (kind, key, _) in enumerate(expected)}
        # The next line from each place on that may not be skipped.
        self.owed: list[int] = [len(expected)] * (len(expected) + 1)
        for n in range(len(expected) - 1, -1, -1):
            self.owed[n] = n if expected[n][0] in ("text", "head", "start") else self.owed[n + 1]
        self.keys = [key for _, key, _ in expected]
        self.verdict: dict[str, str] = {}
        self.reached = -1
        self.block: str | None = None
        self.waiting: list[tuple[int, str, str, str | None]] = []
        self.events: list[tuple] = []
        for n, raw in enumerate(filled, 1):
            if raw.strip():
                self.line(n, raw.strip())
        for n, *_ in self.waiting:
            self.error(n, "marker_without_text")
        owed = self.owed[self.reached + 1]
        if owed < len(expected):
            self.error(len(filled) + 1, "missing_lines", self.keys[owed])
        self.balance()

    def error(self, n: int, why: str, detail: str | None = None) -> None:
        self.out.append((n, "error", why, None, detail))

    def come_to(self, n: int, kind: str, key: str) -> None:
        at = self.rank[(kind, key)]
        if at <= self.reached:
            self.error(n, "out_of_order", key)
            return
        owed = self.owed[self.reached + 1]
        if owed < at:
            self.error(n, "missing_lines", self.keys[owed])
        self.reached = at

    def line(self, n: int, s: str) -> None:
        marker, head, text, field = MARKER.match(s), HEAD.match(s), TEXT.match(s), FIELD.match(s)
        if marker:
            kind, who, quote = marker.group(1).lower(), marker.group(2).upper(), marker.group(3)
            if not re.fullmatch(WHO, who):
                self.error(n, "unknown_who", who)
            elif self.reached < 0:
                self.error(n, "marker_above_transcript")
            elif self.block:
                self.error(n, "marker_in_block", self.block)
            else:
                self.waiting.append((n, kind, who, quote))
        elif LOOKS_LIKE_MARKER.match(s):
            self.error(n, "malformed_marker")
        elif s.startswith("#### START") and ("start", "START") in self.rank:
            self.come_to(n, "start", "START")
        elif head and head.group(1) in self.heads:
            if s != self.heads[head.group(1)]:
                self.error(n, "edited_line", head.group(1))
            for m, *_ in self.waiting:
                self.error(m, "marker_on_boundary", head.group(1))
            self.waiting = []
            self.come_to(n, "head", head.group(1))
            self.block = head.group(1)
            self.events.append(("boundary", self.block, None))
        elif field and self.block:
            self.field(n, field.group(1).lower(), field.group(2).strip())
        elif text and text.group(1) in self.text:
            key = text.group(1)
            if s != self.text[key]:
                self.error(n, "edited_line", key)
            self.come_to(n, "text", key)
            self.block = None
            self.place(key)
        elif self.reached >= 0:
            self.error(n, "unknown_line")

    def field(self, n: int, name: str, value: str) -> None:
        key = self.block
        if name == "boundary":
            self.reached = max(self.reached, self.rank[("boundary", key)])
            if value and value.lower() not in VERDICTS:
                self.error(n, "unknown_verdict", value)
            elif value:
                self.verdict[key] = value.lower()
                self.out.append((n, "verdict", key, value.lower(), None))
            return
        self.reached = max(self.reached, self.rank[("who", key)])
        if value and not re.fullmatch(WHO, value.upper()):
            self.error(n, "unknown_who", value)
        elif value and self.verdict.get(key) == "spurious":
            self.error(n, "who_on_spurious", key)
        elif value:
            self.out.append((n, "who", key, value.upper(), None))
        self.block = None

    def place(self, key: str) -> None:
        tokens = [_plain(t) for t in self.text[key].split("] ", 1)[-1].split()]
        last = -1
        for n, kind, who, quote in self.waiting:
            at = 0
            if quote is not None:
                q = [t for t in map(_plain, quote.split()) if t]
                found = [k for k in range(len(tokens) - len(q) + 1) if q and tokens[k : k + len(q)] == q]
                if len(found) != 1:
                    self.error(n, "empty_quote" if not q else "quote_not_found" if not found else "quote_not_unique", key)
                    continue
                at = found[0]
            if at <= last:
                self.error(n, "same_word" if at == last else "markers_out_of_order", key)
                continue
            last = at
            self.out.append((n, kind, key, who, str(at)))
            self.events.append((kind, n, who))
        self.waiting = []

    def balance(self) -> None:
        """Which change is open at each event: the last one before it, unless a back or a boundary labelled real stands between.

        What lies between is read off running counts: events that open or close, and boundaries without a verdict.
        """
        if not self.events:
            return
        e = pd.DataFrame(self.events, columns=["kind", "at", "who"])
        said = e["at"].map(self.verdict).where(e.kind == "boundary")
        e["opens"] = e.kind == "change"
        e["acts"] = e.opens | (e.kind == "back") | (said == "real")
        e["bare"] = (e.kind == "boundary") & said.isna()
        act = e[e.acts]
        before = act.shift()
        held = before.opens.eq(True)
        same = held & (act.who == before.who) & (act.who != "?")
        rules = {"change_to_open_speaker": (act.opens & same, True), "back_without_change": ((act.kind == "back") & ~held, False), "back_to_open_speaker": ((act.kind == "back") & same, True)}
        for why, (hit, named) in rules.items():
            for r in act[hit].itertuples():
                self.error(r.at, why, r.who if named else None)
        if len(act) and act.opens.iloc[-1]:
            self.out.append((act["at"].iloc[-1], "note" if e.bare[act.index[-1] :].any() else "error", "change_never_returns", None, None))


def checked(expected: DataFrame, filled: DataFrame) -> DataFrame:
    """What filled sheets say and where they break the rules.

    expected: sheet(); filled: (rec_id, n, line). Output: rec_id, line, what (verdict, who, change,
    back, note, error), key (boundary, text line or rule), value, detail (a marker's word offset
    or an error's place).
    """

    def run(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        a, b = a.sort_values("ord"), b.sort_values("n")
        got = _Check(list(zip(a.kind, a.key, a.line)), [x or "" for x in b.line]).out
        return pd.DataFrame([(key[0], *r) for r in sorted(got, key=lambda r: (r[0], r[1], r[2]))], columns=["rec_id", "line", "what", "key", "value", "detail"])

    right = filled.select(F.col("rec_id").alias("r"), F.col("n").alias("n"), F.col("line").alias("line"))
    return expected.groupBy("rec_id").cogroup(right.groupBy("r")).applyInPandas(run, "rec_id string, line int, what string, key string, value string, detail string")
