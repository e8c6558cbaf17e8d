"""Times of words and windows: derived starts, rolled-over clocks, tagged text, fixed and halved windows, accounting."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamloom.operators.stream import BUCKET_S, nearest_edge, rec

SEGMENT_S, RETRY_DEPTH, RETRY_LEAST_S = 300.0, 3, 30.0
PREVIEW_CHARS = 88
#: Runs of one speaker that a preview packs in one task.
RUNS_AT_ONCE = 64


def derived_starts(words: DataFrame) -> DataFrame:
    """Null starts become the last known end before, 0.0 at the beginning; other starts stay. Needs rec_id, pos."""
    last = F.last("end_s", ignorenulls=True).over(rec().rowsBetween(Window.unboundedPreceding, -1))
    return words.withColumn("start_s", F.coalesce("start_s", last, F.lit(0.0)))


def unrolled(texts: DataFrame) -> DataFrame:
    """Words with absolute ends from "word [T:N] word [T:N]" texts: (rec_id, k, token, end_s, silence).

    N counts hundredths of a second modulo 1000 (N < 1000); a reading below the one
    before has rolled over. Tokens that are blank advance the clock only; text behind
    the last tag is left out (`untagged` gives it).
    """
    parts = F.regexp_extract_all("text", F.lit("(?s)(.*?)\\[T:(\\d+)\\]"), 1)
    reads = F.regexp_extract_all("text", F.lit("\\[T:(\\d+)\\]"), 1)
    x = texts.select("rec_id", F.posexplode(F.arrays_zip(parts.alias("t"), reads.alias("n"))).alias("k", "x"))
    x = x.select("rec_id", "k", F.trim("x.t").alias("token"), F.col("x.n").cast("long").alias("n"))
    w = Window.partitionBy("rec_id").orderBy("k")
    x = x.withColumn("roll", F.coalesce((F.col("n") < F.lag("n").over(w)).cast("int"), F.lit(0)))
    x = x.withColumn("end_s", F.round(F.col("n") / 100.0 + 10.0 * F.sum("roll").over(w), 3))
    return x.where("token <> ''").select("rec_id", "k", "token", "end_s", (F.col("token") == "_").alias("silence"))


def untagged(text: Column) -> Column:
    """The text behind the last clock tag."""
    return F.trim(F.regexp_extract(text, "(?s)(?:.*\\[T:\\d+\\])?(.*)$", 1))


def tagged_segments(texts: DataFrame) -> DataFrame:
    """(rec_id, seg, label, segment) of "[Speaker 1]: ... [Speaker 2]: ..." texts; a lead-in has a null label, blank lead-ins are none."""
    parts = F.split("text", "(?=\\[Speaker \\d+\\]:)")
    x = texts.select("rec_id", F.posexplode(parts).alias("k", "p"))
    label = F.regexp_extract("p", "^\\[(Speaker \\d+)\\]:", 1)
    body = F.trim(F.regexp_replace("p", "^\\[Speaker \\d+\\]:", ""))
    x = x.select("rec_id", "k", F.when(label != "", label).alias("label"), body.alias("segment")).where("label is not null or segment <> ''")
    return x.select("rec_id", (F.row_number().over(Window.partitionBy("rec_id").orderBy("k")) - 1).alias("seg"), "label", "segment")


def turns_from_labels(words: DataFrame, label: str = "label") -> DataFrame:
    """Per-word labels collapsed to time ranges; a turn starts where the token before it ended, silences included.

    words: (rec_id, pos, end_s, silence, label) with silences still in.
    """
    w = rec()
    before = F.last("end_s", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = words.withColumn("start", F.coalesce(before, F.lit(0.0))).where(~F.col("silence"))
    x = x.withColumn("new", (~F.col(label).eqNullSafe(F.lag(label).over(w)) | F.lag("pos").over(w).isNull()).cast("int")).withColumn("turn", F.sum("new").over(w))
    t = x.groupBy("rec_id", "turn").agg(F.min_by(label, "pos").alias("speaker"), F.min_by("start", "pos").alias("start_s"), F.max_by("end_s", F.when(F.col("end_s").isNotNull(), F.col("pos"))).alias("end_s"))
    return t.withColumn("end_s", F.coalesce("end_s", "start_s"))


def fixed_windows(recordings: DataFrame, size: float = SEGMENT_S) -> DataFrame:
    """(rec_id, k, start_s, end_s): [k size, (k + 1) size) up to the duration; one window if it fits. Null and negative durations give none."""
    d = F.col("duration_s")
    n = F.when(d <= size, 1).otherwise(F.ceil(d / size).cast("int"))
    x = recordings.where("duration_s is not null and duration_s >= 0").select("rec_id", "duration_s", F.explode(F.sequence(F.lit(0), n - 1)).alias("k"))
    return x.select("rec_id", "k", (F.col("k") * size).cast("double").alias("start_s"), F.least((F.col("k") + 1) * size, d).alias("end_s"))


def retried_windows(windows: DataFrame, fails: Column, depth: int = RETRY_DEPTH, least: float = RETRY_LEAST_S) -> DataFrame:
    """Failing windows halved while depth and length allow: (rec_id, k, depth, start_s, end_s, lost).

    fails: a condition over start_s, end_s (and the window's other columns). Halves that
    still fail at the end are lost ranges.
    """
    level = windows.withColumn("depth", F.lit(0)).withColumn("failed", F.coalesce(fails, F.lit(False)))
    done = None
    for n in range(depth + 1):
        split = F.col("failed") & F.lit(n < depth) & ((F.col("end_s") - F.col("start_s")) / 2 >= least)
        rest = level.where(~split).withColumn("lost", F.col("failed"))
        done = rest if done is None else done.unionByName(rest)
        mid = F.col("start_s") + (F.col("end_s") - F.col("start_s")) / 2
        halves = F.explode(F.array(F.struct(F.col("start_s").alias("s"), mid.alias("e")), F.struct(mid.alias("s"), F.col("end_s").alias("e"))))
        level = level.where(split).withColumn("h", halves).withColumn("start_s", F.col("h.s")).withColumn("end_s", F.col("h.e")).drop("h").withColumn("depth", F.lit(n + 1))
        level = level.withColumn("failed", F.coalesce(fails, F.lit(False)))
    return done.select("rec_id", "k", "depth", "start_s", "end_s", "lost")


def lost_time(errors: DataFrame, recordings: DataFrame) -> DataFrame:
    """Error ranges per recording: number, lost milliseconds, share of the duration in ten-thousandths (double)."""
    ms = F.floor((F.col("end_s") - F.col("start_s")) * 1000 + 0.5)
    e = errors.where("end_s >= start_s").groupBy("rec_id").agg(F.count("*").alias("n"), F.sum(ms).alias("lost_ms"))
    x = e.join(recordings, "rec_id", "left")
    return x.select("rec_id", "n", "lost_ms", F.when(F.col("duration_s") > 0, F.floor(F.col("lost_ms") / (F.col("duration_s") * 1000) * 10000 + 0.5).cast("double")).alias("share_e4"))


def point_speakers(words: DataFrame, turns: DataFrame) -> DataFrame:
    """Adds speaker_at: of the first turn by start with start <= t < end, else of the nearest edge; t is the word's start.

    The preview's looser lookup: half-open, points only.
    """
    at = words.where("start_s is not null").select("rec_id", "pos", F.col("start_s").alias("t"), F.floor(F.col("start_s") / BUCKET_S).alias("bucket"))
    spans = turns.select("rec_id", "ord", "speaker", F.col("start_s").alias("s"), F.col("end_s").alias("e"), F.explode(F.sequence(F.floor(F.col("start_s") / BUCKET_S), F.floor(F.col("end_s") / BUCKET_S))).alias("bucket"))
    inside = at.join(spans, ["rec_id", "bucket"]).where((F.col("s") <= F.col("t")) & (F.col("t") < F.col("e"))).groupBy("rec_id", "pos").agg(F.min_by("speaker", "ord").alias("__sl_in"))
    w = nearest_edge(words, turns, F.col("start_s")).join(inside, ["rec_id", "pos"], "left")
    return w.withColumn("speaker_at", F.coalesce("__sl_in", "near.speaker")).drop("__sl_in", "near")


def raw_accounting(words: DataFrame, turns: DataFrame, hits: DataFrame) -> DataFrame:
    """Why raw label runs outnumber rendered ones: runs, empty, outvoted, changes raw and kept.

    words: (rec_id, pos, start_s, end_s, speaker_raw). A run is kept if a word it hits, or one
    in a gap nearest to it, was given its label.
    """
    o = Window.partitionBy("rec_id").orderBy("ord")
    t = turns.withColumn("new", (~F.col("speaker").eqNullSafe(F.lag("speaker").over(o)) | F.lag("ord").over(o).isNull()).cast("int")).withColumn("run", F.sum("new").over(o))
    h = hits.join(t.select("rec_id", "ord", "run"), ["rec_id", "ord"]).join(words.select("rec_id", "pos", "speaker_raw"), ["rec_id", "pos"])
    touched = h.groupBy("rec_id", "run").agg(F.lit(True).alias("touched"), F.bool_or(F.col("speaker") == F.col("speaker_raw")).alias("won"))
    timed = words.where("start_s is not null and end_s is not null")
    gap = timed.join(hits.select("rec_id", "pos").distinct(), ["rec_id", "pos"], "left_anti").select("rec_id", "pos", ((F.col("start_s") + F.col("end_s")) / 2).alias("mid"))
    near = nearest_edge(gap, turns, F.col("mid")).where("near is not null").select("rec_id", F.col("near.ord").alias("ord")).distinct().join(t.select("rec_id", "ord", "run"), ["rec_id", "ord"])
    gap_won = near.select("rec_id", "run").distinct().withColumn("gap_won", F.lit(True))
    runs = t.groupBy("rec_id", "run").agg(F.min("speaker").alias("speaker")).join(touched, ["rec_id", "run"], "left").join(gap_won, ["rec_id", "run"], "left").fillna(False, ["touched", "won", "gap_won"])
    runs = runs.withColumn("kept", F.col("gap_won") | F.col("won"))
    last = F.last(F.when(F.col("kept"), F.col("speaker")), ignorenulls=True).over(Window.partitionBy("rec_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("kept_change", F.col("kept") & last.isNotNull() & (last != F.col("speaker")))
    return runs.groupBy("rec_id").agg((F.count("*") - 1).alias("raw_changes"), F.count("*").alias("runs"), F.count_if(~F.col("kept") & ~F.col("touched")).alias("empty"), F.count_if(~F.col("kept") & F.col("touched")).alias("outvoted"), F.count_if("kept_change").alias("kept_changes"))


def anchors(st: DataFrame, interval: float) -> DataFrame:
    """Time marks inside long turns: (rec_id, turn, i, kind). Sequential by nature, so one task per long turn.

    Every `interval` seconds the nearest later sentence start within half of it, else the
    nearest later word start; the next target lies an interval on, and at least half of
    one behind the mark.
    """
    t = Window.partitionBy("rec_id", "stretch")
    x = st.select("rec_id", "stretch", "pos", "i", "sent", "start_s", "end_s", F.min("sent").over(t).alias("first_sent"), F.min("pos").over(Window.partitionBy("rec_id", "stretch", "sent")).alias("sent_pos"), F.first("start_s").over(t.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("t0"), F.last("end_s").over(t.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("t1"))
    x = x.where(F.col("t1") - F.col("t0") > interval)

    def run(df: pd.DataFrame) -> pd.DataFrame:
        timed = df[df.start_s.notna()].sort_values(["start_s", "i"])
        opens = timed[timed.sent.gt(timed.first_sent) & timed.pos.eq(timed.sent_pos)]
        spots = {"sentence": _Spots(opens.start_s, opens.i, interval / 2), "word": _Spots(timed.start_s, timed.i)}
        rows = []
        due, behind, end = df.t0.iloc[0] + interval, df.t0.iloc[0], df.t1.iloc[0]
        while due < end:
            kind, spot = next(((k, s) for k, at in spots.items() if (s := at.nearest(due, behind))), (None, None))
            if spot is None:
                break
            behind = spot[0]
            rows.append((df.rec_id.iloc[0], int(df.stretch.iloc[0]), spot[1], kind))
            due = max(due + interval, behind + interval / 2)
        return pd.DataFrame(rows, columns=["rec_id", "turn", "i", "kind"])

    return x.groupBy("rec_id", "stretch").applyInPandas(run, "rec_id string, turn long, i int, kind string")


class _Spots:
    """Places a mark may stand, in order of time."""

    def __init__(self, times: pd.Series, indices: pd.Series, within: float = float("inf")):
        self.t, self.i, self.within = times.to_numpy(), indices.to_numpy(), within

    def nearest(self, due: float, behind: float) -> tuple[float, int] | None:
        """The place nearest to `due` that is later than `behind`; of equally near ones the earliest, then the lowest index."""
        first = np.searchsorted(self.t, behind, "right")
        k = max(first, np.searchsorted(self.t, due, "left"))
        sides = self.t[max(first, k - 1) : k + 1]
        if not len(sides):
            return None
        at = float(sides[np.abs(sides - due).argmin()])
        return (at, int(self.i[np.searchsorted(self.t, at, "left")])) if abs(at - due) <= self.within else None


def preview_lines(words: DataFrame, chars: int = PREVIEW_CHARS) -> DataFrame:
    """Words packed into lines: (rec_id, line, start_s, speaker, text).

    A line ends at a change of speaker, at terminal punctuation from `chars` on, or at twice
    `chars`. words: (rec_id, pos, start_s, text, speaker). A recording is cut between runs of
    one speaker; where a line ends is looked up in the running lengths, so only lines are looped over.
    """
    who = F.struct("speaker")
    x = words.select("rec_id", "pos", "start_s", "text", "speaker", (~who.eqNullSafe(F.lag(who).over(rec()))).cast("int").alias("__sl_new"))
    x = x.withColumn("run", F.sum(F.coalesce("__sl_new", F.lit(1))).over(rec())).drop("__sl_new")

    def pack(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("pos")
        upto = np.cumsum(df.text.str.len().to_numpy() + 1)
        stops = np.flatnonzero(df.text.str.endswith((".", "?", "!")).to_numpy())
        lasts = np.flatnonzero(np.r_[np.diff(df.run.to_numpy()) != 0, True])
        cuts = [0]
        while cuts[-1] < len(df):
            a = cuts[-1]
            before = upto[a - 1] if a else 0
            full, ripe = np.searchsorted(upto, [before + 2 * chars, before + chars])
            stop = np.searchsorted(stops, ripe)
            cuts.append(1 + int(min([full, lasts[np.searchsorted(lasts, a)], *stops[stop : stop + 1]])))
        head = df.iloc[cuts[:-1]]
        texts = df.text.tolist()
        return head.assign(text=[" ".join(texts[a:b]) for a, b in zip(cuts, cuts[1:])])

    lines = x.groupBy("rec_id", F.floor(F.col("run") / RUNS_AT_ONCE)).applyInPandas(pack, x.schema)
    return lines.select("rec_id", (F.row_number().over(rec()) - 1).alias("line"), "start_s", "speaker", "text")


def wrapped(text: Column, width: int, indent: str = "") -> Column:
    """Text broken into lines of `width` without splitting a token; null stays null."""

    @F.pandas_udf("string")
    def wrap(s: pd.Series) -> pd.Series:
        import textwrap

        return s.map(lambda t: None if t is None else "\n".join(textwrap.wrap(t, width, initial_indent=indent, subsequent_indent=indent, break_on_hyphens=False, break_long_words=False)))

    return wrap(text)


def script_words(durations: DataFrame, script: list[str], word_s: float = 0.35, gap_s: float = 0.05, pause_s: float = 0.6, every: int = 8) -> DataFrame:
    """A deterministic word source: the script laid over each duration, a longer gap after every `every` words.

    Output: rec_id, i, text, start_s, end_s (3 decimals).
    """
    k = F.col("k")
    start = k * (word_s + gap_s) + F.floor(k / every) * (pause_s - gap_s)
    most = F.floor(F.col("duration_s") / word_s).cast("int")
    x = durations.where("duration_s > 0").select("rec_id", "duration_s", F.explode(F.sequence(F.lit(0), most)).alias("k"))
    words = F.array(*[F.lit(t) for t in script])
    x = x.withColumn("s", start).where(F.col("s") + word_s <= F.col("duration_s") + 1e-9)
    return x.select("rec_id", k.alias("i"), F.element_at(words, (k % len(script) + 1).cast("int")).alias("text"), F.round("s", 3).alias("start_s"), F.round(F.col("s") + word_s, 3).alias("end_s"))
