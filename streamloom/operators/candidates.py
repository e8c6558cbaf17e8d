"""Places where a speaker label may be wrong: rule classes over the shared stream.

Every class gives windows (a, b, at) of stream positions; a window holds the
transitions between its words, is cut to the stream and dropped if none is left.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from streamloom.functions import tokens as tk
from streamloom.operators import error_rules, window_rules
from streamloom.operators.arrow_groups import whole_groups
from streamloom.operators.evaluate import INSTRUCTOR, STUDENTS
from streamloom.operators.stream import BUCKET_S, MAX_ISLAND, PAUSE_S, rec, spoken

# -- fixed values: thresholds, word lists and class order of the two versions ------------
ANSWER_OPENERS = (
    "yes yeah yep yup no nope nah right exactly correct sure okay ok well um uh hmm mm mhm mm-hmm uh-huh i i'm i've i'd i'll maybe probably "
    "because good great true"
).split()
BACKCHANNEL = "yeah yes yep yup okay ok right sure exactly correct true mm mhm mm-hmm uh-huh hmm uh um cool gotcha".split()
SECOND_PERSON = "you your you're you've you'd you'll yours yourself yourselves y'all".split()
SOLICIT = "anyone anybody someone somebody question questions".split()
FIRST_PERSON = "i i'm i've i'd i'll me my mine myself".split()
NEAR, ZERO_GAP, ISLAND_WORDS, BACK_WORDS, ADDRESS_WORDS = 3, 0.005, 15, 3, 10
REGISTER_WINDOW, REGISTER_MIN, REGISTER_ONSET = 20, 5, 2
CLAUSE_PAUSE, PAIR_WORDS, CLAUSE_FILLERS = 0.3, 60, ["uh", "um"]
CLAUSE_MARKS = [",", ";", ":", "–", "—"]
GROUP_ROWS = 50_000
ORDER = {
    1: ["shift", "long_island", "edge_island", "no_punct_lowercase", "zero_gap", "inside_sentence", "dropped_raw_change", "question_answer", "backchannel", "address_reply", "register_change"],
    2: ["shift", "long_island", "edge_island", "no_punct_lowercase", "zero_gap", "inside_sentence", "dropped_raw_change", "question_answer", "backchannel", "clause_backchannel", "address_reply", "paired_return", "paired_start"],
}
FAMILY = {
    "shift": "shift", "long_island": "split", "edge_island": "split", "no_punct_lowercase": "split", "zero_gap": "split", "inside_sentence": "split",
    "dropped_raw_change": "raw", "question_answer": "merge", "backchannel": "merge", "address_reply": "merge", "register_change": "merge",
    "clause_backchannel": "merge", "paired_return": "pair", "paired_start": "pair",
}
PAIR_RETURN_FROM = ["dropped_raw_change", "question_answer", "backchannel", "clause_backchannel", "address_reply"]
PAIR_START_FROM = ["backchannel", "clause_backchannel"]
# ------------------------------------------------------------------------------------------


def parameters(version: int) -> dict:
    """All that decides a version's windows."""
    if version not in ORDER:
        raise ValueError(f"unknown version {version!r}")
    return {"version": version, "classes": ORDER[version], "near": NEAR, "zero_gap_s": ZERO_GAP, "island_words": ISLAND_WORDS, "openers": sorted(ANSWER_OPENERS + ["so"] * (version == 2)), "backchannel": sorted(BACKCHANNEL), "second_person": sorted(SECOND_PERSON), "solicit": sorted(SOLICIT), "pair_words": PAIR_WORDS}


def parameters_sha256(version: int) -> str:
    return hashlib.sha256(json.dumps(parameters(version), sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def _marks(version: int) -> dict:
    """What the rules ask of a word alone, by the names of window_rules.BITS."""
    tok, c = F.col("tok"), F.col
    return {
        "terminal": tk.is_terminal(c("text")), "question": tk.ends_question(c("text")), "opener": tok.isin(ANSWER_OPENERS + ["so"] * (version == 2)), "answer": tok.isin(ANSWER_OPENERS),
        "chat": ~tok.isin(BACKCHANNEL), "no_clause": ~tok.isin([t for t in BACKCHANNEL if t not in CLAUSE_FILLERS]), "first": tok.isin(FIRST_PERSON), "person": tok.isin(SECOND_PERSON + SOLICIT),
        "ahead": tok == "ahead", "go": tok == "go", "mark": tk.without_closers(c("text")).rlike("[" + "".join(CLAUSE_MARKS) + "]$"), "lower": tk.first_letter_lower(c("text")),
    }


def _turns_by_recording(turns: DataFrame) -> DataFrame:
    return turns.groupBy("rec_id").agg(F.array_sort(F.collect_list(F.struct("ord", "start_s", "end_s", "speaker"))).alias("turns"))


def windows_of(words: DataFrame, turns: DataFrame, version: int, who: Column | None = None, blank: int = 0, unnamed: int = 0) -> DataFrame:
    """windows() straight from stream.words_once() and stream.turns_once(): words are shuffled and sorted once, and get their labels in the same reading.

    With `who`, the known speaker of each word (evaluate.identity()), the wrong transitions come too (wrong() has them): every
    blank-th verdict of the gold sheet is blank, every unnamed-th real one without its speaker.
    """
    marks = _marks(version)
    bits = sum((F.coalesce(marks[name], F.lit(False)).cast("int") * (1 << k) for k, name in enumerate(window_rules.BITS) if name in marks), F.lit(0))
    known = [] if who is None else [F.coalesce(F.array_position(F.array(*map(F.lit, [INSTRUCTOR, *STUDENTS])), who), F.lit(0)).cast("int") - 1]
    w = spoken(words).select("rec_id", "pos", "i", "start_s", "end_s", "text", tk.cue_token(F.col("text")).alias("tok"), *[k.alias("who") for k in known])
    return _read(w.select("rec_id", "pos", "i", "start_s", "end_s", bits.alias("bits"), *["who" for _ in known]), turns, version, blank, unnamed)


def windows(st: DataFrame, turns: DataFrame, version: int) -> DataFrame:
    """Every window: rec_id, class, a, b, at, first_i, last_i, at_i; and a row of each recording without class: n_words, n_boundaries.

    One exchange and one sort by recording; a recording's turns come with its first word. All
    rules are then read in arrays (window_rules), whole recordings at a time.
    """
    c = F.col
    labels = F.array_union(F.coalesce("hit_labels", F.array().cast("array<string>")), F.filter(F.array("speaker_raw"), lambda x: x.isNotNull()))
    w = st.select("rec_id", "pos", "i", "start_s", "gap_next", "text", "speaker", "stretch", "boundary", "change", "hit_ords", F.array_except(labels, F.array("speaker")).alias("lost"), tk.cue_token(c("text")).alias("tok"))
    marks = _marks(version) | {"ends": c("boundary").isNotNull(), "change": c("change")}
    bits = sum((F.coalesce(marks[name], F.lit(False)).cast("int") * (1 << k) for k, name in enumerate(window_rules.BITS)), F.lit(0))
    return _read(w.select("rec_id", "pos", "i", "start_s", "gap_next", "speaker", "stretch", "hit_ords", "lost", bits.alias("bits")), turns, version)


def _read(w: DataFrame, turns: DataFrame, version: int, blank: int = 0, unnamed: int = 0) -> DataFrame:
    """window_rules, and error_rules where the known speakers are given, over whole recordings; a recording's turns come with its first word."""
    fixed = {
        "near": NEAR, "pair_words": PAIR_WORDS, "pause": PAUSE_S, "clause_pause": CLAUSE_PAUSE, "island_words": ISLAND_WORDS, "address_words": ADDRESS_WORDS, "back_words": BACK_WORDS,
        "zero_gap": ZERO_GAP, "max_island": MAX_ISLAND, "bucket_s": BUCKET_S, "register_window": REGISTER_WINDOW, "register_min": REGISTER_MIN, "register_onset": REGISTER_ONSET,
    }
    classes, c, ready, judged = ORDER[version], F.col, "speaker" in w.columns, "who" in w.columns
    i = w.schema["i"].dataType
    w = w.join(_turns_by_recording(turns), "rec_id", "left").withColumn("turns", F.when(c("pos") == 0, c("turns")))
    w = w.select("*", F.row_number().over(rec()).alias("k"), F.xxhash64("rec_id").alias("key"))
    out = "rec_id string, class string, a int, b int, at int, " + ", ".join(f"{k} {i.simpleString()}" for k in ("first_i", "last_i", "at_i")) + ", n_words bigint, n_boundaries bigint" + ", kind string, misattributed bigint, high_harm boolean" * judged
    i_type = to_arrow_type(i)

    def read(batches):
        names, kinds = pa.array(classes), pa.array(error_rules.KINDS)
        for table in whole_groups(batches, ["key"], GROUP_ROWS):
            of = window_rules.columns_of(table) if ready else window_rules.labelled(table, fixed)
            row, kind, values, first, n, changes = window_rules.windows(table, of, version, classes, fixed)
            rec_id, pos = table["rec_id"].combine_chunks(), table["pos"].to_numpy()
            wrong, what, words, harm = error_rules.errors(table, of, blank, unnamed) if judged else (np.zeros(0, dtype=np.int64),) * 4
            whole, bad = len(first), len(wrong)
            empty = lambda k, kind: pa.nulls(k, kind)
            cols = [_one(rec_id.take(pa.array(np.concatenate([row, first, wrong])))), pa.concat_arrays([names.take(pa.array(kind)), empty(whole + bad, pa.string())])]
            for name, kind_ in (("a", pa.int32()), ("b", pa.int32()), ("at", pa.int32()), ("first_i", i_type), ("last_i", i_type), ("at_i", i_type)):
                cols.append(pa.concat_arrays([pa.array(values[name]).cast(kind_), empty(whole, kind_), pa.array(pos[wrong]).cast(kind_) if name == "at" else empty(bad, kind_)]))
            for v in (n, changes):
                cols.append(pa.concat_arrays([empty(len(row), pa.int64()), pa.array(v).cast(pa.int64()), empty(bad, pa.int64())]))
            if judged:
                cols += [pa.concat_arrays([empty(len(row) + whole, v.type), v]) for v in (kinds.take(pa.array(what)), pa.array(words).cast(pa.int64()), pa.array(harm).cast(pa.bool_()))]
            yield pa.RecordBatch.from_arrays(cols, names=["rec_id", "class", "a", "b", "at", "first_i", "last_i", "at_i", "n_words", "n_boundaries", *["kind", "misattributed", "high_harm"][: 3 * judged]])

    return w.mapInArrow(read, out)


def _one(c) -> pa.Array:
    """A column's rows in one array."""
    return c if isinstance(c, pa.Array) else pa.concat_arrays(c.chunks)


def found_windows(windows: DataFrame, version: int = 1) -> DataFrame:
    """All windows of a version, numbered by (a, b, class order, at): rec_id, id, class, family, a, b, at, first_i, last_i, at_i. Empty streams give none."""
    rank = F.array_position(F.array(*[F.lit(c) for c in ORDER[version]]), F.col("class"))
    out = windows.where("class is not null").withColumn("id", F.row_number().over(Window.partitionBy("rec_id").orderBy("a", "b", rank, "at")))
    index = F.create_map(*[F.lit(x) for kv in FAMILY.items() for x in kv])
    return out.select("rec_id", F.concat(F.lit("C-"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("id"), "class", F.element_at(index, F.col("class")).alias("family"), "a", "b", "at", "first_i", "last_i", "at_i")


def wrong(windows: DataFrame) -> DataFrame:
    """The wrong transitions of windows_of() with known speakers, as evaluate.errors()."""
    return windows.where("kind is not null").select("rec_id", "kind", F.col("at").alias("t"), "misattributed", "high_harm")


def candidates(st: DataFrame, turns: DataFrame, version: int = 1) -> DataFrame:
    """found_windows() of a stream."""
    return found_windows(windows(st, turns, version), version)


def sites(found: DataFrame) -> DataFrame:
    """Windows that share a word, merged: rec_id, site (from 1), a, b, n_windows, classes in name order."""
    w = Window.partitionBy("rec_id").orderBy("a", "b", "class", "at")
    reach = F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    f = found.withColumn("new", (reach.isNull() | (F.col("a") > reach)).cast("int")).withColumn("site", F.sum("new").over(w).cast("int"))
    return f.groupBy("rec_id", "site").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.count("*").alias("n_windows"), F.array_join(F.sort_array(F.collect_set("class")), ",").alias("classes"))


def volume(found: DataFrame, n: DataFrame, durations: DataFrame) -> DataFrame:
    """Counts per recording: words, windows, per hour, sites, covered words and their share. n: (rec_id, n_words, n_boundaries)."""
    s = sites(found).groupBy("rec_id").agg(F.count("*").alias("n_sites"), F.sum(F.col("b") - F.col("a") + 1).alias("covered"))
    c = found.groupBy("rec_id").agg(F.count("*").alias("n_candidates"))
    hours = F.col("duration_s") / 3600
    out = n.join(c, "rec_id", "left").join(s, "rec_id", "left").join(durations, "rec_id", "left").fillna(0, ["n_candidates", "n_sites", "covered"])
    return out.select("rec_id", "n_words", "n_boundaries", "n_candidates", "n_sites", "covered", F.floor(F.when(hours > 0, F.col("n_candidates") / hours) * 10 + 0.5).alias("per_hour_tenths"), F.floor(F.col("covered") / F.col("n_words") * 10000 + 0.5).alias("covered_share_e4"))
