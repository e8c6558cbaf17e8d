"""The one shared view of a word stream: spoken words in order with their speakers, sentences and stretches.

Every window here is (rec_id ORDER BY pos), so Spark shuffles words once and sorts
once; what needs a range join is cut by time buckets first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from streamloom.functions.tokens import flags_of, is_terminal
from streamloom.operators.shared import mixed

PAUSE_S, MAX_ISLAND, BUCKET_S = 0.5, 2, 30.0


def rec() -> WindowSpec:
    """The one window of a recording's stream."""
    return Window.partitionBy("rec_id").orderBy("pos")


def once(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each key; re-delivered rows agree, the first delivered stands. Null keys are left out.

    Rows are shuffled by the first key only and sorted by all: a later window by that
    key in the order of the second needs neither again.
    """
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    late = F.col("loaded_at").asc_nulls_last() if "loaded_at" in df.columns else F.lit(0)
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(late))
    return df.repartition(keys[0]).withColumn("__sl_n", n).where("__sl_n = 1").drop("__sl_n")


def words_once(words: DataFrame) -> DataFrame:
    """(rec_id, i, text, start_s, end_s, flags, speaker): own flags joined with those a token's form tells."""
    w = once(words.select("rec_id", "i", "text", "start_s", "end_s", "flags", "speaker", "loaded_at"), ["rec_id", "i"])
    own = F.coalesce("flags", F.array().cast("array<string>"))
    return w.select("rec_id", "i", F.coalesce("text", F.lit("")).alias("text"), "start_s", "end_s", F.array_union(own, flags_of(F.col("text"))).alias("flags"), "speaker")


def turns_once(turns: DataFrame) -> DataFrame:
    """Sound turns in (start, end) order: finite, not negative, not reversed, with a speaker; `ord` counts from 0."""
    t = once(turns.select("rec_id", "turn_ord", "start_s", "end_s", "speaker", "loaded_at"), ["rec_id", "turn_ord"])
    s, e = F.col("start_s"), F.col("end_s")
    sound = ~F.isnan(s) & ~F.isnan(e) & (s >= 0) & (e >= s) & (e < float("inf")) & (F.col("speaker") != "")
    t = t.where(sound).select("rec_id", "turn_ord", "start_s", "end_s", "speaker")
    return t.withColumn("ord", F.row_number().over(Window.partitionBy("rec_id").orderBy("start_s", "end_s", "turn_ord")) - 1)


def spoken(words: DataFrame) -> DataFrame:
    """Silence tokens dropped; `pos` is the place in the stream, `i` stays the record's."""
    w = words.where(~F.array_contains("flags", "silence"))
    return w.withColumn("pos", F.row_number().over(Window.partitionBy("rec_id").orderBy("i")) - 1)


def _buckets(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(F.floor(start / BUCKET_S), F.floor(end / BUCKET_S)))


def hits(words: DataFrame, turns: DataFrame) -> DataFrame:
    """(rec_id, pos, ord, speaker, t_start, t_end, overlap) of every turn that overlaps a word or holds its middle.

    Words without both times hit nothing. A range join: both sides are cut into time
    buckets, so a long recording spreads over tasks; a pair is kept in the first
    bucket both share.
    """
    lo, hi = F.least("start_s", "end_s"), F.greatest("start_s", "end_s")
    w = words.where(F.col("start_s").isNotNull() & F.col("end_s").isNotNull()).select("rec_id", "pos", F.col("start_s").alias("ws"), F.col("end_s").alias("we"), _buckets(lo, hi).alias("bucket"))
    t = turns.select("rec_id", "ord", "speaker", F.col("start_s").alias("t_start"), F.col("end_s").alias("t_end"), _buckets(F.col("start_s"), F.col("end_s")).alias("bucket"))
    overlap = F.least("we", "t_end") - F.greatest("ws", "t_start")
    mid = (F.col("ws") + F.col("we")) / 2
    j = w.join(t, ["rec_id", "bucket"]).withColumn("overlap", overlap)
    first = F.greatest(F.floor(F.least("ws", "we") / BUCKET_S), F.floor(F.col("t_start") / BUCKET_S))
    j = j.where(((F.col("overlap") > 0) | ((F.col("t_start") <= mid) & (mid <= F.col("t_end")))) & (F.col("bucket") == first))
    return j.select("rec_id", "pos", "ord", "speaker", "t_start", "t_end", "overlap")


def nearest_edge(words: DataFrame, turns: DataFrame, t: Column) -> DataFrame:
    """Adds near, struct(t, ord, speaker): the turn edge nearest to t, of the first turn on ties; null without t or turns.

    Edges and words stand in one order of time and each edge knows the next, so one
    reading gives a word the edges on both sides; no word meets all turns.
    """
    own = Window.partitionBy("rec_id")
    edges = turns.select("rec_id", "ord", "speaker", F.explode(F.array("start_s", "end_s")).alias("__sl_t"))
    edges = edges.groupBy("rec_id", "__sl_t").agg(F.min(F.struct("ord", "speaker")).alias("e"))
    edges = edges.select("rec_id", "__sl_t", F.struct(F.col("__sl_t").alias("t"), F.col("e.ord").alias("ord"), F.col("e.speaker").alias("speaker")).alias("__sl_e"))
    edges = edges.withColumn("__sl_next", F.lead("__sl_e").over(own.orderBy("__sl_t")))
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in words.schema if f.name != "rec_id"]
    words = words.withColumn("__sl_t", t)
    both = mixed([words.select("*", *[F.lit(None).cast(edges.schema[c].dataType).alias(c) for c in ("__sl_e", "__sl_next")]), edges.select("rec_id", *blank, "__sl_t", "__sl_e", "__sl_next")], "rec_id")
    is_word = F.col("__sl_e").isNull()
    ahead = own.orderBy("__sl_t", is_word).rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(~is_word, F.struct("__sl_e", "__sl_next")), ignorenulls=True).over(ahead)
    both = both.select("*", last.alias("__sl_at"), F.min("__sl_e").over(own).alias("__sl_first")).where(is_word)
    at, before, after = F.col("__sl_t"), F.col("__sl_at.__sl_e"), F.when(F.col("__sl_at").isNull(), F.col("__sl_first")).otherwise(F.col("__sl_at.__sl_next"))
    db, da = F.abs(at - before["t"]), F.abs(at - after["t"])
    take_before = after.isNull() | (before.isNotNull() & ((db < da) | ((db == da) & (before["ord"] < after["ord"]))))
    near = F.when(at.isNotNull(), F.when(take_before, before).otherwise(after))
    return both.withColumn("near", near).drop("__sl_t", "__sl_e", "__sl_next", "__sl_at", "__sl_first")


def assigned(words: DataFrame, turns: DataFrame) -> DataFrame:
    """Adds speaker_raw: the turn of greatest overlap, first by (start, end); in a gap the nearest turn edge.

    A word inside a turn counts as overlapping it by 0. Words without both times, and
    recordings without turns, get null. hit_ords and hit_labels: the turns that hit the word, null in a gap.
    """
    best = hits(words, turns).groupBy("rec_id", "pos").agg(
        F.min_by("speaker", F.struct(-F.greatest("overlap", F.lit(0.0)), "ord")).alias("__sl_hit"), F.collect_set("ord").alias("hit_ords"), F.collect_set("speaker").alias("hit_labels"),
    )
    w = nearest_edge(words.join(best, ["rec_id", "pos"], "left"), turns, F.when(F.col("hit_ords").isNull(), (F.col("start_s") + F.col("end_s")) / 2))
    w = w.withColumn("speaker_raw", F.when(F.col("hit_ords").isNotNull(), F.col("__sl_hit")).otherwise(F.col("near.speaker")))
    return w.drop("__sl_hit", "near")


def _differs(a: str, b: Column) -> Column:
    return ~F.col(a).eqNullSafe(b)


def smoothed(words: DataFrame, pause: float = PAUSE_S, max_island: int = MAX_ISLAND) -> DataFrame:
    """Adds speaker and flipped: short islands inside pause-bounded runs take their neighbours' speaker.

    Neighbours are judged before any flip, so flips don't cascade. Null speakers
    equal each other.
    """
    w = words.withColumn("__sl_break", F.coalesce(F.col("start_s") - F.lag("end_s").over(rec()) > pause, F.lit(False)))
    w = w.withColumn("__sl_run", F.sum(F.col("__sl_break").cast("int")).over(rec()))
    new = F.col("__sl_break") | _differs("speaker_raw", F.lag("speaker_raw").over(rec())) | (F.col("pos") == 0)
    w = w.withColumn("__sl_st", F.sum(new.cast("int")).over(rec()))
    w = w.select("*", F.lag(F.struct("speaker_raw", "__sl_run")).over(rec()).alias("__sl_l"), F.lead(F.struct("speaker_raw", "__sl_run")).over(rec()).alias("__sl_n"))
    whole = Window.partitionBy("rec_id", "__sl_st").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left, right = F.first("__sl_l").over(whole), F.last("__sl_n").over(whole)
    w = w.select("*", left.alias("__sl_left"), right.alias("__sl_right"), F.count(F.lit(1)).over(whole).alias("__sl_size"))
    run = F.col("__sl_run")
    same_run = (F.col("__sl_left.__sl_run") == run) & (F.col("__sl_right.__sl_run") == run)
    agree = F.col("__sl_left.speaker_raw").eqNullSafe(F.col("__sl_right.speaker_raw"))
    flip = same_run & agree & _differs("speaker_raw", F.col("__sl_left.speaker_raw")) & (F.col("__sl_size") <= max_island)
    flip = F.coalesce(flip, F.lit(False))
    w = w.withColumn("flipped", flip).withColumn("speaker", F.when(F.col("flipped"), F.col("__sl_left.speaker_raw")).otherwise(F.col("speaker_raw")))
    return w.drop(*[c for c in w.columns if c.startswith("__sl_")])


def named(words: DataFrame, names: DataFrame) -> DataFrame:
    """Speakers replaced by their display names where the recording's map has one."""
    m = once(names.select("rec_id", "speaker", "display_name", "loaded_at"), ["rec_id", "speaker"]).where("display_name is not null").select("rec_id", "speaker", "display_name")
    return words.join(m, ["rec_id", "speaker"], "left").withColumn("speaker", F.coalesce("display_name", "speaker")).drop("display_name")


def sentences(words: DataFrame, pause: float = PAUSE_S) -> DataFrame:
    """Adds gap_next, boundary (end, speaker, punct, pause; null inside a sentence) and sent (from 0)."""
    nxt = F.lead(F.struct("speaker", "start_s")).over(rec())
    w = words.withColumn("__sl_n", nxt).withColumn("gap_next", F.col("__sl_n.start_s") - F.col("end_s"))
    boundary = (
        F.when(F.col("__sl_n").isNull(), "end").when(_differs("speaker", F.col("__sl_n.speaker")), "speaker")
        .when(is_terminal(F.col("text")), "punct").when(F.col("gap_next") > pause, "pause")
    )
    w = w.withColumn("boundary", boundary).drop("__sl_n")
    before = rec().rowsBetween(Window.unboundedPreceding, -1)
    return w.withColumn("sent", F.coalesce(F.sum(F.col("boundary").isNotNull().cast("int")).over(before), F.lit(0)))


def stretches(words: DataFrame) -> DataFrame:
    """Adds change (the label changes entering the word) and stretch (from 0, over the whole stream)."""
    w = words.withColumn("change", (F.col("pos") > 0) & _differs("speaker", F.lag("speaker").over(rec())))
    return w.withColumn("stretch", F.sum(F.col("change").cast("int")).over(rec()))


def stream(words: DataFrame, turns: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """words -> spoken -> assigned -> smoothed -> (named) -> sentences and stretches."""
    w = spoken(words_once(words)).withColumnRenamed("speaker", "asr_speaker")
    w = smoothed(assigned(w, turns_once(turns)))
    if names is not None:
        w = named(w, names)
    return stretches(sentences(w))


def sentence_table(st: DataFrame) -> DataFrame:
    return st.groupBy("rec_id", "sent").agg(
        F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"), F.min("i").alias("first_i"), F.max("i").alias("last_i"),
        F.max("boundary").alias("boundary"), F.min_by("speaker", "pos").alias("speaker"), F.min_by("start_s", "pos").alias("start_s"), F.max_by("end_s", "pos").alias("end_s"),
        F.min("stretch").alias("stretch"),
    )


def turn_table(st: DataFrame) -> DataFrame:
    """Runs of sentences of one speaker: as sentences break at every change, these are the stretches."""
    return st.groupBy("rec_id", F.col("stretch").alias("turn")).agg(
        F.min_by("speaker", "pos").alias("speaker"), F.min("i").alias("first_i"), F.max("i").alias("last_i"), F.count("*").alias("n_words"), F.count_distinct("sent").alias("n_sentences"),
    )
