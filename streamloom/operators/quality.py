"""Rules that records, calendars and declarations must keep; every breach is a row, never an exception."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamloom.operators.shared import mixed

# -- fixed values: the enumerations of a record and of a model's declaration -----------
TIMING_SOURCES = ["native", "derived", "aligned", "none"]
GRANULARITIES = ["word", "segment"]
# ------------------------------------------------------------------------------------------


def _breaches(df: DataFrame, rules: list[tuple[str, Column]], place: Column) -> DataFrame:
    """(rec_id, rule, place) of all rules broken, in one pass over the rows."""
    hit = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), r) for r, c in rules]), lambda r: r.isNotNull())
    return df.select("rec_id", F.explode(hit).alias("rule"), place.cast("string").alias("place"))


def _breach(df: DataFrame, rule: str, cond: Column, place: Column, key: str = "rec_id") -> DataFrame:
    return df.where(F.coalesce(cond, F.lit(False))).select(F.col(key).alias(key), F.lit(rule).alias("rule"), place.cast("string").alias("place"))


def word_breaches(words: DataFrame) -> DataFrame:
    """Breaches of the word rules: (rec_id, rule, place). words: one row per (rec_id, i) with the record's columns."""
    w = Window.partitionBy("rec_id").orderBy("i")
    x = words.select("*", (F.row_number().over(w) - 1).alias("n"), F.last("start_s", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    rules = [
        ("word_index", F.col("i") != F.col("n")),
        ("word_text", F.col("text").isNull()),
        ("timing_source", ~F.coalesce("timing_source", F.lit("?")).isin(TIMING_SOURCES)),
        ("speaker_source", F.col("speaker_source").isNotNull() & (F.col("speaker_source") != "asr")),
        ("speaker_and_source", F.col("speaker").isNull() != F.col("speaker_source").isNull()),
        ("end_before_start", F.col("end_s") < F.col("start_s")),
        ("start_goes_back", F.col("start_s") < F.col("before")),
    ]
    return _breaches(x, rules, F.col("i"))


def record_breaches(recordings: DataFrame) -> DataFrame:
    """Breaches of the record rules: missing source, model or run fields, an unknown granularity."""
    rules = [(f"missing_{c}", F.col(c).isNull()) for c in ("audio_path", "audio_sha256", "duration_s", "model_id", "created_utc", "device")]
    rules.append(("granularity", ~F.coalesce("granularity", F.lit("?")).isin(GRANULARITIES)))
    return _breaches(recordings, rules, F.lit(None))


def document_breaches(records: DataFrame) -> DataFrame:
    """Breaches of whole record documents: (rec_id, rule, place). A key that is absent and one that is null break the same rule.

    records: rec_id and the columns of sources.records.RECORD. Keys of source, run and model, the granularity, words of
    both streams, turns and errors; the second stream must be of another mode than the first.
    """
    from streamloom.sources.records import SCHEMA_VERSION, words_of

    top = [("schema_version", ~F.coalesce(F.col("schema_version") == SCHEMA_VERSION, F.lit(False)))]
    top += [(f"missing_{k}", F.col(k).isNull()) for k in ("words", "speaker_turns", "errors", "warnings")]
    top += [(f"missing_{part}.{k}", F.col(f"{part}.{k}").isNull()) for part, keys in (("source", ("audio_path", "audio_sha256", "duration_s")), ("asr", ("model_id", "revision", "capabilities", "params", "performance")), ("run", ("created_utc", "device", "pipeline_version"))) for k in keys]
    top.append(("granularity", ~F.coalesce("asr.granularity", F.lit("?")).isin(GRANULARITIES)))
    sec = F.col("secondary_stream")
    top += [(f"missing_secondary_stream.{k}", sec.isNotNull() & sec[k].isNull()) for k in ("mode", "text", "words")]
    top.append(("second_stream_same_mode", sec.isNotNull() & sec["mode"].eqNullSafe(F.col("asr.params.mode"))))
    parts = [_breaches(records, top, F.lit(None))]
    for column, name, keys in (("speaker_turns", "turn", ("start", "end", "speaker")), ("errors", "error", ("start", "end", "message"))):
        x = records.select("rec_id", F.posexplode(column).alias("n", "x"))
        parts.append(_breaches(x, [(f"{name}_without_{k}", F.col(f"x.{k}").isNull()) for k in keys], F.col("n")))
    w = words_of(records).withColumnsRenamed({"start": "start_s", "end": "end_s"})
    parts.append(word_breaches(w.where("stream = 'primary'")))
    order = Window.partitionBy("rec_id").orderBy("i")
    second = w.where("stream = 'secondary'").withColumn("n", F.row_number().over(order) - 1)
    parts.append(_breaches(second, [("second_word_index", F.col("i") != F.col("n"))], F.col("i")))
    return mixed(parts, "rec_id")


#: Values a model's declaration may hold, by column.
DECLARED = {"word_timestamps": ("start_end", "end_only", "none"), "verbatim": ("selectable", "yes", "no"), "hotwords": ("yes", "no", "untrained"), "longform": ("native", "needs_chunking")}


def declaration_breaches(models: DataFrame) -> DataFrame:
    """(model, rule, place): declared values that are none of the known ones or absent, models declared twice."""
    rules = F.array(*[F.struct(F.lit(c).alias("rule"), F.col(c).cast("string").alias("place"), F.coalesce(F.col(c), F.lit("?")).isin(list(v)).alias("ok")) for c, v in DECLARED.items()])
    x = models.select("model", F.explode(F.filter(rules, lambda r: ~r["ok"])).alias("x")).select("model", "x.rule", "x.place")
    twice = models.groupBy("model").agg(F.count("*").alias("c")).where("c > 1").select("model", F.lit("model_twice").alias("rule"), F.col("c").cast("string").alias("place"))
    return mixed([x, twice], "model")


def private_in_outputs(outputs: DataFrame, private: DataFrame) -> DataFrame:
    """(path, kind) of output texts that name what must stay private: outputs (path, text), private (kind, value), a value being a recording's path, file name or person.

    Values are looked for as whole words, in any case: both sides are cut to words of letters and digits and
    joined on the value's first word, so no text meets all values.
    """
    cut = lambda c: F.filter(F.split(F.lower(c), "(?U)[^\\p{L}\\p{N}]+"), lambda w: w != "")
    o = outputs.select("path", cut(F.col("text")).alias("ws"))
    at = o.select("path", "ws", F.posexplode("ws").alias("n", "first"))
    v = private.select("kind", cut(F.col("value")).alias("vs")).where(F.size("vs") > 0).distinct().select("kind", "vs", F.get("vs", F.lit(0)).alias("first"))
    same = F.slice("ws", F.col("n") + 1, F.size("vs")) == F.col("vs")
    return at.join(v, "first").where(same).select("path", "kind").distinct()


def calendar_breaches(semesters: DataFrame, courses: DataFrame) -> DataFrame:
    """(term, rule, place): reversed or overlapping semesters, unknown days, reversed windows, terms used twice."""
    from streamloom.functions.times import WEEKDAYS, clock_seconds

    w = Window.partitionBy(F.lit(0)).orderBy("start", "end", "term")  # one row per semester
    s = semesters.select("*", F.lead(F.struct("term", "start")).over(w).alias("n"))
    day = courses.select("term", "course_code", F.explode("weekdays").alias("day"))
    parts = [
        _breach(s, "reversed", F.col("start") > F.col("end"), F.col("start"), "term"),
        _breach(s, "overlap", F.col("n.start") <= F.col("end"), F.col("n.term"), "term"),
        _breach(semesters.groupBy("term").agg(F.count("*").alias("c")), "term_twice", F.col("c") > 1, F.col("c"), "term"),
        _breach(day, "unknown_day", ~F.col("day").isin(WEEKDAYS), F.concat_ws(" ", "course_code", "day"), "term"),
        _breach(courses, "reversed_window", clock_seconds(F.col("t0")) >= clock_seconds(F.col("t1")), F.col("course_code"), "term"),
    ]
    return reduce(DataFrame.unionByName, parts)


def drift(registry: DataFrame, declared: DataFrame, columns: list[str]) -> DataFrame:
    """Rows only one of the two tables has: (columns, side)."""
    a, b = registry.select(*columns), declared.select(*columns)
    return a.exceptAll(b).withColumn("side", F.lit("registry")).unionByName(b.exceptAll(a).withColumn("side", F.lit("declared")))


def capability_plan(models: DataFrame, requests: DataFrame) -> DataFrame:
    """What a request can have of a model: (model, request, timing_source, derive_starts, forced_alignment, chunking, needs_diarizer, warnings, errors).

    models: (model, word_timestamps, silence_tokens, verbatim, hotwords, longform, speaker_labels);
    requests: (request, model, diarize, mode, hotwords_given, dual_stream). Requests of undeclared models are left out.
    """
    x = requests.join(models, "model")
    ts = F.col("word_timestamps")
    warnings = F.array(
        F.when((ts == "end_only") & ~F.col("silence_tokens"), "pauses_fold_into_next_word"),
        F.when(F.col("mode").isNotNull() & (F.col("mode") != "verbatim") & (F.col("verbatim") == "yes"), "mode_has_no_effect"),
        F.when(F.col("hotwords_given") & (F.col("hotwords") == "untrained"), "hotwords_untrained"),
    )
    errors = F.array(
        F.when((F.col("mode") == "verbatim") & (F.col("verbatim") == "no"), "verbatim_not_possible"),
        F.when(F.col("dual_stream") & (F.col("verbatim") != "selectable"), "two_streams_not_possible"),
        F.when(F.col("hotwords_given") & (F.col("hotwords") == "no"), "hotwords_not_possible"),
    )
    some = lambda a: F.array_join(F.filter(a, lambda v: v.isNotNull()), ",")
    return x.select(
        "model", "request", F.when(ts == "start_end", "native").when(ts == "end_only", "derived").otherwise("aligned").alias("timing_source"),
        (ts == "end_only").alias("derive_starts"), (~ts.isin("start_end", "end_only")).alias("forced_alignment"), (F.col("longform") == "needs_chunking").alias("chunking"),
        (F.col("diarize") & ~F.col("speaker_labels")).alias("needs_diarizer"), some(warnings).alias("warnings"), some(errors).alias("errors"),
    )
