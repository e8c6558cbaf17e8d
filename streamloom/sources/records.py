"""Transcript records: one nested JSON document per recording, read, taken apart, put together and written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA_VERSION = "1.0"

WORD = T.StructType([
    T.StructField("i", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("start", T.DoubleType()), T.StructField("end", T.DoubleType()),
    T.StructField("timing_source", T.StringType()), T.StructField("speaker", T.StringType()), T.StructField("speaker_source", T.StringType()), T.StructField("conf", T.DoubleType()),
    T.StructField("flags", T.ArrayType(T.StringType())),
])
TURN = T.StructType([T.StructField("start", T.DoubleType()), T.StructField("end", T.DoubleType()), T.StructField("speaker", T.StringType())])
ERROR = T.StructType([T.StructField("start", T.DoubleType()), T.StructField("end", T.DoubleType()), T.StructField("message", T.StringType())])
RECORD = T.StructType([
    T.StructField("schema_version", T.StringType()),
    T.StructField("source", T.StructType([T.StructField("audio_path", T.StringType()), T.StructField("audio_sha256", T.StringType()), T.StructField("duration_s", T.DoubleType()), T.StructField("excerpt", T.StructType([T.StructField("start_time", T.StringType()), T.StructField("offset_s", T.DoubleType())]))])),
    T.StructField("run", T.StructType([T.StructField("created_utc", T.StringType()), T.StructField("device", T.StringType()), T.StructField("hostname", T.StringType()), T.StructField("pipeline_version", T.StructType([T.StructField("commit", T.StringType()), T.StructField("branch", T.StringType()), T.StructField("dirty", T.BooleanType())])), T.StructField("packages", T.MapType(T.StringType(), T.StringType()))])),
    T.StructField("asr", T.StructType([T.StructField("model_id", T.StringType()), T.StructField("revision", T.StringType()), T.StructField("adapter", T.StringType()), T.StructField("granularity", T.StringType()), T.StructField("timing_source", T.StringType()), T.StructField("capabilities", T.MapType(T.StringType(), T.StringType())), T.StructField("params", T.StructType([T.StructField("mode", T.StringType()), T.StructField("hotwords", T.ArrayType(T.StringType()))])), T.StructField("performance", T.MapType(T.StringType(), T.DoubleType()))])),
    T.StructField("diarization", T.StructType([T.StructField("model_id", T.StringType()), T.StructField("revision", T.StringType())])),
    T.StructField("words", T.ArrayType(WORD)), T.StructField("text", T.StringType()), T.StructField("speaker_turns", T.ArrayType(TURN)),
    T.StructField("secondary_stream", T.StructType([T.StructField("mode", T.StringType()), T.StructField("text", T.StringType()), T.StructField("words", T.ArrayType(WORD))])),
    T.StructField("errors", T.ArrayType(ERROR)), T.StructField("warnings", T.ArrayType(T.StringType())),
])


def read_records(spark: SparkSession, path: str, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, refused): documents of the known version that parse, keyed by rec_id, and the others' paths with the reason.

    A document a file, whose stem is its rec_id; with lines a document a line with its own rec_id, as write_records leaves them.
    """
    own = [T.StructField("rec_id", T.StringType())] if lines else []
    schema = T.StructType([*own, *RECORD.fields, T.StructField("_corrupt_record", T.StringType())])
    raw = spark.read.schema(schema).option("multiLine", not lines).option("mode", "PERMISSIVE").json(path).withColumn("path", F.input_file_name())
    why = F.when(F.col("_corrupt_record").isNotNull(), "not_json").when(~F.coalesce(F.col("schema_version") == SCHEMA_VERSION, F.lit(False)), "version").when(F.col("words").isNull(), "no_words")
    raw = raw.withColumn("why", why)
    rec_id = F.col("rec_id") if lines else F.regexp_extract("path", "([^/]+?)(?:_raw)?\\.json$", 1)
    return raw.where("why is null").select(rec_id.alias("rec_id"), *RECORD.fieldNames()), raw.where("why is not null").select("path", "why")


def hotwords_of(records: DataFrame) -> DataFrame:
    """(rec_id, term) of the terms each record's model was biased toward, in their order; records without any give none."""
    return records.select("rec_id", F.posexplode("asr.params.hotwords").alias("n", "term"))


def words_of(records: DataFrame) -> DataFrame:
    """Words of both streams: rec_id, stream (primary, secondary), and the word's fields."""
    first = records.select("rec_id", F.lit("primary").alias("stream"), F.inline("words"))
    second = records.select("rec_id", F.lit("secondary").alias("stream"), F.inline("secondary_stream.words"))
    return first.unionByName(second)


def turns_of(records: DataFrame) -> DataFrame:
    t = records.select("rec_id", F.posexplode("speaker_turns").alias("turn_ord", "t"))
    return t.select("rec_id", "turn_ord", F.col("t.start").alias("start_s"), F.col("t.end").alias("end_s"), "t.speaker")


def errors_of(records: DataFrame) -> DataFrame:
    t = records.select("rec_id", F.posexplode("errors").alias("err_ord", "t"))
    return t.select("rec_id", "err_ord", F.col("t.start").alias("start_s"), F.col("t.end").alias("end_s"), "t.message")


def selected_stream(records: DataFrame, wanted: str) -> DataFrame:
    """(rec_id, stream, warning): the stream of the wanted mode, else the primary with a warning."""
    primary = F.coalesce("asr.params.mode", F.lit("verbatim"))
    other = (F.col("secondary_stream.mode") == wanted) & (F.size("secondary_stream.words") > 0)
    fits = primary == wanted
    return records.select("rec_id", F.when(~fits & F.coalesce(other, F.lit(False)), "secondary").otherwise("primary").alias("stream"), F.when(~fits & ~F.coalesce(other, F.lit(False)), F.concat(F.lit("no "), F.lit(wanted), F.lit(" stream; the primary one is used"))).alias("warning"))


def assembled(recordings: DataFrame, words: DataFrame, turns: DataFrame, errors: DataFrame) -> DataFrame:
    """One document per recording from the flat tables; arrays in their own order, empty where there are no rows."""
    w = words.groupBy("rec_id").agg(F.sort_array(F.collect_list(F.struct("i", "text", F.col("start_s").alias("start"), F.col("end_s").alias("end"), "timing_source", "speaker", "speaker_source", "conf", "flags"))).alias("words"))
    t = turns.groupBy("rec_id").agg(F.sort_array(F.collect_list(F.struct("turn_ord", F.col("start_s").alias("start"), F.col("end_s").alias("end"), "speaker"))).alias("t"))
    t = t.select("rec_id", F.transform("t", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["speaker"].alias("speaker"))).alias("speaker_turns"))
    e = errors.groupBy("rec_id").agg(F.sort_array(F.collect_list(F.struct("err_ord", F.col("start_s").alias("start"), F.col("end_s").alias("end"), "message"))).alias("e"))
    e = e.select("rec_id", F.transform("e", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["message"].alias("message"))).alias("errors"))
    x = recordings.join(w, "rec_id", "left").join(t, "rec_id", "left").join(e, "rec_id", "left")
    empty = lambda c, kind: F.coalesce(c, F.array().cast(T.ArrayType(kind))).alias(c)
    return x.select(
        "rec_id", F.lit(SCHEMA_VERSION).alias("schema_version"), F.struct("audio_path", "audio_sha256", "duration_s").alias("source"),
        F.struct(F.date_format("created_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_utc"), "device").alias("run"), F.struct("model_id", "adapter", "granularity", "timing_source").alias("asr"), F.struct(F.col("diar_model").alias("model_id")).alias("diarization"),
        empty("words", WORD), "text", empty("speaker_turns", TURN), empty("errors", ERROR), F.coalesce("warnings", F.array().cast("array<string>")).alias("warnings"),
    )


def write_records(records: DataFrame, path: str, overwrite: bool = False) -> DataFrame:
    """Writes a JSON document per line and gives its breaches (rec_id, rule, place): a flawed record is written all the same.

    Keys stand in the order of the schema and numbers in their shortest form, so equal records give equal lines.
    Refuses a path that is there unless told to overwrite.
    """
    from streamloom.operators.quality import document_breaches

    records.write.mode("overwrite" if overwrite else "errorifexists").json(path)
    return document_breaches(read_records(records.sparkSession, path, lines=True)[0])


def write_canonical(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Rows, such as candidates, labels or scores, as one sorted JSON document per key, written once: fields in name order, rows in the order of all fields."""
    fields = sorted(c for c in rows.columns if c not in keys)
    one = rows.groupBy(*keys).agg(F.to_json(F.sort_array(F.collect_list(F.struct(*fields)))).alias("rows"))
    one.sort(*keys).write.mode("errorifexists").json(path)


def output_name(stem, day, start, tag):
    """stem[-day][_seg_hhmmss][_tag]; a day the stem holds already isn't repeated."""
    return F.concat(
        stem, F.when(day.isNotNull() & ~F.contains(stem, day), F.concat(F.lit("-"), day)).otherwise(""),
        F.when(F.coalesce(start, F.lit("")) != "", F.concat(F.lit("_seg_"), F.replace(start, F.lit(":"), F.lit("")))).otherwise(""), F.when(F.coalesce(tag, F.lit("")) != "", F.concat(F.lit("_"), tag)).otherwise(""),
    )
