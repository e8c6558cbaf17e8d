"""Models as sources of words: which one is meant, what their raw output becomes, how failures show."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamloom.functions.tokens import flags_of
from streamloom.operators.timeline import derived_starts

#: Longest audio, in seconds, whose output may be empty without being an error.
EMPTY_ALLOWED_S = 5.0


def resolved(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """(model_id, adapter, status, reason): ok, unsupported with its reason, or unknown. Keys are compared trimmed, in lower case.

    registry: (model_id, adapter, reason), reason null for models that run.
    """
    key = lambda c: F.lower(F.trim(c))
    r = registry.select(key(F.col("model_id")).alias("k"), F.col("adapter"), F.col("reason"))
    x = requests.select("model_id", key(F.col("model_id")).alias("k")).join(F.broadcast(r), "k", "left")  # the registry is a page long
    return x.select("model_id", "adapter", F.when(F.col("reason").isNotNull(), "unsupported").when(F.col("adapter").isNotNull(), "ok").otherwise("unknown").alias("status"), "reason")


def twice(registry: DataFrame) -> DataFrame:
    """Keys that stand in the registry more than once."""
    return registry.groupBy(F.lower(F.trim("model_id")).alias("key")).agg(F.count("*").alias("n")).where("n > 1")


def chunk_words(chunks: DataFrame) -> DataFrame:
    """Words of timed chunks (rec_id, k, text, start_s, end_s, window_start): trimmed, blank ones left out, times made absolute, missing ones kept missing."""
    t = F.trim("text")
    return chunks.where(F.coalesce(t, F.lit("")) != "").select("rec_id", "k", t.alias("text"), (F.col("start_s") + F.col("window_start")).alias("start_s"), (F.col("end_s") + F.col("window_start")).alias("end_s"))


def untimed_words(texts: DataFrame) -> DataFrame:
    """Words of untimed output (rec_id, text), split on white space, without times."""
    x = texts.select("rec_id", F.posexplode(F.filter(F.split("text", "(?U)\\s+"), lambda t: t != "")).alias("k", "text"))
    return x.select("rec_id", "k", "text", F.lit(None).cast("double").alias("start_s"), F.lit(None).cast("double").alias("end_s"))


def empty_outputs(durations: DataFrame, words: DataFrame, errors: DataFrame) -> DataFrame:
    """An error range over the whole recording where a model gave nothing for more than EMPTY_ALLOWED_S: (rec_id, start_s, end_s, message)."""
    silent = durations.join(words.select("rec_id").distinct(), "rec_id", "left_anti").join(errors.select("rec_id").distinct(), "rec_id", "left_anti")
    return silent.where(F.col("duration_s") > EMPTY_ALLOWED_S).select("rec_id", F.lit(0.0).alias("start_s"), F.col("duration_s").alias("end_s"), F.lit("no output").alias("message"))


def window_labels(label: Column, window: Column, windows: Column) -> Column:
    """Labels told apart by window (w3:Speaker 1) where a recording has several."""
    return F.when(windows > 1, F.concat(F.lit("w"), window.cast("string"), F.lit(":"), label)).otherwise(label)


def planned_words(words: DataFrame, derive: bool) -> DataFrame:
    """Words as a record holds them: starts derived where asked for, each with its own flag added."""
    w = derived_starts(words) if derive else words
    return w.withColumn("flags", F.array_union(F.coalesce("flags", F.array().cast("array<string>")), flags_of(F.col("text"))))


def accepted(options: Column, names: list[str]) -> Column:
    """The options an adapter takes, of a map."""
    return F.map_filter(options, lambda k, _: k.isin(names))


def hotwords(text: Column) -> Column:
    """Terms of a comma list or of one per line; blanks left out."""
    return F.filter(F.transform(F.split(text, "[,\\n]"), lambda t: F.trim(t)), lambda t: t != "")


# -- variants of the deterministic source -----------------------------------------------


def end_only(words: DataFrame) -> DataFrame:
    return words.withColumn("start_s", F.lit(None).cast("double"))


def untimed(words: DataFrame) -> DataFrame:
    return end_only(words).withColumn("end_s", F.lit(None).cast("double"))


def alternating(words: DataFrame, every: int = 12) -> DataFrame:
    """Two speakers by turns of `every` words."""
    return words.withColumn("speaker", F.concat(F.lit("Speaker "), (F.floor(F.col("i") / every) % 2 + 1).cast("string"))).withColumn("conf", F.lit(0.9))


def failing(words: DataFrame, lo: float, hi: float) -> tuple[DataFrame, DataFrame]:
    """Words outside a failed range, and the range as an error of each recording that has words in it."""
    inside = (F.col("start_s") >= lo) & (F.col("start_s") < hi)
    bad = words.where(inside).select("rec_id").distinct().select("rec_id", F.lit(lo).alias("start_s"), F.lit(hi).alias("end_s"), F.lit("failed").alias("message"))
    return words.where(~inside | F.col("start_s").isNull()), bad


def without_markers(words: DataFrame) -> DataFrame:
    """The second, cleaned stream."""
    return words.where(~F.startswith("text", F.lit("[")))


#: Steps from table to table by name; an extension adds its own function.
STEPS: dict[str, Callable[[DataFrame], DataFrame]] = {"end_only": end_only, "untimed": untimed, "alternating": alternating, "without_markers": without_markers}


def steps(words: DataFrame, names: list[str]) -> DataFrame:
    unknown = [n for n in names if n not in STEPS]
    if unknown:
        raise ValueError(f"unknown steps {unknown}; known: {', '.join(STEPS)}")
    return reduce(lambda w, n: STEPS[n](w), names, words)
