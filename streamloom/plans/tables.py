"""Reading the tables of a directory; keys and repeated deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamloom.operators.intervals import millis

SILENCE = "_"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def timed_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rec_id, i, start_ms, end_ms, loaded_at) of the timed words, re-deliveries included."""
    w = load(spark, sf_dir, "words").where(F.coalesce(F.col("text") != SILENCE, F.lit(True)))
    w = w.select("rec_id", "i", millis(F.col("start_s")).alias("start_ms"), millis(F.col("end_s")).alias("end_ms"), "loaded_at")
    return w.where(F.col("end_ms") >= F.col("start_ms"))
