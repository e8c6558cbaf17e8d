"""Diarizer outputs compared on one gold: headline figures, the worse of two runs, pass bars, a decision."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamloom.operators.evaluate import ratio

# -- fixed values: the bars -----------------------------------------------------------------
PRIMARY_SHARE, RUNS_SHARE, ACCURACY_DROP_E4, CLOSE_CALL_WORDS = 0.5, 0.5, 50, 5
RECALL_BAR_E4, SITES_PER_HOUR_BAR, COVERED_BAR_E4 = 10000, 90.0, 1000
# ----------------------------------------------------------------------------------------------


def headline(judged: DataFrame, runs: DataFrame, folded: DataFrame) -> DataFrame:
    """(arm, run): student words shown as the instructor's, their share, harmful runs, accuracy, and the words and runs again with folded labels as the instructor's.

    judged, folded: words of each arm and run under its map and under the pessimistic one; runs: error runs under its map.
    """
    harm = F.count_if(F.col("direction") == "student_as_instructor")
    w = judged.groupBy("arm", "run").agg(harm.alias("harm_words"), F.count_if(F.col("known") & F.col("truth").rlike("^S[2-9]?$")).alias("student_words"), F.count_if("known").alias("scored"), F.count_if("err").alias("wrong"))
    r = runs.groupBy("arm", "run").agg(F.count_if("high_harm").alias("harm_runs"))
    p = folded.groupBy("arm", "run").agg(harm.alias("pessimistic_words"), F.count_if(F.col("run_start") & (F.col("direction") == "student_as_instructor")).alias("pessimistic_runs"))
    x = w.join(r, ["arm", "run"], "left").join(p, ["arm", "run"], "left").fillna(0, ["harm_runs", "pessimistic_words", "pessimistic_runs"])
    x = x.withColumn("share_e4", ratio(F.col("harm_words"), F.col("student_words")))
    return x.withColumn("accuracy_e4", ratio(F.col("scored") - F.col("wrong"), F.col("scored")))


def worse_runs(h: DataFrame) -> DataFrame:
    """Of an arm's runs the one with more harmful words, then runs, then lower accuracy, then the first."""
    w = Window.partitionBy("arm").orderBy(F.desc("harm_words"), F.desc("harm_runs"), F.coalesce("accuracy_e4", F.lit(0.0)), "run")
    return h.withColumn("k", F.row_number().over(w)).where("k = 1").drop("k")


def identical_runs(turns: DataFrame) -> DataFrame:
    """(arm, rec_id, identical): whether all runs gave the same turns, by one hash of each run's sorted turns."""
    one = turns.groupBy("arm", "rec_id", "run").agg(F.sha2(F.to_json(F.sort_array(F.collect_list(F.struct("start_s", "end_s", "speaker")))), 256).alias("h"))
    return one.groupBy("arm", "rec_id").agg((F.count_distinct("h") == 1).alias("identical"))


def bars(h: DataFrame, baseline: str) -> DataFrame:
    """Each other arm against the baseline: words, words with folded labels as the instructor's, runs and accuracy within their limits, and all of them."""
    every = Window.partitionBy(F.lit(0))  # a row per arm
    own = lambda c: F.max(F.when(F.col("arm") == baseline, F.col(c))).over(every)
    x = h.select("*", own("harm_words").alias("b_words"), own("harm_runs").alias("b_runs"), own("accuracy_e4").alias("b_acc")).where(F.col("arm") != baseline)
    x = x.withColumn("words_ok", F.col("harm_words") <= F.floor(F.col("b_words") * PRIMARY_SHARE)).withColumn("runs_ok", F.col("harm_runs") <= F.floor(F.col("b_runs") * RUNS_SHARE))
    x = x.withColumn("pessimistic_ok", F.col("pessimistic_words") <= F.floor(F.col("b_words") * PRIMARY_SHARE)).withColumn("worse_than_baseline", F.col("harm_words") > F.col("b_words"))
    x = x.withColumn("accuracy_ok", F.coalesce("accuracy_e4", F.lit(0.0)) >= F.coalesce("b_acc", F.lit(0.0)) - ACCURACY_DROP_E4)
    return x.withColumn("passes", F.col("words_ok") & F.col("pessimistic_ok") & F.col("runs_ok") & F.col("accuracy_ok")).drop("b_words", "b_runs", "b_acc")


def decision(passed: DataFrame) -> DataFrame:
    """One row: keep the baseline, switch to an arm, or a close call of the best two."""
    best = passed.where("passes").agg(F.slice(F.sort_array(F.collect_list(F.struct("harm_words", "arm"))), 1, 2).alias("b"))  # arms are a handful
    gap = F.get("b", F.lit(1))["harm_words"] - F.get("b", F.lit(0))["harm_words"]
    one = F.concat(F.lit("switch: "), F.get("b", F.lit(0))["arm"])
    return best.select(F.when(F.size("b") == 0, "keep").when(F.size("b") == 1, one).when(gap > CLOSE_CALL_WORDS, one).otherwise(F.concat(F.lit("close: "), F.get("b", F.lit(0))["arm"], F.lit(", "), F.get("b", F.lit(1))["arm"])).alias("decision"))
