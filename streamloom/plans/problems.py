"""Queries of the general data problems: periods and gaps, sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamloom.operators.intervals import millis, periods_and_gaps
from streamloom.operators.sessions import SessionTable
from streamloom.plans.tables import load, timed_words


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Covered periods and gaps of the turns and of the error ranges of each recording."""
    parts = []
    for kind, table in (("turn", "speaker_turns"), ("error", "error_ranges")):
        t = load(spark, sf_dir, table)
        parts.append(t.select("rec_id", F.lit(kind).alias("kind"), millis(F.col("start_s")).alias("start_ms"), millis(F.col("end_s")).alias("end_ms")))
    out = periods_and_gaps(parts[0].unionByName(parts[1]), ["rec_id", "kind"], "start_ms", "end_ms")
    return out.select("rec_id", "kind", "piece", "start_ms", "end_ms")


P2_FOUND_SQL = """
with iv as (
  select 'turn' as kind, rec_id, cast(round(start_s * 1000) as bigint) as s, cast(round(end_s * 1000) as bigint) as e from speaker_turns
  union all
  select 'error', rec_id, cast(round(start_s * 1000) as bigint), cast(round(end_s * 1000) as bigint) from error_ranges
), v as (select * from iv where s is not null and e is not null and e > s),
m as (select *, max(e) over (partition by rec_id, kind order by s, e rows between unbounded preceding and 1 preceding) as pm from v),
g as (select *, sum(case when pm is null or s > pm then 1 else 0 end) over (partition by rec_id, kind order by s, e rows unbounded preceding) as isl from m),
p as (select rec_id, kind, isl, min(s) as s, max(e) as e from g group by all),
n as (select *, lead(s) over (partition by rec_id, kind order by s) as nx from p)
select rec_id, kind, 'period' as piece, s as start_ms, e as end_ms from n
union all
select rec_id, kind, 'gap', e, nx from n where nx is not null
"""


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speech sessions of each recording, kept in a session table over batches by arrival."""
    words = timed_words(spark, sf_dir)
    ends = load(spark, sf_dir, "sentences").where(F.col("last_i").isNotNull()).select("rec_id", F.col("last_i").alias("i")).distinct().withColumn("is_end", F.lit(1))
    words = words.groupBy("rec_id", "i").agg(F.min("start_ms").alias("start_ms"), F.min("end_ms").alias("end_ms"), F.min("loaded_at").alias("loaded_at"))
    events = words.join(ends, ["rec_id", "i"], "left").select(
        "rec_id", "start_ms", "end_ms", F.col("i").alias("first_i"), F.col("i").alias("last_i"),
        F.lit(1).cast("long").alias("n_words"), F.coalesce("is_end", F.lit(0)).cast("long").alias("n_sentences"), "loaded_at",
    )
    table = SessionTable.create(
        spark, keys=["rec_id"], start="start_ms", end="end_ms", gap=2000,
        measures={"first_i": "min", "last_i": "max", "n_words": "sum", "n_sentences": "sum"},
    )
    for batch in table.batches(events, "loaded_at", 3, span=load(spark, sf_dir, "words")):
        table.merge(batch)
    return table.read().select(
        "rec_id", F.col("first_i").cast("int"), F.col("last_i").cast("int"), "start_ms", "end_ms",
        F.col("n_words").cast("int"), F.col("n_sentences").cast("int"),
    )


P5_FOUND_SQL = """
with w as (
  select distinct rec_id, i, cast(round(start_s * 1000) as bigint) as s, cast(round(end_s * 1000) as bigint) as e
  from words where start_s is not null and end_s is not null and text <> '_'
), t as (select * from w where e >= s),
m as (select *, max(e) over (partition by rec_id order by s, i rows between unbounded preceding and 1 preceding) as pm from t),
g as (select *, sum(case when pm is null or s > pm + 2000 then 1 else 0 end) over (partition by rec_id order by s, i rows unbounded preceding) as ses from m),
d as (select distinct rec_id, last_i from sentences where last_i is not null)
select g.rec_id, min(i) as first_i, max(i) as last_i, min(s) as start_ms, max(e) as end_ms,
  cast(count(*) as int) as n_words, cast(count(d.last_i) as int) as n_sentences
from g left join d on d.rec_id = g.rec_id and d.last_i = g.i
group by g.rec_id, ses
"""

QUERIES = {"p2_found": p2_found, "p5_found": p5_found}
SQL = {"p2_found": P2_FOUND_SQL, "p5_found": P5_FOUND_SQL}
