"""Queries of the training-data problems, with SQL twins where SQL can tell the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streamloom.llm import twins
from streamloom.llm.content_scores import found_kinds, rates, score_content
from streamloom.llm.leaked_tests import leaked_tests
from streamloom.llm.nearest_time import nearest_in_time
from streamloom.llm.personal_data import in_texts, in_words, redacted_words
from streamloom.llm.source_mixing import mix_sources
from streamloom.llm.transcript_turns import speaker_turns
from streamloom.operators.intervals import millis
from streamloom.plans.tables import load, timed_words


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean speaker turns of every recording that has any speaker label."""
    return speaker_turns(load(spark, sf_dir, "words"), load(spark, sf_dir, "speaker_map"))


def p1_turn_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean turns with their spoken words."""
    return speaker_turns(load(spark, sf_dir, "words"), load(spark, sf_dir, "speaker_map"), with_text=True)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each edge of a valid speaker turn the nearest word edge of the recording within 400 ms."""
    turns = load(spark, sf_dir, "speaker_turns").select("rec_id", "turn_ord", millis(F.col("start_s")).alias("s"), millis(F.col("end_s")).alias("e"))
    turns = turns.where(F.col("e") > F.col("s")).dropDuplicates(["rec_id", "turn_ord", "s", "e"])
    edges = lambda s, e: F.explode(F.array(F.struct(F.lit("start").alias("edge"), F.col(s).alias("t")), F.struct(F.lit("end").alias("edge"), F.col(e).alias("t"))))
    left = turns.select("rec_id", "turn_ord", edges("s", "e").alias("x")).select("rec_id", "turn_ord", "x.edge", F.col("x.t").alias("edge_ms"))
    right = timed_words(spark, sf_dir).select("rec_id", "i", edges("start_ms", "end_ms").alias("x")).select("rec_id", "i", "x.edge", F.col("x.t").alias("word_ms"))
    out = nearest_in_time(left, right, ["rec_id", "edge"], "edge_ms", "word_ms", "i", 400, "nearest_i", "nearest_ms")
    return out.select("rec_id", "turn_ord", "edge", F.col("nearest_i").cast("int").alias("i"))


P3_FOUND_SQL = """
with w as (
  select distinct rec_id, i, cast(round(start_s * 1000) as bigint) as s, cast(round(end_s * 1000) as bigint) as e
  from words where start_s is not null and end_s is not null and text <> '_'
), tw as (select * from w where e >= s),
t as (select distinct rec_id, turn_ord, cast(round(start_s * 1000) as bigint) as s, cast(round(end_s * 1000) as bigint) as e
  from speaker_turns where start_s is not null and end_s is not null),
p as (select rec_id, turn_ord, 'start' as edge, s as x from t where e > s union all select rec_id, turn_ord, 'end', e from t where e > s),
q as (select rec_id, i, 'start' as edge, s as y from tw union all select rec_id, i, 'end', e from tw),
m as (select p.rec_id, p.turn_ord, p.edge, q.i, row_number() over (partition by p.rec_id, p.turn_ord, p.edge order by abs(p.x - q.y), q.i) as rn
  from p join q on q.rec_id = p.rec_id and q.edge = p.edge and abs(p.x - q.y) <= 400)
select rec_id, turn_ord, edge, i from m where rn = 1
"""



def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in the words of each recording and in its text."""
    words = in_words(load(spark, sf_dir, "words")).withColumn("place", F.lit("word"))
    texts = load(spark, sf_dir, "recordings").where(F.col("rec_id").isNotNull()).select("rec_id", "text").dropDuplicates()
    records = in_texts(texts).distinct().withColumn("place", F.lit("record"))
    out = words.unionByName(records)
    return out.select("rec_id", "place", "kind", F.col("first_pos").cast("int"), F.col("last_pos").cast("int"))


def p4_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of each recording with typed placeholders for personal data."""
    texts = load(spark, sf_dir, "recordings").select("rec_id", "text").dropDuplicates()
    return in_texts(texts, redact=True)


def p4_redacted_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of each recording with typed placeholders for personal data."""
    return redacted_words(load(spark, sf_dir, "words").select("rec_id", "i", "text").distinct())


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with 12 or more successive words of a held-out passage."""
    return leaked_tests(load(spark, sf_dir, "documents"), load(spark, sf_dir, "eval_passages")).select("doc_id", "item_id")


def p6_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pairs with tiles and the share of the passage they cover; `whole` from half of it on."""
    pairs = leaked_tests(load(spark, sf_dir, "documents"), load(spark, sf_dir, "eval_passages"))
    return pairs.withColumn("share", F.round(F.col("covered") / F.col("item_words"), 4)).withColumn("whole", F.col("share") >= 0.5)


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed corpus: a row for each time a document is taken."""
    return mix_sources(load(spark, sf_dir, "documents"), load(spark, sf_dir, "mix_targets"))[0]


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets, repeats and the actual shares of the mix."""
    return mix_sources(load(spark, sf_dir, "documents"), load(spark, sf_dir, "mix_targets"))[1]


def p7_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual shares where weights are powers of the sources' own shares, as flat as the caps allow."""
    return mix_sources(load(spark, sf_dir, "documents"), load(spark, sf_dir, "mix_targets"), temperature=True)[1]


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with abusive, hateful or sexual content, a row for each kind."""
    return found_kinds(score_content(load(spark, sf_dir, "documents"))).select("doc_id", "kind")


def p8_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three scores of every document."""
    return score_content(load(spark, sf_dir, "documents"))


def p8_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of each kind per source."""
    return rates(score_content(load(spark, sf_dir, "documents"), keep=["source"]))


QUERIES = {"p1_found": p1_found, "p1_turn_texts": p1_turn_texts, "p3_found": p3_found, "p4_found": p4_found, "p4_redacted": p4_redacted, "p4_redacted_words": p4_redacted_words, "p6_found": p6_found, "p6_coverage": p6_coverage, "p7_mix": p7_mix, "p7_shares": p7_shares, "p7_temperature": p7_temperature, "p8_found": p8_found, "p8_scores": p8_scores, "p8_rates": p8_rates}
SQL = {"p1_found": twins.P1_FOUND, "p3_found": P3_FOUND_SQL, "p6_found": twins.P6_FOUND}
