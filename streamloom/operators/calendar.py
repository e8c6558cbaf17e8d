"""Recordings in a teaching calendar: semester, week, course, and the names their files get."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamloom.functions.times import clock_seconds, hour_minute, week_number, weekday


def with_semester(df: DataFrame, semesters: DataFrame, day: str = "day") -> DataFrame:
    """Adds term, term_start and week of the first semester (by start) that holds the day, both ends included; else null."""
    s = semesters.select(F.col("term"), F.col("start").alias("s0"), F.col("end").alias("s1"))  # a row per semester
    held = df.select(day).distinct().join(F.broadcast(s), (F.col(day) >= F.col("s0")) & (F.col(day) <= F.col("s1")))
    first = held.groupBy(day).agg(F.min(F.struct("s0", "term")).alias("x")).select(day, F.col("x.term").alias("term"), F.col("x.s0").alias("term_start"))
    return df.join(first, day, "left").withColumn("week", week_number(F.col(day), F.col("term_start")))


def with_course(df: DataFrame, courses: DataFrame, key: str) -> DataFrame:
    """Adds course and why: the course of the day, by the recording's span where several meet.

    df: (key, term, day, span_start, span_end in seconds of the day); courses: (term,
    course_code, weekdays, t0, t1), one row per course and term. why is null where the
    course is told, else: no_class, untimed, no_span, no_overlap or tie.
    """
    c = courses.select("term", "course_code", F.explode("weekdays").alias("wd"), clock_seconds(F.col("t0")).alias("c0"), clock_seconds(F.col("t1")).alias("c1")).distinct()
    x = df.withColumn("wd", weekday(F.col("day")))
    j = x.select(key, "term", "wd", "span_start", "span_end").join(c, ["term", "wd"])
    over = F.least("span_end", "c1") - F.greatest("span_start", "c0")
    k = Window.partitionBy(key)
    j = j.withColumn("n", F.count(F.lit(1)).over(k)).withColumn("untimed", F.max((F.col("c0").isNull() | F.col("c1").isNull()).cast("int")).over(k)).withColumn("over", over)
    j = j.withColumn("best", F.max("over").over(k))
    g = j.groupBy(key).agg(F.max("n").alias("n"), F.max("untimed").alias("untimed"), F.max("best").alias("best"), F.count_if(F.col("over") == F.col("best")).alias("winners"), F.min("course_code").alias("only"), F.min(F.when(F.col("over") == F.col("best"), F.col("course_code"))).alias("winner"))
    x = x.join(g, key, "left")
    why = (
        F.when(F.col("n").isNull(), "no_class").when(F.col("n") == 1, F.lit(None)).when(F.col("untimed") == 1, "untimed")
        .when(F.col("span_start").isNull(), "no_span").when(F.col("best") <= 0, "no_overlap").when(F.col("winners") > 1, "tie")
    )
    x = x.withColumn("why", why)
    return x.withColumn("course", F.when(F.col("why").isNull(), F.when(F.col("n") == 1, F.col("only")).otherwise(F.col("winner")))).drop("wd", "n", "untimed", "best", "winners", "only", "winner")


def recorder_name(name: Column) -> Column:
    """struct(day, seq, ext) of YYMMDD_n.ext; null for other names and impossible dates."""
    p = "^(\\d{6})_(\\d+)\\.([A-Za-z0-9]+)$"
    day = F.try_to_date(F.concat(F.lit("20"), F.regexp_extract(name, p, 1)), "yyyyMMdd")
    return F.when(day.isNotNull(), F.struct(day.alias("day"), F.regexp_extract(name, p, 2).cast("int").alias("seq"), F.regexp_extract(name, p, 3).alias("ext")))


def target_name(prefix: str, course: Column, term: Column, week: Column, day: Column, ext: Column, nth: Column) -> Column:
    tail = F.concat(F.when(nth.isNotNull(), F.concat(F.lit("-"), nth.cast("string"))).otherwise(""), F.lit("-"), day.cast("string"), F.lit("."), F.lower(ext))
    return F.concat(F.lit(prefix), course, F.lit("-"), term, F.lit("-WK"), week.cast("string"), F.lit("-"), weekday(day), tail)


def rename_plan(files: DataFrame, semesters: DataFrame, courses: DataFrame, prefix: str) -> DataFrame:
    """(name, target, why): new names of recorder files, or why there is none.

    files: (name, span_start, span_end). Same-day files are numbered in recorder order
    where there are several; a target that exists, or that an earlier name claims, is refused.
    """
    f = files.select("*", recorder_name(F.col("name")).alias("r"))
    bad = f.where("r is null").select("name", F.lit(None).cast("string").alias("target"), F.lit("no_recorder_name").alias("why"))
    x = f.where("r is not null").select("name", "span_start", "span_end", "r.day", "r.seq", "r.ext")
    d = Window.partitionBy("day")
    x = x.withColumn("nth", F.when(F.count(F.lit(1)).over(d) > 1, F.row_number().over(d.orderBy("seq", "name"))))
    x = with_course(with_semester(x, semesters), courses, "name")
    x = x.withColumn("why", F.when(F.col("term").isNull(), "no_semester").otherwise(F.col("why")))
    x = x.withColumn("target", F.when(F.col("why").isNull(), target_name(prefix, F.col("course"), F.col("term"), F.col("week"), F.col("day"), F.col("ext"), F.col("nth"))))
    x = x.where("target is null or target <> name")
    x = x.join(files.select(F.col("name").alias("target"), F.lit(True).alias("there")).distinct(), "target", "left")
    x = x.withColumn("why", F.when(F.col("there"), "exists").otherwise(F.col("why")))
    claim = F.row_number().over(Window.partitionBy("target", F.col("why").isNull()).orderBy("name"))
    x = x.withColumn("why", F.when(F.col("why").isNull() & (claim > 1), "claimed").otherwise(F.col("why")))
    return bad.unionByName(x.select("name", F.when(F.col("why").isNull(), F.col("target")).alias("target"), "why"))


def span_text(start: Column, end: Column) -> Column:
    return F.concat(hour_minute(start), F.lit("-"), hour_minute(end))
