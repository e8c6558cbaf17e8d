"""Diarizer outputs: RTTM, numbered segments and JSON lists, checked line by line."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _sound(start, end, speaker):
    """Why a turn is refused: not finite, negative or reversed, without speaker."""
    bad = F.isnan(start) | F.isnan(end) | (F.abs(start) == float("inf")) | (F.abs(end) == float("inf"))
    return F.when(start.isNull() | end.isNull(), "not_a_number").when(bad, "not_finite").when((start < 0) | (end < start), "bad_interval").when(F.coalesce(speaker, F.lit("")) == "", "no_speaker")


def parse_rttm(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, breaches) of RTTM lines (rec_id, n, line).

    Ten fields, the first SPEAKER, one file per recording, no negative duration; blank
    lines and # comments are skipped. End is onset plus duration at 6 decimals.
    """
    x = lines.withColumn("t", F.regexp_replace("line", "(?U)^\\s+|\\s+$", "")).where("t <> '' and not startswith(t, '#')")
    x = x.withColumn("f", F.split("t", "(?U)\\s+"))
    x = x.select("rec_id", "n", F.size("f").alias("k"), F.get("f", F.lit(0)).alias("kind"), F.get("f", F.lit(1)).alias("file"), F.get("f", F.lit(3)).try_cast("double").alias("start"), F.get("f", F.lit(4)).try_cast("double").alias("dur"), F.get("f", F.lit(7)).alias("speaker"))
    x = x.withColumn("end", F.round(F.col("start") + F.col("dur"), 6))
    files = F.size(F.collect_set("file").over(Window.partitionBy("rec_id")))
    x = x.withColumn("why", F.when((F.col("k") != 10) | (F.col("kind") != "SPEAKER"), "fields").when(F.col("dur") < 0, "negative_duration").otherwise(_sound(F.col("start"), F.col("end"), F.col("speaker"))))
    x = x.withColumn("why", F.coalesce("why", F.when(files > 1, "several_files")))
    return _split(x)


def parse_segments(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, breaches) of lines "START END speaker_N" with three decimals."""
    p = "^(\\d+\\.\\d{3}) (\\d+\\.\\d{3}) (speaker_\\d+)$"
    x = lines.withColumn("t", F.trim("line")).where("t <> ''")
    x = x.select("rec_id", "n", F.regexp_extract("t", p, 1).try_cast("double").alias("start"), F.regexp_extract("t", p, 2).try_cast("double").alias("end"), F.regexp_extract("t", p, 3).alias("speaker"), F.col("t").rlike(p).alias("ok"))
    x = x.withColumn("why", F.when(~F.col("ok"), "form").otherwise(_sound(F.col("start"), F.col("end"), F.col("speaker"))))
    return _split(x)


def parse_turns_json(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, breaches) of JSON lists of exactly {start, end, speaker}, texts: (rec_id, text)."""
    items = F.from_json("text", "array<map<string,string>>")
    x = texts.select("rec_id", items.alias("items"))
    broken = x.where("items is null").select("rec_id", F.lit(None).cast("long").alias("n"), F.lit("not_a_list").alias("why"))
    x = x.select("rec_id", F.posexplode("items").alias("n", "m"))
    keys = F.sort_array(F.map_keys("m"))
    x = x.select("rec_id", F.col("n").cast("long").alias("n"), keys.alias("keys"), F.col("m")["start"].try_cast("double").alias("start"), F.col("m")["end"].try_cast("double").alias("end"), F.col("m")["speaker"].alias("speaker"))
    x = x.withColumn("why", F.when(F.col("keys").isNull() | (F.array_join("keys", ",") != "end,speaker,start"), "keys").otherwise(_sound(F.col("start"), F.col("end"), F.col("speaker"))))
    turns, bad = _split(x)
    return turns, bad.unionByName(broken)


def _split(x: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = x.where("why is null").select("rec_id", F.col("start").alias("start_s"), F.col("end").alias("end_s"), "speaker")
    good = good.withColumn("turn_ord", F.row_number().over(Window.partitionBy("rec_id").orderBy("start_s", "end_s", "speaker")) - 1)
    return good, x.where("why is not null").select("rec_id", F.col("n").cast("long").alias("n"), "why")


#: Parsers by name of the format; another is added by a further entry.
FORMATS = {"rttm": parse_rttm, "segments": parse_segments, "turns-json": parse_turns_json}


def convert(lines: DataFrame, form: str) -> tuple[DataFrame, DataFrame]:
    if form not in FORMATS:
        raise ValueError(f"unknown format {form!r}; known: {', '.join(FORMATS)}")
    return FORMATS[form](lines)


def swapped(turns: DataFrame, arms: DataFrame) -> DataFrame:
    """Turns of other diarizers under keys of their own (rec_id/arm), beside the recording's: the words are shared, no record is rewritten."""
    own = turns.select("rec_id", F.lit("stored").alias("arm"), "turn_ord", "start_s", "end_s", "speaker")
    return reduce(DataFrame.unionByName, [own, arms.select("rec_id", "arm", "turn_ord", "start_s", "end_s", "speaker")])


def speaker_map(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(map, breaches) of "KEY: Name" lines (rec_id, n, line): comments cut, quotes stripped, the later line wins."""
    x = lines.withColumn("t", F.trim(F.regexp_replace("line", "#.*$", ""))).where("t <> ''")
    x = x.select("rec_id", "n", "t", F.trim(F.regexp_extract("t", "^([^:]*):", 1)).alias("speaker"), F.regexp_replace(F.trim(F.regexp_extract("t", "^[^:]*:(.*)$", 1)), "^[\"']+|[\"']+$", "").alias("display_name"))
    x = x.withColumn("why", F.when(~F.contains("t", F.lit(":")), "no_colon").when((F.col("speaker") == "") | (F.col("display_name") == ""), "empty"))
    good = x.where("why is null").groupBy("rec_id", "speaker").agg(F.max_by("display_name", "n").alias("display_name"))
    return good, x.where("why is not null").select("rec_id", "n", "why")


def label_spec(spec: str) -> dict[str, str]:
    """LABEL=WHO,LABEL=WHO; WHO is L, S or S2 to S9. Refuses conflicts and empty maps."""
    import re

    out: dict[str, str] = {}
    for part in filter(None, map(str.strip, spec.split(","))):
        label, eq, who = (p.strip() for p in part.partition("="))
        if not eq or not label or not re.fullmatch(r"L|S[2-9]?", who.upper()):
            raise ValueError(f"{part!r}: expected LABEL=WHO with WHO L, S or S2 to S9")
        if out.setdefault(label, who.upper()) != who.upper():
            raise ValueError(f"{label} is mapped twice")
    if not out:
        raise ValueError("the map is empty")
    return out


def chosen_map(stems: DataFrame, sidecars: DataFrame, given: DataFrame | None = None, use: bool = True) -> DataFrame:
    """(rec_id, speaker, display_name): a map given for the recording wins over the sidecar of its stem; none where maps are turned off.

    stems: (rec_id, stem); sidecars: (stem, speaker, display_name); given: (rec_id, speaker, display_name).
    """
    cols = ["rec_id", "speaker", "display_name"]
    found = stems.join(sidecars, "stem").select(*cols)
    if given is not None:
        found = found.join(given.select("rec_id").distinct(), "rec_id", "left_anti").unionByName(given.select(*cols))
    return found if use else found.where(F.lit(False))
