"""Transcripts as text and HTML over the shared stream; hashes and stamps that tell renders apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamloom.functions import tokens as tk
from streamloom.functions.times import tenths
from streamloom.operators.shared import mixed
from streamloom.operators.timeline import wrapped


def _joined(df: DataFrame, keys: list[str], order: str, piece: Column, sep: str, name: str) -> DataFrame:
    parts = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), piece.alias("p"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda x: x["p"]), sep).alias(name))


def content_hash(st: DataFrame) -> DataFrame:
    """(rec_id, hash): first 12 hex digits of the SHA-256 of a stream's words joined by spaces."""
    return _joined(st, ["rec_id"], "pos", F.col("text"), " ", "t").select("rec_id", F.substring(F.sha2("t", 256), 1, 12).alias("hash"))


def plain(st: DataFrame) -> DataFrame:
    """(rec_id, turn, text): the words of each turn."""
    return _joined(st, ["rec_id", "stretch"], "pos", F.col("text"), " ", "text").withColumnRenamed("stretch", "turn")


def html_word() -> Column:
    """A word escaped, in spans of its classes: marker or partial, inside the abandoned half of a repair, inside a candidate with its mark.

    Repetitions are not marked: the text shows them.
    """
    has = lambda f: F.array_contains("flags", f)
    span = lambda cls, inner: F.concat(F.lit(f'<span class="{cls}">'), inner, F.lit("</span>"))
    safe = tk.html_escaped(F.col("text"))
    word = F.when(tk.is_marker(F.col("text")) | has("filled_pause") | has("vocalization"), span("marker", safe)).when(has("partial_word"), span("partial", safe)).otherwise(safe)
    word = F.when(has("repair"), span("reparandum", word)).otherwise(word)
    return F.when(has("proper_noun_candidate"), F.concat(span("candidate", word), F.lit('<sup class="cand-mark">[NAME?]</sup>'))).otherwise(word)


def html_words(st: DataFrame) -> DataFrame:
    """(rec_id, i, html) of each word."""
    return st.select("rec_id", "i", html_word().alias("html"))


def named_word() -> Column:
    """A word of a text transcript; candidates are followed by [NAME?]."""
    return F.concat(F.col("text"), F.when(F.array_contains("flags", "proper_noun_candidate"), " [NAME?]").otherwise(""))


def text_lines(st: DataFrame, marks: DataFrame | None = None, numbered: bool = True, width: int = 88, offset: float = 0.0) -> DataFrame:
    """(rec_id, turn, line, text): a head line for each turn, then its sentences numbered, or its words as one paragraph.

    marks: (rec_id, turn, i) words before which a time stands; candidates are followed by [NAME?].
    """
    x = st
    if marks is not None:
        x = x.join(marks.select("rec_id", "i", F.lit(True).alias("mark")), ["rec_id", "i"], "left")
    else:
        x = x.withColumn("mark", F.lit(None).cast("boolean"))
    time = lambda c: F.concat(F.lit("["), tenths(F.coalesce(c, F.lit(0.0)) + offset), F.lit("]"))
    piece = F.concat(F.when(F.col("mark"), F.concat(time(F.col("start_s")), F.lit(" "))).otherwise(""), named_word())
    head = st.groupBy("rec_id", F.col("stretch").alias("turn")).agg(F.min_by("start_s", "pos").alias("t"), F.min_by("speaker", "pos").alias("who"))
    head = head.select("rec_id", "turn", F.lit(-1).cast("long").alias("line"), F.concat(time(F.col("t")), F.lit(" "), F.coalesce("who", F.lit("UNKNOWN"))).alias("text"))
    unit = F.col("sent") if numbered else F.col("stretch")
    body = _joined(x.withColumn("line", unit.cast("long")), ["rec_id", "stretch", "line"], "pos", piece, " ", "text")
    label = F.concat(F.lpad((F.col("line") + 1).cast("string"), 3, " "), F.lit("  ")) if numbered else F.lit("    ")
    body = body.select("rec_id", F.col("stretch").alias("turn"), "line", F.concat(label, F.ltrim(wrapped(F.col("text"), width - 6, "      "))).alias("text"))
    return mixed([body, head], "rec_id")


def transcripts(lines: DataFrame) -> DataFrame:
    """(rec_id, text): a recording's lines in order, ready for write.text."""
    parts = F.sort_array(F.collect_list(F.struct("turn", "line", "text")))
    return lines.groupBy("rec_id").agg(F.array_join(F.transform(parts, lambda x: x["text"]), "\n").alias("text"))


#: Keys of a stamp in the order in which its header lists them.
STAMP_LINES = ("source", "audio", "model", "revision", "stream", "diarizer", "pause_s", "anchor_s", "smoothing", "words_reassigned", "turns", "sentences", "boundaries", "hash", "version")


def stamped(recordings: DataFrame, stats: DataFrame, hashes: DataFrame, settings: dict[str, str], version: str = "1") -> DataFrame:
    """(rec_id, stamp): what produced a render, an ordered map: source, model and structure, the settings of the render, the words' hash.

    recordings: (rec_id, audio_path, audio_sha256, model_id, diar_model); stats: (rec_id, turns, sentences,
    boundaries, words_reassigned); hashes: content_hash(); settings: pause_s, anchor_s, smoothing, stream. Facts
    that are not known are left out.
    """
    known = {"source": F.col("audio_path"), "audio": F.substring("audio_sha256", 1, 12), "model": F.col("model_id"), "diarizer": F.col("diar_model"), "version": F.lit(version)}
    known |= {k: F.col(k).cast("string") for k in ("turns", "sentences", "boundaries", "words_reassigned", "hash")} | {k: F.lit(v) for k, v in settings.items()}
    unknown = set(settings) - set(STAMP_LINES)
    if unknown:
        raise ValueError(f"stamped: unknown settings {sorted(unknown)}")
    entries = F.array(*[F.struct(F.lit(k).alias("key"), known[k].alias("value")) for k in STAMP_LINES if k in known])
    x = recordings.join(stats, "rec_id").join(hashes, "rec_id")
    return x.select("rec_id", F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())).alias("stamp"))


def header_lines(stamp: Column) -> Column:
    """The stamp as the lines a text render begins with, "key: value"."""
    return F.array_join(F.transform(F.map_entries(stamp), lambda e: F.concat(F.lit("# "), e["key"], F.lit(": "), e["value"])), "\n")


def html_documents(st: DataFrame, stamps: DataFrame, marks: DataFrame | None = None, style: str = "", offset: float = 0.0) -> DataFrame:
    """(rec_id, html): one page per recording: its stamp, then a section per turn with its numbered sentences.

    st: the stream; stamps: stamped(); marks: (rec_id, i) words before which a time stands; style: the text of a
    style sheet. Each sentence carries its start in data-t. Words are put together by sentence, then by turn.
    """
    time = lambda c: tenths(F.coalesce(c, F.lit(0.0)) + offset)
    x = st if marks is None else st.join(marks.select("rec_id", "i", F.lit(True).alias("__sl_mark")), ["rec_id", "i"], "left")
    mark = F.lit("") if marks is None else F.when(F.col("__sl_mark"), F.concat(F.lit('<time class="anchor">'), time(F.col("start_s")), F.lit("</time> "))).otherwise("")
    one = F.sort_array(F.collect_list(F.struct("pos", F.concat(mark, html_word()).alias("h"))))
    s = x.groupBy("rec_id", "stretch", "sent").agg(F.array_join(F.transform(one, lambda w: w["h"]), " ").alias("h"), F.min_by("start_s", "pos").alias("t"), F.min_by("speaker", "pos").alias("who"))
    line = F.concat(F.lit('<li value="'), (F.col("sent") + 1).cast("string"), F.lit('" data-t="'), time(F.col("t")), F.lit('">'), "h", F.lit("</li>"))
    t = s.groupBy("rec_id", "stretch").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("sent", line.alias("l")))), lambda w: w["l"]), "\n").alias("lines"), F.min_by("t", "sent").alias("t"), F.min_by("who", "sent").alias("who"))
    head = F.concat(F.lit('<h2><time>'), time(F.col("t")), F.lit("</time> "), tk.html_escaped(F.coalesce("who", F.lit("UNKNOWN"))), F.lit("</h2>"))
    section = F.concat(F.lit('<section class="turn">\n'), head, F.lit("\n<ol>\n"), "lines", F.lit("\n</ol>\n</section>"))
    body = t.groupBy("rec_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("stretch", section.alias("s")))), lambda w: w["s"]), "\n").alias("body"))
    facts = F.array_join(F.transform(F.map_entries("stamp"), lambda e: F.concat(F.lit("<dt>"), e["key"], F.lit("</dt><dd>"), tk.html_escaped(e["value"]), F.lit("</dd>"))), "\n")
    page = F.concat(
        F.lit('<!doctype html>\n<html lang="en">\n<head>\n<meta charset="utf-8">\n<title>'), tk.html_escaped(F.coalesce(F.element_at("stamp", "source"), "rec_id")), F.lit("</title>\n<style>" + style + "</style>\n</head>\n<body>\n<header>\n<dl>\n"),
        facts, F.lit("\n</dl>\n</header>\n"), "body", F.lit("\n</body>\n</html>\n"),
    )
    return body.join(stamps, "rec_id").select("rec_id", page.alias("html"))


def write_documents(documents: DataFrame, path: str, text: str) -> None:
    """Documents (rec_id, text) as text files in a folder for each recording; refuses a path that is there."""
    documents.select("rec_id", F.col(text).alias("value")).write.partitionBy("rec_id").mode("errorifexists").text(path)
