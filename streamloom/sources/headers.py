"""When a recording was made, from the headers of its file: broadcast WAV chunks and MP4 boxes."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ZONE = "America/Los_Angeles"


def _ascii(raw: bytes) -> str:
    return raw.partition(b"\0")[0].decode("ascii", "replace").strip()


class _Held:
    """Bytes in memory, read by range like a file."""

    def __init__(self, data: bytes):
        self.data, self.size = data, len(data)

    def read(self, at: int, n: int) -> bytes:
        return self.data[at : at + n]


class _File:
    """A file of any file system pyarrow knows, of which only the ranges asked for are read."""

    def __init__(self, path: str):
        from pyarrow import fs

        system, name = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
        self.handle = system.open_input_file(name)
        self.size = self.handle.size()

    def read(self, at: int, n: int) -> bytes:
        return self.handle.read_at(max(0, min(n, self.size - at)), at) if at < self.size else b""


#: Bytes of a header chunk or a date that are read at most; both are defined to be shorter.
_HEAD = 1024


def wav_header(data: bytes | _File) -> dict | None:
    """The fields of a WAV's bext chunk with its rate, byte rate and data size; null without one or for other files."""
    f = _Held(data) if isinstance(data, (bytes, bytearray)) else data
    top = f.read(0, 12)
    if top[:4] != b"RIFF" or top[8:12] != b"WAVE":
        return None
    out: dict = {}
    at = 12
    while len(head := f.read(at, 8)) == 8:
        name, size = head[:4], int.from_bytes(head[4:8], "little")
        body = f.read(at + 8, min(size, _HEAD)) if name in (b"bext", b"fmt ") else b""
        if name == b"bext" and len(body) >= 346:
            out |= {"day": _ascii(body[320:330]), "time": _ascii(body[330:338]), "reference": int.from_bytes(body[338:346], "little")}
        elif name == b"fmt " and len(body) >= 16:
            out |= {"rate": int.from_bytes(body[4:8], "little"), "byte_rate": int.from_bytes(body[8:12], "little")}
        elif name == b"data":
            out["bytes"] = size
        at += 8 + size + size % 2
    return out if "day" in out else None


def mp4_date(data: bytes | _File) -> str | None:
    """The text of moov/udta/date; null for other files, without it, or where a box is broken."""
    f = _Held(data) if isinstance(data, (bytes, bytearray)) else data
    if f.read(4, 4) != b"ftyp":
        return None
    lo, hi = 0, f.size
    for want in (b"moov", b"udta", b"date"):
        found = None
        while found is None and lo + 8 <= hi:
            box = f.read(lo, 16)
            size, head = struct.unpack(">I", box[:4])[0], 8
            if size == 1 and lo + 16 <= hi:
                size, head = struct.unpack(">Q", box[8:16])[0], 16
            elif size == 0:
                size = hi - lo
            if size < head:
                return None
            if box[4:8] == want:
                found = (lo + head, min(lo + size, hi))
            lo += size
        if found is None:
            return None
        lo, hi = found
    return _ascii(f.read(lo, min(hi - lo, _HEAD)))


_FIELDS = "path string, day string, time string, reference long, rate int, byte_rate int, bytes long, mp4 string"


def headers(files: DataFrame) -> DataFrame:
    """Header fields of binary files; files of other kinds, and ones that cannot be read, have nulls.

    files: (path), of which each task reads the headers only, whatever the files' size; or (path, content) for contents at hand.
    """
    held = "content" in files.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for k, path in enumerate(f.path):
                try:
                    source = bytes(f.content.iloc[k]) if held else _File(path)
                    h, m = wav_header(source) or {}, mp4_date(source)
                except (OSError, TypeError):
                    h, m = {}, None
                rows.append((path, h.get("day"), h.get("time"), h.get("reference"), h.get("rate"), h.get("byte_rate"), h.get("bytes"), m))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _FIELDS.split(", ")])

    return files.select("path", *["content"] * held).mapInPandas(run, _FIELDS)


def file_hashes(paths: DataFrame) -> DataFrame:
    """(path, sha256) of files read in pieces of 16 MB; null where a file cannot be read."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for f in frames:
            out = []
            for path in f.path:
                try:
                    source, h, at = _File(path), hashlib.sha256(), 0
                    while piece := source.read(at, 1 << 24):
                        h.update(piece)
                        at += len(piece)
                    out.append(h.hexdigest())
                except (OSError, TypeError):
                    out.append(None)
            yield pd.DataFrame({"path": f.path.tolist(), "sha256": out})

    return paths.select("path").mapInPandas(run, "path string, sha256 string")


def recorded(h: DataFrame) -> DataFrame:
    """(path, date, start, origin, why, span_start, span_end): bext first, then the MP4 date, else why there is none.

    A bext day goes back by one where the recording began late in the evening and was
    closed after midnight (the first sample over a minute later in the day than the
    closing time). An MP4 time must carry its offset and is told in local time.
    """
    from streamloom.functions.times import clock

    d = F.regexp_extract_all("day", F.lit("\\d+"), 0)
    shaped = F.col("day").rlike("^\\d{4}\\D\\d{2}\\D\\d{2}$")
    day = F.when(shaped, F.try_to_date(F.array_join(d, "-"), "yyyy-MM-dd"))
    start = F.when((F.col("reference") > 0) & (F.col("rate") > 0), F.col("reference") / F.col("rate"))
    t = F.regexp_extract_all("time", F.lit("\\d+"), 0)
    closed = F.when(F.col("time").rlike("^\\d{2}\\D\\d{2}\\D\\d{2}$"), F.get(t, F.lit(0)).cast("int") * 3600 + F.get(t, F.lit(1)).cast("int") * 60 + F.get(t, F.lit(2)).cast("int"))
    x = h.select("*", day.alias("d0"), start.alias("s0"), closed.alias("c0"))
    back = F.coalesce(F.col("s0") - F.col("c0") > 60, F.lit(False))
    utc = F.when(F.col("mp4").rlike("(Z|[+-]\\d{2}:?\\d{2})$"), F.expr("try_cast(mp4 as timestamp)"))
    local = F.from_utc_timestamp(F.to_utc_timestamp(utc, F.current_timezone()), ZONE)
    wav, mp4 = F.col("day").isNotNull(), F.col("mp4").isNotNull()
    return x.select(
        "path",
        F.when(wav, F.when(back, F.date_sub("d0", 1)).otherwise(F.col("d0"))).when(mp4, F.to_date(local)).alias("date"),
        F.when(wav & F.col("d0").isNotNull(), clock(F.col("s0"))).when(~wav & mp4, F.date_format(local, "HH:mm:ss")).alias("start"),
        F.when(wav & F.col("d0").isNotNull(), "bext").when(~wav & mp4 & utc.isNotNull(), "mp4").alias("origin"),
        F.when(wav & F.col("d0").isNull(), "bext_day_is_no_date").when(~wav & mp4 & utc.isNull(), "mp4_date_without_offset").when(~wav & ~mp4, "no_header").alias("why"),
        F.when((F.col("rate") > 0) & (F.col("byte_rate") > 0) & F.col("bytes").isNotNull(), F.col("reference") / F.col("rate")).alias("span_start"),
        F.when((F.col("rate") > 0) & (F.col("byte_rate") > 0) & F.col("bytes").isNotNull(), F.col("reference") / F.col("rate") + F.col("bytes") / F.col("byte_rate")).alias("span_end"),
    )


def file_sha256(content: Column) -> Column:
    return F.sha2(content, 256)


_ISO = re.compile(r"^\d{4}-\d{2}-\d{2}$")


def dated(found: DataFrame, given: DataFrame | None = None) -> DataFrame:
    """recorded() with days given by hand (path, day yyyy-mm-dd) in place of a file's own; origin tells which. Days in another form are left out."""
    if given is None:
        return found
    g = given.where(F.col("day").rlike(_ISO.pattern)).select("path", F.try_to_date("day", "yyyy-MM-dd").alias("__sl_day")).where("__sl_day is not null").dropDuplicates(["path"])
    own = F.col("__sl_day").isNotNull()
    x = found.join(g, "path", "left")
    return x.withColumns({"date": F.coalesce("__sl_day", "date"), "origin": F.when(own, "given").otherwise(F.col("origin")), "why": F.when(~own, F.col("why"))}).drop("__sl_day")


def given_day(day: str) -> str:
    """A day given by hand, checked; it wins over a file's own."""
    if not _ISO.match(day):
        raise ValueError(f"{day!r} is not yyyy-mm-dd")
    return day


_TAG = re.compile(r"^[A-Za-z0-9][A-Za-z0-9._-]*$")


def valid_tag(tag: str) -> str:
    """A tag that can stand in a file name."""
    if not _TAG.match(tag):
        raise ValueError(f"{tag!r}: letters, digits, dots, dashes and underscores only")
    return tag
