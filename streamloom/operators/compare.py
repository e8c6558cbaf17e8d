"""Two results held against each other: values by path, streams by boundary, windows by distance, files by hash."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamloom.operators.scan import KEY, packed
from streamloom.operators.shared import mixed


def differences(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, path, left, right) of every value that differs; nested values are compared as JSON, a missing row as null.

    Null equals null. Rows of a key that stand more than once are compared in every pairing.
    """
    cols = [c for c in a.columns if c not in keys and c in b.columns]
    flat = lambda df, side: df.select(packed(keys), F.explode(F.create_map(*[x for c in cols for x in (F.lit(c), F.to_json(F.struct(F.col(c).alias("v"))))])).alias("path", side))
    x = flat(a, "left").join(flat(b, "right"), [KEY, "path"], "full")
    return x.where(~F.col("left").eqNullSafe(F.col("right"))).select(*[F.col(f"{KEY}.k{n}").alias(k) for n, k in enumerate(keys)], "path", "left", "right")


def same_stream(labelled: DataFrame, rendered: DataFrame) -> DataFrame:
    """Boundaries only one side has, or whose labels differ: (rec_id, pos, side). Both: (rec_id, pos, frm, to). Empty: the streams agree."""
    cols = ["rec_id", "pos", "frm", "to"]
    l, r = labelled.select(*cols), rendered.select(*cols)
    return l.exceptAll(r).select("rec_id", "pos", F.lit("labelled").alias("side")).unionByName(r.exceptAll(l).select("rec_id", "pos", F.lit("rendered").alias("side")))


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def match_breaches(labelled: DataFrame, proposed: DataFrame) -> DataFrame:
    """(rec_id, why) where windows were proposed for other material than was labelled, or do not carry their own parameters' hash.

    labelled: (rec_id, source_sha256, render, stream, boundaries); proposed: the same and params, params_sha256.
    boundaries: word indices in order; params: canonical JSON. Nulls equal each other.
    """
    facts = ["source_sha256", "render", "stream", "boundaries"]
    p = proposed.select("rec_id", *[F.col(c).alias(f"p_{c}") for c in facts], "params", "params_sha256")
    x = labelled.select("rec_id", *facts).join(p, "rec_id")
    whys = [F.when(~F.col(c).eqNullSafe(F.col(f"p_{c}")), f"other_{c}") for c in facts]
    whys.append(F.when(~F.col("params_sha256").eqNullSafe(F.sha2("params", 256)), "other_params"))
    return x.select("rec_id", F.explode(F.filter(F.array(*whys), lambda w: w.isNotNull())).alias("why"))


def nearest_windows(surfaced: DataFrame, found: DataFrame) -> DataFrame:
    """For each error that no window holds, the nearest window: (rec_id, kind, t, distance in transitions, class); first in (a, b) order on ties.

    surfaced: errors with the classes that hold them. Of windows that end at one word, and of those that start
    at one, the first stands; errors and these ends are read in one order, once from each side.
    """
    e = surfaced.where(F.size("classes") == 0).select("rec_id", "kind", "t", F.col("t").alias("x"))
    best = lambda key: found.groupBy("rec_id", key).agg(F.min(F.struct("a", "b", "class")).alias("w"))
    is_error = F.col("t").isNotNull()
    ends = best("b").select("rec_id", F.col("b").alias("x"), F.col("w").alias("end"))
    begins = best("a").select("rec_id", F.col("a").alias("x"), F.col("w").alias("begin"))
    w = f"struct<{ends.schema['end'].dataType.simpleString()[7:-1]}>"
    none = lambda df, **kinds: df.select("*", *[F.lit(None).cast(k).alias(c) for c, k in kinds.items()])
    own = {"kind": "string", "t": e.schema["t"].dataType.simpleString()}
    x = mixed([none(e, end=w, begin=w), none(ends, **own, begin=w), none(begins, **own, end=w)], "rec_id")
    upto = lambda order: Window.partitionBy("rec_id").orderBy(order, is_error).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("before", F.last("end", ignorenulls=True).over(upto(F.col("x").asc()))).withColumn("after", F.last("begin", ignorenulls=True).over(upto(F.col("x").desc()))).where(is_error)
    one = lambda w, d: F.when(w.isNotNull(), F.struct(d.alias("d"), w["a"].alias("a"), w["b"].alias("b"), w["class"].alias("class")))
    near = F.array_min(F.filter(F.array(one(F.col("before"), F.col("t") - F.col("before.b")), one(F.col("after"), F.col("after.a") + 1 - F.col("t"))), lambda w: w.isNotNull()))
    return x.select("rec_id", "kind", "t", near["d"].alias("distance"), near["class"].alias("class"))


def union_size(windows: DataFrame, keys: list[str]) -> DataFrame:
    """Words that windows [a, b] of a key cover together, both ends included: (keys, covered)."""
    w = Window.partitionBy(*keys).orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.coalesce(F.max("b").over(w), F.col("a") - 1)
    x = windows.select(*keys, "a", "b", seen.alias("seen"))
    return x.groupBy(*keys).agg(F.sum(F.greatest(F.lit(0), F.col("b") - F.greatest(F.col("a") - 1, F.col("seen")))).alias("covered"))


def returns(harmful: DataFrame, found: DataFrame, size: DataFrame) -> DataFrame:
    """Harmful misses and the transition back out of them: (rec_id, t, back, surfaced, back_surfaced). back is null at the stream's end.

    harmful: (rec_id, t, misattributed); size: (rec_id, n). Transitions meet only the windows of their own stretch of positions.
    """
    from streamloom.operators.evaluate import REACH, _spread

    x = harmful.select("rec_id", "t", (F.col("t") + F.col("misattributed")).alias("r")).join(size, "rec_id")
    x = x.select("rec_id", "t", F.when(F.col("r") < F.col("n"), F.col("r")).alias("back"))
    both = x.select("rec_id", F.explode(F.array("t", "back")).alias("p")).where("p is not null").distinct().withColumn("bucket", F.floor(F.col("p") / REACH))
    c = _spread(found).select(F.col("rec_id").alias("r"), F.col("bucket").alias("k"), "a", "b")
    held = both.join(c, (F.col("rec_id") == F.col("r")) & (F.col("bucket") == F.col("k")) & (F.col("a") < F.col("p")) & (F.col("p") <= F.col("b")), "left_semi").select("rec_id", "p")
    for c, name in (("t", "surfaced"), ("back", "back_surfaced")):
        x = x.join(held.select("rec_id", F.col("p").alias(c), F.lit(True).alias(name)), ["rec_id", c], "left")
    return x.select("rec_id", "t", "back", *[F.coalesce(n, F.lit(False)).alias(n) for n in ("surfaced", "back_surfaced")])


def bar(value: Column, limit: float, least: bool = False) -> Column:
    """Whether a figure meets its limit; a missing figure doesn't."""
    return F.coalesce((value >= limit) if least else (value <= limit), F.lit(False))


def unanchored(spurious: DataFrame, anchors: DataFrame, near: int, size: DataFrame) -> DataFrame:
    """Spurious boundaries without an anchor within `near` words, with the words until the next boundary: (rec_id, pos, until_next)."""
    nxt = F.lead("pos").over(Window.partitionBy("rec_id").orderBy("pos"))
    x = spurious.withColumn("nxt", nxt).join(size, "rec_id")
    q = anchors.select(F.col("rec_id").alias("r"), F.col("pos").alias("q"))
    x = x.join(q, (x["rec_id"] == q["r"]) & (q["q"] >= x["pos"] - near) & (q["q"] <= x["pos"] + near), "left_anti").where("verdict = 'spurious'")
    return x.select("rec_id", "pos", (F.coalesce("nxt", "n") - F.col("pos")).alias("until_next"))


def pessimistic(names: DataFrame) -> DataFrame:
    """A one-to-one map whose folded labels are all the instructor's."""
    return names.withColumn("who", F.when(F.col("paired"), F.col("who")).otherwise("L"))


def provenance_breaches(arms: DataFrame, audio: DataFrame, files: DataFrame) -> DataFrame:
    """(arm, run, why) of arms made from other audio, or whose output is missing or changed.

    arms: (arm, run, rec_id, audio_sha256, native_path, native_sha256, native_format); audio: (rec_id, audio_sha256); files: (path, sha256).
    """
    from streamloom.sources.intervals import FORMATS

    x = arms.alias("x").join(audio.select("rec_id", F.col("audio_sha256").alias("own")), "rec_id", "left").join(files.select(F.col("path").alias("native_path"), F.col("sha256").alias("there")), "native_path", "left")
    why = F.when(~F.col("audio_sha256").eqNullSafe(F.col("own")), "other_audio").when(F.col("there").isNull(), "no_output").when(F.col("there") != F.col("native_sha256"), "changed_output").when(~F.col("native_format").isin(*FORMATS), "unknown_format")
    return x.select("arm", "run", why.alias("why")).where("why is not null")
