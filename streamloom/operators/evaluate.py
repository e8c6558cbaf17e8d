"""Scores of a labelled stream against gold verdicts: truth, errors, misses, recall of proposed windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamloom.operators.shared import mixed
from streamloom.operators.stream import rec

INSTRUCTOR, UNKNOWN = "L", "?"
STUDENTS = ["S", *[f"S{k}" for k in range(2, 10)]]
NEAR = 3
#: Positions of a bucket in joins of windows with errors.
REACH = 64


def is_student(who: Column) -> Column:
    return F.coalesce(who.rlike("^S[2-9]?$"), F.lit(False))


def identity(label: Column) -> Column:
    """L, S, S2 to S9 by a label's number; null where it has none."""
    n = F.regexp_extract(label, "(\\d+)", 1).try_cast("int")
    return F.when(n == 0, INSTRUCTOR).when(n == 1, "S").when(n.between(2, 9), F.concat(F.lit("S"), n.cast("string")))


def gold(st: DataFrame, who: Column) -> DataFrame:
    """Verdicts at the stream's label changes, derived from a known speaker per word: rec_id, pos, bno, frm, to, verdict, who.

    Unknown on either side: unsure; changed: real, with its speaker; same: spurious.
    """
    w = rec()
    x = st.select("rec_id", "pos", "change", F.lag("speaker").over(w).alias("frm"), F.col("speaker").alias("to"), F.lag(who).over(w).alias("was"), who.alias("is")).where("change")
    verdict = F.when(F.col("was").isNull() | F.col("is").isNull(), "unsure").when(F.col("was") != F.col("is"), "real").otherwise("spurious")
    return x.select("rec_id", "pos", F.row_number().over(w).alias("bno"), "frm", "to", verdict.alias("verdict"), F.when(verdict == "real", F.col("is")).alias("who"))


def gold_markers(st: DataFrame, who: Column) -> DataFrame:
    """Speaker changes inside a label's stretch, as a reader marks them: rec_id, pos, ord, who."""
    w = rec()
    x = st.select("rec_id", "pos", "change", F.lag(who).over(w).alias("was"), who.alias("who"))
    return x.where(~F.col("change") & (F.col("was") != F.col("who"))).select("rec_id", "pos", F.lit(0).alias("ord"), "who")


def truth(st: DataFrame, labels: DataFrame, names: DataFrame | None = None, markers: DataFrame | None = None) -> DataFrame:
    """Adds truth: the speaker the labels state for each word, carried forward; null is unknown.

    labels: gold(); names: (rec_id, label, who); markers: (rec_id, pos, ord, who), which
    override a boundary at the same word, the last one standing. An unknown verdict is
    an event of its own, not an absence.
    """
    x = st.join(labels.select("rec_id", "pos", F.lit(True).alias("__sl_b"), "verdict", F.col("who").alias("__sl_who"), F.col("to").alias("__sl_to")), ["rec_id", "pos"], "left")
    if names is not None:
        n = names.select("rec_id", "label", F.col("who").alias("__sl_map"))
        x = x.join(n, (n["rec_id"] == x["rec_id"]) & (n["label"] == x["speaker"]), "left").drop(n["rec_id"]).drop("label")
    else:
        x = x.withColumn("__sl_map", F.lit(None).cast("string"))
    event = lambda c: F.struct(c.alias("who"))
    e = (
        F.when(F.col("pos") == 0, event(F.col("__sl_map")))
        .when(F.col("verdict") == "real", event(F.coalesce("__sl_who", "__sl_map")))
        .when(F.col("verdict") == "spurious", F.lit(None))
        .when(F.col("__sl_b"), event(F.lit(None).cast("string")))
    )
    if markers is not None:
        m = markers.groupBy("rec_id", "pos").agg(F.max_by("who", "ord").alias("__sl_m"))
        x = x.join(m, ["rec_id", "pos"], "left")
        e = F.when(F.col("__sl_m").isNotNull(), event(F.col("__sl_m"))).otherwise(e)
    x = x.withColumn("truth", F.last(e, ignorenulls=True).over(rec().rowsBetween(Window.unboundedPreceding, 0))["who"])
    return x.drop(*[c for c in x.columns if c.startswith("__sl_")])


def shared_words(x: DataFrame, who: str = "truth") -> DataFrame:
    """Words each label shares with each identity: rec_id, label, who, n."""
    return x.where(F.col("speaker").isNotNull() & F.col(who).isNotNull() & (F.col(who) != UNKNOWN)).groupBy("rec_id", F.col("speaker").alias("label"), F.col(who).alias("who")).agg(F.count("*").alias("n"))


def share_map(st: DataFrame, labels: DataFrame, markers: DataFrame | None = None) -> DataFrame:
    """Label to identity by shares of the stated words: (rec_id, label, who).

    A label is the instructor's if its share of the instructor's stated words is at
    least its share of the students'; else it is its most frequent student.
    """
    stated = truth(st, labels, None, markers)
    n = shared_words(stated)
    order = F.array_position(F.array(*[F.lit(s) for s in STUDENTS]), F.col("who"))
    per = n.groupBy("rec_id", "label").agg(
        F.sum(F.when(F.col("who") == INSTRUCTOR, F.col("n")).otherwise(0)).alias("nl"), F.sum(F.when(is_student(F.col("who")), F.col("n")).otherwise(0)).alias("ns"),
        F.max_by(F.when(is_student(F.col("who")), F.col("who")), F.when(is_student(F.col("who")), F.struct("n", -order))).alias("student"),
    )
    every = st.where("speaker is not null").select("rec_id", F.col("speaker").alias("label")).distinct()
    per = every.join(per, ["rec_id", "label"], "left").fillna(0, ["nl", "ns"])
    total = Window.partitionBy("rec_id")
    per = per.withColumn("tl", F.sum("nl").over(total)).withColumn("ts", F.sum("ns").over(total))
    is_l = F.when(F.col("ts") == 0, True).when(F.col("tl") == 0, F.col("ns") == 0).otherwise(F.col("nl") * F.col("ts") >= F.col("ns") * F.col("tl"))
    return per.select("rec_id", "label", F.when(is_l, INSTRUCTOR).otherwise(F.coalesce("student", F.lit("S"))).alias("who"))


def judged(x: DataFrame, names: DataFrame) -> DataFrame:
    """Adds shown, known, err, true_change (null if not to be told), prev_known, direction, run (error run) and cause.

    A run is consecutive wrong words with one true speaker and one label; its cause is
    read at its start.
    """
    n = names.select("rec_id", F.col("label").alias("speaker"), F.col("who").alias("shown"))
    x = x.join(n, ["rec_id", "speaker"], "left")
    w = rec()
    x = x.withColumn("known", F.col("truth").isNotNull() & (F.col("truth") != UNKNOWN)).withColumn("err", F.col("known") & ~F.col("truth").eqNullSafe(F.col("shown")))
    before = F.lag(F.struct("truth", "known", "err", "speaker")).over(w)
    x = x.withColumn("__sl_p", before)
    p = lambda f: F.col(f"__sl_p.{f}")
    both = p("truth").isNotNull() & F.col("truth").isNotNull() & ~((p("truth") == UNKNOWN) & (F.col("truth") == UNKNOWN))
    x = x.withColumn("true_change", F.when(both, p("truth") != F.col("truth")))
    opens = F.col("err") & ~(F.coalesce(p("err"), F.lit(False)) & p("truth").eqNullSafe(F.col("truth")) & p("speaker").eqNullSafe(F.col("speaker")))
    x = x.withColumn("run_start", opens).withColumn("run", F.when(F.col("err"), F.sum(opens.cast("int")).over(w)))
    known_before = F.coalesce(p("known"), F.lit(False))
    cause = F.when(~known_before, "after_unknown").when((p("truth") != F.col("truth")) & F.col("change"), "wrong_label").when(p("truth") != F.col("truth"), "missed_change").otherwise("spurious_split")
    direction = (
        F.when(is_student(F.col("truth")) & (F.col("shown") == INSTRUCTOR), "student_as_instructor").when((F.col("truth") == INSTRUCTOR) & is_student(F.col("shown")), "instructor_as_student")
        .when(is_student(F.col("truth")) & is_student(F.col("shown")), "student_as_other_student").otherwise("other")
    )
    x = x.withColumn("cause", F.when(opens, cause)).withColumn("direction", F.when(F.col("err"), direction)).drop("__sl_p")
    return x


def error_runs(j: DataFrame) -> DataFrame:
    """rec_id, run, first_i, last_i, n_words, truth, label, direction, cause; high_harm: a student under the instructor's label."""
    r = j.where("err").groupBy("rec_id", "run").agg(
        F.min("pos").alias("first_pos"), F.min("i").alias("first_i"), F.max("i").alias("last_i"), F.count("*").alias("n_words"), F.min("truth").alias("truth"), F.min("speaker").alias("label"), F.min("direction").alias("direction"), F.max("cause").alias("cause"),
    )
    return r.withColumn("high_harm", F.col("direction") == "student_as_instructor")


def missed_changes(j: DataFrame) -> DataFrame:
    """True changes the label doesn't follow: rec_id, pos, i, misattributed words, direction, distance to the nearest boundary."""
    w = rec()
    back = F.last(F.when(F.col("change"), F.col("pos")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    down = Window.partitionBy("rec_id").orderBy(F.desc("pos"))  # a frame to the end would be read anew for each row
    ahead = F.last(F.when(F.col("change"), F.col("pos")), ignorenulls=True).over(down.rowsBetween(Window.unboundedPreceding, 0))
    m = j.select("*", F.least(F.col("pos") - back, ahead - F.col("pos")).alias("nearest_boundary")).where(F.col("true_change") & ~F.col("change"))
    r = error_runs(j).select("rec_id", F.col("first_pos").alias("pos"), F.col("n_words").alias("misattributed"), F.col("direction").alias("run_direction"))
    m = m.join(r, ["rec_id", "pos"], "left")
    return m.select("rec_id", "pos", "i", F.coalesce("misattributed", F.lit(0)).alias("misattributed"), F.col("run_direction").alias("direction"), "nearest_boundary")


def unknown_windows(j: DataFrame) -> DataFrame:
    w = rec()
    x = j.withColumn("new", (~F.col("known") & F.coalesce(F.lag("known").over(w), F.lit(True))).cast("int")).withColumn("g", F.sum("new").over(w)).where("not known")
    return x.groupBy("rec_id", "g").agg(F.min("i").alias("first_i"), F.max("i").alias("last_i"), F.count("*").alias("n_words")).select("rec_id", "first_i", "last_i", "n_words")


def ratio(a: Column, b: Column) -> Column:
    """a / b in ten-thousandths, half up, as a double; null for b = 0."""
    return F.when(b != 0, F.floor(a / b * 10000 + 0.5).cast("double"))


def score(j: DataFrame, labels: DataFrame, near: int = NEAR) -> DataFrame:
    """One row per recording: verdict counts, precision, also within 1 to `near` words, accuracy, misses, errors by direction and cause."""
    v = lambda x: F.count_if(F.col("verdict") == x)
    b = labels.groupBy("rec_id").agg(F.count("*").alias("boundaries"), v("real").alias("real"), v("spurious").alias("spurious"), v("unsure").alias("unsure"), F.count_if(F.col("verdict").isNull()).alias("unlabeled"))
    d = lambda x: F.count_if(F.col("direction") == x)
    words = j.groupBy("rec_id").agg(
        F.count("*").alias("words"), F.count_if("known").alias("scored"), F.count_if("err").alias("wrong"), F.count_if(F.col("known") & is_student(F.col("truth"))).alias("student_words"),
        d("student_as_instructor").alias("student_as_instructor"), d("instructor_as_student").alias("instructor_as_student"), F.count_if("true_change").alias("true_changes"), F.count_if(F.col("true_change") & ~F.col("change")).alias("missed"),
    )
    c = error_runs(j)
    by = lambda x: F.coalesce(F.sum(F.when(F.col("cause") == x, F.col("n_words"))), F.lit(0)).alias(f"words_{x}")
    c = c.groupBy("rec_id").agg(by("after_unknown"), by("wrong_label"), by("missed_change"), by("spurious_split"), F.count_if("high_harm").alias("high_harm_runs"))
    within = [f"near_misses_{k}" for k in range(1, near + 1)]
    m = near_misses(labels, missed_changes(j), near).groupBy("rec_id").agg(*[F.count_if(F.col("words") == k).alias(n) for k, n in enumerate(within, 1)])
    out = words.join(b, "rec_id", "left").join(c, "rec_id", "left").join(m, "rec_id", "left")
    zero = [*within, "boundaries", "real", "spurious", "unsure", "unlabeled", "words_after_unknown", "words_wrong_label", "words_missed_change", "words_spurious_split", "high_harm_runs"]
    out = out.fillna(0, zero)
    return out.select(
        "*", ratio(F.col("real"), F.col("real") + F.col("spurious")).alias("precision_e4"), ratio(F.col("real") + F.col("unsure"), F.col("boundaries") - F.col("unlabeled")).alias("precision_unsure_real_e4"),
        ratio(F.col("scored") - F.col("wrong"), F.col("scored")).alias("accuracy_e4"), ratio(F.col("student_as_instructor"), F.col("student_words")).alias("student_share_e4"),
        *[ratio(F.col("real") + F.col(n), F.col("real") + F.col("spurious")).alias(f"precision_within_{k}_e4") for k, n in enumerate(within, 1)],
    )


def verdict_places(j: DataFrame, labels: DataFrame, near: int = NEAR) -> DataFrame:
    """Verdict against where the boundary stands: unknown, at a true change, within `near` words of one, or none nearby."""
    close = F.max(F.coalesce(F.col("true_change"), F.lit(False))).over(rec().rowsBetween(-near, near))
    x = j.select("rec_id", "pos", "true_change", close.alias("close"))
    place = F.when(F.col("true_change").isNull(), "unknown").when(F.col("true_change"), "at_true_change").when(F.col("close"), "near_true_change").otherwise("none_nearby")
    return labels.join(x, ["rec_id", "pos"]).groupBy(F.coalesce("verdict", F.lit("unlabeled")).alias("verdict"), place.alias("place")).agg(F.count("*").alias("n"))


def near_misses(labels: DataFrame, missed: DataFrame, near: int = NEAR) -> DataFrame:
    """Spurious boundaries matched one to one with missed changes within 1 to `near` words: rec_id, words, pos, missed_pos.

    In word order each boundary takes the earliest free change in its window. Only positions in
    reach of each other meet: they are cut to islands first, and an island is read by two pointers.
    """
    both = labels.where("verdict = 'spurious'").select("rec_id", F.col("pos").cast("long").alias("p"), F.lit(None).cast("long").alias("q"))
    both = mixed([both, missed.select("rec_id", F.lit(None).cast("long").alias("p"), F.col("pos").cast("long").alias("q"))], "rec_id")
    both = both.select("rec_id", F.explode(F.sequence(F.lit(1), F.lit(near))).alias("words"), "p", "q", F.coalesce("p", "q").alias("at"))
    w = Window.partitionBy("rec_id", "words").orderBy("at", F.col("p").isNull())
    both = both.withColumn("isl", F.sum(F.coalesce((F.col("at") - F.lag("at").over(w) > F.col("words")).cast("int"), F.lit(0))).over(w))
    x = both.groupBy("rec_id", "words", "isl").agg(F.sort_array(F.collect_list("p")).alias("ps"), F.sort_array(F.collect_list("q")).alias("qs")).where((F.size("ps") > 0) & (F.size("qs") > 0))

    def step(s, _):
        p, q = F.get("ps", s["i"]), F.get("qs", s["j"])
        late, early = q < p - F.col("words"), q > p + F.col("words")
        pair = F.array(F.struct(p.alias("pos"), q.alias("missed_pos")))
        return (
            F.when(p.isNull() | q.isNull(), s).when(late, F.struct(s["i"].alias("i"), (s["j"] + 1).alias("j"), s["out"].alias("out")))
            .when(early, F.struct((s["i"] + 1).alias("i"), s["j"].alias("j"), s["out"].alias("out")))
            .otherwise(F.struct((s["i"] + 1).alias("i"), (s["j"] + 1).alias("j"), F.concat(s["out"], pair).alias("out")))
        )

    begin = F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.array().cast("array<struct<pos:bigint,missed_pos:bigint>>").alias("out"))
    found = F.aggregate(F.sequence(F.lit(1), F.size("ps") + F.size("qs")), begin, step)["out"]
    return x.select("rec_id", "words", F.inline(found))


def errors(j: DataFrame, labels: DataFrame) -> DataFrame:
    """Transitions that are wrong: rec_id, kind (missed, spurious), t, misattributed, high_harm."""
    m = missed_changes(j).select("rec_id", F.lit("missed").alias("kind"), F.col("pos").alias("t"), "misattributed", F.coalesce(F.col("direction") == "student_as_instructor", F.lit(False)).alias("high_harm"))
    s = labels.where("verdict = 'spurious'").select("rec_id", F.lit("spurious").alias("kind"), F.col("pos").alias("t"), F.lit(0).cast("long").alias("misattributed"), F.lit(False).alias("high_harm"))
    return mixed([m, s], "rec_id")


def surfaced(errs: DataFrame, found: DataFrame) -> DataFrame:
    """Each error with the classes whose windows hold it: a window [a, b] holds transition t if a < t <= b."""
    e = errs.withColumn("bucket", F.floor(F.col("t") / REACH)).alias("e")
    c = _spread(found).alias("c")
    hit = e.join(c, (F.col("e.rec_id") == F.col("c.rec_id")) & (F.col("e.bucket") == F.col("c.bucket")) & (F.col("c.a") < F.col("e.t")) & (F.col("e.t") <= F.col("c.b")), "left")
    return hit.groupBy("e.rec_id", "e.kind", "e.t", "e.misattributed", "e.high_harm").agg(F.sort_array(F.collect_set("c.class")).alias("classes"))


def _spread(found: DataFrame) -> DataFrame:
    """Windows over the position buckets they reach, so that an error meets those of its own bucket only."""
    return found.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("a") / REACH), F.floor(F.col("b") / REACH))))


def recall(by: DataFrame) -> DataFrame:
    """Errors and surfaced ones: overall, missed, missed_misattributing, spurious, high_harm (kinds overlap)."""
    kinds = F.filter(
        F.array(F.lit("overall"), F.when(F.col("kind") == "missed", "missed"), F.when((F.col("kind") == "missed") & (F.col("misattributed") > 0), "missed_misattributing"), F.when(F.col("kind") == "spurious", "spurious"), F.when(F.col("high_harm"), "high_harm")),
        lambda k: k.isNotNull(),
    )
    x = by.select(F.explode(kinds).alias("group"), (F.size("classes") > 0).alias("hit"))
    return x.groupBy("group").agg(F.count("*").alias("total"), F.count_if("hit").alias("surfaced")).withColumn("recall_e4", ratio(F.col("surfaced"), F.col("total")))


def class_report(by: DataFrame, found: DataFrame, errs: DataFrame) -> DataFrame:
    """Per class: windows, those that hold an error, errors surfaced, errors only it surfaces."""
    e = errs.select("rec_id", "t", F.floor(F.col("t") / REACH).alias("bucket")).distinct()
    w = _spread(found)
    held = w.join(e, (w["rec_id"] == e["rec_id"]) & (w["bucket"] == e["bucket"]) & (w["a"] < e["t"]) & (e["t"] <= w["b"]), "left_semi").select("rec_id", "class", "a", "b", "at").distinct()
    n = found.groupBy("class").agg(F.count("*").alias("windows")).join(held.groupBy("class").agg(F.count("*").alias("with_error")), "class", "left")
    x = by.select(F.explode("classes").alias("class"), (F.size("classes") == 1).alias("only"))
    x = x.groupBy("class").agg(F.count("*").alias("surfaced"), F.count_if("only").alias("only_this"))
    return n.join(x, "class", "left").fillna(0, ["with_error", "surfaced", "only_this"])


def class_stats(by: DataFrame, found: DataFrame, errs: DataFrame, hours: DataFrame, classes: list[str], family: dict[str, str]) -> DataFrame:
    """Per class and per group of classes: windows, per hour (tenths), words covered, errors surfaced and surfaced by it alone of each kind, windows with an error.

    by: surfaced(); hours: (rec_id, duration_s) of the recordings judged. Groups are split, merge, pair and everything
    but shift. only_*: errors that no class outside the group surfaces. A class without windows has a row of zeros.
    """
    units = [("class", c, family[c], [c]) for c in classes]
    units += [("group", f, f, own) for f in ("split", "merge", "pair") if (own := [c for c in classes if family[c] == f])]
    units.append(("group", "everything but shift", None, [c for c in classes if c != "shift"]))
    unit = F.array(*[F.struct(F.lit(a).alias("level"), F.lit(n).alias("name"), F.lit(f).cast("string").alias("family"), F.array(*[F.lit(c) for c in m]).alias("members")) for a, n, f, m in units])
    of_class = F.explode(F.filter(unit, lambda u: F.array_contains(u["members"], F.col("class"))))
    key = ["u.level", "u.name"]
    total = hours.agg((F.sum("duration_s") / 3600).alias("hours"))

    w = found.select("rec_id", "class", "a", "b", "at", of_class.alias("u"))
    # Words covered: each window adds what lies behind the furthest end before it.
    o = Window.partitionBy("rec_id", *key).orderBy("a", "b", "class", "at").rowsBetween(Window.unboundedPreceding, -1)
    past = F.coalesce(F.max("b").over(o), F.lit(-1))
    w = w.withColumn("new", F.greatest(F.col("b") - F.greatest(F.col("a"), past + 1) + 1, F.lit(0)))
    volume = w.groupBy(*key).agg(F.count("*").alias("windows"), F.sum("new").cast("long").alias("words_covered"))

    e = errs.select("rec_id", "t", F.floor(F.col("t") / REACH).alias("bucket")).distinct()
    s = _spread(found)
    held = s.join(e, (s["rec_id"] == e["rec_id"]) & (s["bucket"] == e["bucket"]) & (s["a"] < e["t"]) & (e["t"] <= s["b"]), "left_semi").select("rec_id", "class", "a", "b", "at").distinct()
    held = held.select(of_class.alias("u")).groupBy(*key).agg(F.count("*").alias("with_error"))

    kinds = {"all": F.lit(True), "missed": F.col("kind") == "missed", "missed_misattributing": (F.col("kind") == "missed") & (F.col("misattributed") > 0), "spurious": F.col("kind") == "spurious", "high_harm": F.col("high_harm")}
    x = by.select("*", F.explode(F.filter(unit, lambda u: F.arrays_overlap(u["members"], F.col("classes")))).alias("u"))
    alone = F.size(F.array_except("classes", "u.members")) == 0
    x = x.groupBy(*key).agg(*[F.count_if(c).alias(f"surfaced_{k}") for k, c in kinds.items()], *[F.count_if(c & alone).alias(f"only_{k}") for k, c in kinds.items()])

    every = total.select("hours", F.explode(unit).alias("u")).select(F.col("u.level").alias("level"), F.col("u.name").alias("name"), F.col("u.family").alias("family"), "hours")
    out = every.join(volume, ["level", "name"], "left").join(held, ["level", "name"], "left").join(x, ["level", "name"], "left")
    counts = ["windows", "words_covered", *[f"{p}_{k}" for p in ("surfaced", "only") for k in kinds], "with_error"]
    out = out.fillna(0, counts)
    rate = F.floor(F.when(F.col("hours") > 0, F.col("windows") / F.col("hours")) * 10 + 0.5).alias("per_hour_tenths")
    return out.select("level", "name", "family", "windows", rate, *counts[1:], ratio(F.col("with_error"), F.col("windows")).alias("with_error_e4"))


def site_lengths(sites: DataFrame) -> DataFrame:
    """Number, least, median, 90th and greatest length of sites over all recordings.

    The 90th is the element at place min(n - 1, floor(0.9 n)) of the sorted lengths, by
    a count per length rather than a list of all.
    """
    per = sites.groupBy((F.col("b") - F.col("a") + 1).alias("len")).agg(F.count("*").alias("c"))  # as many rows as there are lengths
    w = Window.partitionBy(F.lit(0)).orderBy("len")
    per = per.select("len", F.sum("c").over(w).alias("upto"), F.sum("c").over(Window.partitionBy(F.lit(0))).alias("n"))
    at = lambda k: F.min(F.when(F.col("upto") > k, F.col("len")))
    n = F.col("n")
    return per.agg(
        F.max("n").alias("n"), F.min("len").alias("min"), ((at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2).alias("median"), at(F.least(n - 1, F.floor(n * 0.9))).alias("p90"), F.max("len").alias("max"),
    )
