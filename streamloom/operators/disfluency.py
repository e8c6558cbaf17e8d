"""Restatements, completed partials and substitutions in a spoken stream; the fluent view; votes of other transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamloom.functions import tokens as tk
from streamloom.operators.stream import rec

SHAPES = ("restatement", "completed_partial", "substitution")
CANDIDATE = "proper_noun_candidate"


def matches(words: DataFrame, shapes: tuple[str, ...] = SHAPES) -> DataFrame:
    """Where a shape starts: rec_id, k (ordinal among words that are no fillers), pos, i, kind, shape, la, restart_pos.

    A match depends on the next five such words only; fillers may stand between the
    abandoned span and its restart, not inside either. Longer spans are tried first.
    """
    if not set(shapes) <= set(SHAPES):
        raise ValueError(f"unknown shapes {sorted(set(shapes) - set(SHAPES))}")
    w = words.where(~tk.is_filler(F.col("text"), F.col("flags")))
    ends = F.regexp_replace("text", "[\"')\\]”’]+$", "").rlike("[.?!]$")
    comma = F.regexp_replace("text", "[\"')]+$", "").endswith(",")
    one = F.struct(
        "pos", tk.expanded(F.col("text")).alias("e"), tk.restart_form(F.col("text")).alias("n"), ends.alias("t"), comma.alias("c"), F.col("text").rlike("^\\p{Lu}").alias("u"),
        F.array_contains("flags", "partial_word").alias("p"),
    )
    w = w.select("rec_id", "pos", "i", one.alias("x0"), (F.row_number().over(rec()) - 1).alias("k"))
    o = Window.partitionBy("rec_id").orderBy("k")
    w = w.select("*", *[F.lead("x0", n).over(o).alias(f"x{n}") for n in range(1, 6)])
    at = lambda n, f: F.col(f"x{n}.{f}")
    run = lambda a, size: at(a + size - 1, "pos") == at(a, "pos") + (size - 1)
    said = lambda a, size: F.concat_ws(" ", *[at(n, "e") for n in range(a, a + size)])
    found = []

    def calm(size: int):
        cond = run(0, size)
        for n in range(size):
            cond = cond & ~at(n, "t")
        return cond

    def event(kind: str, shape: str, la: int):
        return F.struct(F.lit(kind).alias("kind"), F.lit(shape).alias("shape"), F.lit(la).alias("la"), at(la, "pos").alias("restart_pos"))

    if "restatement" in shapes:
        for la in (3, 2, 1):
            same = None
            for lb in (3, 2, 1):
                if la + lb <= 6:
                    c = run(la, lb) & (said(0, la) == said(la, lb))
                    same = c if same is None else same | c
                else:
                    continue
            found.append(F.when(calm(la) & (said(0, la) != "") & same, event("repetition", "restatement", la)))
    if "completed_partial" in shapes:
        stem = F.regexp_replace(at(0, "n"), "-+$", "")
        nxt = at(1, "n")
        ok = at(0, "p") & (stem != "") & F.startswith(nxt, stem) & (F.length(nxt) > F.length(stem)) & ~nxt.endswith("-")
        found.append(F.when(ok, event("repair", "completed_partial", 1)))
    if "substitution" in shapes:
        for la in (2, 3):
            cond = calm(la) & run(la, la) & ~(at(la, "u") & ~at(0, "u")) & (at(0, "e") == at(la, "e"))
            differ = F.lit(0)
            for n in range(la):
                cond = cond & ~at(n, "c")
                differ = differ + (at(n, "e") != at(la + n, "e")).cast("int")
            found.append(F.when(cond & (differ == 1), event("repair", "substitution", la)))
    return w.withColumn("m", F.coalesce(*found)).where("m is not null").select("rec_id", "k", "pos", "i", "m.*")


def events(words: DataFrame, shapes: tuple[str, ...] = SHAPES) -> DataFrame:
    """The matches a left-to-right reading takes: after a match it goes on behind the abandoned span.

    Matches three or more words apart can't hinder each other, so the reading is a
    fold over each island of close matches, never over a whole recording.
    """
    m = matches(words, shapes)
    o = Window.partitionBy("rec_id").orderBy("k")
    m = m.withColumn("isl", F.sum(F.coalesce((F.col("k") - F.lag("k").over(o) >= 3).cast("int"), F.lit(0))).over(o))
    item = F.struct("k", "pos", "i", "kind", "shape", "la", "restart_pos")
    g = m.groupBy("rec_id", "isl").agg(F.sort_array(F.collect_list(item)).alias("ms"))
    empty = F.struct(F.lit(-1).alias("free"), F.filter("ms", lambda x: F.lit(False)).alias("out"))
    step = lambda s, x: F.when(x["k"] >= s["free"], F.struct((x["k"] + x["la"]).alias("free"), F.concat(s["out"], F.array(x)).alias("out"))).otherwise(s)
    return g.select("rec_id", F.explode(F.aggregate("ms", empty, step)["out"]).alias("e")).select("rec_id", "e.pos", "e.i", "e.kind", "e.shape", F.col("e.la").alias("n_abandoned"), "e.restart_pos")


def event_counts(ev: DataFrame) -> DataFrame:
    """Events by kind and by kind and shape (shape null: all)."""
    return ev.groupingSets([[F.col("rec_id"), F.col("kind")], [F.col("rec_id"), F.col("kind"), F.col("shape")]], F.col("rec_id"), F.col("kind"), F.col("shape")).agg(F.count("*").alias("n"))


def flagged(words: DataFrame, ev: DataFrame) -> DataFrame:
    """The words with their event kinds added to flags at every abandoned position."""
    at = ev.select("rec_id", F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("n_abandoned") - 1)).alias("pos"), "kind").groupBy("rec_id", "pos").agg(F.sort_array(F.collect_set("kind")).alias("kinds"))
    return words.join(at, ["rec_id", "pos"], "left").withColumn("flags", F.array_union("flags", F.coalesce("kinds", F.array().cast("array<string>")))).drop("kinds")


def fluent_view(words: DataFrame, pronouns: bool = True) -> DataFrame:
    """rec_id, fpos, piece, pos: normal pieces without markers and partials; equal neighbours are one."""
    p = words.select("rec_id", "pos", F.posexplode(tk.fluent_pieces(F.col("text"), pronouns)).alias("k", "piece"))
    o = Window.partitionBy("rec_id").orderBy("pos", "k")
    p = p.withColumn("prev", F.lag("piece").over(o)).where(F.col("prev").isNull() | (F.col("prev") != F.col("piece")))
    return p.select("rec_id", (F.row_number().over(o) - 1).alias("fpos"), "piece", "pos")


def name_marks(words: DataFrame) -> DataFrame:
    """Adds dropped, sentence_initial, name_like, adjacent (a dropped neighbour)."""
    w = words.withColumn("dropped", tk.is_disfluent(F.col("text")) | (F.trim("text") == ""))
    before = rec().rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(~tk.is_disfluent(F.col("text")), F.col("text")), ignorenulls=True).over(before)
    w = w.withColumn("__sl_last", last)
    w = w.withColumn("sentence_initial", F.col("__sl_last").isNull() | F.regexp_replace("__sl_last", "[\"')\\]”’]+$", "").rlike("[.?!]$"))
    w = w.withColumn("adjacent", F.coalesce(F.lag("dropped").over(rec()), F.lit(False)) | F.coalesce(F.lead("dropped").over(rec()), F.lit(False)))
    return w.withColumn("name_like", tk.capitalised(F.col("text")) & ~F.col("sentence_initial")).drop("__sl_last")


def conjunction(words: DataFrame, unmatched: DataFrame, dissenters: int, need: int | None = None, mask_adjacent: bool = True, exempt_names: bool = True, allow: DataFrame | None = None) -> DataFrame:
    """Tokens that enough other transcripts disagree with.

    unmatched: (rec_id, dissenter, pos), a row per unmatched fluent piece; a token has
    a vote for each, at most one per dissenter in number. allow: (piece) never flagged.
    Output: rec_id, pos, i, text, votes, adjacent, name_like, masked, allowlisted, flagged.
    """
    votes = unmatched.groupBy("rec_id", "pos").agg(F.least(F.count("*"), F.lit(dissenters)).cast("int").alias("votes")).where(F.col("votes") >= (dissenters if need is None else need))
    c = name_marks(words).join(votes, ["rec_id", "pos"])
    masked = F.lit(mask_adjacent) & F.col("adjacent") & ~(F.lit(exempt_names) & F.col("name_like"))
    c = c.withColumn("masked", masked)
    if allow is None:
        c = c.withColumn("allowlisted", F.lit(False))
    else:
        ok = c.select("rec_id", "pos", F.explode(tk.fluent_pieces(F.col("text"))).alias("piece")).join(allow.where("piece <> '<num>'").select("piece").distinct(), "piece", "left_semi").select("rec_id", "pos").distinct().withColumn("allowlisted", F.lit(True))
        c = c.join(ok, ["rec_id", "pos"], "left").withColumn("allowlisted", F.coalesce("allowlisted", F.lit(False)))
    return c.select("rec_id", "pos", "i", "text", "votes", "adjacent", "name_like", "masked", "allowlisted", (~F.col("masked") & ~F.col("allowlisted")).alias("flagged"))


def conjunction_stats(words: DataFrame, view: DataFrame, unmatched: DataFrame, candidates: DataFrame, dissenters: list[str]) -> DataFrame:
    """Per recording: tokens, fluent pieces, dropped tokens, unmatched pieces of each dissenter, candidates, masked, allowlisted and flagged ones, the flagged per 10,000 fluent pieces.

    words: spoken(); view: fluent_view(words); unmatched and candidates as conjunction() takes and gives them. Recordings without words give no row.
    """
    t = words.groupBy("rec_id").agg(F.count("*").alias("primary_tokens"), F.count_if(tk.is_disfluent(F.col("text")) | (F.trim("text") == "")).alias("dropped_tokens"))
    v = view.groupBy("rec_id").agg(F.count("*").alias("fluent_tokens"))
    u = unmatched.groupBy("rec_id").agg(*[F.count_if(F.col("dissenter") == n).alias(f"unmatched_{n}") for n in dissenters])
    c = candidates.groupBy("rec_id").agg(F.count("*").alias("candidates"), F.count_if("masked").alias("masked"), F.count_if(F.col("allowlisted") & ~F.col("masked")).alias("allowlisted"), F.count_if("flagged").alias("flagged"))
    out = t.join(v, "rec_id", "left").join(u, "rec_id", "left").join(c, "rec_id", "left").fillna(0)
    return out.withColumn("dissenters", F.lit(len(dissenters))).withColumn("flagged_e4", F.floor(F.col("flagged") / F.greatest(F.col("fluent_tokens"), F.lit(1)) * 10000 + 0.5).cast("double"))


def flagged_candidates(words: DataFrame, candidates: DataFrame, keys: list[str]) -> DataFrame:
    """The words with proper_noun_candidate added to flags where conjunction() flagged them; all words stay."""
    at = candidates.where("flagged").select(*keys, F.lit(True).alias("__sl_c")).distinct()
    one = F.when(F.col("__sl_c"), F.array(F.lit(CANDIDATE))).otherwise(F.array().cast("array<string>"))
    return words.join(at, keys, "left").withColumn("flags", F.array_union("flags", one)).drop("__sl_c")


def refused(primary: DataFrame, others: DataFrame, least: int = 3, share: float = 0.25) -> DataFrame:
    """(rec_id, why) of recordings whose other transcripts can't vote: too_few, same_model, too_short.

    primary: (rec_id, n_tokens); others: (rec_id, dissenter, model_id, n_tokens). Too short is one
    with less than `share` of the primary's tokens.
    """
    o = others.join(primary.select("rec_id", F.col("n_tokens").alias("own")), "rec_id")
    g = o.groupBy("rec_id").agg(F.count("*").alias("n"), F.count_distinct("model_id").alias("models"), F.min(F.col("n_tokens") / F.greatest(F.col("own"), F.lit(1))).alias("least_share"))
    x = primary.select("rec_id").join(g, "rec_id", "left").fillna(0, ["n", "models"])
    whys = F.filter(F.array(F.when(F.col("n") < least, "too_few"), F.when(F.col("models") < F.col("n"), "same_model"), F.when(F.col("least_share") < share, "too_short")), lambda w: w.isNotNull())
    return x.select("rec_id", F.explode(whys).alias("why"))
