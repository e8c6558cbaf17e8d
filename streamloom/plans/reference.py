"""Queries of the transcript operators over the record tables, with SQL twins."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamloom.functions import tokens as tk
from streamloom.operators import stream as st
from streamloom.plans.prelude import STREAM, TURNS, WORDS, with_ctes
from streamloom.plans.tables import load

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def the_words(spark: SparkSession, d: str) -> DataFrame:
    return st.words_once(load(spark, d, "words"))


def the_turns(spark: SparkSession, d: str) -> DataFrame:
    return st.turns_once(load(spark, d, "speaker_turns"))


def the_stream(spark: SparkSession, d: str) -> DataFrame:
    return st.stream(load(spark, d, "words"), load(spark, d, "speaker_turns"))


@query(with_ctes(WORDS, "select rec_id, i, text, flag from (select rec_id, i, text, unnest(told) as flag from wf)"))
def txt_flags(spark, d):
    """Flags that a token's own form tells."""
    return the_words(spark, d).select("rec_id", "i", "text", F.explode(tk.flags_of(F.col("text"))).alias("flag"))


@query(with_ctes(WORDS, "select flag, count(*) as n, count(distinct rec_id) as n_recs from (select rec_id, unnest(list_distinct(list_concat(own, told))) as flag from wf) group by flag"))
def agg_flag_counts(spark, d):
    """Words per flag, own and told."""
    return the_words(spark, d).select("rec_id", F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"), F.count_distinct("rec_id").alias("n_recs"))


@query(with_ctes(WORDS, "select rec_id, i, pos, (text like '[%' and text like '%]') as marker from sp"))
def prj_stream_positions(spark, d):
    """Silence dropped; positions in the stream beside the record's."""
    return st.spoken(the_words(spark, d)).select("rec_id", "i", "pos", tk.is_marker(F.col("text")).alias("marker"))


@query(with_ctes(TURNS, "select rec_id, turn_ord, ord, start_s, end_s, speaker from tn"))
def src_sound_turns(spark, d):
    """Turns that pass the sanity rules, in (start, end) order."""
    return the_turns(spark, d).select("rec_id", "turn_ord", "ord", "start_s", "end_s", "speaker")


_ASG = with_ctes(STREAM, "select rec_id, i, speaker_raw, speaker, flipped from sml")


@query(_ASG)
def join_assign_smooth(spark, d):
    """Speaker of each word by overlap, then nearest, then smoothed."""
    return the_stream(spark, d).select("rec_id", "i", "speaker_raw", "speaker", "flipped")


@query(with_ctes(STREAM, "select rec_id, pos, ord, speaker from hit"))
def join_turn_hits(spark, d):
    """Every turn that hits a word."""
    return st.hits(st.spoken(the_words(spark, d)), the_turns(spark, d)).select("rec_id", "pos", "ord", "speaker")


@query(with_ctes(STREAM, "select rec_id, sent, min(i) as first_i, max(i) as last_i, max(boundary) as boundary, arg_min_null(speaker, pos) as speaker, arg_min_null(start_s, pos) as start_s, arg_max_null(end_s, pos) as end_s from stm group by rec_id, sent"))
def win_sentences(spark, d):
    """Sentences by punctuation, pause and speaker change."""
    return st.sentence_table(the_stream(spark, d)).select("rec_id", "sent", "first_i", "last_i", "boundary", "speaker", "start_s", "end_s")


@query(with_ctes(STREAM, "select rec_id, stretch as turn, arg_min_null(speaker, pos) as speaker, min(i) as first_i, max(i) as last_i, count(*) as n_words, count(distinct sent) as n_sentences from stm group by rec_id, stretch"))
def win_turns(spark, d):
    """Turns: consecutive sentences of one speaker."""
    return st.turn_table(the_stream(spark, d))


# -- candidate windows -----------------------------------------------------------------
from streamloom.operators import candidates as cd  # noqa: E402
from streamloom.operators.shared import write_and_read  # noqa: E402
from streamloom.plans.prelude import _Q, terminal_sql  # noqa: E402


def _cue_sql(t: str) -> str:
    return f"regexp_replace(regexp_replace(replace(replace(lower({t}), '’', ''''), '‘', ''''), '^[^\\p{{L}}\\p{{N}}_''-]+', ''), '[^\\p{{L}}\\p{{N}}_''-]+$', '')"


_CORE = "rtrim({t}, '\"'')]”’»')"


def _cand_sql(version: int) -> str:
    openers = cd.ANSWER_OPENERS + ["so"] * (version == 2)
    first_letter = "regexp_extract(text, '(\\p{L})', 1)"
    parts = [
        f"""pp as (
  select *, lag(gap_next) over v as gap_in, {terminal_sql('text')} as terminal, {terminal_sql('text')} and {_CORE.format(t='text')} like '%?' as question, {_cue_sql('text')} as tok,
    lag(speaker) over v as prev_label, lead(speaker) over v as next_label, lag(text) over v as prev_text, lag(stretch) over v as prev_stretch, lead(stretch) over v as next_stretch, lag(sent) over v as prev_sent, count(*) over (partition by rec_id) as n
  from stm window v as (partition by rec_id order by pos)
), c1 as (select rec_id, n, 'shift' as class, pos - 4 as a, pos + 3 as b, pos as att from pp where change),
sg as (select rec_id, stretch, min(pos) as s, max(pos) as e, arg_min_null(speaker, pos) as lab, arg_min_null(gap_in, pos) as bef, arg_max_null(gap_next, pos) as aft, max(n) as n from pp group by all),
sh as (select *, lag(lab) over v as l, lead(lab) over v as r, lag(stretch) over v as ls, lead(stretch) over v as rs from sg window v as (partition by rec_id order by stretch)),
c2 as (select rec_id, n, case when coalesce(bef > 0.5, false) or coalesce(aft > 0.5, false) then 'edge_island' else 'long_island' end, s - 1, e + 1, s from sh where ls is not null and rs is not null and l is not distinct from r and lab is distinct from l and e - s + 1 <= {cd.ISLAND_WORDS}),
c3 as (
  select rec_id, n, 'no_punct_lowercase', pos - 1, pos, pos from pp where change and not {terminal_sql('prev_text')} and {first_letter} <> '' and regexp_matches({first_letter}, '^\\p{{Ll}}$')
  union all select rec_id, n, 'zero_gap', pos - 1, pos, pos from pp where change and gap_in <= {cd.ZERO_GAP}
  union all select rec_id, n, 'inside_sentence', pos - 1, pos, pos from pp where change and not {terminal_sql('prev_text')} and (gap_in is null or gap_in <= 0.5)
), rw as (select distinct rec_id, pos, speaker as x from hit union select rec_id, pos, speaker_raw from pp where speaker_raw is not null),
ct as (select rw.x, pp.rec_id, pp.pos, pp.n, pp.prev_label, pp.next_label, pp.pos - row_number() over (partition by pp.rec_id, rw.x order by pp.pos) as run from rw join pp on pp.rec_id = rw.rec_id and pp.pos = rw.pos where rw.x is distinct from pp.speaker),
cr as (select rec_id, x, run, min(pos) as a0, max(pos) as b0, arg_min_null(prev_label, pos) as pl, arg_max_null(next_label, pos) as nl, max(n) as n from ct group by all),
c4 as (select rec_id, n, 'dropped_raw_change', a0 - 4, b0 + 4, a0 from cr where not ((coalesce(pl = x, false) or coalesce(nl = x, false)) and b0 - a0 + 1 <= 3)),
tl as (select *, lag(speaker) over (partition by rec_id order by ord) as pv from tn),
tr as (select *, sum((pv is distinct from speaker)::int) over (partition by rec_id order by ord) as trun from tl),
te as (select tr.rec_id, tr.trun, min(tr.speaker) as x, min(tr.start_s) as t0 from tr left join (select distinct rec_id, ord from hit) h on h.rec_id = tr.rec_id and h.ord = tr.ord group by tr.rec_id, tr.trun having count(h.ord) = 0),
tg as (select te.rec_id, te.trun, te.x, min(pp.pos) as g, max(pp.n) as n from te join pp on pp.rec_id = te.rec_id and pp.start_s >= te.t0 group by all having min(pp.pos) > 0),
c5 as (select rec_id, n, 'dropped_raw_change', g - 4, g + 3, g from tg where not exists (select 1 from pp where pp.rec_id = tg.rec_id and pp.pos >= tg.g - 3 and pp.pos < tg.g + 3 and pp.speaker = tg.x)),
sn as (select rec_id, sent, min(pos) as f, max(pos) as l, min(stretch) as stretch, arg_min(tok, pos) as op, arg_max(terminal, pos) as terminal, arg_max(question, pos) as question, list(tok order by pos) as toks, max(n) as n, count(*) as nw from pp group by rec_id, sent),
so as (select *, coalesce(lag(stretch) over v = stretch, false) as same_prev, coalesce(lead(stretch) over v = stretch, false) as same_next, lead(op) over v as nop, lead(f) over v as rr from sn window v as (partition by rec_id order by sent)),
c6 as (
  select rec_id, n, 'question_answer', f - 1, rr, rr from so where same_next and question and nop in ({_Q(openers)})
  union all select rec_id, n, 'address_reply', l, rr, rr from so where same_next and nw <= {cd.ADDRESS_WORDS} and terminal and nop in ({_Q(cd.ANSWER_OPENERS)}) and (list_has_any(toks, [{_Q(cd.SECOND_PERSON + cd.SOLICIT)}]) or (' ' || array_to_string(toks, ' ') || ' ') like '% go ahead %')
  union all select rec_id, n, 'backchannel', f - 1, l + 1, f from so where same_prev and same_next and nw <= 3 and list_has_all([{_Q(cd.BACKCHANNEL)}], toks)
)"""
    ]
    union = ["select * from c1", "select * from c2", "select * from c3", "select * from c4", "select * from c5", "select * from c6"]
    if version == 1:
        parts.append(f"""rg as (
  select *, sum((tok in ({_Q(cd.FIRST_PERSON)}))::int) over b as fb, sum((tok in ({_Q(cd.FIRST_PERSON)}))::int) over f as fa, count(*) over b as nb, count(*) over f as na from pp
  window b as (partition by rec_id, stretch order by pos rows between 20 preceding and 1 preceding), f as (partition by rec_id, stretch order by pos rows between current row and 19 following)
), c7 as (select rec_id, n, 'register_change', pos - 1, pos, pos from rg where prev_sent < sent and prev_stretch = stretch and nb >= 5 and na >= 5 and fb = 0 and fa >= 2)""")
        union.append("select * from c7")
    else:
        parts.append(f"""cs as (select *, prev_sent is null or prev_sent <> sent or coalesce(regexp_matches({_CORE.format(t='prev_text')}, '[,;:–—]$') or gap_in > 0.3, false) as opens from pp),
cl as (select *, sum(opens::int) over (partition by rec_id order by pos) as cl from cs),
cg as (select rec_id, cl, min(pos) as f, max(pos) as l, bool_and(tok in ({_Q([t for t in cd.BACKCHANNEL if t not in cd.CLAUSE_FILLERS])})) as ok, min(sent) as sent, arg_min_null(prev_stretch, pos) as ps, arg_max_null(next_stretch, pos) as ns, min(stretch) as stretch, max(n) as n from cl group by rec_id, cl),
ch as (select *, count(*) over (partition by rec_id, sent) as in_sent from cg),
c7 as (select rec_id, n, 'clause_backchannel', f - 1, l + 1, f from ch where ok and l - f + 1 <= 3 and in_sent > 1 and ps = stretch and ns = stretch),
u0 as (select * from c1 union all select * from c2 union all select * from c3 union all select * from c4 union all select * from c5 union all select * from c6 union all select * from c7),
u1 as (select rec_id, n, class, greatest(a, 0) as a, least(b, n - 1) as b, att from u0 where greatest(a, 0) < least(b, n - 1)),
qs as (select rec_id, pos, stretch from pp where question), qn as (select rec_id, pos, stretch from pp where question and next_stretch = stretch),
pr as (select u1.rec_id, u1.n, min(qn.pos) as q from u1 join pp on pp.rec_id = u1.rec_id and pp.pos = u1.b join qn on qn.rec_id = u1.rec_id and qn.stretch = pp.stretch and qn.pos >= u1.b where u1.class in ({_Q(cd.PAIR_RETURN_FROM)}) group by u1.rec_id, u1.n, u1.b having min(qn.pos) - u1.b < {cd.PAIR_WORDS}),
ps as (select u1.rec_id, u1.n, max(qs.pos) as q from u1 join pp on pp.rec_id = u1.rec_id and pp.pos = u1.a join qs on qs.rec_id = u1.rec_id and qs.stretch = pp.stretch and qs.pos <= u1.a where u1.class in ({_Q(cd.PAIR_START_FROM)}) group by u1.rec_id, u1.n, u1.a having u1.a - max(qs.pos) < {cd.PAIR_WORDS}),
c8 as (select distinct rec_id, n, 'paired_return', q, q + 1, q + 1 from pr), c9 as (select distinct rec_id, n, 'paired_start', q, q + 1, q + 1 from ps)""")
        union += ["select * from c7", "select * from c8", "select * from c9"]
    parts.append("ca as (select rec_id, class, greatest(a, 0) as a, least(b, n - 1) as b, att from (" + " union all ".join(union) + ") where greatest(a, 0) < least(b, n - 1))")
    parts.append("ix as (select rec_id || '#' || pos as k, i from stm)")
    return STREAM + ",\n" + ",\n".join(parts)


_NUMBERED = """select ca.rec_id, ca.class, x.i as first_i, y.i as last_i, z.i as at_i from ca join ix x on x.k = ca.rec_id || '#' || ca.a join ix y on y.k = ca.rec_id || '#' || ca.b join ix z on z.k = ca.rec_id || '#' || ca.att"""
_SITES = """sq as (select *, max(b) over (partition by rec_id order by a, b, class, att rows between unbounded preceding and 1 preceding) as reach from ca),
sr as (select *, (sum((reach is null or a > reach)::int) over (partition by rec_id order by a, b, class, att rows unbounded preceding))::int as site from sq),
st as (select rec_id, site, min(a)::int as a, max(b)::int as b, count(*) as n_windows, array_to_string(list_sort(list_distinct(list(class))), ',') as classes from sr group by rec_id, site)"""


def _found(spark, d, version):
    """(rec_id, n_words, n_boundaries) and the windows, both of one table that is written once."""
    w = write_and_read(cd.windows_of(the_words(spark, d), the_turns(spark, d), version), "windows")
    return w.where("class is null").select("rec_id", "n_words", "n_boundaries"), cd.found_windows(w, version)


@query("with " + _cand_sql(1) + "\n" + _NUMBERED)
def cand_v1(spark, d):
    """Windows of the first rule set."""
    return _found(spark, d, 1)[1].select("rec_id", "class", "first_i", "last_i", "at_i")


@query("with " + _cand_sql(2) + "\n" + _NUMBERED)
def cand_v2(spark, d):
    """Windows of the second rule set."""
    return _found(spark, d, 2)[1].select("rec_id", "class", "first_i", "last_i", "at_i")


@query("with " + _cand_sql(2) + ",\n" + _SITES + "\nselect rec_id, site, a, b, n_windows, classes from st")
def cand_sites(spark, d):
    """Windows sharing a word merged to sites."""
    return cd.sites(_found(spark, d, 2)[1])


_DUR = "du as (select rec_id, max(duration_s) as duration_s from recordings where rec_id is not null group by rec_id)"


def durations(spark, d):
    return load(spark, d, "recordings").where("rec_id is not null").groupBy("rec_id").agg(F.max("duration_s").alias("duration_s"))


@query("with " + _cand_sql(1) + ",\n" + _SITES + ",\n" + _DUR + """
select n.rec_id, n.n_words, n.n_boundaries, coalesce(c.k, 0) as n_candidates, coalesce(s.k, 0) as n_sites, coalesce(s.cov, 0) as covered,
  cast(floor(case when du.duration_s / 3600 > 0 then coalesce(c.k, 0) / (du.duration_s / 3600) end * 10 + 0.5) as bigint) as per_hour_tenths, cast(floor(coalesce(s.cov, 0) / n.n_words * 10000 + 0.5) as bigint) as covered_share_e4
from (select rec_id, count(*) as n_words, sum(change::int)::bigint as n_boundaries from stm group by rec_id) n
left join (select rec_id, count(*) as k from ca group by rec_id) c on c.rec_id = n.rec_id left join (select rec_id, count(*) as k, sum(b - a + 1)::bigint as cov from st group by rec_id) s on s.rec_id = n.rec_id left join du on du.rec_id = n.rec_id""")
def cand_volume(spark, d):
    """Counts, rates and coverage of the windows."""
    n, c = _found(spark, d, 1)
    return cd.volume(c, n, durations(spark, d))


# -- disfluencies and the fluent view ------------------------------------------------------
from streamloom.operators import align as al  # noqa: E402
from streamloom.operators import disfluency as df  # noqa: E402


def _case(forms: dict[str, str], t: str, other: str) -> str:
    q = lambda x: x.replace("'", "''")
    return f"case {t} " + " ".join(f"when '{q(k)}' then '{q(v)}'" for k, v in forms.items()) + f" else {other} end"


_NORM = "(regexp_replace(regexp_replace(replace(lower(trim(text)), '’', ''''), '" + tk.PUNCTUATION.replace("\\\\", "\\") + "', '', 'g'), '-+$', '') || case when lower(trim(text)) like '%-' and length(trim(text)) > 1 then '-' else '' end)"
_MATCHES = f"""fl as (select *, {_NORM} as n, list_distinct(list_concat(own, told)) as flags from sp),
nf as (
  select rec_id, pos, i, text, n, replace({_case(tk.RESTART_FORMS, 'n', 'n')}, '''', '') as e, list_contains(flags, 'partial_word') as p, regexp_matches(regexp_replace(text, '["'')\\]”’]+$', ''), '[.?!]$') as t,
    rtrim(text, '"'')') like '%,' as c, regexp_matches(text, '^\\p{{Lu}}') as u, row_number() over (partition by rec_id order by pos) - 1 as k
  from fl where not (list_contains(flags, 'filled_pause') or list_contains(flags, 'vocalization') or regexp_matches(trim(text), '^[(\\[<].*[)\\]>]$'))
), ld as (select *, {', '.join(f'lead({c}, {n}) over v as {c}{n}' for n in range(1, 6) for c in ('pos', 'e', 'n', 't', 'c', 'u'))} from nf window v as (partition by rec_id order by k))"""


def _col(c: str, n: int) -> str:
    return c if n == 0 else f"{c}{n}"


def _said(a: int, size: int) -> str:
    return " || ' ' || ".join(_col("e", n) for n in range(a, a + size))


def _run(a: int, size: int) -> str:
    return f"{_col('pos', a + size - 1)} = {_col('pos', a)} + {size - 1}"


def _match_sql() -> str:
    whens = []
    for la in (3, 2, 1):
        calm = " and ".join([_run(0, la), *[f"not {_col('t', n)}" for n in range(la)], f"trim({_said(0, la)}) <> ''"])
        same = " or ".join(f"({_run(la, lb)} and {_said(0, la)} = {_said(la, lb)})" for lb in (3, 2, 1) if la + lb <= 6)
        whens.append((f"{calm} and ({same})", "repetition", "restatement", la))
    whens.append(("p and rtrim(n, '-') <> '' and starts_with(n1, rtrim(n, '-')) and length(n1) > length(rtrim(n, '-')) and n1 not like '%-'", "repair", "completed_partial", 1))
    for la in (2, 3):
        cond = [_run(0, la), _run(la, la), *[f"not {_col('t', n)} and not {_col('c', n)}" for n in range(la)], f"not ({_col('u', la)} and not u)", f"e = {_col('e', la)}"]
        cond.append(" + ".join(f"({_col('e', n)} <> {_col('e', la + n)})::int" for n in range(la)) + " = 1")
        whens.append((" and ".join(cond), "repair", "substitution", la))
    c = lambda k: "case " + " ".join(f"when {w[0]} then {w[k]!r}" for w in whens) + " end"
    return f"ma as (select rec_id, k, pos, i, {c(1)} as kind, {c(2)} as shape, {c(3)} as la, [pos1, pos2, pos3] as nx from ld), mb as (select *, nx[la] as restart_pos from ma where kind is not null)"


_EVENTS = _MATCHES + ",\n" + _match_sql() + """,
mc as (select *, coalesce((k - lag(k) over (partition by rec_id order by k) >= 3)::int, 0) as brk from mb),
md as (select *, sum(brk) over (partition by rec_id order by k) as isl from mc),
me as (select *, row_number() over (partition by rec_id, isl order by k) as rn, rec_id || '#' || isl as gk from md),
rr as (select gk, rn, k + la as free, true as sel from me where rn = 1 union all select me.gk, me.rn, case when me.k >= rr.free then me.k + me.la else rr.free end, me.k >= rr.free from rr join me on me.gk = rr.gk and me.rn = rr.rn + 1),
ev as (select me.rec_id, me.pos, me.i, me.kind, me.shape, me.la as n_abandoned, me.restart_pos from me join rr on rr.gk = me.gk and rr.rn = me.rn where rr.sel)"""


@query("with recursive " + WORDS + ",\n" + _EVENTS + "\nselect rec_id, i, kind, shape, n_abandoned, restart_pos from ev")
def dis_events(spark, d):
    """Repetitions and repairs a left-to-right reading finds."""
    return df.events(st.spoken(the_words(spark, d))).select("rec_id", "i", "kind", "shape", "n_abandoned", "restart_pos")


@query("with recursive " + WORDS + ",\n" + _EVENTS + "\nselect rec_id, kind, shape, count(*) as n from ev group by grouping sets ((rec_id, kind), (rec_id, kind, shape))")
def agg_disfluency_counts(spark, d):
    """Events by kind, and by kind and shape."""
    return df.event_counts(df.events(st.spoken(the_words(spark, d))))


_PIECES = f"""fp as (select rec_id, pos, text, lower(trim(text)) as t from sp where trim(text) <> '' and not (regexp_matches(trim(text), '^[(\\[<].*[)\\]>]$') or (trim(text) like '%-' and length(trim(text)) > 1))),
fq as (select *, trim(t, '{tk.CORE_SIGNS.replace(chr(39), chr(39) * 2)}') as core from fp),
fr as (select rec_id, pos, {_case(tk.PRONOUN_FORMS, 'core', _case(tk.FLUENT_FORMS, 'core', 't'))} as t from fq),
fs as (select rec_id, pos, unnest(ps) as piece, generate_subscripts(ps, 1) as k from (select rec_id, pos, string_split_regex(regexp_replace(t, '{tk.PUNCTUATION.replace(chr(92) * 2, chr(92))}', '', 'g'), '[-–—/\\s]+') as ps from fr)),
ft as (select rec_id, pos, k, replace(replace(piece, '''', ''), '’', '') as piece from fs),
fu as (select rec_id, pos, k, case when regexp_matches(piece, '^\\d+([.,]\\d+)?(st|nd|rd|th|s)?$') or piece in ({_Q(tk.NUMBER_WORDS)}) then '<num>' else piece end as piece from ft where piece <> ''),
fv as (select *, lag(piece) over (partition by rec_id order by pos, k) as pv from fu),
fw as (select rec_id, row_number() over (partition by rec_id order by pos, k) - 1 as fpos, piece, pos from fv where pv is null or pv <> piece)"""


@query(with_ctes(WORDS, _PIECES, "select rec_id, fpos, piece, pos from fw"))
def txt_fluent_view(spark, d):
    """Pieces of the fluent view with their tokens."""
    return df.fluent_view(st.spoken(the_words(spark, d)))


@query(with_ctes(WORDS, """dr as (select *, regexp_matches(trim(text), '^[(\\[<].*[)\\]>]$') or (trim(text) like '%-' and length(trim(text)) > 1) as dis from sp),
ls as (select *, last_value(case when not dis then text end ignore nulls) over (partition by rec_id order by pos rows between unbounded preceding and 1 preceding) as lt from dr)""",
"select rec_id, i, lt is null or regexp_matches(regexp_replace(lt, '[\"'')\\]”’]+$', ''), '[.?!]$') as sentence_initial, regexp_matches(trim(text, '" + tk.CORE_SIGNS.replace("'", "''") + "'), '^\\p{Lu}') and not (lt is null or regexp_matches(regexp_replace(lt, '[\"'')\\]”’]+$', ''), '[.?!]$')) as name_like from ls"))
def txt_name_like(spark, d):
    """Capitalised words inside sentences."""
    return df.name_marks(st.spoken(the_words(spark, d))).select("rec_id", "i", "sentence_initial", "name_like")


def _dissenters(view: DataFrame) -> DataFrame:
    """Three transcripts of the same recordings that drop or change other pieces each."""
    out = None
    for name, m in (("a", 31), ("b", 37), ("c", 41)):
        x = view.where(F.col("fpos") % m != 7).withColumn("piece", F.when((F.col("fpos") % m == 11) | (F.col("pos") % 97 == 5), F.concat("piece", F.lit("x"))).otherwise(F.col("piece")))
        x = x.select("rec_id", F.lit(name).alias("dissenter"), "fpos", "piece")
        out = x if out is None else out.unionByName(x)
    return out


@query()
def vote_conjunction(spark, d):
    """Tokens that all of three other transcripts disagree with."""
    words = st.spoken(the_words(spark, d))
    view = write_and_read(df.fluent_view(words), "fluent")
    return df.conjunction(words, al.unmatched(view, _dissenters(view), ["a", "b", "c"]), 3)


@query()
def vote_annotated(spark, d):
    """Words of both streams with the flags of the votes, and as they are rendered: [NAME?] and the candidate class."""
    from streamloom.operators import render as rd

    primary = the_words(spark, d).withColumn("stream", F.lit("primary"))
    # The tables hold no second rendering; without markers and partials the words stand for one.
    fluent = primary.where(~tk.is_disfluent(F.col("text"))).withColumn("stream", F.lit("secondary"))
    fluent = fluent.withColumn("i", F.row_number().over(Window.partitionBy("rec_id").orderBy("i")) - 1)
    view = write_and_read(df.fluent_view(st.spoken(the_words(spark, d))), "fluent")
    words, _ = al.annotate(primary.unionByName(fluent), _dissenters(view), ["a", "b", "c"])
    return words.select("stream", "rec_id", "i", "text", "flags", rd.html_word().alias("html"), rd.named_word().alias("shown"))


# -- evaluation ------------------------------------------------------------------------------
from streamloom.operators import evaluate as ev  # noqa: E402

_STUDENTS = _Q(ev.STUDENTS)
_WHO = "case when try_cast(regexp_extract(asr_speaker, '(\\d+)', 1) as int) = 0 then 'L' when try_cast(regexp_extract(asr_speaker, '(\\d+)', 1) as int) = 1 then 'S' when try_cast(regexp_extract(asr_speaker, '(\\d+)', 1) as int) between 2 and 9 then 'S' || try_cast(regexp_extract(asr_speaker, '(\\d+)', 1) as int) end"
_GOLD = f"""gw as (select *, {_WHO} as who from stm),
gx as (select *, lag(who) over v as was, lag(speaker) over v as frm, row_number() over (partition by rec_id, change order by pos) as bno from gw window v as (partition by rec_id order by pos)),
gold as (select rec_id, pos, bno, frm, speaker as "to", case when bno % 11 <> 0 then case when was is null or who is null then 'unsure' when was <> who then 'real' else 'spurious' end end as verdict, case when bno % 11 <> 0 and was <> who and bno % 3 <> 0 then who end as who from gx where change),
gm as (select rec_id, pos, who from gx where not change and was <> who)"""


def _truth_sql(name: str, mapped: str) -> str:
    return f"""{name}e as (select s.*, case when k.pos is not null then {{'w': k.who}} when s.pos = 0 then {{'w': {mapped}}} when g.verdict = 'real' then {{'w': coalesce(g.who, {mapped})}} when g.verdict = 'spurious' then null when g.pos is not null then {{'w': null::varchar}} end as e
  from stm s left join gm k on k.rec_id || '#' || k.pos = s.rec_id || '#' || s.pos left join gold g on g.rec_id || '#' || g.pos = s.rec_id || '#' || s.pos {"left join mp m on m.rec_id || '#' || m.label = s.rec_id || '#' || s.speaker" if mapped != "null::varchar" else ""}),
{name} as (select * exclude (e), last_value(e ignore nulls) over (partition by rec_id order by pos rows between unbounded preceding and current row)['w'] as truth from {name}e)"""


_MAP = _truth_sql("stated", "null::varchar") + f""",
sw as (select rec_id, speaker as label, truth as who, count(*) as n from stated where speaker is not null and truth is not null and truth <> '?' group by all),
al as (select distinct rec_id, speaker as label from stm where speaker is not null),
pl as (select al.rec_id, al.label, coalesce(sum(case when who = 'L' then n else 0 end), 0) as nl, coalesce(sum(case when who <> 'L' then n else 0 end), 0) as ns from al left join sw on sw.rec_id = al.rec_id and sw.label = al.label group by all),
pt as (select *, sum(nl) over (partition by rec_id) as tl, sum(ns) over (partition by rec_id) as ts from pl),
bs as (select rec_id, label, who from (select *, row_number() over (partition by rec_id, label order by n desc, list_position([{_STUDENTS}], who)) as rn from sw where who <> 'L') where rn = 1),
mp as (select pt.rec_id, pt.label, case when case when ts = 0 then true when tl = 0 then ns = 0 else nl * ts >= ns * tl end then 'L' else coalesce(bs.who, 'S') end as who from pt left join bs on bs.rec_id = pt.rec_id and bs.label = pt.label)"""
_JUDGED = _GOLD + ",\n" + _MAP + ",\n" + _truth_sql("trt", "m.who") + """,
ja as (select t.*, m.who as shown from trt t left join mp m on m.rec_id || '#' || m.label = t.rec_id || '#' || t.speaker),
jb as (select *, truth is not null and truth <> '?' as known, truth is not null and truth <> '?' and truth is distinct from shown as err from ja),
jc as (select *, lag(truth) over v as pt, coalesce(lag(known) over v, false) as pk, coalesce(lag(err) over v, false) as pe, lag(speaker) over v as pl from jb window v as (partition by rec_id order by pos)),
jd as (select *, case when pt is not null and truth is not null and not (pt = '?' and truth = '?') then pt <> truth end as true_change, err and not (pe and pt is not distinct from truth and pl is not distinct from speaker) as opens from jc),
je as (select *, case when err then sum(opens::int) over (partition by rec_id order by pos) end as run,
  case when opens then case when not pk then 'after_unknown' when pt <> truth and change then 'wrong_label' when pt <> truth then 'missed_change' else 'spurious_split' end end as cause,
  case when err then case when regexp_matches(truth, '^S[2-9]?$') and shown = 'L' then 'student_as_instructor' when truth = 'L' and regexp_matches(shown, '^S[2-9]?$') then 'instructor_as_student' when regexp_matches(truth, '^S[2-9]?$') and regexp_matches(shown, '^S[2-9]?$') then 'student_as_other_student' else 'other' end end as direction from jd),
ru as (select rec_id, run, min(pos) as first_pos, min(i) as first_i, max(i) as last_i, count(*) as n_words, min(truth) as truth, min(speaker) as label, min(direction) as direction, max(cause) as cause, min(direction) = 'student_as_instructor' as high_harm from je where err group by rec_id, run),
mx as (select *, last_value(case when change then pos end ignore nulls) over (partition by rec_id order by pos rows between unbounded preceding and current row) as bk, first_value(case when change then pos end ignore nulls) over (partition by rec_id order by pos rows between current row and unbounded following) as ah from je),
mi as (select mx.rec_id, mx.pos, mx.i, coalesce(ru.n_words, 0) as misattributed, ru.direction, least(mx.pos - bk, ah - mx.pos) as nearest_boundary from mx left join ru on ru.rec_id || '#' || ru.first_pos = mx.rec_id || '#' || mx.pos where mx.true_change and not mx.change)"""


BLANK, UNNAMED = 11, 3


def sheet_in_work(s: DataFrame) -> DataFrame:
    """Verdicts from the words' own speaker labels, every 11th boundary blank and every third real one without its speaker."""
    g = ev.gold(s, ev.identity(F.col("asr_speaker")))
    done = F.col("bno") % BLANK != 0
    return g.withColumn("who", F.when(done & (F.col("bno") % UNNAMED != 0), F.col("who"))).withColumn("verdict", F.when(done, F.col("verdict")))


def _judged(spark, d):
    s = write_and_read(the_stream(spark, d), "stream")
    labels = write_and_read(sheet_in_work(s), "gold")
    markers = write_and_read(ev.gold_markers(s, ev.identity(F.col("asr_speaker"))), "markers")
    names = write_and_read(ev.share_map(s, labels, markers), "map")
    return s, labels, names, write_and_read(ev.judged(ev.truth(s, labels, names, markers), names), "judged")


@query(with_ctes(STREAM, _GOLD, 'select rec_id, pos, bno, frm, "to", verdict, who from gold'))
def eval_gold(spark, d):
    """Verdicts at label changes, from the words' own speaker labels."""
    return sheet_in_work(the_stream(spark, d))


@query(with_ctes(STREAM, _GOLD, _MAP, "select rec_id, label, who from mp"))
def eval_share_map(spark, d):
    """Labels mapped to identities by the share rule."""
    s = write_and_read(the_stream(spark, d), "stream")
    return ev.share_map(s, write_and_read(sheet_in_work(s), "gold"), write_and_read(ev.gold_markers(s, ev.identity(F.col("asr_speaker"))), "markers"))


@query(with_ctes(STREAM, _JUDGED, "select rec_id, i, truth, shown, err, coalesce(true_change::int, -1) as true_change from je"))
def eval_truth(spark, d):
    """Truth carried forward, shown identity and error of each word."""
    return _judged(spark, d)[3].select("rec_id", "i", "truth", "shown", "err", F.coalesce(F.col("true_change").cast("int"), F.lit(-1)).alias("true_change"))


@query(with_ctes(STREAM, _JUDGED, "select rec_id, first_i, last_i, n_words, truth, label, direction, cause, high_harm from ru"))
def eval_error_runs(spark, d):
    """Runs of wrong words with direction and cause."""
    return ev.error_runs(_judged(spark, d)[3]).drop("run", "first_pos")


@query(with_ctes(STREAM, _JUDGED, "select rec_id, pos, i, misattributed, direction, nearest_boundary from mi"))
def eval_missed_changes(spark, d):
    """True changes that no label change follows."""
    return ev.missed_changes(_judged(spark, d)[3])


@query(with_ctes(STREAM, _JUDGED, """uw as (select *, sum((not known and not (pk is false and pos > 0))::int) over (partition by rec_id order by pos) as g from je)""", "select rec_id, min(i) as first_i, max(i) as last_i, count(*) as n_words from uw where not known group by rec_id, g"))
def eval_unknown_windows(spark, d):
    """Runs of words whose speaker is unknown."""
    return ev.unknown_windows(_judged(spark, d)[3])


_NEAR_SQL = f"""np as (select rec_id, list(pos order by pos) as ps from gold where verdict = 'spurious' group by rec_id), nq as (select rec_id, list(pos order by pos) as qs from mi group by rec_id),
nr as (select np.rec_id, k::int as words, 1 as i, 1 as j, ps, qs, null::bigint as pos, null::bigint as missed_pos from np join nq on nq.rec_id = np.rec_id, range(1, {ev.NEAR + 1}) r(k)
  union all select rec_id, words, case when qs[j] < ps[i] - words then i else i + 1 end, case when qs[j] > ps[i] + words then j else j + 1 end, ps, qs, case when abs(qs[j] - ps[i]) <= words then ps[i] end, case when abs(qs[j] - ps[i]) <= words then qs[j] end
  from nr where i <= len(ps) and j <= len(qs)),
nm as (select rec_id, words, pos, missed_pos from nr where pos is not null)"""


_E4 = "case when {b} <> 0 then cast(floor({a} / {b} * 10000 + 0.5) as double) end"
_E4F = lambda a, b: _E4.format(a=f"cast({a} as double)", b=f"({b})")


@query("with recursive " + with_ctes(STREAM, _JUDGED, _NEAR_SQL, f"""
sb as (select rec_id, count(*) as boundaries, count(*) filter (verdict = 'real') as "real", count(*) filter (verdict = 'spurious') as spurious, count(*) filter (verdict = 'unsure') as unsure, count(*) filter (verdict is null) as unlabeled from gold group by rec_id),
sv as (select rec_id, count(*) as words, count(*) filter (known) as scored, count(*) filter (err) as wrong, count(*) filter (known and regexp_matches(truth, '^S[2-9]?$')) as student_words, count(*) filter (direction = 'student_as_instructor') as student_as_instructor,
  count(*) filter (direction = 'instructor_as_student') as instructor_as_student, count(*) filter (true_change) as true_changes, count(*) filter (true_change and not change) as missed from je group by rec_id),
sc as (select rec_id, {', '.join(f"coalesce(sum(n_words) filter (cause = '{c}'), 0)::bigint as words_{c}" for c in ('after_unknown', 'wrong_label', 'missed_change', 'spurious_split'))}, count(*) filter (high_harm) as high_harm_runs from ru group by rec_id),
so as (select sv.*, {', '.join(f'coalesce("{c}", 0)::bigint as "{c}"' for c in ('boundaries', 'real', 'spurious', 'unsure', 'unlabeled', 'words_after_unknown', 'words_wrong_label', 'words_missed_change', 'words_spurious_split', 'high_harm_runs'))} from sv left join sb on sb.rec_id = sv.rec_id left join sc on sc.rec_id = sv.rec_id),
sn as (select so.*, coalesce(c1, 0)::bigint as near_misses_1, coalesce(c2, 0)::bigint as near_misses_2, coalesce(c3, 0)::bigint as near_misses_3 from so left join (select rec_id, count(*) filter (words = 1) as c1, count(*) filter (words = 2) as c2, count(*) filter (words = 3) as c3 from nm group by rec_id) n on n.rec_id = so.rec_id)""",
f"""select *, {', '.join(_E4F(f'("real" + near_misses_{k})', '"real" + spurious') + f' as precision_within_{k}_e4' for k in (1, 2, 3))}, {_E4F('"real"', '"real" + spurious')} as precision_e4, {_E4F('("real" + unsure)', 'boundaries - unlabeled')} as precision_unsure_real_e4, {_E4F('(scored - wrong)', 'scored')} as accuracy_e4, {_E4F('student_as_instructor', 'student_words')} as student_share_e4 from sn""")[5:])
def eval_score(spark, d):
    """The score block of each recording."""
    _, labels, _, j = _judged(spark, d)
    return ev.score(j, labels)


@query(with_ctes(STREAM, _JUDGED, "vp as (select *, max(coalesce(true_change, false)::int) over (partition by rec_id order by pos rows between 3 preceding and 3 following) as close from je)", """
select coalesce(g.verdict, 'unlabeled') as verdict, case when true_change is null then 'unknown' when true_change then 'at_true_change' when close = 1 then 'near_true_change' else 'none_nearby' end as place, count(*) as n
from gold g join vp on vp.rec_id || '#' || vp.pos = g.rec_id || '#' || g.pos group by all"""))
def eval_verdict_places(spark, d):
    """Verdicts against the place of true changes."""
    _, labels, _, j = _judged(spark, d)
    return ev.verdict_places(j, labels)


@query("with recursive " + STREAM + ",\n" + _JUDGED + ",\n" + _NEAR_SQL + "\nselect * from nm")
def eval_near_misses(spark, d):
    """Spurious boundaries and the missed changes within one to three words that explain them."""
    _, labels, _, j = _judged(spark, d)
    return ev.near_misses(labels, ev.missed_changes(j), ev.NEAR)


_ID_LIST = "[" + _Q(al.IDENTITIES) + "]"
#: All pairings of a recording's labels, label by label; a label is paired only where it shares words.
_PAIRED = lambda words: f"""aw as ({words}),
ak as (select rec_id, label, row_number() over (partition by rec_id order by label) as k from (select distinct rec_id, speaker as label from stm where speaker is not null)),
ao as (select rec_id, label, who, n, list_position({_ID_LIST}, who) as p from aw),
ax as (select distinct rec_id, 0::bigint as k, 0::bigint as total, []::integer[] as picks from ak
  union all select ax.rec_id, ax.k + 1, ax.total + coalesce(o.n, 0), list_append(ax.picks, coalesce(o.p, 99)::integer) from ax join ak on ak.rec_id = ax.rec_id and ak.k = ax.k + 1
  join (select rec_id, label, p, n from ao union all select rec_id, label, null, 0 from ak) o on o.rec_id = ak.rec_id and o.label = ak.label where o.p is null or not list_contains(ax.picks, o.p)),
ay as (select rec_id, picks from (select *, row_number() over (partition by rec_id order by total desc, picks) as rn from ax where k = (select max(k) from ak where ak.rec_id = ax.rec_id)) where rn = 1),
om as (select ak.rec_id, ak.label, case when ay.picks[ak.k] < 99 then {_ID_LIST}[ay.picks[ak.k]] else coalesce((select arg_min(who, (-n, p)) from ao where ao.rec_id = ak.rec_id and ao.label = ak.label), 'L') end as who, ay.picks[ak.k] < 99 as paired from ak join ay on ay.rec_id = ak.rec_id)"""  # noqa: E731


@query("with recursive " + with_ctes(STREAM, _PAIRED(f"select rec_id, speaker as label, {_WHO} as who, count(*) as n from stm where speaker is not null and {_WHO} is not null group by all"), "select * from om")[5:])
def map_one_to_one(spark, d):
    """Labels paired one to one with identities, the rest folded."""
    s = the_stream(spark, d).withColumn("truth", ev.identity(F.col("asr_speaker")))
    labels = s.where("speaker is not null").select("rec_id", F.col("speaker").alias("label")).distinct()
    return al.one_to_one(labels.join(ev.shared_words(s), ["rec_id", "label"], "left"))


_RECALL = "with " + _cand_sql(1) + ",\n" + _JUDGED + """,
er as (select rec_id, 'missed' as kind, pos as t, misattributed, coalesce(direction = 'student_as_instructor', false) as high_harm from mi union all select rec_id, 'spurious', pos, 0, false from gold where verdict = 'spurious'),
sf as (select er.rec_id, er.kind, er.t, er.misattributed, er.high_harm, list_sort(list_distinct(list(ca.class) filter (ca.class is not null))) as classes from er left join ca on ca.rec_id = er.rec_id and ca.a < er.t and er.t <= ca.b group by all)"""


def _surfaced(spark, d):
    """Windows, wrong transitions by sheet_in_work(), and these with the windows that hold them: all of one table that is written once."""
    w = write_and_read(cd.windows_of(the_words(spark, d), the_turns(spark, d), 1, ev.identity(F.col("speaker")), BLANK, UNNAMED), "windows")
    found, errs = cd.found_windows(w, 1), cd.wrong(w)
    return found, errs, ev.surfaced(errs, found)


@query(_RECALL + """
select g as "group", count(*) as total, count(*) filter (len(classes) > 0) as surfaced, cast(floor(cast(count(*) filter (len(classes) > 0) as double) / count(*) * 10000 + 0.5) as double) as recall_e4
from (select classes, unnest(list_filter(['overall', case when kind = 'missed' then 'missed' end, case when kind = 'missed' and misattributed > 0 then 'missed_misattributing' end, case when kind = 'spurious' then 'spurious' end, case when high_harm then 'high_harm' end], lambda x: x is not null)) as g from sf) group by g""")
def eval_recall(spark, d):
    """Share of the wrong transitions that candidate windows hold."""
    return ev.recall(_surfaced(spark, d)[2])


@query(_RECALL + """,
k1 as (select class, count(*) as windows, count(*) filter (exists (select 1 from er where er.rec_id = ca.rec_id and ca.a < er.t and er.t <= ca.b)) as with_error from ca group by class),
k2 as (select c as class, count(*) as surfaced, count(*) filter (n = 1) as only_this from (select unnest(classes) as c, len(classes) as n from sf) group by c)
select k1.class, k1.windows, k1.with_error, coalesce(k2.surfaced, 0) as surfaced, coalesce(k2.only_this, 0) as only_this from k1 left join k2 on k2.class = k1.class""")
def eval_class_report(spark, d):
    """What each class of windows surfaces."""
    found, errs, by = _surfaced(spark, d)
    return ev.class_report(by, found, errs)


_UNITS = [("class", c, cd.FAMILY[c], [c]) for c in cd.ORDER[1]] + [("group", f, f, [c for c in cd.ORDER[1] if cd.FAMILY[c] == f]) for f in ("split", "merge")] + [("group", "everything but shift", None, [c for c in cd.ORDER[1] if c != "shift"])]
_KINDS_SQL = {"all": "true", "missed": "kind = 'missed'", "missed_misattributing": "kind = 'missed' and misattributed > 0", "spurious": "kind = 'spurious'", "high_harm": "high_harm"}


@query(_RECALL + ",\n" + _DUR + ",\nun as (select * from (values " + ", ".join(f"('{lv}', '{n}', {repr(f) if f else 'null'}, [{_Q(m)}])" for lv, n, f, m in _UNITS) + f""") v(level, name, family, members)),
hr as (select sum(duration_s) / 3600 as hours from du where rec_id in (select rec_id from w0)),
uw as (select un.level, un.name, ca.*, coalesce(max(b) over (partition by un.level, un.name, rec_id order by a, b, class, att rows between unbounded preceding and 1 preceding), -1) as past, exists (select 1 from er where er.rec_id = ca.rec_id and ca.a < er.t and er.t <= ca.b) as bad from un join ca on list_contains(un.members, ca.class)),
uv as (select level, name, count(*) as windows, sum(greatest(b - greatest(a, past + 1) + 1, 0))::bigint as words_covered, count(*) filter (bad) as with_error from uw group by level, name),
ue as (select un.level, un.name, {', '.join(f"count(*) filter ({c}) as surfaced_{k}, count(*) filter (({c}) and list_has_all(un.members, sf.classes)) as only_{k}" for k, c in _KINDS_SQL.items())} from un join sf on list_has_any(un.members, sf.classes) group by un.level, un.name)
select un.level, un.name, un.family, coalesce(windows, 0) as windows, cast(floor(case when hours > 0 then coalesce(windows, 0) / hours end * 10 + 0.5) as bigint) as per_hour_tenths, coalesce(words_covered, 0) as words_covered, {', '.join(f"coalesce({x}_{k}, 0) as {x}_{k}" for x in ("surfaced", "only") for k in _KINDS_SQL)}, coalesce(with_error, 0) as with_error,
  {_E4F("coalesce(with_error, 0)", "coalesce(windows, 0)")} as with_error_e4 from un left join uv on uv.level = un.level and uv.name = un.name left join ue on ue.level = un.level and ue.name = un.name, hr""")
def eval_class_stats(spark, d):
    """Volume, coverage, rate and errors surfaced per kind, by class of windows and by group of classes."""
    found, errs, by = _surfaced(spark, d)
    hours = durations(spark, d).join(load(spark, d, "words").where("rec_id is not null and i is not null").select("rec_id").distinct(), "rec_id", "left_semi")
    return ev.class_stats(by, found, errs, hours, cd.ORDER[1], cd.FAMILY)


@query("with " + _cand_sql(2) + ",\n" + _SITES + ",\nsl as (select list_sort(list(b - a + 1)) as l, count(*) as n from st)\nselect n, l[1] as min, (l[1 + (n - 1) // 2] + l[1 + n // 2]) / 2 as median, l[1 + least(n - 1, cast(floor(n * 0.9) as bigint))] as p90, l[-1] as max from sl")
def agg_site_lengths(spark, d):
    """Least, median, 90th and greatest site length."""
    return ev.site_lengths(cd.sites(_found(spark, d, 2)[1]))


# -- timeline ----------------------------------------------------------------------------------
from streamloom.operators import timeline as tl  # noqa: E402


@query(with_ctes(WORDS, "ds as (select rec_id, i, start_s, last_value(end_s ignore nulls) over (partition by rec_id order by pos rows between unbounded preceding and 1 preceding) as le from sp)", "select rec_id, i, coalesce(start_s, le, 0.0) as start_s from ds"))
def win_derived_starts(spark, d):
    """Null starts from the end before."""
    return tl.derived_starts(st.spoken(the_words(spark, d))).select("rec_id", "i", "start_s")


def _clocked(spark, d) -> DataFrame:
    """Texts whose words carry their ends modulo ten seconds."""
    w = st.spoken(the_words(spark, d)).where("end_s is not null and end_s >= 0 and not contains(text, '[')")
    tag = F.concat(F.col("text"), F.lit(" [T:"), (F.floor(F.col("end_s") * 100 + 0.5) % 1000).cast("string"), F.lit("]"))
    return w.groupBy("rec_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", tag.alias("t")))), lambda x: x["t"]), " ").alias("text"))


@query(with_ctes(WORDS, """ct as (select rec_id, row_number() over (partition by rec_id order by pos) - 1 as k, text, cast(floor(end_s * 100 + 0.5) as bigint) % 1000 as n from sp where end_s is not null and end_s >= 0 and not contains(text, '[')),
cu as (select *, coalesce((n < lag(n) over (partition by rec_id order by k))::int, 0) as roll from ct)""", "select rec_id, k, text as token, round(n / 100.0 + 10.0 * sum(roll) over (partition by rec_id order by k), 3)::double as end_s from cu"))
def win_unrolled(spark, d):
    """Absolute ends out of rolled-over clock tags in a text."""
    return tl.unrolled(_clocked(spark, d)).select("rec_id", "k", "token", "end_s")


@query(with_ctes(WORDS, """tg as (select rec_id, pos, text, regexp_matches(text, '^\\[Speaker \\d+\\]:$') as tag from sp where not contains(text, '[') or regexp_matches(text, '^\\[Speaker \\d+\\]:$')),
th as (select *, sum(tag::int) over (partition by rec_id order by pos) as g from tg),
ti as (select rec_id, g, max(case when tag then regexp_extract(text, '(Speaker \\d+)', 1) end) as label, coalesce(string_agg(case when not tag then text end, ' ' order by pos), '') as segment from th group by rec_id, g)""",
"select rec_id, row_number() over (partition by rec_id order by g) - 1 as seg, label, segment from ti where label is not null or segment <> ''"))
def win_tagged_segments(spark, d):
    """Segments of texts with speaker tags."""
    w = st.spoken(the_words(spark, d)).where("not contains(text, '[') or text rlike '^\\\\[Speaker \\\\d+\\\\]:$'")
    texts = w.groupBy("rec_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), " ").alias("text"))
    return tl.tagged_segments(texts).select("rec_id", "seg", "label", "segment")


@query(with_ctes(WORDS, """lw as (select *, row_number() over (partition by rec_id order by i) - 1 as pos from ws),
lx as (select *, coalesce(last_value(end_s ignore nulls) over (partition by rec_id order by pos rows between unbounded preceding and 1 preceding), 0.0) as st0 from lw),
ly as (select *, lag(asr_speaker) over v as pl, lag(pos) over v as pp from lx where not is_silence window v as (partition by rec_id order by pos)),
lz as (select *, sum((pp is null or pl is distinct from asr_speaker)::int) over (partition by rec_id order by pos) as turn from ly)""",
"select rec_id, turn::bigint as turn, arg_min_null(asr_speaker, pos) as speaker, arg_min(st0, pos) as start_s, coalesce(arg_max(end_s, pos) filter (end_s is not null), arg_min(st0, pos)) as end_s from lz group by rec_id, turn"))
def win_turns_from_labels(spark, d):
    """Word labels collapsed to time ranges."""
    w = the_words(spark, d).withColumn("silence", F.array_contains("flags", "silence")).withColumn("pos", F.row_number().over(st.Window.partitionBy("rec_id").orderBy("i")) - 1)
    return tl.turns_from_labels(w, "speaker").select("rec_id", "turn", "speaker", "start_s", "end_s")


_DURS = "du as (select rec_id, max(duration_s) as duration_s from recordings where rec_id is not null group by rec_id)"


@query("with " + _DURS + " select rec_id, k::int as k, (k * 60)::double as start_s, least((k + 1) * 60, duration_s) as end_s from (select *, unnest(range(0, case when duration_s <= 60 then 1 else ceil(duration_s / 60)::bigint end)) as k from du where duration_s is not null and duration_s >= 0)")
def win_fixed_windows(spark, d):
    """One-minute windows of each recording."""
    return tl.fixed_windows(durations(spark, d), 60.0)


@query("with recursive " + _DURS + """, w as (select rec_id, k::int as k, 0 as depth, (k * 300)::double as s, least((k + 1) * 300, duration_s) as e from (select *, unnest(range(0, case when duration_s <= 300 then 1 else ceil(duration_s / 300)::bigint end)) as k from du where duration_s is not null and duration_s >= 0)),
r as (select * from w union all select rec_id, k, depth + 1, case when h = 0 then s else s + (e - s) / 2 end, case when h = 0 then s + (e - s) / 2 else e end from r, (values (0), (1)) t(h) where depth < 3 and (e - s) / 2 >= 30 and floor(s / 40)::bigint % 2 = 0)
select rec_id, k, depth, s as start_s, e as end_s, floor(s / 40)::bigint % 2 = 0 as lost from r where not (depth < 3 and (e - s) / 2 >= 30 and floor(s / 40)::bigint % 2 = 0)""")
def win_retried_windows(spark, d):
    """Failing windows halved; those that start in an even stretch of 40 s count as failing."""
    return tl.retried_windows(tl.fixed_windows(durations(spark, d)), F.floor(F.col("start_s") / 40) % 2 == 0)


@query("with " + _DURS + """, e as (select * from (select *, row_number() over (partition by rec_id, err_ord order by loaded_at nulls last) as rn from error_ranges where rec_id is not null and err_ord is not null) where rn = 1 and end_s >= start_s),
g as (select rec_id, count(*) as n, sum(floor((end_s - start_s) * 1000 + 0.5))::bigint as lost_ms from e group by rec_id)
select g.rec_id, n, lost_ms, case when duration_s > 0 then cast(floor(lost_ms / (duration_s * 1000) * 10000 + 0.5) as double) end as share_e4 from g left join du on du.rec_id = g.rec_id""")
def agg_lost_time(spark, d):
    """Lost time of each recording."""
    e = st.once(load(spark, d, "error_ranges").select("rec_id", "err_ord", "start_s", "end_s", "loaded_at"), ["rec_id", "err_ord"])
    return tl.lost_time(e, durations(spark, d))


@query(with_ctes(WORDS, TURNS, "pj as (select sp.rec_id, sp.i, tn.speaker, row_number() over (partition by sp.rec_id, sp.i order by case when tn.start_s <= sp.start_s and sp.start_s < tn.end_s then -1.0 else least(abs(sp.start_s - tn.start_s), abs(sp.start_s - tn.end_s)) end, tn.ord) as rn from sp join tn on tn.rec_id = sp.rec_id where sp.start_s is not null)", "select rec_id, i, speaker as speaker_at from pj where rn = 1"))
def join_point_speakers(spark, d):
    """The preview's point lookup of speakers."""
    return tl.point_speakers(st.spoken(the_words(spark, d)), the_turns(spark, d)).where("speaker_at is not null").select("rec_id", "i", "speaker_at")


@query(with_ctes(STREAM, """rl as (select *, lag(speaker) over (partition by rec_id order by ord) as pv from tn), rr as (select *, sum((pv is distinct from speaker)::int) over (partition by rec_id order by ord) as run from rl),
rt as (select rr.rec_id, rr.run, bool_or(hit.speaker = asg.speaker_raw) as won from hit join rr on rr.rec_id || '#' || rr.ord = hit.rec_id || '#' || hit.ord join asg on asg.rec_id || '#' || asg.pos = hit.rec_id || '#' || hit.pos group by all),
rg as (select rec_id, pos, run from (select asg.rec_id, asg.pos, rr.run, row_number() over (partition by asg.rec_id, asg.pos order by least(abs((asg.start_s + asg.end_s) / 2 - rr.start_s), abs((asg.start_s + asg.end_s) / 2 - rr.end_s)), rr.ord) as rn
  from asg join rr on rr.rec_id = asg.rec_id where asg.start_s is not null and asg.end_s is not null and asg.rec_id || '#' || asg.pos not in (select rec_id || '#' || pos from hit)) where rn = 1),
rs as (select rr.rec_id, rr.run, min(rr.speaker) as speaker from rr group by all),
ru as (select rs.*, rt.run is not null as touched, coalesce(rt.won, false) or exists (select 1 from rg where rg.rec_id = rs.rec_id and rg.run = rs.run) as kept from rs left join rt on rt.rec_id || '#' || rt.run = rs.rec_id || '#' || rs.run),
rk as (select *, last_value(case when kept then speaker end ignore nulls) over (partition by rec_id order by run rows between unbounded preceding and 1 preceding) as lk from ru)""",
"select rec_id, count(*) - 1 as raw_changes, count(*) as runs, count(*) filter (not kept and not touched) as empty, count(*) filter (not kept and touched) as outvoted, count(*) filter (kept and lk is not null and lk <> speaker) as kept_changes from rk group by rec_id"))
def agg_raw_accounting(spark, d):
    """Raw label runs kept, empty and outvoted."""
    words, turns = st.spoken(the_words(spark, d)), the_turns(spark, d)
    return tl.raw_accounting(st.assigned(words, turns), turns, st.hits(words, turns))


@query(with_ctes(STREAM, "select rec_id, count(*) filter (change) as changes, count(*) filter (flipped) as flipped from stm group by rec_id"))
def agg_label_changes(spark, d):
    """Label changes and smoothed words of each stream."""
    return the_stream(spark, d).groupBy("rec_id").agg(F.count_if("change").alias("changes"), F.count_if("flipped").alias("flipped"))


@query(with_ctes(STREAM, "bh as (select rec_id, boundary, count(*) as n from stm where boundary is not null group by all)", "select s.rec_id, s.turns, s.sentences, coalesce(s.speakers, '') as speakers, b.boundaries from (select rec_id, max(stretch) + 1 as turns, max(sent) + 1 as sentences, array_to_string(list_sort(list_distinct(list(speaker) filter (speaker is not null))), ',') as speakers from stm group by rec_id) s join (select rec_id, string_agg(boundary || ' ' || n, ', ' order by boundary) as boundaries from bh group by rec_id) b on b.rec_id = s.rec_id"))
def agg_segment_stats(spark, d):
    """Turns, sentences, speakers and the boundary histogram of each stream."""
    s = the_stream(spark, d)
    h = s.where("boundary is not null").groupBy("rec_id", "boundary").agg(F.count("*").alias("n"))
    h = h.groupBy("rec_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("boundary", "n"))), lambda x: F.concat(x["boundary"], F.lit(" "), x["n"].cast("string"))), ", ").alias("boundaries"))
    a = s.groupBy("rec_id").agg((F.max("stretch") + 1).alias("turns"), (F.max("sent") + 1).alias("sentences"), F.array_join(F.sort_array(F.collect_set("speaker")), ",").alias("speakers"))
    return a.join(h, "rec_id")


@query()
def win_anchors(spark, d):
    """Time marks inside turns longer than half a minute."""
    return tl.anchors(the_stream(spark, d), 30.0)


@query()
def ren_preview(spark, d):
    """Preview lines of each recording."""
    words = tl.point_speakers(st.spoken(the_words(spark, d)).drop("speaker"), the_turns(spark, d)).withColumnRenamed("speaker_at", "speaker")
    return tl.preview_lines(words)


@query("with " + _DURS + """, k as (select *, unnest(range(0, floor(duration_s / 0.35)::bigint + 1)) as k from du where duration_s > 0), s as (select *, k * (0.35::double + 0.05::double) + floor(k / 8.0) * (0.6::double - 0.05::double) as s from k)
select rec_id, k::int as i, (['one', '[UM]', 'two', 'thr-', 'three.'])[k % 5 + 1] as text from s where s + 0.35::double <= duration_s + 1e-9""")
def src_script_words(spark, d):
    """The deterministic word source over each recording's duration."""
    return tl.script_words(durations(spark, d), ["one", "[UM]", "two", "thr-", "three."]).select("rec_id", "i", "text")


# -- records, files, quality, calendar, rendering, arms, sessions ------------------------------
from pyspark.sql import Window  # noqa: E402

from streamloom import streaming  # noqa: E402
from streamloom.functions import times as tm  # noqa: E402
from streamloom.operators import arms as ar  # noqa: E402
from streamloom.operators import compare as cp  # noqa: E402
from streamloom.operators import calendar as ca  # noqa: E402
from streamloom.operators import quality as ql  # noqa: E402
from streamloom.operators import render as rd  # noqa: E402
from streamloom.operators.shared import shared_dir  # noqa: E402
from streamloom.sources import intervals as si  # noqa: E402
from streamloom.sources import records as sr  # noqa: E402


def _all_words(spark, d):
    return st.once(load(spark, d, "words"), ["rec_id", "i"])


def _records(spark, d):
    r = st.once(load(spark, d, "recordings"), ["rec_id"])
    turns = st.once(load(spark, d, "speaker_turns"), ["rec_id", "turn_ord"])
    errs = st.once(load(spark, d, "error_ranges"), ["rec_id", "err_ord"])
    return sr.assembled(r, _all_words(spark, d), turns, errs)


_W1 = "w as (select * from (select *, row_number() over (partition by rec_id, i order by loaded_at nulls last) as rn from words where rec_id is not null and i is not null) where rn = 1)"


@query("with " + _W1 + """, r as (select * from (select *, row_number() over (partition by rec_id order by loaded_at nulls last) as rn from recordings where rec_id is not null) where rn = 1),
wa as (select rec_id, count(*) as n, count(start_s) as timed, sha256(string_agg(i || ':' || coalesce(text, '') || ':' || coalesce(speaker, '') || ':' || coalesce(array_to_string(flags, ','), '') || ':' || coalesce(cast(round(end_s * 1000) as bigint)::varchar, ''), ' ' order by i)) as h from w group by rec_id),
t as (select * from (select *, row_number() over (partition by rec_id, turn_ord order by loaded_at nulls last) as rn from speaker_turns where rec_id is not null and turn_ord is not null) where rn = 1),
ta as (select rec_id, count(*) as n, sha256(string_agg(coalesce(cast(round(start_s * 1000) as bigint)::varchar, '') || '-' || coalesce(cast(round(end_s * 1000) as bigint)::varchar, '') || ':' || coalesce(speaker, ''), ' ' order by turn_ord)) as h from t group by rec_id),
e as (select rec_id, count(distinct err_ord) as n, sha256(string_agg(distinct message, ' ' order by message)) as h from error_ranges where rec_id is not null and err_ord is not null group by rec_id)
select r.rec_id, r.model_id, coalesce(wa.n, 0) as n_words, coalesce(wa.timed, 0) as n_timed, coalesce(ta.n, 0) as n_turns, coalesce(e.n, 0) as n_errors, wa.h as words_sha256, ta.h as turns_sha256, sha256(r.text) as text_sha256
from r left join wa on wa.rec_id = r.rec_id left join ta on ta.rec_id = r.rec_id left join e on e.rec_id = r.rec_id""")
def src_records_round_trip(spark, d):
    """Records put together, written as JSON, read and taken apart again: their words, turns and texts, by number and hash."""
    path = shared_dir(spark, "records")
    sr.write_records(_records(spark, d), path)
    back, _ = sr.read_records(spark, path, lines=True)
    ms = lambda c: F.coalesce(F.round(F.col(c) * 1000).cast("long").cast("string"), F.lit(""))
    text = lambda c: F.coalesce(c, F.lit(""))
    word = F.concat_ws(":", F.col("i").cast("string"), text(F.col("text")), text(F.col("speaker")), text(F.array_join("flags", ",")), ms("end"))
    turn = F.concat(ms("start_s"), F.lit("-"), ms("end_s"), F.lit(":"), text(F.col("speaker")))
    told = lambda order, piece: F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, piece.alias("p")))), lambda x: x["p"]), " "), 256)
    w = sr.words_of(back).groupBy("rec_id").agg(F.count("*").alias("n_words"), F.count("start").alias("n_timed"), told("i", word).alias("words_sha256"))
    t = sr.turns_of(back).groupBy("rec_id").agg(F.count("*").alias("n_turns"), told("turn_ord", turn).alias("turns_sha256"))
    e = sr.errors_of(back).groupBy("rec_id").agg(F.count("*").alias("n_errors"))
    out = back.select("rec_id", F.col("asr.model_id").alias("model_id"), F.sha2("text", 256).alias("text_sha256")).join(w, "rec_id", "left").join(t, "rec_id", "left").join(e, "rec_id", "left")
    return out.fillna(0, ["n_words", "n_timed", "n_turns", "n_errors"])


_DOC_KEYS = {"source.audio_path": "audio_path", "source.audio_sha256": "audio_sha256", "source.duration_s": "duration_s", "asr.model_id": "model_id", "asr.revision": None, "asr.capabilities": None, "asr.params": None, "asr.performance": None, "run.created_utc": "created_utc", "run.device": "device", "run.pipeline_version": None}
_TURN_RULES = lambda t, name, keys: " ".join(f"union all select rec_id, '{name}_without_{k}' from {t} where {c} is null" for k, c in keys)
_ONCE = lambda table, key: f"(select * from (select *, row_number() over (partition by rec_id, {key} order by loaded_at nulls last) as rn from {table} where rec_id in (select rec_id from recordings) and {key} is not null) where rn = 1)"


@query("with " + f"w as {_ONCE('words', 'i')}, tt as {_ONCE('speaker_turns', 'turn_ord')}, ee as {_ONCE('error_ranges', 'err_ord')}" + """,
r as (select * from (select *, row_number() over (partition by rec_id order by loaded_at nulls last) as rn from recordings where rec_id is not null) where rn = 1),
x as (select *, row_number() over (partition by rec_id order by i) - 1 as n, last_value(start_s ignore nulls) over (partition by rec_id order by i rows between unbounded preceding and 1 preceding) as bef from w)
select rule, count(*) as n, count(distinct rec_id) as n_recs from (
select rec_id, 'word_index' as rule from x where i <> n union all select rec_id, 'word_text' from x where text is null union all select rec_id, 'timing_source' from x where coalesce(timing_source, '?') not in ('native', 'derived', 'aligned', 'none')
union all select rec_id, 'speaker_source' from x where speaker_source is not null and speaker_source <> 'asr' union all select rec_id, 'speaker_and_source' from x where (speaker is null) <> (speaker_source is null)
union all select rec_id, 'end_before_start' from x where end_s < start_s union all select rec_id, 'start_goes_back' from x where start_s < bef
""" + _TURN_RULES("tt", "turn", [("start", "start_s"), ("end", "end_s"), ("speaker", "speaker")]) + " " + _TURN_RULES("ee", "error", [("start", "start_s"), ("end", "end_s"), ("message", "message")]) + " " + " ".join(f"union all select rec_id, 'missing_{k}' from r" + (f" where {c} is null" if c else "") for k, c in _DOC_KEYS.items()) + " union all select rec_id, 'granularity' from r where coalesce(granularity, '?') not in ('word', 'segment')) group by rule")
def dq_documents(spark, d):
    """Breaches of the rules of whole record documents, as the writer tells them."""
    b = sr.write_records(_records(spark, d), shared_dir(spark, "records"))
    return b.groupBy("rule").agg(F.count("*").alias("n"), F.count_distinct("rec_id").alias("n_recs"))


_RT = TURNS + ", rt as (select rec_id, start_s, round(end_s - start_s, 3) as dur, replace(speaker, ' ', '_') as speaker from tn)"


@query("with " + _RT + " select rec_id, row_number() over (partition by rec_id order by start_s, e, speaker) - 1 as turn_ord, start_s, e as end_s, speaker from (select *, round(start_s + dur, 6) as e from rt)")
def src_rttm(spark, d):
    """Turns written as RTTM lines and read again."""
    t = the_turns(spark, d)
    line = F.concat_ws(" ", F.lit("SPEAKER"), "rec_id", F.lit("1"), F.col("start_s").cast("string"), F.round(F.col("end_s") - F.col("start_s"), 3).cast("string"), F.lit("<NA>"), F.lit("<NA>"), F.replace("speaker", F.lit(" "), F.lit("_")), F.lit("<NA>"), F.lit("<NA>"))
    return si.convert(t.select("rec_id", F.col("ord").alias("n"), line.alias("line")), "rttm")[0].select("rec_id", "turn_ord", "start_s", "end_s", "speaker")


@query(with_ctes(TURNS, "select rec_id, row_number() over (partition by rec_id order by start_s, end_s, speaker) - 1 as turn_ord, start_s, end_s, speaker from tn"))
def src_turns_json(spark, d):
    """Turns written as JSON lists and read again."""
    t = the_turns(spark, d).groupBy("rec_id").agg(F.to_json(F.collect_list(F.struct(F.col("start_s").alias("start"), F.col("end_s").alias("end"), "speaker"))).alias("text"))
    return si.convert(t, "turns-json")[0].select("rec_id", "turn_ord", "start_s", "end_s", "speaker")


@query("""with w as (select * from (select *, row_number() over (partition by rec_id, i order by loaded_at nulls last) as rn from words where rec_id is not null and i is not null) where rn = 1),
x as (select *, row_number() over (partition by rec_id order by i) - 1 as n, last_value(start_s ignore nulls) over (partition by rec_id order by i rows between unbounded preceding and 1 preceding) as bef from w)
select rule, count(*) as n, count(distinct rec_id) as n_recs from (
select rec_id, 'word_index' as rule from x where i <> n union all select rec_id, 'word_text' from x where text is null union all select rec_id, 'timing_source' from x where coalesce(timing_source, '?') not in ('native', 'derived', 'aligned', 'none')
union all select rec_id, 'speaker_source' from x where speaker_source is not null and speaker_source <> 'asr' union all select rec_id, 'speaker_and_source' from x where (speaker is null) <> (speaker_source is null)
union all select rec_id, 'end_before_start' from x where end_s < start_s union all select rec_id, 'start_goes_back' from x where start_s < bef
union all select rec_id, rule from (select *, row_number() over (partition by rec_id order by loaded_at nulls last) as rn from recordings where rec_id is not null), lateral (select unnest([case when audio_path is null then 'missing_audio_path' end, case when audio_sha256 is null then 'missing_audio_sha256' end, case when duration_s is null then 'missing_duration_s' end, case when model_id is null then 'missing_model_id' end, case when created_utc is null then 'missing_created_utc' end, case when device is null then 'missing_device' end, case when coalesce(granularity, '?') not in ('word', 'segment') then 'granularity' end]) as rule) where rn = 1 and rule is not null) group by rule""")
def dq_breaches(spark, d):
    """Breaches of the record and word rules."""
    b = ql.word_breaches(_all_words(spark, d)).unionByName(ql.record_breaches(st.once(load(spark, d, "recordings"), ["rec_id"])))
    return b.groupBy("rule").agg(F.count("*").alias("n"), F.count_distinct("rec_id").alias("n_recs"))


SEMESTERS = [("F25", "2025-08-25", "2025-12-19"), ("S26", "2026-01-12", "2026-05-29"), ("X26", "2026-05-29", "2026-08-14"), ("F26", "2026-08-24", "2026-12-11")]
_SEM = "sem as (select * from (values " + ", ".join(f"('{t}', date '{a}', date '{b}')" for t, a, b in SEMESTERS) + ') v(term, "start", "end"))'


def semesters(spark):
    s = spark.createDataFrame(SEMESTERS, "term string, start string, end string")
    return s.select("term", F.to_date("start").alias("start"), F.to_date("end").alias("end"))


def _days(spark, d):
    r = st.once(load(spark, d, "recordings").select("rec_id", "recorded_date", "recorded_start", "duration_s", "loaded_at"), ["rec_id"])
    start = tm.clock_seconds(F.col("recorded_start"))
    return r.select("rec_id", tm.any_date(F.col("recorded_date")).alias("day"), start.alias("span_start"), (start + F.col("duration_s")).alias("span_end"))


_DAYS = "dy as (select rec_id, try_cast(regexp_replace(trim(recorded_date), '^(\\d{4})\\D?(\\d{2})\\D?(\\d{2})$', '\\1-\\2-\\3') as date) as day from (select *, row_number() over (partition by rec_id order by loaded_at nulls last) as rn from recordings where rec_id is not null) where rn = 1)"


@query("with " + _SEM + ", " + _DAYS + """, hs as (select dy.rec_id, min_by(sem.term, sem."start") as term, min(sem."start") as term_start from dy join sem on dy.day between sem."start" and sem."end" group by dy.rec_id)
select dy.rec_id, cast(dy.day as varchar) as day, hs.term, coalesce((floor(date_diff('day', hs.term_start, dy.day) / 7) + 1)::int, -1) as week from dy left join hs on hs.rec_id = dy.rec_id""")
def join_semester(spark, d):
    """Semester and week of each recording."""
    x = ca.with_semester(_days(spark, d), semesters(spark))
    return x.select("rec_id", F.col("day").cast("string").alias("day"), "term", F.coalesce("week", F.lit(-1)).alias("week"))


_CLOCK = lambda c: f"list_reduce(list_transform(string_split(trim({c}), ':'), lambda p: try_cast(trim(p) as double)), lambda a, p: a * 60 + p)"
_SPANS = f"""dz as (select dy.rec_id, dy.day, {_CLOCK('r.recorded_start')} as span_start, {_CLOCK('r.recorded_start')} + r.duration_s as span_end from dy join (select * from (select *, row_number() over (partition by rec_id order by loaded_at nulls last) as rn from recordings where rec_id is not null) where rn = 1) r on r.rec_id = dy.rec_id)"""


def _course_sql(name: str, days: str, key: str) -> str:
    """CTEs that give each row of `days` (key, day, span_start, span_end) its semester, week, course and why there is none."""
    return f"""{name}h as (select x.{key}, min_by(sem.term, sem."start") as term, min(sem."start") as t0 from {days} x join sem on x.day between sem."start" and sem."end" group by x.{key}),
{name}c as (select distinct term, course_code, wd, {_CLOCK('t0')} as c0, {_CLOCK('t1')} as c1 from (select term, course_code, unnest(weekdays) as wd, t0, t1 from courses)),
{name}x as (select x.*, h.term, (floor(date_diff('day', h.t0, x.day) / 7) + 1)::int as week, strftime(x.day, '%a') as wd from {days} x left join {name}h h on h.{key} = x.{key}),
{name}j as (select x.{key}, c.*, least(x.span_end, c.c1) - greatest(x.span_start, c.c0) as ov from {name}x x join {name}c c on c.term = x.term and c.wd = x.wd),
{name}k as (select *, max(ov) over (partition by {key}) as best from {name}j),
{name}g as (select {key}, count(*) as n, max((c0 is null or c1 is null)::int) as untimed, max(best) as best, count(*) filter (ov = best) as winners, min(course_code) as only_one, min(course_code) filter (ov = best) as winner from {name}k group by {key}),
{name}w as (select x.*, case when g.n is null then 'no_class' when g.n = 1 then null when g.untimed = 1 then 'untimed' when x.span_start is null then 'no_span' when g.best <= 0 then 'no_overlap' when g.winners > 1 then 'tie' end as why, case when g.n = 1 then only_one else winner end as told from {name}x x left join {name}g g on g.{key} = x.{key}),
{name} as (select *, case when why is null then told end as course from {name}w)"""


@query("with " + _SEM + ", " + _DAYS + ", " + _SPANS + ", " + _course_sql("cr", "dz", "rec_id") + " select rec_id, term, week, course, why from cr")
def join_course(spark, d):
    """Course of each recording by weekday and span, or why none is told."""
    return ca.with_course(ca.with_semester(_days(spark, d), semesters(spark)), load(spark, d, "courses"), "rec_id").select("rec_id", "term", "week", "course", "why")


@query("with " + _SEM + ", " + _DAYS + ", " + _SPANS + """, nf as (select strftime(day, '%y%m%d') || '_' || lpad((row_number() over (partition by day order by rec_id))::varchar, 4, '0') || '.WAV' as name, day, span_start, span_end, row_number() over (partition by day order by rec_id) as seq, count(*) over (partition by day) as per_day from dz where day is not null),
""" + _course_sql("cr", "nf", "name") + """,
pl as (select name, case when term is null then 'no_semester' else why end as why, 'LEC' || course || '-' || term || '-WK' || week || '-' || wd || case when per_day > 1 then '-' || seq else '' end || '-' || day::varchar || '.wav' as target from cr),
pm as (select name, why, case when why is null then target end as target, row_number() over (partition by target, why is null order by name) as claim from pl)
select name, case when claim = 1 and why is null then target end as target, case when why is null and claim > 1 then 'claimed' else why end as why from pm""")
def plan_rename(spark, d):
    """New names for recorder files named after each recording's day (those without a day have no recorder file)."""
    x = _days(spark, d).where("day is not null")
    n = F.row_number().over(Window.partitionBy("day").orderBy("rec_id"))
    files = x.select(F.concat(F.date_format("day", "yyMMdd"), F.lit("_"), F.lpad(n.cast("string"), 4, "0"), F.lit(".WAV")).alias("name"), "span_start", "span_end")
    return ca.rename_plan(files, semesters(spark), load(spark, d, "courses"), "LEC")


@query("with " + _SEM + ', n as (select *, lead(term) over (order by "start", "end", term) as nt, lead("start") over (order by "start", "end", term) as ns from sem), cs as (select distinct term, course_code, weekdays, t0, t1 from courses) ' + """
select term, 'reversed' as rule, cast("start" as varchar) as place from n where "start" > "end" union all select term, 'overlap', nt from n where ns <= "end"
union all select term, 'unknown_day', course_code || ' ' || wd from (select term, course_code, unnest(weekdays) as wd from cs) where wd not in ('Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun')
union all select term, 'reversed_window', course_code from cs where string_split(t0, ':')[1]::double * 3600 + string_split(t0, ':')[2]::double * 60 >= string_split(t1, ':')[1]::double * 3600 + string_split(t1, ':')[2]::double * 60""")
def dq_calendar(spark, d):
    """Breaches of the calendar rules."""
    c = load(spark, d, "courses").select("term", "course_code", "weekdays", F.regexp_extract("t0", "^(\\d+:\\d+)", 1).alias("t0"), F.regexp_extract("t1", "^(\\d+:\\d+)", 1).alias("t1")).distinct()
    c = c.withColumn("t0", F.concat("t0", F.lit(":00"))).withColumn("t1", F.concat("t1", F.lit(":00")))
    return ql.calendar_breaches(semesters(spark), c)


MODELS = [("a", "start_end", False, "selectable", "yes", "native", False), ("b", "end_only", True, "yes", "no", "needs_chunking", True), ("c", "end_only", False, "no", "untrained", "needs_chunking", False), ("d", "none", False, "no", "no", "native", False)]
REQUESTS = [("plain", True, None, False, False), ("verbatim", True, "verbatim", False, False), ("clean", False, "intended", True, False), ("dual", True, "verbatim", True, True)]


def _values(rows: list[tuple], names: str) -> str:
    cell = lambda v: "null" if v is None else str(v).lower() if isinstance(v, bool) else f"'{v}'"
    return "(values " + ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows) + f") v({names})"


@query("with m as (select * from " + _values(MODELS, "model, word_timestamps, silence_tokens, verbatim, hotwords, longform, speaker_labels") + "), r as (select * from " + _values(REQUESTS, "request, diarize, mode, hotwords_given, dual_stream") + """)
select model, request, case word_timestamps when 'start_end' then 'native' when 'end_only' then 'derived' else 'aligned' end as timing_source, word_timestamps = 'end_only' as derive_starts, word_timestamps not in ('start_end', 'end_only') as forced_alignment, longform = 'needs_chunking' as chunking, diarize and not speaker_labels as needs_diarizer,
  array_to_string(list_filter([case when word_timestamps = 'end_only' and not silence_tokens then 'pauses_fold_into_next_word' end, case when mode is not null and mode <> 'verbatim' and verbatim = 'yes' then 'mode_has_no_effect' end, case when hotwords_given and hotwords = 'untrained' then 'hotwords_untrained' end], lambda v: v is not null), ',') as warnings,
  array_to_string(list_filter([case when mode = 'verbatim' and verbatim = 'no' then 'verbatim_not_possible' end, case when dual_stream and verbatim <> 'selectable' then 'two_streams_not_possible' end, case when hotwords_given and hotwords = 'no' then 'hotwords_not_possible' end], lambda v: v is not null), ',') as errors
from m, r""")
def plan_capabilities(spark, d):
    """What each request can have of each declared model."""
    m = spark.createDataFrame(MODELS, "model string, word_timestamps string, silence_tokens boolean, verbatim string, hotwords string, longform string, speaker_labels boolean")
    each = [(q[0], mo[0], *q[1:]) for q in REQUESTS for mo in MODELS]
    r = spark.createDataFrame(each, "request string, model string, diarize boolean, mode string, hotwords_given boolean, dual_stream boolean")
    return ql.capability_plan(m, r)


@query("with " + _SEM + """, r as (select * from (select *, row_number() over (partition by rec_id order by loaded_at nulls last) as rn from recordings where rec_id is not null) where rn = 1)
select rec_id, regexp_extract(audio_path, '([^/]+)\\.[^./]+$', 1) as stem, case when duration_s is null then null else lpad((floor(duration_s)::bigint // 3600)::varchar, 2, '0') || ':' || lpad((floor(duration_s)::bigint // 60 % 60)::varchar, 2, '0') || ':' || lpad((floor(duration_s)::bigint % 60)::varchar, 2, '0') end as clock,
  regexp_extract(audio_path, '([^/]+)\\.[^./]+$', 1) || case when recorded_date is not null and not contains(regexp_extract(audio_path, '([^/]+)\\.[^./]+$', 1), recorded_date) then '-' || recorded_date else '' end || '_v1' as output_name from r""")
def txt_names(spark, d):
    """Clock readings and output names of each recording."""
    r = st.once(load(spark, d, "recordings"), ["rec_id"])
    stem = F.regexp_extract("audio_path", "([^/]+)\\.[^./]+$", 1)
    return r.select("rec_id", stem.alias("stem"), tm.clock(F.col("duration_s")).alias("clock"), sr.output_name(stem, F.col("recorded_date"), F.lit(None).cast("string"), F.lit("v1")).alias("output_name"))


@query(with_ctes(WORDS, "select rec_id, substring(sha256(string_agg(text, ' ' order by pos)), 1, 12) as hash from sp group by rec_id"))
def txt_content_hash(spark, d):
    """The hash that tells renders of other words apart."""
    return rd.content_hash(st.spoken(the_words(spark, d)))


@query(with_ctes(STREAM, "select rec_id, stretch as turn, string_agg(text, ' ' order by pos) as text from stm group by rec_id, stretch"))
def ren_plain(spark, d):
    """The words of each turn."""
    return rd.plain(the_stream(spark, d))


@query(with_ctes(WORDS, "hh as (select rec_id, i, text, list_distinct(list_concat(own, told)) as flags, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') as safe from sp)",
"""hi as (select rec_id, i, flags, case when (text like '[%' and text like '%]') or list_contains(flags, 'filled_pause') or list_contains(flags, 'vocalization') then '<span class="marker">' || safe || '</span>' when list_contains(flags, 'partial_word') then '<span class="partial">' || safe || '</span>' else safe end as h from hh),
hj as (select rec_id, i, flags, case when list_contains(flags, 'repair') then '<span class="reparandum">' || h || '</span>' else h end as h from hi)""",
"select rec_id, i, case when list_contains(flags, 'proper_noun_candidate') then '<span class=\"candidate\">' || h || '</span><sup class=\"cand-mark\">[NAME?]</sup>' else h end as html from hj"))
def ren_html_words(spark, d):
    """Escaped words in spans of their class."""
    return rd.html_words(st.spoken(the_words(spark, d)))


@query()
def ren_transcripts(spark, d):
    """Numbered text transcripts with names and time marks."""
    s = write_and_read(st.stream(load(spark, d, "words"), load(spark, d, "speaker_turns"), load(spark, d, "speaker_map")), "named-stream")
    return rd.transcripts(rd.text_lines(s, tl.anchors(s, 30.0)))


def _arms(spark, d):
    """Two arms on the same gold, their labels paired one to one with the true speakers: labels before and after smoothing."""
    s, _, _, j = _judged(spark, d)
    t = j.select("rec_id", "pos", "truth")
    raw = s.drop("speaker", "change", "stretch").withColumnRenamed("speaker_raw", "speaker").withColumn("speaker_raw", F.col("speaker"))
    words, runs, folded = [], [], []
    for arm, x in (("smoothed", s), ("raw", st.stretches(raw))):
        x = write_and_read(x.join(t, ["rec_id", "pos"]), "arm")
        labels = x.where("speaker is not null").select("rec_id", F.col("speaker").alias("label")).distinct()
        names = write_and_read(al.one_to_one(labels.join(ev.shared_words(x), ["rec_id", "label"], "left")), "pairs")
        tag = lambda df: df.select(*[c for c in ("known", "err", "truth", "direction", "run_start", "high_harm") if c in df.columns], F.lit(arm).alias("arm"), F.lit("run1").alias("run"))  # noqa: B023, E731
        judged = ev.judged(x, names)
        words.append(tag(judged))
        runs.append(tag(ev.error_runs(judged)))
        folded.append(tag(ev.judged(x, cp.pessimistic(names))))
    return ar.headline(words[0].unionByName(words[1]), runs[0].unionByName(runs[1]), folded[0].unionByName(folded[1]))


def _arm_sql(name: str, label: str) -> str:
    """Headline figures of the labels in a column of the stream, by words and by runs of wrong words."""
    t = f"{name}t as (select rec_id, pos, {label} as speaker, truth from je),\n"
    pairs = _PAIRED(f"select rec_id, speaker as label, truth as who, count(*) as n from {name}t where speaker is not null and truth is not null and truth <> '?' group by all").replace("from stm where speaker", f"from {name}t where speaker")
    for x in ("aw", "ak", "ao", "ax", "ay", "om"):
        pairs = re.sub(rf"\b{x}\b", f"{name}{x}", pairs)
    harm = "regexp_matches(truth, '^S[2-9]?$') and shown = 'L'"
    part = lambda n, shown: f"""{name}{n} as (select x.*, {shown} as shown, truth is not null and truth <> '?' and truth is distinct from {shown} as err from {name}t x left join {name}om m on m.rec_id || '#' || m.label = x.rec_id || '#' || x.speaker),
{name}{n}r as (select *, err and not (coalesce(lag(err) over v, false) and lag(truth) over v is not distinct from truth and lag(speaker) over v is not distinct from speaker) as opens from {name}{n} window v as (partition by rec_id order by pos))"""  # noqa: E731
    return t + pairs + ",\n" + part("m", "m.who") + ",\n" + part("p", "case when m.paired then m.who when m.label is not null then 'L' end") + f""",
{name}h as (select '{name}' as arm, 'run1' as run, count(*) filter (err and {harm}) as harm_words, count(*) filter (regexp_matches(truth, '^S[2-9]?$')) as student_words, count(*) filter (truth <> '?') as scored, count(*) filter (err) as wrong, count(*) filter (opens and {harm}) as harm_runs,
  (select count(*) from {name}p where err and {harm}) as pessimistic_words, (select count(*) from {name}pr where opens and {harm}) as pessimistic_runs from {name}mr)"""


@query("with recursive " + with_ctes(STREAM, _JUDGED, _arm_sql("smoothed", "speaker"), _arm_sql("raw", "speaker_raw"), f"hs as (select *, {_E4F('harm_words', 'student_words')} as share_e4, {_E4F('(scored - wrong)', 'scored')} as accuracy_e4 from (select * from smoothedh union all select * from rawh))", f"""
select x.*, x.harm_words <= floor(b.harm_words * {ar.PRIMARY_SHARE}) as words_ok, x.pessimistic_words <= floor(b.harm_words * {ar.PRIMARY_SHARE}) as pessimistic_ok, x.harm_words > b.harm_words as worse_than_baseline, x.harm_runs <= floor(b.harm_runs * {ar.RUNS_SHARE}) as runs_ok, coalesce(x.accuracy_e4, 0) >= coalesce(b.accuracy_e4, 0) - {ar.ACCURACY_DROP_E4} as accuracy_ok,
  x.harm_words <= floor(b.harm_words * {ar.PRIMARY_SHARE}) and x.pessimistic_words <= floor(b.harm_words * {ar.PRIMARY_SHARE}) and x.harm_runs <= floor(b.harm_runs * {ar.RUNS_SHARE}) and coalesce(x.accuracy_e4, 0) >= coalesce(b.accuracy_e4, 0) - {ar.ACCURACY_DROP_E4} as passes
from hs x, hs b where x.arm = 'raw' and b.arm = 'smoothed'""")[5:])
def arms_bars(spark, d):
    """Unsmoothed labels against smoothed ones: headline figures and bars."""
    return ar.bars(ar.worse_runs(_arms(spark, d)), "smoothed")


@query("""with e as (select *, lag(ts) over (partition by user_id order by ts) as p from events where ts is not null), g as (select *, sum((p is null or ts - p > interval 6 hours)::int) over (partition by user_id order by ts) as s from e)
select user_id, min(ts) as "start", max(ts) as "end", count(*) as n from g group by user_id, s""")
def str_event_sessions(spark, d):
    """Events in sessions separated by six hours of silence, as the stream operator groups them."""
    return streaming.session_counts(load(spark, d, "events"), ["user_id"], "ts", "6 hours")


@query("""select event_type, time_bucket(interval 1 day, ts) as "start", time_bucket(interval 1 day, ts) + interval 1 day as "end", count(*) as n from events group by all""")
def str_event_windows(spark, d):
    """Events per type and day."""
    return streaming.windowed_counts(load(spark, d, "events"), "event_type", "ts", "1 day")


# -- sheets, sources of words, comparisons ------------------------------------------------------
from streamloom.operators import compare as cp  # noqa: E402
from streamloom.operators import sheets as sh  # noqa: E402
from streamloom.sources import models as md  # noqa: E402


@query(with_ctes(STREAM, "select rec_id, count(distinct sent) + max(stretch) * 3 + 1 as n_lines from stm group by rec_id"))
def gram_sheet_sizes(spark, d):
    """Lines of each recording's label sheet."""
    return sh.sheet(the_stream(spark, d)).groupBy("rec_id").agg(F.count("*").alias("n_lines"))


@query()
def gram_checked_sheets(spark, d):
    """Sheets filled from the gold verdicts and checked: verdicts read back, and breaches if there are any."""
    s = write_and_read(the_stream(spark, d), "stream")
    rows = write_and_read(sh.sheet(s), "sheet")
    g = sheet_in_work(s).select("rec_id", F.concat(F.lit("B-"), F.lpad(F.col("bno").cast("string"), 3, "0")).alias("key"), "verdict")
    filled = rows.join(g, ["rec_id", "key"], "left").select("rec_id", F.col("ord").alias("n"), F.when((F.col("kind") == "boundary") & F.col("verdict").isNotNull(), F.concat(F.lit("boundary: "), F.col("verdict"))).otherwise(F.col("line")).alias("line"))
    return sh.checked(rows, filled)


@query(with_ctes(STREAM, _GOLD, "select rec_id, count(*) as boundaries, count(verdict) as done, count(*) filter (verdict = 'real') as \"real\", count(*) filter (verdict = 'spurious') as spurious, count(*) filter (verdict = 'unsure') as unsure, max(bno) filter (verdict is not null) as last, (select count(*) from gm where gm.rec_id = gold.rec_id and gm.who <> 'L') as change_markers, (select count(*) from gm where gm.rec_id = gold.rec_id and gm.who = 'L') as back_markers from gold group by rec_id"))
def agg_label_progress(spark, d):
    """How far each sheet is labelled; markers to the instructor count as back."""
    s = write_and_read(the_stream(spark, d), "stream")
    markers = ev.gold_markers(s, ev.identity(F.col("asr_speaker"))).withColumn("kind", F.when(F.col("who") == "L", "back").otherwise("change"))
    return sh.progress(sheet_in_work(s), markers)


@query("with " + _cand_sql(1) + """, un as (select *, coalesce(max(b) over (partition by rec_id, class order by a, b rows between unbounded preceding and 1 preceding), a - 1) as seen from ca)
select rec_id, class, sum(greatest(0, b - greatest(a - 1, seen)))::bigint as covered from un group by rec_id, class""")
def agg_union_size(spark, d):
    """Words that each class's windows cover together."""
    return cp.union_size(_found(spark, d, 1)[1], ["rec_id", "class"])


@query(_RECALL + """, nw as (select er.rec_id, er.kind, er.t, case when er.t <= ca.a then ca.a + 1 - er.t when er.t > ca.b then er.t - ca.b else 0 end as dist, ca.class, row_number() over (partition by er.rec_id, er.kind, er.t order by case when er.t <= ca.a then ca.a + 1 - er.t when er.t > ca.b then er.t - ca.b else 0 end, ca.a, ca.b, ca.class) as rn from er left join ca on ca.rec_id = er.rec_id)
select rec_id, kind, t, dist as distance, class from nw where rn = 1 and coalesce(dist > 0, true)""")
def join_nearest_window(spark, d):
    """The nearest window of errors that none holds."""
    found, _, by = _surfaced(spark, d)
    return cp.nearest_windows(by, found)


_RENDER, _PARAMS = '{"pause":0.5}', '{"version":1}'


@query(with_ctes(STREAM, "mb as (select rec_id, list(i order by pos) filter (change) as b from stm group by rec_id), mc as (select mb.rec_id, coalesce(b, []) as b, len(coalesce(b, [])) % 5 as k, r.sha from mb left join (select rec_id, max(audio_sha256) as sha from recordings group by rec_id) r on r.rec_id = mb.rec_id)",
"select rec_id, why from (select rec_id, unnest(list_filter([case when k = 0 and sha is not null then 'other_source_sha256' end, case when k = 1 then 'other_render' end, case when k = 2 then 'other_boundaries' end, case when k = 3 then 'other_params' end], lambda x: x is not null)) as why from mc)"))
def eval_match(spark, d):
    """Labels held against windows: every fifth number of boundaries meets another source, render, boundary list or parameter hash."""
    b = the_stream(spark, d).groupBy("rec_id").agg(F.sort_array(F.collect_list(F.when(F.col("change"), F.col("i")))).alias("boundaries"))
    sha = load(spark, d, "recordings").groupBy("rec_id").agg(F.max("audio_sha256").alias("source_sha256"))
    x = b.join(sha, "rec_id", "left").select("*", F.lit(_RENDER).alias("render"), F.lit("primary").alias("stream"), F.lit(_PARAMS).alias("params"), F.lit(cp.sha256(_PARAMS)).alias("params_sha256"))
    k = F.size("boundaries") % 5
    other = {"source_sha256": (0, F.lit(None).cast("string")), "render": (1, F.lit("{}")), "boundaries": (2, F.slice("boundaries", 2, 1000000)), "params_sha256": (3, F.lit("0"))}
    return cp.match_breaches(x, x.withColumns({c: F.when(k == n, v).otherwise(F.col(c)) for c, (n, v) in other.items()}))


@query("with recursive " + with_ctes(STREAM, _JUDGED, _PAIRED("select rec_id, speaker as label, truth as who, count(*) as n from trt where speaker is not null and truth is not null and truth <> '?' group by all"), """select mp.rec_id, mp.label, 'who' as path, '{"v":"' || mp.who || '"}' as "left", '{"v":"' || om.who || '"}' as "right" from mp join om on om.rec_id = mp.rec_id and om.label = mp.label where mp.who <> om.who""")[5:])
def id_check(spark, d):
    """Labels that the rule of shares and the pairing one to one map to other speakers."""
    s, _, names, j = _judged(spark, d)
    labels = s.where("speaker is not null").select("rec_id", F.col("speaker").alias("label")).distinct()
    paired = al.one_to_one(labels.join(ev.shared_words(j), ["rec_id", "label"], "left")).select("rec_id", "label", "who")
    return cp.differences(names, paired, ["rec_id", "label"])


@query()
def vote_stats(spark, d):
    """What the vote of three other transcripts found in each recording, in figures."""
    words = the_words(spark, d).withColumn("stream", F.lit("primary"))
    view = write_and_read(df.fluent_view(st.spoken(the_words(spark, d))), "fluent")
    others = write_and_read(_dissenters(view), "dissenters")
    found = al.annotate(words, others, ["a", "b", "c"])[1]
    return df.conjunction_stats(st.spoken(the_words(spark, d)), view, al.unmatched(view, others, ["a", "b", "c"]), found, ["a", "b", "c"])


@query()
def ren_html_documents(spark, d):
    """One page per recording with its stamp, turns and numbered sentences."""
    s = write_and_read(the_stream(spark, d), "stream")
    stats = s.groupBy("rec_id").agg((F.max("stretch") + 1).alias("turns"), (F.max("sent") + 1).alias("sentences"), F.count("boundary").alias("boundaries"), F.count_if("flipped").alias("words_reassigned"))
    stamps = rd.stamped(st.once(load(spark, d, "recordings"), ["rec_id"]), stats, rd.content_hash(s), {"pause_s": str(st.PAUSE_S), "anchor_s": "30", "smoothing": str(st.MAX_ISLAND), "stream": "primary"})
    return rd.html_documents(s, stamps)


@query(with_ctes(WORDS, "select rec_id, count(*) as n, count(*) filter (speaker = 'Speaker 2') as second from (select rec_id, case when (i // 12) % 2 = 0 then 'Speaker 1' else 'Speaker 2' end as speaker from w0 where text not like '[%') group by rec_id"))
def src_variants(spark, d):
    """Variants of a word source: untimed, two speakers by turns, without markers."""
    w = md.steps(the_words(spark, d), ["untimed", "alternating", "without_markers"])
    return w.groupBy("rec_id").agg(F.count("*").alias("n"), F.count_if(F.col("speaker") == "Speaker 2").alias("second"))


@query("with " + _DURS + ", w as (select distinct rec_id from words where conf > 0.999), e as (select distinct rec_id from error_ranges) select du.rec_id, 0.0::double as start_s, duration_s as end_s, 'no output' as message from du where duration_s > 5 and rec_id not in (select rec_id from w where rec_id is not null) and rec_id not in (select rec_id from e where rec_id is not null)")
def src_empty_outputs(spark, d):
    """Recordings without any near-certain word nor an error range, as a model's empty output would show."""
    return md.empty_outputs(durations(spark, d), load(spark, d, "words").where("conf > 0.999"), load(spark, d, "error_ranges"))


@query("with r as (select distinct model_id from recordings where model_id is not null) select lower(trim(model_id)) as key, count(*) as n from r group by 1 having count(*) > 1")
def src_registry_twice(spark, d):
    """Model ids that differ in spelling only."""
    return md.twice(load(spark, d, "recordings").where("model_id is not null").select("model_id").distinct())


@query(with_ctes(TURNS, "nm as (select rec_id, speaker from (select *, row_number() over (partition by rec_id, speaker order by loaded_at nulls last) as rn from speaker_map where rec_id is not null and speaker is not null) where rn = 1 and display_name is not null)", "select distinct tn.rec_id, tn.speaker from tn left join nm on nm.rec_id = tn.rec_id and nm.speaker = tn.speaker where nm.speaker is null"))
def prj_unmapped_labels(spark, d):
    """Labels of turns that the name map leaves without a name."""
    m = st.once(load(spark, d, "speaker_map"), ["rec_id", "speaker"]).where("display_name is not null").select("rec_id", "speaker")
    return the_turns(spark, d).select("rec_id", "speaker").distinct().join(m, ["rec_id", "speaker"], "left_anti")
