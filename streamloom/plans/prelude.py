"""The SQL side of the shared stream: CTEs that the twins of the reference queries start from."""

from __future__ import annotations

from streamloom.functions.tokens import ABBREVIATIONS, FILLED_PAUSES, VOCAL_SOUNDS

_Q = lambda xs: ", ".join("'" + x.replace("'", "''") + "'" for x in xs)


def flags_sql(t: str) -> str:
    body = f"lower(trim(regexp_extract(trim({t}), '^[(\\[<]\\s*(.*?)\\s*[)\\]>]$', 1)))"
    return f"""case when coalesce(trim({t}), '') = '' then [] when trim({t}) = '_' then ['silence']
      when regexp_matches(trim({t}), '^[(\\[<].*[)\\]>]$') then case when {body} in ({_Q(FILLED_PAUSES)}) then ['filled_pause'] when {body} in ({_Q(VOCAL_SOUNDS)}) then ['vocalization'] else ['unknown_marker'] end
      when regexp_matches(trim(trim({t}), '"''“”‘’.,;:!?)('), '\\p{{L}}-$') then ['partial_word'] else [] end"""


def terminal_sql(t: str) -> str:
    core = f"rtrim({t}, '\"'')]”’»')"
    stem = f"lower(replace({core}, '.', ''))"
    return f"""(not ({t} like '[%' and {t} like '%]') and regexp_matches({core}, '[.?!]$') and not ({core} like '%.' and ({stem} in ({_Q(ABBREVIATIONS)}) or (length({stem}) = 1 and regexp_matches({stem}, '^\\p{{L}}$') and regexp_matches({core}, '^\\p{{Lu}}')))))"""


WORDS = f"""w0 as (
  select * from (select rec_id, i, coalesce(text, '') as text, start_s, end_s, flags, speaker as asr_speaker, row_number() over (partition by rec_id, i order by loaded_at nulls last) as rn from words where rec_id is not null and i is not null) where rn = 1
), wf as (
  select rec_id, i, text, start_s, end_s, asr_speaker, coalesce(flags, []) as own, {flags_sql('text')} as told from w0
), ws as (
  select *, list_contains(own, 'silence') or list_contains(told, 'silence') as is_silence from wf
), sp as (
  select *, row_number() over (partition by rec_id order by i) - 1 as pos from ws where not is_silence
)"""

TURNS = """t0 as (
  select * from (select *, row_number() over (partition by rec_id, turn_ord order by loaded_at nulls last) as rn from speaker_turns where rec_id is not null and turn_ord is not null) where rn = 1
), tn as (
  select rec_id, turn_ord, start_s, end_s, speaker, row_number() over (partition by rec_id order by start_s, end_s, turn_ord) - 1 as ord from t0
  where start_s is not null and end_s is not null and start_s >= 0 and end_s >= start_s and speaker <> ''
)"""

ASSIGN = """hit as (
  select sp.rec_id, sp.pos, tn.ord, tn.speaker, least(sp.end_s, tn.end_s) - greatest(sp.start_s, tn.start_s) as ov
  from sp join tn on tn.rec_id = sp.rec_id
  where sp.start_s is not null and sp.end_s is not null and (least(sp.end_s, tn.end_s) - greatest(sp.start_s, tn.start_s) > 0 or (tn.start_s <= (sp.start_s + sp.end_s) / 2 and (sp.start_s + sp.end_s) / 2 <= tn.end_s))
), best as (
  select rec_id, pos, speaker from (select *, row_number() over (partition by rec_id, pos order by greatest(ov, 0.0) desc, ord) as rn from hit) where rn = 1
), near as (
  select rec_id, pos, speaker from (
    select sp.rec_id, sp.pos, tn.speaker, row_number() over (partition by sp.rec_id, sp.pos order by least(abs((sp.start_s + sp.end_s) / 2 - tn.start_s), abs((sp.start_s + sp.end_s) / 2 - tn.end_s)), tn.ord) as rn
    from sp join tn on tn.rec_id = sp.rec_id anti_best where sp.start_s is not null and sp.end_s is not null) where rn = 1
), asg as (
  select sp.*, coalesce(best.speaker, near.speaker) as speaker_raw from sp left join best on best.rec_id = sp.rec_id and best.pos = sp.pos left join near on near.rec_id = sp.rec_id and near.pos = sp.pos
)""".replace("anti_best", "left join best b2 on b2.rec_id = sp.rec_id and b2.pos = sp.pos").replace("where sp.start_s is not null and sp.end_s is not null) where rn = 1", "where b2.pos is null and sp.start_s is not null and sp.end_s is not null) where rn = 1")

SMOOTH = """br as (
  select *, coalesce(start_s - lag(end_s) over (partition by rec_id order by pos) > 0.5, false) as brk, lag(speaker_raw) over (partition by rec_id order by pos) as pl from asg
), rn as (
  select *, sum(brk::int) over (partition by rec_id order by pos) as run, sum((brk or speaker_raw is distinct from pl or pos = 0)::int) over (partition by rec_id order by pos) as st from br
), sx as (
  select rec_id, st, any_value(run) as run, min_by(speaker_raw, pos) as lab, count(*) as n from (select rec_id, st, run, pos, speaker_raw from rn) group by rec_id, st
), sy as (
  select *, lag(lab) over v as ll, lead(lab) over v as rl, lag(run) over v as lr, lead(run) over v as rr from sx window v as (partition by rec_id order by st)
), sm as (
  select rn.rec_id, rn.i, rn.pos, rn.text, rn.start_s, rn.end_s, rn.own, rn.told, rn.asr_speaker, rn.speaker_raw,
    coalesce(sy.lr = sy.run and sy.rr = sy.run and sy.ll is not distinct from sy.rl and sy.lab is distinct from sy.ll and sy.n <= 2, false) as flipped, sy.ll
  from rn join sy on sy.rec_id = rn.rec_id and sy.st = rn.st
), sml as (select * exclude (ll), case when flipped then ll else speaker_raw end as speaker from sm)"""

SENT = f"""nx as (
  select *, lead(pos) over v as np, lead(speaker) over v as ns, (lead(start_s) over v) - end_s as gap_next, lag(speaker) over v as ps from sml window v as (partition by rec_id order by pos)
), bd as (
  select *, case when np is null then 'end' when ns is distinct from speaker then 'speaker' when {terminal_sql('text')} then 'punct' when gap_next > 0.5 then 'pause' end as boundary, pos > 0 and ps is distinct from speaker as change from nx
), stm as (
  select *, coalesce(sum((boundary is not null)::int) over (partition by rec_id order by pos rows between unbounded preceding and 1 preceding), 0)::bigint as sent, (sum(change::int) over (partition by rec_id order by pos))::bigint as stretch from bd
)"""

STREAM = ",\n".join([WORDS, TURNS, ASSIGN, SMOOTH, SENT])


def with_ctes(*parts: str) -> str:
    return "with " + ",\n".join(parts[:-1]) + "\n" + parts[-1]
