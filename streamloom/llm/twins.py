"""SQL twins of queries whose result SQL can tell by a way of its own."""

#: Told by the tokens' written form alone, apart from the tagger.
P1_FOUND = r"""
with w as (select rec_id, i, any_value(text) as t, any_value(speaker) as speaker from words where rec_id is not null and i is not null group by rec_id, i),
n as (select *, lead(t) over v as nt, lag(t) over v as pt from w window v as (partition by rec_id order by i)),
k as (select *, regexp_full_match(t, '(?i)(>>\s*)?[\[(<]?(speaker|spk)[ _]?\d+[\])>]?:?') as tag,
  regexp_full_match(t, '(?i)[\[(<]?(u+h+|u+m+|u+h+m+|h+m+|mm+|m+h+m+|e+r+|e+r+m+|e+h+|a+h+)[\])>]?[.,!?]*') or (regexp_full_match(t, '(?i)[\[(<](t:)?\d+([:.]\d+)*[\])>]') and not regexp_full_match(t, '\(\d{1,3}\)'))
  or regexp_full_match(t, '[\[(<*]\p{L}{2,}[ \p{L}-]*[\])>*]|♪|_') or (regexp_full_match(t, '[\[(<*]\p{L}{2,}') and regexp_full_match(nt, '\p{L}+[\])>*]')) or (regexp_full_match(t, '\p{L}+[\])>*]') and regexp_full_match(pt, '[\[(<*]\p{L}{2,}')) as unspoken from n),
l as (select rec_id, i, tag, coalesce(unspoken, false) as unspoken, case when tag then t else speaker end as lab from k),
m as (select rec_id, speaker, regexp_replace(lower(trim(display_name)), '^(dr|prof|professor|mr|mrs|ms)\.?\s+', '') as name from speaker_map where display_name is not null),
mm as (select rec_id, name as k, min(speaker) as who from (select rec_id, speaker, name from m union select rec_id, speaker, regexp_extract(name, '(\S+)$', 1) from m) group by all),
r as (select l.*, case when regexp_matches(lab, '\d') then 'SPEAKER_' || lpad(regexp_extract(lab, '0*(\d+)', 1), 2, '0') else mm.who end as who from l left join mm on mm.rec_id = l.rec_id and mm.k = regexp_replace(lower(trim(lab)), '^(dr|prof|professor|mr|mrs|ms)\.?\s+', '')),
f as (select *, last_value(who ignore nulls) over (partition by rec_id order by i rows between unbounded preceding and current row) as cur from r),
s as (select *, lag(cur) over (partition by rec_id order by i) as pv from f where not unspoken and not tag and cur is not null),
g as (select *, sum((pv is null or pv <> cur)::int) over (partition by rec_id order by i) as turn from s)
select rec_id, turn::int as turn_no, min(cur) as speaker, min(i) as first_i, max(i) as last_i, count(*)::int as n_words from g group by rec_id, turn
"""

#: Shared runs of twelve words, as strings.
P6_FOUND = r"""
with raw as (select 'd' as side, doc_id as id, lower(text) as t from documents where text is not null union all select 'p', item_id, lower(text) from eval_passages where text is not null),
c1 as (select side, id, regexp_replace(regexp_replace(t, '(?m)^[ \t]*(\d+[ \t]*\r?\n[ \t]*)?\d\d?:\d\d:\d\d[,.]?\d*[ \t]*-->[^\n]*$', ' ', 'g'), case when contains(t, '-->') then '(?m)^[ \t]*\d+[ \t]*$' else '\x00' end, ' ', 'g') as t from raw),
c2 as (select side, id, regexp_replace(regexp_replace(t, '\[[^\[\]\n]{1,40}\]|\((coughs|laughs|laughter|sighs|inaudible)\)', ' ', 'g'), '(?m)(^|[\s\]>])(speaker|spk)[ _]?\d+\s*:', ' ', 'g') as t from c1),
c3 as (select side, id, replace(replace(regexp_replace(t, '\d{1,2}:\d\d(:\d\d)?([.,]\d+)?', ' ', 'g'), '''', ''), '’', '') as t from c2),
ws as (select side, id, list_filter(regexp_extract_all(t, '[\p{L}\p{N}]+'), lambda w: not regexp_full_match(w, 'u+h+|u+m+|u+h+m+|h+m+|mm+|m+h+m+|e+r+|e+r+m+|e+h+|a+h+')) as w from c3),
gr as (select side, id, unnest(list_transform(range(1, len(w) - 10), lambda k: array_to_string(w[k:k + 11], ' '))) as g from ws where len(w) >= 12)
select distinct d.id as doc_id, p.id as item_id from gr d join gr p on p.g = d.g where d.side = 'd' and p.side = 'p'
"""
