"""DuckDB SQL for the rows of ``op13_licenses``: k-grams as text, the same diagonals and the same rule for spans."""

from __future__ import annotations

from histkit.llm.licenses import GAP, LEAST, LOWER, TEMPLATES, UPPER, WORD, gram_rows


def oracle() -> str:
    rows = ",\n".join(
        f"({number}, {place}, '{' '.join(words)}', {len(words)}, '{label}', {base}, {phrase}, {size})"
        for number, place, words, label, base, phrase, size in gram_rows(TEMPLATES)
    )
    return f"""
with grams(template, place, gram, k, label, base, phrase, template_words) as (values {rows}),
texts as (
  select row_number() over () as uid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') as words
  from documents),
pieces as (select uid, words, unnest(range(0, len(words))) as pos from texts),
keyed as (
  select uid, pos, unnest([2, 4]) as k, unnest([array_to_string(words[pos + 1 : pos + 2], ' '), array_to_string(words[pos + 1 : pos + 4], ' ')]) as gram
  from pieces),
hits as (
  select uid, g.template, pos - place as diagonal, place, label, base, phrase, template_words, g.k
  from keyed join grams g on keyed.gram = g.gram and keyed.k = g.k),
lines as (
  select uid, template, diagonal, any_value(label) as label, any_value(base) as base, any_value(phrase) as phrase,
    any_value(template_words) as template_words, any_value(k) as k, list(place) as places
  from hits group by uid, template, diagonal),
merged as (
  select l.*, (
    select list(distinct w) from (
      select unnest(range(p, p + l.k)) as w
      from (select unnest(m.places) as p from lines m
            where m.uid = l.uid and m.template = l.template
              and abs(m.diagonal - l.diagonal) <= case when l.phrase then 0 else {GAP} end))) as covered
  from lines l),
scored as (select *, len(covered)::double / template_words as coverage from merged),
spans as (
  select uid, label, base, coverage, greatest(diagonal + list_min(covered), 0) as first_word
  from scored s
  where case when phrase then len(places) = template_words - k + 1
    else coverage >= {LEAST} and not exists (
      select 1 from scored o
      where o.uid = s.uid and o.template = s.template and abs(o.diagonal - s.diagonal) <= {GAP}
        and (o.coverage > s.coverage or (o.coverage = s.coverage and o.diagonal < s.diagonal))) end),
found as (
  select uid, count(*) filter (base) as n_base, min(first_word) filter (base) as first_word, max(first_word) filter (base) as last_word,
    string_agg(distinct label, ',' order by label) filter (base) as base_labels, string_agg(distinct label, ',' order by label) as labels,
    max(coverage) as score
  from spans group by uid)
select doc_id, len(words)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0)::double as score
from texts left join found using (uid)
"""
