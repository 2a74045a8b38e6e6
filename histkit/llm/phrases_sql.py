"""DuckDB SQL for the rows of ``op11_collocations``: all words with their followers, counted in one table."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def oracle(least: int = 10, share: int = 50, top: int = 2000) -> str:
    return f"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents),
lists as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as words from pieces),
starts as (select lang, words, unnest(range(1, len(words) + 1)) as i from lists),
runs as (select lang, unnest([words[i : i], words[i : i + 1], words[i : i + 2]]) as run, unnest([1, 2, 3]) as k, len(words) - i + 1 as left_over from starts),
counts as (select lang, run, k, count(*)::bigint as f from runs where left_over >= k group by all),
totals as (select lang, sum(f)::bigint as n from counts where k = 1 group by lang),
candidates as (select * from counts where k > 1 and f >= {least}),
cuts as (select lang, run, k, f, unnest(range(1, k)) as cut from candidates),
scored as (
  select c.lang, c.run, c.k, c.f as a, x.f as l, y.f as r, cut, ((1000000::hugeint * c.f * c.f) // (x.f::hugeint * y.f))::bigint as score
  from cuts c join counts x on x.lang = c.lang and x.run = c.run[1 : cut] join counts y on y.lang = c.lang and y.run = c.run[cut + 1 :]),
worst as (select * from (select *, row_number() over (partition by lang, run order by score, cut) as place from scored) where place = 1),
longer as (
  select lang, run, max(f) as f from (
    select lang, run[1 : 2] as run, f from candidates where k = 3 union all select lang, run[2 : 3], f from candidates where k = 3) group by all),
kept as (
  select w.* from worst w left join longer o on o.lang = w.lang and o.run = w.run where o.f is null or 100 * o.f < {share} * w.a),
ranked as (
  select *, array_to_string(run, ' ') as phrase, row_number() over (partition by lang order by score desc, a desc, array_to_string(run, ' ')) as rank from kept)
select lang, rank::bigint as rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= {top}
"""
