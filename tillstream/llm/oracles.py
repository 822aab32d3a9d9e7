"""DuckDB SQL for queries of this folder, written from their rules."""

from __future__ import annotations

# Every length is cut out on its own and counted.
COLLOCATIONS = r"""
with cut as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
pieces as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from cut),
totals as (select lang, sum(len(w))::bigint as n from pieces group by lang),
sizes as (select unnest([1, 2, 3, 4, 5]) as size),
grams as (
  select lang, size, unnest([array_to_string(w[i:i + size - 1], ' ')
                             for i in generate_series(1, len(w) - size + 1)]) as phrase
  from pieces join sizes on len(w) >= size),
counts as (
  select lang, size, phrase, count(*) as f from grams group by all having count(*) >= 100),
candidates as (select *, string_split(phrase, ' ') as w from counts where size >= 2),
cuts as (
  select c.lang, c.phrase, c.f as a, k, l.f as l, r.f as r, n,
         ((1000::hugeint * c.f * n) // (l.f::hugeint * r.f))::bigint as score
  from (select *, unnest(generate_series(1, size - 1)) as k from candidates) c
  join counts l on l.lang = c.lang and l.phrase = array_to_string(w[1:k], ' ')
  join counts r on r.lang = c.lang and r.phrase = array_to_string(w[k + 1:], ' ')
  join totals on totals.lang = c.lang),
weakest as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inside as (
  select lang, f, array_to_string(w[i:i + s - 1], ' ') as phrase
  from (select *, unnest(generate_series(1, size - s + 1)) as i
        from (select *, unnest(generate_series(2, size - 1)) as s from candidates where size > 2) b) p),
kept as (
  select * from weakest x where not exists (
    select 1 from inside y where y.lang = x.lang and y.phrase = x.phrase and 100 * y.f >= 100 * x.a)),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000"""

_CRC_BITS = ", ".join(["-1"] * 8)
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _leaf(text: str) -> str:
    def field(name: str) -> str:
        value = f"cast({name} as varchar)"
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    return "sha256(" + " || ".join(map(field, ["doc_id", "source", "lang", "n_chars", text])) + ")"


def _levels(tree: str, count: int) -> list[str]:
    """CTEs of a tree's levels above ``{tree}_0`` (g, i, h); a lone node stays as it is."""
    return [
        f"""{tree}_{k} as (
  select g, case when c > 1 then i // 16 else i end as i,
         case when any_value(c) > 1 then sha256(string_agg(h, '' order by i)) else any_value(h) end as h
  from (select t.*, n.c from {tree}_{k - 1} t
        join (select g, count(*) as c from {tree}_{k - 1} group by g) n on n.g = t.g) x
  group by g, case when c > 1 then i // 16 else i end)"""
        for k in range(1, count + 1)
    ]


def _folds(tree: str, name: str, count: int) -> list[str]:
    """CTEs that take every row of ``{name}_0`` (row, g, i, f, p) up a tree's levels.

    f: the folded digest, p: the siblings so far.
    """
    return [
        f"""{name}_{k} as (
  select row, x.g, any_value(x.i // 16) as i,
         case when count(*) > 1 or any_value(c) > 1
              then sha256(string_agg(case when t.i = x.i then f else h end, '' order by t.i))
              else any_value(f) end as f,
         any_value(p) || coalesce(string_agg(h, '' order by t.i) filter (where t.i <> x.i), '') as p
  from {name}_{k - 1} x
  join {tree}_{k - 1} t on t.g = x.g and t.i // 16 = x.i // 16
  join (select g, count(*) as c from {tree}_{k - 1} group by g) n on n.g = x.g
  group by row, x.g)"""
        for k in range(1, count + 1)
    ]


def merkle_sql(levels: int = 5, upper: int = 4) -> str:
    """Trees of at most 16^levels rows a source and 16^upper sources, level by level."""
    parts = [
        f"""leaves as (
  select row_number() over () as row, doc_id, coalesce('=' || source, '') as g,
         {_leaf('text')} as leaf, {_leaf(_LOWER)} as lowered,
         xor(list_reduce(list_prepend(4294967295::bigint, flatten([[ascii(c)::bigint, {_CRC_BITS}]
                           for c in string_split(cast(doc_id as varchar), '')])),
                         lambda s, x: case when x >= 0 then xor(s, x)
                                           else xor(s >> 1, 3988292384::bigint * (s & 1)) end),
             4294967295::bigint) as crc
  from documents)""",
        """a_leaves as (
  select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as i,
         case when crc % 5 = 0 then lowered else leaf end as f from leaves)""",
        "a_0 as (select g, i, leaf as h from a_leaves)",
        *_levels("a", levels),
        f"b_nodes as (select g as source, row_number() over (order by g) - 1 as i, h from a_{levels})",
        "b_0 as (select 0 as g, i, h from b_nodes)",
        *_levels("b", upper),
        "up_0 as (select row, g, i, f, '' as p from a_leaves)",
        *_folds("a", "up", levels),
        f"""over_0 as (
  select row, 0 as g, b.i, f, p from up_{levels} u join b_nodes b on b.source = u.g)""",
        *_folds("b", "over", upper),
    ]
    return (
        "with "
        + ",\n".join(parts)
        + f"""
select doc_id, leaf, b.h as subroot, r.h as root, sha256(p) as proof_sha256,
       o.f as folded_root, o.f = r.h as verified
from a_leaves l join over_{upper} o on o.row = l.row
join b_nodes b on b.source = l.g join b_{upper} r on true"""
    )
