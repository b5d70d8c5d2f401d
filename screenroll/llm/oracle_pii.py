"""DuckDB statement for the personal-data query, with the plain patterns."""

from __future__ import annotations

from .pii import CONTEXT_BONUS, CONTEXT_CHARS, KINDS, THRESHOLD

_OCTET = "0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_PLAIN = "replace(m, ' ', '')"
_TURNED = f"(substr({_PLAIN}, 5) || substr({_PLAIN}, 1, 4))"
_TESTS = {
    "any": "true",
    "octets": rf"regexp_full_match(m, '{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}')",
    "luhn": f"length({_DIGITS}) between 12 and 19 and list_sum(list_transform(range(length({_DIGITS})), "
            f"lambda i: (ascii(reverse({_DIGITS})[i + 1]) - 48) * (1 + i % 2) - case when i % 2 = 1 "
            f"and reverse({_DIGITS})[i + 1] > '4' then 9 else 0 end)) % 10 = 0",
    "digits": f"length({_DIGITS}) between 9 and 15",
    "mod97": f"length({_PLAIN}) between 15 and 34 and list_reduce(list_transform("
             f"string_split({_TURNED}, ''), lambda c: case when c >= 'A' then ascii(c) - 55 else ascii(c) - 48 end), "
             "lambda a, v: (a * case when v > 9 then 100 else 10 end + v) % 97, 0) = 1",
    "ssn": "regexp_full_match(m, '[0-9]{3}-[0-9]{2}-[0-9]{4}')",
}


def pii_sql() -> str:
    found = []
    for i, k in enumerate(KINDS):
        found.append(f"""
          select rid, {i} as kind, '{k.name}' as name, start, start + length(m) as stop from (
            select rid, m[i] as m, right(p[i], {CONTEXT_CHARS}) as before,
              list_sum(list_transform(p[1:i], lambda x: length(x))) +
              coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) as start
            from (select rid, p, m, unnest(range(1, len(m) + 1)) as i from (
              select rid, string_split_regex(text, '{k.pattern}') as p,
                regexp_extract_all(text, '{k.pattern}') as m from d)))
          where {_TESTS[k.confirm]} and ({str(k.base).lower()} or {k.score} +
            case when regexp_matches(lower(before), '{k.context}') then {CONTEXT_BONUS} else 0 end >= {THRESHOLD})""")
    span = "name || ':' || cast(start as bigint) || ':' || cast(stop as bigint)"
    n_base = sum(k.base for k in KINDS)
    counts = ", ".join(f"count(*) filter (where kind = {i}) as n_{KINDS[i].name}" for i in range(n_base))
    return f"""
      with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
      f as ({' union all '.join(found)})
      select doc_id, {counts},
        sha256(coalesce(string_agg({span}, ',' order by start, kind) filter (where kind < {n_base}), '')) as base_sha256,
        coalesce(string_agg({span}, ',' order by start, kind), '') as spans
      from d left join f using (rid) group by rid, doc_id"""
