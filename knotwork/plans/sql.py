"""SQL spellings of the normalizers, for the oracle queries. RE2 syntax, one expression each."""

from __future__ import annotations

from ..functions import tables as T


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _map(d: dict[str, str]) -> str:
    return "map([" + ", ".join(map(_q, d)) + "], [" + ", ".join(map(_q, d.values())) + "])"


def clean(x: str) -> str:
    s = f"lower(regexp_replace(strip_accents(coalesce({x}, '')), '[^\\x00-\\x7F]', '', 'g'))"
    for pattern, put in T.CLEANING:
        s = f"regexp_replace({s}, {_q(pattern)}, {_q(put.replace('$1', chr(92) + '1'))}, 'g')"
    return f"trim({s})"


LEGAL = r"\b(?:" + "|".join(t.replace(" ", r"\s+") for t in T.LEGAL_TERMS) + r")\b"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, ' +', ' ', 'g'))"


def name_of_clean(c: str) -> str:
    """Name from a cleaned column."""
    s = c
    for _ in range(2):
        s = collapse(f"regexp_replace({s}, {_q(LEGAL)}, ' ', 'g')")
    return s


def tokens(c: str) -> str:
    return f"(case when {c} = '' then [] else string_split({c}, ' ') end)"


def sort_tokens(c: str) -> str:
    return f"array_to_string(list_sort({tokens(c)}), ' ')"


def address_ctes(src: str) -> str:
    """CTEs up to ``adr`` (id, address) of CTE ``src`` (id, c, land), c clean text; native scripts don't occur."""
    two = lambda d: {k: (d[k] if isinstance(d, dict) else k).replace(" ", "_") for k in d if k.count(" ") == 1}
    one = lambda d: {k: v for k, v in d.items() if " " not in k}
    land = "upper(trim(coalesce(land, '')))"

    def gated(us: str, india: str, france: str | None, key: str) -> str:
        parts = [f"case when {land} in ('US', '') then {us}[{key}] end", f"case when {land} in ('INDIA', '') then {india}[{key}] end"]
        if france:
            parts.append(f"case when {land} in ('FRANCE', '') then {france}[{key}] end")
        return f"coalesce({', '.join(parts)})"

    pair = lambda key: gated(_map(two(T.US_STATES)), _map(two(T.INDIA_STATES)), _map(two(T.FRANCE_REGIONS)), key)
    zero = "case when regexp_matches(t, '^[0-9]+$') then coalesce(nullif(ltrim(t, '0'), ''), '0') else t end"
    return f"""tk as (select id, land, unnest({tokens("c")}) as t, generate_subscripts({tokens("c")}, 1) as k from {src}),
t2 as (select *, lead(t) over w as n, lag(t) over w as p from tk window w as (partition by id order by k)),
t3 as (select id, land, k, {pair("t || ' ' || n")} as two, {pair("p || ' ' || t")} as before, coalesce({_map(T.ADDRESS_EXPANSIONS)}[{zero}], {zero}) as f from t2),
t4 as (select id, k, coalesce(two, case when before is null then coalesce({gated(_map(one(T.US_STATES)), _map(one(T.INDIA_STATES)), None, "f")}, f) end) as v from t3),
t5 as (select id, k, v, lag(v) over (partition by id order by k) as w from t4 where v is not null),
t6 as (select id, replace(string_agg(v, ' ' order by k) filter (where w is null or v <> w), '_', ' ') as address from t5 group by id),
adr as (select s.id, coalesce(address, '') as address from {src} s left join t6 on s.id = t6.id)"""


def numbers(x: str) -> str:
    return f"list_transform(regexp_extract_all(coalesce({x}, ''), '\\b\\d+\\b'), lambda n: coalesce(nullif(ltrim(n, '0'), ''), '0'))"


def soundex(w: str) -> str:
    letters = "".join(T.SOUNDEX_GROUPS)
    codes = "".join(d * len(g) for g, d in T.SOUNDEX_GROUPS.items())
    s = f"translate(regexp_replace(upper({w}), '[AEIOUHWY]', '0', 'g'), '{letters}', '{codes}')"
    for d in "0123456":
        s = f"regexp_replace({s}, '{d}+', '{d}', 'g')"
    return f"case when regexp_matches({w}, '^[A-Za-z]+$') then rpad(substr(upper({w}), 1, 1) || replace(substr({s}, 2), '0', ''), 4, '0') else '' end"


def state(addr: str) -> str:
    return f"coalesce(list_filter({tokens(addr)}, lambda t: regexp_matches(t, '^[a-z]{{2}}$'))[1], '')"


def postal(nums: str) -> str:
    return f"coalesce(list_filter({nums}, lambda n: len(n) in (5, 6))[1], '')"


def core(name: str) -> str:
    stop = ", ".join(map(_q, T.BLOCKING_STOPWORDS))
    return f"array_to_string(list_sort(list_filter({tokens(name)}, lambda w: len(w) >= 2 and w not in ({stop}))), ' ')"


def long_ngrams(x: str) -> str:
    """``ngrams`` of 3 over a column of characters, for texts so long that substrings by position would count too far."""
    return f"(case when len({x}) = 0 then [] when len({x}) < 3 then [array_to_string({x}, '')] else list_distinct(list_transform(list_zip({x}[:-3], {x}[2:-2], {x}[3:]), lambda z: z[1] || z[2] || z[3])) end)"


def ngrams(x: str, n: int = 3) -> str:
    return f"(case when {x} = '' then [] when len({x}) < {n} then [{x}] else list_distinct(list_transform(range(1, len({x}) - {n - 2}), lambda i: substr({x}, i, {n}))) end)"


#: Documents as entity records: the first line is the name, all others are the address; a third each is source 1, 2, 3.
ENTITIES = """
ent as (select 'S' || (1 + doc_id % 3) || '-' || doc_id as entity_id, split_part(text, chr(10), 1) as business_name,
               case when contains(text, chr(10)) then substr(text, strpos(text, chr(10)) + 1) else '' end as business_address,
               case lang when 'en' then 'US' when 'fr' then 'France' else '' end as country
        from documents)"""


def prepared() -> str:
    """CTEs up to ``rec``: entity_id, country, name, address, numbers, state, postal."""
    return f"""{ENTITIES},
cl as (select *, {clean("business_name")} as cn, {clean("business_address")} as ca, {numbers("business_address")} as numbers from ent),
src as (select entity_id as id, ca as c, country as land from cl),
{address_ctes("src")},
na as (select entity_id, country, numbers, {name_of_clean("cn")} as name, address from cl join adr on adr.id = cl.entity_id),
rec as (select *, {state("address")} as state, {postal("numbers")} as postal from na)"""


def keys() -> str:
    """CTEs up to ``key_rows``: entity_id, key_order, key."""
    generic = ", ".join(map(_q, T.GENERIC_STREET_WORDS))
    return f"""{prepared()},
sk as (select *, {core("name")} as core, {soundex("string_split(name, ' ')[1]")} as sound,
              list_filter({tokens("address")}, lambda w: len(w) >= 4 and not regexp_matches(w, '^[0-9]+$') and w not in ({generic}))[1] as street,
              len({tokens("address")}) as n_words from rec),
kl as (select entity_id, list_filter([
         case when state <> '' and len(name) >= 3 then 'st_nm3:' || country || ':' || state || ':' || substr(name, 1, 3) end,
         case when state <> '' and len(name) >= 3 then 'st_nm4:' || country || ':' || state || ':' || substr(name, 1, 4) end,
         case when postal <> '' and len(name) >= 3 then 'zip_nm:' || country || ':' || postal || ':' || substr(name, 1, 3) end,
         case when len(numbers) > 0 and n_words >= 2 then 'num_street:' || country || ':' || numbers[1] || ':' || substr(street, 1, 4) end,
         case when len(core) >= 4 then 'nm_sort4:' || country || ':' || substr(core, 1, 4) end,
         case when sound <> '' and state <> '' then 'st_soundex:' || country || ':' || state || ':' || sound end
       ], lambda k: k is not null) as ks from sk),
key_rows as (select entity_id, unnest(ks) as key, cast(generate_subscripts(ks, 1) - 1 as int) as key_order from kl)"""


def capped(limit: int, cap: int) -> str:
    """CTEs up to ``pairs``: s1_id, candidate_id, key_order."""
    return f"""{keys()},
idx as (select distinct key, entity_id as target_id from key_rows where entity_id not like 'S1-%'),
ok as (select key from idx group by key having count(*) <= {limit}),
jp as (select k.entity_id as s1_id, i.target_id as candidate_id, min(k.key_order) as key_order
       from key_rows k join idx i on k.key = i.key join ok on ok.key = k.key where k.entity_id like 'S1-%' group by 1, 2),
pairs as (select s1_id, candidate_id, key_order from jp
          qualify row_number() over (partition by s1_id order by key_order, candidate_id) <= {cap})"""
