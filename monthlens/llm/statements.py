"""DuckDB SQL of the Merkle manifest and the filter audit, the plain way."""

from __future__ import annotations

AUDIT = r"""
with texts as (
    select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
        min(doc_id) over (partition by coalesce(text, '')) as least
    from documents
),
worded as (
    select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words from texts
),
flags as (
    select doc_id, coalesce(max((quality = 1)::int), 0) as good,
        coalesce(max((toxic = 1)::int), 0) as toxic
    from labels where doc_id is not null group by doc_id
),
masks as (
    select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
        if(len(words) < 50, 1, 0)
        + if(100 * len(list_distinct(words)) < 65 * len(words), 2, 0)
        + if(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text), 4, 0)
        + if(regexp_matches(text, '[#$%&*|]'), 8, 0)
        + if(least is not null and (doc_id is null or doc_id > least), 16, 0) as mask
    from worded left join flags using (doc_id)
),
cells as (
    select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic
    from masks group by part, mask
),
letters(letter, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders as (
    select a.letter || b.letter || c.letter || d.letter || e.letter as filter_order,
        [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
    from letters a, letters b, letters c, letters d, letters e
    where a.bit | b.bit | c.bit | d.bit | e.bit = 31
),
steps as (
    select filter_order, step::int as step, bits[step] as bit,
        list_sum(bits[1:step - 1])::int as before
    from orders, range(1, 6) r(step)
),
rows as (
    select part, filter_order, step, bit,
        coalesce(sum(n) filter (where mask & (coalesce(before, 0) | bit) = 0), 0) as kept,
        coalesce(sum(n) filter (where mask & bit > 0 and mask & coalesce(before, 0) = 0), 0) as removed,
        coalesce(sum(n) filter (where mask & bit > 0 and mask & coalesce(before, 0) > 0), 0) as redundant,
        coalesce(sum(n) filter (where mask = bit), 0) as unique_fails,
        coalesce(sum(good) filter (where mask & bit > 0 and mask & coalesce(before, 0) = 0), 0) as good_lost,
        coalesce(sum(toxic) filter (where mask & bit > 0 and mask & coalesce(before, 0) = 0), 0) as toxic_lost
    from cells, steps group by part, filter_order, step, bit
)
select part, filter_order, step, kept::bigint as kept, removed::bigint as removed,
    redundant::bigint as redundant, unique_fails::bigint as unique_fails,
    good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
    (sum(removed) over (partition by part, bit))::bigint as shapley
from rows
"""


def _field(name: str) -> str:
    return f"coalesce(strlen({name}::varchar) || ':' || {name}::varchar, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


def _levels(name: str, depth: int) -> str:
    """CTEs ``name``1 to ``name``depth: the levels above ``name``0 (part, rank, digest)."""
    return ",\n".join(
        f"""{name}{k} as (
    select part, rank // 16 as rank,
        if(max(total) = 1, any_value(digest), sha256(string_agg(digest, '' order by rank))) as digest
    from (select *, count(*) over (partition by part) as total from {name}{k - 1})
    group by part, rank // 16
)"""
        for k in range(1, depth + 1)
    )


def _folds(source: str, name: str, depth: int, result: str) -> str:
    """CTEs that lead the rows of ``source`` up through the levels of ``name``."""
    steps, before = [], source
    for k in range(depth):
        after = f"{result}{k + 1}"
        steps.append(
            f"""{after} as (
    select any_value(columns(f.* exclude (fold, proof, part, rank, key))), f.key, f.part,
        any_value(f.rank) // 16 as rank,
        any_value(f.proof) || coalesce(string_agg(n.digest, '' order by n.rank)
            filter (where n.rank <> f.rank), '') as proof,
        if(any_value(n.total) = 1, any_value(f.fold),
            sha256(string_agg(if(n.rank = f.rank, f.fold, n.digest), '' order by n.rank))) as fold
    from {before} f join
        (select *, count(*) over (partition by part) as total from {name}{k}) n
        on n.part is not distinct from f.part and n.rank // 16 = f.rank // 16
    group by f.key, f.part
)"""
        )
        before = after
    return ",\n".join(steps)


_CHECKSUM = """list_reduce(
    list_concat([4294967295], list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
    lambda crc, byte: list_reduce(
        [xor(crc, byte), 1, 1, 1, 1, 1, 1, 1, 1],
        lambda x, again: xor(x >> 1, (x & 1) * 3988292384)))"""

#: Levels of 16 within a source and over the sources: enough for 16**6 rows of one source.
_DEEP, _WIDE = 6, 3

MANIFEST = f"""
with rows as (
    select doc_id, source as part, {_leaf("text")} as leaf,
        if(doc_id is not null and xor({_CHECKSUM}, 4294967295) % 5 = 0,
            {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")},
            {_leaf("text")}) as fold
    from documents
),
placed as (
    select *, row_number() over (order by part nulls first, doc_id nulls first, leaf) as key,
        row_number() over (partition by part order by doc_id nulls first, leaf) - 1 as rank,
        '' as proof
    from rows
),
node0 as (select part, rank, leaf as digest from placed),
{_levels("node", _DEEP)},
source0 as (
    select '' as part, row_number() over (order by part nulls first) - 1 as rank, digest,
        part as source
    from node{_DEEP}
),
{_levels("source", _WIDE)},
{_folds("placed", "node", _DEEP, "climbed")},
joined as (
    select c.* exclude (part, rank), s.part, s.rank, s.digest as subroot
    from climbed{_DEEP} c join source0 s on s.source is not distinct from c.part
),
{_folds("joined", "source", _WIDE, "topped")}
select doc_id, leaf, subroot, digest as root, sha256(proof) as proof_sha256,
    fold as folded_root, fold = digest as verified
from topped{_WIDE}, source{_WIDE}
"""
