"""SQL for the rows of the Merkle manifest query: the same trees, grown level by level.

The proofs come from window functions over each level and not from a descent, so the SQL
shares nothing with the operator but the definition. Trees up to 8^7 leaves.
"""

from __future__ import annotations

LEVELS = 7

# CRC-32 of a text's bytes by the reflected polynomial, one bit at a time; SQL has none.
CRC32 = """xor(list_reduce(list_transform(string_split({text}, ''), lambda c: cast(ascii(c) as bigint)),
    lambda crc, byte: list_reduce(range(8), lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, xor(crc, byte)),
    cast(4294967295 as bigint)), 4294967295)"""


def _framed(value: str) -> str:
    text = f"cast({value} as varchar)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _digest(text: str) -> str:
    return f"sha256({' || '.join(_framed(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


def _levels(name: str, leaves: str) -> list[str]:
    """Tables `name`0.. with t, r, d, c (nodes left in the tree) and their siblings."""
    parts, source = [], leaves
    for level in range(LEVELS + 1):
        parts.append(f"""{name}{level} as (select *,
            case when c = 1 then '' else coalesce(string_agg(d, '') over (w rows between unbounded preceding and 1 preceding), '') end as l,
            case when c = 1 then '' else coalesce(string_agg(d, '') over (w rows between 1 following and unbounded following), '') end as g
            from ({source}) window w as (partition by t, r // 8 order by r))""")
        source = f"""select t, r // 8 as r, case when c = 1 then min(d) else sha256(string_agg(d, '' order by r)) end as d,
            (c + 7) // 8 as c from {name}{level} group by t, r // 8, c"""
    return parts


def _folded(step: str, source: str, name: str, key: str, rank: str) -> list[str]:
    """One level at a time, so that the folded digest is not nested seven deep."""
    parts = []
    for level in range(LEVELS):
        at = f"{name}{level}"
        parts.append(f"""{step}{level} as (select s.* exclude (x, p), p || n.l || n.g as p,
            case when n.c = 1 then x else sha256(n.l || x || n.g) end as x
            from {source} s join {at} n on n.t = s.{key} and n.r = s.{rank} // {8 ** level})""")
        source = f"{step}{level}"
    return parts


def manifest_sql() -> str:
    crc = CRC32.format(text="cast(doc_id as varchar)")
    small = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    last = LEVELS - 1
    parts = [
        f"""leaf as (select doc_id, coalesce('=' || lang, '') as lang_key, {_digest('text')} as leaf,
            case when {crc} % 3 = 0 then {_digest(small)} else {_digest('text')} end as x, '' as p from documents)""",
        """placed as (select *, row_number() over (partition by lang_key order by doc_id nulls first, leaf) - 1 as r,
            count(*) over (partition by lang_key) as c from leaf)""",
        *_levels("low", "select lang_key as t, r, leaf as d, c from placed"),
        f"""branch as (select t as lang_key, d as subroot, row_number() over (order by t) - 1 as br,
            count(*) over () as bc from low{LEVELS})""",
        *_levels("top", "select 'all' as t, br as r, subroot as d, bc as c from branch"),
        *_folded("up", "placed", "low", "lang_key", "r"),
        f"start as (select u.*, b.subroot, b.br, 'all' as top_key from up{last} u join branch b using (lang_key))",
        *_folded("over", "start", "top", "top_key", "br"),
    ]
    return f"""with {", ".join(parts)}
        select doc_id, leaf, subroot, top{LEVELS}.d as root, sha256(p) as proof_sha256, x as folded_root,
        x = top{LEVELS}.d as verified from over{last}, top{LEVELS}"""
