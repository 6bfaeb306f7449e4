"""Boolean trigram queries derived from regular expressions.

A query is a list of alternatives, each a set of trigrams a matching text must all
contain (in lower case). None means that nothing is mandatory: such a rule has to scan
every text.
"""

from __future__ import annotations

from itertools import product
from re import _constants as op
from re import _parser

MOST_STRINGS = 64  # beyond so many alternatives a run of letters is cut

Query = list[frozenset[str]] | None


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return b if a is None else a
    return _smallest([x | y for x, y in product(a, b)])


def _smallest(query: Query) -> Query:
    """Without alternatives that another alternative already covers."""
    found = sorted(set(query), key=lambda s: (len(s), sorted(s)))
    return [s for i, s in enumerate(found) if not any(t <= s for t in found[:i])]


def _of_strings(strings: set[str]) -> Query:
    if any(len(s) < 3 for s in strings):
        return None
    return _smallest([frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings])


def _strings(node) -> set[str] | None:
    """All texts a piece can match, in lower case, if they are few."""
    kind, value = node
    if kind is op.LITERAL:
        return {chr(value).lower()}
    if kind is op.IN and all(k is op.LITERAL for k, _ in value):
        return {chr(v).lower() for _, v in value}
    if kind is op.SUBPATTERN:
        return _joined(value[3])
    if kind is op.BRANCH:
        options = [_joined(b) for b in value[1]]
        return None if None in options else set().union(*options)
    if kind is op.MAX_REPEAT and value[1] <= 3:
        one = _joined(value[2])
        if one is not None:
            times = [{"".join(p) for p in product(one, repeat=n)} for n in range(value[0], value[1] + 1)]
            return set().union(*times)
    return None


def _joined(nodes) -> set[str] | None:
    out = {""}
    for node in nodes:
        more = _strings(node)
        if more is None or len(out) * len(more) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in more}
    return out


def _query(nodes) -> Query:
    found: Query = None
    run = {""}
    for node in nodes:
        more = _strings(node)
        if more is not None and len(run) * len(more) <= MOST_STRINGS:
            run = {a + b for a in run for b in more}
            continue
        found, run = _both(found, _of_strings(run)), {""} if more is None else more
        kind, value = node
        if more is None and kind is op.SUBPATTERN:
            found = _both(found, _query(value[3]))
        elif more is None and kind is op.MAX_REPEAT and value[0] > 0:
            found = _both(found, _query(value[2]))
    return _both(found, _of_strings(run))


def trigram_query(pattern: str) -> Query:
    """The alternatives of mandatory trigrams of `pattern`, or None."""
    return _query(_parser.parse(pattern))
