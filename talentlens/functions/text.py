"""Taxonomy predicates (T1–T11) as native Column expressions.

All matching is done with built-in functions (``contains``, ``InSet``,
higher-order ``filter``/``exists`` for lists) so it runs inside the JVM; no Python
worker is involved.  Conditions over a taxonomy are written as SQL over a column's name:
built call by call, the literals alone would cost seconds a plan.  Keyword matching is *substring* matching of distinct
keywords, as in the semantics being reproduced ("map" matches "roadmap"); a
taxonomy is compiled once into groups that one scan for a shared string can
rule out, as plain conditions that whole-stage code generation takes in.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lower0(c) -> Column:
    """Null-safe lower case (``NULL`` → ``''``)."""
    return F.lower(F.coalesce(col(c), F.lit("")))


def quoted(s: str) -> str:
    """A SQL text literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _listed(values: Iterable[str]) -> str:
    return ", ".join(map(quoted, dict.fromkeys(values))) or "NULL"


def in_set(c: str, values: Iterable[str]) -> Column:
    """Exact membership; a literal list becomes an ``InSet`` hash lookup."""
    return F.expr(f"{c} IN ({_listed(values)})")


#: Characters of a text for which the use of a guard is weighed.
TYPICAL_LENGTH = 400


@functools.cache
def keyword_plan(keywords: tuple[str, ...]) -> tuple[tuple[str | None, tuple[str, ...]], ...]:
    """Groups (guard, keywords) of distinct keywords: a text without the guard holds none of the group's keywords.

    A guard is a string of three or more characters that several keywords share (often a keyword itself), so that one
    scan of a text settles them all.  Taken are, one after another, the guards that save most scans: all but one where
    a text lacks it.  How likely a text holds it is reckoned from the characters' frequencies in the keywords.
    Keywords that no guard covers stand under ``None``.
    """
    letters = Counter("".join(keywords))
    total = sum(letters.values())

    def saved(guard: str, members: list[str]) -> float:
        present = min(1.0, TYPICAL_LENGTH * math.prod(letters[c] / total for c in guard))
        return len(members) - 1 - present * len(members)

    left, groups = list(keywords), []
    while True:
        shared: dict[str, list[str]] = {}
        for k in left:
            for s in {k[i:j] for i in range(len(k)) for j in range(i + 3, len(k) + 1)}:
                shared.setdefault(s, []).append(k)
        best = max(((saved(s, m), len(s), s) for s, m in shared.items() if len(m) > 1), default=(0.0, 0, ""))
        if best[0] <= 0:
            return (*groups, *(((None, tuple(left)),) if left else ()))
        groups.append((best[2], tuple(shared[best[2]])))
        left = [k for k in left if k not in shared[best[2]]]


def any_substring(text: str, keywords: Iterable[str]) -> Column:
    """Any keyword occurs in the column ``text`` (already lower-cased)."""
    return F.expr(" OR ".join(f"contains({text}, {quoted(k)})" for k in _shortest(keywords)) or "false")


def _shortest(keywords: Iterable[str]) -> list[str]:
    """The keywords that hold no other one: a text that holds any keyword holds one of these."""
    words = list(dict.fromkeys(keywords))
    return [k for k in words if not any(o != k and o in k for o in words)]


def count_substrings(text: str, keywords: Iterable[str]) -> Column:
    """T4: number of *distinct* keywords occurring in the column ``text`` (null: none), by the groups of ``keyword_plan``."""
    parts = []
    for guard, members in keyword_plan(tuple(dict.fromkeys(keywords))):
        hits = " + ".join("1" if k == guard else f"int(contains({text}, {quoted(k)}))" for k in members)
        parts.append(hits if guard is None else f"CASE WHEN contains({text}, {quoted(guard)}) THEN {hits} ELSE 0 END")
    return F.expr(f"coalesce({' + '.join(parts) or '0'}, 0)")


# every character Python's str.strip() removes (derived by rule, not listed)
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())


def py_strip(c) -> Column:
    """Python ``str.strip()``: trims all Unicode whitespace, not only spaces."""
    return F.btrim(col(c), F.lit(PY_WHITESPACE))


def split_items(joined) -> Column:
    """Split a ``|``-joined list; elements stripped, empty ones dropped."""
    return F.array_remove(F.transform(F.split(col(joined), r"\|"), py_strip), "")


def _members(items: str, values: Iterable[str]) -> str:
    return f"size(filter({items}, x -> x IN ({_listed(values)})))"


def count_members(items: str, values: Iterable[str]) -> Column:
    """T5: elements of the column ``items`` (duplicates counted) that are in ``values``."""
    return F.expr(_members(items, values))


def any_member(items: str, values: Iterable[str]) -> Column:
    """T6 any."""
    return F.expr(f"exists({items}, x -> x IN ({_listed(values)}))")


def all_members(items: str, values: Iterable[str]) -> Column:
    """T6 all, with the empty list → False (``forall([])`` is true in Spark)."""
    return F.expr(f"size({items}) > 0 AND forall({items}, x -> x IN ({_listed(values)}))")


def member_ratio(items: str, values: Iterable[str]) -> Column:
    """T6 ratio; empty list → 0.0."""
    return F.expr(f"CASE WHEN size({items}) > 0 THEN {_members(items, values)} / size({items}) ELSE 0.0D END")


def count_distinct_members(items: str, values: Iterable[str]) -> Column:
    """Distinct elements in ``values``."""
    return F.expr(_members(f"array_distinct({items})", values))


def strip_then_contains(text: str, phrases: Iterable[str], word: str) -> Column:
    """Remove each phrase (in order), then test for ``word``."""
    t = text
    for p in phrases:
        t = f"replace({t}, {quoted(p)}, '')"
    return F.expr(f"contains({t}, {quoted(word)})")


def lookup(c, pairs, default) -> Column:
    """Dictionary lookup with default, as a CASE ladder of literals."""
    key = col(c)
    expr = None
    for k, v in pairs:
        expr = (F.when(key == F.lit(k), F.lit(v)) if expr is None
                else expr.when(key == F.lit(k), F.lit(v)))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def title_regex(c, pattern: str = "data engineer|qa|junior|intern") -> Column:
    """Regex on the lower-cased title; NULL → False."""
    return F.coalesce(F.lower(col(c)).rlike(pattern), F.lit(False))


def bool_int(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("long")


_DIGITS = "[0-9]+(_[0-9]+)*"
FLOAT_TEXT = rf"^[+-]?(({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})([eE][+-]?{_DIGITS})?|(?i:inf|infinity|nan))$"


def py_float(text: Column) -> Column:
    """The number that stripped text stands for as Python reads it, else null (no type suffixes, no hexadecimal)."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), "_", ""), "^[+-]nan$", "nan")
    return F.when(text.rlike(FLOAT_TEXT), plain.try_cast("double"))
