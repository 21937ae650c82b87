"""Text cleaning: key normaliser, ordered rule categoriser, changed flag."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillsight.functions.labels import REASON_DEFAULT, REASON_EMPTY_VALUES, REASON_RULES


def normalise_key(col: Column) -> Column:
    """``lower(collapse_whitespace(trim(coalesce(x, ''))))``.

    ``trim`` strips spaces only (like ``btrim``); ``\\s+`` then collapses runs
    of ASCII whitespace, as the reference's regex does.
    """
    return F.lower(F.regexp_replace(F.trim(F.coalesce(col, F.lit(""))), r"\s+", " "))


def categorise(key: Column,
               empty_values: Iterable[str] = REASON_EMPTY_VALUES,
               rules: Sequence[tuple[Sequence[str], str]] = REASON_RULES,
               default: str = REASON_DEFAULT) -> Column:
    """First matching rule wins: set membership, then ordered substrings.

    ``rules`` is a list of ``(substrings, label)``; a rule matches when the key
    contains any of its substrings. Unmatched keys get ``default``. The result
    is one CASE expression, evaluated once per row inside codegen.
    """
    expr = F.when(key.isin(list(empty_values)), F.lit(default))
    for substrings, label in rules:
        cond = None
        for s in substrings:
            c = key.contains(s)
            cond = c if cond is None else (cond | c)
        expr = expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def matched_any_rule(key: Column, empty_values: Iterable[str] = REASON_EMPTY_VALUES,
                     rules: Sequence[tuple[Sequence[str], str]] = REASON_RULES) -> Column:
    """True when some rule (or the empty set) explains the key.

    Unmatched spellings share the default label with the empties; this flag
    keeps them countable.
    """
    cond = key.isin(list(empty_values))
    for substrings, _ in rules:
        for s in substrings:
            cond = cond | key.contains(s)
    return cond


def changed(original: Column, cleaned: Column) -> Column:
    """Null-safe "cleaning changed the value" (``IS DISTINCT FROM``)."""
    return ~original.eqNullSafe(cleaned)
