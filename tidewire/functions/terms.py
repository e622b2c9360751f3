"""Topic terms and signal categories."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from tidewire import config as C


def _quote(term: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", term.lower())


def matched_terms(title: Column, summary: Column, latin: tuple[str, ...] = C.LATIN_TERMS, cjk: tuple[str, ...] = C.CJK_TERMS) -> Column:
    """Terms that occur, longest first: Latin ones not next to a letter or digit, others anywhere."""
    hay = F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(summary, F.lit(""))))
    hits = [F.when(hay.rlike(rf"(?<![a-z0-9]){_quote(t)}(?![a-z0-9])"), F.lit(t)) for t in sorted(latin, key=len, reverse=True)]
    hits += [F.when(F.contains(hay, F.lit(t.lower())), F.lit(t)) for t in sorted(cjk, key=len, reverse=True)]
    return F.filter(F.array(*hits), lambda x: x.isNotNull())


def is_related(title: Column, summary: Column, latin: tuple[str, ...] = C.LATIN_TERMS, cjk: tuple[str, ...] = C.CJK_TERMS) -> Column:
    return F.size(matched_terms(title, summary, latin, cjk)) > 0


def should_keep(flag: Column, title: Column, summary: Column) -> Column:
    return ~flag | is_related(title, summary)


def _hit(hay: Column, term: str) -> Column:
    t = term.lower()
    if t.isascii() and " " not in t and t.replace("-", "").isalpha():
        return hay.rlike(rf"(?<![a-z]){_quote(t)}(?![a-z])")
    return F.contains(hay, F.lit(t))


def signals(title: Column, summary: Column, table: dict[str, tuple[str, ...]] = C.SIGNALS) -> Column:
    """Names of the categories that a term of occurs in title or summary, in the table's order. A
    word of Latin letters must not touch another letter; a digit next to it is fine."""
    hay = F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(summary, F.lit(""))))
    names = []
    for name, terms in table.items():
        any_of = F.lit(False)
        for t in terms:
            any_of = any_of | _hit(hay, t)
        names.append(F.when(any_of, F.lit(name)))
    return F.filter(F.array(*names), lambda x: x.isNotNull())
