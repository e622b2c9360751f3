"""Title normalisation, n-gram sets and what is decided with them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidewire import config as C
from tidewire.functions.text import CJK, SPACE, nfkc

ENTITY = r"(?U)\b[A-Z][A-Za-z0-9]*(?:[.\-][A-Za-z0-9]+)*\b"


def normalize_title(c: Column) -> Column:
    return F.regexp_replace(F.lower(nfkc(F.coalesce(c, F.lit("")))), f"[^0-9a-z{CJK}]+", "")


def normalize_for_compare(c: Column) -> Column:
    return F.regexp_replace(F.lower(nfkc(c)), SPACE, "")


def _grams(t: Column, n: int) -> Column:
    """All n-grams in order; one linear pass, where substring by place would be quadratic."""
    return F.regexp_extract_all(t, F.lit(f"(?=(.{{{n}}}))"), F.lit(1))


def blocking_grams(t: Column, n: int) -> Column:
    """Distinct n-grams; a shorter text is one gram, an empty one none."""
    return F.when(t == "", F.array().cast("array<string>")).when(F.length(t) < n, F.array(t)).otherwise(F.array_distinct(_grams(t, n)))


def trigram_set(t: Column) -> Column:
    return blocking_grams(t, 3)


def shingle_set(t: Column) -> Column:
    both = F.array_distinct(F.concat(_grams(t, 2), _grams(t, 3)))
    return F.when(t == "", F.array().cast("array<string>")).when(F.length(t) < 3, F.array(t)).otherwise(both)


def jaccard(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(common / (F.size(a) + F.size(b) - common))


def entities(title: Column, stop: tuple[str, ...] = C.ENTITY_STOP) -> Column:
    found = F.filter(F.regexp_extract_all(F.coalesce(title, F.lit("")), F.lit(ENTITY), F.lit(0)), lambda e: F.length(e) >= 2)
    return F.array_except(F.array_distinct(found), F.array(*map(F.lit, stop)).cast("array<string>"))


def length_ratio_ok(a: Column, b: Column) -> Column:
    return F.least(F.length(a), F.length(b)) >= C.DUP_LENGTH_RATIO * F.greatest(F.length(a), F.length(b))


def containment(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.least(F.size(a), F.size(b))


def is_duplicate(title_a: Column, title_b: Column) -> Column:
    """Equal normalised titles, or similar lengths and 90 % of the smaller set of 3-grams shared."""
    a, b = normalize_title(title_a), normalize_title(title_b)
    near = length_ratio_ok(a, b) & (containment(trigram_set(a), trigram_set(b)) >= C.DUP_CONTAINMENT)
    return F.when((a == "") | (b == ""), F.lit(False)).otherwise((a == b) | near)


def same_event(similarity: Column, shared: Column) -> Column:
    """Why two titles tell of one event: how similar their 2- and 3-grams are, if that is enough, or
    else the rare names that they share (sorted); null if neither tells."""
    return F.when(similarity >= C.CLUSTER_JACCARD, F.format_string("标题相似度 %.2f", similarity)).when(
        F.size(shared) >= C.CLUSTER_SHARED_ENTITIES, F.concat(F.lit("共同实体："), F.array_join(F.slice(shared, 1, 3), "、"))
    )
