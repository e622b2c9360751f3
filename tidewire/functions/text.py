"""Text, HTML and image-address cleaning. Every function takes and returns a Column."""

from __future__ import annotations

import html
import html.entities
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from tidewire import config as C
from tidewire.functions.let import let

# White space that is squeezed, ranges of Chinese characters, and what may end a phrase.
SPACE = r"[ \t\r\n\x0B\f\u00a0\u3000]+"
CJK = r"\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
TRAILING = r"[\s>»＞|·・—\-–:：,，.。!！?？、]+$"
#: An HTML reference with its semicolon.
REFERENCE = re.compile(r"&(#[0-9]+|#[xX][0-9a-fA-F]+|[0-9a-zA-Z]+);")


@F.pandas_udf(StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


@F.pandas_udf(StringType())
def _unescape_whole(s: pd.Series) -> pd.Series:
    named = html.entities.html5  # all in here, as the workers need not have this package
    whole = lambda m: html.unescape(m[0]) if m[1][0] == "#" or m[1] + ";" in named else m[0]
    return s.map(lambda x: REFERENCE.sub(whole, x), na_action="ignore")


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def unescape(c: Column, whole: bool = False) -> Column:
    """HTML entities resolved; only text with an ampersand leaves the JVM. Old names such as `&amp`
    need no semicolon; with `whole`, a reference without one is text."""
    return F.coalesce((_unescape_whole if whole else _unescape)(F.when(F.contains(c, F.lit("&")), c)), c)


def nfkc(c: Column) -> Column:
    """Compatibility normal form; only text that is not ASCII leaves the JVM."""
    return F.coalesce(_nfkc(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(F.coalesce(c, F.lit("")), SPACE, " "))


def strip_tags(c: Column) -> Column:
    """Script and style go with their content, block ends become spaces, other tags vanish."""

    def bare(s: Column) -> Column:
        t = F.regexp_replace(s, r"(?is)<(script|style)[^>]*>.*?</\1\s*>", " ")
        t = F.regexp_replace(t, r"(?i)<br\s*/?>|</p\s*>|</div\s*>|</li\s*>|</h\d\s*>", " ")
        return F.when(F.contains(s, F.lit("<")), F.regexp_replace(t, r"<[^>]+>", "")).otherwise(s)

    return let(c, bare)


def html_to_text(c: Column, whole: bool = False) -> Column:
    t = unescape(strip_tags(unescape(F.coalesce(c, F.lit("")), whole)), whole)
    return strip(F.regexp_replace(F.replace(t, F.lit("\u200b"), F.lit("")), SPACE, " "))


def truncate(c: Column, limit: int = C.MAX_SUMMARY_CHARS) -> Column:
    def short(t: Column) -> Column:
        return F.when(F.length(t) <= limit, t).otherwise(F.concat(F.regexp_replace(F.substring(t, 1, limit - 1), r"(?U)\s+$", ""), F.lit("…")))

    return let(c, lambda s: F.when(F.length(s) > 0, let(strip(s), short)))


def is_boilerplate(c: Column) -> Column:
    """Nothing but navigation: a whole-line pattern, or a known phrase with fewer than 8 characters
    after it."""
    t = F.lower(F.regexp_replace(strip(F.coalesce(c, F.lit(""))), TRAILING, ""))
    phrases = "|".join(C.BOILERPLATE)
    return t.rlike("|".join((r"^$", rf"^(?s:(?:{phrases}).{{0,7}})$", *C.BOILERPLATE_PATTERNS)))


def summary_of(text: Column) -> Column:
    return let(truncate(text), lambda t: F.when(t.isNotNull() & ~is_boilerplate(t) & (F.length(t) >= C.SUMMARY_MIN_CHARS), t))


def clean_summary(c: Column, whole: bool = False) -> Column:
    return summary_of(html_to_text(c, whole))


def detect_lang(c: Column) -> Column:
    t = F.coalesce(c, F.lit(""))
    cjk = F.length(F.regexp_replace(t, f"[^{CJK}]", ""))
    latin = F.length(F.regexp_replace(t, "[^A-Za-z]", ""))
    return F.when((cjk > 0) & (3 * cjk >= latin), "zh").when(latin > 0, "en").otherwise("other")


def clean_image_url(c: Column) -> Column:
    u = F.regexp_replace(strip(unescape(c)), "^[\"']+|[\"']+$", "")
    u = F.when(u.rlike("^//[^/]"), F.concat(F.lit("https:"), u)).otherwise(u)
    return F.when((F.length(u) <= C.IMAGE_MAX_CHARS) & u.rlike("(?i)^https?://"), u)


def is_plausible_image(u: Column) -> Column:
    hit = F.lit(False)
    for p in C.IMAGE_DENY:
        hit = hit | F.contains(F.lower(u), F.lit(p))
    return ~hit


def first_image(c: Column) -> Column:
    """The first usable address of the first dozen <img> tags; lazy-loading attributes go before
    src within a tag."""
    tags = F.slice(F.regexp_extract_all(unescape(F.coalesce(c, F.lit(""))), F.lit(r"(?i)<img\b[^>]*>"), F.lit(0)), 1, C.IMAGE_SCAN_TAGS)
    value = lambda t, a: F.regexp_extract(t, rf"(?i)(?<![\w-]){a}\s*=\s*(\"[^\"]+\"|'[^']+'|[^\s\"'>]+)", 1)
    found = F.flatten(F.transform(tags, lambda t: F.array(*[value(t, a) for a in ("data-original", "data-src", "data-lazy-src", "src")])))
    tidy = lambda u: F.regexp_replace(F.trim(u), "^[\"'\\s]+|[\"'\\s]+$", "")
    whole = F.transform(found, lambda u: F.when(tidy(u).rlike("^//[^/]"), F.concat(F.lit("https:"), tidy(u))).otherwise(tidy(u)))
    good = F.filter(whole, lambda u: (F.length(u) <= C.IMAGE_MAX_CHARS) & u.rlike("(?i)^https?://") & is_plausible_image(u))
    return F.try_element_at(good, F.lit(1))


def media_image(media: Column) -> Column:
    """First usable address of an array of (url, type): a type, if given, must be an image."""
    ok = F.filter(media, lambda m: (F.coalesce(m["type"], F.lit("")) == "") | F.startswith(m["type"], F.lit("image")))
    url = F.filter(F.transform(ok, lambda m: F.trim(m["url"])), lambda u: (F.length(u) <= C.IMAGE_MAX_CHARS) & u.rlike("(?i)^(https?:)?//"))
    first = F.try_element_at(url, F.lit(1))
    return F.when(first.rlike("^//"), F.concat(F.lit("https:"), first)).otherwise(first)
