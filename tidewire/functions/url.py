"""URL canonicalisation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Query parameters that only track where a visitor came from, and prefixes of such.
TRACKING_PARAMS = (
    "fbclid", "gclid", "spm", "ref", "source", "from", "share_token",
    "mc_cid", "mc_eid", "igshid", "_hsenc", "_hsmi", "yclid", "weibo_id",
)
TRACKING_PREFIXES = ("utm_",)

PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?//([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def _form_decode(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), F.translate(c, "+", " "))


def _form_encode(c: Column) -> Column:
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _query(raw: Column) -> Column:
    """Parameters in their order, without blank values and tracking, form-encoded."""
    pairs = F.transform(
        F.split(raw, "&"),
        lambda p: F.struct(
            _form_decode(F.regexp_extract(p, r"^([^=]*)=", 1)).alias("k"), _form_decode(F.regexp_extract(p, r"^[^=]*=(.*)$", 1)).alias("v")
        ),
    )
    tracking = F.array(*map(F.lit, TRACKING_PARAMS))
    kept = F.filter(
        pairs,
        lambda p: (p["v"] != "")
        & ~F.array_contains(tracking, F.lower(p["k"]))
        & ~F.exists(F.array(*map(F.lit, TRACKING_PREFIXES)), lambda x: F.startswith(F.lower(p["k"]), x)),
    )
    return F.array_join(F.transform(kept, lambda p: F.concat(_form_encode(p["k"]), F.lit("="), _form_encode(p["v"]))), "&")


def canonical_url(url: Column) -> Column:
    """A comparable form: https for http, host in lower case without `www.`, default port, user and
    fragment, path without double and trailing slashes, query without tracking and blank values.
    Null gives an empty string; text without a host, or with a port that is no number, is returned
    trimmed and otherwise as it is."""
    t = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"^\s+|\s+$", ""), r"[\t\r\n]", "")
    scheme, netloc, path, query = (F.regexp_extract(t, PARTS, i) for i in range(1, 5))
    server = F.regexp_replace(netloc, r"^.*@", "")
    host = F.regexp_replace(F.lower(F.regexp_replace(server, r":[^:\]]*$", "")), r"^www\.|[\[\]]", "")
    port = F.regexp_extract(server, r":([^:\]]*)$", 1)
    bad = ~port.rlike(r"^\d*$")
    number = F.when(port != "", F.regexp_replace(port, r"^0+(?=\d)", ""))
    host = F.when(number.isin("0", "80", "443") | number.isNull(), host).otherwise(F.concat(host, F.lit(":"), number))
    scheme = F.when(F.lower(scheme).isin("", "http", "https"), F.lit("https")).otherwise(F.lower(scheme))
    path = F.regexp_replace(F.regexp_replace(path, r"/{2,}", "/"), r"/+$", "")
    path = F.when(path == "", F.lit("/")).otherwise(path)
    query = _query(query)
    full = F.concat(scheme, F.lit("://"), host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when((netloc == "") | bad, t).otherwise(full)


def _without_dots(path: Column) -> Column:
    """The path without `.` and `..` segments; one of these at the end leaves a slash."""
    up, here = F.lit(".."), F.lit(".")
    parts = F.split(F.regexp_replace(path, r"^/", ""), "/", -1)
    parts = F.when(F.element_at(parts, -1).isin("..", "."), F.concat(parts, F.array(F.lit("")))).otherwise(parts)
    step = lambda out, x: F.when(x == up, F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0)))).when(x == here, out).otherwise(F.concat(out, F.array(x)))
    return F.concat(F.lit("/"), F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/"))


def resolve_url(ref: Column, base: Column) -> Column:
    """What `ref` stands for on the page `base`, as RFC 3986 has it. A reference with a scheme stays
    as it is; null if any other one has no `://` in its base."""
    r, b = (F.regexp_replace(F.regexp_replace(c, r"^\s+|\s+$", ""), r"[\t\r\n]", "") for c in (ref, base))
    whole = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?"
    scheme, netloc, path, query = (F.regexp_extract(b, whole, i) for i in range(1, 5))
    site = F.concat(scheme, F.lit("://"), netloc)
    own, rest = F.regexp_extract(r, r"^([^?#]*)", 1), F.regexp_extract(r, r"^[^?#]*(.*)$", 1)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, r"[^/]*$", ""))
    under = F.when(F.startswith(own, F.lit("/")), own).otherwise(F.concat(folder, own))
    under = F.when(under.rlike(r"/\.{1,2}(/|$)"), _without_dots(under)).otherwise(under)
    return (
        F.when(r.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), r).when(~b.rlike(whole), F.lit(None).cast("string"))
        .when(F.startswith(r, F.lit("//")), F.concat(scheme, F.lit(":"), r)).when((own == "") & ~F.startswith(rest, F.lit("?")), F.concat(site, path, query, rest))
        .when(own == "", F.concat(site, path, rest)).otherwise(F.concat(site, under, rest))
    )


def article_id(canonical: Column) -> Column:
    """Stable id of an article: the first 16 hex digits of the canonical URL's SHA-1."""
    return F.substring(F.sha1(canonical.cast("binary")), 1, 16)
