"""DuckDB text for expressions that more than one query needs."""

from __future__ import annotations

from tidewire.functions.url import PARTS, TRACKING_PARAMS


def canonical_url_sql(url: str) -> str:
    """What functions.url.canonical_url gives for URLs without user, port and escapes in the query."""
    part = lambda i: f"regexp_extract(trim({url}), '{PARTS}', {i})"
    names = ", ".join(f"'{x}'" for x in TRACKING_PARAMS)
    kept = (
        f"list_filter(string_split({part(4)}, '&'), lambda p: regexp_extract(p, '^[^=]*=(.*)$', 1) <> '' "
        f"AND NOT list_contains([{names}], lower(regexp_extract(p, '^([^=]*)=', 1))) AND NOT starts_with(lower(p), 'utm_'))"
    )
    path = f"regexp_replace(regexp_replace({part(3)}, '/{{2,}}', '/', 'g'), '/+$', '')"
    return (
        f"(CASE WHEN {part(2)} = '' THEN trim({url}) ELSE "
        f"(CASE WHEN lower({part(1)}) IN ('', 'http', 'https') THEN 'https' ELSE lower({part(1)}) END) || '://' || "
        f"regexp_replace(lower({part(2)}), '^www\\.', '') || (CASE WHEN {path} = '' THEN '/' ELSE {path} END) || "
        f"(CASE WHEN len({kept}) > 0 THEN '?' || array_to_string({kept}, '&') ELSE '' END) END)"
    )
