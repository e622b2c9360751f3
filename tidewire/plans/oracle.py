"""DuckDB SQL for the queries."""

from __future__ import annotations

from tidewire import config as C
from tidewire.plans.queries import CJK, FORMS, LATIN, SIGNALS, STOP
from tidewire.plans.sqltext import canonical_url_sql

NOW = "TIMESTAMP '2024-01-31 00:00:00'"
WS = r"[ \t\r\n\v\f\x{a0}\x{3000}]+"
UWS = r"[\s\p{Z}\x{85}\x{1c}-\x{1f}]"
CJK_SET = r"\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}"


def _q(s: str) -> str:
    return s.replace("'", "''")


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{UWS}+|{UWS}+$', '', 'g')"


def _squeeze(x: str) -> str:
    return _strip(f"regexp_replace(coalesce({x}, ''), '{WS}', ' ', 'g')")


def _unescape(x: str) -> str:
    for a, b in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        x = f"replace({x}, '{a}', '{b}')"
    return x


def _html(x: str) -> str:
    t = _unescape(f"coalesce({x}, '')")
    for pattern, by in ((r"(?is)<script[^>]*>.*?</script\s*>", " "), (r"(?is)<style[^>]*>.*?</style\s*>", " "), (r"(?i)<br\s*/?>|</p\s*>|</div\s*>|</li\s*>|</h\d\s*>", " "), ("<[^>]+>", "")):
        t = f"regexp_replace({t}, '{pattern}', '{by}', 'g')"
    return _strip(f"regexp_replace({_unescape(t)}, '{WS}', ' ', 'g')")


def _truncate(x: str) -> str:
    t = _strip(x)
    return f"CASE WHEN length({x}) > 0 THEN CASE WHEN length({t}) <= 240 THEN {t} ELSE regexp_replace(substr({t}, 1, 239), '{UWS}+$', '') || '…' END END"


def _summary(src: str, cols: str, x: str) -> str:
    """CTEs s1..s3 over `src`; s3 has `cols` and summary."""
    bare = f"lower(regexp_replace(short, '[{UWS[1:-1]}>»＞|·・—\\-–:：,，.。!！?？、]+$', ''))"
    phrases = ", ".join(f"'{_q(p)}'" for p in C.BOILERPLATE)
    patterns = " OR ".join(f"regexp_matches(bare, '{_q(p)}')" for p in C.BOILERPLATE_PATTERNS)
    return (
        f"s0 AS (SELECT {cols}, {_html(x)} AS flat FROM {src}), s1 AS (SELECT *, {_truncate('flat')} AS short FROM s0), s2 AS (SELECT *, {bare} AS bare FROM s1), "
        f"s3 AS (SELECT *, CASE WHEN short IS NOT NULL AND bare <> '' AND NOT ({patterns}) AND length(short) >= 20 AND NOT list_bool_or(list_transform([{phrases}], lambda p: starts_with(bare, p) AND (bare = p OR length(bare) - length(p) < 8))) THEN short END AS summary FROM s2)"
    )


TITLE = _squeeze("split_part(text, chr(10), 1)")
NORM = f"regexp_replace(lower({TITLE}), '[^0-9a-z{CJK_SET}]+', '', 'g')"
LANG = "CASE WHEN cjk > 0 AND 3 * cjk >= latin THEN 'zh' WHEN latin > 0 THEN 'en' ELSE 'other' END"
LETTERS = f"length(regexp_replace(coalesce(text, ''), '[^{CJK_SET}]', '', 'g')) AS cjk, length(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')) AS latin"


def _grams(x: str, n: int) -> str:
    return f"CASE WHEN {x} = '' THEN [] WHEN length({x}) < {n} THEN [{x}] ELSE list_distinct(list_transform(range(1, length({x}) - {n} + 2), lambda i: substr({x}, i, {n}))) END"


def _shingles(x: str) -> str:
    part = lambda n: f"list_transform(range(1, length({x}) - {n} + 2), lambda i: substr({x}, i, {n}))"
    return f"CASE WHEN {x} = '' THEN [] WHEN length({x}) < 3 THEN [{x}] ELSE list_distinct(list_concat({part(2)}, {part(3)})) END"


ARTICLES = (
    "d0 AS (SELECT doc_id, text, source, CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS rest FROM documents), "
    + _summary("d0", "doc_id, text, source", "rest")
    + f""", art AS (SELECT substr(sha1(s3.doc_id::VARCHAR), 1, 16) AS id, s3.doc_id, {TITLE} AS title, {NORM} AS norm, source AS source_id,
  0.85::DOUBLE + (coalesce(TRY_CAST(regexp_extract(source, '(\\d+)$', 1) AS INT), 0) % 6) * 0.1::DOUBLE AS source_weight,
  coalesce(TRY_CAST(regexp_extract(source, '(\\d+)$', 1) AS INT), 1) % 5 = 0 AS source_official,
  ts AS published_at, {NOW} AS first_seen_at, coalesce(ts, {NOW}) AS at_, summary, {LANG} AS lang, trunc(value)::INT AS heat
  FROM (SELECT *, {LETTERS} FROM s3) s3 LEFT JOIN events ON event_id = s3.doc_id)"""
)

_OUT = r"[^\p{L}\p{N}\p{M}_]"
#: RE2 has no Unicode word boundary: characters outside words are doubled, so that each match can
#: take one on either side.
_DOUBLED = f"' ' || regexp_replace(text, '({_OUT})', '\\1\\1', 'g') || ' '"
_FOUND = f"list_transform(regexp_extract_all({_DOUBLED}, '{_OUT}([A-Z][A-Za-z0-9]*(?:(?:\\.\\.|--)[A-Za-z0-9]+)*){_OUT}', 1), lambda w: replace(replace(w, '..', '.'), '--', '-'))"

def _entities(text: str, stop: tuple[str, ...]) -> str:
    names = ", ".join(f"'{s}'" for s in stop)
    return f"list_sort(list_filter(list_distinct({_FOUND.replace('text,', text + ',', 1)}), lambda w: length(w) >= 2 AND NOT list_contains([{names}], w)))"


ENTITIES = _entities("text", STOP)
_ENTITY_ROWS = f"e AS (SELECT doc_id AS id, unnest({ENTITIES}) AS entity FROM documents), df AS (SELECT lower(entity) AS low, count(*) AS df FROM e GROUP BY 1)"

#: Pairs a < b of rows of `src` (id, `list`) with the number of members that their lists share.
SHARED = "(SELECT x.id AS a, y.id AS b, count(*) AS c FROM (SELECT id, unnest({list}) AS k FROM {src}) x JOIN (SELECT id, unnest({list}) AS k FROM {src}) y USING (k) WHERE x.id < y.id GROUP BY ALL)"


def _events() -> str:
    """CTEs up to `edge` (a, b): events by grams or by two rare entities."""
    return (
        f"{ARTICLES}, near AS MATERIALIZED (SELECT id, norm, source_id, {_entities('title', C.ENTITY_STOP)} AS found FROM art WHERE at_ >= {NOW} - INTERVAL 720 HOUR), "
        "ent AS (SELECT id, unnest(found) AS e FROM near), few AS (SELECT lower(e) AS low FROM ent GROUP BY 1 HAVING count(*) <= 3), "
        "rares AS (SELECT id, list(e) AS rare FROM ent JOIN few ON low = lower(e) GROUP BY id), "
        "recent AS MATERIALIZED (SELECT near.id, norm, source_id, coalesce(rare, []) AS rare FROM near LEFT JOIN rares USING (id)), "
        f"sets AS MATERIALIZED (SELECT id, rare, {_shingles('norm')} AS s FROM recent), "
        f"near_pair AS (SELECT a, b FROM {SHARED.format(list='s', src='sets')} JOIN sets x ON x.id = a JOIN sets y ON y.id = b WHERE c::DOUBLE / (len(x.s) + len(y.s) - c) >= {C.CLUSTER_JACCARD}), "
        f"named_pair AS (SELECT a, b FROM {SHARED.format(list='rare', src='sets')} JOIN sets x ON x.id = a JOIN sets y ON y.id = b WHERE c >= {C.CLUSTER_SHARED_ENTITIES} AND len(x.s) > 0 AND len(y.s) > 0), "
        "edge AS MATERIALIZED (SELECT a, b FROM near_pair UNION SELECT a, b FROM named_pair)"
    )


def _members() -> str:
    return (
        f"WITH RECURSIVE {_events()}, und AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge), "
        "reach AS (SELECT a AS node, a AS other FROM und UNION SELECT reach.node, und.b FROM reach JOIN und ON reach.other = und.a), "
        "label AS (SELECT node AS id, min(other) AS cluster_id FROM reach GROUP BY node), "
        "sizes AS (SELECT cluster_id, count(*) AS cluster_size, count(DISTINCT source_id) AS independent_sources FROM label JOIN recent USING (id) GROUP BY cluster_id), "
        "member AS (SELECT label.id, sizes.* FROM label JOIN sizes USING (cluster_id))"
    )


def _hit(hay: str, term: str, edge: str) -> str:
    t = term.lower()
    single = t.isascii() and " " not in t and t.replace("-", "").isalpha()
    if edge == "a-z" and not single:
        return f"contains({hay}, '{t}')"
    return f"regexp_matches({hay}, '(^|[^{edge}]){t}([^{edge}]|$)')"


HAY = "lower(coalesce(title, '') || ' ' || coalesce(summary, ''))"
TERMS = "[" + ", ".join(
    [f"CASE WHEN {_hit('hay', t, 'a-z0-9')} THEN '{t}' END" for t in sorted(LATIN, key=len, reverse=True)]
    + [f"CASE WHEN contains(hay, '{t}') THEN '{t}' END" for t in sorted(CJK, key=len, reverse=True)]
) + "]"
SIGNAL = "[" + ", ".join(f"CASE WHEN {' OR '.join(_hit('hay', t, 'a-z') for t in ts)} THEN '{n}' END" for n, ts in SIGNALS.items()) + "]"
NOT_NULL = "list_filter({x}, lambda x: x IS NOT NULL)"
TOPIC = "(" + " OR ".join([_hit("hay", t, "a-z0-9") for t in C.LATIN_TERMS] + [f"contains(hay, '{t.lower()}')" for t in C.CJK_TERMS]) + ")"
SECONDS = "(epoch_us(TIMESTAMP '{now}') - epoch_us({ts})) / 1000000.0"
MOMENT = "CASE WHEN s < 0 THEN '刚刚' WHEN s < 3600 THEN greatest(1, floor(s / 60)::BIGINT) || ' 分钟前' WHEN s < 86400 THEN floor(s / 3600)::BIGINT || ' 小时前' WHEN s < 2592000 THEN floor(s / 86400)::BIGINT || ' 天前' ELSE floor(s / 86400)::BIGINT // 30 || ' 个月前' END"


def _scored() -> str:
    hours = f"greatest(0.0, (epoch_us({NOW}) - epoch_us(at_)) / 3600000000.0)"
    return (
        f"{_members()}, crossed AS (SELECT * FROM member WHERE cluster_size >= 2 AND independent_sources >= 2), "
        f"sig AS (SELECT art.*, cluster_id, coalesce(cluster_size, 1) AS cluster_size, coalesce(independent_sources, 1) AS n, {HAY} AS hay, {SECONDS.format(now='2024-01-31 00:00:00', ts='at_')} AS s FROM art LEFT JOIN crossed USING (id)), "
        f"sg AS (SELECT *, {NOT_NULL.format(x=SIGNAL)} AS names, {MOMENT} AS moment FROM sig), "
        "sc AS (SELECT *, round(3.0::DOUBLE * source_weight + 2.5::DOUBLE * (CASE WHEN n >= 2 THEN least(1.0::DOUBLE, (n - 1)::DOUBLE / 3) ELSE 0.0::DOUBLE END) + 1.5::DOUBLE * greatest(0.0::DOUBLE, 1 - "
        f"({hours})::DOUBLE / 72) + 0.8::DOUBLE * least(len(names), 2) + 0.4::DOUBLE * (least(coalesce(heat, 0), 1000)::DOUBLE / 1000), 3) AS score, "
        + NOT_NULL.format(x="[CASE WHEN n >= 2 THEN n || ' 个独立来源报道' WHEN cluster_size >= 2 THEN '同一事件聚合 ' || cluster_size || ' 条' END, CASE WHEN source_official THEN '官方一手来源' END, moment, CASE WHEN len(names) > 0 THEN '涉及' || array_to_string(names, '、') END, CASE WHEN coalesce(heat, 0) <> 0 THEN 'HN ' || heat || ' 分' END]")
        + " AS reasons FROM sg)"
    )


_PICK = (
    "why AS (SELECT *, CASE WHEN n >= 2 THEN n || ' 个独立来源同时报道' WHEN coalesce(heat, 0) >= 150 THEN '社区热度 ' || heat || ' 分' WHEN len(names) >= 2 THEN '命中多重信号：' || array_to_string(names, '、') WHEN source_official AND len(names) >= 1 THEN '官方来源，涉及' || names[1] END AS why FROM sc), "
    "top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY coalesce(cluster_id, id) ORDER BY score DESC, id) AS place FROM why WHERE why IS NOT NULL) WHERE place = 1 ORDER BY score DESC, id LIMIT 5)"
)
_CARD = "list_filter(list_concat([why], list_filter(reasons, lambda r: NOT ((contains(why, '信号') AND starts_with(r, '涉及')) OR (contains(why, '独立来源') AND ends_with(r, '个独立来源报道')) OR (contains(why, '社区热度') AND starts_with(r, 'HN ')))))[1:4], lambda r: r <> moment)"

_HALF = f"""WITH {ARTICLES},
old AS (SELECT * FROM art WHERE doc_id % 2 = 0), new AS (SELECT *, row_number() OVER (ORDER BY source_weight DESC, at_ DESC, id) AS rank FROM art WHERE doc_id % 2 = 1),
head AS (SELECT norm, first(id ORDER BY at_ DESC, first_seen_at DESC, id DESC) AS hid FROM old WHERE norm <> '' GROUP BY norm),
lead AS (SELECT norm, first(id ORDER BY rank) AS lid FROM new WHERE norm <> '' GROUP BY norm),
tgt AS (SELECT new.id, coalesce(hid, lid, new.id) AS target FROM new LEFT JOIN head USING (norm) LEFT JOIN lead USING (norm)),
t AS (SELECT *, CASE WHEN id = target THEN 0 ELSE 2 END AS priority FROM tgt)"""

_OUTCOME = f"""WITH {ARTICLES}, k AS (SELECT *, {HAY} AS hay FROM art), kk AS (SELECT *, NOT (source_weight < 1.1) OR {TOPIC} OR len({NOT_NULL.format(x=TERMS)}) > 0 AS kept, at_ < {NOW} - INTERVAL 29 DAY AS old FROM k),
o AS (SELECT source_id, count(*) AS items_seen, count(*) FILTER (kept) AS items_kept, count(*) FILTER (NOT kept) AS items_filtered, count(summary) AS items_with_summary,
  count(*) FILTER (kept AND old) AS items_out_of_window, count(DISTINCT id) FILTER (kept AND NOT old) AS items_new, max(published_at) FILTER (kept) AS latest_published_at FROM kk GROUP BY source_id),
out AS (SELECT *, CASE WHEN latest_published_at < {NOW} - INTERVAL 14 DAY THEN 'stale' WHEN items_new = 0 THEN 'no_new' ELSE 'ok' END AS status FROM o)"""

_RENDER = """r AS (SELECT event_id, event_type, event_id % 5 AS k, date_trunc('second', ts) AS t,
  CASE event_id % 5 WHEN 0 THEN 'Mon, ' || strftime(ts, '%-d %b %Y %H:%M:%S') || ' +0000' WHEN 1 THEN 'Tue, ' || strftime(ts, '%-d %b %Y %H:%M:%S') || ' GMT' WHEN 2 THEN 'Wed, ' || strftime(ts, '%-d %b %Y %H:%M:%S') || ' +0800'
  WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS raw FROM events)"""
_PARSED = "CASE WHEN k = 2 THEN t - INTERVAL 8 HOUR ELSE t END"

SQL = {
    "url_canonical": f"SELECT page_id, {canonical_url_sql('url')} AS canonical, substr(sha1({canonical_url_sql('url')}), 1, 16) AS id FROM pages",
    "url_dedupe": f"SELECT {canonical_url_sql('url')} AS canonical, min(page_id) AS page_id, count(*) AS copies FROM pages GROUP BY 1",
    "html_text": f"SELECT page_id, {_html('html')} AS text FROM pages",
    "clean_summary": f"WITH {_summary('pages', 'page_id', 'html')} SELECT page_id, summary FROM s3",
    "truncate": f"SELECT doc_id, {_truncate('text')} AS short FROM documents",
    "detect_lang": f"SELECT doc_id, {LANG} AS detected FROM (SELECT doc_id, {LETTERS} FROM documents)",
    "squeeze": f"SELECT doc_id, {_squeeze('text')} AS squeezed FROM documents",
    "normalize_title": f"SELECT doc_id, {NORM} AS norm FROM documents",
    "title_grams": f"WITH t AS (SELECT doc_id, {NORM} AS n FROM documents) SELECT doc_id, len({_grams('n', 3)}) AS trigrams, len({_shingles('n')}) AS shingles, len({_grams('n', 4)}) AS blocks FROM t",
    "gram_df": f"WITH t AS (SELECT {NORM} AS n FROM documents) SELECT gram, count(*) AS df FROM (SELECT unnest({_grams('n', 4)}) AS gram FROM t) GROUP BY gram",
    "exact_title_dups": f"SELECT min(doc_id) AS id, norm, count(*) AS copies FROM (SELECT doc_id, {NORM} AS norm FROM documents) WHERE norm <> '' GROUP BY norm HAVING count(*) > 1",
    "near_dup_pairs": f"WITH t AS MATERIALIZED (SELECT min(doc_id) AS id, norm FROM (SELECT doc_id, {NORM} AS norm FROM documents) WHERE norm <> '' GROUP BY norm), "
    + f"g AS MATERIALIZED (SELECT id, norm, {_grams('norm', 3)} AS g FROM t) SELECT a, b, c::DOUBLE / least(len(x.g), len(y.g)) AS containment FROM {SHARED.format(list='g', src='g')} JOIN g x ON x.id = a JOIN g y ON y.id = b "
    f"WHERE least(length(x.norm), length(y.norm)) >= {C.DUP_LENGTH_RATIO}::DOUBLE * greatest(length(x.norm), length(y.norm)) AND c::DOUBLE / least(len(x.g), len(y.g)) >= {C.DUP_CONTAINMENT}::DOUBLE",
    "entities": f"SELECT doc_id, array_to_string({ENTITIES}, '|') AS entities FROM documents",
    "entity_df": f"WITH {_ENTITY_ROWS} SELECT low AS entity, df FROM df",
    "rare_entities": f"WITH {_ENTITY_ROWS} SELECT id, entity, df FROM e JOIN df ON low = lower(entity) WHERE df <= {C.RARE_ENTITY_DF}",
    "same_event_pairs": f"WITH {_events()} SELECT a, b FROM edge",
    "event_clusters": f"{_members()} SELECT cluster_id, cluster_size, independent_sources FROM sizes",
    "cross_source_clusters": f"{_members()} SELECT cluster_id, cluster_size, independent_sources FROM sizes WHERE cluster_size >= 2 AND independent_sources >= 2",
    "cluster_members": f"{_members()} SELECT id, cluster_id FROM member WHERE cluster_size >= 2 AND independent_sources >= 2",
    "relevance_filter": f"WITH {ARTICLES}, k AS (SELECT *, {HAY} AS hay FROM art), m AS (SELECT *, {NOT_NULL.format(x=TERMS)} AS hits FROM k) SELECT id, array_to_string(hits, '|') AS terms, NOT (source_weight < 1.1) OR len(hits) > 0 AS kept FROM m",
    "signal_counts": f"WITH {ARTICLES}, k AS (SELECT *, {HAY} AS hay FROM art), m AS (SELECT id, {NOT_NULL.format(x=SIGNAL)} AS s FROM k) SELECT id, len(s) AS n, array_to_string(s, '|') AS names FROM m",
    "parse_published": f"WITH {_RENDER} SELECT event_id, {_PARSED} AS published_at, CASE WHEN k = 4 THEN 'tz_assumed' END AS note FROM r",
    "tz_audit": f"WITH {_RENDER}, g AS (SELECT event_type, CASE k WHEN 0 THEN '+0000' WHEN 1 THEN 'GMT' WHEN 2 THEN '+0800' WHEN 3 THEN 'ISO8601' ELSE '(未知)' END AS shape, count(*) AS n, max({_PARSED}) AS newest FROM r GROUP BY ALL) SELECT event_type, shape, n, newest, CASE WHEN h > 4 THEN 'tz_mislabelled' WHEN h > 0 THEN 'slightly_ahead' ELSE 'ok' END AS verdict, CASE WHEN abs(h - 8) < 1.5 THEN 480::BIGINT END AS \"offset\" FROM (SELECT *, (epoch_us(newest) - epoch_us(TIMESTAMP '2024-01-30 16:00:00')) / 3600000000.0 AS h FROM g)",
    "relative_time": f"SELECT event_id, {MOMENT} AS label FROM (SELECT event_id, {SECONDS.format(now='2024-01-30 12:00:00', ts='ts')} AS s FROM events)",
    "cap_per_source": "SELECT event_type, event_id, place FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC NULLS LAST, event_id) AS place FROM events) WHERE place <= 20",
    "dual_track": "WITH e AS (SELECT event_id, ts, trunc(value)::INT AS points FROM events), u AS (SELECT 'high' AS track, * FROM e WHERE points > 80 AND ts > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 30 DAY UNION ALL SELECT 'fresh', * FROM e WHERE points > 20 AND ts > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 6 HOUR) SELECT track, event_id, points, 'https://news.ycombinator.com/item?id=' || event_id AS url FROM u",
    "window_split": f"WITH {ARTICLES} SELECT id, at_ >= {NOW} - INTERVAL 29 DAY AS inside FROM art",
    "retention_topn": f"WITH {ARTICLES} SELECT id, at_ AS at FROM art WHERE at_ >= {NOW} - INTERVAL 29 DAY ORDER BY at_ DESC, first_seen_at DESC, id DESC LIMIT 500",
    "merge_upsert": f"""{_HALF}, u AS (SELECT id AS target, 0 AS rank, id, title, published_at, first_seen_at, summary, heat FROM old UNION ALL SELECT target, rank, id, title, published_at, first_seen_at, summary, heat FROM new JOIN t USING (id)),
m AS (SELECT target AS id, max(title) FILTER (id = target) AS title, first(published_at ORDER BY rank) FILTER (published_at IS NOT NULL) AS published_at, first(summary ORDER BY length(summary) DESC, rank) FILTER (summary IS NOT NULL) AS summary, max(heat) AS heat, count(*) AS rows, max(first_seen_at) AS seen FROM u GROUP BY target)
SELECT id, title, published_at, summary, heat, rows FROM m WHERE coalesce(published_at, seen) >= {NOW} - INTERVAL 60 DAY""",
    "merge_stats": f"{_HALF} SELECT priority, count(*) AS n, count(DISTINCT target) AS targets FROM t GROUP BY priority",
    "score_articles": f"{_scored()} SELECT id, score, cluster_size, n AS independent_sources FROM sc",
    "article_reasons": f"{_scored()} SELECT id, array_to_string(reasons, '|') AS reasons FROM sc",
    "highlights": f"{_scored()}, {_PICK} SELECT id, title, source_id, score, array_to_string({_CARD}, '|') AS reasons, cluster_size, n AS independent_sources FROM top",
    "source_outcomes": f"{_OUTCOME} SELECT * FROM out",
    "store_counts": f"{_members()} SELECT count(*) AS total, count(*) FILTER (lang = 'zh') AS zh, count(*) FILTER (lang = 'en') AS en, count(*) FILTER (source_official) AS official, count(published_at) AS with_published_at, count(*) FILTER (published_at IS NULL) AS without_published_at, count(*) FILTER (member.independent_sources >= 2) AS clustered, count(*) FILTER (heat % 3 = 0) AS with_image, count(*) FILTER (epoch_us({NOW}) - epoch_us(published_at) <= 86400000000) AS last_24h, count(*) FILTER (epoch_us({NOW}) - epoch_us(published_at) <= 604800000000) AS last_7d FROM art LEFT JOIN member USING (id)",
    "health": f"{_OUTCOME}, st AS (SELECT unnest(['ok', 'no_new', 'stale', 'parse_warning', 'failed']) AS status) SELECT st.status, count(out.status) AS n FROM st LEFT JOIN out USING (status) GROUP BY st.status",
    "run_success_rate": f"WITH r AS (SELECT date_trunc('hour', ts) AS started_at, count(*) AS n FROM events GROUP BY 1), o AS (SELECT started_at, CASE WHEN n % 7 = 0 THEN 'failed' WHEN n % 5 = 0 THEN 'partial' WHEN n % 3 = 0 THEN 'no_new' ELSE 'success' END IN ('success', 'no_new') AS good FROM r) SELECT round(avg(good::INT) FILTER (started_at >= {NOW} - INTERVAL 7 DAY), 4) AS success_rate_7d, max(started_at) FILTER (good)::TIMESTAMP AS last_success_at FROM o",
    "ui_filter": f"WITH {ARTICLES} SELECT id, source_id FROM art WHERE at_ >= {NOW} - INTERVAL 29 DAY AND lang = 'en' AND contains(lower(title), 'th')",
    "unread_antijoin": f"WITH {ARTICLES} SELECT id, source_id FROM art WHERE NOT source_official",
    "article_list": f"{_scored()}, {_PICK}, clicked AS (SELECT substr(sha1(event_id::VARCHAR), 1, 16) AS id FROM events WHERE event_type = 'click') SELECT id, source_id FROM sc WHERE lang = 'en' AND at_ >= {NOW} - INTERVAL 29 DAY AND contains(lower(title || chr(10) || coalesce(summary, '')), 'the') AND id NOT IN (SELECT id FROM top) AND id NOT IN (SELECT id FROM clicked)",
    "event_list": f"{_scored()} SELECT id, cluster_id, n AS independent_sources FROM sc WHERE n >= 2 AND list_contains(reasons, '官方一手来源')",
    "facet_counts": f"{_scored()}, one AS (SELECT source_id, lang, cluster_id, CASE WHEN n >= 2 THEN 'true' ELSE 'false' END AS multi FROM sc) "
    "SELECT 'source' AS facet, source_id AS value, count(*) AS n FROM one WHERE source_id IS NOT NULL GROUP BY ALL UNION ALL SELECT 'lang', lang, count(*) FROM one GROUP BY ALL UNION ALL SELECT 'cluster', cluster_id, count(*) FROM one WHERE cluster_id IS NOT NULL GROUP BY ALL "
    "UNION ALL SELECT 'multi_source', multi, count(*) FROM one GROUP BY ALL UNION ALL SELECT 'all', '', count(*) FROM one UNION ALL SELECT 'reason', r, count(*) FROM (SELECT unnest(list_distinct(reasons)) AS r FROM sc) GROUP BY ALL",
    "lead_story": f"{_scored()}, {_PICK} SELECT id, score, CASE WHEN heat % 3 = 0 THEN 'https://cdn.example.com/x.jpg' END AS image_url FROM top ORDER BY coalesce(heat % 3 = 0, false) DESC, score DESC, id LIMIT 1",
    "manifest_diff": "WITH x AS (SELECT doc_id::VARCHAR AS name, doc_id AS n, coalesce(text, '') AS text FROM documents), a AS (SELECT name, sha256(CASE WHEN n % 5 = 0 THEN text || '!' ELSE text END) AS s FROM x WHERE n % 7 <> 0), b AS (SELECT name, sha256(text) AS s FROM x WHERE n % 11 <> 0) "
    "SELECT name, CASE WHEN a.s IS NULL THEN 'added' WHEN b.s IS NULL THEN 'missing' WHEN a.s = b.s THEN 'same' ELSE 'changed' END AS status, a.s AS captured_sha256, b.s AS landed_sha256 FROM a FULL JOIN b USING (name)",
    "parse_dates": f"SELECT event_id, CASE WHEN k = 11 THEN t - INTERVAL 2 HOUR ELSE t END AS published_at, CASE WHEN k NOT IN ({', '.join(str(i) for i, (_, zoned) in enumerate(FORMS) if zoned)}) THEN 'tz_assumed' END AS note FROM (SELECT event_id, event_id % {len(FORMS)} AS k, date_trunc('second', ts) AS t FROM events)",
    "image_pick": "SELECT page_id, 'https://cdn.example.com/' || page_id || '.jpg' AS image_url FROM pages",
}
