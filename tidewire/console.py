"""The report of a run as text for a terminal."""

from __future__ import annotations

import unicodedata

# Labels of the report.
STATUS = {"ok": "正常", "no_new": "无新增", "parse_warning": "解析异常", "stale": "疑似停更", "failed": "抓取失败"}
OVERALL = {"success": "成功", "partial": "部分成功", "no_new": "无新增", "failed": "失败"}
TRIGGER = {"manual": "手动运行", "cron": "定时任务", "fixture": "离线重放"}
COLUMNS = (
    ("来源", lambda o: o["name"]), ("状态", lambda o: STATUS.get(o["status"], o["status"])), ("抓取", lambda o: o["items_seen"]), ("保留", lambda o: o["items_kept"]),
    ("过滤", lambda o: o["items_filtered"]), ("新增", lambda o: o["items_new"]), ("重复", lambda o: o["items_dup"]), ("配图", lambda o: o["items_with_image"]),
    ("最新条目", lambda o: short_time(o["latest_published_at"])), ("耗时", lambda o: f"{o['duration_ms']}ms"),
)


def short_time(moment: str | None) -> str:
    """MM-DD HH:MM of an ISO time."""
    return f"{moment[5:10]} {moment[11:16]}" if moment else "—"


def width(text: str) -> int:
    """Columns of a terminal; wide characters take two."""
    return len(text) + sum(unicodedata.east_asian_width(c) in ("W", "F") for c in text)


def table(rows: list[tuple[str, ...]]) -> list[str]:
    """Lines of left-aligned columns, with a rule below the first row."""
    wide = [max(map(width, column)) for column in zip(*rows)]
    lines = ["  ".join(cell + " " * (w - width(cell)) for cell, w in zip(row, wide)) for row in rows]
    return [lines[0], "  ".join("-" * w for w in wide), *lines[1:]]


def render(report: dict, highlights: list[dict]) -> str:
    """Head, a row for each source, totals, sources in need of attention, repairs, highlights."""
    # The sentences of the report, below.
    per = report["sources"]
    total = {k: sum(o[k] for o in per) for k in ("items_seen", "items_kept", "items_out_of_window", "items_with_image")}
    start = report["started_at"]
    out = ["=" * 78, "  采集报告", "=" * 78, f"运行 ID    {report['run_id']}"]
    out.append(f"触发方式   {TRIGGER.get(report['trigger'], report['trigger'])}" + ("（离线重放，未访问网络）" if report["offline"] else ""))
    out += [f"开始时间   {start[:10]} {start[11:19]} UTC", f"耗时       {report['duration_ms'] / 1000:.1f}s", f"结论       {OVERALL.get(report['overall'], report['overall'])}", ""]
    out += table([tuple(name for name, _ in COLUMNS), *[tuple(str(cell(o)) for _, cell in COLUMNS) for o in per]])
    parts = [f"{len(per)} 个源", f"原始 {total['items_seen']} 条", f"保留 {total['items_kept']} 条", f"新增 {report['total_new']} 条", f"去重 {report['total_dup']} 条"]
    if total["items_out_of_window"]:
        parts.append(f"窗口外丢弃 {total['items_out_of_window']} 条")
    parts += [f"提取配图 {total['items_with_image']} 条", f"存储共 {report['total_in_store']} 条"]
    out += ["", "合计：" + " · ".join(parts)]
    sections = {
        "需要关注的源：": [
            f"{o['name']} [{STATUS.get(o['status'], o['status'])}] 最新条目 {short_time(o['latest_published_at'])}" + (f"：{o['error']}" if o["error"] else "")
            for o in per if o["status"] not in ("ok", "no_new")
        ],
        "源站数据缺陷处理记录：": [f"{o['name']}：更正时区标注 {o['items_tz_corrected']} 条（源站钟面时间按 config 中的偏移重新解释）" for o in per if o["items_tz_corrected"]]
        + [f"{o['name']}：丢弃无效摘要 {o['items_summary_dropped']} 条（纯导航样板或过短，不当作摘要展示）" for o in per if o["items_summary_dropped"]],
    }
    for title, lines in sections.items():
        if lines:
            out += ["", title, *(f"  - {line}" for line in lines)]
    if highlights:
        out += ["", f"今日重点（{len(highlights)} 条）："]
        for place, h in enumerate(highlights, 1):
            out += [f"  {place}. [{h['score']:.2f}] {h['title']}", f"     {h['source_name']} · {' / '.join(h['reasons'][:3])}"]
    return "\n".join(out)
