"""The site as one page with its data inside."""

from __future__ import annotations

import json
import os
import re
import shutil

from tidewire.plans import daily
from tidewire.sources import store

#: What the template holds in place of the data. Fixed value.
PLACEHOLDER = "/*__INLINE_DATA__*/ null"
DOCUMENTS = {"news": daily.NEWS, "status": daily.STATUS, "meta": daily.META, "runs": daily.RUNS}
LOCAL = re.compile(r"<(script|link)\b[^>]*?\b(src|href)\s*=\s*[\"'](?!(https?:|data:|//))", re.I)


def _folder(data_dir: str) -> str:
    """Where the documents of the last published run are: all of one run, even if copying them beside
    the store was cut short. A folder without a store holds them itself."""
    return store.published_folder(os.path.join(data_dir, daily.STORE)) or data_dir


def load(data_dir: str) -> tuple[dict, list[str]]:
    """(documents by name, warnings). Only the articles are required; others may be missing."""
    data_dir, out, notes = _folder(data_dir), {}, []
    for name, file in DOCUMENTS.items():
        path = os.path.join(data_dir, file)
        out[name] = None
        if os.path.exists(path):
            with open(path, encoding="utf-8") as f:
                out[name] = json.load(f)
        else:
            notes.append(f"缺少 {path}")
    if out["news"] is None:
        raise FileNotFoundError(os.path.join(data_dir, daily.NEWS))
    return out, notes


def inline(payload: dict) -> str:
    """Compact JSON that cannot close the script element it stands in."""
    return json.dumps(payload, ensure_ascii=False, separators=(",", ":")).replace("</", "<\\/")


def build(template: str, data_dir: str, out_dir: str) -> tuple[str, list[str]]:
    """(page, warnings): the template with the data filled in, and copies of the documents."""
    with open(template, encoding="utf-8") as f:
        page = f.read()
    if PLACEHOLDER not in page:
        raise ValueError(f"{template} has no {PLACEHOLDER}")
    payload, notes = load(data_dir)
    if not payload["news"].get("articles"):
        notes.append("条目数为 0")
    os.makedirs(os.path.join(out_dir, "data"), exist_ok=True)
    path = os.path.join(out_dir, "index.html")
    with open(path, "w", encoding="utf-8", newline="\n") as f:
        f.write(page.replace(PLACEHOLDER, inline(payload)))
    data_dir = _folder(data_dir)
    for file in DOCUMENTS.values():
        if os.path.exists(os.path.join(data_dir, file)):
            shutil.copyfile(os.path.join(data_dir, file), os.path.join(out_dir, "data", file))
    return path, notes


def check(page: str, template: str) -> list[str]:
    """What keeps the page from standing alone; an empty list if nothing does."""
    with open(page, encoding="utf-8") as f:
        text = f.read()
    found = LOCAL.search(text)
    faults = {
        "the placeholder was not replaced": PLACEHOLDER in text,
        "no articles inside": '"articles":' not in text,
        f"a local file is referenced: {found and found.group(0)[:60]}": bool(found),
        "no way to fetch the data over HTTP": "fetch(" not in text,
        f"no template {template}": not os.path.exists(template),
    }
    return [fault for fault, holds in faults.items() if holds]
