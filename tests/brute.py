"""Plain single-threaded versions of the pipeline problems, for comparison."""

from __future__ import annotations

import json
from collections import defaultdict

RECORD_KEYS = {"citations", "attachments", "files", "search_result_groups", "entries", "messages", "filters", "sources", "moderation_results"}
BLANK = " \t\n\r\f\x0b\xa0"


def key(x):
    return (x.strip(BLANK).lower() or None) if x is not None else None


def current(rows):
    best = {}
    for r in rows:
        k = key(r["id"])
        if k is not None and (k not in best or (r["updated_at"] is not None and (best[k]["updated_at"] is None or r["updated_at"] > best[k]["updated_at"]))):
            best[k] = r
    return best


def hierarchy(edges):
    """edges: (scope, node, parent) -> node: (root, depth, n_descendants)."""
    at = {(s, n) for s, n, _ in edges}
    up = {(s, n): ((s, p) if p is not None and (s, p) in at else None) for s, n, p in edges}
    below = defaultdict(set)
    out = {}
    for v in up:
        seen, w = {v}, up[v]
        while w is not None and w not in seen:
            seen.add(w)
            w = up[w]
        chain = [v]
        while up[chain[-1]] is not None and w is None:
            chain.append(up[chain[-1]])
        for a in seen:
            if a != v:
                below[a].add(v)
        out[v] = (chain[-1][1], len(chain) - 1) if w is None else ("", -1)
    return {v[1]: (*out[v], len(below[v])) for v in up}


def records(text):
    """(record_path, parent_path) of the objects in arrays of a JSON text."""
    out = []

    def opened(v):
        if isinstance(v, str):
            t = v.strip(" \t\n\r")
            if t[:1] in ("{", "[") and t:
                try:
                    got = json.loads(t)
                except ValueError:
                    return v
                return got if isinstance(got, (dict, list)) else v
        return v

    def walk(v, path, owner, how):
        v = opened(v)
        if isinstance(v, dict):
            if how == "keyed":
                path += "[0]"
            if how:
                out.append((path, owner))
                owner = path
            for k, x in v.items():
                walk(x, f"{path}.{k}" if path else k, owner, "keyed" if k in RECORD_KEYS else "")
        elif isinstance(v, list):
            for i, x in enumerate(v):
                walk(x, f"{path}[{i}]", owner, "element")

    if text is not None and isinstance(opened(text), (dict, list)):
        walk(text, "", "", "")
    return out


def orphans(messages, parts, pairs):
    cur = current(messages)
    msg = {k: (r["created_at"], r["deleted_at"] is not None) for k, r in cur.items()}
    out = set()

    def judge(table, rid, ref, at, targets):
        if ref is None:
            return
        month = at.strftime("%Y-%m") if at is not None else ""
        if ref not in targets:
            out.add((table, rid, "missing", month))
        elif all(g for _, g in targets[ref]):
            out.add((table, rid, "deleted", month))
        elif at is not None and all(t is not None and t > at for t, g in targets[ref] if not g):
            out.add((table, rid, "late", month))

    single = {k: [v] for k, v in msg.items()}
    for r in pairs:
        judge("prompt_responses", r["id"], key(r["prompt_message_id"]), r["created_at"], single)
    for r in cur.values():
        if r["deleted_at"] is None:
            judge("messages", r["id"], key(r["parent_id"]), r["created_at"], single)
    tools = defaultdict(list)
    for r in parts:
        if key(r["tool_name"]) and key(r["tool_use_id"]):
            tools[key(r["tool_use_id"])].append(msg.get(key(r["message_id"]), (None, False)))
    for r in parts:
        if not key(r["tool_name"]):
            at, gone = msg.get(key(r["message_id"]), (None, False))
            if not gone:
                judge("content_parts", r["id"], key(r["tool_use_id"]), at, tools)
    return out


def drift(dialogues, parts, exports):
    kind = lambda v: {bool: "boolean", str: "string", dict: "object", list: "array"}.get(type(v), "number")
    rows = defaultdict(lambda: defaultdict(lambda: defaultdict(set)))  # export -> field -> dialogue -> values
    ids = defaultdict(set)
    for r in dialogues:
        try:
            top = json.loads(r["source_json"] or "")
        except ValueError:
            top = {}
        if not isinstance(top, dict):
            continue
        fields = dict(top)
        for k, v in top.items():
            if isinstance(v, dict) and k != "mapping":
                fields |= {f"{k}.{k2}": v2 for k2, v2 in v.items()}
        for k, v in fields.items():
            if v is not None:
                rows[r["export_id"]][k][r["id"]].add(kind(v) + ":" + json.dumps(v, sort_keys=True))
                ids[r["export_id"]].add(r["id"])
    by = defaultdict(list)
    for e in exports:
        by[e["account_key"]].append((e["seq"], e["export_id"]))
    shapes = defaultdict(set)
    given = lambda x: x is not None and x.strip() != ""
    for r in parts:
        shape = next((c for c in ("tool_name", "tool_use_id", "language", "media_type") if given(r[c])), None)
        if shape and key(r["part_type"]):
            shapes[r["export_id"], shape].add(key(r["part_type"]))
    out = set()
    for steps in by.values():
        steps.sort()
        last = {}
        for i, (_, e) in enumerate(steps):
            for shape in ("tool_name", "tool_use_id", "language", "media_type"):
                now = shapes.get((e, shape))
                if now:
                    was = last.get(shape)
                    last[shape] = now
                    if was is not None:
                        new, gone = sorted(now - was), sorted(was - now)
                        if len(new) == 1 and len(gone) == 1:
                            out.add((e, "renamed", f"part_type={new[0]}", f"part_type={gone[0]}"))
                        else:
                            out |= {(e, "added", f"part_type={x}", "") for x in new} | {(e, "removed", f"part_type={x}", "") for x in gone}
            if not i:
                continue
            p = steps[i - 1][1]
            new, gone = rows[e].keys() - rows[p].keys(), rows[p].keys() - rows[e].keys()
            types = lambda x, f: {v.split(":", 1)[0] for vs in rows[x][f].values() for v in vs}
            out |= {(e, "retyped", f, "") for f in rows[e].keys() & rows[p].keys() if types(e, f) != types(p, f)}
            renamed = set()
            for g in gone:
                shared = {d for d in rows[p][g] if d in ids[e]}
                for f in new:
                    if shared and all(rows[p][g][d] <= rows[e][f].get(d, set()) for d in shared):
                        renamed.add((f, g))
            out |= {(e, "renamed", f, g) for f, g in renamed}
            out |= {(e, "added", f, "") for f in new - {f for f, _ in renamed}} | {(e, "removed", g, "") for g in gone - {g for _, g in renamed}}
    return out
