"""Plain versions of the corpus operators for small inputs: every place, every pair."""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def quality_counts(text):
    text = text or ""
    w = words(text)
    triples = Counter(zip(w, w[1:], w[2:]))
    again = set()
    for i in range(len(w) - 2):
        if triples[tuple(w[i:i + 3])] > 1:
            again |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if words(x)]
    n = len(w)
    return {"n_words": n, "word_chars": sum(map(len, w)),
            "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(again),
            "base_failed": n < 50 or 100 * len(again) > 50 * n}


def simhash(text, size=3):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(lower)
    if not w:
        return 0
    parts = [" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(nodes, linked):
    """Smallest node reachable, for every node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def simhash_groups(rows, radius=2):
    prints = {d: simhash(t) for d, t in rows}
    ids = sorted(prints)
    linked = [(a, b) for i, a in enumerate(ids) for b in ids[:i]
              if (prints[a] ^ prints[b]).bit_count() <= radius]
    root = groups(ids, linked)
    return {d: (f"{prints[d]:016x}", root[d]) for d in ids}


def substring_dedup(rows, size=20):
    first = {}
    for d, t in sorted(rows):
        w = words(t)
        for i in range(len(w) - size + 1):
            first.setdefault(tuple(w[i:i + size]), (d, i))
    out = {}
    for d, t in rows:
        w = words(t)
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i:i + size])] != (d, i):
                gone |= set(range(i, i + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def byte_dedup(rows, size=200):
    seen = defaultdict(int)
    raw = {d: (t or "").encode() for d, t in rows}
    for b in raw.values():
        for i in range(len(b) - size + 1):
            seen[b[i:i + size]] += 1
    out = {}
    for d, b in raw.items():
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if seen[b[i:i + size]] > 1:
                gone[i:i + size] = b"\1" * size
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def hex_digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def manifest(rows, fanout=16):
    """Digest columns per document from trees held as lists of levels."""
    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    def leaf(row):
        return hex_digest(*[field(row[c]) for c in ("doc_id", "source", "lang", "n_chars",
                                                     "text")])

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            last = levels[-1]
            levels.append([hex_digest(*last[i:i + fanout]) for i in range(0, len(last), fanout)])
        return levels

    groups = defaultdict(list)
    for row in rows:
        groups[row["source"]].append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for source in order:
        groups[source].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = {s: tree([leaf(r) for r in groups[s]]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for number, source in enumerate(order):
        for at, row in enumerate(groups[source]):
            changed = dict(row)
            name = str(row["doc_id"]).encode()
            if row["doc_id"] is not None and zlib.crc32(name) % 5 == 0 and row["text"]:
                changed["text"] = re.sub("[A-Z]", lambda m: m[0].lower(), row["text"])
            node, siblings = leaf(changed), []
            for levels, place in ((trees[source], at), (top, number)):
                for level in levels[:-1]:
                    run = level[place // fanout * fanout:][:fanout]
                    own = place % fanout
                    siblings += run[:own] + run[own + 1:]
                    node = hex_digest(*run[:own], node, *run[own + 1:])
                    place //= fanout
            out.append((row["doc_id"], leaf(row), trees[source][-1][0], top[-1][0],
                        hex_digest(*siblings), node, node == top[-1][0]))
    return out


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fault = zlib.crc32(key.encode()) % 20
        if fault:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text)
            row = (conv, turn, "user" if fault == 4 else role, text)
            yield from [row, row] if fault == 3 else [row]


def repaired(rows):
    """Columns of the report for one conversation, by searching edits cheapest and least first."""
    def name(row):
        return hashlib.sha256(f"{len(row[0].encode())}:{row[0]}{row[1]}".encode()).digest()

    rows = sorted((turn is not None, turn or 0, name((role, text)), turn, role, text)
                  for _, turn, role, text in rows)
    rows = [row[3:] for row in rows]
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen
                      else "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    turns = [row[0] for row in rows if row[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    first = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
    heap, done = [(0, "", 0, "", "")], set()
    while True:
        cost, audit, at, state, out = heapq.heappop(heap)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(rows) and state in ("", "a"):
            return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    illegal, cost, audit, hashlib.sha256(out[1:].encode()).hexdigest())
        due = "a" if state == "u" else "u"
        given = {"u": "user", "a": "assistant"}[due]
        heapq.heappush(heap, (cost + 2, audit + "I", at, due, f"{out}\n{given}:"))
        if at == len(rows):
            continue
        _, role, text = rows[at]
        heapq.heappush(heap, (cost + 3, audit + "D", at + 1, state, out))
        if faults[at] not in ("blank", "duplicate"):
            more = cost + (faults[at] == "truncated")
            heapq.heappush(heap, (more + 2, audit + "R", at + 1, due, f"{out}\n{given}:{text}"))
            if first[at] == due or (first[at] == "s" and state == ""):
                heapq.heappush(
                    heap, (more, audit + "K", at + 1, first[at], f"{out}\n{role}:{text}"))


def conversations(rows, ids):
    """The report of all conversations, ids with or without rows."""
    groups = defaultdict(list, {one: [] for one in ids})
    for row in rows:
        groups[row[0]].append(row)
    return sorted(((one, *repaired(listed)) for one, listed in groups.items()), key=str)
