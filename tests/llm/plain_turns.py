"""Conversation repair by shortest paths over (rows taken, state of the grammar), without tables, bands or pieces."""

import hashlib
import heapq
import re
import zlib

NEXT = {("0", "s"): "1", ("0", "u"): "2", ("1", "u"): "2", ("2", "a"): "3", ("3", "u"): "2"}
FULL = {"u": "user", "a": "assistant"}


def plain_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        role = "user" if draw == 4 else role
        out[conv] += [(turn, role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, v in out.items()}


def plain_repair(rows):
    """One tuple for a conversation's rows (turn, role, text) in order: gaps to repaired_sha256."""
    seen, faults, word = set(), [], re.compile(r"[^\x20\x09-\x0D]")
    for _, role, text in rows:
        marks = word.findall(text)
        faults.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else "")
        seen.add((role, text))
    initials = [r[1][:1] for r in rows]
    turns = [r[0] for r in rows if r[0] is not None]
    heap, done = [(0, "", 0, "0", "")], set()
    while True:
        cost, audit, i, state, text = heapq.heappop(heap)
        if i == len(rows) and state in "03":
            break
        if (i, state) in done:
            continue
        done.add((i, state))
        for symbol in "ua":
            if (state, symbol) in NEXT:
                heapq.heappush(heap, (cost + 2, audit + "I", i, NEXT[state, symbol], text + f"\n{FULL[symbol]}:"))
                if i < len(rows) and faults[i] not in ("blank", "duplicate"):
                    heapq.heappush(heap, (cost + 2 + (faults[i] == "truncated"), audit + "R", i + 1, NEXT[state, symbol], text + f"\n{FULL[symbol]}:{rows[i][2]}"))
        if i < len(rows):
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, text))
            if faults[i] not in ("blank", "duplicate") and (state, initials[i]) in NEXT:
                heapq.heappush(heap, (cost + (faults[i] == "truncated"), audit + "K", i + 1, NEXT[state, initials[i]], text + f"\n{rows[i][1]}:{rows[i][2]}"))
    pairs = [a + b for a, b in zip(initials[:-1], initials[1:], strict=True)]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text[1:].encode()).hexdigest())
