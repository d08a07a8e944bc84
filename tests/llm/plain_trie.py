"""The trie of rebuilt conversations, plainly."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict


def nodes(rows: list[tuple]) -> list[tuple]:
    """Rows of the trie for (conv_id, turn, role, text) rows, sorted."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).hexdigest()
            own[conv_id].append((turn is not None, turn or 0, role, digest, text))
    turns = {c: [(role, text) for _, _, role, _, text in sorted(found)] for c, found in own.items()}
    rebuilt = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(turns.get(c - c % 100, [])[:h] + mine[h:])
    members = defaultdict(list)
    for c, sequence in rebuilt.items():
        for depth in range(len(sequence) + 1):
            members[sequence[:depth]].append(c)
    children, leaves, saved = defaultdict(set), defaultdict(int), defaultdict(int)
    for prefix, of in members.items():
        if prefix:
            children[prefix[:-1]].add(prefix)
    for prefix, of in members.items():
        for depth in range(len(prefix) + 1):
            leaves[prefix[:depth]] += not children[prefix]
            saved[prefix[:depth]] += (len(of) - 1) * (len(prefix[-1][1]) if prefix else 0)
    result = []
    for prefix, of in members.items():
        ends = ",".join(str(c) for c in sorted(of) if len(rebuilt[c]) == len(prefix))
        result.append((
            min(of), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(of), len(children[prefix]),
            leaves[prefix], saved[prefix], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(result, key=lambda r: r[:2])
