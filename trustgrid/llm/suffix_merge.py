"""Distributed merge sort of byte strings that never compares a known common prefix again.

Every task sorts its strings into runs. A run is front-coded: each string is stored as the length of the prefix it
shares with the one before and the rest. Runs are cut at sampled splitters and exchanged by range; equal strings
meet in one range and are sent once per run. A range's runs are merged by a loser tree whose players carry the
length of their common prefix with the last winner: of two players the one that shares more comes first, and only at
a tie are bytes compared, from the first unknown one on.
"""

from __future__ import annotations

import struct
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import zstandard

BLOCK_BYTES = 1 << 16
ENTRY = "<HHqq"      # shared prefix, length of the rest, identifier


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, known to be at least ``start``."""
    n = min(len(a), len(b))
    for low, high in ((start, min(start + 32, n)), (start + 32, n)):     # most differences come soon
        if low < high:
            x = int.from_bytes(a[low:high]) ^ int.from_bytes(b[low:high])
            if x:
                return high - (x.bit_length() + 7) // 8
    return n


def front_coded_blocks(strings: list[bytes], idents: list[tuple[int, int]], splitters: list[bytes]
                       ) -> Iterator[tuple[int, int, bytes]]:
    """(range, sequence number, block) of one sorted run. ``strings`` are sorted and distinct.

    The run's strings of one range follow each other; the first of a range is stored whole. Blocks are compressed.
    """
    squeeze = zstandard.ZstdCompressor(level=1).compress
    part, seq, last, out, size = -1, 0, b"", [], 0
    cut = b""
    for string, ident in zip(strings, idents):
        if part < 0 or (cut is not None and string >= cut):
            if out:
                yield part, seq, squeeze(b"".join(out))
            part = bisect_right(splitters, string)
            cut = splitters[part] if part < len(splitters) else None
            seq, last, out, size = 0, b"", [], 0
        shared = common_prefix(last, string)
        rest = string[shared:]
        piece = struct.pack(ENTRY, shared, len(rest), *ident) + rest
        out.append(piece)
        size += len(piece)
        last = string
        if size >= BLOCK_BYTES:
            yield part, seq, squeeze(b"".join(out))
            seq, out, size = seq + 1, [], 0
    if out:
        yield part, seq, squeeze(b"".join(out))


def decoded(blocks: list[bytes]) -> Iterator[tuple[int, bytes, tuple[int, int]]]:
    """(prefix shared with the string before in the run, string, identifier)."""
    last, size = b"", struct.calcsize(ENTRY)
    for squeezed in blocks:
        block = zstandard.ZstdDecompressor().decompress(squeezed)
        at, n = 0, len(block)
        while at < n:
            shared, rest, *ident = struct.unpack_from(ENTRY, block, at)
            at += size
            last = last[:shared] + block[at:at + rest]
            at += rest
            yield shared, last, tuple(ident)


def merged(runs: list[list[bytes]]) -> Iterator[tuple[int, bytes, tuple[int, int]]]:
    """All strings of the runs in order, each with the length of its common prefix with the one before.

    Loser tree: ``tree[i]`` is the loser of the match at node i, ``shared[p]`` what player p's string shares with the
    last winner. A player that comes after the winner shares with it exactly what its match has shown, so the known
    length only has to be kept for the loser of each match.
    """
    players = [decoded(r) for r in runs]
    k = 1
    while k < len(players):
        k *= 2
    heads: list[tuple[bytes, tuple[int, int]] | None] = [None] * k
    shared = [0] * k
    for p, run in enumerate(players):
        first = next(run, None)
        if first is not None:
            heads[p] = (first[1], first[2])

    def match(p: int, q: int) -> tuple[int, int]:
        """Winner and loser; the loser's shared length becomes that with the winner."""
        a, b = heads[p], heads[q]
        if a is None:
            return q, p
        if b is None:
            return p, q
        if shared[p] != shared[q]:
            return (p, q) if shared[p] > shared[q] else (q, p)      # the loser shares the same with the winner
        x, y = a[0], b[0]
        n = common_prefix(x, y, shared[p])
        if x[n:n + 1] <= y[n:n + 1]:
            shared[q] = n
            return p, q
        shared[p] = n
        return q, p

    tree = [0] * k
    winners = list(range(k))
    level = k
    while level > 1:
        nxt = []
        for i in range(0, level, 2):
            w, loser = match(winners[i], winners[i + 1])
            tree[(level + i) // 2] = loser
            nxt.append(w)
        winners, level = nxt, level // 2
    champion = winners[0]
    while heads[champion] is not None:
        string, ident = heads[champion]
        yield shared[champion], string, ident
        following = next(players[champion], None)
        if following is None:
            heads[champion] = None
        else:
            shared[champion], heads[champion] = following[0], (following[1], following[2])
        node, w = (champion + k) // 2, champion
        while node >= 1 and k > 1:
            w, tree[node] = match(w, tree[node])
            node //= 2
        champion = w


def pick_splitters(sample: list[bytes], parts: int) -> list[bytes]:
    ordered = sorted(set(sample))
    if not ordered or parts < 2:
        return []
    at = np.unique(np.linspace(0, len(ordered), parts + 1)[1:-1].astype(int))
    return sorted({ordered[min(i, len(ordered) - 1)] for i in at})
