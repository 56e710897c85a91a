"""Periodic runs of words: suffix-tree extension queries on Lyndon-root candidates."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from fractions import Fraction
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 6  # words of the shortest run
POWER = 4  # least length over period
BLOCK = 8  # tour entries a block of the range-minimum structure


class SuffixTree:
    """Ukkonen's suffix tree of a sequence of positive ids, with an end mark 0 below all ids.

    Nodes 0 to n are the leaves, by suffix; node n + 1 is the root. About 300
    bytes an id while it is built.
    """

    def __init__(self, ids: list[int]):
        s = [*ids, 0]
        n, wide = len(s), max(s) + 1
        root = inner = n
        leaf = 0
        start, end = array("i", bytes(8 * n + 4)), array("i", [n]) * (2 * n + 1)
        link, depth = array("i", [root]) * (n + 1), array("i", bytes(4 * n + 4))  # of inner nodes, from the root
        end[root] = 0
        edges: dict[int, int] = {}
        node, length, edge = root, 0, 0
        for i, c in enumerate(s):
            made = 0  # inner node of this phase that still lacks its link
            while leaf <= i:
                if not length:
                    edge = i
                key = node * wide + s[edge]
                below = edges.get(key)
                if below is None:
                    edges[key] = leaf
                    start[leaf] = i
                    if made:
                        link[made - n] = node
                        made = 0
                else:
                    begin = start[below]
                    size = (i + 1 if end[below] > i else end[below]) - begin
                    if length >= size:
                        edge += size
                        length -= size
                        node = below
                        continue
                    if s[begin + length] == c:
                        if made and node != root:
                            link[made - n] = node
                        length += 1
                        break
                    inner += 1
                    start[inner], end[inner] = begin, begin + length
                    depth[inner - n] = depth[node - n] + length
                    edges[key] = inner
                    start[below] = begin + length
                    edges[inner * wide + s[begin + length]] = below
                    edges[inner * wide + c] = leaf
                    start[leaf] = i
                    if made:
                        link[made - n] = inner
                    made = inner
                leaf += 1
                if node == root and length:
                    length -= 1
                    edge = leaf
                else:
                    node = link[node - n]
        self.n, self.inner = n, inner - n + 1
        self.depth = np.array(depth[: self.inner], np.int64)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        self.child = np.fromiter(edges.values(), np.int64, len(edges))
        self.above, self.first = keys // wide - n, keys % wide
        self._ready = False

    def _walk(self, backwards: bool) -> tuple[list[int], list[int]]:
        """Leaves along the Euler tour, and the least string depth the tour passes since the leaf before.

        Children by rising or falling first id, the end mark first. Only the
        tour's minimum between leaves matters to a lowest common ancestor of
        leaves, so no more of it is kept.
        """
        # the last of a slice is taken first
        order = np.lexsort((np.where(self.first > 0, self.first, self.first.max() + 1) if backwards else -self.first, self.above))
        child, above = self.child[order], self.above[order]
        at = np.searchsorted(above, np.arange(self.inner + 1))
        turn = self.depth[above]
        turn[at[1:] - 1] = -1  # the first child goes on from its parent
        up = np.empty(self.n + self.inner, np.int64)
        up[self.n] = -1
        up[child] = turn
        child, at, up, n = child.tolist(), at.tolist(), up.tolist(), self.n
        leaves, low, wait, least = [], [], [n], 0
        while wait:
            u = wait.pop()
            if up[u] >= 0:
                least = up[u]
            if u < n:
                leaves.append(u)
                low.append(least)
            else:
                wait += child[at[u - n] : at[u - n + 1]]
        return leaves, low

    def _prepare(self) -> None:
        leaves, low = self._walk(False)
        self.place = np.empty(self.n, np.int64)
        self.place[leaves] = np.arange(self.n)
        flat = np.array(low, np.int32)
        self.grid = np.concatenate([flat, np.full(-len(flat) % BLOCK, np.iinfo(np.int32).max, np.int32)]).reshape(-1, BLOCK)
        self.head = np.minimum.accumulate(self.grid, axis=1)
        self.tail = np.minimum.accumulate(self.grid[:, ::-1], axis=1)[:, ::-1]
        self.sparse = [self.head[:, -1]]
        while 2 ** len(self.sparse) <= len(self.grid):
            half, own = 2 ** (len(self.sparse) - 1), self.sparse[-1]
            self.sparse.append(np.minimum(own[:-half], own[half:]))
        self._ready = True

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of suffixes i and j (i not j): string depth of their lowest common ancestor.

        The least entry of the tour between the leaves, from block minima in
        constant time.
        """
        if not self._ready:
            self._prepare()
        a, b = self.place[i], self.place[j]
        a, b = np.minimum(a, b) + 1, np.maximum(a, b)
        p, q = a // BLOCK, b // BLOCK
        out = np.minimum(self.tail[p, a % BLOCK], self.head[q, b % BLOCK])
        inner = np.maximum(q - p - 1, 0)
        level = np.frexp(inner.astype(np.float64))[1]  # inner holds 2**(level-1) to 2**level - 1 blocks
        for k in (np.flatnonzero(np.bincount(level)) if len(level) else []):
            if k:
                w, own = np.flatnonzero(level == k), self.sparse[k - 1]
                out[w] = np.minimum(out[w], np.minimum(own[p[w] + 1], own[q[w] - (1 << int(k - 1))]))
        w = np.flatnonzero(p == q)
        if len(w):
            slot = np.arange(BLOCK)
            inside = (slot >= (a[w] % BLOCK)[:, None]) & (slot <= (b[w] % BLOCK)[:, None])
            out[w] = np.where(inside, self.grid[p[w]], np.iinfo(np.int32).max).min(axis=1)
        return out.astype(np.int64)

    def ranks(self, backwards: bool) -> np.ndarray:
        """Rank of each suffix under the order of ids, or its inverse; a suffix comes before those it begins."""
        if backwards:
            out = np.empty(self.n, np.int64)
            out[self._walk(True)[0]] = np.arange(self.n)
            return out
        if not self._ready:
            self._prepare()
        return self.place


def lyndon_lengths(ranks: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word from each place: the distance to the next smaller suffix."""
    ranks = ranks.tolist()
    out, wait = [0] * (len(ranks) - 1), []
    for i, r in enumerate(ranks):
        while wait and ranks[wait[-1]] > r:
            j = wait.pop()
            out[j] = i - j
        wait.append(i)
    return np.array(out, np.int64)


def runs(ids: list[int], *, least: int = LEAST, power: int = POWER) -> np.ndarray:
    """Rows (start, length, period) of all runs of a sequence of positive ids, by start, then period.

    Every run holds, with regard to one of the two orders of ids, the longest
    Lyndon word from some place as its root: both orders' roots are extended to
    the right and left by common prefixes in the trees of the sequence and its
    reversal.
    """
    n = len(ids)
    if n < max(least, power):
        return np.zeros((0, 3), np.int64)
    tree, back = SuffixTree(ids), SuffixTree(ids[::-1])
    found = []
    for backwards in (False, True):
        p = lyndon_lengths(tree.ranks(backwards))
        i = np.flatnonzero(p * power <= n)
        p = p[i]
        right = tree.common(i, i + p)
        left = back.common(n - i, n - i - p)
        keep = left + p + right >= np.maximum(least, power * p)
        found.append(np.column_stack([i - left, left + p + right, p])[keep])
    out = np.unique(np.concatenate(found), axis=0)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def stretches(ids: np.ndarray, *, least: int = LEAST, power: int = POWER) -> list[tuple[int, int]]:
    """Disjoint stretches that between them hold every run whole; all else provably holds none.

    In a run of period q every word after the first q recurs at a distance of
    at most q: such words follow each other at least max(least - q, (power - 1)
    * q) times. Looked for with distances up to 1, 2, 4 and so on.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    gap = np.full(n, n + 1, np.int64)
    same = np.flatnonzero(ids[order[1:]] == ids[order[:-1]])
    gap[order[same + 1]] = order[same + 1] - order[same]
    cover = np.zeros(n + 1, np.int64)

    def long(reach: int, need: int) -> tuple[np.ndarray, np.ndarray]:
        edge = np.flatnonzero(np.diff(np.concatenate([[0], (gap <= reach).view(np.int8), [0]])))
        a, b = edge[::2], edge[1::2]
        big = b - a >= need
        return a[big], b[big]

    reach, under = 1, 0
    a, b = long(n, 1)
    longest = int((b - a).max()) if len(a) else 0
    while (need := max(least - reach, (power - 1) * (under + 1))) <= longest:
        a, b = long(reach, need)
        np.add.at(cover, np.maximum(a - reach, 0), 1)
        np.add.at(cover, b, -1)
        under, reach = reach, reach * 2
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (np.cumsum(cover) > 0).view(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def document_runs(words: list[bytes]) -> np.ndarray:
    """Rows (start, length, period) of all runs of a document's words."""
    if len(words) < LEAST:
        return np.zeros((0, 3), np.int64)
    number: dict[bytes, int] = {}
    ids = np.fromiter(map(number.setdefault, words, count(1)), np.int64, len(words))
    out = []
    for a, b in stretches(ids):
        part = np.unique(ids[a:b], return_inverse=True)[1] + 1
        got = runs(part.tolist())
        got[:, 0] += a
        out.append(got)
    return np.concatenate(out) if out else np.zeros((0, 3), np.int64)


def planted(n: int, code: int | None) -> np.ndarray | None:
    """Original word numbers of a document of n words whose id has this crc32; None where nothing changes."""
    if not n or code is None or code % 10:
        return None
    g = code // 10
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i >= a, a + (i - a) % p, i)


def collapsed(words: list[bytes], found: np.ndarray) -> list[bytes]:
    """Words that no run holds after its first period."""
    if not len(found):
        return words
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, found[:, 0] + found[:, 2], 1)
    np.add.at(cover, found[:, 0] + found[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()]


def strongest(found: np.ndarray) -> tuple[int, int, int] | None:
    """The run of greatest length over period; ties: least start, then period."""
    if not len(found):
        return None
    ratio = found[:, 1] / found[:, 2]
    near = found[ratio >= ratio.max() * (1 - 1e-12)].tolist()
    return tuple(min(near, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])))


def periodic_runs(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", plant: bool = False) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256 and collapsed, a row per document.

    A run is a maximal stretch of words of smallest period q and at least
    max(6, 4q) words. start, length and period tell the run of greatest length
    over period (ties: least start, then period), null where there is none;
    collapsed is the text with each run cut to its first period.

    Null text counts as empty: no run, and digests of the empty string. A null
    doc_id stays null and is never planted. Repeated rows are answered each, an
    empty table gives no rows, and other columns, of whatever names, are not
    read. Each document is handled whole in one task, without a shuffle; suffix
    trees are built for the stretches whose words recur closely enough to hold
    a run, about 300 bytes a word. plant: the periodic tails of the registered
    query's rule.
    """
    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, collapsed string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, code, value in zip(batch.column("doc_id").to_pylist(), batch.column("code").to_pylist(), batch.column("text"), strict=True):
                words = (value.as_py() or "").encode().split()
                take = planted(len(words), code) if plant else None
                words = words if take is None else [words[i] for i in take.tolist()]
                found = document_runs(words)
                best = strongest(found) or (None, None, None)
                lines = "".join(f"{s},{n},{q}\n" for s, n, q in found.tolist())
                left = b" ".join(collapsed(words, found))
                rows.append((key, len(found), *best, best[1] and 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest(), left.decode()))
            names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "collapsed"]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k < 6 else pa.string()) for k, c in enumerate(columns)], names=names)

    key = F.col(doc_id).cast("long")
    return docs.select(key.alias("doc_id"), F.crc32(F.col(doc_id).cast("string")).alias("code"), F.col(text).alias("text")).mapInArrow(run, schema)
