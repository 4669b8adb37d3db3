"""Counts of short number sequences in a HAT-trie: hash containers under a shallow trie of word ids.

A phrase of d word ids is one integer, `BITS` for each word, the first word highest. The trie is kept flat: a
container holds all phrases from its first key up to the next container's, and begins at a word of the shallowest
level that still divides it: several first words at first, then one first word, then second words below it.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np

BITS = 21
# A container with more phrases bursts.
BURST = 4096


class HatTrie:
    def __init__(self, depth: int, burst: int = BURST) -> None:
        self.depth = depth
        self.burst = burst
        self.starts = [0]
        self.containers: list[dict[int, int]] = [{}]
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Adds distinct keys in ascending order with their counts."""
        cuts = [*np.searchsorted(keys, np.array(self.starts, np.int64)).tolist(), len(keys)]
        full = []
        for k, container in enumerate(self.containers):
            begin, end = cuts[k], cuts[k + 1]
            if begin == end:
                continue
            known = container.get
            before = len(container)
            for key, n in zip(keys[begin:end].tolist(), counts[begin:end].tolist(), strict=True):
                container[key] = known(key, 0) + n
            self.size += len(container) - before
            if len(container) > self.burst:
                full.append(self.starts[k])
        for start in full:
            self._burst(start)

    def _level(self, low: int, high: int) -> int | None:
        """Bits below the shallowest word in which two keys differ; none for one word or equal keys."""
        for level in range(1, self.depth):
            shift = BITS * (self.depth - level)
            if low >> shift != high >> shift:
                return shift
        return 0 if low != high else None

    def _burst(self, start: int) -> None:
        """Divides a container between two words of one trie node until every part is small."""
        work = [start]
        while work:
            k = bisect_right(self.starts, work.pop()) - 1
            container = self.containers[k]
            if len(container) <= self.burst:
                continue
            keys = np.sort(np.fromiter(container, np.int64, len(container)))
            shift = self._level(int(keys[0]), int(keys[-1]))
            if shift is None:
                continue
            words = keys >> shift
            # The word boundary nearest to the middle.
            changes = np.flatnonzero(words[1:] != words[:-1]) + 1
            cut = int(changes[np.argmin(np.abs(changes - len(keys) // 2))])
            at = int(words[cut]) << shift
            self.containers[k] = {key: n for key, n in container.items() if key < at}
            self.containers.insert(k + 1, {key: n for key, n in container.items() if key >= at})
            self.starts.insert(k + 1, at)
            work += [self.starts[k], at]

    def spill(self, keep: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Takes out whole subtrees, the largest first, until at most `keep` phrases are left.

        A subtree is what hangs under one first word, or the range of first words that share a container. Each is
        given as a run: keys in ascending order, and counts.
        """
        shift = BITS * (self.depth - 1)
        subtrees: list[list[int]] = []
        for k, start in enumerate(self.starts):
            if subtrees and start >> shift == self.starts[subtrees[-1][0]] >> shift:
                subtrees[-1].append(k)
            else:
                subtrees.append([k])
        subtrees.sort(key=lambda ks: -sum(len(self.containers[k]) for k in ks))
        for ks in subtrees:
            if self.size <= keep:
                break
            runs = [self._run(k) for k in ks if self.containers[k]]
            for k in ks:
                self.size -= len(self.containers[k])
                self.containers[k] = {}
            if runs:
                yield np.concatenate([r[0] for r in runs]), np.concatenate([r[1] for r in runs])
        if not self.size:
            self.starts, self.containers = [0], [{}]

    def _run(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        container = self.containers[k]
        keys = np.fromiter(container, np.int64, len(container))
        order = np.argsort(keys)
        return keys[order], np.fromiter(container.values(), np.int64, len(container))[order]
