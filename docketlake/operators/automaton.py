"""Dictionary matching of word sequences: a trie with failure links (Aho and Corasick) that texts stream through in Arrow batches.

The automaton is a handful of arrays: sorted edges (node and word to node), failure links, and for each node the nearest suffix of it that is an entry. A batch's
words are one sequence with a breaking word between texts. It is cut into lanes that overlap by the longest entry less one word, and all lanes
step together, a word at a time: an edge is found by binary search, and lanes without one fall back along failure links. The work follows
the number of words, whatever the entries' lengths, and no window of a text is ever made.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words a lane.
LANE = 512


@dataclass
class Automaton:
    """vocabulary: the entries' words; edges: node * vocabulary + word, sorted, each to the node in ``to``; fail: each node's longest proper suffix; entry: the
    number of the entry that ends in the node, else -1; output: the node itself where an entry ends in it, else the nearest suffix where one does,
    else 0; longest: words of the longest entry."""

    vocabulary: pa.Array
    edges: np.ndarray
    to: np.ndarray
    fail: np.ndarray
    entry: np.ndarray
    output: np.ndarray
    longest: int

    @classmethod
    def build(cls, entries: list[list[str]]) -> Automaton:
        """Of distinct, non-empty word sequences; entry k is the k-th."""
        number: dict[str, int] = {}
        children: list[dict[int, int]] = [{}]
        entry = [-1]
        for k, words in enumerate(entries):
            node = 0
            for w in words:
                w = number.setdefault(w, len(number))
                if (child := children[node].get(w)) is None:
                    child = children[node][w] = len(children)
                    children.append({})
                    entry.append(-1)
                node = child
            entry[node] = k
        fail, output = [0] * len(children), [0] * len(children)
        todo = deque(children[0].values())
        for node in children[0].values():
            output[node] = node if entry[node] >= 0 else 0
        while todo:
            node = todo.popleft()
            for w, child in children[node].items():
                back = fail[node]
                while back and w not in children[back]:
                    back = fail[back]
                fail[child] = children[back].get(w, 0)
                output[child] = child if entry[child] >= 0 else output[fail[child]]
                todo.append(child)
        size = max(1, len(number))
        pairs = sorted((node * size + w, child) for node, ways in enumerate(children) for w, child in ways.items())
        edges, to = (np.array([p[i] for p in pairs], dtype=t) for i, t in ((0, np.int64), (1, np.int32)))
        arrays = (np.array(x, dtype=np.int32) for x in (fail, entry, output))
        return cls(pa.array(list(number), pa.string()), edges, to, *arrays, max(map(len, entries), default=0))

    def _step(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Where each lane goes with its word; -1 is a word of no entry."""
        state = np.where(word < 0, 0, state)
        size, out, open_ = max(1, len(self.vocabulary)), np.zeros(len(state), dtype=np.int32), np.flatnonzero(word >= 0)
        while len(open_):
            key = state[open_].astype(np.int64) * size + word[open_]
            at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            hit = self.edges[at] == key
            out[open_[hit]] = self.to[at[hit]]
            open_ = open_[~hit]
            open_ = open_[state[open_] > 0]  # at the root there is nowhere to fall back to
            state[open_] = self.fail[state[open_]]
        return out

    def find(self, words: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """(row, entry) of the entries that stand in a row's words, each once. A null row has none."""
        sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = int(sizes.sum())
        if not total or not len(self.edges):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        known = pc.fill_null(pc.index_in(words.flatten(), value_set=self.vocabulary), -1).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(total) + row  # a breaking word between texts
        stream, owner = np.full(total + len(sizes), -1, dtype=np.int64), np.zeros(total + len(sizes), dtype=np.int64)
        stream[place], owner[place] = known, row
        before, width = self.longest - 1, max(LANE, self.longest)
        lanes = -(-len(stream) // width)
        padded = np.concatenate([np.full(before, -1), stream, np.full(lanes * width - len(stream), -1)])
        starts, state, found = np.arange(lanes) * width, np.zeros(lanes, dtype=np.int32), []
        for k in range(before + width):
            state = self._step(state, padded[starts + k])
            node = self.output[state]
            lane = np.flatnonzero(node)
            node = node[lane]
            while len(lane):
                found.append(np.stack([owner[starts[lane] + k - before], self.entry[node]]))
                node = self.output[self.fail[node]]
                lane, node = lane[node > 0], node[node > 0]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        every = np.unique(np.concatenate(found, axis=1), axis=1)
        return every[0], every[1]


def matcher(automaton, owners):
    """A mapInArrow function over (id, words): (id, owner) of every entry in the words; ``owners`` (broadcast) has, for each entry, where its owners begin
    and the owners of all, ``automaton`` (broadcast) the automaton."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, every = owners.value
        for batch in batches:
            row, entry = automaton.value.find(batch.column(1))
            counts = first[entry + 1] - first[entry]
            at = np.arange(counts.sum()) + np.repeat(first[entry] - np.cumsum(counts) + counts, counts)
            ids, owner = batch.column(0).take(pa.array(np.repeat(row, counts))), every.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([ids, owner], ["doc_id", "entity_id"])

    return run
