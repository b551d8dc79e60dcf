"""Repeated passages by collinear chaining of shared k-mer seeds.

Seeds are runs of five words, thinned by winnowing: of every window of seeds, the one with the least hash is kept, so any two
texts that share a window share a seed. Sorted by hash, each seed's first place (smallest document, then position) is its anchor and all
later places match it; a place also carries the last few documents before it that have its seed. Matches follow the number of places, never
their pairs. A document's matches with one anchor document are chained, and those with the other earlier documents where no sure chain with an
anchor holds them, as when slices of a passage stand in documents before it: a Fenwick tree over positions there gives each match the best chain that may stand before it, less a cost for
the gap. Chains are cut at wide gaps, and aligned on the words of both documents: between matches, and outward from the
ends. What is long and alike enough is a repeated passage; the anchor document keeps it.

What that leaves is looked for once more, with every earlier document. A place is open if it was not matched with all of them and no passage found covers it.
A chain around an open place may hold a match that is known; then its source is a known one of the document, and only has to have the open place's seed. Else
it has two seeds that stand near each other in both texts, of which the document was matched with other sources only, with enough equal words between and beside them for a
passage; documents meet by such pairs of seeds, and of those that meet, earliest first, the ones between which the two seeds make a passage that reaches further are aligned.

Anchors alone lose a passage whose seeds have their anchors in different documents. So runs of min_words are also joined whole: winnowed
long seeds, such that every run of min_words has one, tell where texts repeat; there every run of min_words meets its first place.
Stretches found so that no aligned passage covers are passages of their own: no exact repetition of min_words is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketlake.llm import filters
from docketlake.llm.memory import mapped
from docketlake.llm.words import mix, shingles, word_hashes
from docketlake.session import ship, written


@dataclass(frozen=True)
class Settings:
    """Words a seed; seeds a window; least words and similarity (percent) of a passage; widest gap inside a chain in words;
    cost of a gap word; words looked at beyond a chain's ends; documents before a place, besides its anchor, that it may be chained with."""

    words: int = 5
    window: int = 12
    min_words: int = 45
    percent: int = 80
    max_gap: int = 40
    gap_cost: float = 0.25
    beyond: int = 40
    earlier: int = 2


#: Words between the places that stand for a stretch that repeats one seed.
_STEP = 31


def winnow(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the seeds kept: the least hash (the last such) of each window; of all, where there are fewer."""
    if not len(hashes):
        return np.empty(0, np.int64)
    if len(hashes) <= window:
        return np.array([len(hashes) - 1 - int(hashes[::-1].argmin())])
    least, at, size = hashes, np.arange(len(hashes)), 1
    while size < window:  # of ever wider windows, each of two that overlap
        step = min(size, window - size)
        right = least[step:] <= least[:-step]
        least, at = np.where(right, least[step:], least[:-step]), np.where(right, at[step:], at[:-step])
        size += step
    return at[np.append(True, at[1:] != at[:-1])]


def _seeds(s: Settings, words: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = part.column(0).to_pylist()
                hashes, bounds, _, _ = word_hashes(part.column(1).to_pylist())
                found: list[tuple] = []
                for doc_id, a, b in zip(ids, bounds[:-1], bounds[1:], strict=True):
                    if b - a >= s.min_words:
                        grams = shingles(hashes[a:b], words)
                        places = winnow(grams, window)
                        found.append((grams[places].view(np.int64), np.full(len(places), doc_id), places))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[0] for f in found])), pa.array(np.concatenate([f[1] for f in found]), pa.int64()), pa.array(np.concatenate([f[2] for f in found]), pa.int32())], ["seed", "doc_id", "place"])

    return run


def _matches(earlier: int = 0, whole: bool = False):
    """From places sorted by seed, document and position: each place with its seed's anchor in an earlier document, and with the first place in each of
    the last ``earlier`` documents before it that have the seed (place -1 where there are fewer). Constant memory.

    With ``whole``, places in the anchor document too, as their own source, of seeds that another document has; and each row's seed, and whether earlier documents
    other than those told have it (``lost``), and whether it is first, last or every so many words of those that follow each other within a window (``edge``), as where a text repeats
    itself. Then one seed's places in one document are held."""
    names = ["doc_id", "source_id", "place", "source_place", *(f"earlier_{j}{x}" for j in range(earlier) for x in ("", "_place"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 3), dtype=np.int64)  # of the seed that goes on: its anchor, and the first place in each of its last documents
        told = 0  # rows of these that were given out
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], axis=1)
            rows = np.concatenate([held, rows])
            seed, doc, place = rows.T
            new_seed = np.append(True, seed[1:] != seed[:-1])
            new = new_seed | np.append(True, doc[1:] != doc[:-1])
            starts, nth = np.flatnonzero(new), np.cumsum(new) - 1
            first = np.maximum.accumulate(np.where(new_seed, np.arange(len(seed)), 0))
            last = np.append(np.flatnonzero(new_seed)[1:], len(seed))[np.cumsum(new_seed) - 1] - 1
            at = np.flatnonzero((doc[last if whole else slice(None)] != doc[first]) & (np.arange(len(seed)) >= told))
            anchor = first[at]
            cols = [doc[at], doc[anchor], place[at], place[anchor]]
            for j in range(1, earlier + 1):
                there = nth[at] - j >= nth[anchor]
                before = starts[np.where(there, nth[at] - j, 0)]
                cols += [np.where(there, doc[before], doc[anchor]), np.where(there, place[before], -1)]
            own = starts[starts >= first[-1]]
            if whole and len(own) == 1:
                held, told = rows[first[-1] :], 0
            else:
                kept = earlier + 1 + whole
                held = rows[own if len(own) <= kept + 1 else np.append(own[0], own[-kept:])]
                told = len(held)
            out = [pa.array(c, pa.int32() if n.endswith("place") else pa.int64()) for n, c in zip(names, cols, strict=True)]
            if whole:
                begins = new | np.append(True, np.diff(place) > Settings.window)
                since = place - place[np.maximum.accumulate(np.where(begins, np.arange(len(seed)), 0))]
                edge = begins | np.append(begins[1:], True) | (since // _STEP != np.append(0, since[:-1]) // _STEP)
            more = [pa.array(seed[at]), pa.array(nth[at] - nth[anchor] >= earlier + 2), pa.array(edge[at])] if whole else []
            yield pa.RecordBatch.from_arrays([*out, *more], [*names, *(["seed", "lost", "edge"] if whole else [])])

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From places sorted by seed, document and position: those whose seed stands in two documents or more. Holds one seed's places in one document at most."""
    held, known = None, None  # rows of the last seed while only one document has it; the last seed where more have
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], axis=1)
        rows = np.concatenate([held, rows]) if held is not None else rows
        starts = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0]))
        ends = np.append(starts[1:], len(rows))
        several = rows[starts, 1] != rows[ends - 1, 1]
        several[0] |= known is not None and rows[0, 0] == known
        held, known = (None, rows[-1, 0]) if several[-1] else (rows[starts[-1] :], None)
        keep = rows[np.repeat(several, ends - starts)]
        yield pa.RecordBatch.from_arrays([pa.array(keep[:, 1]), pa.array(keep[:, 2], pa.int32())], ["doc_id", "place"])


def _whole(s: Settings, window: int):
    """Places and hashes of the runs of min_words that hold one of the places of repeated long seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = mix(batch.column(1)[i].values.to_numpy().view(np.uint32).astype(np.uint64))
                if len(words) < s.min_words:
                    continue
                grams = shingles(words, s.min_words)
                starts = np.unique(batch.column(2)[i].values.to_numpy()[:, None] - np.arange(window))
                starts = starts[(starts >= 0) & (starts < len(grams))]
                yield pa.RecordBatch.from_arrays([pa.array(grams[starts].view(np.int64)), pa.array(np.full(len(starts), batch.column(0)[i].as_py()), pa.int64()), pa.array(starts, pa.int32())], ["seed", "doc_id", "place"])

    return run


def _by_doc(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Rows of whole documents; rows are sorted by document, and the last one may go on in the next batch."""
    held: list[np.ndarray] = []
    for batch in batches:
        if batch.num_rows:
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(batch.num_columns)], axis=1)
            rows = np.concatenate([*held, rows])
            first = int(np.searchsorted(rows[:, 0], rows[-1, 0]))
            if first:
                yield rows[:first]
            held = [rows[first:]]
    yield from held


def _cover(docs: list[int], starts: list[int], ends: list[int]) -> list[int]:
    """Which of a document's stretches (starts and ends rising) cover all of its words that any covers: each the furthest that joins the one before."""
    kept, i = [0], 0
    while i + 1 < len(docs):
        k = i + 1
        while k + 1 < len(docs) and docs[k + 1] == docs[i] and starts[k + 1] <= ends[i]:
            k += 1
        kept.append(k)
        i = k
    return kept


def _runs(s: Settings):
    """Matches of runs of min_words, sorted by document and place, as the stretches that they make: passages word for word. Of
    stretches that overlap, as they do where a text repeats itself, only as many stay as cover the same words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_doc(batches):
            goes_on = (rows[1:, :2] == rows[:-1, :2]).all(axis=1) & (rows[1:, 2:] == rows[:-1, 2:] + 1).all(axis=1)
            first = np.flatnonzero(np.append(True, ~goes_on))
            last = np.append(first[1:], len(rows)) - 1
            keep = np.array(_cover(rows[first, 0].tolist(), rows[first, 2].tolist(), (rows[last, 2] + s.min_words).tolist()))
            first, last = first[keep], last[keep]
            ends = rows[last, 2:] + s.min_words
            cols = [rows[first, 2], ends[:, 0], rows[first, 3], ends[:, 1], ends[:, 0] - rows[first, 2]]
            yield pa.RecordBatch.from_arrays([pa.array(rows[first, 0]), pa.array(rows[first, 1]), *(pa.array(c, pa.int32()) for c in cols)], _NAMES)

    return run


def _left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All passages of one kind, and those of another (column 7 is 1) that the first ones of their document do not cover; sorted by document, column 7 and start."""
    for rows in _by_doc(batches):
        keep = np.ones(len(rows), dtype=bool)
        doc, reach = None, []  # the joined stretches of the document's aligned passages
        for i, (row_doc, _, start, end, _, _, _, exact) in enumerate(rows.tolist()):
            if row_doc != doc:
                doc, reach = row_doc, []
            if exact:
                keep[i] = not any(low <= start and end <= high for low, high in reach)
            elif reach and start <= reach[-1][1]:
                reach[-1][1] = max(reach[-1][1], end)
            else:
                reach.append([start, end])
        kept = rows[keep]
        yield pa.RecordBatch.from_arrays([pa.array(kept[:, 0]), pa.array(kept[:, 1]), *(pa.array(kept[:, k], pa.int32()) for k in range(2, 7))], _NAMES)


def chains(x: np.ndarray, y: np.ndarray, s: Settings) -> list[list[int]]:
    """Chains of matches (x rising, y rising), best first; each a list of indices. Matches are in order of x.

    A chain's value: the words its matches cover, less gap_cost for each word between them in either text. With f the value
    and g = f + gap_cost * (x + y), the best predecessor has the largest g among smaller y, which the Fenwick tree keeps. Matches that
    overlap add only what they cover anew; the predecessor is chosen as if they did not overlap.
    """
    n = len(x)
    ranks = {v: r + 1 for r, v in enumerate(sorted(set(y.tolist())))}
    tree: list[tuple[float, int]] = [(-1e18, -1)] * (len(ranks) + 1)
    value, before = [0.0] * n, [-1] * n
    xs, ys, waiting = x.tolist(), y.tolist(), []
    for i in range(n):
        while waiting and xs[waiting[0]] < xs[i]:
            j = waiting.pop(0)
            g, r = (value[j] + s.gap_cost * (xs[j] + ys[j]), j), ranks[ys[j]]
            while r < len(tree):
                tree[r] = max(tree[r], g)
                r += r & -r
        best, r = (-1e18, -1), ranks[ys[i]] - 1
        while r > 0:
            best = max(best, tree[r])
            r -= r & -r
        value[i] = float(s.words)
        if best[1] >= 0:
            j = best[1]
            gain = min(s.words, xs[i] - xs[j], ys[i] - ys[j])
            linked = best[0] - s.gap_cost * (xs[i] + ys[i] - 2 * gain) + gain
            if linked > value[i]:
                value[i], before[i] = linked, j
        waiting.append(i)
    used, found = [False] * n, []
    for end in sorted(range(n), key=lambda i: -value[i]):
        now, i = [], end
        while i >= 0 and not used[i]:
            used[i] = True
            now.append(i)
            i = before[i]
        now.reverse()
        cut = 0
        for k in range(1, len(now) + 1):  # passages end where the gap is too wide
            if k == len(now) or max(xs[now[k]] - xs[now[k - 1]], ys[now[k]] - ys[now[k - 1]]) > s.max_gap + s.words:
                if k > cut:
                    found.append(now[cut:k])
                cut = k
    return found


def _sure(x: np.ndarray, y: np.ndarray, s: Settings) -> np.ndarray:
    """Which matches of a chain are in a stretch of min_words or more whose matches follow each other closely, on one diagonal: such a stretch is a passage."""
    near = (np.diff(x) == np.diff(y)) & (np.diff(x) <= 2 * s.window)
    first = np.flatnonzero(np.append(True, ~near))
    last = np.append(first[1:], len(x)) - 1
    return np.repeat(x[last] - x[first] + s.words >= s.min_words, last - first + 1)


def _groups(rows: np.ndarray) -> Iterator[tuple[int, int]]:
    """From and to of the rows with the same document and source."""
    edges = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
    return zip(np.append(0, edges).tolist(), np.append(edges, len(rows)).tolist(), strict=True)


def _more(rows: np.ndarray, settled: np.ndarray) -> np.ndarray:
    """(document, source, place, source place, fresh) of the documents in which places are open: their chain with the anchor is not sure, and an earlier
    document other than the anchor has the seed. Fresh are the open places' matches with such documents. Sorted, no row twice."""
    others = [(rows[:, c + 1] >= 0) & (rows[:, c] != rows[:, 1]) for c in range(4, rows.shape[1], 2)]
    open_ = ~settled & np.logical_or.reduce(others) if others else np.zeros(len(rows), dtype=bool)
    chosen = np.isin(rows[:, 0], rows[open_, 0])
    parts = [np.column_stack([rows[chosen, :4], np.zeros(int(chosen.sum()), np.int64)])]
    for c, other in zip(range(4, rows.shape[1], 2), others, strict=True):
        at = chosen & other
        parts.append(np.column_stack([rows[at, 0], rows[at, c], rows[at, 2], rows[at, c + 1], open_[at]]))
    found = np.concatenate(parts)
    return found[np.lexsort((found[:, 3], found[:, 2], found[:, 1], found[:, 0]))]


def _chained(s: Settings):
    """Chains of each document's matches with its anchors; then, where places are open, of all matches known with the other earlier documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        out: list[tuple] = []

        def good(x: np.ndarray, y: np.ndarray) -> Iterator[np.ndarray]:
            for chain in chains(x, y, s):
                if len(chain) >= 2 and max(np.ptp(x[chain]), np.ptp(y[chain])) + s.words + 2 * s.beyond >= s.min_words:
                    yield np.array(chain)

        def close(rows: np.ndarray) -> None:
            """Chains of whole documents; rows are sorted by document, source and place."""
            settled, made = np.zeros(len(rows), dtype=bool), {}
            for a, b in _groups(rows):
                if b - a >= 2:
                    x, y = rows[a:b, 2], rows[a:b, 3]
                    for chain in good(x, y):
                        settled[a + chain] = _sure(x[chain], y[chain], s)
                        made.setdefault((int(rows[a, 0]), int(rows[a, 1])), []).append((x[chain].tolist(), y[chain].tolist()))
            more = _more(rows, settled)
            for a, b in _groups(more) if len(more) else ():
                x, y, fresh = more[a:b, 2], more[a:b, 3], more[a:b, 4].astype(bool)
                if fresh.any() and b - a >= 2:
                    pair = (int(more[a, 0]), int(more[a, 1]))
                    for chain in good(x, y):
                        if fresh[chain].any():  # it takes the place of the anchor's chains that it holds
                            now = (x[chain].tolist(), y[chain].tolist())
                            made[pair] = [(u, v) for u, v in made.get(pair, ()) if u[0] < now[0][0] or u[-1] > now[0][-1]] + [now]
            out.extend((doc, source, u, v) for (doc, source), found in made.items() for u, v in found)

        def told() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) or [()] * 4
            got = pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(pa.int32())), pa.array(cols[3], pa.list_(pa.int32()))], ["doc_id", "source_id", "places", "source_places"])
            out.clear()
            return got

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(batch.num_columns)], axis=1)
            rows = np.concatenate([*held, rows]) if held else rows
            # the last document may go on in the next batch; its rows are as many as its own seeds at most
            first = int(np.searchsorted(rows[:, 0], rows[-1, 0]))
            close(rows[:first]) if first else None
            held = [rows[first:]]
            if out:
                yield told()
        if held:
            close(held[0])
        yield told()

    return run


def _word_lists(s: Settings, shared):
    """(doc_id, words as 32-bit hashes) of the documents that the filter may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            rows = np.flatnonzero(filters.holds(shared.value, ids.view(np.uint64)))
            for at in range(0, len(rows), 256):
                part = rows[at : at + 256]
                hashes, bounds, _, _ = word_hashes(batch.column(1).take(pa.array(part)).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array((hashes >> np.uint64(32)).astype(np.uint32).view(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(ids[part], pa.int64()), lists], ["doc_id", "words"])

    return run


def _common(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence of two short word lists: a bit a word of ``a``, a column of the table at once."""
    at: dict[int, int] = {}
    for i, v in enumerate(a):
        at[v] = at.get(v, 0) | 1 << i
    row = every = (1 << len(a)) - 1
    for w in b:
        both = row & at.get(w, 0)
        row = (row + both | row - both) & every
    return len(a) - row.bit_count()


def _outward(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """How far two texts go on alike, word by word: (words, equal words) with the best sum, where a differing word costs 2."""
    n = min(len(a), len(b))
    if not n:
        return 0, 0
    same = a[:n] == b[:n]
    total = np.cumsum(np.where(same, 1, -2))
    best = int(total.argmax())
    return (best + 1, int(same[: best + 1].sum())) if total[best] > 0 else (0, 0)


def align(x: list[int], y: list[int], a: np.ndarray, b: np.ndarray, s: Settings) -> tuple[int, int, int, int, int]:
    """(start, end, source start, source end, equal words) of a chain; x, y: its places in the word lists a and b."""
    k, same = s.words, s.words
    for i in range(1, len(x)):
        x0, y0, x1, y1 = x[i - 1] + k, y[i - 1] + k, x[i] + k, y[i] + k
        if x1 - x0 == y1 - y0:
            same += int((a[x0:x1] == b[y0:y1]).sum())
        else:
            x0, y0 = min(x0, x[i]), min(y0, y[i])
            gap = _common(a[x0 : x[i]].tolist(), b[y0 : y[i]].tolist())
            same += gap + min(k, x1 - (x[i - 1] + k), y1 - (y[i - 1] + k))
    start, end, source_start, source_end = x[0], x[-1] + k, y[0], y[-1] + k
    more, equal = _outward(a[end : end + s.beyond], b[source_end : source_end + s.beyond])
    end, source_end, same = end + more, source_end + more, same + equal
    low, source_low = max(0, start - s.beyond), max(0, source_start - s.beyond)
    more, equal = _outward(a[low:start][::-1], b[source_low:source_start][::-1])
    return start - more, end, source_start - more, source_end, same + equal


def _aligned(s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                x, y = cols["places"][i].values.to_numpy(), cols["source_places"][i].values.to_numpy()
                a, b = cols["part"][i].values.to_numpy(), cols["source_part"][i].values.to_numpy()
                first, source_first = max(0, int(x[0]) - s.beyond), max(0, int(y[0]) - s.beyond)
                got = align((x - first).tolist(), (y - source_first).tolist(), a, b, s)
                if got[1] - got[0] >= s.min_words and 100 * got[4] >= s.percent * max(got[1] - got[0], got[3] - got[2]):
                    out.append((cols["doc_id"][i].as_py(), cols["source_id"][i].as_py(), got[0] + first, got[1] + first, got[2] + source_first, got[3] + source_first, got[4]))
            told = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(told[0], pa.int64()), pa.array(told[1], pa.int64()), *(pa.array(c, pa.int32()) for c in told[2:])], _NAMES)

    return run


def _reach(s: Settings) -> int:
    """Words between two seeds of a chain that are looked at together: of every chain around a place two seeds within them, one on each side of it or at it, are
    its ends or hold the words of a passage between them."""
    return s.percent * s.min_words // 100 + s.max_gap


def _positions(doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A number for each place: those of one document are as far from each other as its places, those of different ones are far. Rows of a document follow each other."""
    return np.cumsum(np.append(False, doc[1:] != doc[:-1])) << 32 | place


def _near(at: np.ndarray, seeds: np.ndarray, s: Settings) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Indices of two places within reach, and a key of their seeds; places rise."""
    for d in range(1, len(at)):
        near = np.flatnonzero(at[d:] - at[:-d] <= _reach(s))
        if not len(near):
            return
        yield near, near + d, mix(mix(seeds[near]) + seeds[near + d])


def _has(doc: np.ndarray, seed: np.ndarray) -> np.ndarray:
    return mix(mix(doc.view(np.uint64)) + seed.view(np.uint64))


def _having(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A hash for each document and seed that it has."""
    for batch in batches:
        doc, seed = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(_has(doc, seed)).view(np.int64))], ["has"])


def _asks(s: Settings, having):
    """From places of whole documents (doc_id, place, seed, lost, open, then sources and places there), sorted by document, what its open places ask for. Kind 0: who has two seeds (``key``)
    that it lost, at p and q around an open place. Kind 1: where a source that is known near an open place, and may have its seed, has a lost seed (``key``) of the place p. Kind 2: the
    known matches (p, q) with such a source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_doc(batches):
            out: list[list[np.ndarray]] = []

            def tell(kind: int, key, doc, p, q, first, second) -> None:
                if len(p):
                    out.append([np.full(len(p), kind), key, doc if np.ndim(doc) else np.full(len(p), doc), p, q, first, second])

            at = _positions(rows[:, 0], rows[:, 1])
            open_ = np.unique(at[rows[:, 4] == 1])
            mine = np.flatnonzero((rows[:, 4] == 0) & np.isin(at >> 32, open_ >> 32))
            if not len(mine):  # the filter let through documents without open places
                continue
            at, first = np.unique(at[mine], return_index=True)
            there = rows[mine[first]]
            lost = there[:, 3] == 1
            asks, places, seeds = there[lost, :2], at[lost], there[lost, 2].copy()
            for i, j, keys in _near(places, seeds.view(np.uint64), s):
                good = np.searchsorted(open_, places[j], "right") > np.searchsorted(open_, places[i])
                i, j = i[good], j[good]
                tell(0, keys[good].view(np.int64), asks[i, 0], asks[i, 1], asks[j, 1], seeds[i], seeds[j])
            trigger = np.isin(places, open_)
            edges = np.flatnonzero(np.append(True, there[1:, 0] != there[:-1, 0]))
            own = np.append(0, np.cumsum(lost))
            for a, b in zip(edges, [*edges[1:], len(there)], strict=True):
                doc, low, high = there[a, 0], own[a], own[b]
                known = np.concatenate([there[a:b][:, [c, 1, c + 1]] for c in range(5, there.shape[1], 2)])
                known = known[(known[:, 2] >= 0) & (known[:, 0] != doc)]
                if not len(known) or not trigger[low:high].any():
                    continue
                sources, code = np.unique(known[:, 0], return_inverse=True)
                first = np.unique(known[:, 1] * len(sources) + code, return_index=True)[1]
                known, code = known[first], code[first]
                at, own_seeds = asks[low:high, 1], seeds[low:high]
                asking = np.flatnonzero(trigger[low:high])
                x, y = np.nonzero(np.abs(known[:, 1][None, :] - at[asking][:, None]) <= _reach(s))
                pairs = np.zeros((len(asking), len(sources)), dtype=bool)
                pairs[x, code[y]] = True
                x, y = np.nonzero(pairs)
                hit = np.unique(y[filters.holds(having.value, _has(sources[y], own_seeds[asking[x]]))])
                if not len(hit):
                    continue
                x, y = np.repeat(np.arange(len(at)), len(hit)), np.tile(hit, len(at))
                held = filters.holds(having.value, _has(sources[y], own_seeds[x]))
                tell(1, own_seeds[x[held]], doc, at[x[held]], at[x[held]], sources[y[held]], sources[y[held]])
                chosen = known[np.isin(code, hit)]
                tell(2, chosen[:, 0], doc, chosen[:, 1], chosen[:, 2], chosen[:, 0], chosen[:, 0])
            if out:
                cols = [np.concatenate(c) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if n in ("kind", "p", "q") else pa.int64()) for n, c in zip(_ASKS, cols, strict=True)], _ASKS)

    return run


def _offers(s: Settings, shared):
    """From places of whole documents (doc_id, place, seed), sorted by document: pairs of seeds within reach that the filter may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_doc(batches):
            out: list[list[np.ndarray]] = []
            at, first = np.unique(_positions(rows[:, 0], rows[:, 1]), return_index=True)
            doc, place, seeds = rows[first].T
            for i, j, keys in _near(at, seeds.copy().view(np.uint64), s):
                held = filters.holds(shared.value, keys)
                if held.any():
                    out.append([keys[held].view(np.int64), doc[i[held]], place[i[held]], place[j[held]]])
            if out:
                cols = [np.concatenate(c) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k < 2 else pa.int32()) for k, c in enumerate(cols)], ["key", "doc_id", "p", "q"])

    return run


def _beside(s: Settings):
    """Pairs of seeds with a byte of each word from ``beyond`` before the first to as many after the second. Where the text ends, an asking row has 0, another 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = np.maximum(batch.column(1)[i].values.to_numpy().view(np.uint32) & 255, 2).astype(np.uint8)
                pairs = batch.column(2)[i].values
                key, p, q, asks = (pairs.field(n).to_numpy(zero_copy_only=False) for n in ("key", "p", "q", "asks"))
                sizes = q.astype(np.int64) - p + s.words + 2 * s.beyond
                ends = np.cumsum(sizes)
                at = np.arange(ends[-1]) + np.repeat(p - s.beyond - (ends - sizes), sizes)
                inside = (at >= 0) & (at < len(words))
                seen = np.where(inside, words[np.where(inside, at, 0)], np.repeat(np.where(asks, 0, 1), sizes)).astype(np.uint8)
                doc = np.full(len(key), batch.column(0)[i].as_py())
                side = pa.Array.from_buffers(pa.binary(), len(key), [None, pa.py_buffer(np.append(0, ends).astype(np.int32).tobytes()), pa.py_buffer(seen.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(asks), pa.array(doc, pa.int64()), pa.array(p, pa.int32()), pa.array(q, pa.int32()), side], ["key", "asks", "doc_id", "p", "q", "beside"])

    return run


def _reached(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_outward`` of many rows of equal or differing words at once: words, equal words."""
    total = np.cumsum(np.where(same, np.int16(1), np.int16(-2)), axis=1, dtype=np.int16)
    best = total.argmax(axis=1)
    top = total[np.arange(len(total)), best]
    n = np.where(top > 0, best + 1, 0)
    return n, np.where(top > 0, (top + 2 * n) // 3, 0)


class _Asking:
    """The asking rows of a block, and how far the passages found around each go before its first and after its second seed (-1: none). A row leaves when no
    passage can go further."""

    #: Bytes that are compared at once.
    MOST = 1 << 20

    def __init__(self, rows: tuple, s: Settings):
        self.s = s
        self.docs, self.p, self.q, self.sides, self.cores = rows
        self.left, self.right = np.full(len(self.p), -1), np.full(len(self.p), -1)
        self.ends = [(self.sides[:, : s.beyond] > 0).sum(axis=1), (self.sides[:, s.beyond :] > 0).sum(axis=1)]

    def drop(self) -> None:
        keep = (self.left < self.ends[0]) | (self.right < self.ends[1])
        if 4 * keep.sum() <= 3 * len(keep):
            self.docs, self.p, self.q, self.sides, self.cores, self.left, self.right = (x[keep] for x in (self.docs, self.p, self.q, self.sides, self.cores, self.left, self.right))
            self.ends = [x[keep] for x in self.ends]

    def meet(self, doc: np.ndarray, p: np.ndarray, q: np.ndarray, sides: np.ndarray, cores: np.ndarray) -> Iterator[tuple]:
        """Of other rows, in order of their documents, those (document, source, p, q, p there, q there) around which a passage reaches words that none before did."""
        at = 0
        while at < len(doc) and len(self.docs):
            n = max(1, self.MOST // (self.sides.shape[1] * len(self.docs)))
            yield from self._part(*(x[at : at + n] for x in (doc, p, q, sides, cores)))
            self.drop()
            at += n

    def _part(self, doc, p, q, sides, cores) -> Iterator[tuple]:
        s, length, there = self.s, self.q - self.p, q - p
        equal = (self.sides[:, None] == sides[None]).sum(axis=2, dtype=np.uint8)
        a, b = np.nonzero((100 * (equal + np.minimum(length[:, None], there[None]) + s.words) >= s.percent * s.min_words) & (self.docs[:, None] > doc[None]))
        if not len(a):
            return
        same = self.sides[a] == sides[b]
        left, more = _reached(same[:, : s.beyond][:, ::-1])
        right, other = _reached(same[:, s.beyond :])
        core = np.minimum(length[a], there[b]) + s.words
        level = length[a] == there[b]
        core[level] = (self.cores[a[level]] == cores[b[level]]).sum(axis=1) - (self.cores.shape[1] - length[a[level]] - s.words)
        size = left + right + s.words + length[a]
        alike = (size >= s.min_words) & (100 * (core + more + other) >= s.percent * (left + right + s.words + np.maximum(length[a], there[b])))
        for k in np.flatnonzero(alike & ((left > self.left[a]) | (right > self.right[a]))).tolist():
            i, j = a[k], b[k]
            if left[k] <= self.left[i] and right[k] <= self.right[i]:
                continue
            if not level[k]:
                x, y = int(length[i]), int(there[j])
                gap = _common(self.cores[i, min(s.words, x) : x].tolist(), cores[j, min(s.words, y) : y].tolist())
                if 100 * (gap + s.words + min(s.words, x, y) + more[k] + other[k]) < s.percent * (left[k] + right[k] + s.words + max(x, y)):
                    continue
            self.left[i], self.right[i] = max(self.left[i], left[k]), max(self.right[i], right[k])
            yield self.docs[i], doc[j], self.p[i], self.q[i], p[j], q[j]


def _alike(s: Settings):
    """From rows sorted by key and block, those that ask first, then by document: chains of the two seeds of an asking row with those of an earlier document, where they make a passage that
    goes further than those with the documents before. So a row gives as many as it has words beside it at most, and their passages cover what those of all pairs do. Holds the asking rows
    of a block."""
    width = _reach(s) + s.words

    def read(batch: pa.RecordBatch) -> tuple:
        doc, p, q = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3, 6))
        column = batch.column(6)
        first = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column)].astype(np.int64)
        data = np.frombuffer(column.buffers()[2], dtype=np.uint8)
        size = q - p + s.words
        before, after = (first + x for x in (0, s.beyond + size))
        sides = data[np.concatenate([before[:, None] + np.arange(s.beyond), after[:, None] + np.arange(s.beyond)], axis=1)]
        inside = np.arange(width) < size[:, None]
        return doc, p, q, sides, np.where(inside, data[np.where(inside, first[:, None] + s.beyond + np.arange(width), 0)], 0).astype(np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asking, ready = None, [], None
        for whole in batches:
            for low in range(0, whole.num_rows, 4096):
                batch = whole.slice(low, 4096)
                key, block, asks = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
                rows, out = read(batch), []
                edges = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (block[1:] != block[:-1]) | (asks[1:] != asks[:-1])))
                for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(key)], strict=True):
                    if now != (key[a], block[a]):
                        now, asking, ready = (key[a], block[a]), [], None
                    part = tuple(x[a:b] for x in rows)
                    if asks[a]:
                        asking.append(part)
                    elif asking:
                        ready = ready or _Asking(tuple(np.concatenate(c) for c in zip(*asking, strict=True)), s)
                        out.extend(ready.meet(*part))
                if out:
                    cols = np.array(out, dtype=np.int64).T
                    ends = pa.array(np.arange(0, 2 * len(out) + 1, 2), pa.int32())
                    lists = [pa.ListArray.from_arrays(ends, pa.array(cols[k : k + 2].T.ravel(), pa.int32())) for k in (2, 4)]
                    yield pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1]), *lists], ["doc_id", "source_id", "places", "source_places"])

    return run


def _fewest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of passages sorted by document as many as cover the same words; of equal ones that of the earliest source."""
    for rows in _by_doc(batches):
        rows = rows[np.lexsort((*rows[:, :3:-1].T, rows[:, 1], -rows[:, 3], rows[:, 2], rows[:, 0]))]
        keep, doc, reach = [], None, -1
        for i, (row_doc, end) in enumerate(rows[:, [0, 3]].tolist()):
            if row_doc != doc or end > reach:
                keep.append(i)
                doc, reach = row_doc, end
        rows = rows[keep]
        rows = rows[_cover(rows[:, 0].tolist(), rows[:, 2].tolist(), rows[:, 3].tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(rows[:, k], pa.int64() if k < 2 else pa.int32()) for k in range(7)], _NAMES)


_NAMES = ["doc_id", "source_id", "start", "end", "source_start", "source_end", "equal_words"]
MATCHES = "doc_id long, source_id long, place int, source_place int"
CHAINS = "doc_id long, source_id long, places array<int>, source_places array<int>"
_ASKS = ["kind", "key", "doc_id", "p", "q", "first", "second"]
PASSAGES = "doc_id long, source_id long, start int, end int, source_start int, source_end int, equal_words int"


def _exact(given: DataFrame, s: Settings, parts: int) -> DataFrame:
    """A row a stretch of min_words or more that stands word for word in an earlier document: the columns of PASSAGES."""
    long = max(s.words, s.min_words - s.window + 1)
    window = s.min_words - long + 1
    seeds = given.transform(mapped, _seeds(s, long, window), "seed long, doc_id long, place int").repartition(parts, "seed").sortWithinPartitions("seed", "doc_id", "place")
    places = written(seeds.transform(mapped, _repeated, "doc_id long, place int"), "repeated")
    chosen = filters.shared(places.select("doc_id").distinct())
    words = given.transform(mapped, _word_lists(s, chosen), "doc_id long, words array<int>").dropDuplicates(["doc_id"])
    asked = words.join(places.groupBy("doc_id").agg(F.collect_list("place").alias("places")), "doc_id").select("doc_id", "words", "places")
    whole = asked.transform(mapped, _whole(s, window), "seed long, doc_id long, place int").repartition(parts, "seed").sortWithinPartitions("seed", "doc_id", "place")
    return whole.transform(mapped, _matches(), MATCHES).repartition(parts, "doc_id").sortWithinPartitions("doc_id", "place").transform(mapped, _runs(s), PASSAGES)


def _aligned_chains(found: DataFrame, given: DataFrame, s: Settings) -> DataFrame:
    """The passages that chains make (doc_id, source_id, places, source_places)."""
    both = found.select("doc_id").unionByName(found.select(F.col("source_id").alias("doc_id"))).distinct()
    chosen = filters.shared(both)
    words = given.transform(mapped, _word_lists(s, chosen), "doc_id long, words array<int>").dropDuplicates(["doc_id"])
    chain = found.withColumn("chain", F.xxhash64("doc_id", "source_id", F.col("places")[0], F.col("source_places")[0], F.element_at("places", -1), F.size("places")))

    def asked(doc: str, at: str, side: int) -> DataFrame:
        low = F.greatest(F.lit(0), F.col(at)[0] - s.beyond)
        return chain.select("chain", F.col(doc).alias("doc_id"), F.lit(side).alias("side"), low.alias("low"), (F.element_at(at, -1) + s.words + s.beyond - low).alias("length"))

    wanted = asked("doc_id", "places", 0).unionByName(asked("source_id", "source_places", 1))
    cut = wanted.join(words, "doc_id").select("chain", "side", F.slice("words", F.col("low") + 1, F.col("length")).alias("part"))
    own, source = cut.where("side = 0").select("chain", "part"), cut.where("side = 1").select("chain", F.col("part").alias("source_part"))
    ready = chain.join(own, "chain").join(source, "chain").select("doc_id", "source_id", "places", "source_places", "part", "source_part")
    return ready.transform(mapped, _aligned(s), PASSAGES).dropDuplicates()


def _rest(given: DataFrame, placed: DataFrame, found: DataFrame, s: Settings, parts: int, block: int = 4096) -> DataFrame:
    """Passages around the places that were not matched with every earlier document and that no passage found covers: of these all partners are looked at. Rows of a
    pair of seeds are dealt over blocks of about ``block`` that ask, each of which meets all others, so a common pair is in no single task."""
    placed = placed.where("edge").drop("edge")
    spans = found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    covered = F.exists("spans", lambda x: (x["start"] <= F.col("place")) & (F.col("place") + s.words <= x["end"]))
    left = placed.where("lost").select("doc_id", "place", "seed").join(spans, "doc_id", "left").where(F.col("spans").isNull() | ~covered)
    open_ = written(left.select("doc_id", "place", "seed"), "open")
    hot = placed.where(filters.may_hold(F.col("seed"), filters.shared(open_.select("seed").distinct())))
    having = filters.shared(hot.select("doc_id", "seed").transform(mapped, _having, "has long"))
    told = [c for c in placed.columns if c not in ("doc_id", "place", "seed", "lost")]
    near = placed.where(filters.may_hold(F.col("doc_id"), filters.shared(open_.select("doc_id").distinct()))).select("doc_id", "place", "seed", F.col("lost").cast("int").alias("lost"), F.lit(0).alias("open"), *told)
    near = near.unionByName(open_.withColumn("lost", F.lit(1)).withColumn("open", F.lit(1)).select("*", *(F.lit(-1).cast(placed.schema[c].dataType).alias(c) for c in told)))
    near = near.repartition(parts, "doc_id").sortWithinPartitions("doc_id")
    every = written(near.transform(mapped, _asks(s, having), "kind int, key long, doc_id long, p int, q int, first long, second long"), "asking")
    asking = every.where("kind = 0")
    wanted = every.where("kind = 1").select("doc_id", F.col("p").alias("place"), F.col("first").alias("source_id"), F.col("key").alias("seed"))
    wanted = wanted.join(hot.select(F.col("doc_id").alias("source_id"), "seed", F.col("place").alias("source_place")), ["source_id", "seed"]).select("doc_id", "source_id", "place", "source_place")
    known = every.where("kind = 2").select("doc_id", F.col("first").alias("source_id"), F.col("p").alias("place"), F.col("q").alias("source_place"))
    known = known.join(wanted.select("doc_id", "source_id").distinct(), ["doc_id", "source_id"], "left_semi")
    seeds = asking.select(F.explode(F.array("first", "second")).alias("seed")).distinct()
    others = placed.select("doc_id", "place", "seed").where(filters.may_hold(F.col("seed"), filters.shared(seeds))).repartition(parts, "doc_id").sortWithinPartitions("doc_id")
    keys = filters.shared(asking.select("key").distinct())
    offered = others.transform(mapped, _offers(s, keys), "key long, doc_id long, p int, q int")
    both = asking.select("doc_id", F.struct("key", "p", "q", F.lit(True).alias("asks")).alias("pair")).unionByName(offered.select("doc_id", F.struct("key", "p", "q", F.lit(False).alias("asks")).alias("pair")))
    both = written(both.groupBy("doc_id").agg(F.collect_list("pair").alias("pairs")), "seed-pairs")
    words = given.transform(mapped, _word_lists(s, filters.shared(both.select("doc_id"))), "doc_id long, words array<int>").dropDuplicates(["doc_id"])
    beside = words.join(both, "doc_id").select("doc_id", "words", "pairs").transform(mapped, _beside(s), "key long, asks boolean, doc_id long, p int, q int, beside binary")
    blocks = asking.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("n"))
    dealt = beside.join(blocks, "key").withColumn("block", F.explode(F.when(F.col("asks"), F.array(F.pmod(F.xxhash64("doc_id"), "n").cast("int"))).otherwise(F.sequence(F.lit(0), F.col("n") - 1))))
    dealt = dealt.select("key", "block", "asks", "doc_id", "p", "q", "beside").repartition(parts, "key", "block").sortWithinPartitions("key", "block", F.desc("asks"), "doc_id", "p", "q")
    by_doc = wanted.unionByName(known).distinct().repartition(parts, "doc_id").sortWithinPartitions("doc_id", "source_id", "place", "source_place")
    chained = by_doc.transform(mapped, _chained(s), CHAINS).unionByName(dealt.transform(mapped, _alike(s), CHAINS))
    passages = _aligned_chains(written(chained, "chains"), given, s)
    return passages.repartition(parts, "doc_id").sortWithinPartitions("doc_id").transform(mapped, _fewest, PASSAGES)


def repeated_passages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", settings: Settings | None = None) -> DataFrame:
    """A row a passage that stands in an earlier document too: doc_id, source_id (the earlier document), start and end
    (words, end excluded), the same in the source, equal_words.

    A passage has min_words or more, and of its words at least ``percent`` are equal in the alignment. Every run of min_words that stands in an
    earlier document word for word is in a passage. Documents without repeated passages
    have no row, so have null, empty and short texts. Of rows with the same id only one counts; null ids take no part. An empty
    table gives no rows. Other columns are left out, whatever their names. A passage that a document repeats of itself alone is none.
    """
    s = settings or Settings()
    spark = docs.sparkSession
    ship(spark)
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = given.join(_texts(given), "doc_id", "left").where("text_hash is null or xxhash64(text) = text_hash").drop("text_hash")
    places = given.transform(mapped, _seeds(s, s.words, s.window), "seed long, doc_id long, place int")
    kind = MATCHES + "".join(f", earlier_{j} long, earlier_{j}_place int" for j in range(s.earlier))
    sorted_ = places.repartition(parts, "seed").sortWithinPartitions("seed", "doc_id", "place")
    placed = written(sorted_.transform(mapped, _matches(s.earlier, True), kind + ", seed long, lost boolean, edge boolean"), "placed")
    by_doc = placed.where("doc_id <> source_id").drop("seed", "lost", "edge").repartition(parts, "doc_id").sortWithinPartitions("doc_id", "source_id", "place", "source_place")
    aligned = _aligned_chains(written(by_doc.transform(mapped, _chained(s), CHAINS), "chains"), given, s)
    both = aligned.withColumn("exact", F.lit(0)).unionByName(_exact(given, s, parts).withColumn("exact", F.lit(1)))
    found = written(both.repartition(parts, "doc_id").sortWithinPartitions("doc_id", "exact", "start").transform(mapped, _left, PASSAGES), "found")
    both = found.withColumn("exact", F.lit(0)).unionByName(_rest(given, placed, found, s, parts).withColumn("exact", F.lit(1)))
    return both.repartition(parts, "doc_id").sortWithinPartitions("doc_id", "exact", "start").transform(mapped, _left, PASSAGES)


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            _, _, first, last = word_hashes([text])
            raw, kept, at = (text or "").encode(), [], 0
            for span in sorted((x["start"], x["end"]) for x in spans or ()):
                low, high = int(first[span[0]]), int(last[span[1] - 1])
                if low > at:
                    kept.append(raw[at:low])
                at = max(at, high)
            out.append(b"".join([*kept, raw[at:]]).decode().strip() if spans else text)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["row", "text"])


def _texts(ids: DataFrame) -> DataFrame:
    """(doc_id, text_hash) of ids that have different texts: of these, the text with the least hash counts. It is written, so that Spark knows its size where it is
    joined: texts do not move to meet a small table."""
    found = ids.select("doc_id", F.xxhash64("text").alias("h")).groupBy("doc_id").agg(F.min("h").alias("text_hash"), F.max("h").alias("_high")).where("text_hash <> _high").drop("_high")
    return written(found, "texts")


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = "n_chars", settings: Settings | None = None) -> DataFrame:
    """``docs`` with repeated passages cut out of every document but the earliest; all columns stay, count_col is counted anew.

    A document that is all repetition keeps its row with an empty text. Rows without repeated passages, null texts and null ids
    are as they were. Rows that share an id and text are cut alike; of an id with different texts, one counts (see ``_texts``), and its other rows are as they were. An empty
    table stays empty. Helper columns have names that the table has not.
    """
    passages = written(repeated_passages(docs, id_col=id_col, text_col=text_col, settings=settings), "passages")
    cut_id, cuts, may, hash_, odd_id = filters.names(docs, "cut_id", "cuts", "may", "hash", "odd_id")
    odd = _texts(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")).toDF(odd_id, hash_)
    spans = passages.groupBy(F.col("doc_id").alias(cut_id)).agg(F.collect_list(F.struct("start", "end")).alias(cuts))
    shared = filters.shared(passages.select("doc_id").distinct())
    marked = docs.withColumn(may, filters.may_hold(F.col(id_col), shared))  # only these rows are moved to meet their passages
    joined = marked.where(F.col(may)).join(spans, F.col(id_col).cast("long") == F.col(cut_id), "left")
    joined = joined.join(odd, F.col(id_col).cast("long") == F.col(odd_id), "left")
    joined = joined.withColumn(cuts, F.when(F.col(hash_).isNull() | (F.xxhash64(F.col(text_col).cast("string")) == F.col(hash_)), F.col(cuts)))

    @F.pandas_udf("string")
    def without(texts, cuts):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(list(texts), pa.string()), pa.array([None if c is None else [{"start": int(x["start"]), "end": int(x["end"])} for x in c] for c in cuts], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], ["row", "text", "spans"])
        import pandas as pd

        return pd.Series(next(_without(iter([batch]))).column(1).to_pylist(), dtype=object)

    text = F.when(F.col(cuts).isNull(), F.col(text_col)).otherwise(without(F.col(text_col), F.col(cuts)))
    touched = joined.withColumn(text_col, text)
    if count_col and count_col in docs.columns:
        anew = F.length(text_col).cast(docs.schema[count_col].dataType)
        touched = touched.withColumn(count_col, F.when(F.col(cuts).isNull(), F.col(count_col)).otherwise(anew))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    return marked.where(~F.col(may)).select(*kept).unionByName(touched.select(*kept))
