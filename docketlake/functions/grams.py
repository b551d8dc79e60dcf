"""Hashed word n-grams of many texts at once, for tasks that hold Arrow batches. Words are as in ``functions.text.words``: the texts come in lower case."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_WORD = np.isin(np.arange(256), np.frombuffer(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_", dtype=np.uint8))


def _numbers(first: int, n: int) -> np.ndarray:
    return _mix(np.arange(first, first + n, dtype=np.uint64) * _GOLD) | np.uint64(1)


def _words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all words, one after the other, their sizes, and the first word of each text (one more at the end)."""
    parts = [(t or "").encode() for t in texts]
    data = np.frombuffer(b" ".join([*parts, b""]), dtype=np.uint8)
    inside = _WORD[data]
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    at = np.cumsum([0, *(len(p) + 1 for p in parts)])
    return data[inside], ends - starts, np.searchsorted(starts, at)


def _hashes(data: np.ndarray, sizes: np.ndarray, values: np.ndarray = _BYTES, seed: int = 1_000) -> np.ndarray:
    """Hashes of strings of these sizes, whose bytes follow each other."""
    out, ends = np.empty(len(sizes), np.uint64), np.cumsum(sizes)
    for at in range(0, len(sizes), 1 << 16):
        n, stop = sizes[at : at + (1 << 16)], ends[at : at + (1 << 16)]
        first = stop - n - (stop[0] - n[0])
        place = np.arange(int(n.sum())) - np.repeat(first, n)
        each = values[data[stop[0] - n[0] : stop[-1]]] * _numbers(seed, int(n.max()))[place]
        sums, full = np.zeros(len(n), np.uint64), n > 0
        if len(each):
            sums[full] = np.add.reduceat(each, first[full])
        out[at : at + len(n)] = _mix(sums + n.astype(np.uint64) * _GOLD)
    return out


def _word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the first word of each text (one more at the end)."""
    data, sizes, bounds = _words(texts)
    return _hashes(data, sizes), bounds


def gram_arrays(n: int):
    """From batches of (doc_id, text): (doc_id, the distinct hashes of its runs of n words in rising order, their number)."""
    factors = _numbers(9_000, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                words, bounds = _word_hashes(part.column(1).to_pylist())
                runs = np.zeros(max(len(words) - n + 1, 0), dtype=np.uint64)
                for k, factor in enumerate(factors):
                    runs += words[k : len(runs) + k] * factor
                runs = _mix(runs).view(np.int64)
                sets = [np.unique(runs[a : max(a, b - n + 1)]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                sizes = np.array([len(x) for x in sets], dtype=np.int32)
                offsets = pa.array(np.cumsum([0, *sizes]), pa.int32())
                grams = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([part.column(0), grams, pa.array(sizes)], ["doc_id", "grams", "size"])

    return run


def overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by cell, sets before pairs (x, y, a, b, grams; a set has no b): (a, b, overlap). Holds the sets of one cell."""
    cell, sets = None, {}
    for batch in batches:
        one, two = ((batch.column(i).to_pylist()) for i in (0, 1))
        a, b, grams = batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4)
        values, offsets = grams.values.to_numpy(), grams.offsets.to_numpy()
        found: tuple[list, list, list] = ([], [], [])
        for i in range(batch.num_rows):
            if (one[i], two[i]) != cell:
                cell, sets = (one[i], two[i]), {}
            if b[i] is None:
                sets[a[i]] = np.sort(values[offsets[i] : offsets[i + 1]])
                continue
            few, many = sorted((sets[a[i]], sets[b[i]]), key=len)
            at = np.searchsorted(many, few)
            at[at == len(many)] = 0
            for column, value in zip(found, (a[i], b[i], int(np.count_nonzero(many[at] == few))), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.int32())], ["a", "b", "overlap"])


#: Texts of so many bytes make a block, whose n-grams are told apart by itself before they meet those of others.
_BLOCK = 4 << 20


def gram_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (doc_id, texts or arrays of n-grams) sorted by both: blocks of whole documents (given, size), compressed. A document's equal rows count once."""
    docs, given, size, last = [], [], 0, None
    for batch in batches:
        kind = batch.column(1).type
        for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if value is None:
                continue
            if given and doc == last:
                if value == given[-1]:
                    continue
            elif size >= _BLOCK:
                yield _block(docs, given, size, kind)
                docs, given, size = [], [], 0
            docs.append(docs[-1] + (doc != last) if docs else 0)
            given.append(value)
            size += len(value) if isinstance(value, str) else sum(map(len, value))
            last = doc
    if given:
        yield _block(docs, given, size, kind)


def _block(docs: list[int], given: list, size: int, kind: pa.DataType) -> pa.RecordBatch:
    part = pa.RecordBatch.from_arrays([pa.array(docs, pa.int32()), pa.array(given, kind)], ["doc", "given"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(part)
    return pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([size], pa.int64())], ["given", "size"])


def _places(block: bytes, n: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """A block's words (of arrays, their n-grams, for which n is 1); the first word of each of its distinct n-grams at its first place; that place's rank in the block; and the
    n-gram's 96 bits as two columns, in whose order all are."""
    docs, given = pa.ipc.open_stream(block).read_all().combine_chunks().columns
    docs, given = docs.to_numpy(), given.combine_chunks()
    if pa.types.is_string(given.type):
        data, sizes, bounds = _words(given.to_pylist())
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    else:
        words = given.flatten().cast(pa.large_string()).fill_null("")
        bounds = np.concatenate([[0], np.cumsum(given.value_lengths().to_numpy())])
        offsets = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, 8 * words.offset)
        data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        sizes = np.diff(offsets)
    text = np.repeat(np.arange(len(docs)), np.diff(bounds))
    at = np.flatnonzero(text[: max(len(text) - n + 1, 0)] == text[n - 1 :])
    if len(docs) and docs[-1] + 1 < len(docs):  # several texts of a document: their places by turns
        at = at[np.lexsort((text[at], at - bounds[text[at]], docs[text[at]]))]
    marks = []
    for seed, values in ((1_000, _BYTES), (1 << 40, _mix(_BYTES ^ _GOLD))):
        hashes, runs = _hashes(data, sizes, values, seed), np.zeros(len(at), np.uint64)
        for k, factor in enumerate(_numbers(9_000 + seed, n)):
            runs += hashes[at + k] * factor
        marks.append(_mix(runs))
    k, l = marks[0], (marks[1] >> np.uint64(32)).astype(np.uint32)
    rank = _firsts(k, l)
    return words, at[rank], rank, k[rank], l[rank]


def _firsts(k: np.ndarray, l: np.ndarray) -> np.ndarray:
    """Where each pair of values comes first, in rising order of k."""
    order = np.argsort(k, kind="stable")
    same = np.diff(k[order]) == 0
    if np.any(same & (np.diff(l[order]) != 0)):
        order = np.lexsort((l, k))
        same = (np.diff(k[order]) == 0) & (np.diff(l[order]) == 0)
    return order[np.append(True, ~same)[: len(order)]]


def _lows(parts: int) -> np.ndarray:
    """The least value of each of so many equal parts of 64 bits."""
    return np.array([-(-(p << 64) // parts) for p in range(parts)], np.uint64)


def gram_marks(n: int, parts: int):
    """From blocks (block, given): (part, block, marks), the distinct n-grams of a block as 96 bits each, dealt over parts by their value and in its order. The first 64 bits move
    as steps from one to the next, which saves some 20 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows = _lows(parts)
        for batch in batches:
            for block, given in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                *_, k, l = _places(given.as_buffer(), n)
                at = np.append(np.searchsorted(k, lows), len(k))
                some = np.flatnonzero(np.diff(at))
                marks = [_packed(k[at[p] : at[p + 1]], l[at[p] : at[p + 1]], lows[p]) for p in some]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([block] * len(some), pa.int64()), pa.array(marks, pa.binary())], ["part", "block", "marks"])

    return run


def _packed(k: np.ndarray, l: np.ndarray, low: np.uint64) -> bytes:
    steps = np.diff(k, prepend=low)
    width = max(1, -(-int(steps.max()).bit_length() // 8))
    return bytes([width]) + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes() + l.astype("<u4").tobytes()


def _unpacked(marks: bytes, low: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    width = marks[0]
    n = (len(marks) - 1) // (width + 4)
    steps = np.zeros((n, 8), np.uint8)
    steps[:, :width] = np.frombuffer(marks, np.uint8, n * width, 1).reshape(n, width)
    return low + np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64), np.frombuffer(marks[1 + n * width :], "<u4")


def gram_firsts(parts: int):
    """From (part, block, marks) sorted by the first two: (block, part, n, firsts), a bit for each mark that stands in no earlier block, and their number. Holds one part."""

    def told(part: int, low: np.uint64, blocks: list[int], pieces: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        k, l = (np.concatenate(x) for x in zip(*pieces, strict=True))
        first = np.zeros(len(k), bool)
        first[_firsts(k, l)] = True
        each = np.split(first, np.cumsum([len(x) for x, _ in pieces])[:-1])
        columns = [pa.array(blocks, pa.int64()), pa.array([part] * len(blocks), pa.int32()), pa.array([int(x.sum()) for x in each], pa.int64()), pa.array([np.packbits(x).tobytes() for x in each], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["block", "part", "n", "firsts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows, part, blocks, pieces = _lows(parts), None, [], []
        for batch in batches:
            for p, block, marks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if p != part and blocks:
                    yield told(part, lows[part], blocks, pieces)
                    blocks, pieces = [], []
                part = p
                blocks.append(block)
                pieces.append(_unpacked(marks, lows[p]))
        if blocks:
            yield told(part, lows[part], blocks, pieces)

    return run


def new_grams(n: int, parts: int):
    """From blocks (given, base, told: part and firsts in order): (gram, gram_id) of the n-grams that stand in no earlier block, numbered on from base in order of place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows = _lows(parts)
        for batch in batches:
            for given, base, told in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2), strict=True):
                words, at, rank, k, _ = _places(given.as_buffer(), n)
                bounds, new = np.append(np.searchsorted(k, lows), len(k)), np.zeros(len(k), bool)
                for row in told.as_py():
                    a, b = bounds[row["part"]], bounds[row["part"] + 1]
                    new[a:b] = np.unpackbits(np.frombuffer(row["firsts"], np.uint8), count=b - a)
                at = at[new][np.argsort(rank[new])]
                for i in range(0, len(at), 1 << 16):
                    some = at[i : i + (1 << 16)]
                    grams = pc.binary_join_element_wise(*(words.take(pa.array(some + j)) for j in range(n)), pa.scalar(" ", pa.large_string()))
                    yield pa.RecordBatch.from_arrays([grams.cast(pa.string()), pa.array(base + 1 + i + np.arange(len(some)), pa.int64())], ["gram", "gram_id"])

    return run
