"""Packing by vector bin packing with the dot-product heuristic.

An item is a run of a document's token ids with three demands: tokens, one segment, and loss-bearing tokens. A sequence is
a bin with a limit on each. The next item for an open sequence is the one, among those that fit, whose demand has the largest
dot product with what the sequence has left, both as shares of the limits. All items need one segment, so the product alone leaves the short ones; where these
would use up the segments, a sequence begins with half its segments of the shortest. When nothing fits, or one segment is left, an item is cut to fill it.

Loss-bearing ids are those after a document's context (a prompt, or a document's first line), which is given as input.
The default limits bind: of 4096 tokens at most 4072 bear loss and at most 16 segments share a sequence, both below
what a window can offer; what is left beside a full load of loss goes to contexts, cut to fit. Where none wait, these last tokens are
padded (0.6 % at most), for a sequence so full is never split.

Each task packs the documents of its own partition from a window of bounded size, so there is no shuffle, no group and
no driver state, and a lost task is simply run again. What is left at a partition's end, or where nothing fits any more, is cut at
powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketlake.llm.memory import mapped
from docketlake.llm.tokens import BLOCK, blocks, default_path, encoder
from docketlake.session import ship

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, segment int, loss_tokens long"


@dataclass(frozen=True)
class Limits:
    """Limits of a sequence; window: items that wait at most; min_piece: shorter gaps are padded instead of cutting an item, if they need not be; pad: gaps up to
    this are padded where nothing that waits may fill them, instead of splitting the sequence."""

    tokens: int = 4096
    segments: int = 16
    loss_tokens: int = 4072
    window: int = 256
    min_piece: int = 4
    pad: int = 24


class Packer:
    """Sequences from a stream of items. An item: (key, start, length, loss_from); ids before loss_from bear no loss."""

    def __init__(self, limits: Limits):
        self.limits = limits
        self.items: list[tuple] = []

    @staticmethod
    def loss(start: int, length: int, loss_from: int) -> int:
        return min(length, max(0, start + length - loss_from))

    def add(self, key, n: int, loss_from: int = 0) -> Iterator[list[tuple]]:
        """Whole sequences that come free when a document of n ids is added."""
        cap, start = self.limits.tokens, 0
        while start < n:
            length = min(cap, n - start)
            while self.loss(start, length, loss_from) > self.limits.loss_tokens:
                length -= self.loss(start, length, loss_from) - self.limits.loss_tokens
            if length == cap:
                yield [(key, start, cap, loss_from)]
            else:
                self.items.append((key, start, length, loss_from))
            start += length
            if len(self.items) >= 2 * self.limits.window:  # of one very long document
                yield from self.fill()
        if len(self.items) >= self.limits.window:
            while len(self.items) > self.limits.window // 2:
                yield from self.fill()

    def end(self) -> Iterator[list[tuple]]:
        while self.items:
            yield from self.fill()

    def fill(self) -> Iterator[list[tuple]]:
        """One sequence, or more of power-of-two lengths where it cannot be filled."""
        lim = self.limits
        start, length, loss_from = np.array([x[1:] for x in self.items], dtype=np.int64).T
        need = np.stack([length, np.ones_like(length), np.minimum(length, np.maximum(0, start + length - loss_from))], axis=1).astype(np.float64)
        free = np.ones(len(need), dtype=bool)
        left = np.array([lim.tokens, lim.segments, lim.loss_tokens], dtype=np.float64)
        caps = np.array([lim.tokens, lim.segments, lim.loss_tokens], dtype=np.float64)
        share, chosen = need / caps, []
        if 2 * len(need) * lim.tokens > lim.segments * need[:, 0].sum():  # so many short ones wait that they would be left without long ones
            for i in np.argsort(need[:, 0], kind="stable")[: lim.segments // 2].tolist():
                if (need[i] <= left).all():
                    free[i] = False
                    left -= need[i]
                    chosen.append(self.items[i])
        while left[0] and left[1] > 1:  # the last segment is for what fills the sequence best
            fits = free & (need <= left).all(axis=1)
            if not fits.any():
                break
            dots = np.where(fits, share @ (left / caps), -1.0)
            best = int(dots.argmax())
            free[best] = False
            left -= need[best]
            chosen.append(self.items[best])
        gap = int(left[0])
        while gap and left[1] and free.any():
            cuts = np.where(free, np.minimum(np.minimum(gap, length), np.maximum(0, loss_from - start) + int(left[2])), -1)
            best = int((cuts * (lim.tokens + 1) + length).argmax())  # the longest of those that fill most
            key, at, n, edge = self.items[best]
            cut = int(cuts[best])
            if not cut or cut < min(lim.min_piece, n) and not gap > lim.pad >= gap - cut:
                break
            chosen.append((key, at, cut, edge))
            self.items[best] = (key, at + cut, n - cut, edge)
            start[best], length[best], free[best] = at + cut, n - cut, cut < n
            left -= (cut, 1, self.loss(at, cut, edge))
            gap -= cut
        self.items = [x for x, keep in zip(self.items, free, strict=True) if keep]
        if gap <= max(lim.pad, lim.min_piece - 1):
            yield chosen
        else:
            yield from self.powers(chosen)

    def powers(self, chosen: list[tuple]) -> Iterator[list[tuple]]:
        """The same ids as sequences of falling power-of-two lengths."""
        total = sum(x[2] for x in chosen)
        rest = list(reversed(chosen))
        sizes = [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]
        for size in sizes:
            now, room = [], size
            while room:
                key, start, length, loss_from = rest.pop()
                cut = min(room, length)
                now.append((key, start, cut, loss_from))
                if cut < length:
                    rest.append((key, start + cut, length - cut, loss_from))
                room -= cut
            yield now


def _packed(path: str, end_id: int, limits: Limits, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, packer, held = encoder(path), Packer(limits), {}
        end = np.array([end_id], dtype=enc.dtype)
        context = TaskContext.get()
        base = ((context.partitionId() if context else 0) << 32) - 1
        rows: list[tuple] = []
        serial = 0

        def put(sequence: list[tuple]) -> None:
            nonlocal base
            base, offset = base + 1, 0
            for segment, (key, start, length, loss_from) in enumerate(sequence):
                doc_id, ids, done = held[key]
                piece = ids[start : start + length].astype("<u4").tobytes()
                rows.append((doc_id, start, length, zlib.crc32(piece), len(ids), base, offset, segment, Packer.loss(start, length, loss_from), piece if keep_ids else None))
                offset += length
                held[key][2] = done + length
                if done + length == len(ids):
                    del held[key]

        def out() -> pa.RecordBatch:
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            cols = list(zip(*rows, strict=True)) or [()] * 10
            arrays = [pa.array(c, pa.int64()) for c in cols[:7]] + [pa.array(cols[7], pa.int32()), pa.array(cols[8], pa.int64())]
            names += ["segment", "loss_tokens"]
            if keep_ids:
                arrays, names = [*arrays, pa.array(cols[9], pa.binary())], [*names, "ids"]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            texts, contexts = batch.column(1), batch.column(2)
            for low, high in blocks(texts, contexts, most=2 * BLOCK):
                n = high - low
                ids, bounds = enc.batch(pa.concat_arrays([contexts.slice(low, n), texts.slice(low, n)]))  # what both have is encoded once
                for i, doc_id in enumerate(batch.column(0).slice(low, n).to_pylist()):
                    own = np.concatenate((ids[bounds[i] : bounds[i + 1]], ids[bounds[n + i] : bounds[n + i + 1]], end))
                    held[serial] = [doc_id, own, 0]
                    for sequence in packer.add(serial, len(own), int(bounds[i + 1] - bounds[i])):
                        put(sequence)
                    serial += 1
                    if len(rows) >= 20_000:
                        yield out()
        for sequence in packer.end():
            put(sequence)
        enc.words.forget()  # tasks go round all idle workers of an executor, and each would keep its own
        yield out()

    return run


def first_line(text: Column) -> tuple[Column, Column]:
    """A text's first line, if more lines follow, and the rest: context and text for documents without a prompt."""
    first = F.when(F.instr(text, "\n") > 0, F.substring_index(text, "\n", 1)).otherwise(F.lit(""))
    return first, F.substring(text, F.length(first) + 1, F.length(text))


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", context_col: str | None = None, first_line_is_context: bool = False, tokenizer: str | None = None, end_id: int = 2, limits: Limits | None = None, keep_ids: bool = False) -> DataFrame:
    """Pieces of every document in sequences within ``limits``; each id of a document lies in exactly one piece.

    A document's ids: those of its context (which bear no loss), of its text, and the end id. The context is context_col (a
    conversation's prompt; null: empty), or the text's first line where first_line_is_context, which needs a tokenizer that drops
    white space; else there is none and all ids bear loss; the limit on these is then that on tokens, if no limits are given.

    Columns: doc_id, start, length, ids_crc32 (of the piece's ids as little-endian 32-bit), doc_tokens, sequence_id, offset
    (gapless from 0 in its sequence), segment, loss_tokens, and ids (binary, where keep_ids).

    A null or empty text is one id, the end id. Repeated rows are separate documents that share a doc_id; a null doc_id
    stays null. An empty table gives no rows. Of items with equal dot products the one that came first is taken. Other columns are left out, whatever
    their names.
    """
    ship(docs.sparkSession)
    whole = Limits()
    limits = limits or (whole if context_col or first_line_is_context else replace(whole, loss_tokens=whole.tokens))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    context = F.coalesce(F.col(context_col).cast("string"), F.lit("")) if context_col else F.lit("")
    if first_line_is_context:
        context, text = first_line(text)
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), context.alias("context"))
    run = _packed(tokenizer or default_path("word_bpe_49k.json"), end_id, limits, keep_ids)
    return given.transform(mapped, run, SCHEMA + (", ids binary" if keep_ids else ""))
