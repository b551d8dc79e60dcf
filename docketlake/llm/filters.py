"""A Bloom filter over 64-bit hashes: a bounded thing to broadcast, whatever the number of hashes.

Its size follows their number, 16 bits a hash, up to 2**MOST_BITS bits (16 MB). Beyond eight million hashes it lets more through, all in the end: it only
ever saves moving rows, and changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketlake.llm.memory import mapped
from docketlake.llm.words import mix
from docketlake.session import written


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Three places of 2**bits for each hash, a row a hash."""
    h = mix(hashes.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
    step = mix(h) | np.uint64(1)
    return np.stack([(h + step * np.uint64(k)) >> np.uint64(64 - bits) for k in range(3)], axis=1).astype(np.int64)


def _words(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.unique(places(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64), bits))
            words, first = np.unique(at >> 5, return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.int64()), pa.array(np.bitwise_or.reduceat(np.int64(1) << (at & 31), first), pa.int64())], ["word", "bits"])

    return run


LEAST_BITS, MOST_BITS = 16, 27


def bits_for(n: int) -> int:
    """log2 of the bits for n hashes."""
    return min(MOST_BITS, max(LEAST_BITS, (16 * n).bit_length()))


def shared(hashes: DataFrame):
    """The filter of a column of non-null longs, of a size that follows their number, as a broadcast."""
    known = written(hashes, "filtered")
    return hashes.sparkSession.sparkContext.broadcast(build(known, bits_for(known.count())))


def names(docs: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that the table has not, in any case of letters."""
    taken, got = {c.lower() for c in docs.columns}, []
    for name in wanted:
        name = "_" + name
        while name in taken:
            name = "_" + name
        got.append(name)
    return got


def build(hashes: DataFrame, bits: int) -> np.ndarray:
    """The filter of a column of non-null longs. At most 2**(bits - 5) numbers come to the driver."""
    rows = hashes.transform(mapped, _words(bits), "word long, bits long").groupBy("word").agg(F.expr("bit_or(bits)").alias("bits")).toArrow()
    packed = np.zeros(1 << (bits - 5), dtype="<u4")
    packed[rows["word"].to_numpy()] = rows["bits"].to_numpy().astype("<u4")
    return packed


def holds(packed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may have been put in; never false for one that was."""
    at = places(hashes, len(packed).bit_length() - 1 + 5)
    return (packed[at >> 5] >> (at & 31).astype(np.uint32) & np.uint32(1)).all(axis=1)


def may_hold(column: Column, packed) -> Column:
    """Whether a filter that was broadcast may hold an id; only the id goes to Python. Null is not held."""

    @F.pandas_udf("boolean")
    def held(ids):
        import pandas as pd

        known = ids.notna().to_numpy()
        out = np.zeros(len(ids), dtype=bool)
        if known.any():
            out[known] = holds(packed.value, ids[known].to_numpy().astype(np.int64).view(np.uint64))
        return pd.Series(out)

    return held(column.cast("long"))
