"""Media columns: payloads kept as 8-bit sound in content-defined chunks, deduplicated by Spark joins.

A payload is a text's UTF-8 bytes and zeros up to a positive multiple of 64. Its media form is a WAV file of 8-bit samples,
one channel. A rolling gear hash cuts the media into chunks, so equal passages give equal chunks wherever they stand. The store
has two tables: ``chunks`` holds each chunk that occurs more than once, a single time; ``media`` holds a row a
document with its ordered list of chunk digests and, in place, the chunks that occur nowhere else. Reading back joins
the shared chunks to the rows that need them, puts the list in order, and verifies length and digest.

Chunks that occur once never move: a Bloom filter of the repeated digests, of fixed size, is all that tasks are told. What it takes
for repeated but is not goes the way of the repeated ones and is stored there, so the filter's errors change no result.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketlake.llm.memory import mapped
from docketlake.session import scratch, ship

SEED, WINDOW = 64_206, 32
RATE = 8000
#: Fixed layout of a WAV header: 44 bytes, PCM, one channel, 8 bits.
WAV = "<4sI4s4sIHHIIHH4sI"


def payload(text: str | None) -> tuple[bytes, int]:
    """Padded bytes and the number before padding."""
    raw = (text or "").encode()
    return raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw)), len(raw)


def to_wav(samples: bytes) -> bytes:
    return struct.pack(WAV, b"RIFF", 36 + len(samples), b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(samples)) + samples


def from_wav(media: bytes) -> bytes:
    head = struct.unpack_from(WAV, media)
    if (head[0], head[2], head[5], head[6], head[10]) != (b"RIFF", b"WAVE", 1, 1, 8) or head[12] != len(media) - struct.calcsize(WAV):
        raise ValueError("not a WAV file of 8-bit samples, one channel")
    return media[struct.calcsize(WAV) :]


def features(samples: bytes) -> str:
    """Mean, root mean square about 128, zero crossings and peak of the samples, as one string."""
    x = np.frombuffer(samples, dtype=np.uint8).astype(np.int64) - 128
    crossings = int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))
    return f"mean={x.mean():.4f};rms={np.sqrt((x * x).mean()):.4f};crossings={crossings};peak={int(np.abs(x).max())}"


@functools.cache
def _gear() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 32, 256, dtype=np.uint32)


def cut_points(data: bytes, bits: int = 10, least: int = 256, most: int = 8192) -> list[int]:
    """Ends of the chunks: after a byte whose gear hash over the last 32 bytes has its top ``bits`` zero, within least and most."""
    n = len(data)
    if n <= least:
        return [n]
    h = _gear()[np.frombuffer(data, dtype=np.uint8)]
    for k in (1, 2, 4, 8, 16):  # the sum over 32 bytes, each shifted by its distance, in five doublings
        h[k:] = h[k:] + (h[:-k] << np.uint32(k))
    ends, start = [], 0
    for at in (np.flatnonzero(h >> np.uint32(32 - bits) == 0) + 1).tolist():
        while at - start > most:
            start += most
            ends.append(start)
        if at - start >= least and at < n:
            ends.append(at)
            start = at
    while n - start > most:
        start += most
        ends.append(start)
    return [*ends, n]


def chunks_of(media: bytes) -> list[bytes]:
    ends = cut_points(media)
    return [media[a:b] for a, b in zip([0, *ends], ends)]  # noqa: B905  one start too many


def digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def _texts(batches: Iterator[pa.RecordBatch], step: int = 256) -> Iterator[tuple[list, list]]:
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield part.column(0).to_pylist(), part.column(1).to_pylist()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, texts in _texts(batches):
        found = [digest(c) for t in texts for c in chunks_of(to_wav(payload(t)[0]))]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["digest"])


def _places(digests: np.ndarray, bits: int) -> np.ndarray:
    """Four places in a filter of 2**bits for each digest: parts of the digest are independent hashes already."""
    return (digests.view("<u4").reshape(-1, 4).astype(np.int64) & ((1 << bits) - 1)).reshape(-1)


def _filter_words(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_pylist()
            if not found:
                continue
            at = np.unique(_places(np.frombuffer(b"".join(found), dtype=np.uint8), bits))
            words, first = np.unique(at >> 5, return_index=True)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.int64()), pa.array(np.bitwise_or.reduceat(np.int64(1) << (at & 31), first), pa.int64())], ["word", "bits"])

    return run


def repeated_filter(docs: DataFrame, bits: int) -> np.ndarray:
    """The Bloom filter of digests that occur more than once, as 2**bits bits; this size bounds what comes to the driver."""
    found = docs.transform(mapped, _digests, "digest binary").groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    words = found.transform(mapped, _filter_words(bits), "word long, bits long").groupBy("word").agg(F.expr("bit_or(bits)").alias("bits")).toPandas()
    packed = np.zeros(1 << (bits - 5), dtype="<u4")
    packed[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype("<u4")
    return packed


MEDIA = "row long, doc_id long, n_bytes long, media_bytes long, media_sha256 string, digests array<binary>, in_place array<binary>"


def _store(shared) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze, packed = zstandard.ZstdCompressor(level=3).compress, shared.value
        bits, row = len(packed).bit_length() - 1 + 5, TaskContext.get().partitionId() << 40
        for ids, texts in _texts(batches):
            cols: tuple[list, ...] = ([], [], [], [], [])
            for text in texts:
                body, n = payload(text)
                media = to_wav(body)
                parts = chunks_of(media)
                names = [digest(c) for c in parts]
                at = _places(np.frombuffer(b"".join(names), dtype=np.uint8), bits)
                maybe = ((packed[at >> 5] >> (at & 31).astype(np.uint32)) & 1).reshape(-1, 4).all(axis=1)
                for col, value in zip(cols, (n, len(media), hashlib.sha256(media).hexdigest(), names, [None if m else squeeze(c) for c, m in zip(parts, maybe, strict=True)]), strict=True):
                    col.append(value)
            rows = pa.array(range(row, row + len(ids)), pa.int64())
            row += len(ids)
            yield pa.RecordBatch.from_arrays([rows, pa.array(ids, pa.int64()), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.list_(pa.binary())), pa.array(cols[4], pa.list_(pa.binary()))], ["row", "doc_id", "n_bytes", "media_bytes", "media_sha256", "digests", "in_place"])

    return run


def _shared_chunks(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze, packed = zstandard.ZstdCompressor(level=3).compress, shared.value
        bits = len(packed).bit_length() - 1 + 5
        for _, texts in _texts(batches):
            found: dict[bytes, bytes] = {}
            for text in texts:
                parts = chunks_of(to_wav(payload(text)[0]))
                names = [digest(c) for c in parts]
                at = _places(np.frombuffer(b"".join(names), dtype=np.uint8), bits)
                maybe = ((packed[at >> 5] >> (at & 31).astype(np.uint32)) & 1).reshape(-1, 4).all(axis=1)
                found |= {k: c for k, c, m in zip(names, parts, maybe, strict=True) if m and k not in found}
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array([squeeze(c) for c in found.values()], pa.binary())], ["digest", "chunk"])

    return run


def store(docs: DataFrame, folder: str, *, id_col: str = "doc_id", text_col: str = "text", filter_bits: int = 23) -> None:
    """Writes the tables ``media`` and ``chunks`` under ``folder``. filter_bits: log2 of the Bloom filter's bits (1 MB at 23)."""
    spark = docs.sparkSession
    ship(spark)
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = spark.sparkContext.broadcast(repeated_filter(given, filter_bits))
    given.transform(mapped, _store(shared), MEDIA).write.option("compression", "uncompressed").parquet(f"{folder}/media")
    once = given.transform(mapped, _shared_chunks(shared), "digest binary, chunk binary").groupBy("digest").agg(F.first("chunk").alias("chunk"))
    once.write.option("compression", "uncompressed").parquet(f"{folder}/chunks")


READ = "doc_id long, n_bytes long, media_bytes long, media_sha256 string, payload_bytes long, payload_sha256 string, tail_crc32 long, feature string, media binary"


def _read(keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256).to_pylist()
                cols: tuple[list, ...] = ([], [], [], [], [])
                for r in rows:
                    there = {x["at"]: x["chunk"] for x in r["shared"] or ()}
                    media = b"".join([expand(c if c is not None else there[k]) for k, c in enumerate(r["in_place"])])
                    if len(media) != r["media_bytes"] or hashlib.sha256(media).hexdigest() != r["media_sha256"]:
                        raise ValueError(f"stored media of document {r['doc_id']} do not verify")
                    body = from_wav(media)
                    for col, value in zip(cols, (len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-64:]), features(body), media if keep else None), strict=True):
                        col.append(value)
                yield pa.RecordBatch.from_arrays([pa.array([r["doc_id"] for r in rows], pa.int64()), pa.array([r["n_bytes"] for r in rows], pa.int64()), pa.array([r["media_bytes"] for r in rows], pa.int64()), pa.array([r["media_sha256"] for r in rows], pa.string()), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.binary())], ["doc_id", "n_bytes", "media_bytes", "media_sha256", "payload_bytes", "payload_sha256", "tail_crc32", "feature", "media"])

    return run


def read(spark, folder: str, *, keep_media: bool = False) -> DataFrame:
    """Every stored document: its media put together from the chunk list and verified, its payload's digests and features.

    Documents whose chunks all stand in place are read as they are; only the others meet the shared chunks in a join on
    the digest and are brought together by a key of their own row.
    """
    ship(spark)
    media = spark.read.schema(MEDIA).parquet(f"{folder}/media")
    chunks = spark.read.schema("digest binary, chunk binary").parquet(f"{folder}/chunks")
    needs = F.exists("in_place", lambda c: c.isNull())
    whole = media.where(~needs).drop("row").withColumn("shared", F.lit(None).cast("array<struct<at:int,chunk:binary>>"))
    part = media.where(needs)
    lists = part.select("row", F.posexplode(F.arrays_zip("digests", "in_place")).alias("at", "c")).where(F.col("c.in_place").isNull()).select("row", "at", F.col("c.digests").alias("digest"))
    gathered = lists.join(chunks, "digest").groupBy("row").agg(F.collect_list(F.struct("at", "chunk")).alias("shared"))
    together = part.join(gathered, "row").drop("row")
    return whole.unionByName(together).transform(mapped, _read(keep_media), READ)


def through_media(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None, filter_bits: int = 23) -> DataFrame:
    """Stores every document and reads it back: doc_id, n_bytes, media_bytes, media_sha256, payload_bytes, payload_sha256,
    tail_crc32, feature.

    A null or empty text is 64 zero bytes. Equal texts give equal values; repeated rows and ids are kept apart. An empty
    table writes empty tables and gives no rows. Other columns are left out.
    """
    spark = docs.sparkSession
    folder = folder or scratch(spark, "media")
    store(docs, folder, id_col=id_col, text_col=text_col, filter_bits=filter_bits)
    return read(spark, folder).drop("media")
