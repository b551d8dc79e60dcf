"""Token-id output as length-delimited binary records, with a separate offset index for shuffled reads.

A record on disk: length (uint64), masked CRC-32C of those eight bytes (uint32), payload, masked CRC-32C of the payload
(uint32), all little-endian; this is the TFRecord framing. The payload: doc_id (int64), ids before it in its shard (int64), number
of ids (uint32), bytes an id (uint16), 1 if the doc_id is null (uint16), then the ids. Shards are range partitions of
doc_id, so shard by shard the files hold ascending doc_id.
"""

from __future__ import annotations

import functools
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketlake.llm.memory import mapped
from docketlake.llm.tokens import blocks, default_path, encoder
from docketlake.session import scratch, ship

#: Fixed values of the record format: the reflected Castagnoli polynomial and the mask's constant.
POLYNOMIAL, MASK_DELTA = 0x82F63B78, 0xA282EAD8
BLOCK = 512
#: Layout of a payload before its ids.
HEAD = "<qqIHH"


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """CRC tables for eight bytes at a time, the same for byte pairs, and tables that carry a CRC over BLOCK zero bytes."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    eight = [table]
    for _ in range(7):
        eight.append(table[eight[-1] & 0xFF] ^ (eight[-1] >> 8))
    pairs = np.arange(1 << 16, dtype=np.uint32)
    wide = [eight[k + 1][pairs & 0xFF] ^ eight[k][pairs >> 8] for k in (6, 4, 2, 0)]
    skip = np.empty((4, 256), dtype=np.uint32)
    for k in range(4):
        crc = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
        for _ in range(BLOCK):
            crc = table[crc & 0xFF] ^ (crc >> np.uint32(8))
        skip[k] = crc
    return np.array(eight), np.array(wide), skip


def crc32c(payloads: list[bytes]) -> np.ndarray:
    """CRC-32C of each payload; all payloads' blocks advance together, then a payload's blocks are combined."""
    if not payloads:
        return np.empty(0, dtype=np.uint32)
    eight, wide, skip = _tables()
    sizes = np.array([len(p) for p in payloads], dtype=np.int64)
    blocks = np.maximum(1, -(-sizes // BLOCK))
    ends = np.cumsum(blocks) * BLOCK
    flat = np.zeros(int(ends[-1]), dtype=np.uint8)
    for p, end in zip(payloads, ends, strict=True):
        flat[end - len(p) : end] = np.frombuffer(p, dtype=np.uint8)  # zeros in front change nothing while the register is 0
    short = sizes < 4
    for k in range(4):  # the register's first value, 0xFFFFFFFF, goes into the first four bytes
        flat[(ends - sizes)[~short] + k] ^= 0xFF
    words = np.ascontiguousarray(flat.view("<u4").reshape(-1, BLOCK // 4))
    crc = np.zeros(len(words), dtype=np.uint32)
    for k in range(0, BLOCK // 4, 2):
        low, high = crc ^ words[:, k], words[:, k + 1]
        crc = wide[0].take(low & 0xFFFF) ^ wide[1].take(low >> 16) ^ wide[2].take(high & 0xFFFF) ^ wide[3].take(high >> 16)
    out, at = np.zeros(len(payloads), dtype=np.uint32), np.cumsum(blocks) - blocks
    for step in range(int(blocks.max())):
        on = blocks > step
        now = out[on]
        now = skip[0][now & 0xFF] ^ skip[1][(now >> 8) & 0xFF] ^ skip[2][(now >> 16) & 0xFF] ^ skip[3][now >> 24]
        out[on] = now ^ crc[at[on] + step]
    out ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(short):
        c = 0xFFFFFFFF
        for byte in payloads[i]:
            c = int(eight[0][(c ^ byte) & 0xFF]) ^ (c >> 8)
        out[i] = c ^ 0xFFFFFFFF
    return out


def crc32c_words(lengths: list[int]) -> np.ndarray:
    """CRC-32C of each number's eight little-endian bytes."""
    eight, _, _ = _tables()
    x = np.array(lengths, dtype="<u8")
    low, high = (x & 0xFFFFFFFF).astype(np.uint32) ^ np.uint32(0xFFFFFFFF), (x >> np.uint64(32)).astype(np.uint32)
    crc = eight[7][low & 0xFF] ^ eight[6][(low >> 8) & 0xFF] ^ eight[5][(low >> 16) & 0xFF] ^ eight[4][low >> 24]
    return crc ^ eight[3][high & 0xFF] ^ eight[2][(high >> 8) & 0xFF] ^ eight[1][(high >> 16) & 0xFF] ^ eight[0][high >> 24] ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    """The CRC rotated right by 15 bits plus a constant, so that a CRC of data holding CRCs stays sound."""
    crc = crc.astype(np.uint32)
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_DELTA)


def frames(payloads: list[bytes]) -> list[bytes]:
    lengths = [struct.pack("<Q", len(p)) for p in payloads]
    heads, bodies = masked(crc32c_words([len(p) for p in payloads])), masked(crc32c(payloads))
    return [b"".join((n, struct.pack("<I", h), p, struct.pack("<I", b))) for n, h, p, b in zip(lengths, heads.tolist(), payloads, bodies.tolist(), strict=True)]


def unframed(found: list[bytes]) -> list[bytes]:
    """Payloads of framed records; ValueError if a length or checksum does not hold."""
    payloads = [x[12:-4] for x in found]
    heads, bodies = masked(crc32c_words([struct.unpack("<Q", x[:8])[0] for x in found])).tolist(), masked(crc32c(payloads)).tolist()
    for x, p, h, b in zip(found, payloads, heads, bodies, strict=True):
        if struct.unpack("<Q", x[:8])[0] != len(p) or struct.unpack("<I", x[8:12])[0] != h or struct.unpack("<I", x[-4:])[0] != b:
            raise ValueError("a record's length or checksum does not hold")
    return payloads


def _writer(folder: str, path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, context = encoder(path), TaskContext.get()
        shard = context.partitionId()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        file = f"{root}/{shard:06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.records"  # only an attempt that ends well is in the index
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        names = ["doc_id", "shard", "file", "offset", "length", "start_in_shard", "n_tokens"]
        with store.open_output_stream(file) as out:
            at = start = 0
            for batch in batches:
                ids, texts, width = batch.column(0).to_pylist(), batch.column(1), np.dtype(enc.dtype).itemsize
                for low, high in blocks(texts):
                    got, bounds = enc.batch(texts.slice(low, high - low))
                    own = ids[low:high]
                    counts = np.diff(bounds) + 1
                    starts = start + np.cumsum(counts) - counts
                    heads = [struct.pack(HEAD, i or 0, s, n, width, i is None) for i, s, n in zip(own, starts.tolist(), counts.tolist(), strict=True)]
                    framed = frames([h + got[a:b].tobytes() + end for h, a, b in zip(heads, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)])
                    out.write(b"".join(framed))
                    sizes = np.fromiter(map(len, framed), np.int64, len(framed))
                    offsets = at + np.cumsum(sizes) - sizes
                    at, start = at + int(sizes.sum()), start + int(counts.sum())
                    n = high - low
                    yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array([shard] * n, pa.int32()), pa.array([file] * n), *(pa.array(x, pa.int64()) for x in (offsets, sizes, starts, counts))], names)

    return run


INDEX = "doc_id long, shard int, file string, offset long, length long, start_in_shard long, n_tokens long"


def write_records(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = 1, folder: str | None = None, shard_bytes: int = 32 << 20) -> DataFrame:
    """Writes the record files and, beside them, the offset index as a Parquet table; returns the index.

    Shards hold about shard_bytes of text, so their number grows with the table. Index columns: doc_id, shard, file, offset, length (of the framed
    record), start_in_shard (ids before it in its shard), n_tokens.

    A null or empty text is the end id alone; a null doc_id is marked in its record and sorts first. Rows with equal doc_id are in order
    of a hash of their text, then of the text, so a lost task writes them again as they were, and many of them share shards. Repeated rows
    are repeated records; an empty table writes no record and an empty index. Other columns are left out.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = folder or scratch(spark, "records")
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    total = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ordered = given.withColumn("h", F.xxhash64("text")).repartitionByRange(max(1, -(-total // shard_bytes)), "doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
    ordered.select("doc_id", "text").transform(mapped, _writer(f"{folder}/shards", tokenizer or default_path("word_bpe_49k.json"), end_id), INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def _in_bytes(rows: list, size, most: int = 8 << 20) -> Iterator[list]:
    """Runs of rows of about ``most`` bytes in all."""
    run, held = [], 0
    for row in rows:
        run.append(row)
        held += size(row)
        if held >= most:
            yield run
            run, held = [], 0
    if run:
        yield run


def _reader(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        file, source = None, None
        for batch in batches:
            rows = list(zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True))
            for run_ in _in_bytes(rows, lambda r: r[4]):
                found = []
                for _, _, path, offset, length, *_ in run_:
                    if path != file:
                        if source:
                            source.close()
                        file, source = path, store.open_input_file(path)
                    found.append(source.read_at(length, offset))
                ids, heads = [], []
                for p in unframed(found):
                    doc_id, start, n, width, none = struct.unpack_from(HEAD, p)
                    heads.append((None if none else doc_id, start, n))
                    ids.append(np.frombuffer(p, dtype=f"<u{width}", count=n, offset=struct.calcsize(HEAD)).astype("<u4").tobytes())
                if any(h != (r[0], r[5], r[6]) for h, r in zip(heads, run_, strict=True)):
                    raise ValueError("a record is not the one that the index names")
                told = list(zip(*heads, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(told[0], pa.int64()), pa.array([r[1] for r in run_], pa.int32()), pa.array(told[1], pa.int64()), pa.array(told[2], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "shard", "start_in_shard", "n_tokens", "ids_crc32", "ids"])
        if source:
            source.close()

    return run


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The index's records, in whatever order the index has them: doc_id, shard, start_in_shard, n_tokens, ids_crc32, ids
    (binary of little-endian 32-bit ids), all but the shard from the records themselves.

    A checksum that does not hold, or a record that is not the one the index names, is a ValueError. An empty index gives no rows.
    ``folder`` names the file system the files are on."""
    ship(index.sparkSession)
    return index.select(*(x.split()[0] for x in INDEX.split(", "))).transform(mapped, _reader(folder), "doc_id long, shard int, start_in_shard long, n_tokens long, ids_crc32 long, ids binary")


def with_global_start(records: DataFrame, index: DataFrame) -> DataFrame:
    """Adds ``start``: ids of all documents before it, null ids first. Repeated records have starts of their own; no records, no rows.

    One row a shard, two numbers, is gathered; at 100 TB and shards of 32 MB these are three million rows, which larger shards lower."""
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()
    bases, base = [], 0
    for row in totals:
        bases.append((row["shard"], base))
        base += row["n"]
    starts = records.sparkSession.createDataFrame(bases or [(0, 0)], "shard int, base long")
    return records.join(F.broadcast(starts), "shard").withColumn("start", F.col("base") + F.col("start_in_shard")).drop("base")
