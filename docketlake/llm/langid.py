"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of a letter three-gram binds its letters' vectors, each permuted
by its place: rotate(a, 2) * rotate(b, 1) * c. A text's vector bundles (adds) those of its three-grams, a language's
prototype bundles those of all its learning texts. A text has the language whose prototype, after the mean of
the prototypes is taken from all, has the largest cosine with it.

Bundling is linear: each task bundles its own learning rows, a vector of whole numbers a language, and Spark adds these vectors up. What
a task holds and what comes to the driver is languages x dimensions numbers, and languages are known by name (ISO 639 has under 8,000).
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketlake.llm.memory import mapped
from docketlake.session import ship

#: Letter codes: 0 stands between words, a to z are 1 to 26, all other letters share the rest by their code point.
LETTERS, SEED = 128, 20_240_501
CODES = LETTERS**3


@functools.cache
def _letter_codes() -> np.ndarray:
    """Letter code of every code point; 0 for what is no letter."""
    known = np.zeros(0x110000, dtype=np.int32)
    for cp in range(0x110000):
        if chr(cp).isalpha():
            known[cp] = cp - 96 if 97 <= cp <= 122 else 27 + (cp * 2_654_435_761 >> 7) % (LETTERS - 27)
    return known


@functools.lru_cache(maxsize=2)
def letter_vectors(dimensions: int) -> np.ndarray:
    return np.random.default_rng(SEED).choice(np.array([-1, 1], dtype=np.int8), size=(LETTERS, dimensions))


def gram_vectors(codes: np.ndarray, dimensions: int) -> np.ndarray:
    """Bound vectors of three-gram codes, as float32 rows."""
    v = letter_vectors(dimensions)
    a, b, c = codes // (LETTERS * LETTERS), codes // LETTERS % LETTERS, codes % LETTERS
    return (np.roll(v, 2, axis=1)[a] * np.roll(v, 1, axis=1)[b] * v[c]).astype(np.float32)


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, three-gram code) of every three-gram with a letter, and which texts have a letter. Case is dropped."""
    lowered = ["" if t is None else t.lower() for t in texts]
    joined = "\n".join(["", *lowered, ""])
    codes = _letter_codes()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])
    keep = np.append((codes[1:] > 0) | (codes[:-1] > 0), True)  # one gap between words, however wide
    owner = np.concatenate(([0], owner))
    codes, owner = codes[keep], owner[keep]
    if len(codes) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(texts), bool)
    code = (codes[:-2] * LETTERS + codes[1:-1]) * LETTERS + codes[2:]
    own = owner[1:-1]
    # a three-gram belongs to the text of its middle letter; with a gap in the middle it would span two words
    inside = codes[1:-1] > 0
    has = np.zeros(len(texts), bool)
    has[own[inside]] = True
    return own[inside], code[inside], has


def _bundle(dimensions: int, most: int = 32_768):
    """(lang, place, value): the sum of a task's three-gram vectors for each language, from counts of the codes met since the last sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def add() -> None:
            for lang, parts in held.items():
                codes, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                counts = np.bincount(at, weights=np.concatenate([p[1] for p in parts]), minlength=len(codes))
                total = sums.setdefault(lang, np.zeros(dimensions))
                for low in range(0, len(codes), 4096):
                    total += counts[low : low + 4096] @ gram_vectors(codes[low : low + 4096], dimensions)
            held.clear()

        for batch in batches:
            langs, texts = np.array(batch.column(0).to_pylist(), dtype=object), batch.column(1)
            for low in range(0, batch.num_rows, 512):
                own, code, _ = grams(texts.slice(low, 512).to_pylist())
                here = langs[low : low + 512]
                for lang in set(here):
                    codes, counts = np.unique(code[(here == lang)[own]], return_counts=True)
                    held.setdefault(lang, []).append((codes, counts))
                    size += len(codes)
                if size > 16 * most:
                    add()
                    size = 0
        add()
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dimensions, pa.string()), pa.array(np.arange(dimensions), pa.int32()), pa.array(total.astype(np.int64))], ["lang", "place", "value"])

    return run


def learn(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", dimensions: int = 1024) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes (a row each) from all rows whose language and text are not null; none from an empty table."""
    ship(docs.sparkSession)
    given = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    got = given.transform(mapped, _bundle(dimensions), "lang string, place int, value long").groupBy("lang", "place").agg(F.sum("value").alias("value")).orderBy("lang", "place").toPandas()
    langs = sorted(set(got["lang"]))
    return langs, got["value"].to_numpy(np.float64).reshape(len(langs), dimensions) if langs else np.zeros((0, dimensions))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _predict(langs: list[str], prototypes: np.ndarray):
    unit = _unit(prototypes) if len(langs) else prototypes
    mean = unit.mean(axis=0) if len(langs) > 1 else np.zeros(prototypes.shape[1])
    own = _unit(unit - mean).astype(np.float32).T
    mean = mean.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.empty(0, dtype=np.int64)  # codes met so far; table holds their vectors, slot their rows
        slot = np.full(CODES, -1, dtype=np.int64)
        table = np.empty((0, own.shape[0]), dtype=np.float32)
        for batch in batches:
            texts, preds, scores = batch.column(1), [], []
            for at in range(0, batch.num_rows, 256):
                part = texts.slice(at, 256).to_pylist()
                mine, code, has = grams(part)
                seen = np.zeros(CODES, dtype=bool)
                seen[code] = True
                fresh = np.flatnonzero(seen & (slot < 0))
                if len(fresh):
                    if len(known) + len(fresh) > 32_768:  # bounded memory: begin anew with the codes of this batch
                        slot[:] = -1
                        known, table, fresh = np.empty(0, dtype=np.int64), table[:0], np.flatnonzero(seen)
                    slot[fresh] = np.arange(len(known), len(known) + len(fresh))
                    known, table = np.concatenate((known, fresh)), np.concatenate((table, gram_vectors(fresh, own.shape[0])))
                here = np.flatnonzero(seen[known])
                column = np.zeros(len(known), dtype=np.int64)
                column[here] = np.arange(len(here))
                counts = np.bincount(mine * len(here) + column[slot[code]], minlength=len(part) * len(here)).reshape(len(part), -1).astype(np.float32)
                bundle = _unit(counts @ table[here]) if len(here) else np.zeros((len(part), own.shape[0]), np.float32)
                cosines = _unit(bundle - mean) @ own if len(langs) else np.zeros((len(part), 1))
                best = cosines.argmax(axis=1)
                for i in range(len(part)):
                    sure = has[i] and len(langs) > 0
                    preds.append(langs[best[i]] if sure else "und")
                    scores.append(float(min(1.0, max(0.0, cosines[i, best[i]]))) if sure else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(preds, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (cosine with the language's prototype, cut to 0..1) of every whole text.

    A null text or one without letters is ``und`` with score 0, as is every text where nothing could be learned. Ties go to the
    first language in order. Repeated rows give repeated rows, an empty table none; other columns are left out.
    """
    ship(docs.sparkSession)
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.transform(mapped, _predict(*model), "doc_id long, lang_pred string, score double")

