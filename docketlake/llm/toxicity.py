"""Toxic passages by maximum-scoring segment search over token log-odds.

Learning: each word and its prefixes of three to six letters count the documents of either label that they occur in. Their
log-odds ratio has a Dirichlet prior (half a document plus the key's own share of ``prior`` documents); a key
scores its log-odds less two standard errors, if that is clearly positive. A token scores as its best key, every other token
costs ``drift``. One scan finds all maximal scoring segments of a text (Ruzzo and Tompa). In texts without toxicity the best
segments follow an extreme-value law: E = K n exp(-lambda S) of them score S or more among n tokens, with lambda the root of
sum p exp(lambda s) = 1 over the token scores of non-toxic texts. A document's evidence is the sum of -ln E over its
significant passages, and a logistic curve fitted on labelled documents that the lexicon has not seen turns it into a score.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketlake.llm.memory import mapped
from docketlake.llm.tokens import Kept, worker_cache
from docketlake.session import ship

EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”„‘’…–—¡¿"
PREFIXES = (3, 4, 5, 6)


@dataclass(frozen=True)
class Settings:
    """max_labelled bounds the learning sample of each label, in rows, and so what is learned from it. least: of a key's score in the lexicon; drift: cost of any other token."""

    max_labelled: int = 20_000
    prior: float = 10.0
    least: float = 1.6
    drift: float = 0.5
    threshold: float = 0.3


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    rate: float  # lambda
    k: float
    weights: tuple[float, float]
    settings: Settings = Settings()
    uid: str = field(default_factory=lambda: uuid.uuid4().hex)


def keys_of(chunk: str) -> tuple[str, ...]:
    """A token's keys: the word, marked, and its prefixes; none for what has no letter."""
    word = chunk.strip(EDGES).lower()
    if not any(c.isalpha() for c in word):
        return ()
    return ("=" + word, *(word[:n] for n in PREFIXES if len(word) >= n))


def segments(scores: np.ndarray, drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of token scores, where a token that is not positive costs drift.

    Ruzzo and Tompa's scan over the positive tokens, with the runs between them as one cost each: linear time.
    """
    held: list[list[float]] = []  # start, end, sum before, sum after
    total, before = 0.0, 0
    for at in np.flatnonzero(scores > 0).tolist():
        total -= drift * (at - before)
        new = [at, at + 1, total, total + float(scores[at])]
        total, before = new[3], at + 1
        while True:
            k = len(held) - 1
            while k >= 0 and held[k][2] >= new[2]:
                k -= 1
            if k < 0 or held[k][3] >= new[3]:
                held.append(new)
                break
            new = [held[k][0], new[1], held[k][2], new[3]]
            del held[k:]
    return [(int(a), int(b), right - left) for a, b, left, right in held]


class Scorer:
    """Token scores of texts under a lexicon."""

    def __init__(self, bound: int = 16 << 20):
        self.lexicon: dict[str, float] = {}
        self.tokens = Kept(self._tokens, bound)

    def _tokens(self, chunks: list[str]) -> list[float]:
        get = self.lexicon.get
        return [max((get(k, 0.0) for k in keys_of(chunk)), default=0.0) for chunk in chunks]

    def scores(self, text: str | None) -> np.ndarray:
        return np.array(self.tokens.many((text or "").split()), dtype=np.float64)


@worker_cache
def _scorer_of(uid: str) -> Scorer:
    """One scorer a worker and model."""
    return Scorer()


def _scorer(uid: str, lexicon: dict[str, float]) -> Scorer:
    scorer = _scorer_of(uid)
    scorer.lexicon = lexicon
    return scorer


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache, counts = Kept(lambda chunks: [keys_of(c) for c in chunks], 24 << 20), (Counter(), Counter())

    def out() -> pa.RecordBatch:
        keys = list(counts[0].keys() | counts[1].keys())
        got = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([counts[1][k] for k in keys], pa.int64()), pa.array([counts[0][k] for k in keys], pa.int64())], ["key", "toxic", "clean"])
        counts[0].clear()
        counts[1].clear()
        return got

    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            chunks = list(set((text.as_py() or "").split()))
            counts[toxic].update({k for keys in cache.many(chunks) for k in keys})
            if len(counts[0]) + len(counts[1]) > 300_000:
                yield out()
    yield out()


def _lexicon(sample: DataFrame, n: tuple[int, int], s: Settings) -> dict[str, float]:
    """Positive keys and their scores; n: documents labelled 0 and 1 in the sample. They are words of at most max_labelled toxic documents."""
    counted = sample.select("text", "toxic").transform(mapped, _count, "key string, toxic long, clean long").groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    share = (F.col("toxic") + F.col("clean")) / (n[0] + n[1])
    a = 0.5 + s.prior * share

    def odds(y: Column, docs: int) -> Column:
        return F.log((y + a) / (docs + 1 + s.prior - y - a))

    score = odds(F.col("toxic"), n[1]) - odds(F.col("clean"), n[0]) - 2 * F.sqrt(1 / (F.col("toxic") + a) + 1 / (F.col("clean") + a))
    best = counted.where("toxic >= 2").withColumn("score", score).where(F.col("score") > s.least)
    return {r["key"]: r["score"] for r in best.select("key", "score").collect()}


def _tally(uid: str, shared, drift: float):
    """Over whole texts: how many tokens have each positive score, rounded to 0.1 (kind token), and numbers of tokens and segments in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, words, found, positive = _scorer(uid, shared.value), 0, 0, Counter()
        for batch in batches:
            for text in batch.column(0):
                scores = scorer.scores(text.as_py())
                words += len(scores)
                found += len(segments(scores, drift))
                positive.update(scores[scores > 0].round(1).tolist())
        rows = [("words", 0.0, words), ("segments", 0.0, found), *(("token", s, n) for s, n in positive.items())]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.int64())], ["kind", "score", "n"])

    return run


def _evidence(uid: str, shared, drift: float, rate: float, k: float):
    """(toxic, evidence) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(uid, shared.value)
        for batch in batches:
            found = []
            for text in batch.column(0):
                scores = scorer.scores(text.as_py())
                found.append(evidence(len(scores), [x[2] for x in segments(scores, drift)], rate, k))
            yield pa.RecordBatch.from_arrays([batch.column(1).cast(pa.int32()), pa.array(found, pa.float64())], ["toxic", "evidence"])

    return run


def _root(positive: Counter, negative: int, drift: float) -> float:
    """The positive root of sum p exp(lambda s) = 1, by bisection; expected scores are negative."""
    total = negative + sum(positive.values())
    if not positive or negative == 0:
        return 1.0

    def excess(rate: float) -> float:
        return (negative * math.exp(-rate * drift) + sum(n * math.exp(min(700.0, rate * s)) for s, n in positive.items())) / total - 1

    low, high = 1e-6, 1e-3
    while excess(high) < 0 and high < 100:
        high *= 2
    if excess(low) > 0:
        return low
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return low


def evidence(n: int, found: list[float], rate: float, k: float) -> float:
    """ln(1 + sum of -ln E) over the passages with E < 1, for a text of n tokens."""
    if not found:
        return 0.0
    level = math.log(max(k * n, 1e-300))
    return math.log1p(sum(max(0.0, rate * s - level) for s in found))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton steps, with Platt's softened targets and a weak ridge."""
    pos, neg = y.sum(), (1 - y).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    w, a = np.zeros(2), np.column_stack((np.ones(len(x)), x))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2), a.T @ (p - target) + 1e-3 * w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(max(w[1], 0.0))


def learn(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", settings: Settings | None = None) -> Model:
    """A model from the labelled documents. At most about max_labelled documents of each label are read, chosen by a hash of the id;
    a fifth of them, chosen likewise, calibrates and is not in the lexicon. Null labels and texts teach nothing."""
    s = settings or Settings()
    spark = docs.sparkSession
    ship(spark)
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1_000_000)) / 1e6
    chosen = known.where(place < F.when(F.col("toxic") == 1, s.max_labelled / max(sizes.get(1, 0), 1)).otherwise(s.max_labelled / max(sizes.get(0, 0), 1)))
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    # the sample has a bounded number of ids, so its side may be broadcast
    sample = given.join(F.broadcast(chosen), "doc_id").withColumn("fit", F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(5)) > 0)
    counts = {r["toxic"]: r["n"] for r in sample.where("fit").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    lexicon = _lexicon(sample.where("fit"), (counts.get(0, 0), counts.get(1, 0)), s) if counts.get(1) and counts.get(0) else {}
    model = Model(lexicon, 1.0, 1.0, (0.0, 0.0), s)
    shared = spark.sparkContext.broadcast(lexicon)
    held = sample.where("not fit").select("text", "toxic")
    told = held.where("toxic = 0").transform(mapped, _tally(model.uid, shared, s.drift), "kind string, score double, n long").groupBy("kind", "score").agg(F.sum("n").alias("n")).collect()
    positive = Counter({r["score"]: r["n"] for r in told if r["kind"] == "token"}) or Counter({round(max(lexicon.values(), default=1.0), 1): 1})
    sums = {r["kind"]: r["n"] for r in told if r["kind"] != "token"}
    tokens = max(1, sums.get("words", 0))
    rate = _root(positive, max(1, tokens - sum(positive.values())), s.drift)
    k = (0.5 + sums.get("segments", 0)) / (tokens * math.exp(-rate * s.least))
    seen = held.transform(mapped, _evidence(model.uid, shared, s.drift, rate, k), "toxic int, evidence double").orderBy("toxic", "evidence").collect()  # two numbers a calibrating document
    x = np.array([r["evidence"] for r in seen])
    y = np.array([float(r["toxic"]) for r in seen])
    weights = _logistic(x, y) if len(seen) else (-2.0, 1.0)
    return Model(lexicon, rate, k, weights, s, model.uid)


PASSAGES = "array<struct<start:int,end:int,score:double,e_value:double>>"


def _score(model: Model, shared):
    uid, rate, k, (bias, slope), s = model.uid, model.rate, model.k, model.weights, model.settings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(uid, shared.value)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64())]))
        for batch in batches:
            out, passages = [], []
            for text in batch.column(1):
                scores = scorer.scores(text.as_py())
                found = segments(scores, s.drift)
                out.append(1 / (1 + math.exp(-(bias + slope * evidence(len(scores), [x[2] for x in found], rate, k)))))
                told = [(a, b, v, k * len(scores) * math.exp(-rate * v)) for a, b, v in found]
                passages.append([{"start": a, "end": b, "score": v, "e_value": e} for a, b, v, e in told if e < 1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64()), pa.array([int(x >= s.threshold) for x in out], pa.int32()), pa.array(passages, kind)], ["doc_id", "score", "predicted", "passages"])

    return run


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from the threshold on), passages (words from start to before end, score, E value).

    A null or empty text has no passages and the score of a document without evidence. Repeated rows give repeated rows, an empty
    table none; other columns are left out, whatever their names. The lexicon that every task gets is bounded by the learning sample.
    """
    spark = docs.sparkSession
    ship(spark)
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.transform(mapped, _score(model, spark.sparkContext.broadcast(model.lexicon)), f"doc_id long, score double, predicted int, passages {PASSAGES}")


def drop_toxic(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` below the threshold, with all their columns, whatever their names; rows travel whole, so there is no join.

    A null or empty text has no evidence and stays, unless the model holds every text for toxic. Repeated rows are judged alike, so all or
    none stay. An empty table stays empty. A score equal to the threshold goes."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model.lexicon)
    uid, rate, k, (bias, slope), s, at = model.uid, model.rate, model.k, model.weights, model.settings, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(uid, shared.value)
        for batch in batches:
            keep = []
            for text in batch.column(at):
                scores = scorer.scores(text.as_py())
                found = evidence(len(scores), [x[2] for x in segments(scores, s.drift)], rate, k)
                keep.append(1 / (1 + math.exp(-(bias + slope * found))) < s.threshold)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.transform(mapped, run, docs.schema)
