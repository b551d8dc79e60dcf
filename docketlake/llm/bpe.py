"""Byte-pair encoding as a bounded-lookahead streaming transducer, and decoding as an incremental byte-to-text machine.

The encoding of a prefix ends in exactly one token, so one state a byte is enough: the last token of the prefix that ends
there. It is the token that ends there and may follow the last token of what stands before it; two tokens may stand side by
side when no merge across their border would have come before the merges that made them.

The merge list bounds how far ahead a token can still change. Compare the merging of a prefix with that of the prefix and more: left of
some border both agree. That border only moves left when, in one of them, a merge (a, b) spans it, by the length of a. After
that the token behind it begins with a, so the next such merge, of a later rank, has a right part whose left edge holds a. Bytes ahead
that matter to a border are thus a sum over a chain of merges of rising rank; ``Transducer.ahead`` has the longest such chain for
each token, over all merges that take a right edge of it, and ``lookahead`` is the largest. A token is emitted once more than
its bytes have been read behind it. Memory is the bytes since the last one emitted.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketlake.llm.memory import mapped
from docketlake.llm.tokens import Kept, blocks, byte_letters, default_path, worker_cache
from docketlake.session import ship

BLOCK = 4096
#: States are kept for prefixes of so many bytes.
SHORT = 6

#: Fixed value: how byte-level files split text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Transducer:
    """The merge list of a byte-level BPE file as a left-to-right machine over bytes."""

    def __init__(self, vocab: dict[str, int], merges: list, bound: int = 100_000):
        letters = {c: b for b, c in byte_letters().items()}
        raw = {token: bytes(letters[c] for c in token) for token in vocab}
        self.bytes_of = {i: raw[token] for token, i in vocab.items()}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        self.longest = max(map(len, self.id_of))
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        #: (left, right) -> rank, and a token -> (rank, left, right) of the merge that makes it.
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            left, right = vocab[a], vocab[b]
            self.rank[left, right] = rank
            self.made.setdefault(vocab[a + b], (rank, left, right))
        self.ahead = self._ahead()
        self.lookahead = 1 + max(self.ahead.values(), default=-1)
        self.bound, self._beside, self._whole = bound, {}, {}
        #: Tokens that merging their own bytes gives; no other can come out.
        self.id_of = {b: i for b, i in self.id_of.items() if self._alone(i)}
        #: For the two bytes that a token ends with, the lengths of such tokens, the longest first.
        self.sizes: dict[bytes, list[int]] = {}
        for b in sorted(self.id_of, key=len, reverse=True):
            known = self.sizes.setdefault(b[-2:], [])
            if not known or known[-1] != len(b):
                known.append(len(b))
        #: States after short prefixes of splits, as the machine met them; bytes that went through the machine.
        self._states: dict[bytes, tuple[int, int]] = {}
        self.streamed = 0

    def _edge(self, token: int, side: int) -> Iterator[int]:
        """The token, its left (1) or right (2) part, that part's, and so on."""
        while True:
            yield token
            if token not in self.made:
                return
            token = self.made[token][side]

    def _ahead(self) -> dict[int, int]:
        """For each token, the bytes behind it by which its end can still go: more than these, and it is final; -1 if it always is."""
        chain: dict[int, int] = {}  # for a left part, bytes of the longest chain that ends with a merge of it
        beyond: dict[int, int] = {}  # the same without its own bytes
        for (a, b), _ in sorted(self.rank.items(), key=lambda x: x[1]):
            before = max((chain.get(x, 0) for x in self._edge(b, 1)), default=0)
            beyond[a] = max(beyond.get(a, -1), before)
            chain[a] = max(chain.get(a, 0), before + len(self.bytes_of[a]))
        return {t: max(beyond.get(x, -1) for x in self._edge(t, 2)) for t in self.bytes_of}

    def beside(self, a: int, b: int) -> bool:
        """Whether b may follow a: undo the merges at the border, latest first; no earlier merge may reach across it."""
        got = self._beside.get((a, b))
        if got is None:
            if len(self._beside) >= self.bound:
                self._beside.clear()
            got = self._beside[a, b] = self._legal(a, b)
        return got

    def _legal(self, a: int, b: int) -> bool:
        none = len(self.rank)
        limit = none
        while True:
            if self.rank.get((a, b), none) < limit:
                return False
            by_a, by_b = self.made.get(a, (-1, 0, 0)), self.made.get(b, (-1, 0, 0))
            if by_a[0] < 0 and by_b[0] < 0:
                return True
            if by_a[0] > by_b[0]:
                # a's last merge stands left of the border and so wins over a merge of its own rank across it
                limit, a = by_a[0], by_a[2]
            else:
                limit, b = by_b[0] + 1, by_b[1]

    def stream(self, blocks: Iterator[bytes]) -> Iterator[int]:
        """Ids of one split's bytes, given in blocks; each id comes as soon as the bytes read behind it say that it is final."""
        get, sides, known, sizes, ahead = self.id_of.get, self._beside, self._states, self.sizes, self.ahead
        held, tokens, starts = b"", [-1], [0]  # bytes since the last cut; for each end: the last token, its start
        low, due, whole = 0, 0, True  # the last final border; when to look for one again; whether held has the split's first byte
        for block in blocks:
            self.streamed += len(block)
            at, held = len(held), held + block
            for end in range(at + 1, len(held) + 1):
                short = whole and end <= SHORT
                got = known.get(held[:end]) if short else None  # a state depends on the prefix alone
                if got is None:
                    got = -2, 0  # no token ends here
                    for size in (*sizes.get(held[end - 2 : end], ()), 1) if end > 1 else (1,):
                        start = end - size
                        if start < low:
                            continue
                        token = get(held[start:end])
                        if token is None:
                            continue
                        left = tokens[start]
                        if left == -2:
                            continue
                        if left >= 0:
                            legal = sides.get((left, token))
                            if not (self.beside(left, token) if legal is None else legal):
                                continue
                        got = token, start
                        break
                    if short:
                        if len(known) >= self.bound:
                            known.clear()
                        known[held[:end]] = got
                tokens.append(got[0])
                starts.append(got[1])
                if end >= due and got[0] >= 0:
                    path = []  # of tokens that are not final, the last first
                    now = end
                    while now > low:
                        path.append((now, tokens[now]))
                        now = starts[now]
                    final = next((k for k, (e, t) in enumerate(path) if end - e > ahead[t]), len(path))
                    if final < len(path):
                        yield from [t for _, t in reversed(path[final:])]
                        low = path[final][0]
                    due = min((e + ahead[t] + 1 for e, t in path[:final]), default=end + 1)
            if low > BLOCK:
                held, tokens, starts, due, low, whole = held[low:], tokens[low:], [x - low for x in starts[low:]], due - low, 0, False
        ids, end = [], len(held)
        while end > low:
            ids.append(tokens[end])
            end = starts[end]
        yield from reversed(ids)

    def ids(self, word: bytes) -> list[int]:
        """Ids of one split."""
        return list(self.stream(word[at : at + BLOCK] for at in range(0, len(word), BLOCK)))

    def _alone(self, token: int) -> bool:
        """Whether merging a token's own bytes gives that token: both halves do, and they may stand side by side up to its merge."""
        got = self._whole.get(token)
        if got is None:
            made = self.made.get(token)
            got = len(self.bytes_of[token]) == 1 if made is None else self._alone(made[1]) and self._alone(made[2]) and self._joins(*made)
            self._whole[token] = got
        return got

    def _joins(self, rank: int, a: int, b: int) -> bool:
        """Whether a and b stand side by side when nothing but their own merge reaches across the border."""
        limit, none = len(self.rank), len(self.rank)
        first = True
        while True:
            if not first and self.rank.get((a, b), none) < limit:
                return False
            first = False
            by_a, by_b = self.made.get(a, (-1, 0, 0)), self.made.get(b, (-1, 0, 0))
            if by_a[0] < 0 and by_b[0] < 0:
                return True
            if by_a[0] > by_b[0]:
                limit, a = by_a[0], by_a[2]
            else:
                limit, b = by_b[0] + 1, by_b[1]


class Decoder:
    """Ids to text, id by id: bytes that do not yet end a code point wait; what can never be one becomes U+FFFD."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of, self.machine = bytes_of, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        return self.machine.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def end(self) -> str:
        return self.machine.decode(b"", True)


#: What stands between two spaces most often: a Latin word, marks, and the same after one line end.
_PIECE = r"^(?P<a>[A-Za-zÀ-ÖØ-öø-ÿ]*)(?P<b>[!-&(-/:;=?@\[-`{-~]*)(?P<c>\n?)(?P<d>[A-Za-zÀ-ÖØ-öø-ÿ]*)(?P<e>[!-&(-/:;=?@\[-`{-~]*)$"


class Codec:
    """Encodes and decodes whole texts as the tokenizers library does with a byte-level BPE file.

    A space before a character that is no white space always begins a new split, so text falls into pieces there. A block's
    distinct splits go through the transducer; those that a bounded cache of earlier results holds do not again.
    """

    def __init__(self, path: str, bound: int = 40 << 20):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, before = spec["model"], spec["pre_tokenizer"]
        plain = model["type"] == "BPE" and not spec["normalizer"] and before["type"] == "ByteLevel" and not before["add_prefix_space"] and before["use_regex"]
        if not plain or model.get("ignore_merges") or any(t["lstrip"] or t["rstrip"] or t["single_word"] or regex.search(r"\s", t["content"]) for t in spec["added_tokens"]):
            raise ValueError("a byte-level BPE file without normalizer, prefix space and special tokens that take white space is needed")
        self.machine = Transducer(model["vocab"], model["merges"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = self.machine.bytes_of | {i: s.encode() for s, i in self.special.items()}
        size = max(self.bytes_of) + 1
        self.kind = "H" if size <= 1 << 16 else "I"  # executors are little-endian
        self.names = pa.array([f",{i}".encode() for i in range(size)], pa.binary())
        self.shown = pa.array([self.bytes_of.get(i, b"") for i in range(size)], pa.binary())
        self.split = regex.compile(SPLIT).findall
        self.specials = "|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))
        self.at_special = re.compile(f"({self.specials})") if self.special else None
        self.border = regex.compile(r" (?=\S)").search
        self.words = Kept(self._words, bound)

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of splits, packed."""
        kind, ids = self.kind, self.machine.ids
        return [array(kind, ids(word.encode())).tobytes() for word in words]

    def splits(self, text: str) -> list[str]:
        """Splits of a text, special tokens among them."""
        if not self.at_special or not self.at_special.search(text):
            return self.split(text)
        return [w for k, part in enumerate(self.at_special.split(text)) for w in ([part] if k % 2 else self.split(part))]

    def segments(self, text: str, most: int = 1 << 20) -> Iterator[str]:
        """A long text in parts whose splits are those of the whole."""
        at = 0
        while len(text) - at > most and (m := self.border(text, at + most)):
            yield text[at : m.start()]
            at = m.start()
        yield text[at:] if at else text

    def of(self, splits: list[str]) -> list[bytes]:
        special = self.special
        if any(w in special for w in splits):
            got = dict(zip(plain := [w for w in splits if w not in special], self.words.many(plain), strict=True))
            return [got[w] if w in got else array(self.kind, [special[w]]).tobytes() for w in splits]
        return self.words.many(splits)

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, which have no nulls, one after another, and where each text's begin (one more at the end)."""
        odd = pc.match_substring_regex(texts, r" (\s|$)|[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x1c-\x1f]" + ("|" + self.specials if self.special else ""))
        lists = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        coded = lists.flatten().dictionary_encode()
        pieces, at = coded.dictionary, coded.indices.to_numpy()
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        told = pc.extract_regex(pieces, _PIECE)
        a, b, c, d, e = (pc.fill_null(told.field(k), "") for k in "abcde")
        bare = pc.equal(a, "")
        parts = [pc.if_else(bare, "", pc.binary_join_element_wise(" ", a, "")), pc.if_else(pc.and_(bare, pc.not_equal(b, "")), pc.binary_join_element_wise(" ", b, ""), b), c, d, e]
        whole = pa.concat_arrays(parts).dictionary_encode()
        # entries of a store of ids: the distinct splits of pieces; then of each odd piece, and of each text's first piece, which has no space before it, or of an odd text
        strange = np.flatnonzero(told.is_null().to_numpy(zero_copy_only=False))
        own = [self.split(" " + p) for p in pieces.take(pa.array(strange)).to_pylist()] + [self.splits(t) for t in pc.if_else(odd, texts, pieces.take(pa.array(at[bounds[:-1]]))).to_pylist()]
        made = iter(self.of([w for splits in own for w in splits]))
        values = [*self.words.many(whole.dictionary.to_pylist()), *(b"".join([next(made) for _ in splits]) for splits in own)]
        entries = np.zeros((len(pieces) + len(texts), len(parts)), dtype=np.int32)
        entries[: len(pieces)] = whole.indices.to_numpy().reshape(len(parts), -1).T
        empty = len(values)
        values.append(b"")
        entries[strange], entries[len(pieces) :] = empty, empty
        entries[strange, 0] = len(whole.dictionary) + np.arange(len(strange))
        entries[len(pieces) :, 0] = len(whole.dictionary) + len(strange) + np.arange(len(texts))
        at = at.copy()
        at[bounds[:-1]] = len(pieces) + np.arange(len(texts))
        width = array(self.kind).itemsize
        sizes = np.fromiter(map(len, values), np.int32, len(values)) // width
        store = np.frombuffer(b"".join(values), dtype=f"<u{width}")
        entry = entries[at].reshape(-1)
        n = sizes[entry]
        ends = np.append(0, np.cumsum(n, dtype=np.int64))
        first = (np.cumsum(sizes) - sizes)[entry] - ends[:-1]
        return store[np.repeat(first, n) + np.arange(ends[-1])], ends[len(parts) * bounds]

    def ids(self, text: str | None) -> list[int]:
        return self.batch(pa.array([text or ""]))[0].tolist()

    def decode(self, ids: list[int]) -> str:
        machine = Decoder(self.bytes_of)
        return machine.feed(ids) + machine.end()


def _joined(values: pa.Array, bounds: np.ndarray) -> list[memoryview]:
    """The bytes of each run of values, which have just been taken."""
    _, offsets, data = values.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[bounds].tolist() if len(values) else [0] * len(bounds)
    view = memoryview(data) if data is not None else memoryview(b"")
    return [view[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


@worker_cache
def codec(path: str) -> Codec:
    """One codec a worker and file."""
    return Codec(path)


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(path)
        for batch in batches:
            texts, rows = pc.fill_null(batch.column(1), ""), batch.num_rows
            n, hashes, machines = np.zeros(rows, dtype=np.int64), [None] * rows, {}
            told: list[tuple[str, str]] = []
            for low, high in blocks(texts):
                parts = [(i, p) for i in range(low, high) for p in known.segments(texts[i].as_py())]
                for a, b in blocks(pa.array([p for _, p in parts], pa.string())):
                    ids, bounds = known.batch(pa.array([p for _, p in parts[a:b]], pa.string()))
                    joined = [_joined(x.take(pa.array(ids)), bounds) for x in (known.names, known.shown)]
                    for (i, _), names, shown, count in zip(parts[a:b], *joined, np.diff(bounds).tolist(), strict=True):
                        if hashes[i] is None:
                            hashes[i], machines[i] = (hashlib.sha256(), hashlib.sha256()), codecs.getincrementaldecoder("utf-8")("replace")
                        hashes[i][0].update(names if n[i] else names[1:])
                        hashes[i][1].update(machines[i].decode(shown).encode())
                        n[i] += count
                for i in range(low, high):
                    hashes[i][1].update(machines.pop(i).decode(b"", True).encode())
                    told.append((hashes[i][0].hexdigest(), hashes[i][1].hexdigest()))
                    hashes[i] = None
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array([x[0] for x in told], pa.string()), pa.array([x[1] for x in told], pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def round_trip_digests(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 (lowercase hex) of the decimal ids joined by commas and of the text decoded from them.

    A null text is empty: no ids, and the digests of the empty string. Special tokens written out in a text are
    special tokens, as in the library. Repeated rows give repeated rows, an empty table none; other columns are left out.
    """
    ship(docs.sparkSession)
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.transform(mapped, _digests(tokenizer or default_path("byte_bpe_50k.json")), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, *, text_col: str = "text", ids_col: str = "ids", tokenizer: str | None = None) -> DataFrame:
    """``docs`` with the ids of each text as an array column; a null or empty text has none. Repeated rows stay, an empty table stays
    empty, and ids_col replaces a column of that name."""
    ship(docs.sparkSession)
    path = tokenizer or default_path("byte_bpe_50k.json")

    @F.pandas_udf("array<int>")
    def ids(texts):
        known = codec(path)
        return texts.map(lambda t: known.ids(t), na_action=None)

    return docs.withColumn(ids_col, ids(F.col(text_col).cast("string")))


def decode(rows: DataFrame, *, ids_col: str = "ids", text_col: str = "decoded", tokenizer: str | None = None) -> DataFrame:
    """``rows`` with the text of each array of ids; a null array stays null, an empty one is the empty text. Repeated rows stay, an
    empty table stays empty, and text_col replaces a column of that name. An unknown id is an error."""
    ship(rows.sparkSession)
    path = tokenizer or default_path("byte_bpe_50k.json")

    @F.pandas_udf("string")
    def text(arrays):
        known = codec(path)
        return arrays.map(lambda x: None if x is None else known.decode([int(i) for i in x]))

    return rows.withColumn(text_col, text(F.col(ids_col)))
