"""Exact token ids of whole texts through the tokenizers library, block by block, with caches of bounded bytes in each worker.

The tokenizer file is a parameter. Where its pre-tokenizer drops white space, a text's ids are those of its white-space separated
chunks one after another: a block's distinct chunks are found by Arrow, encoded once, and taken by index. Any other
file is encoded text by text.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from docketlake.llm.memory import free_memory, worker_cache

#: The pre-tokenizer pattern for which chunks are independent: no alternative matches white space.
_CHUNKED = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: A Latin word, then punctuation without digits, letters, apostrophes and "<": both parts are tokens of the pattern above.
_PLAIN = r"^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]*)(?P<marks>[!-&(-/:;=?@\[-`{-~]*)$"
#: Bytes of text that are encoded at once.
BLOCK = 2 << 20


class Kept(dict):
    """What ``make`` gives for a list of keys, kept in two generations of ``bound`` bytes: constant memory, and what recurs stays."""

    ENTRY = 180  # bytes of an entry on average: key, value, object heads, hash table

    def __init__(self, make: Callable[[list], list], bound: int = 16 << 20):
        super().__init__()
        self.make, self.most, self.old = make, max(2, bound // self.ENTRY), {}

    def many(self, keys: list) -> list:
        got = list(map(self.get, keys))
        gaps = [i for i, v in enumerate(got) if v is None]
        if not gaps:
            return got
        asked = [keys[i] for i in gaps]
        found = list(map(self.old.get, asked))
        unknown = [k for k, v in zip(asked, found, strict=True) if v is None]
        made = iter(self.make(unknown))
        found = [next(made) if v is None else v for v in found]
        for i, v in zip(gaps, found, strict=True):
            got[i] = v
        for at in range(0, len(asked), self.most):
            part = asked[at : at + self.most]
            if len(self) + len(part) > self.most:
                self.old = self.copy()
                self.clear()
            self.update(zip(part, found[at : at + self.most], strict=True))
        return got

    def forget(self) -> None:
        self.clear()
        self.old = {}


def blocks(texts: pa.Array, *more: pa.Array, most: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Runs (from, to) of rows of about ``most`` bytes of text, in all columns given; a longer text is a run of its own. What a run's work has freed goes
    back to the system before the next."""
    sizes = sum(pc.fill_null(pc.binary_length(x), 0).to_numpy(zero_copy_only=False).astype(np.int64) for x in (texts, *more))
    at, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > most:
            yield at, i
            free_memory()
            at, held = i, 0
        held += n
    if at < len(texts):
        yield at, len(texts)


def byte_letters() -> dict[int, str]:
    """The printable letter for each byte in byte-level vocabularies: bytes that print stand for themselves."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Token ids of texts, of ``dtype``: two bytes an id where the vocabulary allows."""

    def __init__(self, path: str, bound: int = 16 << 20):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.chunked = _chunks_are_independent(spec)
        self.width = np.dtype(self.dtype).itemsize
        self.kind = "H" if self.dtype == "<u2" else "I"  # executors are little-endian
        #: Which ids end a word.
        self.ends = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), dtype=bool)
        if self.chunked:
            suffix = spec["model"]["end_of_word_suffix"]
            self.ends[[i for t, i in spec["model"]["vocab"].items() if t.endswith(suffix)]] = True
        self.words = Kept(self._words, bound)

    def _ids(self, text: str) -> bytes:
        return array(self.kind, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of lower-case words and runs of punctuation, each a single token of the pre-tokenizer: one call for all of them."""
        if not words:
            return []
        if "" in words:
            got = dict(zip(filled := [w for w in words if w], self._words(filled), strict=True)) | {"": b""}
            return [got[w] for w in words]
        raw = array(self.kind, self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids).tobytes()
        ends = (np.flatnonzero(self.ends[np.frombuffer(raw, dtype=self.dtype)]) + 1) * self.width
        if len(ends) != len(words):
            return [self._ids(w) for w in words]
        return [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's begin (one more at the end). A null text has none."""
        texts = pc.fill_null(texts, "")
        if not self.chunked:
            got = [self._ids(t) if t else b"" for t in texts.to_pylist()]
            return np.frombuffer(b"".join(got), dtype=self.dtype), np.append(0, np.cumsum([len(g) // self.width for g in got], dtype=np.int64))
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        of_text = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        # a distinct chunk is a word and marks, or an odd one; each is an entry of a store of ids, and entry 0 is empty
        chunks, at = coded.dictionary, coded.indices.to_numpy()
        plain = pc.extract_regex(chunks, _PLAIN)
        words, marks = (pc.fill_null(x, "").dictionary_encode() for x in (pc.utf8_lower(plain.field("word")), plain.field("marks")))
        odd = np.flatnonzero(plain.is_null().to_numpy(zero_copy_only=False))
        values = [b"", *self.words.many(words.dictionary.to_pylist()), *self.words.many(marks.dictionary.to_pylist()), *map(self._ids, chunks.take(pa.array(odd)).to_pylist())]
        pair = np.stack([words.indices.to_numpy() + 1, marks.indices.to_numpy() + 1 + len(words.dictionary)], axis=1).astype(np.int32)
        pair[odd, 0], pair[odd, 1] = 1 + len(words.dictionary) + len(marks.dictionary) + np.arange(len(odd)), 0
        sizes = np.fromiter(map(len, values), np.int32, len(values)) // self.width
        store = np.frombuffer(b"".join(values), dtype=self.dtype)
        del values, words, marks, plain, chunks
        # places in 32 bits: a column of texts has under 2^31 bytes, so no more ids
        entry = pair[at].reshape(-1)
        del pair, at, coded, lists
        n = sizes[entry]
        ends = np.zeros(len(n) + 1, dtype=np.int32)
        np.cumsum(n, out=ends[1:])
        first = (np.cumsum(sizes, dtype=np.int32) - sizes)[entry]
        del entry
        first -= ends[:-1]
        place = np.repeat(first, n)
        del first, n
        place += np.arange(len(place), dtype=np.int32)
        return store[place], ends[2 * of_text].astype(np.int64)

    def ids_of(self, text: str | None) -> np.ndarray:
        return self.batch(pa.array([text], pa.string()))[0]


def _chunks_are_independent(spec: dict) -> bool:
    """Whether the file is a lower-casing BPE with word ends whose pre-tokenizer drops white space, so that chunks do not touch each other."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
    first, second = steps[0], steps[-1]
    normal = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers") or []]
    model = spec["model"]
    return (
        first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") is True and first.get("pattern", {}).get("Regex") == _CHUNKED
        and len(steps) == 2 and second.get("type") == "ByteLevel" and not second.get("add_prefix_space") and not second.get("use_regex")
        and normal == ["NFC", "Replace", "Lowercase"]
        and model["type"] == "BPE" and bool(model.get("end_of_word_suffix")) and not model.get("dropout") and not model.get("continuing_subword_prefix")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or re.search(r"\s", t["content"]) for t in spec["added_tokens"])
    )


@worker_cache
def encoder(path: str) -> Encoder:
    """One encoder a worker and file."""
    return Encoder(path)


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
