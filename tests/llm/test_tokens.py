"""Packing, record files, and the byte-level codec, against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from docketlake.llm import bpe, packing, records
from docketlake.llm.tokens import Encoder, default_path
from docketlake.session import scratch

WORD, BYTE = default_path("word_bpe_49k.json"), default_path("byte_bpe_50k.json")


def plain(path):
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


def random_texts(n):
    rnd = random.Random(3)
    letters = " \n\t aAbcdeéÜŒßΣσü 　'’st|<|endoftext|>漢字😀01%--=́İ"
    return ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 50))) for _ in range(n)] + ["a" * 700, "ab" * 400, "<|endoftext|>" * 3, "a  b", "a \n b ", "  "]


@pytest.mark.parametrize("path", [WORD])
def test_chunked_ids_are_the_librarys(path):
    want, got = plain(path), Encoder(path, bound=20)
    for x in random_texts(400):
        assert got.ids_of(x).tolist() == want(x), x


def test_codec_is_the_librarys():
    want, got = plain(BYTE), bpe.Codec(BYTE, bound=50)
    decode = Tokenizer.from_file(BYTE).decode
    for x in random_texts(400):
        ids = want(x)
        assert got.ids(x) == ids, x
        assert got.decode(ids) == decode(ids, skip_special_tokens=False)
    rnd = random.Random(5)
    for _ in range(50):
        ids = [rnd.randrange(50_257) for _ in range(20)]
        assert got.decode(ids) == decode(ids, skip_special_tokens=False)


def test_stream_is_stable_and_keeps_little():
    machine = bpe.codec(BYTE).machine
    rnd = random.Random(1)
    word = "".join(rnd.choice("abcdefst") for _ in range(4000))
    assert list(machine.stream(iter([word[:7].encode(), word[7:].encode()]))) == plain(BYTE)(word)
    assert machine.lookahead < 1000


def test_every_unknown_split_goes_through_the_machine():
    codec = bpe.Codec(BYTE)
    codec.ids("some words, some WORDS again.\nAnd ünder  more")
    seen = {"some", " words", ",", " some", " WORDS", " again", ".", "\n", "And", " ünder", " ", " more"}
    assert codec.machine.streamed == sum(len(w.encode()) for w in seen)


@pytest.mark.parametrize("seed", range(4))
def test_lookahead_is_sufficient_for_any_merge_list(seed):
    """Random merge lists over three letters: what comes before the whole is read is a prefix of what merging in rank order gives."""
    rnd = random.Random(seed)
    tokens, merges = ["a", "b", "c"], []
    while len(merges) < 14:
        pair = (rnd.choice(tokens), rnd.choice(tokens))
        if pair[0] + pair[1] not in tokens:
            merges.append(pair)
            tokens.append(pair[0] + pair[1])
    machine = bpe.Transducer({t: i for i, t in enumerate(tokens)}, [" ".join(m) for m in merges])

    def merged(word):
        parts = list(word)
        for left, right in merges:
            now, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == (left, right):
                    now.append(left + right)
                    i += 2
                else:
                    now.append(parts[i])
                    i += 1
            parts = now
        return parts

    early = 0
    for _ in range(150):
        word = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 120)))
        read, out = [0], []

        def letters(word=word, read=read):
            for c in word:
                read[0] += 1
                yield c.encode()

        for i in machine.stream(letters()):
            out.append(tokens[i])
            early += read[0] < len(word)
            assert sum(map(len, out)) <= read[0]
        assert out == merged(word), (word, merges)
    assert early > 100


def test_round_trip_digests(odd_docs, no_docs):
    want = plain(BYTE)
    texts = sorted((r["doc_id"] is None, r["doc_id"], r["text"] or "") for r in odd_docs.collect())
    got = sorted(((r["doc_id"] is None, r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.round_trip_digests(odd_docs).collect()))
    assert len(got) == len(texts)
    for (_, i, t), (_, j, n, a, b) in zip(texts, got, strict=True):
        assert (i, len(want(t)), hashlib.sha256(",".join(map(str, want(t))).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) == (j, n, a, b)
    assert bpe.round_trip_digests(no_docs).collect() == []


def test_encode_and_decode_columns(odd_docs):
    back = bpe.decode(bpe.encode(odd_docs.select("doc_id", "text"))).collect()
    assert all(r["decoded"] == (r["text"] or "") for r in back)


def check_pieces(rows, ids, capacity):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for key, pieces in by_doc.items():
        pieces = sorted(pieces, key=lambda r: (r["start"], r["sequence_id"]))
        if pieces[0]["doc_tokens"] * 2 == sum(p["length"] for p in pieces):
            continue  # a repeated row
        at = 0
        for p in pieces:
            assert p["start"] == at
            assert zlib.crc32(np.array(ids[key][at : at + p["length"]], dtype="<u4").tobytes()) == p["ids_crc32"]
            at += p["length"]
        assert at == len(ids[key]) == pieces[0]["doc_tokens"]
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity
        padding += capacity - at if at & (at - 1) else 0
    return padding


def test_pack(odd_docs, no_docs):
    ids = {r["doc_id"]: [*plain(WORD)(r["text"]), 2] for r in odd_docs.collect()}
    rows = packing.pack(odd_docs, keep_ids=True).collect()
    assert {r["doc_id"] for r in rows} == set(ids)
    assert check_pieces(rows, ids, 4096) <= 4 * len({r["sequence_id"] for r in rows})
    assert all(len(r["ids"]) == 4 * r["length"] for r in rows)
    assert packing.pack(no_docs).collect() == []


def test_limits_on_segments_and_loss_tokens():
    limits = packing.Limits(tokens=64, segments=3, loss_tokens=40, window=8)
    packer, rnd, out = packing.Packer(limits), random.Random(2), []
    sizes = [rnd.randint(1, 150) for _ in range(200)]
    for k, n in enumerate(sizes):
        out += packer.add(k, n, loss_from=n // 3)
    out += packer.end()
    seen = {k: 0 for k in range(200)}
    for sequence in out:
        assert sum(x[2] for x in sequence) <= 64 and len(sequence) <= 3
        assert sum(packing.Packer.loss(*x[1:]) for x in sequence) <= 40
        for k, _, n, _ in sequence:
            seen[k] += n
    assert [seen[k] for k in range(200)] == sizes


def test_dot_product_differs_from_the_largest_that_fits():

    # left: much loss, so of two that fit the shorter one without context has the larger dot product
    packer = packing.Packer(packing.Limits())
    packer.items = [(0, 0, 3000, 2600), (1, 0, 600, 600), (2, 0, 590, 0)]
    first = next(packer.fill())
    assert [x[0] for x in first[:2]] == [0, 2]


@pytest.mark.parametrize("one_line", [False, True])
def test_few_more_sequences_than_the_ids_fill(one_line):
    """Many short documents beside long ones, with and without contexts."""
    rnd, limits = random.Random(5), packing.Limits()
    packer, out = packing.Packer(limits), []
    sizes = [rnd.choice((rnd.randint(1, 60), rnd.randint(100, 1500), int(rnd.lognormvariate(6.5, 1.3)) + 1)) for _ in range(5000)]
    for k, n in enumerate(sizes):
        out += packer.add(k, n, 0 if one_line else rnd.randint(0, min(n, 20)))
    out += packer.end()
    assert len(out) <= 1.01 * sum(sizes) / limits.tokens + 10
    assert any(sum(packing.Packer.loss(*x[1:]) for x in s) == limits.loss_tokens for s in out)


def test_segments_bind_where_all_documents_are_short():
    def sequences(limits):
        packer, out = packing.Packer(limits), []
        for k in range(3000):
            out += packer.add(k, 1 + k % 40)
        return [*out, *packer.end()]

    out = sequences(packing.Limits())
    assert max(map(len, out)) <= 16 and all(n & (n - 1) == 0 or n >= 4072 for n in (sum(x[2] for x in s) for s in out))
    assert len(out) > 5 * len(sequences(packing.Limits(segments=4096)))


def test_all_limits_bind_in_the_registered_query(spark, sf_dir):
    from docketlake.llm.queries import op1_packing

    by_sequence = {}
    for r in op1_packing(spark, sf_dir).collect():
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    totals = [(sum(r["length"] for r in x), len(x), sum(r["loss_tokens"] for r in x)) for x in by_sequence.values()]
    limits = packing.Limits()
    assert all(a <= limits.tokens and b <= limits.segments and c <= limits.loss_tokens for a, b, c in totals)
    assert any(a == limits.tokens for a, _, _ in totals) and any(c == limits.loss_tokens for _, _, c in totals)


def test_contexts_and_texts_of_a_block_are_encoded_together(monkeypatch):
    import pyarrow as pa

    calls, batch = [], Encoder.batch
    monkeypatch.setattr(Encoder, "batch", lambda self, texts: calls.append(len(texts)) or batch(self, texts))
    rows = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(["\nb c", "", None]), pa.array(["a b", None, ""])], ["doc_id", "text", "context"])
    got = [r for b in packing._packed(WORD, 2, packing.Limits(), True)(iter([rows])) for r in b.to_pylist()]
    want = plain(WORD)
    assert calls == [6] and sum(r["loss_tokens"] for r in got) == len(want("b c")) + 3
    assert {r["doc_id"]: b"".join(x["ids"] for x in got if x["doc_id"] == r["doc_id"]) for r in got} == {i: np.array([*want(x), 2], "<u4").tobytes() for i, x in ((1, "a b\nb c"), (2, ""), (3, ""))}


def test_pack_prompts_and_answers(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    asked = turns.where("role = 'user'").select("conv_id", "turn", turns["text"].alias("prompt"))
    answered = turns.where("role <> 'user'").select("conv_id", (turns["turn"] - 1).alias("turn"), "text")
    pairs = asked.join(answered, ["conv_id", "turn"])
    rows = packing.pack(pairs, id_col="conv_id", context_col="prompt").collect()
    want = plain(WORD)
    assert sum(r["loss_tokens"] for r in rows) == sum(len(want(r["text"])) + 1 for r in pairs.collect()) > 0
    assert sum(r["length"] for r in rows) == sum(len(want(r["text"])) + len(want(r["prompt"])) + 1 for r in pairs.collect())


def test_crc32c_of_known_values():
    known = records.crc32c([b"123456789", b"", b"\0" * 32, b"\xff" * 32, bytes(range(32))])
    assert [int(x) for x in known] == [0xE3069283, 0, 0x8A9136AA, 0x62A8AB43, 0x46DD794E]
    assert int(records.crc32c_words([8])[0]) == int(records.crc32c([(8).to_bytes(8, "little")])[0])


def test_records_round_trip_and_damage_is_seen(spark, odd_docs, no_docs):
    folder = scratch(spark, "records-test")
    index = records.write_records(odd_docs.where("doc_id is not null"), folder=folder)
    rows = sorted(records.with_global_start(records.read_records(index, folder), index).collect(), key=lambda r: r["start"])
    docs = sorted((r["doc_id"], r["text"] or "") for r in odd_docs.where("doc_id is not null").collect())
    want, at = plain(WORD), 0
    for r, (i, t) in zip(rows, docs, strict=True):
        ids = np.array([*want(t), 1], dtype="<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    other = index.withColumn("doc_id", index["doc_id"] + 1)
    with pytest.raises(Exception, match="not the one that the index names"):
        records.read_records(other, folder).collect()
    with pytest.raises(ValueError, match="does not hold"):
        records.unframed([records.frames([b"abc"])[0][:-1] + b"\0"])
    assert records.write_records(no_docs).collect() == []
