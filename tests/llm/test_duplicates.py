"""Near-duplicate groups and repeated passages against brute force, and the pipeline."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docketlake.llm import filters, minhash, substring
from docketlake.llm.words import shingles, word_hashes

rnd = random.Random(11)
VOCABULARY = [f"w{k}" for k in range(3000)]


def prose(n):
    return [rnd.choice(VOCABULARY) for _ in range(n)]


def edited(words, times):
    words = list(words)
    for _ in range(times):
        words[rnd.randrange(len(words))] = rnd.choice(VOCABULARY)
    return words


@pytest.fixture(scope="module")
def near(spark):
    base = [prose(120) for _ in range(6)]
    rows = []
    for b in base:
        rows += [" ".join(edited(b, k)) for k in (0, 0, 1, 2, 3, 4, 6, 9)]
    hot = prose(100)
    rows += [" ".join(edited(hot, rnd.randrange(8))) for _ in range(80)]
    rows += [" ".join(prose(60)) for _ in range(20)] + ["", None, "one two", "One  two", "one two three"]
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").cache()


def brute(texts, n, percent):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize("n", [4, 5])
def test_groups_equal_brute_force(near, n):
    texts = {r["doc_id"]: r["text"] for r in near.collect()}
    truth, sizes = brute(texts, n, 80)
    got = minhash.near_duplicates(near, settings=minhash.Settings(words=n)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == truth
    assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_keep_one_keeps_all_columns_and_odd_rows(odd_docs, no_docs):
    kept = minhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert 5 not in ids and {1, 2, 3, 4, 6, None} <= set(ids)
    assert minhash.near_duplicates(no_docs).collect() == []


def test_signature_places_agree_as_often_as_sets_are_alike():
    a, b = np.arange(1, 401, dtype=np.uint64), np.arange(101, 501, dtype=np.uint64)
    sig = [minhash.super_minhash([np.unique(x * np.uint64(7919 + k)) for x in (a, b)], 96) for k in range(30)]
    share = np.mean([(s[0] == s[1]).mean() for s in sig])
    assert share == pytest.approx(300 / 500, abs=0.03)
    assert np.array_equal(minhash.super_minhash([a], 96), minhash.super_minhash([a[::-1].copy()], 96))
    assert (minhash.super_minhash([np.array([5], dtype=np.uint64)], 96) < np.uint64(96) << np.uint64(48)).all()


def test_words_and_shingles():
    hashes, bounds, first, last = word_hashes(["A b\tc ", "", None, "é a", " a B "])
    assert bounds.tolist() == [0, 3, 3, 3, 5, 7]
    assert hashes[0] == hashes[4] == hashes[5] and hashes[1] == hashes[6]
    assert (first.tolist(), last.tolist()) == ([0, 2, 4, 0, 3, 1, 3], [1, 3, 5, 2, 4, 2, 4])
    assert len(shingles(hashes[:3], 2)) == 2 and len(shingles(hashes[:1], 2)) == 1 and not len(shingles(hashes[:0], 2))


def test_filter_never_loses(spark):
    ids = spark.range(0, 5000, 3)
    packed = filters.build(ids, 16)
    assert filters.holds(packed, np.arange(0, 5000, 3).astype(np.uint64)).all()
    assert filters.holds(packed, np.arange(1, 5000, 3).astype(np.uint64)).mean() < 0.05


@pytest.fixture(scope="module")
def repeats(spark):
    passage, other = prose(60), prose(90)
    docs = {i: prose(150) for i in range(30)}
    for i in (3, 7, 12, 20):
        at = rnd.randrange(100)
        docs[i][at:at] = passage
    for i in (5, 9):
        docs[i] = edited(other, 6) + docs[i] if i == 9 else other + docs[i]
    docs[25] = docs[4][:]
    rows = [(i, " ".join(w)) for i, w in docs.items()] + [(40, None), (41, ""), (42, "short text"), (None, " ".join(passage))]
    return spark.createDataFrame(rows, "doc_id long, text string").cache(), passage, other


def test_repeated_passages_are_found_and_nothing_else(repeats):
    docs, passage, other = repeats
    texts = {r["doc_id"]: (r["text"] or "").split() for r in docs.collect()}
    got = substring.repeated_passages(docs).collect()
    assert {r["doc_id"] for r in got} == {7, 9, 12, 20, 25}
    for i in (7, 12, 20):
        mine = [r for r in got if r["doc_id"] == i]
        covered = sorted({k for r in mine for k in range(r["start"], r["end"])})
        assert {r["source_id"] for r in mine} <= {3, 7, 12} and all(r["source_id"] < i for r in mine)
        assert set(passage) <= {texts[i][k] for k in covered} and len(covered) <= 64
    assert any(r["source_id"] == 5 and r["end"] - r["start"] >= 80 for r in got if r["doc_id"] == 9)


def test_exact_passages_of_lines_that_recur_elsewhere(spark):
    lines = [prose(8) for _ in range(36)]
    docs = {i: prose(30) + line + prose(30) for i, line in enumerate(lines)}  # each line stands in an earlier document of its own
    want = {}
    for k in range(6):
        passage = [w for line in lines[6 * k : 6 * k + 6] for w in line]
        docs[100 + k] = prose(70) + passage + prose(40)
        docs[200 + k] = prose(40 + k) + passage + prose(60)
        want[200 + k] = (100 + k, 40 + k, 88 + k)
    docs[107] = prose(20) + docs[100][75:112] + prose(10) + docs[101][70:115] + prose(10)  # 37 words are too few, 45 are not
    got = substring.repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string").repartition(7)).collect()
    assert {r["doc_id"]: (r["source_id"], r["start"], r["end"]) for r in got} == want | {107: (101, 67, 112)}


def test_text_that_repeats_itself_gives_few_passages(spark):
    rows = [(1, " ".join(prose(3) * 40)), (2, None)]
    rows[1] = (2, " ".join([rows[0][1]] * 2))  # 240 words
    got = substring.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {k for r in got for k in range(r["start"], r["end"])} == set(range(240)) and len(got) <= 6
    assert substring._cover([1, 1, 1, 1, 2, 2], [0, 1, 2, 60, 0, 44], [45, 46, 47, 105, 45, 89]) == [0, 2, 3, 4, 5]


def test_fragments_that_recur_elsewhere_do_not_hide_a_passage(spark):
    passage = prose(120)
    docs = {i: prose(40) + passage[12 * i : 12 * i + 20] + prose(40) for i in range(10)}
    docs |= {20: prose(50) + passage + prose(50), 21: prose(30) + passage + prose(70)}
    got = substring.repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")).collect()
    assert {k for r in got if (r["doc_id"], r["source_id"]) == (21, 20) for k in range(r["start"], r["end"])} >= set(range(30, 150))


def test_recall_of_edited_passages_against_brute_force(spark):
    """Pairs with 60 to 100 shared words of which one in twelve is replaced; brute force tells which are alike enough."""
    docs, pairs = {}, []
    for k in range(60):
        passage = prose(rnd.randint(60, 100))
        docs[2 * k], docs[2 * k + 1] = prose(60) + passage + prose(60), prose(50) + edited(passage, len(passage) // 12) + prose(70)
        pairs.append((2 * k + 1, 2 * k, passage))
    texts = {i: " ".join(w) for i, w in docs.items()}
    found = {(r["doc_id"], r["source_id"]) for r in substring.repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}

    def alike(a, b):
        """Whether some diagonal of the two texts has 45 words of which 80 % are equal, from the first equal word to the last."""
        x, y = docs[a], docs[b]
        for shift in range(-len(y), len(x)):
            same = [i for i in range(max(0, shift), min(len(x), len(y) + shift)) if x[i] == y[i - shift]]
            if same and same[-1] - same[0] + 1 >= 45 and len(same) >= 0.8 * (same[-1] - same[0] + 1):
                return True
        return False

    truth = {(a, b) for a, b, _ in pairs if alike(a, b)}
    assert len(truth) >= 50 and len(found & truth) >= 0.95 * len(truth)
    assert found <= {(a, b) for a, b, _ in pairs}


def test_recall_of_edited_passages_whose_slices_recur(spark):
    """As above, but slices of each passage also stand in earlier documents, which hold the first place of its seeds; and in some between the two."""
    docs, pairs, at = {}, {}, 0
    for size in (15, 20, 30):
        for k in range(30):
            passage = prose(rnd.randint(60, 100))
            slices = [passage[i : i + size] for i in range(0, len(passage), size)]
            for part in slices:
                docs[at] = prose(40) + part + prose(40)
                at += 1
            docs[at] = prose(60) + passage + prose(60)
            if k % 2:
                docs[at + 1] = prose(50) + slices[1] + prose(50)
            docs[at + 2] = prose(50) + edited(passage, len(passage) // 12) + prose(70)
            pairs[at + 2] = (at, size)
            at += 3
    got = substring.repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string").repartition(5)).collect()
    for size in (15, 20, 30):
        asked = {b: a for b, (a, n) in pairs.items() if n == size}
        found = {r["doc_id"] for r in got if asked.get(r["doc_id"]) == r["source_id"]}
        assert len(found) >= 0.9 * len(asked), (size, len(found))
    assert {r["doc_id"] for r in got} <= set(pairs)


def test_near_copies_whose_seeds_all_stand_in_many_documents_between(spark):
    """Slices of a passage stand in two documents before it, which hold the first places, and in eight between it and its near copy: neither the anchors nor the last documents are its source."""
    docs, want, at = {}, {}, 0
    for k in range(20):
        passage = prose(rnd.randint(70, 100))
        slices = [passage[i : i + 20] for i in range(0, len(passage), 20)]
        for j in range(11):
            if j == 2:
                source, docs[at] = at, prose(60) + passage + prose(60)
                at += 1
            for part in slices:
                docs[at] = prose(40) + part + prose(40)
                at += 1
        docs[at] = prose(50) + edited(passage, len(passage) // 12) + prose(70)
        want[at] = source
        at += 1
    texts = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string").repartition(5)
    got = substring.repeated_passages(texts).collect()
    found = {r["doc_id"] for r in got if want.get(r["doc_id"]) == r["source_id"]}
    assert len(found) >= 0.95 * len(want) and {r["doc_id"] for r in got} <= set(want)


def test_common_pairs_of_seeds_are_dealt_over_blocks(spark):
    """Any number of blocks gives the same matches, and a line that many documents share with nothing alike around it gives none."""
    s, line, body = substring.Settings(), prose(25), prose(70)
    docs = {i: prose(50) + line + prose(50) for i in range(40)}
    docs |= {50 + i: prose(30) + edited(body, 4) + prose(30) for i in range(12)}
    given = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string").cache()
    seeds = given.mapInArrow(substring._seeds(s, s.words, s.window), "seed long, doc_id long, place int").repartition(4, "seed").sortWithinPartitions("seed", "doc_id", "place")
    kind = substring.MATCHES + ", earlier_0 long, earlier_0_place int, earlier_1 long, earlier_1_place int, seed long, lost boolean, edge boolean"
    placed = seeds.mapInArrow(substring._matches(2, True), kind).cache()
    none = spark.createDataFrame([], substring.PASSAGES)
    one, many = (sorted(tuple(r) for r in substring._rest(given, placed, none, s, 4, block=n).collect()) for n in (4096, 2))
    assert one == many and one and all(r[0] > r[1] >= 50 for r in one)


def test_pairs_of_seeds_give_few_rows_that_cover_as_much_as_all_pairs():
    """A stretch of 36 words in 120 documents, which go on alike for some words, or with a word more inside: a row an asking one has few chains, and no pair of documents reaches further."""
    s, core, before, after = substring.Settings(), prose(36), prose(40), prose(40)
    texts = {}
    for i in range(120):
        low, high = rnd.randrange(41), rnd.randrange(41)
        inner = core[:18] + prose(i % 3 == 0) + core[18:]
        texts[i] = (prose(40 - low) + before[40 - low :] + edited(inner[5:-5], i % 5)[: len(inner) - 10] + after[:high] + prose(40 - high), len(inner) - 5)
        body = texts[i][0]
        body[40:40], body[40 + len(inner) - 5 : 40 + len(inner) - 5] = core[:5], core[-5:]
    hashed = {i: np.maximum(word_hashes([" ".join(w)])[0] >> np.uint64(32) & np.uint64(255), 2).astype(np.uint8) for i, (w, _) in texts.items()}
    rows = [(7, 0, asks, i, 40, 40 + texts[i][1], hashed[i].tobytes()) for asks in (True, False) for i in texts]
    kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    want = {}
    for i in texts:
        x = [40, 40 + texts[i][1] - 5]
        for j in range(i):
            got = substring.align([40, 35 + texts[i][1]], [40, 35 + texts[j][1]], hashed[i], hashed[j], s)
            if got[1] - got[0] >= 45 and 100 * got[4] >= 80 * max(got[1] - got[0], got[3] - got[2]):
                low, high = want.get(i, (x[0], x[0]))
                want[i] = min(low, got[0]), max(high, got[1])
    for size in (5, 1000):
        cols = [[*c] for c in zip(*[(k, b, a, d, p, q - 5, side) for k, b, a, d, p, q, side in rows], strict=True)]
        table = pa.table([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["key", "block", "asks", "doc_id", "p", "q", "beside"])
        found = [r for b in substring._alike(s)(iter(table.to_batches(max_chunksize=size))) for r in b.to_pylist()]
        reach = {}
        for r in found:
            got = substring.align(r["places"], r["source_places"], hashed[r["doc_id"]], hashed[r["source_id"]], s)
            low, high = reach.get(r["doc_id"], (40, 40))
            reach[r["doc_id"]] = min(low, got[0]), max(high, got[1])
            assert r["source_id"] < r["doc_id"]
        assert reach == want and len(want) > 100 and len(found) < 10 * len(texts)


def test_documents_without_open_places_ask_nothing():
    """The filter may let through such documents, and batches of them alone."""
    rows = [(i, p, 100 * i + p, 1, 0, 1, 7, 2, -1, 2, -1) for i in (5, 6) for p in (0, 9)]
    kinds = [pa.int64()] * 11
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [f"c{k}" for k in range(11)])
    assert list(substring._asks(substring.Settings(), None)(iter([batch]))) == []


def test_places_of_the_anchor_and_what_is_left_out():
    """As below, with places in the anchor document, and whether more documents have the seed than are told."""
    rows = sorted({(rnd.randrange(5), rnd.randrange(12), rnd.randrange(40)) for _ in range(150)} | {(9, 1, 1), (9, 1, 2), (10, 3, 3)})
    docs = {s: sorted({d for t, d, _ in rows if t == s}) for s, _, _ in rows}
    want = [(s, d, p, docs[s].index(d) >= 4) for s, d, p in rows if len(docs[s]) > 1]
    for size in (1, 2, 7, 1000):
        batches = (pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i : i + size], strict=True)], ["seed", "doc_id", "place"]) for i in range(0, len(rows), size))
        found = [(r["seed"], r["doc_id"], r["place"], r["lost"]) for b in substring._matches(2, True)(batches) for r in b.to_pylist()]
        assert found == want


def test_matches_name_the_last_documents_before_a_place():
    """Whatever the batches, against a plain loop."""
    rows = sorted({(rnd.randrange(4), rnd.randrange(9), rnd.randrange(40)) for _ in range(150)})

    def batches(size):
        for i in range(0, len(rows), size):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i : i + size], strict=True)], ["seed", "doc_id", "place"])

    want = []
    for seed, doc, place in rows:
        firsts = {}
        for s, d, p in rows:
            if s == seed and d < doc:
                firsts.setdefault(d, p)
        if firsts:
            anchor = min(firsts)
            last = sorted(firsts.items(), reverse=True)[:2] + [(anchor, -1)] * 2
            want.append((doc, anchor, place, firsts[anchor], *last[0], *last[1]))
    for size in (1, 7, 1000):
        found = [tuple(r.values()) for b in substring._matches(2)(batches(size)) for r in b.to_pylist()]
        assert found == want


def test_chains_have_the_best_value():
    """Of matches that do not overlap."""
    s = substring.Settings()
    for _ in range(60):
        x = np.array(sorted(rnd.sample(range(0, 120, 5), 6)))
        y = np.array([rnd.randrange(0, 120, 5) for _ in x])

        def value(chain):
            total = s.words
            for i, j in zip(chain, chain[1:]):
                gain = min(s.words, x[j] - x[i], y[j] - y[i])
                total += gain - s.gap_cost * (x[j] - x[i] + y[j] - y[i] - 2 * gain)
            return total

        every = [[]]
        for i in range(len(x)):
            every += [c + [i] for c in every if not c or y[c[-1]] < y[i]]
        assert value(substring.chains(x, y, s)[0]) == pytest.approx(max(value(c) for c in every if c))
        assert sorted(i for c in substring.chains(x, y, s) for i in c) == list(range(len(x)))


CLASH = ["_gone", "_may", "_cut_id", "_cuts", "doc.id", "bucket", "seed"]


def test_helper_columns_do_not_clash(repeats):
    docs, passage, _ = repeats
    wide = docs.select("*", *(F.lit(c).alias(c) for c in CLASH))
    for out in (minhash.keep_one(wide), substring.deduplicate(wide)):
        rows = out.collect()
        assert out.columns == wide.columns and len(rows) >= docs.count() - 1
        assert all([r[c] for c in CLASH] == CLASH for r in rows)
    assert minhash.keep_one(wide.where("false")).collect() == substring.deduplicate(wide.where("false")).collect() == []


def test_cut_out_passages(repeats, odd_docs, no_docs):
    docs, passage, _ = repeats
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r for r in substring.deduplicate(docs.withColumn("n_chars", F.length("text"))).collect()}
    assert len(got) == len(before)
    assert " ".join(passage) in got[3]["text"] and " ".join(passage[5:50]) not in got[12]["text"]
    assert got[25]["text"] == "" and got[25]["n_chars"] == 0
    assert got[0]["text"] == before[0] and got[40]["text"] is None
    assert substring.deduplicate(odd_docs).columns == odd_docs.columns
    assert substring.repeated_passages(no_docs).collect() == []


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "toxicity", "MinHash near-dedup", "substring dedup", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert rows and {r["doc_id"] for r in rows} < {r["doc_id"] for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:2]:
        assert stage(spark, docs, sf_dir).columns == docs.columns


def test_pipeline_stages_take_odd_tables(spark, sf_dir, odd_docs, no_docs):
    import corpus_pipeline

    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == docs.columns and out.count() <= docs.count()
        assert {r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()} == {r["doc_id"] for r in docs.collect()}


def test_one_id_with_different_texts_is_cut_by_one_of_them(spark):
    a, b = " ".join(prose(200)), " ".join(prose(300))
    rows = [(1, a), (2, a), (2, "short text here"), (2, b), (2, a), (3, b), (None, a)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for _ in range(2):
        got = [tuple(r) for r in substring.deduplicate(df.repartition(3), count_col=None).collect()]
        own = sorted(t for i, t in got if i == 2)
        assert len(got) == len(rows) and (1, a) in got and (None, a) in got and "short text here" in own
        counted = substring._texts(df.where("doc_id is not null")).join(df.selectExpr("text", "xxhash64(text) as text_hash"), "text_hash").select("text").distinct().first()[0]
        assert own == sorted(["", "short text here", b, ""] if counted == a else ["short text here", a, a, b])
        assert (3, "") in got if counted == b else (3, b) in got
