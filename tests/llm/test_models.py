"""Toxicity, quality rules, language profiles, main text and media columns."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from docketlake.llm import extraction, langid, media, quality, toxicity
from docketlake.session import scratch


def test_segments_are_all_maximal_ones():
    import numpy as np

    rnd = random.Random(4)
    for _ in range(200):
        x = np.array([rnd.choice([0, 0, 0, 1.0, 2.0, 3.0]) for _ in range(rnd.randint(0, 14))])
        full = np.where(x > 0, x, -0.7)

        def maximal(a, b):
            out = []
            if b > a:
                best = max((full[i:j].sum(), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1))
                if best[0] > 0:
                    i, j = best[3], best[4]
                    out = [*maximal(a, i), (i, j), *maximal(j, b)]
            return out

        got = [(a, b) for a, b, _ in toxicity.segments(x, 0.7)]
        assert sum(full[a:b].sum() for a, b in got) == pytest.approx(sum(full[a:b].sum() for a, b in maximal(0, len(x))))
        assert all(abs(full[a:b].sum() - s) < 1e-9 for a, b, s in toxicity.segments(x, 0.7))


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(9)
    words = [a + b for a in "ba be bi bo bu da de di".split() for b in "ka ke ki ko ku la le li lo".split()]
    rows = []
    for i in range(600):
        text = [rnd.choice(words) for _ in range(rnd.randint(20, 80))]
        toxic = i % 4 == 0
        if toxic:
            text[rnd.randrange(len(text))] = rnd.choice(["moron,", "Scum", "idiot!"])
        rows.append((i, " ".join(text), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int").cache()


def test_toxicity_learns_and_ranks(labelled, odd_docs, no_docs):
    model = toxicity.learn(labelled.where("doc_id < 400"), labelled.select("doc_id", "toxic"))
    got = {r["doc_id"]: r for r in toxicity.score(labelled.where("doc_id >= 400"), model).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in labelled.collect()}
    assert sum(r["predicted"] == truth[i] for i, r in got.items()) >= 0.97 * len(got)
    assert all(r["passages"] for i, r in got.items() if r["predicted"])
    odd = toxicity.score(odd_docs, model).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert toxicity.score(no_docs, model).collect() == []
    kept = toxicity.drop_toxic(labelled, model)
    assert kept.columns == labelled.columns and 400 <= kept.count() <= 470
    empty = toxicity.learn(labelled.where("false"), labelled.select("doc_id", "toxic").where("false"))
    assert all(r["predicted"] == 0 for r in toxicity.score(odd_docs, empty).collect())


def test_calibration_is_that_of_plain_sums(spark):
    import math

    texts = ["scum here and there", "fine words only", "scum scum " + "x " * 5000 + "scum", ""]
    lexicon = {"=scum": 3.0}
    scorer = toxicity.Scorer()
    scorer.lexicon = lexicon
    rows = spark.createDataFrame([(t, 0) for t in texts], "text string, toxic int").coalesce(1)
    shared = spark.sparkContext.broadcast(lexicon)
    got = {(r["kind"], r["score"]): r["n"] for r in rows.mapInArrow(toxicity._tally("u", shared, 0.5), "kind string, score double, n long").collect()}
    assert got == {("words", 0.0): sum(len(t.split()) for t in texts), ("segments", 0.0): 3, ("token", 3.0): 4}
    found = [r["evidence"] for r in rows.mapInArrow(toxicity._evidence("u", shared, 0.5, 1.0, 0.1), "toxic int, evidence double").collect()]
    want = [math.log1p(sum(max(0.0, v - math.log(0.1 * len(t.split()))) for _, _, v in toxicity.segments(scorer.scores(t), 0.5))) if t else 0.0 for t in texts]
    assert found == pytest.approx(want)
    rate = toxicity._root(__import__("collections").Counter({3.0: 4}), 96, 0.5)
    assert 0.96 * math.exp(-0.5 * rate) + 0.04 * math.exp(3 * rate) == pytest.approx(1, abs=1e-6)


def test_log_odds_have_the_stated_prior(spark):
    import math

    rows = spark.createDataFrame([("bad good", 1)] * 6 + [("good", 0)] * 20, "text string, toxic int")
    got = toxicity._lexicon(rows, (20, 6), toxicity.Settings(least=0.1))
    a = 0.5 + 10 * 6 / 26
    odds = math.log((6 + a) / (6 + 11 - 6 - a)) - math.log((0 + a) / (20 + 11 - 0 - a)) - 2 * math.sqrt(1 / (6 + a) + 1 / a)
    assert got == pytest.approx({"=bad": odds, "bad": odds})


def test_a_language_with_one_document_has_a_reference(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice("the of and house river stone".split()) for _ in range(200)), "en") for i in range(30)]
    rows.append((99, " ".join("".join(rnd.choice("абвгдежз") for _ in range(5)) for _ in range(200)), "ru"))
    got = {r["doc_id"]: r for r in quality.assess(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[99]["kept"] and got[99]["class_distance"] < 0.01


def test_quality_counts_and_guards(spark, odd_docs, no_docs):
    text = "one two three one two three\nfour five\n\nfour five\n # $$ x"
    got = quality.assess(spark.createDataFrame([(1, text, None)], "doc_id long, text string, lang string")).first()
    assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"], got["n_repeat_words"]) == (13, 42, 3, 1, 6)
    rows = quality.assess(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[3]["n_words"] == 0 and by_id[3]["base_failed"] and not by_id[3]["kept"]
    assert quality.assess(no_docs).collect() == []
    kept = quality.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in rows if r["kept"]}


def test_quality_rejects_far_texts_and_keeps_prose(spark):
    rnd = random.Random(1)
    prose = lambda: " ".join(rnd.choice("the of and house river stone walks that with for garden evening".split()) for _ in range(200))
    rows = [(i, prose(), "en") for i in range(40)] + [(100, " ".join("%%## 77" for _ in range(120)) + " " + " ".join(str(k) for k in range(200)), "en")]
    got = {r["doc_id"]: r for r in quality.assess(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not got[100]["kept"]
    assert sum(r["kept"] or r["base_failed"] for i, r in got.items() if i < 100) == 40


def test_language_profiles(spark, odd_docs, no_docs):
    rows = []
    rnd = random.Random(2)
    for i in range(120):
        lang, parts = (("aa", "ling mor tev"), ("bb", "osch kau zen"), ("cc", "ñera uez illo"))[i % 3]
        rows.append((i, " ".join("".join(rnd.choice(parts.split()) for _ in range(2)) for _ in range(15)), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(docs.where("doc_id < 90"))
    got = langid.predict(docs.where("doc_id >= 90"), model).collect()
    assert all(r["lang_pred"] == ("aa", "bb", "cc")[r["doc_id"] % 3] and 0 < r["score"] <= 1 for r in got)
    odd = {r["doc_id"]: r["lang_pred"] for r in langid.predict(odd_docs, model).collect()}
    assert odd[2] == odd[3] == odd[4] == "und" and odd[9] != "und"
    assert langid.predict(no_docs, model).collect() == []
    nothing = langid.learn(docs.where("false"))
    assert {r["lang_pred"] for r in langid.predict(docs, nothing).collect()} == {"und"}


def test_prototypes_are_sums_of_three_gram_vectors(spark):
    import numpy as np

    docs = spark.createDataFrame([(t, lang) for t in ("abc abd", "zyx", None) for lang in ("aa", "bb", None)], "text string, lang string").repartition(3)
    langs, got = langid.learn(docs)
    _, code, _ = langid.grams(["abc abd", "zyx"])
    assert langs == ["aa", "bb"] and np.array_equal(got[0], langid.gram_vectors(code, 1024).sum(axis=0)) and np.array_equal(got[0], got[1])


def test_three_grams_are_those_of_a_plain_count():
    texts = ["Ab c", "", None, "  d\n\nee ", "x1y"]
    own, code, has = langid.grams(texts)
    assert has.tolist() == [True, False, False, True, True]
    letter = lambda c: ord(c) - 96 if c.isalpha() else 0
    want = []
    for k, t in enumerate(texts):
        for word in "".join(c if c.isalpha() else " " for c in (t or "").lower()).split():
            padded = f" {word} "
            want += [(k, (letter(padded[i]) * 128 + letter(padded[i + 1])) * 128 + letter(padded[i + 2])) for i in range(len(padded) - 2)]
    assert sorted(zip(own.tolist(), code.tolist(), strict=True)) == sorted(want)


PAGES = [
    ('<html><body><nav>Menu</nav><header>Top</header><article><h1>Title</h1><p>One,  two.<p>Three <b>fo</b>ur&nbsp;five &amp; six.<div class="comments"><p>bad words here</p></div></article><aside>side</aside><footer>&copy; x</footer></body></html>', "Title One, two. Three four five & six."),
    ('<body><div class="menu"><a href="/">a</a></div><div id="content"><p>Long text, with marks. And more of it, here.</p><script>var t="</p>";</script><p>Short.</p><form>Send</form></div><div class="sidebar">zz</div></body>', "Long text, with marks. And more of it, here. Short."),
    (None, ""),
    ("", ""),
    ("<script>x</script>", ""),
    ("plain words", "plain words"),
    ("<p>open <i>and", "open and"),
    ('<div><div class="nav"><a>Home</a></div><div class="body"><h2>Head</h2><p>A first text, long enough. With marks, too.<p>A <a href="x">linked</a> second, no less long.</div><ul class="related"><li><a>One</a><li><a>Two</a></ul><p class="cookie-notice">We use cookies, as all do.</p></div>', "Head A first text, long enough. With marks, too. A linked second, no less long."),
    ('<article><p>Text, with a <span class="ad">buy now</span> part.</p><div class="post-share"><p>Words on sharing, said at length.</p></div><div class="share"><a>tweet</a></div></article>', "Text, with a part. Words on sharing, said at length."),
]


def test_main_text(spark):
    rows = [(i, None, h, "clash") for i, (h, _) in enumerate(PAGES)]
    got = extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {i: t for i, (_, t) in enumerate(PAGES)}
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_media(spark, odd_docs, no_docs):
    many = spark.range(30).select(F.col("id").alias("doc_id"), F.concat(F.repeat(F.lit("shared passage of some length. "), 60), F.when(F.col("id") % 2 == 0, F.lit("")).otherwise(F.repeat(F.col("id").cast("string"), 700))).alias("text"))
    for docs in (odd_docs, many):
        texts = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in docs.collect()))
        got = sorted(media.through_media(docs).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"]))
        assert len(got) == len(texts)
        for (_, i, t), r in zip(texts, got, strict=True):
            raw = t.encode()
            body = raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw))
            assert (i, len(raw), len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-64:]), len(body) + 44) == (r["doc_id"] or 0, r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"], r["media_bytes"])
            assert r["media_sha256"] == hashlib.sha256(media.to_wav(body)).hexdigest()
    assert media.through_media(no_docs).collect() == []


def test_repeated_chunks_are_stored_once(spark):
    docs = spark.range(20).select(F.col("id").alias("doc_id"), F.repeat(F.lit("same bytes in all of them, "), 400).alias("text"))
    folder = scratch(spark, "media-test")
    media.store(docs, folder)
    chunks = spark.read.parquet(f"{folder}/chunks")
    assert chunks.count() == chunks.select("digest").distinct().count() == len(media.chunks_of(media.to_wav(media.payload(docs.first()["text"])[0])) and {media.digest(c) for c in media.chunks_of(media.to_wav(media.payload(docs.first()["text"])[0]))})
    assert spark.read.parquet(f"{folder}/media").where(F.exists("in_place", lambda c: c.isNotNull())).count() == 0


def test_path_scores_are_those_of_plain_sums():
    import math

    page = "<article><h1>Head</h1><p>One, two. Three!</p><p>Four <a>five</a>.</p><ul><li><a>six</a></li></ul><div class=ad><p>Buy, now.</p></div></article>"
    nodes, _ = extraction.text_nodes(page)
    paths, got = extraction.path_scores(nodes)
    groups = [(4, 0, 1, 0, 1), (16 + 4 + 4 + 1, 3 + 0 + 0 + 1, 4, 4, 1), (3, 0, 1, 3, 1), (9, 2, 1, 0, 0)]
    chars, marks = [g[0] / g[2] for g in groups], [1 + g[1] / g[2] for g in groups]
    smooth = lambda v, i: 0.1 * v[max(0, i - 1)] + 0.8 * v[i] + 0.1 * v[min(len(v) - 1, i + 1)]
    assert len(paths) == 4
    assert got.tolist() == pytest.approx([smooth(chars, i) * smooth(marks, i) * max(1 - g[3] / g[0], 0.05) * g[4] * math.log(1 + g[0]) for i, g in enumerate(groups)])


def test_other_scores_select_other_nodes(monkeypatch):
    page = "<body><nav><a>Menu</a></nav><article><h1>Head</h1><p>" + "Long text, with marks. " * 20 + "</p></article><footer>End, of it.</footer></body>"
    before, real = extraction.main_text(page), extraction.path_scores
    monkeypatch.setattr(extraction, "path_scores", lambda nodes: (real(nodes)[0], __import__("numpy").roll(real(nodes)[1], 1)))
    assert before.startswith("Head Long text") and "End" not in before and extraction.main_text(page) != before


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "Deep, text.", "<div>a, b. " * 50_000, "<a x " * 20_000 + '"', "<i>" * 50_000 + "</b>" * 50_000 + "x", "<p>" + "<script>" * 50_000, "< " * 100_000, "<a b=\"'" * 30_000, "<!--" * 50_000, "</p>" * 100_000])
def test_broken_pages_take_linear_time(page):
    import time

    start = time.process_time()
    assert isinstance(extraction.main_text(page), str)
    assert time.process_time() - start < 15


def test_main_text_of_odd_tables(spark):
    rows = [(1, None, None)] * 2 + [(None, "u", "<p>" + "Words, and more. " * 50_000 + "</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(r["n_chars"] for r in extraction.extract(pages).collect())
    assert got == [0, 0, 50_000 * 17 - 1] and extraction.extract(pages.where("false")).collect() == []


def test_cut_points_are_those_of_a_hash_rolled_byte_by_byte():
    data = bytes(random.Random(8).randrange(256) for _ in range(40_000))
    gear, mask = media._gear().astype("uint64"), (1 << 32) - 1
    cuts, last, h = [], 0, 0
    for i, byte in enumerate(data):
        h = (2 * h + int(gear[byte])) & mask
        size = i + 1 - last
        if size >= 8192 or size >= 256 and i >= 31 and h >> 22 == 0:
            cuts.append(i + 1)
            last = i + 1
    if last < len(data):
        cuts.append(len(data))
    assert list(media.cut_points(data)) == cuts
