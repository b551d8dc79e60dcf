"""Entity matching by the automaton and by the join, against word windows in plain Python."""

import random
import re

import pyarrow as pa
import pytest

from docketlake.operators import entities
from docketlake.operators.automaton import Automaton

rnd = random.Random(2)


def tokens(text):
    return [w for w in re.sub(r"\W", " ", (text or "").lower(), flags=re.ASCII).split(" ") if w]


def brute(texts, aliases):
    found = set()
    for i, t in texts:
        t = tokens(t)
        for alias, entity in aliases:
            w = tokens(alias)
            if w and any(t[k : k + len(w)] == w for k in range(len(t) - len(w) + 1)):
                found.add((i, entity))
    return found


@pytest.fixture(scope="module")
def tables():
    vocabulary = ["the", "of", "a", "bank", "river", "city", "new", "york"]
    texts = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(60)))) for i in range(80)]
    long_text = [rnd.choice(vocabulary) for _ in range(4000)]
    texts += [(100, " ".join(long_text)), (101, None), (102, ""), (103, "The Bank, of; NEW-York!"), (104, "of of of of")]
    aliases = [(" ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(1, 5))), k % 23) for k in range(120)]
    # nested, overlapping, longer than a lane, longer than any text, empty
    aliases += [("of of of", 30), ("of of", 31), ("new york", 32), ("York", 33), (" ".join(long_text[300:1900]), 34), (" ".join(long_text[40:70]), 35), ("zzz " * 6000, 36), ("", 37), ("?!", 38), (None, 39), ("new york", 40), ("river zebra city", 41)]
    return texts, aliases


@pytest.mark.parametrize("most", [500_000, 0])
def test_aliases_of_any_length_match_where_their_words_stand(spark, tables, most):
    texts, aliases = tables
    t = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    a = spark.createDataFrame(aliases, "alias string, entity_id long")
    got = [tuple(r) for r in entities.match(t, a, most_words=most).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(texts, [x for x in aliases if x[0]])
    no = spark.createDataFrame([("New  York",)], "alias string")
    got = {tuple(r) for r in entities.match(t, a, blacklist=no, most_words=most).collect()}
    assert got == brute(texts, [x for x in aliases if x[0] and tokens(x[0]) != ["new", "york"]])
    assert not entities.match(t, a.limit(0), most_words=most).collect() and not entities.match(t.limit(0), a, most_words=most).collect()


def test_entity_ids_keep_their_type(spark):
    t = spark.createDataFrame([("d1", "Acme Corporation of Delaware")], "doc_id string, text string")
    a = spark.createDataFrame([("acme", "e1"), ("of delaware", "e2"), ("corporation delaware", "e3")], "alias string, entity_id string")
    assert {tuple(r) for r in entities.match(t, a).collect()} == {("d1", "e1"), ("d1", "e2")}


def test_matches_do_not_cross_texts_or_lanes():
    machine = Automaton.build([["a", "b"], ["b", "c", "a"], ["c"]])
    rows, found = machine.find(pa.array([["a"], ["b"], None, [], ["x"] * 510 + ["b", "c", "a", "b"], ["a", "x", "b"]], pa.list_(pa.string())))
    assert set(zip(rows.tolist(), found.tolist())) == {(4, 0), (4, 1), (4, 2)}
    assert Automaton.build([]).find(pa.array([["a"]]))[0].size == 0


def test_texts_are_not_exploded(spark, tables):
    texts, aliases = tables
    t, a = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(aliases, "alias string, entity_id long")
    plan = entities.match(t, a)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan and "MapInArrow" in plan
